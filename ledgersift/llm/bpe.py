"""BPE encoding by tree concatenation, and decoding.

A text longer than a leaf is cut into halves, the halves again, down to leaves; the
leaves of all texts of a batch are encoded in parallel. Then neighbours are joined,
level by level: a window of the last tokens on the left and the first on the right is
encoded again, and grows until its outer tokens agree exactly with those of both sides.

Why agreement suffices: within one piece of the pre-tokenizer, a sequence is the encoding
of its bytes if each two neighbours are the encoding of theirs, and the tokens that agree
make the pairs on either edge of the window pairs of one of the three encodings. The
pre-tokenizer and the special tokens look no more than a few characters ahead and never
back, so agreement must also span ``AGREE_BYTES`` bytes and ``AGREE_TOKENS`` tokens. A window that has grown
over both sides is the encoding of the whole.

Defined results: a null text counts as empty; an empty text has no tokens (the hashes of
the empty string); special tokens within a text become their ids, as the library has it;
repeated rows are encoded alike; an empty table gives an empty result; other columns are
ignored. The vocabulary file is a parameter and is read on the driver.
"""

from __future__ import annotations

import hashlib
import json
from itertools import chain

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from ledgersift.llm.common import kept_by_worker, map_texts, query, table

VOCABULARY = "byte_bpe_50k.json"
#: Characters of a leaf; tokens on either side of a window at first; needed agreement.
LEAF_CHARS, WINDOW_TOKENS, AGREE_TOKENS, AGREE_BYTES = 4096, 16, 3, 24

#: Words whose ids an encoder remembers at most, but for those of the leaves at hand.
KNOWN_WORDS = 200_000
#: Characters of leaves encoded together.
GROUP_CHARS = 1 << 18
#: Text encoded at once; lists of ids take several times its size.
SLICE_BYTES = 2 << 20


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, all others for U+0100 onwards.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return symbols | {chr(0x100 + i): b for i, b in enumerate(rest)}


def _last(text: str) -> str:
    return text[-1:]


def _joined_at_blanks(parts: list[str]) -> list[str]:
    """Parts of a split at blanks, joined again where a part is empty or ends in white space."""
    out = [parts[0]]
    for part in parts[1:]:
        if not out[-1] or out[-1][-1].isspace():
            out[-1] += " " + part
        else:
            out.append(part)
    return out


class TreeEncoder:
    """Encodes texts of any length; made from the text of a vocabulary file."""

    def __init__(self, vocabulary: str, leaf_chars: int = LEAF_CHARS):
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.leaf_chars = leaf_chars
        self.known: dict[str, tuple] = {}
        symbols = byte_symbols()
        parsed = json.loads(vocabulary)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.bytes_of = [b""] * size
        for token, number in parsed["model"]["vocab"].items():
            self.bytes_of[number] = bytes(symbols[c] for c in token)
        for added in parsed["added_tokens"]:
            self.bytes_of[added["id"]] = added["content"].encode()
        self.numerals = [str(k).encode() for k in range(size)]
        self.length_of = np.array([len(b) for b in self.bytes_of], dtype=np.int64)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded_leaves(self, leaves: list[str]) -> list[list[int]]:
        """Leaves by their words: neither a token nor a piece of the pre-tokenizer spans the
        start of a blank after a visible character, so words encode alone. Known words are
        looked up; new ones are encoded together, once.
        """
        split = [leaf.split(" ") for leaf in leaves]
        new = set(chain.from_iterable(parts[1:] for parts in split)).difference(self.known)
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known.clear()
        missing: set[str] = set()
        for k, parts in enumerate(split):
            new = set(parts[1:]).difference(self.known)
            if not all(new) or any(map(str.isspace, map(_last, new))) or not parts[0] or parts[0][-1].isspace():
                split[k] = parts = _joined_at_blanks(parts)
                new = set(parts[1:]).difference(self.known)
            missing |= new
        self._learn([w for w in missing if w and not w[-1].isspace()])
        ending = [w for w in missing if not w or w[-1].isspace()]  # only at the end of a leaf
        own = dict(zip(ending, self._ids([" " + w for w in ending])))
        heads = self._ids([parts[0] for parts in split])
        get = self.known.__getitem__
        out = []
        for head, parts in zip(heads, split):
            if len(parts) > 1 and parts[-1] in own:
                middle, last = parts[1:-1], own[parts[-1]]
            else:
                middle, last = parts[1:], ()
            out.append([*head, *chain.from_iterable(map(get, middle)), *last])
        return out

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of a blank and each word; a text of them all is cut at the words."""
        for at in range(0, len(words), 1000):
            part = words[at : at + 1000]
            ids = np.array(self._ids(["".join([" " + w for w in part])])[0], dtype=np.int64)
            ends = np.cumsum([len(w.encode("utf-8", "surrogatepass")) + 1 for w in part])
            cuts = np.searchsorted(np.cumsum(self.length_of[ids]), ends, side="left") + 1
            ids = ids.tolist()
            first = 0
            for w, last in zip(part, cuts.tolist()):
                self.known[w] = tuple(ids[first:last])
                first = last

    def _leaves(self, text: str) -> list[str]:
        """Halves of halves, none longer than a leaf, in order."""
        if len(text) <= self.leaf_chars:
            return [text]
        parts = 1 << (-(-len(text) // self.leaf_chars) - 1).bit_length()
        cuts = [len(text) * k // parts for k in range(parts + 1)]
        return [text[a:b] for a, b in zip(cuts, cuts[1:])]

    def _join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring texts from theirs."""
        if not left or not right:
            return left + right
        width = WINDOW_TOKENS
        while True:
            outer_left, outer_right = left[max(0, len(left) - width) :], right[:width]
            raw = b"".join(map(self.bytes_of.__getitem__, outer_left + outer_right))
            try:
                window = self._ids([raw.decode()])[0]
            except UnicodeDecodeError:  # an edge within a character: take more
                window = None
            whole_left, whole_right = len(outer_left) == len(left), len(outer_right) == len(right)
            if window is not None:
                before = self._agreed(window, outer_left)
                after = self._agreed(window[::-1], outer_right[::-1])
                if (whole_left or before) and (whole_right or after):
                    return left[: len(left) - len(outer_left)] + window + right[len(outer_right) :]
            width *= 2

    def _agreed(self, window: list[int], side: list[int]) -> bool:
        """The window begins with enough tokens of the side, short of the join."""
        same = 0
        for a, b in zip(window, side):
            if a != b:
                break
            same += 1
        if same < AGREE_TOKENS:
            return False
        return int(self.length_of[window[:same]].sum()) >= AGREE_BYTES

    def encode(self, texts: list[str]) -> list[list[int]]:
        leaves, spans = [], []
        for text in texts:
            own = self._leaves(text)
            spans.append((len(leaves), len(leaves) + len(own)))
            leaves += own
        done, at = [], 0
        while at < len(leaves):
            end, size = at, 0
            while end < len(leaves) and size < GROUP_CHARS:
                size += len(leaves[end])
                end += 1
            done += self._encoded_leaves(leaves[at:end])
            at = end
        out = []
        for first, last in spans:
            level = done[first:last]
            while len(level) > 1:
                level = [self._join(level[k], level[k + 1]) for k in range(0, len(level), 2)]
            out.append(level[0])
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of token ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _encoder(vocabulary: str, leaf_chars: int) -> TreeEncoder:
    """The encoder of this Python worker, made once; another vocabulary takes its place."""
    kept, key = kept_by_worker(), (hash(vocabulary), leaf_chars)
    if kept.get("encoder", (None, None))[0] != key:
        kept["encoder"] = (key, TreeEncoder(vocabulary, leaf_chars))
    return kept["encoder"][1]


def _vocabulary(path: str | None) -> str:
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        return file.read()


def _map_tokens(docs: DataFrame, path: str | None, leaf_chars: int, compute, added: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(_vocabulary(path))  # a vocabulary file of fixed size

    def run(texts: list) -> dict:
        encoder = _encoder(shared.value, leaf_chars)
        return compute(encoder, encoder.encode([t or "" for t in texts]))

    return map_texts(docs.select("doc_id", "text"), ["doc_id"], run, added, slice_bytes=SLICE_BYTES)


def encode(docs: DataFrame, path: str | None = None, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """doc_id and ids of every row."""
    return _map_tokens(docs, path, leaf_chars, lambda _, ids: {"ids": ids}, "ids array<int>")


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of rows (doc_id, ids); null ids give a null text."""
    shared = tokens.sparkSession.sparkContext.broadcast(_vocabulary(path))

    def run(rows: list) -> dict:
        encoder = _encoder(shared.value, LEAF_CHARS)
        return {"text": [None if ids is None else encoder.decode(ids) for ids in rows]}

    return map_texts(tokens, ["doc_id"], run, "text string", text_col="ids")


def digests(docs: DataFrame, path: str | None = None, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """doc_id, n_tokens, and hashes of the ids and of the text decoded from them."""
    sha = lambda raw: hashlib.sha256(raw).hexdigest()

    def compute(encoder: TreeEncoder, ids: list[list[int]]) -> dict:
        numeral = encoder.numerals.__getitem__
        return {
            "n_tokens": [len(x) for x in ids],
            "ids_sha256": [sha(b",".join(map(numeral, x))) for x in ids],
            "decoded_sha256": [sha(encoder.decode(x).encode("utf-8")) for x in ids],
        }

    return _map_tokens(docs, path, leaf_chars, compute, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


@query("op2_bpe_tokens")
def op2_bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
