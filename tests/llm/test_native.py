"""Secret, license, line, quality and URL operators against plain Python on small rows."""

import collections
import hashlib
import re

import pytest
from compare import difference, duck
from pyspark.sql import functions as F

from ledgersift.llm import common, license_scan, line_dedup, quality_rules, secret_scan, url_filter
from ledgersift.llm.common import running_starts

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _key string, words int"
AWKWARD = [
    None, "", " ", "\n\n", "a", "ß" * 30, "password=abc123 token : 'XYZ_12345678' x",
    "password=token:abcdefgh secret==deadbeef", "AKIA" + "A1" * 8 + " AKIAAKIA12 AKIAZZ",
    "0123456789abcdef01234567 " * 3 + "\U0001f600 api_key=abcdef0123456789abcdef01234567",
    "MIT License mit license MIT\nLicense; Apache-License general public\tlicense",
    "Released under the MIT License.\nLicensed under CC BY-NC 4.0.",
    "one two three four five six seven eight nine ten\n" * 4,
    "Aa0+" * 20, "q7Gv2Lx0PzRk9TtYwB3nMhJ5cD8eF1aS", "x" * 5000 + " tail",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or ""), "k", 1) for i, t in enumerate(AWKWARD)]
    rows += [rows[11], (None, "the same", None, None, None, None, None), (11, "other text", "en", "s", 10, "k", 2)]
    return spark.createDataFrame(rows, SCHEMA)


def texts(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def test_running_starts(spark):
    for n in (0, 1, 255, 256, 257, 1000):
        values = [(i * 7) % 11 for i in range(n)]
        got = spark.createDataFrame([(values,)], "v array<int>").select(running_starts(spark_col("v"), 256)).first()[0]
        assert got == [sum(values[:i]) for i in range(n)]


def spark_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


ASSIGN = re.compile(r"""((?:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_secret_base_spans(docs):
    want = collections.Counter()
    for doc_id, text in texts(docs):
        spans = base_spans(text)
        joined = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        counts = collections.Counter(k for _, k, _ in spans)
        want[(doc_id, counts[0], counts[1], counts[2], joined)] += 1
    got = collections.Counter()
    for r in secret_scan.scan_secrets(docs).collect():
        got[(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_spans)] += 1
        assert set(filter(None, r.base_spans.split(","))) <= set(r.spans.split(","))
        assert len(list(filter(None, r.spans.split(",")))) == r.n_assign + r.n_access + r.n_hex + r.n_random
    assert got == want


def test_randomness_tells_keys_from_words(spark):
    import random

    rng = random.Random(5)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choice(b64) for _ in range(40)) for _ in range(60)]
    plain = ["get2ElementsByTagNameFromNode%d" % i for i in range(30)] + ["Ab1" * 14] * 30
    plain = [p.replace("%", "") for p in plain]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(keys + plain)], "doc_id bigint, text string")
    found = {r.doc_id for r in secret_scan.scan_secrets(frame).where("n_random > 0").collect()}
    assert len([i for i in found if i < 60]) >= 52  # randomness is wrongly rejected at about 5 %
    assert not [i for i in found if i >= 60]


def test_long_text_is_searched_whole(spark):
    text = ("token=abcdef123 " * 3000) + "AKIA" + "B2" * 10
    row = secret_scan.scan_secrets(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert (row.n_assign, row.n_access) == (3000, 1)
    assert row.base_spans.endswith(f"access:{len(text) - 24}:{len(text)}")


def test_long_token_takes_one_pass(spark):
    text = "Qz7+" * 50_000
    row = secret_scan.scan_secrets(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert row.n_random == 0


def license_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_licenses_base(docs):
    want, got = collections.Counter(), collections.Counter()
    for doc_id, text in texts(docs):
        words, places, labels = license_words(text), [], set()
        for phrase, label in license_scan.PHRASES:
            p = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        want[(doc_id, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))] += 1
    for r in license_scan.scan_licenses(docs).collect():
        got[(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)] += 1
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0.0 <= r.score <= 1.0
    assert got == want


def test_license_join_is_exact(spark):
    import random

    rng = random.Random(3)
    lines = []
    for _ in range(300):
        label, text = rng.choice(license_scan.TEMPLATES)
        words = [w for w in text.split() if rng.random() > 0.08] + ["noise"] * rng.randrange(4)
        rng.shuffle(words)
        lines.append(" ".join(words))
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id int, text string")
    want = {}
    for i, line in enumerate(lines):
        have, best = set(license_words(line)), 0.0
        for _, text in license_scan.TEMPLATES:
            tokens = set(license_words(text))
            share = len(tokens & have) / len(tokens)
            if len(tokens & have) >= -(-license_scan.CONTAINMENT * len(tokens) // 100):
                best = max(best, share)
        want[i] = best
    got = {r.doc_id: (1.0 if r.n_base else 0.0, r.score) for r in license_scan.scan_licenses(frame).collect()}
    assert {i: s for i, (_, s) in got.items()} == {i: max(got[i][0], s) for i, s in want.items()}


def test_quality_measures(docs):
    for r in quality_rules.quality(docs).where("doc_id is not null and doc_id <> 11").collect():
        text = AWKWARD[r.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == len(covered)
        assert r.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert not (r.kept and r.base_failed)


def plain_dedup(docs):
    """The texts that ``dedup_lines`` leaves, for rows (id, text), text not null."""
    order = lambda d: (d[0] is None, d[0] or 0, hashlib.md5(f"{'-' if d[0] is None else d[0]}:{d[1]}".encode()).hexdigest())
    cut = {d: re.split(line_dedup.CUT, d[1]) for d in docs}
    bare = {d: [x.rstrip(line_dedup.BLANKS) for x in c] for d, c in cut.items()}
    code = lambda x: int(hashlib.md5(x.encode()).hexdigest()[:15], 16) % 1_000_003
    first, shared = {}, set()
    for d in sorted(cut, key=order):
        for i in range(1, len(bare[d])):
            pair = (bare[d][i - 1], bare[d][i])
            if (code(pair[1]) + line_dedup.MULTIPLIER * code(pair[0])) % line_dedup.PIECES_PER_BOUNDARY == 0 and any(pair):
                at = first.setdefault(pair, (d, i))
                if at != (d, i):
                    shared.add((d, at[0], i - at[1]))
    gone = collections.defaultdict(set)
    for d, f, apart in shared:
        run = []
        for i in range(len(cut[d]) + 1):
            if i < len(cut[d]) and 0 <= i - apart < len(bare[f]) and bare[d][i] == bare[f][i - apart]:
                run.append(i)
                continue
            if len(run) > 1 and len(" ".join(cut[d][k] for k in run).split()) >= line_dedup.LEAST_WORDS:
                gone[d] |= set(run)
            run = []
    return {d: "".join(x for i, x in enumerate(c) if i not in gone[d]) for d, c in cut.items()}


def test_line_dedup_against_plain(spark):
    import random

    rng = random.Random(9)
    passage = [f"shared line {i} of the passage" for i in range(12)]
    docs = []
    for d in range(60):
        own = [f"own {d} {i} {rng.random()}" for i in range(rng.randrange(6))]
        at = rng.randrange(len(own) + 1)
        docs.append((d, "\n".join(own[:at] + (passage if d % 2 else []) + own[at:])))
    turning = "\n".join(passage * 3)
    docs += [(60, None), (61, ""), (62, "\n\n\n\n"), (None, "\n".join(passage)), (None, turning), (1, turning), docs[1], docs[1]]
    docs += [(70, "Is it? Yes. No. " * 40), (71, "one. " + " ".join(passage) + ". two. "), (72, "three. " + " ".join(passage) + ".\nfour")]
    frame = spark.createDataFrame([(i, t, "x", 5) for i, t in docs], "doc_id bigint, text string, _chunks string, _key int")
    left = plain_dedup([d for d in docs if d[1] is not None])
    out = line_dedup.dedup_lines(frame)
    got = collections.Counter((r.doc_id, r.text) for r in out.collect())
    assert got == collections.Counter((d[0], left.get(d)) for d in docs)
    assert set(frame.columns) <= set(out.columns)
    stage = line_dedup.without_repeats(frame)
    assert stage.columns == frame.columns
    assert stage.where("text is null").count() == 1
    assert stage.where("doc_id = 3 and text like '%passage%'").count() == 0
    assert sum("shared line 5 " in (r.text or "") for r in stage.collect() if r.doc_id != 1) <= 2  # 71 and 72: other cuts


def test_repeated_passages_are_found(spark):
    """Passages of over 50 words in 1 to 8 lines, between different texts: nine in ten go, nothing else does."""
    import random

    rng = random.Random(17)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    sentence = lambda: " ".join(word() for _ in range(rng.randrange(5, 14))).capitalize() + ". "
    rows, cases = [], {}
    for n_lines in range(1, 9):
        for k in range(40):
            said = []
            while len(" ".join(said).split()) < 52:
                said.append(sentence())
            marks = sorted(rng.sample(range(1, len(said)), min(n_lines, len(said)) - 1)) if len(said) > 1 else []
            text = "\n".join("".join(said[a:b]).strip() for a, b in zip([0, *marks], [*marks, len(said)]))
            for copy in range(2):
                doc_id = len(rows)
                own = ["".join(sentence() for _ in range(6)) for _ in range(2)]
                inside = copy and k % 2  # the later one within a line
                rows.append((doc_id, own[0] + ("" if inside else "\n") + text + (" " if inside else "\n") + own[1]))
                cases[doc_id] = (copy, len(text.split()), own)
    out = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    caught = 0
    for doc_id, text in rows:
        copy, n_words, own = cases[doc_id]
        lost = len(text.split()) - len(out[doc_id].text.split())
        assert copy or lost == 0
        assert all(x.strip() in out[doc_id].text for x in own)
        caught += copy and lost >= 0.8 * n_words
    assert caught >= 0.9 * 320, caught


def test_stretches_within_others_are_left_out(spark):
    """A text that repeats itself agrees with itself at many distances; one stretch covers them all."""
    lines = [f"line {i} of a text that comes again and again" for i in range(10)]
    rows = [(1, "\n".join(lines * 30) + "\n"), (2, "before\n" + "\n".join(lines) + "\n"), (2, "before\n" + "\n".join(lines) + "\n"), (None, "other")]
    frame = spark.createDataFrame(rows, "_id bigint, _text string")
    texts = frame.withColumn("_key", common.row_key(F.col("_id"), F.col("_text")))
    signed = line_dedup._signed(texts)
    assert sorted((r._number, len(r._hashes)) for r in signed.collect()) == [(0, 301), (1, 12), (2, 1)]
    shared = line_dedup._shared(line_dedup._chunks(signed))
    assert sum(len(r._aparts) for r in shared.collect()) > 20
    assert "SortAggregate" not in shared._jdf.queryExecution().toString()
    parts = [[(p.start, p.end, p.apart) for p in r._parts] for r in line_dedup._stretches(signed, shared).collect()]
    assert sorted(parts) == [[(1, 12, 1)], [(10, 301, 10)]] or sorted(parts) == [[(1, 11, 1)], [(10, 300, 10)]], parts


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1?x#y", "http://example.com/en/2", "http://example.com",
        "http://a.b.net/es/", "http://net/fr/x", "http://xnet/fr/x", "ftp://h.org?q=://z.com/a", "://com/", "http://É.com/p\nq?r",
    ]
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)], "page_id bigint, url string, html string, host int")
    bad = [("bad.org", 1)] * 50 + [("good.org", 0)] * 50
    outcomes = spark.createDataFrame(bad, "host string, bad int")
    for r in url_filter.filter_urls(pages, outcomes).collect():
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", urls[r.page_id] or "")
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]) if m else ""
        path = m[2] if m else ""
        assert (r.host, r.path) == (host, path), urls[r.page_id]
        fits = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits, key=lambda x: len(x[0]), default=(None, None))
        assert r.rule == rule[0]
        assert r.verdict == (rule[1] or "allow")
    judged = {r.host: r.blocked for r in url_filter.reputation(outcomes).collect()}
    assert judged == {"bad.org": True, "good.org": False}


def test_hosts_without_outcomes_inherit(spark):
    """Lower bounds worked out by hand: prior 2 where one child is seen, else by the spread."""
    bad = [(f"h{k}.bad.org", 1) for k in range(3) for _ in range(50)] + [("www.good.net", 0)] * 400
    outcomes = spark.createDataFrame(bad, "host string, bad int")
    hosts = ["h0.bad.org", "new.bad.org", "new.good.net", "other.org", "other.net", "else.where", "www.good.net"]
    pages = spark.createDataFrame([(h, f"https://{h}/a") for h in hosts], "page_id string, url string")
    verdicts = {r.page_id: r.verdict for r in url_filter.filter_urls(pages, outcomes, (("none", "/", "allow"),)).collect()}
    assert {h for h, v in verdicts.items() if v == "block"} == {"h0.bad.org", "new.bad.org", "other.org"}


def test_empty_tables(spark, docs):
    none = docs.where("false")
    assert secret_scan.scan_secrets(none).count() == 0
    assert license_scan.scan_licenses(none).count() == 0
    assert quality_rules.quality(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert url_filter.filter_urls(pages, spark.createDataFrame([], "host string, bad int")).count() == 0


@pytest.mark.parametrize("name", ["op3_url_filter", "op7_license_scan", "op9_line_dedup", "op10_quality_rules"])
def test_matches_sql(spark, sf_dir, name):
    from ledgersift.llm.queries import CHECKS, QUERIES

    problem = difference(QUERIES[name](spark, sf_dir).toPandas(), duck(sf_dir).execute(CHECKS[name]).df())
    assert problem is None or problem.startswith("TYPES"), problem
