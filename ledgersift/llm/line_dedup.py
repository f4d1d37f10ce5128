"""Line dedup: content-defined chunks of lines find repeated passages, each kept once.

A text is cut into lines, and long lines by content: after sentence ends and after words of
twelve letters or more. A rolling hash over the hashes of two such pieces chooses the
boundaries, one piece in two on average, wherever the passage stands in a document. The two
pieces that the hash has read at a boundary are its chunk. A chunk met again gives the place
of its first occurrence (lowest id, then lowest place); from there both texts are
compared piece by piece, by their bytes, as far as they agree to both sides. Agreeing
stretches of ``LEAST_WORDS`` words or more are removed from the later document.

Only hashes of chunks are counted over the corpus, combined before the shuffle; texts travel
once for each pair of a document and an earlier one of which a stretch may go. Every text is
cut and hashed once, into a work table; stretches are found on the hashes by their first and
last pieces, and those within another one of the document are not compared. Every removed piece stands in an earlier place, so the first of all is always kept.

Defined results: pieces that differ in the blanks or line ends after them are equal; a null
text stays null and an empty text empty; a stretch without a word is left alone; a null id
counts as the largest; repeated rows (same id, same text) count as one place and get one
answer; an empty table gives an empty result; further columns, whatever their names, are
kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgersift.llm.common import discard, free_finished_shuffles, free_name, query, row_key, table, written

#: One piece in so many is a boundary, on average.
PIECES_PER_BOUNDARY = 2
MULTIPLIER = 31
#: Words of a stretch that is removed, at least.
LEAST_WORDS = 30
#: Where a line is cut: after its end, after a sentence, after a long word. All cuts follow a
#: space or a line end; that test comes first, so most characters need no other.
_AFTER = r"(?:(?<=\n)|(?<=[.!?] )|(?<=[^ \n]{12} ))"
CUT = r"(?<=[ \n])" + _AFTER
#: The same cuts, which take the space or line end before them away.
ENDED = r"[ \n]" + _AFTER
#: What may differ after a piece.
BLANKS = " \n\r\t"
#: A place is the number of a document with the number of a piece in so many bits below it.
AT_BITS = 31


def pieces(text: Column) -> Column:
    """The pieces of a text; put together they are the text."""
    return F.split(text, CUT, -1)


def _code(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _hash(piece: Column) -> Column:
    blank = [piece.endswith(end) for end in BLANKS]  # few are, and trimming goes through all characters
    bare = F.when(blank[0] | blank[1] | blank[2] | blank[3], F.rtrim(piece, F.lit(BLANKS))).otherwise(piece)
    return _code(F.md5(bare.cast("binary")))


def _signed(texts: DataFrame) -> DataFrame:
    """(_key, _number, _hashes): the hashes of the pieces of every different row.

    Numbers go without gaps by id, null last, and key: a place is one whole number, which
    aggregates by hash where a struct of id, key and place would have to be sorted.
    """
    raw = written(texts.select("_key", "_id", F.transform(F.split("_text", ENDED, -1), _hash).alias("_hashes")), "line-raw")
    in_order = raw.select("_key", "_id").distinct().orderBy(F.col("_id").asc_nulls_last(), "_key")
    sorted_keys = written(in_order.select("_key", F.monotonically_increasing_id().alias("_place")), "line-order")
    part = F.shiftright("_place", 33).cast("int")  # of the sort, with the row in it below
    counts = {r["part"]: r["count"] for r in sorted_keys.groupBy(part.alias("part")).count().collect()}  # one for each task
    shifts, before = [], 0
    for k in range(max(counts, default=0) + 1):
        shifts.append(F.lit(before - (k << 33)).cast("bigint"))
        before += counts.get(k, 0)
    numbers = sorted_keys.select("_key", (F.col("_place") + F.get(F.array(*shifts), part)).alias("_number"))
    once = raw.select("_key", "_hashes").join(numbers, "_key").dropDuplicates(["_key"])
    signed = written(once.select("_key", "_number", "_hashes"), "line-hashes")
    discard(raw, sorted_keys)
    del once, numbers, raw, sorted_keys, in_order
    free_finished_shuffles(texts.sparkSession)
    return signed


def _chunks(signed: DataFrame) -> DataFrame:
    """(_digest, _place, _size): the chunks at boundaries; the place is that of the second piece."""
    small = lambda h: h % 1_000_003
    here, before = F.col("_hash"), F.get("_hashes", F.col("_at") - 1)
    rolled = small(here) + F.lit(MULTIPLIER) * small(before)
    empty = _code(F.md5(F.lit("").cast("binary")))
    pairs = signed.select("_number", "_hashes", F.posexplode("_hashes").alias("_at", "_hash")).where(F.col("_at") > 0)
    bounds = pairs.where((rolled % PIECES_PER_BOUNDARY == 0) & ((here != empty) | (before != empty)))
    place = F.shiftleft("_number", AT_BITS).bitwiseOR(F.col("_at").cast("bigint"))
    return bounds.select(F.xxhash64(before, here).alias("_digest"), place.alias("_place"), F.size("_hashes").alias("_size"))


def _shared(chunks: DataFrame) -> DataFrame:
    """(_number, _first, _size, _aparts): a document, an earlier one with chunks of it, and their distances."""
    number = lambda place: F.shiftright(place, AT_BITS)
    at = lambda place: F.col(place).bitwiseAND(F.lit((1 << AT_BITS) - 1)).cast("int")
    repeated = (
        chunks.groupBy("_digest")
        .agg(F.min("_place").alias("_first_place"), F.max("_place").alias("_last_place"))
        .where("_first_place <> _last_place")
        .select("_digest", "_first_place")
    )
    hits = chunks.join(repeated, "_digest").where("_place <> _first_place")
    apart = (at("_place") - at("_first_place")).alias("_apart")
    each = hits.select(number("_place").alias("_number"), number("_first_place").alias("_first"), "_size", apart).distinct()
    return each.groupBy("_number", "_first", "_size").agg(F.collect_list("_apart").alias("_aparts"))


def _stretches(signed: DataFrame, shared: DataFrame) -> DataFrame:
    """(_key, _parts): stretches of pieces whose hashes agree with an earlier document.

    Those that lie within another one are left out: they cover nothing more, and are no longer.
    """
    firsts = signed.select(F.col("_number").alias("_first"), F.col("_key").alias("_first_key"), F.col("_hashes").alias("_b"))
    own = signed.select("_number", "_key", F.col("_hashes").alias("_a"))
    # only what the later document can lie beside travels on; _from is its first piece
    most = F.size("_b")
    begin = F.least(F.greatest(-F.array_max("_aparts"), F.lit(0)), most)
    end = F.least(F.col("_size") - F.array_min("_aparts"), most)
    beside = shared.join(firsts, "_first").select(
        "_number", "_first", "_first_key", "_aparts", begin.alias("_from"), F.slice("_b", begin + 1, F.greatest(end - begin, F.lit(0))).alias("_b")
    )
    pairs = beside.join(own, "_number").select("*", F.explode("_aparts").alias("_apart"))
    # piece _i of _a beside piece _i - _back of _b
    back = F.col("_apart") + F.col("_from")
    pairs = pairs.withColumn("_back", back).withColumn("_lead", F.greatest(back, F.lit(0)))
    until = F.least(F.size("_a"), F.size("_b") + F.col("_back"))
    at = pairs.withColumn("_until", until).where("_until > _lead").select("*", F.explode(F.sequence("_lead", F.col("_until") - 1)).alias("_i"))

    def same(i: Column) -> Column:  # beyond either end: no
        return F.coalesce(F.get("_a", i) == F.get("_b", i - F.col("_back")), F.lit(False))

    # of two pieces or more, the first and the last
    follows = same(F.col("_i") + 1)
    marks = at.where(same(F.col("_i")) & (same(F.col("_i") - 1) != follows))
    marks = marks.select("_number", "_first", "_key", "_first_key", "_apart", "_i", follows.alias("_starts"))
    run = Window.partitionBy("_number", "_first", "_apart").orderBy("_i")
    runs = marks.withColumn("_end", F.lead("_i").over(run) + 1).where("_starts")
    by_start = Window.partitionBy("_number").orderBy("_i", F.desc("_end"), "_first", "_apart")
    reached = F.max("_end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    kept = runs.withColumn("_reached", reached).where("_reached IS NULL OR _end > _reached")
    part = F.struct(F.col("_i").alias("start"), F.col("_end").alias("end"), F.col("_first_key").alias("first"), F.col("_apart").alias("apart"))
    return kept.groupBy("_number", "_key").agg(F.collect_list(part).alias("_parts")).select("_key", "_parts")


def _agreeing(texts: DataFrame, stretches: DataFrame) -> DataFrame:
    """(_key, _gone): those stretches that are long enough and agree by their bytes."""
    # dealt by key before, so the texts are sorted once
    once = texts.select("_key", "_text").repartition("_key").dropDuplicates(["_key"])
    firsts = once.select(F.col("_key").alias("_first_key"), F.col("_text").alias("_first_text"))
    cut = stretches.join(once, "_key").select("_key", "_parts", pieces(F.col("_text")).alias("_pieces"))
    joined = lambda of, s, by: F.array_join(F.slice(of, s["start"] - by + 1, s["end"] - s["start"]), "")
    own = F.transform("_parts", lambda s: F.struct(s.alias("at"), joined(F.col("_pieces"), s, F.lit(0)).alias("text")))
    # _pieces is named outside the lambda too: named there alone, the text would be cut anew for each part
    own = F.when(F.size("_pieces") > 0, own)
    enough = lambda x: x.rlike(f"^[ \\t-\\r]*+(?:[^ \\t-\\r]++[ \\t-\\r]++){{{LEAST_WORDS - 1}}}[^ \\t-\\r]")  # noqa: E731  reads no further
    long = F.filter(F.col("_own"), lambda x: enough(x["text"]))
    # one row for each earlier document, so its text is cut once; outer: a test of the array's
    # size would be pushed down and cut the texts once more
    names = F.array_distinct(F.transform("_long", lambda x: x["at"]["first"]))
    each = (
        cut.select("_key", own.alias("_own"))
        .select("_key", long.alias("_long"))
        .select("_key", "_long", F.explode_outer(names).alias("_first_key"))
        .where("_first_key IS NOT NULL")
        .select("_key", "_first_key", F.filter("_long", lambda x: x["at"]["first"] == F.col("_first_key")).alias("_mine"))
    )
    held = each.join(firsts, "_first_key").select("_key", "_mine", pieces(F.col("_first_text")).alias("_pieces"))
    bare = lambda x: F.trim(F.regexp_replace(x, "[ \\n\\r\\t]+", " "))

    def same(x: Column) -> Column:
        theirs = joined(F.col("_pieces"), x["at"], x["at"]["apart"])
        return (x["text"] == theirs) | (bare(x["text"]) == bare(theirs))

    proven = F.when(F.size("_pieces") > 0, F.filter("_mine", same))
    spans = F.transform(proven, lambda x: F.struct(x["at"]["start"].alias("start"), x["at"]["end"].alias("end")))
    return (
        held.select("_key", spans.alias("_spans"))
        .groupBy("_key")
        .agg(F.array_distinct(F.flatten(F.collect_list("_spans"))).alias("_gone"))
        .where(F.size("_gone") > 0)
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with cleaned ``text_col``, and counts of pieces before and removed.

    The counts are ``_ls_lines`` and ``_ls_removed``; ``_ls_all_gone`` tells that a text had
    pieces and none is left (see ``count_names`` for documents that have such columns).
    """
    key = row_key(F.col(id_col), F.col(text_col)).alias("_key")
    texts = docs.select(key, F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where("_text IS NOT NULL")
    signed = _signed(texts)
    stretches = written(_stretches(signed, _shared(_chunks(signed))), "line-stretches")
    free_finished_shuffles(docs.sparkSession)  # still in use until here
    removed = written(_agreeing(texts, stretches), "line-removed")  # so the texts are not dealt twice at one time
    free_finished_shuffles(docs.sparkSession)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), key)
    counted = signed.select("_key", F.size("_hashes").alias("_total")).join(removed, "_key", "left")
    return _rebuilt(docs, keyed, counted, text_col)


def count_names(columns: list[str]) -> tuple[str, str, str]:
    """The names of the three added columns: free ones."""
    return tuple(free_name(columns, name) for name in ("_ls_lines", "_ls_removed", "_ls_all_gone"))


def _rebuilt(docs: DataFrame, keyed: DataFrame, counted: DataFrame, text_col: str) -> DataFrame:
    """Put the remaining pieces together again, in rows that lost any."""
    text = F.col(f"_row.`{text_col}`")
    lost = F.col("_gone").isNotNull()
    cut = keyed.join(counted, "_key", "left").withColumn("_pieces", F.when(lost, pieces(text)))
    inside = lambda i: F.exists("_gone", lambda s: (s["start"] <= i) & (i < s["end"]))
    rows = cut.withColumn("_left", F.when(lost, F.filter("_pieces", lambda x, i: ~inside(i))))
    cleaned = F.when(lost, F.array_join("_left", "")).otherwise(text)
    total = F.when(text.isNull(), F.lit(0)).otherwise(F.coalesce("_total", F.lit(0)))
    fields = [cleaned.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    n_lines, n_removed, all_gone = count_names(docs.columns)
    return rows.select(
        *fields,
        total.cast("bigint").alias(n_lines),
        F.when(lost, total - F.size("_left")).otherwise(F.lit(0)).cast("bigint").alias(n_removed),
        F.coalesce(lost & ((F.size("_left") == 0) | ~F.array_join("_left", "").rlike("[^ \\t-\\r]")), F.lit(False)).alias(all_gone),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """The pipeline stage: cleaned documents; those with no line left go, ``n_chars`` follows."""
    _, n_removed, all_gone = count_names(docs.columns)
    cleaned = dedup_lines(docs).where(~F.col(all_gone))
    if "n_chars" in docs.columns:
        size = F.when(F.col(n_removed) > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        cleaned = cleaned.withColumn("n_chars", size.otherwise(F.col("n_chars")))
    return cleaned.select(*[f"`{c}`" for c in docs.columns])


_SQL = f"""
WITH d AS (SELECT DISTINCT doc_id, text, md5(coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, '')) AS r
  FROM documents WHERE text IS NOT NULL),
s AS (SELECT r, doc_id, string_split(regexp_replace(text, '(\\n|[.!?] |[^ \\n]{{12}} )', '\\1' || chr(57344), 'g'), chr(57344)) AS us FROM d),
u AS (SELECT r, doc_id, unnest(us) AS unit, generate_subscripts(us, 1) AS i FROM s),
h AS (SELECT *, rtrim(unit, chr(32) || chr(10) || chr(13) || chr(9)) AS bare FROM u),
g AS (SELECT *, ('0x' || substr(md5(bare), 1, 15))::BIGINT AS h FROM h),
b AS (SELECT r, doc_id, i, bare, lag(bare) OVER w AS before,
  (h % 1000003 + {MULTIPLIER} * (lag(h) OVER w % 1000003)) % {PIECES_PER_BOUNDARY} = 0 AS cuts FROM g
  WINDOW w AS (PARTITION BY r ORDER BY i)),
f AS (SELECT r, i, first_value(r) OVER w AS fr, first_value(i) OVER w AS fi FROM b
  WHERE cuts AND NOT (bare = '' AND before = '') WINDOW w AS (PARTITION BY before, bare ORDER BY doc_id, r, i)),
p AS (SELECT DISTINCT r, fr, i - fi AS apart FROM f WHERE r <> fr OR i <> fi),
e AS (SELECT p.r, p.fr, p.apart, x.i, len(regexp_extract_all(x.unit, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM p JOIN h x ON x.r = p.r JOIN h y ON y.r = p.fr AND y.i = x.i - p.apart AND y.bare = x.bare),
j AS (SELECT *, i - row_number() OVER (PARTITION BY r, fr, apart ORDER BY i) AS run FROM e),
k AS (SELECT *, sum(words) OVER w AS total, count(*) OVER w AS n FROM j WINDOW w AS (PARTITION BY r, fr, apart, run)),
gone AS (SELECT DISTINCT r, i FROM k WHERE total >= {LEAST_WORDS} AND n > 1),
x AS (SELECT u.r, count(*) AS n_lines, count(gone.i) AS n_removed,
  coalesce(string_agg(unit, '' ORDER BY u.i) FILTER (gone.i IS NULL), '') AS cleaned FROM u LEFT JOIN gone ON gone.r = u.r AND gone.i = u.i GROUP BY u.r)
SELECT o.doc_id, coalesce(x.n_lines, 0)::BIGINT AS n_lines, coalesce(x.n_removed, 0)::BIGINT AS n_removed,
  sha256(x.cleaned) AS text_sha256 FROM documents o
LEFT JOIN x ON o.text IS NOT NULL AND x.r = md5(coalesce(o.doc_id::VARCHAR, '-') || ':' || coalesce(o.text, ''))
"""


@query("op9_line_dedup", _SQL)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("_ls_lines").alias("n_lines"),
        F.col("_ls_removed").alias("n_removed"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )
