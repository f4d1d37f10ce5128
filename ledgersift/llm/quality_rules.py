"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Every measure is a built-in expression over one row, so a text never leaves its task
and nothing is shuffled. Defined results: a null or empty text has no words and fails
the base rule; ties do not arise; repeated rows are judged alike; an empty table gives
an empty result; columns of the input are neither read nor kept, but for id and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersift.llm.common import query, space_words, table

SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as",
    "be", "by", "this", "are", "from", "at", "an", "or",
    "der", "die", "das", "und", "ist", "zu", "von", "mit", "den", "dem", "ein", "eine", "auf",
    "für", "nicht", "sich", "des", "im",
    "le", "la", "les", "de", "des", "et", "un", "une", "du", "que", "qui", "est", "dans", "pour",
    "par", "au", "aux", "en", "pas", "ne",
    "el", "los", "las", "del", "y", "se", "su", "con", "por", "para", "no", "al", "lo", "como",
)

#: (measure, relation, limit): a text is kept if every line holds.
RULES = (
    ("mean_word_length", ">=", 2.0),
    ("mean_word_length", "<=", 12.0),
    ("symbols_per_word", "<=", 0.3),
    ("stop_word_share", ">=", 0.02),
    ("duplicate_line_share", "<=", 0.5),
    ("letter_word_share", ">=", 0.6),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the counts that the rules need."""
    text = F.col("text")
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    split = base.select(
        "doc_id",
        space_words(text).alias("words"),
        F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: F.translate(x, " \t\x0b\f\r", "") != "").alias("lines"),
    )
    words = F.col("words")
    starts = F.slice(words, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))
    hashed = split.select(
        "doc_id", "word_chars", "n_symbols", "words",
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform(
            starts, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WINDOW)])
        ).alias("windows"),
    )
    # Only texts with a repeated window are sorted; the window's place goes along.
    windows = F.col("windows")
    placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    nothing = F.lit(None).cast("array<struct<h:bigint,i:int>>")
    ordered = hashed.withColumn(
        "ordered",
        F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.sort_array(placed)).otherwise(nothing),
    )
    row = F.col("ordered")
    repeated = F.filter(
        row,
        lambda x, k: F.coalesce(F.get(row, k - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(row, k + 1)["h"] == x["h"], F.lit(False)),
    )
    found = ordered.withColumn("places", F.sort_array(F.transform(repeated, lambda x: x["i"])))
    places = F.col("places")
    covered = F.aggregate(
        F.transform(places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x,
    )
    letters = "[A-Za-z\\x{80}-\\x{10FFFF}]"
    return found.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.col("n_lines").cast("bigint").alias("n_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(*dict.fromkeys(STOP_WORDS)))).cast("bigint").alias("n_stop"),
        F.size(F.filter("words", lambda w: w.rlike(letters))).cast("bigint").alias("n_letter_words"),
    )


def _verdict(rules: tuple) -> Column:
    """The whole table as one boolean expression."""
    values = {
        "mean_word_length": _ratio(F.col("word_chars"), F.col("n_words")),
        "symbols_per_word": _ratio(F.col("n_symbols"), F.col("n_words")),
        "stop_word_share": _ratio(F.col("n_stop"), F.col("n_words")),
        "duplicate_line_share": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
        "letter_word_share": _ratio(F.col("n_letter_words"), F.col("n_words")),
    }
    verdict = F.lit(True)
    for name, relation, limit in rules:
        verdict = verdict & (values[name] >= limit if relation == ">=" else values[name] <= limit)
    return verdict


def quality(docs: DataFrame, rules: tuple = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measures with ``base_failed`` and ``kept`` for every document."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measures(docs, id_col, text_col).withColumns({"base_failed": failed, "kept": ~failed & _verdict(rules)})


_STOP_LIST = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
l AS (SELECT r, doc_id, text, words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM w),
g AS (SELECT r, i, list_aggregate(words[i:i+4], 'string_agg', ' ') AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM g) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS c FROM rep, (SELECT unnest(range(5)) AS k) GROUP BY r),
m AS (SELECT l.doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(cov.c, 0) AS BIGINT) AS n_repeat_words,
  len(lines) AS n_lines,
  len(list_filter(words, lambda x: lower(x) IN ({_STOP_LIST}))) AS n_stop,
  len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z\\x{{80}}-\\x{{10FFFF}}]'))) AS n_letter
  FROM l LEFT JOIN cov ON cov.r = l.r),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 2.0 * n_words AND word_chars <= 12.0 * n_words
    AND n_symbols::DOUBLE / n_words <= 0.3 AND n_stop::DOUBLE / n_words >= 0.02
    AND (n_lines = 0 OR n_dup_lines::DOUBLE / n_lines <= 0.5)
    AND n_letter::DOUBLE / n_words >= 0.6 AS kept
FROM b
"""


@query("op10_quality_rules", _SQL)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
