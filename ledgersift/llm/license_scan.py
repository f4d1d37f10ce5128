"""License scan: exact set-similarity join of text blocks with license templates.

Tokens are ordered by how many blocks of the whole corpus hold them, rarest first. A
template needs ``required`` of its tokens in a block, so one of its first
``size - required + 1`` tokens must be there (prefix filter); the block needs that many
template tokens at all (length filter), and as many must still be left from the first
common token on in both (positional filter). What passes is counted exactly. Blocks are
lines. Only tokens of the templates are kept of a block, and only blocks with a prefix
token go on, so next to nothing is shuffled.

Defined results: a null text counts as empty; an empty text has no words, no labels and
score 0; repeated rows are scanned alike; tied token counts are ordered by the token; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersift.llm.common import query, row_key, table

#: Base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Share of a template's tokens that a block must hold, in percent.
CONTAINMENT = 90
#: Most template rows that are sent to every task; a larger index is joined by shuffle.
BROADCAST_ROWS = 20_000

# Sentences of public license notices, with the label each stands for.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc", "Licensed under CC BY-NC 4.0"),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mit", "Released under the MIT License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


def _template_tokens(text: str) -> list[str]:
    kept = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower())
    return sorted(set(kept.split()))


def _required(size: int) -> int:
    return -(-CONTAINMENT * size // 100)


def folded(text: Column) -> Column:
    """Words parted by one blank, lines by a line feed.

    Lower-casing all letters gives the same word places as A-Z alone: no other letter
    turns into a word character from outside one, and none into a letter of a phrase.
    """
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", " ")


def _blocks(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(_key, tokens): per line the template tokens it holds, in the order of ``vocabulary``."""
    wanted = F.array(*[F.lit(t) for t in vocabulary])
    lines = docs.select("_key", F.explode_outer(F.split("_folded", "\n")).alias("line"))
    return lines.select("_key", F.array_intersect(wanted, F.split("line", " ")).alias("tokens"))


def global_order(docs: DataFrame, templates: tuple) -> list[str]:
    """All template tokens, rarest in the corpus first; brings back one row per token."""
    vocabulary = sorted({t for _, text in templates for t in _template_tokens(text)})
    counts = _blocks(docs, vocabulary).select(F.explode("tokens").alias("token")).groupBy("token").count()
    seen = {r["token"]: r["count"] for r in counts.collect()}
    return sorted(vocabulary, key=lambda t: (seen.get(t, 0), t))


def template_hits(docs: DataFrame, templates: tuple = TEMPLATES) -> DataFrame:
    """(_key, label, containment): every line that holds enough of a template."""
    spark = docs.sparkSession
    order = global_order(docs, templates)
    rank = {t: i for i, t in enumerate(order)}
    index = []
    for label, text in templates:
        tokens = sorted(_template_tokens(text), key=rank.__getitem__)
        need = _required(len(tokens))
        index += [(t, label, tokens, i, need) for i, t in enumerate(tokens[: len(tokens) - need + 1])]
    side = spark.createDataFrame(index, "token string, label string, template array<string>, at int, need int")
    if len(index) <= BROADCAST_ROWS:
        side = F.broadcast(side)
    prefix = F.array(*[F.lit(t) for t in sorted({row[0] for row in index}, key=rank.__getitem__)])
    shortest = min(row[4] for row in index)
    blocks = _blocks(docs, order).where((F.size("tokens") >= shortest) & F.arrays_overlap("tokens", prefix))
    probes = blocks.select("_key", "tokens", F.posexplode_outer("tokens").alias("place", "token"))
    left = F.least(F.size("template") - F.col("at"), F.size("tokens") - F.col("place"))
    common = F.array_intersect("template", "tokens")
    return (
        probes.join(side, "token")
        .where((F.size("tokens") >= F.col("need")) & (left >= F.col("need")))
        .where((F.element_at(common, 1) == F.col("token")) & (F.size(common) >= F.col("need")))
        .select("_key", "label", (F.size(common).cast("double") / F.size("template")).alias("containment"))
    )


def _places(phrase: str) -> tuple[Column, Column, Column]:
    """Count, first and last start of a phrase in ``_words``, a text padded with blanks."""
    parts = F.split("_words", f"(?<= ){phrase}(?= )")
    blanks = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))
    count = F.size(parts) - 1
    after = blanks(F.element_at(parts, -1)) - 1
    first = blanks(F.element_at(parts, 1)) - 1
    last = F.col("n_words") - after - len(phrase.split())
    found = F.col("_words").contains(f" {phrase} ")
    return (
        F.when(found, count).otherwise(F.lit(0)).cast("bigint"),
        F.when(found & (count > 0), first).cast("bigint"),
        F.when(found & (count > 0), last).cast("bigint"),
    )


def scan_licenses(docs: DataFrame, templates: tuple = TEMPLATES) -> DataFrame:
    """One row per document: phrase places, labels and the largest containment."""
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("_key"), folded(F.col("text")).alias("_folded"))
    words = F.trim(F.regexp_replace("_folded", "[ \\n]+", " "))
    counted = rows.select("doc_id", "_key", words.alias("_bare")).select(
        "doc_id", "_key",
        F.concat(F.lit(" "), "_bare", F.lit(" ")).alias("_words"),
        F.when(F.col("_bare") == "", 0)
        .otherwise(F.length("_bare") - F.length(F.replace("_bare", F.lit(" "), F.lit(""))) + 1)
        .cast("bigint").alias("n_words"),
    )
    places = [_places(p) for p, _ in PHRASES]
    base = counted.select(
        "doc_id", "_key", "n_words",
        sum((n for n, _, _ in places[1:]), places[0][0]).alias("n_base"),
        F.least(*[f for _, f, _ in places]).alias("first_word"),
        F.greatest(*[e for _, _, e in places]).alias("last_word"),
        F.array_compact(F.array(*[F.when(n > 0, label) for (n, _, _), (_, label) in zip(places, PHRASES)])).alias("_base"),
    )
    hits = (
        template_hits(rows, templates)
        .groupBy("_key")
        .agg(F.collect_set("label").alias("_found"), F.max("containment").alias("_score"))
    )
    joined = base.join(hits, "_key", "left")
    both = F.array_union("_base", F.coalesce("_found", F.array().cast("array<string>")))
    by_base = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.sort_array("_base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(both), ",").alias("labels"),
        F.greatest(by_base, F.coalesce("_score", F.lit(0.0))).alias("score"),
    )


_LISTS = " UNION ALL ".join(
    f"SELECT '{label}' AS label, {_template_tokens(text)!r} AS tokens, {_required(len(_template_tokens(text)))} AS need"
    for label, text in TEMPLATES
)
_BASE = " UNION ALL ".join(
    f"SELECT r, i - 1 AS i, '{label}' AS label FROM p WHERE "
    + " AND ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(phrase.split()))
    for phrase, label in PHRASES
)
_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM d),
p AS (SELECT r, words, unnest(range(1, len(words) + 1)) AS i FROM w WHERE list_contains(words, 'license')),
b AS ({_BASE}),
bb AS (SELECT r, count(*) AS n, min(i) AS lo, max(i) AS hi, list(DISTINCT label) AS labels FROM b GROUP BY r),
t AS ({_LISTS}),
l AS (SELECT r, list_distinct(regexp_extract_all(lower(line), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS words
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)),
m AS (SELECT r, label, len(list_intersect(words, tokens)) AS n, len(tokens) AS size FROM l, t
  WHERE len(words) >= need AND len(list_intersect(words, tokens)) >= need),
mm AS (SELECT r, list(DISTINCT label) AS labels, max(n::DOUBLE / size) AS score FROM m GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(bb.n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(bb.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(bb.labels, []), coalesce(mm.labels, [])))), ','), '') AS labels,
  greatest(CASE WHEN bb.n > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, coalesce(mm.score, 0.0::DOUBLE)) AS score
FROM d JOIN w USING (r) LEFT JOIN bb USING (r) LEFT JOIN mm USING (r)
"""


@query("op7_license_scan", _SQL)
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
