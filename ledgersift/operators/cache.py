"""Keyed feature cache as a table: newest row per key with an expiry time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgersift.operators.analytics import ratio, rows
from ledgersift.operators.skew import HOT_ROWS, left_join_lookup

# Seconds an entry stays valid.
TTL_SECONDS = {"transaction": 3600, "account": 1800, "risk": 300}


def latest_features(
    df: DataFrame,
    entity: str,
    kind: str = "account",
    time: str = "ts",
    tie: str = "tx_id",
    ttl: int | None = None,
) -> DataFrame:
    """Newest row per entity as a cache entry ``kind:entity``.

    The newest row is a maximum over (time, tie), so rows combine before the shuffle.
    """
    payload = [c for c in df.columns if c not in (entity, time, tie)]
    newest = df.groupBy(entity).agg(F.max(F.struct(time, tie, *payload)).alias("r"))
    seconds = TTL_SECONDS[kind] if ttl is None else ttl
    return newest.select(
        F.concat(F.lit(f"{kind}:"), F.col(entity).cast("string")).alias("cache_key"),
        *[F.col(f"r.{c}").alias(c) for c in (tie, *payload)],
        F.col(f"r.{time}").alias("cached_at"),
        (F.col(f"r.{time}") + F.expr(f"INTERVAL {int(seconds)} SECOND")).alias("expires_at"),
    )


def cache_lookup(
    requests: DataFrame,
    cache: DataFrame,
    request_id: str = "tx_id",
    features: tuple[str, ...] = ("amount", "type"),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Look up ``cache_key`` at ``request_ts``; on a miss keep the request's own features.

    An entry serves from the moment it was cached until it expires.
    """
    entries = cache.select("cache_key", "cached_at", "expires_at", F.struct(*features).alias("_cached"))
    joined = left_join_lookup(requests, entries, "cache_key", request_id, hot_rows=hot_rows)
    valid = (F.col("cached_at") <= F.col("request_ts")) & (F.col("expires_at") > F.col("request_ts"))
    hit = F.coalesce(valid, F.lit(False))
    merged = {c: F.when(F.col("cache_hit"), F.col("_cached")[c]).otherwise(F.col(c)) for c in features}
    return (
        joined.withColumn("cache_hit", hit).withColumns(merged).drop("_cached", "cached_at", "expires_at")
    )


def cache_hit_stats(lookups: DataFrame) -> DataFrame:
    hit = F.col("cache_hit")
    counted = lookups.agg(
        F.count_if(hit).alias("hits"),
        F.count_if(~hit).alias("misses"),
        rows().alias("total_requests"),
    )
    return counted.withColumn(
        "hit_rate_percent", ratio(F.col("hits"), F.col("total_requests"), 100.0)
    )


def glob_to_regex(pattern: str) -> str:
    """Key pattern with ``*``, ``?`` and ``[...]`` as an anchored regular expression.

    A backslash makes the next character plain; a bracket that is never closed is plain too.
    """
    out, at = "", 0
    plain = lambda ch: "\\" + ch if not ch.isalnum() and ch.isascii() else ch
    while at < len(pattern):
        ch, at = pattern[at], at + 1
        if ch == "\\" and at < len(pattern):
            out, at = out + plain(pattern[at]), at + 1
        elif ch == "[" and (end := pattern.find("]", at + 1)) > 0:
            negated = pattern[at] in "^!"
            members = pattern[at + negated : end]
            out += "[" + "^" * negated + "".join(c if c == "-" else plain(c) for c in members) + "]"
            at = end + 1
        elif ch in "*?":
            out += ".*" if ch == "*" else "."
        else:
            out += plain(ch)
    return f"^(?s:{out})$"


def cache_invalidate(cache: DataFrame, pattern: str) -> DataFrame:
    """Entries that survive removing every key matching the pattern (``*`` flushes)."""
    return cache.filter(~F.col("cache_key").rlike(glob_to_regex(pattern)))


def invalidated_count(cache: DataFrame, pattern: str) -> DataFrame:
    matched = F.col("cache_key").rlike(glob_to_regex(pattern))
    return cache.agg(F.count_if(matched).alias("deleted"), F.count_if(~matched).alias("kept"))


def account_risk_history(scored: DataFrame, limit: int = 10) -> DataFrame:
    """Newest scored transactions per account.

    The rank filter runs per task before the shuffle, so an account of any size
    sends at most ``limit`` rows per task.
    """
    newest = Window.partitionBy("nameOrig").orderBy(F.desc("step"), F.desc("tx_id"))
    ranked = scored.withColumn("recency", F.row_number().over(newest))
    return ranked.filter(F.col("recency") <= limit).select(
        "nameOrig", "recency", "tx_id", "step", "fraud_probability", "risk_level"
    )
