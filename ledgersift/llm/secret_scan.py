"""Secret scan: fixed patterns, and a battery of randomness tests over long tokens.

All of it is one projection per row: patterns by ``split`` and ``regexp_extract_all``
(their pieces interleave, so sums of lengths give places), tests by array functions over
the few tokens that qualify. Nothing is shuffled.

A token of 20 characters or more is read in the encoding its letters suggest (hex,
base32, base36, base64). Three tests ask whether its symbols could be random: chi-squared
uniformity over equal parts of the alphabet, runs above and below its middle, and the
correlation of neighbours. Fisher's method combines them. The tokens of a text are one
family: the Benjamini-Hochberg rule, each p-value weighted by the token's share of length
(long tokens carry more evidence), rejects randomness at rate ``FALSE_RATE``; tokens it
cannot reject are reported as kind ``random``. They may overlap spans of the patterns.

Defined results: a null text counts as empty, and an empty text has no spans (empty
strings, and the hash of the empty string); spans that start together come in the order
of kinds; repeated rows are scanned alike; an empty table gives an empty result; other
columns are ignored. Texts of any length are searched whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersift.llm.common import query, running_starts, table

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # as AKIA[A-Z0-9]+ of 20 characters: a shorter run holds no longer one
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
FALSE_RATE = 0.05

#: (encoding, what its tokens look like, alphabet, sizes of the parts for the chi-squared test)
ENCODINGS = (
    ("hex", r"^(?=[^0-9]*[0-9])(?=[^a-f]*[a-f])[0-9a-f]+$", "0123456789abcdef", (2,) * 8),
    ("base32", r"^(?=[^2-7]*[2-7])(?=[^A-Z]*[A-Z])[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", (13, 13, 6)),
    ("base36", r"^(?=[^0-9]*[0-9])(?=[^a-z]*[a-z])[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz", (10, 13, 13)),
    (
        "base64", r"^(?=[^0-9]*[0-9])(?=[^A-Z]*[A-Z])(?=[^a-z]*[a-z])[A-Za-z0-9+/_-]+$",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", (26, 26, 12),
    ),
)
MOST_PARTS = max(len(parts) for _, _, _, parts in ENCODINGS)


def _found(text: Column, pattern: str) -> tuple[Column, Column]:
    """Matches and, between them, the gaps."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def _spans(found: str, gaps: str, rank: int) -> Column:
    """Structs (start, rank, end, part) of the matches in column ``found``."""
    lengths = F.transform(F.col(found), lambda m: F.length(m))
    leads = F.transform(F.slice(F.col(gaps), 1, F.size(found)), lambda g: F.length(g))
    before = running_starts(F.zip_with(leads, lengths, lambda g, m: g + m))
    starts = F.zip_with(before, leads, lambda b, g: b + g)
    return F.zip_with(
        starts, F.col(found),
        lambda s, m: F.struct(s.alias("start"), F.lit(rank).alias("rank"), (s + F.length(m)).alias("end"), m.alias("part")),
    )


def _named(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _above(z: Column) -> Column:
    """Upper tail of the normal distribution, by a logistic form (error below 2e-4)."""
    bound = lambda x: F.greatest(F.lit(-30.0), F.least(F.lit(30.0), x * (1.5976 + 0.07056 * x * x)))
    return _named(z, lambda x: 1.0 / (1.0 + F.exp(bound(x))))


def _chi_tail(x: Column, df: Column) -> Column:
    """Upper tail of chi-squared, by the cube-root form."""
    spread = F.lit(2.0) / (9.0 * df)
    return _above((F.pow(x / df, F.lit(1.0 / 3.0)) - (1.0 - spread)) / F.sqrt(spread))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _values(token: Column) -> Column:
    """Struct of the token's symbols as numbers, the alphabet's size, the part of each number
    and the parts' shares; null without encoding."""
    plain = F.translate(token, "-_", "+/")
    choice = None

    def numbered(alphabet: str) -> Column:
        return F.transform(F.split(plain, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)

    for _, looks, alphabet, parts in ENCODINGS:
        numbers = numbered(alphabet)
        part_of = [k for k, width in enumerate(parts) for _ in range(width)]
        row = F.struct(
            F.filter(numbers, lambda v: v >= 0).alias("v"),
            F.lit(float(len(alphabet))).alias("size"),
            F.array(*map(F.lit, part_of)).alias("part_of"),
            F.array(*[F.lit(width / len(alphabet)) for width in parts]).alias("shares"),
        )
        choice = F.when(token.rlike(looks), row) if choice is None else choice.when(token.rlike(looks), row)
    return choice


def _summary(row: Column) -> Column:
    """One pass over the symbols: the sums and counts that the tests need."""
    size = row["size"]
    zero = lambda name: F.lit(0.0).alias(name)
    bins = [f"c{k}" for k in range(MOST_PARTS)]
    start = F.struct(*[zero(x) for x in ("n", "sum", "squares", "products", "first", "last", "high", "runs", *bins)])

    def step(a: Column, v: Column) -> Column:
        x = v.cast("double")
        begun, up = a["n"] > 0, (x * 2 >= size)
        turned = ~begun | (up != (a["last"] * 2 >= size))
        fields = {
            "n": a["n"] + 1, "sum": a["sum"] + x, "squares": a["squares"] + x * x,
            "products": a["products"] + F.when(begun, x * a["last"]).otherwise(0.0),
            "first": F.when(begun, a["first"]).otherwise(x), "last": x,
            "high": a["high"] + up.cast("double"), "runs": a["runs"] + turned.cast("double"),
        }
        fields |= {c: a[c] + (F.get(row["part_of"], v) == k).cast("double") for k, c in enumerate(bins)}
        return F.struct(*[value.alias(name) for name, value in fields.items()])

    return F.aggregate(row["v"], start, step, lambda a: F.struct(a.alias("s"), row["shares"].alias("shares")))


def _p_random(summary: Column) -> Column:
    """Fisher's combination of the three tests."""
    s, shares = summary["s"], summary["shares"]
    n = F.greatest(s["n"], F.lit(2.0))
    counts = F.array(*[s[f"c{k}"] for k in range(MOST_PARTS)])
    # the sum of (c - n * share)^2 / (n * share) over the encoding's parts
    parts = F.transform(shares, lambda share, k: F.get(counts, k) * F.get(counts, k) / (n * share))
    chi = F.greatest(_sum(parts) - n, F.lit(0.0))

    def runs(high: Column) -> Column:
        mean = 2.0 * high * (n - high) / n + 1.0
        return F.struct(mean.alias("mean"), ((mean - 1.0) * (mean - 2.0) / (n - 1.0)).alias("var"))

    z_runs = lambda r: (s["runs"] - r["mean"]) / F.sqrt(F.greatest(r["var"], F.lit(1e-9)))
    p_runs = _named(runs(s["high"]), lambda r: F.when(r["var"] > 0, 2.0 * _above(F.abs(z_runs(r)))).otherwise(F.lit(0.0)))

    def serial(mean: Column) -> Column:
        around = s["squares"] - n * mean * mean
        along = s["products"] - mean * (2.0 * s["sum"] - s["first"] - s["last"]) + (n - 1.0) * mean * mean
        return F.struct(around.alias("around"), along.alias("along"))

    z_serial = lambda r: r["along"] / F.greatest(r["around"], F.lit(1e-9)) * F.sqrt(n) + 1.0 / F.sqrt(n)
    p_serial = _named(
        _named(s["sum"] / n, serial),
        lambda r: F.when(r["around"] > 1e-9, 2.0 * _above(F.abs(z_serial(r)))).otherwise(F.lit(0.0)),
    )
    log = lambda p: F.ln(F.greatest(F.lit(1e-12), F.least(F.lit(1.0), p)))
    return _chi_tail(-2.0 * (log(_chi_tail(chi, F.size(shares) - 1.0)) + log(p_runs) + log(p_serial)), F.lit(6.0))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, and the spans of the patterns and of all kinds."""
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    columns = {}
    for kind, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("token", TOKEN)):
        found, gaps = _found(text, pattern)
        present = text.contains("AKIA") if kind == "access" else text.rlike(pattern)
        columns[f"{kind}_found"] = F.when(present, found).otherwise(none)
        columns[f"{kind}_gaps"] = F.when(present, gaps).otherwise(none)
        if kind == "assign":
            columns["values"] = F.when(present, F.regexp_extract_all(text, F.lit(pattern), F.lit(2))).otherwise(none)
    matched = rows.select("doc_id", *[c.alias(name) for name, c in columns.items()])
    assign = F.filter(
        F.zip_with(_spans("assign_found", "assign_gaps", 0), F.col("values"), lambda s, x: F.when(F.length(x) >= LEAST_VALUE, s)),
        lambda s: s.isNotNull(),
    )
    placed = matched.select(
        "doc_id",
        assign.alias("assign"),
        _spans("access_found", "access_gaps", 1).alias("access"),
        _spans("hex_found", "hex_gaps", 2).alias("hex"),
        _spans("token_found", "token_gaps", 3).alias("token"),
    )
    read = F.filter(
        F.transform("token", lambda s: F.struct(s.alias("span"), _values(s["part"]).alias("row"))), lambda t: t["row"].isNotNull()
    )
    tested = placed.withColumn("read", read).withColumn(
        "summed", F.transform("read", lambda t: F.struct(_summary(t["row"]).alias("row"), t["span"].alias("span")))
    ).withColumn(
        "tested", F.transform("summed", lambda t: F.struct(_p_random(t["row"]).alias("p"), t["span"].alias("span")))
    )
    mean_length = _sum(F.transform("tested", lambda t: F.length(t["span"]["part"]).cast("double"))) / F.size("tested")
    family = tested.withColumn("mean_length", F.when(F.size("tested") > 0, mean_length)).withColumn(
        "ordered",
        F.sort_array(F.transform("tested", lambda t: F.struct(
            (t["p"] * F.col("mean_length") / F.length(t["span"]["part"])).alias("p"), t["span"].alias("span")))),
    )
    count = F.size("ordered")
    passing = F.transform("ordered", lambda t, i: F.when(t["p"] <= FALSE_RATE * (i + 1) / count, i + 1).otherwise(0))
    rejected = family.withColumn("rejected", F.coalesce(F.array_max(passing), F.lit(0)))
    random = F.transform(
        F.slice("ordered", F.col("rejected") + 1, F.greatest(count - F.col("rejected"), F.lit(0))), lambda t: t["span"]
    )
    ranked = rejected.withColumn("random", random)
    bare = lambda spans: F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"]))
    base = F.sort_array(bare(F.concat("assign", "access", "hex")))
    every = F.sort_array(bare(F.concat("assign", "access", "hex", "random")))
    names = F.array(*[F.lit(k) for k in KINDS])

    def written_out(spans: Column) -> Column:
        one = lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))
        return F.array_join(F.transform(spans, one), ",")

    return ranked.select(
        "doc_id",
        F.size("assign").cast("bigint").alias("n_assign"),
        F.size("access").cast("bigint").alias("n_access"),
        F.size("hex").cast("bigint").alias("n_hex"),
        F.size("random").cast("bigint").alias("n_random"),
        written_out(base).alias("base_spans"),
        written_out(every).alias("spans"),
    )


@query("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans", "n_random",
    )
