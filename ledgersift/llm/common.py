"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

import ledgersift.llm as package
from ledgersift.session import work_path

# Functions sent to executors travel by value, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(package)

#: Text of one call of a ``map_texts`` function, but for a single longer text.
SLICE_BYTES = 8 << 20

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its check."""

    def keep(build):
        QUERIES[name] = build
        if sql:
            CHECKS[name] = sql
        return build

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Work tables and sent values of the innermost ``releasing`` block.
_IN_USE: list[list] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read again: cuts lineage, survives executors."""
    spark, path = df.sparkSession, work_path(df.sparkSession, name)
    df.write.parquet(path)
    if _IN_USE:
        _IN_USE[-1].append(path)
    free_finished_shuffles(spark)
    table = spark.read.schema(df.schema).parquet(path)
    table.work_path = path
    return table


def free_finished_shuffles(spark: SparkSession) -> None:
    """Spark removes the shuffle files of finished steps once the driver has collected garbage."""
    gc.collect()
    spark._jvm.java.lang.System.gc()


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Delete work tables made by ``written`` that nothing reads any more."""
    for df in tables:
        _delete(df.sparkSession, df.work_path)


@contextmanager
def releasing(spark: SparkSession):
    """Delete the work tables written inside the block, and destroy what it shared, when it ends."""
    _IN_USE.append([])
    try:
        yield
    finally:
        for used in _IN_USE.pop():
            if isinstance(used, str):
                _delete(spark, used)
            else:
                used.destroy()


class Shared:
    """A value sent to all executors once; calling this gives it back there.

    Serialized by value like the functions, so executors need not have the library.
    """

    def __init__(self, spark: SparkSession, value):
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self.held: list = []
        self.destroyed = False

    def __call__(self):
        if not self.held:
            self.held.append(cloudpickle.loads(self.sent.value))
        return self.held[0]

    def destroy(self) -> None:
        """Free it everywhere; nothing that uses it may run afterwards."""
        if not self.destroyed:
            self.destroyed = True
            self.sent.destroy()


def share(spark: SparkSession, value) -> Shared:
    """``value`` for all executors; the innermost ``releasing`` block destroys it."""
    sent = Shared(spark, value)
    if _IN_USE:
        _IN_USE[-1].append(sent)
    return sent


def kept_by_worker() -> dict:
    """A dictionary that stays with a Python worker from task to task.

    Functions arrive by value, each task with globals of its own, so those keep nothing.
    """
    module = sys.modules.setdefault("_ledgersift_worker", types.ModuleType("_ledgersift_worker"))
    return module.__dict__.setdefault("kept", {})


def give_back_memory() -> None:
    """Return freed memory to the system: workers wait idle while later stages need it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, made longer until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def _sizes_of(values: pa.Array) -> list[int]:
    lengths = pc.binary_length(values) if pa.types.is_string(values.type) else pc.list_value_length(values)
    return lengths.fill_null(0).to_pylist()


def map_texts(
    df: DataFrame,
    keep: list[str],
    compute: Callable[[list], dict],
    added: str,
    text_col: str = "text",
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Columns computed from the texts of an Arrow batch, beside the columns ``keep`` unchanged.

    ``compute`` gets the texts of some rows (None for null) and returns a list or array for
    each column of the schema string ``added``. Rows are handed on in slices of bounded
    text, so one batch of long texts does not multiply in memory.
    """
    spark = df.sparkSession
    fields = spark.createDataFrame([], added).schema
    wanted = list(dict.fromkeys([*keep, text_col]))
    plain = {c: f"c{i}" for i, c in enumerate(wanted)}  # names may hold dots
    kept = [T.StructField(plain[c], df.schema[c].dataType) for c in keep]
    schema = T.StructType(kept + [T.StructField(f"n{i}", f.dataType) for i, f in enumerate(fields)])
    kinds = to_arrow_schema(fields)
    names = schema.names
    kept_names, text_name = [plain[c] for c in keep], plain[text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = _sizes_of(batch.column(text_name))
            at = 0
            while at < batch.num_rows:
                end, size = at, 0
                while end < batch.num_rows and (size < slice_bytes or end == at):
                    size += sizes[end]
                    end += 1
                part = batch.slice(at, end - at)
                new = compute(part.column(text_name).to_pylist())
                columns = [part.column(c) for c in kept_names] + [pa.array(new[f.name], type=f.type) for f in kinds]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                at = end
        give_back_memory()

    rows = df.select(*[F.col(f"`{c}`").alias(plain[c]) for c in wanted])
    return rows.mapInArrow(run, schema).toDF(*keep, *fields.names)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def space_words(text: Column) -> Column:
    """The runs of anything but space and U+0009 to U+000D."""
    blanks = F.translate(text, "\t\n\x0b\f\r", "     ")
    return F.array_remove(F.split(blanks, " "), "")


def crc32_of_id(doc_id: Column) -> Column:
    """crc32 of the id written as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def row_key(doc_id: Column, text: Column) -> Column:
    """16 bytes that tell rows apart even where ids repeat; rows equal in both share it."""
    named = F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit("")))
    # never null, and said to be so: else joins test it first and hash every text once more
    return F.coalesce(F.unhex(F.md5(named.cast("binary"))), F.lit(b""))


def running_starts(lengths: Column, block: int = 256) -> Column:
    """Sum of all earlier elements, for each element of an array of whole numbers.

    Works block by block, so an array of n costs about n * block steps, not n * n.
    """
    total = lambda values: F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def starts(values: Column, first: Column) -> Column:
        empty = F.struct(F.array().cast("array<bigint>").alias("starts"), first.cast("bigint").alias("at"))
        grow = lambda a, x: F.struct(F.concat(a["starts"], F.array(a["at"])).alias("starts"), (a["at"] + x).alias("at"))
        return F.aggregate(values, empty, grow)["starts"]

    count = F.size(lengths)
    numbers = F.when(count > 0, F.sequence(F.lit(0), F.floor((count - 1) / block).cast("int")))
    blocks = F.transform(
        F.coalesce(numbers, F.array().cast("array<int>")),
        lambda b: F.slice(lengths, b * block + 1, F.lit(block)),
    )
    firsts = starts(F.transform(blocks, total), F.lit(0))
    return F.flatten(F.zip_with(blocks, firsts, starts))
