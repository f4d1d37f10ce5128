"""Transaction files and partitioned tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.schema import CSV_SCHEMA


#: Column with the text of a row that could not be read.
MALFORMED = "_malformed"


class MissingInputError(FileNotFoundError):
    """The input path does not exist."""


def read_transactions_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = CSV_SCHEMA,
) -> DataFrame:
    """CSV with header; malformed rows are dropped. ``schema=None`` infers types.

    A row only counts as malformed in the columns a query reads. So the result
    carries a filter that reads all of them; else counts would depend on the query.
    """
    reader = spark.read.option("header", True).option("mode", "DROPMALFORMED")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    try:
        df = reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingInputError(path) from error
        raise
    return df.filter(F.hash(*df.columns) >= -(2**31))


def read_transactions_with_errors(
    spark: SparkSession, path: str, schema: T.StructType = CSV_SCHEMA
) -> DataFrame:
    """CSV with header, malformed rows kept: their line is in ``MALFORMED``, null elsewhere."""
    with_line = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").schema(with_line)
    try:
        return reader.option("columnNameOfCorruptRecord", MALFORMED).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingInputError(path) from error
        raise


def write_partitioned(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = ("type",),
) -> None:
    """Write a table partitioned by column values.

    Tasks write their own rows: repartitioning by type alone would leave one
    task per type. ``fmt`` may be ``delta`` where its package is installed.
    """
    writer = df.write.format(fmt).mode(mode).partitionBy(*partition_by)
    if fmt == "delta" and mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)


def load_features(
    spark: SparkSession, path: str, csv_path: str, fmt: str = "parquet"
) -> DataFrame:
    """The feature table, or the raw CSV when there is none."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return read_transactions_csv(spark, csv_path)
