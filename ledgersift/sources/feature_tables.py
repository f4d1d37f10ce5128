"""Versioned feature tables below one root folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METADATA_SCHEMA = (
    "name string, feature_type string, description string, created_at timestamp, version int"
)


class FeatureTables:
    """Tables at ``<root>/<name>/version=N`` and one metadata row per version.

    The metadata row is appended after the data is written, so a version that
    shows up is complete.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def _data_path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/version={version}"

    def metadata(self) -> DataFrame:
        path = f"{self.root}/_feature_metadata"
        try:
            return self.spark.read.schema(METADATA_SCHEMA).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], METADATA_SCHEMA)

    def versions(self, name: str) -> DataFrame:
        """Current version of one table as a row; 0 when it is unknown."""
        mine = self.metadata().filter(F.col("name") == name)
        return mine.agg(
            F.lit(name).alias("name"), F.coalesce(F.max("version"), F.lit(0)).alias("version")
        )

    def version(self, name: str) -> int:
        return self.versions(name).first().version

    def create(
        self,
        df: DataFrame,
        name: str,
        partition_by: tuple[str, ...] = ("type",),
        feature_type: str = "table",
        description: str = "",
    ) -> int:
        version = self.version(name) + 1
        usable = [c for c in partition_by if c in df.columns]
        writer = df.write.format(self.fmt).mode("overwrite").partitionBy(*usable)
        writer.save(self._data_path(name, version))
        row = self.spark.range(1).select(
            F.lit(name).alias("name"),
            F.lit(feature_type).alias("feature_type"),
            F.lit(description).alias("description"),
            F.current_timestamp().alias("created_at"),
            F.lit(version).alias("version"),
        )
        row.write.mode("append").parquet(f"{self.root}/_feature_metadata")
        return version

    def load(self, name: str, version: int | None = None) -> DataFrame:
        chosen = version or self.version(name)
        if not chosen:
            raise KeyError(f"no feature table named {name}")
        return self.spark.read.format(self.fmt).load(self._data_path(name, chosen))
