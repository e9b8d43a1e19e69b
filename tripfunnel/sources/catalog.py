"""Logical table names resolved to physical tables per environment."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tripfunnel.session import scratch_path


@dataclass
class Catalog:
    """Maps ``layer.table`` names to paths below a root, or to metastore tables.

    ``overrides`` holds names that do not follow the pattern. A value that
    contains a slash or a scheme is read as Parquet, any other as a table.
    """

    spark: SparkSession
    root: str
    overrides: dict[str, str] = field(default_factory=dict)

    def resolve(self, name: str) -> str:
        return self.overrides.get(name, f"{self.root.rstrip('/')}/{name.replace('.', '/')}")

    def read(self, name: str) -> DataFrame:
        target = self.resolve(name)
        return self.spark.read.parquet(target) if "/" in target else self.spark.table(target)

    def exists(self, name: str) -> bool:
        try:
            self.read(name)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "TABLE_OR_VIEW_NOT_FOUND"):
                return False
            raise
        return True

    def read_or_empty(self, name: str, schema: str) -> DataFrame:
        return self.read(name) if self.exists(name) else self.spark.createDataFrame([], schema)

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        """The rows meant for a table, computed once and stored in the shared scratch folder."""
        path = scratch_path(self.spark, name.replace(".", "-"))
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def replace(self, df: DataFrame, name: str) -> DataFrame:
        """Full refresh from rows that may come from the table itself: they are stored first."""
        return self.materialize(self.staged(df, name), name)

    def append(self, df: DataFrame, name: str) -> None:
        """More rows for a table; what it has stays as it is."""
        target = self.resolve(name)
        if "/" in target:
            df.write.mode("append").parquet(target)
        else:
            df.write.mode("append").saveAsTable(target)

    def materialize(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Full refresh of a model; returns the stored table."""
        writer = df.write.mode("overwrite").partitionBy(*partition_by)
        target = self.resolve(name)
        if "/" in target:
            writer.parquet(target)
        else:
            writer.saveAsTable(target)
        return self.read(name)

    def register_view(self, df: DataFrame, name: str) -> DataFrame:
        """A lazy model: a temporary view under the flat name."""
        df.createOrReplaceTempView(name.replace(".", "_"))
        return df
