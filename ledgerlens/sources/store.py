"""Parquet store for the tables jobs hand to each other, and for fitted parameters."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class TableStore:
    """Named Parquet tables under one root.  A job never overwrites a table it reads."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def write(self, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        writer = df.write.mode("overwrite")
        if partition_by:
            # One shuffle on the partition column keeps the file count at partitions, not tasks × partitions;
            # adaptive execution splits an oversized partition and joins small ones.
            writer = df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by)
        writer.parquet(self.path(name))
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def write_params(self, name: str, params) -> None:
        """A fitted parameter dataclass as a one-row table."""
        values = asdict(params)
        row = self.spark.createDataFrame([tuple(values.values())], list(values))
        row.coalesce(1).write.mode("overwrite").parquet(self.path(name))

    def read_params(self, name: str, kind):
        return kind(**self.read(name).first().asDict())

    def write_model(self, name: str, model) -> None:
        model.write().overwrite().save(self.path(name))

    def read_model(self, name: str, kind):
        return kind.load(self.path(name))
