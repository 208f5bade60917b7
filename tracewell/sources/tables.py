"""Reading tables, literal rows, and table stores on a parquet folder."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Lazy access to the parquet tables of one directory: ``t.orders``."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        table = self.__dict__[name] = self.spark.read.parquet(self.path(name))  # read the footer once
        return table

    def path(self, name: str) -> str:
        return f"{self.directory}/{name}.parquet"


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread rows over all cores when a scan has fewer splits than that.

    For CPU-heavy work per row on small inputs, such as one file with a single
    row group. Large inputs have splits enough and are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """Typed seed rows, as ``INSERT ... VALUES`` into a declared table would give."""
    return spark.createDataFrame(list(rows), schema)


class TableStore:
    """Named parquet tables under one folder.

    ``replace`` overwrites, ``create_if_missing`` keeps existing rows and
    ``append`` adds rows; views are lazy DataFrames over those tables.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        try:
            self.spark.read.parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return False
        return True

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def replace(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(name))
        return self.read(name)

    def create_if_missing(self, name: str, source: str | DataFrame) -> DataFrame:
        """``source`` is a DDL schema for an empty table, or rows to start from."""
        if not self.exists(name):
            df = self.spark.createDataFrame([], source) if isinstance(source, str) else source
            self.replace(name, df)
        return self.read(name)

    def append(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("append").parquet(self.path(name))
        return self.read(name)

    def view(self, name: str, df: DataFrame) -> DataFrame:
        df.createOrReplaceTempView(name)
        return self.spark.table(name)
