"""Named relations: Parquet table folders, temp views, inline rows, database tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakeloom.schemas import TABLES


class Tables:
    """Lazy access to ``<root>/<name>.parquet`` as ``tables.<name>``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        reader = self.spark.read
        if name in TABLES:
            reader = reader.schema(TABLES[name])
        return reader.parquet(self.path(name))


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` under ``name`` and read it back by that name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def inline_rows(spark: SparkSession, rows: Iterable[Sequence], schema: StructType | str) -> DataFrame:
    """A frame from literal rows with a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def stored_table(spark: SparkSession, name: str, url: str | None = None, **options: str) -> DataFrame:
    """A catalog table, or a table of the database behind ``url``.

    For a large database table pass ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions``, or one task reads all of it.
    """
    if url is None:
        return spark.table(name)
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()
