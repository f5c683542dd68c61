"""Catalog tables: create, drop, load, insert-select, bucketed layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakeloom.operators.quality import has_rows


def create_tables(spark: SparkSession, schemas: Mapping[str, StructType], folder: str | None = None) -> None:
    """Create every table empty with its declared schema, replacing what is there."""
    for name, schema in schemas.items():
        writer = spark.createDataFrame([], schema).write.mode("overwrite").format("parquet")
        if folder:
            writer = writer.option("path", f"{folder.rstrip('/')}/{name}")
        writer.saveAsTable(name)


def drop_tables(spark: SparkSession, names: Sequence[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def clear_table(spark: SparkSession, name: str) -> None:
    """Remove all rows. Overwriting with none also works for tables with a path of
    their own, which TRUNCATE TABLE refuses."""
    spark.createDataFrame([], spark.table(name).schema).write.insertInto(name, overwrite=True)


def _in_target_order(df: DataFrame, table: str) -> DataFrame:
    """``insertInto`` goes by position; put columns in the order of the table."""
    target = df.sparkSession.table(table).schema
    missing = [f.name for f in target.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{table}: no column for {missing}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in target.fields])


def load_dimension(df: DataFrame, table: str, append: bool = False) -> None:
    """Replace the rows of a dimension, or add to them."""
    _in_target_order(df, table).write.insertInto(table, overwrite=not append)


def load_fact(df: DataFrame, table: str) -> None:
    """Add rows to a fact table."""
    _in_target_order(df, table).write.insertInto(table, overwrite=False)


def insert_select(df: DataFrame, table: str) -> None:
    """Add the rows of any query to a table, matched by column name."""
    load_fact(df, table)


def stage_table(df: DataFrame, table: str) -> None:
    """Clear a staging table and load it again."""
    load_dimension(df, table, append=False)


def create_and_load(df: DataFrame, table: str, schema: StructType, folder: str | None = None) -> DataFrame:
    """Create a table, load it, and return the report of whether it has rows."""
    spark = df.sparkSession
    create_tables(spark, {table: schema}, folder)
    stage_table(df, table)
    return has_rows({table: spark.table(table)})


def write_bucketed(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    buckets: int,
    sort_by: Sequence[str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Store ``df`` hashed into ``buckets`` by ``keys`` and read it back.

    Two tables with the same buckets and keys join, and aggregate by those keys,
    without a shuffle. One bucket is read by one task, so a fact in which one key
    holds a large share of the rows has to be pre-aggregated by that key first (see
    ``operators.layout.hot_keys``).
    """
    spread = df.repartition(buckets, *keys)
    writer = spread.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*(sort_by or keys))
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)
