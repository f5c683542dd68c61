"""Stored query tables in ranges of their key: lookups and merges touch few files.

The rows, unique by partition key and clustering columns (the last write wins), lie in one
folder for each range of that key. The keys at which ranges begin are fixed when the table
is created and kept beside it. A lookup reads the folders whose ranges can hold the key,
and in them the row groups that statistics and Bloom filters do not rule out. A merge
reads and replaces only the folders that its batch falls into, so its cost follows the
batch. A partition key with very many rows spans ranges.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.operators.dedup import last_write_wins
from lakeloom.operators.layout import estimated_bytes
from lakeloom.sinks.files import write_parquet
from lakeloom.sinks.folders import finish_replacement, replace_folders

RANGE, BEGINS = "key_range", "_begins"
#: Bytes of a range by Catalyst's estimate, and ranges of a table at most: their begins
#: travel with every merge. Beyond that ranges are larger.
RANGE_BYTES, MOST_RANGES = 256 << 20, 4096


@dataclass(frozen=True)
class RangedTable:
    path: str
    schema: StructType
    partition_key: tuple[str, ...]
    clustering: tuple[str, ...]
    written_by: tuple[str, ...]

    @property
    def primary(self) -> list[str]:
        return [*self.partition_key, *self.clustering]

    @property
    def _options(self) -> dict[str, str]:
        return {f"parquet.bloom.filter.enabled#{c}": "true" for c in self.partition_key}

    @classmethod
    def create(
        cls, rows: DataFrame, path: str, partition_key: Sequence[str], clustering: Sequence[str] = (), written_by: Sequence[str] = (), ranges: int | None = None
    ) -> "RangedTable":
        """Store ``rows``, the last write of each key. ``written_by`` are columns that tell
        which of two rows was written later; where they leave a tie the greater row counts."""
        table = cls(path.rstrip("/"), rows.schema, tuple(partition_key), tuple(clustering), tuple(written_by))
        ranges = ranges or min(MOST_RANGES, 1 + estimated_bytes(rows) // RANGE_BYTES)
        order = [F.asc_nulls_first(c) for c in table.primary]
        unique = last_write_wins(rows, table.primary, written_by)
        placed = unique.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn(RANGE, F.spark_partition_id())
        placed.write.options(**table._options).partitionBy(RANGE).parquet(table.path)
        begins = table._read(rows.sparkSession).groupBy(RANGE).agg(F.min(F.struct(*table.primary)).alias("begin"))
        write_parquet(begins.coalesce(1), f"{table.path}/{BEGINS}")
        return table

    def _read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(StructType([*self.schema.fields]).add(RANGE, "integer")).parquet(self.path)

    def rows(self, spark: SparkSession) -> DataFrame:
        return self._read(spark).select(*self.schema.fieldNames())

    def _begins(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{BEGINS}")

    def _range_of(self, spark: SparkSession) -> Column:
        """The range a row's key falls into. Begins are searched in two steps, groups first,
        so a row is compared with about twice the root of their number."""
        # At most MOST_RANGES rows.
        found = sorted((r[RANGE], r["begin"]) for r in self._begins(spark).collect())
        if not found:
            return F.lit(0)
        types = {c: self.schema[c].dataType for c in self.primary}
        begins = [F.struct(F.lit(n).alias("n"), F.struct(*[F.lit(b[c]).cast(t).alias(c) for c, t in types.items()]).alias("b")) for n, b in found]
        size = max(1, int(len(begins) ** 0.5))
        groups = F.array(*[F.array(*begins[i : i + size]) for i in range(0, len(begins), size)])
        key = F.struct(*self.primary)
        group = F.greatest(F.size(F.filter(groups, lambda g: g[0]["b"] <= key)) - 1, F.lit(0))
        before = F.filter(F.get(groups, group), lambda b: b["b"] <= key)
        return F.when(F.size(before) > 0, F.get(before, F.size(before) - 1)["n"]).otherwise(F.lit(found[0][0]))

    def merge(self, batch: DataFrame) -> list[int]:
        """Bring in a batch; returns the ranges that were rewritten. The same batch again
        changes nothing, and a merge that was cut short is finished, or undone, by the next."""
        spark = batch.sparkSession
        finish_replacement(spark, self.path)
        names = self.schema.fieldNames()
        placed = batch.select(*names).withColumn(RANGE, self._range_of(spark))
        # At most MOST_RANGES values.
        touched = sorted(r[0] for r in placed.select(RANGE).distinct().collect())
        if touched:
            old = self._read(spark).where(F.col(RANGE).isin(touched))
            merged = last_write_wins(old.unionByName(placed), [*self.primary, RANGE], self.written_by)
            replace_folders(merged, self.path, RANGE, sort_by=self.primary, options=self._options)
        return touched

    def where(self, spark: SparkSession, **values) -> DataFrame:
        """Rows of one partition key, further cut by a prefix of the clustering columns, in
        clustering order."""
        extra = [c for c in values if c not in self.partition_key]
        if not set(self.partition_key) <= set(values) or set(extra) != set(self.clustering[: len(extra)]):
            raise ValueError(f"filter on {sorted(values)} does not fix key {self.partition_key} and a prefix of {self.clustering}")
        prefix = [*self.partition_key, *self.clustering[: len(extra)]]
        wanted = F.struct(*[F.lit(values[c]).cast(self.schema[c].dataType).alias(c) for c in prefix])
        begins = self._begins(spark).select(RANGE, F.struct(*[F.col("begin")[c].alias(c) for c in prefix]).alias("b"), wanted.alias("w"))
        # The last range that begins before the key, and those that begin with it.
        picked = begins.where("b < w").agg(F.max(RANGE)).first()[0]
        ranges = [r[0] for r in begins.where("b = w").select(RANGE).collect()] + ([] if picked is None else [picked])
        found = self._read(spark).where(F.col(RANGE).isin(ranges))
        for c in prefix:
            found = found.where(F.col(c) == F.lit(values[c]))
        return found.select(*self.schema.fieldNames()).orderBy(*self.clustering)
