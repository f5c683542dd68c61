"""Stored cubes that take new facts without reading the old ones.

Each group of each grouping set keeps a state that merges: an exact sum, a count, and a
sketch of distinct values. A refresh brings in the states of the new facts alone, so it costs
as much as they and the cube, not the facts before. The merged states are a version of
their own, published as a whole with the names of the deltas they hold; a delta that is
brought in again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.exact import from_units
from lakeloom.sinks.files import write_parquet, write_partitioned
from lakeloom.sinks.publish import new_release, publish, published
from lakeloom.sources.tables import inline_rows

#: Bits of the sketches' registers: 2^12 of them, a standard error of 1.04 / 2^6, 1.6 %.
SKETCH_BITS = 12
_STATES = ("_sum", "_count", "_distinct")


def all_subsets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    return [s for n in range(len(dimensions) + 1) for s in combinations(dimensions, n)]


@dataclass(frozen=True)
class RefreshedCube:
    """``sets`` of ``dimensions`` whose groups are kept (all subsets unless given). ``metric``
    is a whole number of ``10 ** -scale``; ``distinct`` a column whose values are counted by
    sketch, null ones left out."""

    path: str
    dimensions: tuple[str, ...]
    metric: Column
    distinct: str
    scale: int = 0
    sets: tuple[tuple[str, ...], ...] | None = None

    def _groupings(self) -> list[list[Column]]:
        return [[F.col(d) for d in s] for s in (self.sets if self.sets is not None else all_subsets(self.dimensions))]

    def states(self, facts: DataFrame) -> DataFrame:
        """States of some facts. They are folded to the finest groups before they are
        expanded to the grouping sets."""
        fine = facts.groupBy(*self.dimensions).agg(
            F.sum(self.metric).alias("_sum"), F.count(F.lit(1)).alias("_count"), F.hll_sketch_agg(self.distinct, SKETCH_BITS).alias("_distinct")
        )
        grouped = fine.groupingSets(self._groupings(), *[F.col(d) for d in self.dimensions])
        return self._merged(grouped, F.grouping_id().cast("long"))

    def _merged(self, grouped, grouping_id: Column) -> DataFrame:
        added = grouped.agg(
            F.sum("_sum").cast("decimal(38,0)").alias("_sum"), F.sum("_count").alias("_count"), F.hll_union_agg("_distinct").alias("_distinct"), grouping_id.alias("grouping_id")
        )
        return added.select("grouping_id", *self.dimensions, *_STATES)

    def merge(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """States of both. Null in a dimension is a value; the id tells it from a total."""
        both = old.unionByName(new).withColumnRenamed("grouping_id", "_gid")
        merged = both.groupBy("_gid", *self.dimensions).agg(
            F.sum("_sum").cast("decimal(38,0)").alias("_sum"), F.sum("_count").alias("_count"), F.hll_union_agg("_distinct").alias("_distinct")
        )
        return merged.select(F.col("_gid").alias("grouping_id"), *self.dimensions, *_STATES)

    def refresh(self, facts: DataFrame, delta: str) -> bool:
        """Bring in the facts named ``delta``; false if the cube has them already. What is
        published stays until the new version is written."""
        spark = facts.sparkSession
        states = self.states(facts)
        known: list[str] = []
        current = published(spark, self.path)
        if current is not None:
            # One row for each delta.
            known = [r[0] for r in spark.read.schema("delta string").parquet(current.table("deltas")).collect()]
            if delta in known:
                return False
            states = self.merge(spark.read.schema(states.schema).parquet(current.table("states")).select(*states.columns), states)
        release = new_release(self.path)
        write_partitioned(states, release.table("states"), ["grouping_id"])
        write_parquet(inline_rows(spark, [(d,) for d in (*known, delta)], "delta string").coalesce(1), release.table("deltas"))
        publish(spark, release)
        return True

    def totals(self, spark: SparkSession, *dimensions: str) -> DataFrame:
        """Sum, count and estimated distinct values by ``dimensions``, from the folder of that
        grouping alone; without a grouping given, see ``all_totals``."""
        kept = set(dimensions)
        gid = sum(1 << (len(self.dimensions) - 1 - i) for i, d in enumerate(self.dimensions) if d not in kept)
        return self.all_totals(spark).where(F.col("grouping_id") == gid).drop("grouping_id", *[d for d in self.dimensions if d not in kept])

    def all_totals(self, spark: SparkSession) -> DataFrame:
        current = published(spark, self.path)
        if current is None:
            raise FileNotFoundError(f"no cube in {self.path}")
        stored = spark.read.parquet(current.table("states"))
        answers = [from_units(F.col("_sum"), self.scale).alias("total"), F.col("_count").alias("n_facts"), F.hll_sketch_estimate("_distinct").alias("n_distinct")]
        return stored.select(F.col("grouping_id").cast("long"), *self.dimensions, *answers)
