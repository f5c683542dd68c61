"""Cubes: one metric over dimensions with hierarchies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.exact import from_units


@dataclass(frozen=True)
class Cube:
    """``facts`` joined to their dimensions, with a metric to add up.

    ``hierarchies`` lists attributes from coarse to fine. Every method returns a new
    cube or a lazy frame; nothing runs before an action. A metric counted in units of
    ``10 ** -scale`` (see ``functions.exact``) is turned into amounts after summing.
    """

    facts: DataFrame
    metric: Column
    metric_name: str
    dimensions: tuple[str, ...]
    hierarchies: Mapping[str, Sequence[str]] = field(default_factory=dict)
    scale: int = 0

    def slice(self, dimension: str, value) -> "Cube":
        """Fix one dimension to one value and leave it out of the grouping."""
        kept = tuple(d for d in self.dimensions if d != dimension)
        return replace(self, facts=self.facts.where(F.col(dimension) == value), dimensions=kept)

    def dice(self, allowed: Mapping[str, Sequence]) -> "Cube":
        """Restrict several dimensions to lists of values."""
        facts = self.facts
        for dimension, values in allowed.items():
            facts = facts.where(F.col(dimension).isin(list(values)))
        return replace(self, facts=facts)

    def _step(self, dimension: str, by: int) -> str:
        for levels in self.hierarchies.values():
            if dimension in levels:
                at = list(levels).index(dimension) + by
                if 0 <= at < len(levels):
                    return levels[at]
        raise ValueError(f"no {'coarser' if by < 0 else 'finer'} level for {dimension}")

    def roll_up(self, dimension: str) -> "Cube":
        """Group by the next coarser attribute instead."""
        coarser = self._step(dimension, -1)
        return replace(self, dimensions=tuple(coarser if d == dimension else d for d in self.dimensions))

    def drill_down(self, dimension: str) -> "Cube":
        """Group by the next finer attribute as well; the coarser one stays, since a
        fine name may repeat below several coarse ones."""
        finer = self._step(dimension, 1)
        at = self.dimensions.index(dimension) + 1
        return replace(self, dimensions=(*self.dimensions[:at], finer, *self.dimensions[at:]))

    def _sum(self) -> Column:
        return from_units(F.sum(self.metric), self.scale).alias(self.metric_name)

    def totals(self) -> DataFrame:
        return self.facts.groupBy(*self.dimensions).agg(self._sum())

    def top(self, n: int) -> DataFrame:
        """The ``n`` largest groups; ties go by the dimensions."""
        return self.totals().orderBy(F.desc(self.metric_name), *self.dimensions).limit(n)

    def _at_finest(self) -> "Cube":
        """The metric summed to the finest grouping first. The several groupings then
        expand these few rows, not every fact; sums of sums are exact for decimals."""
        summed = self.facts.groupBy(*self.dimensions).agg(F.sum(self.metric).alias("_sum"))
        return replace(self, facts=summed, metric=F.col("_sum"))

    def _grouped(self, grouped) -> DataFrame:
        return grouped.agg(self._sum(), F.grouping_id().cast("long").alias("grouping_id"))

    def grouping_sets(self, sets: Sequence[Sequence[str]]) -> DataFrame:
        """Totals for each listed set of dimensions in one pass over the facts."""
        fine = self._at_finest()
        columns = [[F.col(c) for c in s] for s in sets]
        return fine._grouped(fine.facts.groupingSets(columns, *[F.col(d) for d in self.dimensions]))

    def rollup(self) -> DataFrame:
        """Totals for every prefix of the dimensions."""
        fine = self._at_finest()
        return fine._grouped(fine.facts.rollup(*self.dimensions))

    def cube(self) -> DataFrame:
        """Totals for every subset of the dimensions."""
        fine = self._at_finest()
        return fine._grouped(fine.facts.cube(*self.dimensions))

    def grouping_id_of(self, *kept: str) -> int:
        """The id Spark gives to the grouping that keeps these dimensions."""
        return sum(1 << (len(self.dimensions) - 1 - i) for i, d in enumerate(self.dimensions) if d not in kept)

    def materialize(self, path: str) -> "StoredCube":
        """Save all groupings, one folder each. Only sums are stored, which stay exact
        when an answer is read from the matching grouping."""
        self.cube().write.partitionBy("grouping_id").parquet(path)
        return StoredCube(self, path)


@dataclass(frozen=True)
class StoredCube:
    origin: Cube
    path: str

    def totals(self, *dimensions: str) -> DataFrame:
        """Totals by ``dimensions`` from the one folder that holds them."""
        gid = self.origin.grouping_id_of(*dimensions)
        schema = self.origin.cube().schema
        stored = self.origin.facts.sparkSession.read.schema(schema).parquet(self.path)
        return stored.where(F.col("grouping_id") == gid).select(*dimensions, self.origin.metric_name)
