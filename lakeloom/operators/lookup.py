"""Lookups and query-shaped tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.dedup import last_write_wins, one_per_key
from lakeloom.operators.layout import many_to_one
from lakeloom.sinks.files import write_sorted


def first_match(
    df: DataFrame, reference: DataFrame, on: Sequence[str], take: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """Each row of ``df`` with ``take`` from the first matching row of ``reference``,
    null where none matches. The reference is cut to one row per key before the join."""
    firsts = one_per_key(reference, on, order_by).select(*on, *take)
    return many_to_one(df, firsts, on)


@dataclass(frozen=True)
class QueryTable:
    """A table shaped for one query: rows unique by partition key and clustering
    columns (last write wins), kept in clustering order within a partition key."""

    rows: DataFrame
    partition_key: tuple[str, ...]
    clustering: tuple[str, ...] = ()

    @classmethod
    def build(
        cls,
        df: DataFrame,
        partition_key: Sequence[str],
        clustering: Sequence[str] = (),
        written_by: Sequence[str] = (),
        columns: Sequence[str] | None = None,
    ) -> "QueryTable":
        primary = [*partition_key, *clustering]
        rows = last_write_wins(df, primary, written_by)
        return cls(rows.select(*(columns or df.columns)), tuple(partition_key), tuple(clustering))

    def where(self, strict: bool = True, **values) -> DataFrame:
        """Rows for given key values, in clustering order.

        With ``strict`` the filter must fix the whole partition key and a prefix of the
        clustering columns, which the order of a stored table answers by reading few
        row groups; without it any column will do, at the price of a full scan.
        """
        if strict:
            extra = [c for c in values if c not in self.partition_key]
            whole_key = set(self.partition_key) <= set(values)
            if not whole_key or set(extra) != set(self.clustering[: len(extra)]):
                raise ValueError(
                    f"filter on {sorted(values)} does not fix key {self.partition_key} and a prefix of {self.clustering}"
                )
        found = self.rows
        for name, value in values.items():
            found = found.where(F.col(name) == value)
        return found.orderBy(*self.clustering) if self.clustering else found

    def store(self, path: str) -> "QueryTable":
        """Write in key order and read back from there.

        Ranges of the whole primary key are cut to equal size, so a partition key with
        very many rows spans several files; a lookup reads only the row groups whose
        minimum and maximum enclose the key.
        """
        write_sorted(self.rows, path, [*self.partition_key, *self.clustering])
        return QueryTable(self.rows.sparkSession.read.parquet(path), self.partition_key, self.clustering)


def expression_list(source: str, fields: Mapping[str, str] | Sequence[str]) -> list[str]:
    """``source['f'] AS f`` for every field, for ``selectExpr``."""
    pairs = fields.items() if isinstance(fields, Mapping) else ((f, f) for f in fields)
    return [f"{source}['{field}'] AS {alias}" for field, alias in pairs]
