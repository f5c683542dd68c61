"""JSON load through a list of paths: the n-th path fills the n-th target column."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


# Steps of a path: names, plain or in brackets, and places in an array.
_STEP = re.compile(r"""\.([A-Za-z_]\w*)|\['([^'\]]+)'\]|\["([^"\]]+)"\]|\[(\d+)\]""")


def steps_of(path: str) -> tuple[str | int, ...] | None:
    """Names and array places of a path, or None if it has others (wildcards, filters)."""
    if not path.startswith("$"):
        return None
    at, steps = 1, []
    while at < len(path):
        found = _STEP.match(path, at)
        if not found:
            return None
        steps.append(int(found[4]) if found[4] is not None else found[1] or found[2] or found[3])
        at = found.end()
    return tuple(steps) or None


def _struct_of(tree: Mapping) -> StructType:
    return StructType([StructField(name, _struct_of(below) if below else StringType()) for name, below in tree.items()])


def _tree_of(paths: Sequence[tuple]) -> dict:
    """Nested names of the paths that one parse into a struct can answer: those of names
    alone, none of which leads through another."""
    plain = {p for p in paths if all(isinstance(s, str) for s in p)}
    inner = {p[:n] for p in paths for n in range(1, len(p))}
    tree: dict = {}
    for path in sorted(plain):
        if path not in inner and not any(path[:n] in plain for n in range(1, len(path))):
            node = tree
            for name in path:
                node = node.setdefault(name, {})
    return tree


def select_paths(df: DataFrame, json: str, paths: Sequence[str], target: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """The columns ``keep`` and one typed column per path of the text column ``json``. Text
    that does not fit its type becomes null.

    Paths of names, in dots or brackets, are answered by one parse of each text into a
    struct. Paths with places in arrays, or that lead through others, share one parse into
    a variant. Only paths with wildcards, and texts that are no variant (a name occurs
    twice), have a search of their own. A number that a variant gives as text is in its
    plain form (1.50 is 1.5)."""
    if len(paths) != len(target.fields):
        raise ValueError(f"{len(paths)} paths for {len(target.fields)} columns")
    steps = [steps_of(p) for p in paths]
    tree = _tree_of([s for s in steps if s])
    columns, fixed = [], {"_parsed": F.from_json(json, _struct_of(tree))} if tree else {}
    for path, found, field in zip(paths, steps, target.fields, strict=True):
        node = tree if found else None
        for step in found or ():
            node = node.get(step) if isinstance(node, dict) else None
        if node is not None and not node:
            value = F.col("_parsed")
            for step in found:
                value = value.getField(step)
        elif found:
            fixed["_variant"] = F.try_parse_json(json)
            bracketed = "$" + "".join(f"[{s}]" if isinstance(s, int) else f"['{s}']" for s in found)
            value = F.when(F.col("_variant").isNotNull(), F.try_variant_get("_variant", bracketed, "string")).otherwise(F.get_json_object(json, path))
        else:
            value = F.get_json_object(json, path)
        if field.dataType != StringType():
            value = value.try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.withColumns(fixed).select(*keep, *columns) if fixed else df.select(*keep, *columns)


def json_by_paths(
    spark: SparkSession, source: str | list[str], paths: Sequence[str], target: StructType
) -> DataFrame:
    """Read JSON lines and map them by ``paths``."""
    return select_paths(spark.read.text(source), "value", paths, target)


def read_path_list(spark: SparkSession, mapping_file: str) -> list[str]:
    """The path list of a mapping file ``{"jsonpaths": ["$.a", ...]}``: one small document."""
    row = spark.read.option("multiLine", "true").schema("jsonpaths array<string>").json(mapping_file).first()
    if row is None or row.jsonpaths is None:
        raise ValueError(f"no jsonpaths in {mapping_file}")
    return list(row.jsonpaths)
