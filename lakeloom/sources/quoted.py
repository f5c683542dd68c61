"""CSV whose quoted fields hold line breaks, read by as many tasks as there are blocks.

Where a file is cut into blocks nobody knows whether the cut lies inside quotes, so the
CSV reader takes such a file whole in one task. Here blocks are read as lines, and the
number of quotes of a block says whether it changes from outside to inside quotes. A sum
of these parities over a file's earlier blocks (one row for each block) tells how each
block begins. Lines before a block's first record, and a last record that goes on after its
block, are known by the block's first and last line with an odd number of quotes; only
these are shuffled, to be put together. All other lines make up whole records and are joined
in the order in which they are read, so a task holds one batch of them and one record.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeloom.operators.layout import REPLICATE_ROWS, estimated_bytes, many_to_one

_FILE, _BLOCK, _LINE = "_file", "_block", "_line"
#: With more blocks than this, lines are shuffled to them, so many bytes to a task.
BROADCAST_BLOCKS = REPLICATE_ROWS
TASK_BYTES = 32 << 20


def quoted_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines, split at line feeds only, with their file, block and order within the block."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias(_BLOCK), F.monotonically_increasing_id().alias(_LINE))


def _quotes(text: str):
    return F.char_length(text) - F.char_length(F.replace(text, F.lit('"'), F.lit("")))


def _blocks(lines: DataFrame) -> DataFrame:
    """One row for each block of a file: whether it begins and ends inside quotes, its first
    line, its first and last line with an odd number of quotes, and the block of the record
    that is open where it begins."""
    odd = F.when(F.col("_odd") == 1, F.col(_LINE))
    found = lines.groupBy(_FILE, _BLOCK).agg(
        (F.sum("_odd") % 2).alias("_flips"), F.min(_LINE).alias("_top"), F.max(_LINE).alias("_end"), F.min(odd).alias("_first_odd"), F.max(odd).alias("_last_odd")
    )
    before = Window.partitionBy(_FILE).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("_inside", F.coalesce(F.sum("_flips").over(before), F.lit(0)) % 2)
    # A block that begins inside quotes has a record's start after the line that closes them.
    starts = (F.col("_inside") == 0) | F.coalesce(F.col("_first_odd") < F.col("_end"), F.lit(False))
    found = found.withColumn("_open", starts & ((F.col("_inside") + F.col("_flips")) % 2 == 1))
    owner = F.last(F.when(F.col("_open"), F.col(_BLOCK)), ignorenulls=True).over(before)
    return found.select(_FILE, _BLOCK, "_inside", "_open", "_top", "_first_odd", "_last_odd", owner.alias("_owner"))


def _join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from the lines of whole records, in order: ``value``, the parity ``_odd`` of its
    quotes, and other columns, of which a record has those of its first line."""
    pending, inside = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        after = (inside + np.cumsum(batch.column("_odd").to_numpy(zero_copy_only=False))) % 2
        inside, ends = int(after[-1]), np.flatnonzero(after == 0) + 1
        if not len(ends):
            pending.append(batch)
            continue
        held = sum(p.num_rows for p in pending)
        lines = pa.Table.from_batches([*pending, batch.slice(0, ends[-1])]).combine_chunks()
        offsets = pa.array(np.concatenate([[0], held + ends]), pa.int32())
        texts = pc.binary_join(pa.ListArray.from_arrays(offsets, lines["value"].combine_chunks()), "\n")
        others = lines.drop_columns(["value", "_odd"]).take(offsets[:-1])
        yield from others.add_column(0, "record", texts).combine_chunks().to_batches()
        pending = [batch.slice(ends[-1])] if ends[-1] < batch.num_rows else []
    if pending:
        raise ValueError("lines of whole records end inside quotes")


def records(spark: SparkSession, path: str | list[str], with_file: bool = True) -> DataFrame:
    """``record`` texts with their file, and whether it is the file's ``first`` one. A record
    ends at a line feed outside quotes; a carriage return before it belongs to the ending.
    Blank lines between records are none. A quote that is never closed makes the rest of its
    file one record, as in the CSV reader."""
    read = quoted_lines(spark, path)
    lines = read.withColumn("_odd", (_quotes("value") % 2).cast("int"))
    blocks = _blocks(lines)
    # A task reads one block of full size at most, and a file has one shorter block, so there
    # are no more blocks than tasks and files. A broadcast leaves lines in their order.
    few = read.rdd.getNumPartitions() + len(read.inputFiles()) <= BROADCAST_BLOCKS
    placed = lines.join(F.broadcast(blocks), [_FILE, _BLOCK]) if few else many_to_one(lines, blocks, [_FILE, _BLOCK])
    head = (F.col("_inside") == 1) & (F.col("_first_odd").isNull() | (F.col(_LINE) <= F.col("_first_odd")))
    tail = F.col("_open") & (F.col(_LINE) >= F.col("_last_odd"))
    first = ((F.col(_BLOCK) == 0) & (F.col(_LINE) == F.col("_top"))).alias("first")
    inner = placed.where(~head & ~tail)
    if not few:
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), estimated_bytes(read) // TASK_BYTES)
        inner = inner.repartition(tasks, _FILE, _BLOCK).sortWithinPartitions(_FILE, _BLOCK, _LINE)
    kept = ["first", *[_FILE] * with_file]
    inner = inner.select("value", "_odd", first, _FILE).select("value", "_odd", *kept)
    whole = inner.mapInArrow(_join_lines, f"record string, first boolean{f', {_FILE} string' if with_file else ''}")
    # What begins at a block's end belongs to that block, what a block begins with to an earlier one.
    edges = placed.where(head | tail).withColumn("_record", F.when(head, F.col("_owner")).otherwise(F.col(_BLOCK)))
    pieces = F.array_sort(F.collect_list(F.struct(F.col(_BLOCK).alias("b"), F.col(_LINE).alias("l"), F.col("value").alias("v"))))
    rest = edges.withColumn("first", first).groupBy(_FILE, "_record").agg(
        F.array_join(F.transform(pieces, lambda p: p["v"]), "\n").alias("record"), F.bool_or("first").alias("first")
    )
    found = whole.unionByName(rest.select("record", *kept))
    return found.withColumn("record", F.regexp_replace("record", r"\r\z", "")).where(F.col("first") | (F.col("record") != ""))


def csv_records(spark: SparkSession, path: str | list[str], schema: StructType, sep: str = ",", header: bool = False) -> DataFrame:
    """CSV with quoted line breaks. Fields are quoted by ``"``, doubled inside; columns go by
    position. A field that does not fit its type is null, and so are fields a record lacks."""
    texts = records(spark, path, with_file=False)
    if header:
        texts = texts.where(~F.col("first"))
    texts = texts.where(F.col("record") != "")
    # One parse into texts, then casts: a broken field does not take its record with it.
    raw = StructType([StructField(f.name, StringType()) for f in schema.fields])
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}
    parsed = texts.select(F.from_csv("record", raw.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options).alias("r"))
    return parsed.select(*[F.col("r")[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields])
