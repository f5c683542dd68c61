"""Sharding by balanced label propagation, in built-in functions only.

Linked documents are those with equal texts. A shard is a label. Documents start where a hash
of their id puts them; in each round a group that is not yet whole asks for the shard that
holds most of it, among those with room for all of it, and a shard grants what its room
takes, larger groups first. Refused groups ask again, so rounds end when no group asks that
some shard has room for. Groups that are large for a shard come first, in falling order, and
groups that no shard has room for come last, over as few shards as the room left needs.
Documents of a group in one shard are alike, so a round works on one row for each group.

The law is ``rows``: in the end shards differ by one row at most. Linked documents never
exceed a shard's quota. Documents are numbered in their shard, linked ones first; those
beyond the quota have no links, and go to the free places of other shards in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.storage import stored
from lakeloom.operators.layout import many_to_one

SHARDS, ROUNDS, OVERHEAD_BYTES = 40, 6, 16
#: Rows of one numbering window, and most windows for each shard.
_WINDOW_ROWS, _MOST_WINDOWS = 20_000, 1 << 14


#: A group of at least one in so many of a shard's rows is large. There are no more than so
#: many for each shard, so they are placed one by one.
_LARGE_PART = 50


def _bins(rows: int, at_least: int = 1) -> int:
    return max(at_least, min(_MOST_WINDOWS, rows // _WINDOW_ROWS + 1))


def _before(rows: DataFrame, keys: list[str], order: list, amount: Column) -> DataFrame:
    """Add ``before``: the amounts of the rows before, of equal ``keys``, in the order of
    ``bin`` and then ``order``. The rows of a bin meet in a window, bins in another."""
    totals = rows.groupBy(*keys, "bin").agg(F.sum(amount).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "bin", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys, "bin").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return summed.join(F.broadcast(offsets), [*keys, "bin"]).withColumn("before", F.col("_offset") + F.col("_inside")).drop("_offset", "_inside")


def _asked(waiting: DataFrame, room: list[int], step: int, rounds: int) -> DataFrame:
    """Add ``to``: the shard with most of the group among those with room for all of it; where
    none of its own has room, and after so many rounds, any that has, by a hash. Else null."""
    fits = lambda s: F.get(F.lit(room), s) >= F.col("size")
    some = F.filter(F.lit(list(range(len(room)))), fits)
    any_ = F.get(some, F.pmod(F.xxhash64(F.lit(step), "group"), F.greatest(F.size(some), F.lit(1))).cast("int"))
    own = F.get(F.filter("own", fits), F.lit(0)) if step < rounds else F.lit(None).cast("int")
    return waiting.withColumn("to", F.coalesce(own, any_))


def _place_small(waiting: DataFrame, room: list[int], rounds: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds until no group asks; what each grants, and the groups that fit nowhere. ``room``
    is lowered. In each, a shard that is asked grants its first request at least."""
    granted, step = [], 0
    while True:
        asked = stored(_asked(waiting, room, step, rounds), "asked")
        wanted = asked.where("to is not null").groupBy("to").count().collect()
        if not wanted:
            return granted, asked.drop("to")
        # Larger groups come first: by power of two, and in bins of bounded size below it.
        bins = _bins(max(r["count"] for r in wanted))
        level = 64 - F.length(F.bin("size"))
        numbered = asked.where("to is not null").withColumn("bin", level.cast("long") * bins + F.pmod(F.xxhash64("group"), F.lit(bins)))
        summed = _before(numbered, ["to"], [F.desc("size"), "group"], F.col("size"))
        judged = stored(summed.withColumn("granted", F.col("before") + F.col("size") <= F.get(F.lit(room), F.col("to"))), "granted")
        for r in judged.where("granted").groupBy("to").agg(F.sum("size").alias("n")).collect():
            room[r["to"]] -= r["n"]
        granted.append(judged.where("granted").select("group", F.col("to").alias("shard")))
        left = judged.where("not granted").select("group", "size", "own")
        waiting = left.unionByName(asked.where("to is null").select("group", "size", "own"))
        step += 1


def _place_groups(linked: DataFrame, quota: list[int], rounds: int) -> tuple[DataFrame, dict[str, list[tuple[int, int]]]]:
    """The shard of each group that is whole, and for the others the shards and numbers of
    rows that they are cut into. ``linked`` has ``group``, ``size`` and ``own``: its shards,
    the one with most of it first."""
    spark, room, shards = linked.sparkSession, list(quota), range(len(quota))
    large = F.col("size") * _LARGE_PART >= max(quota)
    whole, cut = [], []
    for r in sorted(linked.where(large).collect(), key=lambda r: (-r["size"], r["group"])):
        fits = [s for s in [*r["own"], *sorted(shards, key=lambda s: -room[s])] if room[s] >= r["size"]]
        if fits:
            room[fits[0]] -= r["size"]
            whole.append((r["group"], fits[0]))
        else:
            cut.append((r["size"], r["group"]))
    granted, left = _place_small(linked.where(~large), room, rounds)
    # Each of these has more rows than any shard has room for, so there are fewer than shards.
    cut += [(r["size"], r["group"]) for r in left.select("size", "group").collect()]
    pieces: dict[str, list[tuple[int, int]]] = {}
    for size, group in sorted(cut):
        for s in sorted(shards, key=lambda s: (-room[s], s)):
            n = min(size, room[s])
            if n:
                pieces.setdefault(group, []).append((s, n))
                room[s] -= n
                size -= n
    plan = spark.createDataFrame([*whole, *((g, -1) for g in pieces)], "group string, shard int")
    for part in granted:
        plan = plan.unionByName(part)
    return stored(plan, "plan"), pieces


def _cut(rows: DataFrame, pieces: dict[str, list[tuple[int, int]]], n_rows: int, shards: int) -> DataFrame:
    """Labels for the rows of cut groups: rows are numbered, and go to the pieces in order."""
    ends = []
    for group, parts in pieces.items():
        end = 0
        for shard, n in parts:
            ends.append((group, end, end + n, shard))
            end += n
    bin_ = F.pmod(F.xxhash64("id", "text_crc32"), F.lit(_bins(n_rows, shards)))
    numbered = _before(rows.withColumn("bin", bin_), ["group"], ["id", "size"], F.lit(1))
    listed = rows.sparkSession.createDataFrame(ends, "group string, first long, upto long, piece int")
    at = numbered.join(F.broadcast(listed), "group").where("first <= before and before < upto")
    return at.select("id", "size", "text_crc32", F.col("piece").alias("label"), F.lit(True).alias("linked"))


def balanced_shards(
    docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Each row's id, ``size`` (UTF-8 bytes and 16), ``text_crc32``, ``shard`` and ``slot``
    (from 0 in each shard, without gaps).

    Shards differ by one row at most. Rows with equal texts are linked and share a shard
    where some shard has room for all of them when their turn comes; a null text counts as empty. Repeated rows are rows of their own.
    Other columns are not read. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    narrow = docs.select(
        F.col(id_column).alias("id"),
        (F.octet_length(text) + OVERHEAD_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("group"),
    )
    base = stored(narrow.withColumn("start", F.pmod(F.xxhash64("id", "group"), F.lit(shards)).cast("int")), "sizes")
    n_rows = base.count()
    quota = [n_rows // shards + (s < n_rows % shards) for s in range(shards)]

    counted = base.groupBy("group", F.col("start").alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    ranked = F.sort_array(F.collect_list(F.struct("n", F.xxhash64("group", "shard").alias("h"), "shard")), asc=False)
    many = counted.groupBy("group").agg(F.sum("n").alias("size"), F.transform(ranked, lambda x: x["shard"]).alias("own")).where("size > 1")
    plan, pieces = _place_groups(stored(many, "groups"), quota, rounds)

    joined = many_to_one(base, plan, ["group"])
    wished = joined.where("shard is null or shard >= 0").select(
        "id", "size", "text_crc32",
        F.coalesce("shard", "start").alias("label"), F.col("shard").isNotNull().alias("linked"),
    )
    if pieces:
        rows_of_cut = base.where(F.col("group").isin(list(pieces))).select("id", "size", "text_crc32", "group")
        wished = wished.unionByName(_cut(rows_of_cut, pieces, n_rows, shards))
    return _numbered(wished, shards, quota, n_rows).select(F.col("id").alias(id_column), "size", "text_crc32", "shard", "slot")


def _numbered(wished: DataFrame, shards: int, quota: list[int], n_rows: int) -> DataFrame:
    """Slots in the wished shard, linked rows first, and for those beyond the quota the free
    slots of other shards. Numbers are given in windows of bounded size, to which the rows of
    windows before them are added from a table with one row for each window."""
    windows = max(1, min(_MOST_WINDOWS, n_rows // shards // _WINDOW_ROWS + 1))
    spread = stored(wished.withColumn("bin", F.pmod(F.xxhash64("id", "text_crc32"), F.lit(windows)).cast("int")), "wishes")
    counts = spread.groupBy("label", "linked", "bin").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("label").orderBy(F.desc("linked"), "bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("label", "linked", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    order = Window.partitionBy("label", "linked", "bin").orderBy("id", "size", "text_crc32")
    slots = spread.withColumn("row", F.row_number().over(order) - 1).join(F.broadcast(offsets), ["label", "linked", "bin"])
    placed = slots.withColumn("place", F.col("offset") + F.col("row"))

    held = {r["label"]: r["n"] for r in counts.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    over, free, total = [], [], 0
    for s in range(shards):
        over.append(total)
        total += max(0, held.get(s, 0) - quota[s])
    total = 0
    for s in range(shards):
        spare = max(0, quota[s] - held.get(s, 0))
        if spare:
            # Rows beyond a quota are numbered through all shards; from ``first`` on they come here.
            free.append((total, s, held.get(s, 0)))
            total += spare
    quotas, overs = F.lit(quota), F.lit(over)
    beyond = F.col("place") - F.get(quotas, F.col("label"))
    rank = F.get(overs, F.col("label")) + beyond
    if not free:
        return placed.select("id", "size", "text_crc32", F.col("label").alias("shard"), F.col("place").cast("long").alias("slot"))
    places = F.array(*[F.struct(F.lit(a).alias("first"), F.lit(s).alias("shard"), F.lit(h).alias("held")) for a, s, h in free])
    target = F.element_at(F.filter(places, lambda p: p["first"] <= F.greatest(rank, F.lit(0))), -1)
    moved = placed.withColumn("target", F.when(beyond >= 0, target)).withColumn("rank", rank)
    return moved.select(
        "id", "size", "text_crc32",
        F.coalesce(F.col("target.shard"), F.col("label")).cast("int").alias("shard"),
        F.coalesce(F.col("target.held") + F.col("rank") - F.col("target.first"), F.col("place")).cast("long").alias("slot"),
    )
