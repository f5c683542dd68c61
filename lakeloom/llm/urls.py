"""URL filter by path templates.

Stated rules decide the URLs they fit; the longest wins. The others are judged by the path
template they belong to. For each host the segments of its paths form a tree. Level by
level, from the top, a segment that is common below its parent stays as it is and all
others become a wildcard of their form (numbers, hexadecimal, words, ...). Then, from the
bottom, literal branches of one parent are merged into one wildcard if the mix of what
follows them and of their labels does not differ from the mix of all of them, by a
chi-square test of each branch against their sum. So branches are compared with one total,
never in pairs.

Pages that a rule decides, and pages that come with a label, are the labelled ones. A
template is rejected if the share of unwanted pages among its labelled ones is high, the
share being smoothed by that of the same template on all hosts, and that by the share among
all labelled pages.

Only built-in functions and joins are used. Distinct paths of a host are counted, so copies
of a page do not make its segments common. A host may hold any share of the pages: rows are
grouped and joined by host and template with partial counts, and hot keys are split.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.storage import stored
from lakeloom.operators.layout import many_to_one

#: Segments of a path that the tree tells apart; the rest is one last segment.
LEVELS = 8
#: A segment is literal if so many paths, and so many percent of its parent's, have it.
LITERAL_PATHS, LITERAL_PERCENT = 5, 5
#: Normal quantile of the chi-square test (one in a hundred), weight of smoothing, and share
#: of unwanted pages from which a template is rejected.
QUANTILE, SMOOTHING, REJECTED = 2.326, 5.0, 0.8
#: '#' ends a path, so no segment holds it.
ANY, REST = "#", "##"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @classmethod
    def parse(cls, text: str) -> "Rule":
        """``allow host/path``; host and path meet at the first slash."""
        verdict, place = text.split(" ", 1)
        if verdict not in ("allow", "block") or "/" not in place:
            raise ValueError(f"not a rule: {text}")
        at = place.index("/")
        return cls(verdict, place[:at].lower(), place[at:])

    @property
    def name(self) -> str:
        return self.host + self.path


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lowered, and path; both empty for null or without ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, parts, 1), string.ascii_uppercase, string.ascii_lowercase), F.regexp_extract(url, parts, 2)


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The longest fitting rule as (rule, verdict), null if none fits; of equal length the one
    with the longer host. Rules are a short stated list and become one expression."""
    ordered = sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name), reverse=True)
    fits = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in ordered]
    return F.coalesce(*fits, F.lit(None).cast("struct<rule:string,verdict:string>"))


def form(segment: Column) -> Column:
    """The wildcard of a segment: its kind of characters and its ending."""
    ending = F.regexp_extract(segment, r"\.[A-Za-z]{1,5}\z", 0)
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}\z", "")
    kind = (
        F.when(segment == "", "")
        .when(stem.rlike(r"^[0-9]+\z"), "n")
        .when(stem.rlike(r"^[0-9a-fA-F-]{8,}\z") & stem.rlike("[0-9]"), "x")
        .when(stem.rlike("[0-9]"), "m")
        .otherwise("w")
    )
    return F.concat(F.lit(ANY), kind, F.lower(ending))


def _segments(path: Column) -> Column:
    """Segments of a path, what follows the last level as one."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/", LEVELS + 1)
    return F.when(F.size(parts) > LEVELS, F.concat(F.slice(parts, 1, LEVELS), F.array(F.lit(REST)))).otherwise(parts)


def path_tree(paths: DataFrame) -> DataFrame:
    """``template`` (an array of segments) for every row of ``host`` and ``path``, which are
    distinct; other columns are kept. Common segments stay, others become wildcards."""
    columns = paths.columns
    rows = stored(paths.select("*", _segments(F.col("path")).alias("_segments"), F.array().cast("array<string>").alias("template")), "paths")
    for level in range(LEVELS + 1):
        deep = F.size("_segments") > level
        if not rows.where(deep).limit(1).count():
            break
        rows = rows.withColumn("_segment", F.when(deep, F.try_element_at("_segments", F.lit(level + 1))))
        counted = rows.where(deep).groupBy("host", "template", "_segment").agg(F.count(F.lit(1)).alias("_n"))
        # A node may have a child for each of its paths; only the common ones meet its total.
        total = counted.groupBy("host", "template").agg(F.sum("_n").alias("_total"))
        often = many_to_one(counted.where(F.col("_n") >= LITERAL_PATHS), total, ["host", "template"])
        literal = often.where(F.col("_n") * 100 >= F.col("_total") * LITERAL_PERCENT).select("host", "template", "_segment", F.lit(True).alias("_literal"))
        kept = F.when(F.coalesce("_literal", F.lit(False)) | (F.col("_segment") == REST), F.col("_segment")).otherwise(form(F.col("_segment")))
        grown = F.when(F.col("_segment").isNull(), F.col("template")).otherwise(F.concat("template", F.array(kept)))
        rows = stored(many_to_one(rows, literal, ["host", "template", "_segment"]).select(*columns, "_segments", grown.alias("template")), "paths")
    return rows.drop("_segments")


def _critical(freedom: Column) -> Column:
    """Chi-square quantile by the Wilson-Hilferty approximation."""
    part = F.lit(2.0) / (F.lit(9.0) * freedom)
    return freedom * F.pow(F.lit(1.0) - part + F.lit(QUANTILE) * F.sqrt(part), F.lit(3.0))


def merge_branches(templates: DataFrame) -> DataFrame:
    """``merged`` for every row of ``host`` and ``template`` with its numbers of paths ``n`` and
    of those labelled ``bad`` and ``good``: literal branches that look alike share one wildcard."""
    rows = stored(templates.select("host", "template", "n", "bad", "good", F.col("template").alias("merged")), "templates")
    deepest = rows.agg(F.max(F.size("merged"))).first()[0] or 0
    for level in range(deepest, 0, -1):
        segment = F.try_element_at("merged", F.lit(level))
        literal = (F.size("merged") >= level) & ~F.coalesce(segment, F.lit(ANY)).startswith(ANY)
        unlabelled = F.greatest(F.col("n") - F.col("bad") - F.col("good"), F.lit(0))
        kinds = F.array(*[F.struct(F.lit(k).alias("label"), c.alias("c")) for k, c in (("b", F.col("bad")), ("g", F.col("good")), ("u", unlabelled))])
        parts = rows.where(literal).select("host", F.slice("merged", 1, level - 1).alias("_above"), segment.alias("_branch"), F.expr(f"slice(merged, {level + 1}, {LEVELS + 2})").alias("_below"), F.explode(kinds).alias("_kind"))
        cells = parts.where("_kind.c > 0").groupBy("host", "_above", "_branch", "_below", "_kind.label").agg(F.sum("_kind.c").alias("c"))
        # Rows here are branches of one node by what follows them, not pages.
        branch = Window.partitionBy("host", "_above", "_branch")
        bad, good = (F.sum(F.when(F.col("label") == k, F.col("c")).otherwise(0)).over(branch) for k in "bg")
        lead = F.when(bad > good, "b").when(good > 0, "g").otherwise("u")
        cells = cells.withColumns({"_most": F.max(F.struct("c", "_below")).over(branch)["_below"], "_lead": lead})
        group = ["host", "_above", "_most", "_lead"]
        node, alike = Window.partitionBy(*group), Window.partitionBy(*group, "_below", "label")
        cells = cells.withColumns({"_all": F.sum("c").over(node), "_own": F.sum("c").over(branch), "_pool": F.sum("c").over(alike)})
        cells = cells.withColumn("_first", F.row_number().over(alike.orderBy("_branch")))
        cells = cells.withColumn("_cells", F.sum(F.when(F.col("_first") == 1, 1).otherwise(0)).over(node))
        term = F.col("c") * F.col("c") * F.col("_all") / (F.col("_own") * F.col("_pool")).cast("double")
        tested = cells.groupBy(*group, "_branch").agg(F.sum(term).alias("_sum"), F.first("_own").alias("_own"), F.first("_cells").alias("_cells"))
        freedom = (F.col("_cells") - 1).cast("double")
        like = F.when(F.col("_cells") == 1, F.lit(True)).otherwise(F.round(F.col("_sum") - F.col("_own"), 6) <= F.round(_critical(freedom), 6))
        tested = tested.select(*group, "_branch", like.alias("_like")).where("_like")
        tested = tested.withColumn("_together", F.count(F.lit(1)).over(node)).where("_together > 1").select("host", "_above", "_branch", F.lit(True).alias("_alike"))
        keyed = rows.withColumns({"_above": F.when(literal, F.slice("merged", 1, level - 1)), "_branch": F.when(literal, segment)})
        general = F.concat(F.slice("merged", 1, level - 1), F.array(F.lit(ANY)), F.expr(f"slice(merged, {level + 1}, {LEVELS + 2})"))
        joined = many_to_one(keyed, tested, ["host", "_above", "_branch"])
        rows = stored(joined.select("host", "template", "n", "bad", "good", F.when(F.col("_alike"), general).otherwise(F.col("merged")).alias("merged")), "templates")
    return rows


def unwanted_share(templates: DataFrame) -> DataFrame:
    """``unwanted`` for every ``host`` and ``merged`` template: the smoothed share of unwanted
    pages among its labelled ones."""
    own = stored(templates.groupBy("host", "merged").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "labelled")
    bad, good = own.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))).first()
    overall = (bad + 1) / (bad + good + 2)

    def smoothed(bad: str, good: str, prior: Column) -> Column:
        return (F.col(bad) + F.lit(SMOOTHING) * prior) / (F.col(bad) + F.col(good) + F.lit(SMOOTHING))

    pooled = own.groupBy("merged").agg(F.sum("bad").alias("_bad"), F.sum("good").alias("_good"))
    joined = many_to_one(own, pooled, ["merged"])
    return joined.select("host", "merged", smoothed("bad", "good", smoothed("_bad", "_good", F.lit(overall))).alias("unwanted"))


def judge(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", label: str | None = None) -> DataFrame:
    """Every row's id, ``host``, ``path``, ``rule`` (null if none fits), ``verdict`` (allow or
    block), ``template`` and the template's share of ``unwanted`` pages.

    ``label`` names a boolean column: true for pages known to be unwanted, false for wanted
    ones, null for others; rules go before it. A null or empty URL, or one without ``://``,
    has an empty host and path and is judged like others of that host. Repeated rows stay,
    each with the same verdict. Columns other than the named ones are not read. A path that
    has pages of both labels counts for each.
    """
    host, path = split_url(F.col(url))
    parsed = pages.select(F.col(key).alias("_key"), host.alias("host"), path.alias("path"), (F.col(label).cast("boolean") if label else F.lit(None).cast("boolean")).alias("_label"))
    parsed = parsed.withColumn("_rule", longest_rule(rules, F.col("host"), F.col("path")))
    parsed = stored(parsed.select("_key", "host", "path", "_rule.rule", "_rule.verdict", F.coalesce(F.col("_rule.verdict") == "block", "_label").alias("_bad")), "urls")
    paths = parsed.groupBy("host", "path").agg(F.max(F.coalesce(F.col("_bad"), F.lit(False)).cast("int")).alias("bad"), F.max(F.coalesce(~F.col("_bad"), F.lit(False)).cast("int")).alias("good"))
    placed = path_tree(paths)
    templates = merge_branches(placed.groupBy("host", "template").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"), F.sum("good").alias("good")))
    shares = many_to_one(templates.select("host", "template", "merged"), unwanted_share(templates), ["host", "merged"])
    named = many_to_one(placed.select("host", "path", "template"), shares, ["host", "template"]).select("host", "path", F.concat(F.lit("/"), F.array_join("merged", "/")).alias("template"), "unwanted")
    verdict = F.coalesce("verdict", F.when(F.col("unwanted") >= REJECTED, "block").otherwise("allow"))
    joined = many_to_one(parsed, named, ["host", "path"])
    return joined.select(F.col("_key").alias(key), "host", "path", "rule", verdict.alias("verdict"), "template", "unwanted")
