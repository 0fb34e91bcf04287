"""URL filters: fixed rules first, then a path-template tree per host with labelled purity.

Pages that a rule decides are the labelled ones. Path segments are generalised twice: by shape
(numbers, dates, hex strings, long identifiers), then level by level by counts, down to the deepest
place where templates still branch: where a place has too many different children, the rare ones become ``*``. Branches whose share of blocked
pages does not differ from that of all branches beside them are merged into ``*`` as well. A
template is rejected when its smoothed share of blocked pages is high enough.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.operators.lineage import cut_lineage
from smelter.operators.windows import neighbours

#: Levels of the tree between two cuts of the lineage.
LEVELS_AT_ONCE = 3

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Segment shapes, first match wins.
SHAPES = (
    (r"^[0-9]+$", "{n}"),
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "{date}"),
    (r"^[0-9]+\.[A-Za-z]+$", "{n}.ext"),
    (r"^[0-9a-fA-F-]{16,}$", "{hex}"),
    (r"^(?=.*[0-9])[A-Za-z0-9_-]{12,}$", "{id}"),
)


@dataclass(frozen=True)
class TreeSettings:
    """``levels``: how deep the tree is tested by counts; None for all of it. Deeper segments go by shape only."""

    levels: int | None = None
    max_children: int = 50
    z: float = 1.96
    smoothing: float = 1.0
    purity: float = 0.8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and whether it blocks; both null where none fits."""
    rule = blocks = F.lit(None)
    for verdict, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        blocks = F.when(fits, F.lit(verdict == "block")).otherwise(blocks)
    return rule.cast("string"), blocks.cast("boolean")


def _shape(segment: Column) -> Column:
    # A segment that looks like a name of the template's own is told from it by a backslash.
    shown = F.when(segment.rlike(r"^(\*|\\|\{)"), F.concat(F.lit("\\"), segment)).otherwise(segment)
    for pattern, name in reversed(SHAPES):
        shown = F.when(segment.rlike(pattern), F.lit(name)).otherwise(shown)
    return shown


def shaped(path: Column) -> Column:
    """The path's segments with variable ones replaced by the name of their shape."""
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), _shape)


def _generalise(shapes: DataFrame, level: int, s: TreeSettings) -> DataFrame:
    """Replace the segment at ``level`` (from 1) of each template by ``*`` where it should be."""
    at = shapes.withColumns({"parent": F.slice("template", 1, level - 1), "child": F.get("template", F.lit(level - 1))})
    sums = [F.sum(c).alias(c) for c in ("pages", "labelled", "blocked")]
    children = at.filter(F.col("child").isNotNull()).groupBy("host", "parent", "child").agg(*sums)
    parents = children.groupBy("host", "parent").agg(
        F.count(F.lit(1)).alias("children"), F.sum("pages").alias("all_pages"),
        F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked"))
    rate = F.col("all_blocked") / F.greatest(F.col("all_labelled"), F.lit(1))
    spread = F.sqrt(rate * (1 - rate) / F.greatest(F.col("labelled"), F.lit(1)))
    rare = (F.col("children") > s.max_children) & (F.col("pages") * s.max_children < F.col("all_pages"))
    alike = (F.col("labelled") == 0) | (
        F.abs(F.col("blocked") / F.greatest(F.col("labelled"), F.lit(1)) - rate) <= s.z * spread)
    starred = children.join(parents, ["host", "parent"]).filter(
        (F.col("children") > 1) & (rare | alike)).select("host", "parent", "child", F.lit(True).alias("starred"))
    changed = F.transform("template", lambda x, i: F.when(
        F.coalesce(F.col("starred"), F.lit(False)) & (i == level - 1), F.lit("*")).otherwise(x))
    return (at.join(starred, ["host", "parent", "child"], "left")
            .select("host", "shape", changed.alias("template"), "pages", "labelled", "blocked"))


def _next_branch(tree: DataFrame, level: int) -> int | None:
    """The first level beyond ``level`` at which two templates of a host part; None if there is none.

    Where templates part, two that follow each other in order do. Levels at which nothing parts are no work, however long a path.
    """
    distinct = tree.select("host", "template").distinct()
    beside = neighbours(distinct, ["host"], ["template"], "template", "before", "after")
    parted = F.array_position(F.zip_with("before", "template", lambda a, b: F.coalesce(a != b, F.lit(False))), F.lit(True))
    return beside.select(parted.alias("level")).filter(F.col("level") > level).agg(F.min("level")).collect()[0][0]


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], page_id: str = "page_id", url: str = "url",
               settings: TreeSettings = TreeSettings()) -> DataFrame:
    """One row per page: host, path, rule, verdict, template and its purity.

    A null url, or one without ``://``, has an empty host and path and is judged like any other. Null
    and repeated ids stay as they are; an empty table gives no rows; further columns are left out.
    A template without labelled pages has purity 0.5 and is allowed. Counts are summed before every
    shuffle and the tree is stored every few levels, so that a host with most pages is a few rows; the last join meets rows by
    (host, shape), whose hot keys adaptive execution splits.
    """
    s = settings
    parsed = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")).select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, blocks = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parsed.select("*", rule.alias("rule"), blocks.alias("blocks"),
                          F.concat_ws("/", shaped(F.col("path"))).alias("shape"))
    shapes = ruled.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("pages"), F.count("blocks").alias("labelled"),
        F.count_if("blocks").alias("blocked"))
    deepest_wanted = 1 << 30 if s.levels is None else s.levels
    tree, level = cut_lineage(shapes.withColumn("template", F.split("shape", "/"))), 0
    while (following := _next_branch(tree, level)) is not None and following <= deepest_wanted:
        for level in range(following, min(following + LEVELS_AT_ONCE, deepest_wanted + 1)):
            tree = _generalise(tree, level, s)
        tree = cut_lineage(tree)
    tree = tree.withColumn("template", F.concat_ws("/", "template"))
    purity = tree.groupBy("host", "template").agg(
        ((F.sum("blocked") + s.smoothing) / (F.sum("labelled") + 2 * s.smoothing)).alias("purity"))
    judged = tree.select("host", "shape", "template").join(purity, ["host", "template"])
    blocked = F.coalesce(F.col("blocks"), F.col("purity") >= s.purity)
    return ruled.join(judged, ["host", "shape"]).select(
        "page_id", "host", "path", "rule", F.when(blocked, "block").otherwise("allow").alias("verdict"),
        F.concat(F.lit("/"), "template").alias("template"), "purity")
