"""Url verdicts from host rules and from a tree of path templates learned per host."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import materialize

WILD = "*"
_SEP = "\x01"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a host, then a path that starts with a slash, like ``example.net/en/``."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, ascii_uppercase, ascii_lowercase)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (pattern, verdict) of the longest rule that fits, else null; ties in text order."""
    out = F.lit(None).cast("struct<pattern:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):
        on_host = (host == rule.host) | host.endswith("." + rule.host)
        hit = F.struct(F.lit(rule.pattern).alias("pattern"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(on_host & path.startswith(rule.path), hit).otherwise(out)
    return out


def path_templates(
    pages: DataFrame, min_pages: int = 8, max_distinct_share: float = 0.5, stored_levels: int = 8
) -> DataFrame:
    """Adds ``_template`` to rows with ``_host`` and ``_path``.

    Level by level, the rare children of a node of the host's path tree, those with so few pages that
    one child a page is a share of at least ``max_distinct_share``, become one wildcard if together
    they have at least ``min_pages`` pages. Every other child stays a branch of its own, however many
    there are. Empty segments do not count, so a trailing slash changes nothing.

    Every ``stored_levels`` levels the rows are stored, and levels end where no node has enough pages
    for a wildcard; what lies deeper stays as it is.
    """
    segments = F.filter(F.split("_path", "/"), lambda x: x != "")
    rows = pages.withColumn("_segments", segments).withColumn("_template", F.lit(""))
    deepest = rows.agg(F.max(F.size("_segments"))).first()[0] or 0
    for level in range(deepest):
        segment = F.get("_segments", F.lit(level))
        if level and level % stored_levels == 0:
            rows = materialize(rows, "url_levels")
            busy = rows.filter(segment.isNotNull()).groupBy("_host", "_template").count().filter(F.col("count") >= min_pages)
            if busy.isEmpty():
                rest = F.array_join(F.slice("_segments", level + 1, deepest), "/")
                whole = F.when(segment.isNull(), F.col("_template")).otherwise(F.concat("_template", F.lit("/"), rest))
                rows = rows.withColumn("_template", whole)
                break
        children = rows.filter(segment.isNotNull()).groupBy("_host", "_template", segment.alias("_segment")).count()
        rare = F.col("count") * max_distinct_share <= 1
        nodes = children.filter(rare).groupBy("_host", "_template").agg(F.sum("count").alias("_pages"))
        # Stored, so that Catalyst knows its size and can split the join where a host is frequent.
        wild = nodes.filter(F.col("_pages") >= min_pages).select("_host", "_template", F.lit(True).alias("_wild"))
        wild = materialize(wild, "wild_nodes")
        kept = children.filter(~rare).join(wild, ["_host", "_template"], "left_semi")
        kept = materialize(kept.select("_host", "_template", "_segment", F.lit(True).alias("_kept")), "kept_children")
        rows = rows.withColumn("_segment", segment).join(wild, ["_host", "_template"], "left")
        rows = rows.join(kept, ["_host", "_template", "_segment"], "left")
        step = F.when(F.col("_wild") & F.col("_kept").isNull(), F.lit(WILD)).otherwise(F.col("_segment"))
        rows = rows.withColumn(
            "_template",
            F.when(F.col("_segment").isNull(), F.col("_template")).otherwise(F.concat("_template", F.lit("/"), step)),
        )
        rows = rows.drop("_wild", "_kept", "_segment")
    return rows.drop("_segments")


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    label_key: Column | None = None,
    label_id: str = "doc_id",
    bad_col: str = "bad",
    same_z: float = 1.96,
    prior_weight: float = 10.0,
    block_from: float = 0.5,
    **tree,
) -> DataFrame:
    """(id, host, path, rule, verdict, template, bad_share) for each row of ``pages``.

    A fitting rule decides (``matching_rule``). Otherwise the page's template does: templates of a
    host with as many segments are siblings, and those whose share of bad labels does not differ from
    the share of all siblings (two-proportion z below ``same_z``) are merged into one branch. The bad
    share of a branch is smoothed by ``prior_weight`` pages with the share of the whole table; from
    ``block_from`` on its pages are blocked. A branch without labels has no share and is allowed.

    ``labels`` holds ``label_id`` and a boolean ``bad_col``; a repeated id is bad if one of its rows
    is, and null ids or labels say nothing. ``label_key`` is the expression over ``pages`` that names
    the label of a page, its id by default. A null url, or one without ``://``, has an empty host and
    path and is judged like any other host; empty tables give no rows. Only urls are read. All counts
    are combined in the map tasks, so a host with a third of the pages is a few rows of each.
    """
    key = F.col(id_col) if label_key is None else label_key
    rows = pages.select(
        F.col(id_col).alias("_id"),
        key.alias("_label_key"),
        url_host(F.col(url_col)).alias("_host"),
        url_path(F.col(url_col)).alias("_path"),
    )
    known = labels.filter(F.col(label_id).isNotNull() & F.col(bad_col).isNotNull())
    known = known.groupBy(F.col(label_id).alias("_label_key")).agg(F.max(F.col(bad_col).cast("int")).alias("_bad"))
    placed = materialize(path_templates(rows, **tree), "url_templates")
    shape = F.size(F.split("_template", "/"))
    leaves = (
        placed.join(known, "_label_key", "left")
        .groupBy("_host", "_template")
        .agg(F.count("_bad").alias("_n"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("_b"))
        .withColumn("_shape", shape)
    )
    leaves = materialize(leaves, "url_leaves")
    siblings = leaves.groupBy("_host", "_shape").agg(F.sum("_n").alias("_sn"), F.sum("_b").alias("_sb"))
    total = leaves.agg(F.try_divide(F.sum("_b"), F.sum("_n")).alias("share")).select(F.coalesce("share", F.lit(0.0))).scalar()
    pooled = F.try_divide(F.col("_b") + F.col("_sb"), F.col("_n") + F.col("_sn"))
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), "_n") + F.try_divide(F.lit(1), "_sn")))
    apart = F.abs(F.try_divide("_b", "_n") - F.try_divide("_sb", "_sn")) >= same_z * error
    alone = F.coalesce((error > 0) & apart, F.lit(False))
    branches = (
        leaves.join(siblings, ["_host", "_shape"])
        .withColumn("_branch", F.when(alone, F.col("_template")).otherwise(F.concat(F.lit(_SEP), "_shape")))
        .select("_host", "_template", "_branch", "_n", "_b")
    )
    judged = branches.groupBy("_host", "_branch").agg(F.sum("_n").alias("_bn"), F.sum("_b").alias("_bb"))
    smoothed = (F.col("_bb") + prior_weight * total) / (F.col("_bn") + prior_weight)
    share = F.when(F.col("_bn") > 0, smoothed)
    verdicts = branches.join(judged, ["_host", "_branch"]).select("_host", "_template", share.alias("bad_share"))
    rule = matching_rule(F.col("_host"), F.col("_path"), rules)
    learned = F.when(F.col("bad_share") >= block_from, "block").otherwise("allow")
    return (
        placed.join(materialize(verdicts, "url_verdicts"), ["_host", "_template"], "left")
        .withColumn("_rule", rule)
        .select(
            F.col("_id").alias(id_col),
            F.col("_host").alias("host"),
            F.col("_path").alias("path"),
            F.col("_rule.pattern").alias("rule"),
            F.coalesce("_rule.verdict", learned).alias("verdict"),
            F.col("_template").alias("template"),
            "bad_share",
        )
    )
