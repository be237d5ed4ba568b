"""Ranks of a table's rows, and the first ranks that a list lacks."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialize


def ranked(table: DataFrame, key: str, order: list[tuple[str, bool]], carry: list[str] | None = None) -> DataFrame:
    """(key, ``carry``, rank) with ranks from 1 on, for the distinct keys of ``table``.

    ``order`` lists (column, descending). Rows without a key, or whose ordering columns are null or
    NaN, have no rank; of rows that repeat a key the first in the order counts. The table is sorted in
    ranges, each numbered by its own task; only one count per range passes through a single task.
    """
    names = list(dict.fromkeys([key, *[x for x, _ in order], *(carry or [])]))
    usable = F.col(key).isNotNull()
    for name, _ in order:
        kind = table.schema[name].dataType.typeName()
        usable = usable & F.col(name).isNotNull() & (~F.isnan(name) if kind in ("double", "float") else F.lit(True))
    keys = [F.desc(x) if down else F.asc(x) for x, down in order]
    first = F.row_number().over(Window.partitionBy(key).orderBy(*keys, *[F.col(x) for x in names]))
    rows = table.filter(usable).select(*names).withColumn("_n", first).filter(F.col("_n") == 1).drop("_n")
    parts = rows.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id())
    # Stored, since another run could cut the ranges elsewhere.
    parts = materialize(parts, "ranges")
    counts = parts.groupBy("_part").agg(F.count("*").alias("_c"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*keys, key))
    placed = parts.withColumn("_own", own).join(starts, "_part")
    rank = (F.col("_start") + F.col("_own")).cast("int").alias("rank")
    return materialize(placed.select(*names, rank), "ranked")


# Up to so many ranks, the ranked keys travel inside the plan and nothing is shuffled.
FEW_RANKS = 1000


def _few_names(ranks: DataFrame, key: str, few: int) -> Column | None:
    """All ranked keys in their order as a constant, if they are text and ``few`` at most."""
    listed = ranks.select(key, "rank").orderBy("rank").limit(few + 1).collect()
    if len(listed) > few or ranks.schema[key].dataType.typeName() != "string":
        return None
    return F.from_json(F.lit(json.dumps([r[0] for r in listed])), "array<string>")


def missing_keys(
    people: DataFrame, ranks: DataFrame, id_col: str, own: str, key: str, n: int, few: int = FEW_RANKS
) -> DataFrame:
    """A row for each of the first ``n`` ranked keys that a person lacks: ``people`` with ``_pos``, its
    place among them from 0 on, and ``key``.

    ``ranks`` are those of ``ranked``. A short list is a constant, so keys come straight from it; a longer
    one is joined for the ranks and again for their names, see ``with_missing_ranks``.
    """
    names = _few_names(ranks, key, few)
    if names is not None:
        lacked = F.slice(F.array_except(names, own), 1, n)
        return people.select("*", F.posexplode(lacked).alias("_pos", key))
    lacked = _with_joined_ranks(people, ranks, id_col, own, key, n)
    each = lacked.select(*people.columns, F.posexplode("_missing").alias("_pos", "rank"))
    return each.join(ranks.select(key, "rank"), "rank").drop("rank")


def with_missing_ranks(
    people: DataFrame, ranks: DataFrame, id_col: str, own: str, key: str, n: int, few: int = FEW_RANKS
) -> DataFrame:
    """``people`` with ``_missing``: the first ``n`` ranks that none of their ``own`` keys has.

    A short list of ``few`` ranked keys at most is a constant of the plan, and each person's answer comes
    from two array functions. A longer one is joined: someone with m ranked keys finds their answer within the first n + m ranks, and keys without a
    rank do not lengthen it. Lists of ranks are as long as one person's list; ranks beyond the table
    are left to the join that turns them into names. ``id_col`` must be unique.
    """
    names = _few_names(ranks, key, few)
    if names is not None:
        lacked = F.slice(F.array_except(names, own), 1, n)
        return people.withColumn("_missing", F.transform(lacked, lambda x: F.array_position(names, x).cast("int")))
    return _with_joined_ranks(people, ranks, id_col, own, key, n)


def _with_joined_ranks(people: DataFrame, ranks: DataFrame, id_col: str, own: str, key: str, n: int) -> DataFrame:
    held = people.select(id_col, F.explode(F.array_distinct(own)).alias(key)).join(ranks.select(key, "rank"), key)
    lists = held.groupBy(F.col(id_col).alias("_holder")).agg(F.collect_set("rank").alias("_ranks"))
    have = F.coalesce("_ranks", F.array().cast("array<int>"))
    missing = F.slice(F.array_except(F.sequence(F.lit(1), F.size(have) + n), have), 1, n)
    joined = people.join(lists, F.col(id_col) == F.col("_holder"), "left")
    return joined.withColumn("_missing", missing).drop("_holder", "_ranks")
