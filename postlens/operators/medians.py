"""Exact medians of groups of any size, by histograms that are refined around the middle.

Sorting a group, or holding its values, takes a task that grows with the group. Here every round counts
the values of all groups in bins between bounds, combined in the map tasks, and keeps the bin that
holds the middle, until it is a single value. A group that holds a third of all rows costs no more
than another: a few thousand counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import COLUMNS
from ..sources.shared import materialize

_EXACT = "decimal(28,6)"


def group_medians(
    df: DataFrame, keys: Sequence[str], measure: str = COLUMNS.salary, out: str = "median", bins: int = 4096
) -> DataFrame:
    """(keys, ``out``, n): the median of ``measure`` in each group and the number of its values.

    Values count in millionths, below 4e12; null, NaN and larger ones are left out, and a group with no
    value has no row. The median of an even number is the mean of the middle two. Null keys are a group.
    ``df`` is read once for each round, about four for amounts of money, so store it first.
    """
    exact = F.col(measure).try_cast(_EXACT)
    whole = F.when(F.abs(exact) < F.lit(4e12).cast(_EXACT), (exact * 1_000_000).cast("decimal(38,0)").cast("bigint"))
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    ks = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*named, whole.alias("_v")).filter(F.col("_v").isNotNull())
    # One search for each of the two middle ranks; of an odd number they are the same.
    sizes = rows.groupBy(*ks).agg(F.count("*").alias("n"), F.min("_v").alias("a"), F.max("_v").alias("b"))
    half = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    ranks = F.array(*[F.struct(F.lit(i).alias("side"), h.cast("bigint").alias("rank")) for i, h in enumerate(half)])
    state = materialize(sizes.select(*ks, "n", "a", "b", F.inline(ranks)), "median_bounds")
    while state.filter("a < b").limit(1).count():
        open_ = state.filter("a < b").select(*[F.col(k).alias(f"{k}_o") for k in ks], "side", "a", "b", "rank")
        same = F.lit(True)
        for k in ks:
            same = same & F.col(k).eqNullSafe(F.col(f"{k}_o"))
        width = F.expr(f"(b - a) div {bins} + 1")
        inside = rows.join(open_, same & F.col("_v").between(F.col("a"), F.col("b")))
        counts = inside.groupBy(*ks, "side", "a", "b", "rank", F.expr(f"(_v - a) div ((b - a) div {bins} + 1)").alias("bin")).agg(
            F.count("*").alias("c")
        )
        upto = F.sum("c").over(Window.partitionBy(*ks, "side").orderBy("bin"))
        first = F.col("a") + F.col("bin") * width
        # The bin where the running count passes the rank; the rank goes on inside it.
        found = counts.withColumn("upto", upto).filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("c")))
        found = found.select(
            *[F.col(k).alias(f"{k}_o") for k in ks],
            F.col("side").alias("side_o"),
            first.alias("a_o"),
            F.least(F.col("b"), first + width - 1).alias("b_o"),
            (F.col("rank") - F.col("upto") + F.col("c")).alias("rank_o"),
        )
        joined = state.join(found, same & (F.col("side") == F.col("side_o")), "left")
        state = materialize(
            joined.select(*ks, "n", *[F.coalesce(f"{x}_o", x).alias(x) for x in ("a", "b")], "side", F.coalesce("rank_o", "rank").alias("rank")),
            "median_bounds",
        )
    both = state.groupBy(*ks).agg(F.first("n").alias("n"), F.sum("a").alias("s"))
    return both.select(*[F.col(k).alias(name) for k, name in zip(ks, keys)], (F.col("s") / F.lit(2_000_000.0)).alias(out), "n")
