"""Sources mixed to target weights by pivotal rounding of the documents' copies."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import materialize
from .common import fraction

_WORD = r"[^\x20\x09-\x0D]+"
_UNIT = "_source string, _id bigint, _size bigint, _rows bigint, _p double, _copies bigint, _open boolean"


def word_count(text: Column) -> Column:
    """Runs of other than the six ASCII white space characters; 0 for null."""
    squeezed = F.btrim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "), F.lit(" "))
    spaces = F.char_length(squeezed) - F.char_length(F.replace(squeezed, F.lit(" "), F.lit("")))
    return F.coalesce(F.when(squeezed == "", 0).otherwise(spaces + 1), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources take the ``weights`` in turn, in code point order with null last. Together they aim at
    ``share`` times all sizes, by weight; no target passes ``most`` times its source's size, and what
    is cut off goes to the others by weight, until none is above. That is one level L with
    target = min(most * size, L * weight): sorted by the level at which a source is full, L follows
    from running sums. One row per source passes through one task.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn(
        "_w", F.get(turn, ((F.row_number().over(order) - 1) % len(weights)).cast("int"))
    ).withColumn("_cap", F.col("source_size") * float(most))
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # Level if exactly the sources before this one are full.
    level = (
        F.sum("source_size").over(everything) * float(share) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    ) / F.sum("_w").over(rest)
    levels = ranked.withColumn("_level", level)
    # It rises from source to source as long as they are full below it, and then falls: its peak is L.
    final = F.max("_level").over(everything)
    return levels.withColumn("_final", final).select(
        "source",
        "source_size",
        F.least("_cap", F.col("_final") * F.col("_w")).alias("target"),
    )


def pivotal(p: np.ndarray, weight: np.ndarray, chance: np.ndarray) -> tuple[np.ndarray, int]:
    """Rounds ``p`` to 0 and 1 by pairs, and returns it with the place of the one left open, or -1.

    Two open units trade mass so that ``sum(p * weight)`` stays, until one of them is 0 or 1; which
    of the two ways it goes is drawn so that each keeps its expectation.
    """
    p, weight, chance = p.tolist(), weight.tolist(), chance.tolist()
    held = -1
    for i, share in enumerate(p):
        if not 0.0 < share < 1.0:
            continue
        if held < 0:
            held = i
            continue
        first, wa, wb = p[held], weight[held], weight[i]
        grow, shrink = wa * (1.0 - first), wb * share
        lose, gain = wa * first, wb * (1.0 - share)
        up, down = min(grow, shrink), min(lose, gain)
        if chance[i] * (up + down) < down:  # mass moves to the held one
            if grow <= shrink:
                p[held], p[i], held = 1.0, min(1.0, max(0.0, share - up / wb)), i
            else:
                p[held], p[i] = min(1.0, first + up / wa), 0.0
        elif lose <= gain:
            p[held], p[i], held = 0.0, min(1.0, share + down / wb), i
        else:
            p[held], p[i] = max(0.0, first - down / wa), 1.0
        if not 0.0 < p[held] < 1.0:
            held = -1
    return np.array(p), held


def _round_group(seed: int, last: bool):
    def work(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_id", "_size"], na_position="first", kind="mergesort").reset_index(drop=True)
        salt = f"{seed}/{int(last)}/{len(group)}"
        keys = group["_id"].astype("object").where(group["_id"].notna(), "null").astype(str) + "/" + salt
        draws = np.array([xxhash.xxh3_64_intdigest(x) for x in keys], dtype=np.uint64)
        weight = (group["_size"] * group["_rows"]).to_numpy(np.float64)
        p = group["_p"].to_numpy(np.float64)
        rounded, held = pivotal(np.where(weight > 0, p, 0.0), np.maximum(weight, 1.0), fraction(draws))
        if last and held >= 0:
            rounded[held], held = float(rounded[held] >= 0.5), -1
        group["_open"] = False
        if held >= 0:
            group.loc[held, "_open"] = True
        group["_p"] = rounded
        group["_copies"] = group["_copies"] + np.where(group["_open"], 0, np.round(rounded)).astype(np.int64)
        return group[["_source", "_id", "_size", "_rows", "_p", "_copies", "_open"]]

    return work


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 17,
    bucket_rows: int = 2_000,
    fan_in: int = 256,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) for each row of ``docs``.

    A document of a source asks for target / source_size copies: the whole part is taken, the rest is
    a probability. Inside buckets of about ``bucket_rows`` documents of one source, pivotal rounding
    settles all but at most one document while the words taken stay the same; the open ones of
    ``fan_in`` buckets meet in the next round, until one is left, which goes to the nearer side. A
    source therefore misses its target by half a document at most, and no document is taken more than
    ``most`` times, rounded up. Draws are hashes of the ids, so reruns agree however the table is partitioned.

    Null text has size 0; documents of size 0 take the whole part of their copies, which are 0 words.
    Null sources are one source. Rows equal in id, source and size are settled together and get equal
    copies; a null id is an id like any other. An empty table gives no rows. Sources are dealt over
    as many buckets as their rows ask for, so a large one is many tasks.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("_id"),
        F.col(source_col).cast("string").alias("_source"),
        word_count(F.col(text_col)).alias("_size"),
    )
    units = rows.groupBy("_source", "_id", "_size").agg(F.count("*").alias("_rows"))
    units = materialize(units, "mix_units", rows=docs.count())
    n_units = units.count()
    per_source = units.groupBy("_source").agg(
        F.sum(F.col("_size") * F.col("_rows")).alias("source_size"), F.count("*").alias("_units")
    )
    sums = materialize(per_source, "mix_sources", rows=n_units)
    targets = source_targets(sums.select(F.col("_source").alias("source"), "source_size"), weights, share, most)
    targets = materialize(
        targets.join(sums.select(F.col("_source").alias("_s"), "_units"), F.col("source").eqNullSafe(F.col("_s")))
        .select(
            F.col("source").alias("_s"),
            "source_size",
            "target",
            F.ceil(F.col("_units") / bucket_rows).cast("bigint").alias("_buckets"),
            F.coalesce(F.col("target") / F.nullif("source_size", F.lit(0)), F.lit(0.0)).alias("_rate"),
        ),
        "mix_targets",
        rows=n_units,
    )
    placed = units.join(targets, F.col("_source").eqNullSafe(F.col("_s"))).select(
        "_source", "_id", "_size", "_rows",
        (F.col("_rate") - F.floor("_rate")).alias("_p"),
        F.floor("_rate").cast("bigint").alias("_copies"),
        F.lit(True).alias("_open"),
        F.pmod(F.xxhash64("_id", "_size"), F.col("_buckets")).alias("_bucket"),
    )
    most_buckets = sums.agg(F.max(F.ceil(F.col("_units") / bucket_rows))).first()[0] or 1
    settled, level, buckets = [], 0, int(most_buckets)
    while True:
        last = buckets <= 1
        done = materialize(
            placed.groupBy("_source", "_bucket").applyInPandas(_round_group(seed + level, last), _UNIT), "mix_round", rows=n_units
        )
        settled.append(done.filter(~F.col("_open")))
        if last:
            break
        level += 1
        # Units whose size is 0 never stay open, so each open one carries its source's residual.
        buckets = -(-buckets // fan_in)
        placed = done.filter("_open").withColumn("_bucket", F.pmod(F.xxhash64("_id", "_size"), F.lit(buckets)))
    decided = settled[0]
    for more in settled[1:]:
        decided = decided.unionByName(more)
    return (
        decided.join(targets, F.col("_source").eqNullSafe(F.col("_s")))
        .withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("_rows"))))
        .select(
            F.col("_id").alias(id_col),
            F.col("_source").alias("source"),
            F.col("_size").alias("size"),
            "source_size",
            "target",
            F.col("_copies").alias("copies"),
            (F.col("_copies") * F.col("_size")).alias("taken"),
        )
    )
