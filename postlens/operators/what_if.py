"""Which one extra skill would raise the score of a request most."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..fixed_values import WHAT_IF_BEST, WHAT_IF_CANDIDATES, WHAT_IF_MIN_GAIN
from ..functions.money import round_money
from ..functions.ranking import missing_keys, ranked
from ..functions.skills import add_skill, owned_skills
from ..sources.shared import materialize


ORDERS = {"alphabetical": [("skill", False)], "importance": [("importance", True), ("skill", False)]}


def _scored(
    ready: DataFrame, scorer: Callable[[DataFrame], DataFrame], columns: list[str], score_col: str
) -> DataFrame:
    """``columns`` and ``_base_score``, with what the scorer keeps of a request for its additions."""
    kept = getattr(scorer, "kept", ())
    scored = scorer.prepared(ready) if kept else scorer(ready)
    return scored.select(*columns, *kept, F.col(score_col).alias("_base_score"))


def _gains(
    base: DataFrame, vocabulary: DataFrame, scorer: Callable[[DataFrame], DataFrame],
    min_gain: float, k: int, max_candidates: int, order: str, request_col: str, skills_col: str, score_col: str,
) -> DataFrame:
    """Best additions of requests that carry their score as ``_base_score``."""
    if order not in ORDERS:
        raise ValueError(f"order must be one of {sorted(ORDERS)}, got {order!r}")
    ranks = ranked(vocabulary, "skill", ORDERS[order]).select(F.col("skill").alias("_skill"), "rank")
    tried = missing_keys(base, ranks, request_col, skills_col, "_skill", max_candidates)
    if getattr(scorer, "kept", ()):
        scored = scorer.with_addition(tried, "_skill")
    else:
        scored = scorer(tried.withColumn(skills_col, add_skill(F.col(skills_col), F.col("_skill"))))
    boost = F.col(score_col) - F.col("_base_score")
    # Filtered by leaving out an array: as a plain filter, the optimizer would move the test below the
    # scorer's projection and have every candidate scored twice.
    enough = F.when(boost > min_gain, F.array(F.struct(boost.alias("boost"))))
    gains = scored.select(request_col, "_pos", F.col("_skill").alias("skill"), F.inline(enough))
    whole = gains.schema["boost"].dataType.typeName() in ("long", "integer")
    amount = F.col("boost") if whole else round_money(F.col("boost"))
    best = Window.partitionBy(request_col).orderBy(F.desc("boost_amount"), "_pos")
    return (
        gains.withColumn("boost_amount", amount)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select(request_col, F.col("rank").cast("bigint").alias("rank"), "skill", "boost_amount")
    )


def what_if(
    requests: DataFrame,
    vocabulary: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    min_gain: float = WHAT_IF_MIN_GAIN,
    k: int = WHAT_IF_BEST,
    max_candidates: int = WHAT_IF_CANDIDATES,
    order: str = "alphabetical",
    request_col: str = "request_id",
    skills_col: str = "skills",
    score_col: str = "prediction",
) -> DataFrame:
    """Best ``k`` single additions for each request: (request, rank, skill, boost_amount).

    ``vocabulary`` has a column ``skill`` and, for ``order="importance"``, a number ``importance``;
    skills whose importance is null or NaN are no candidates, and repeated skills are one. Of the
    skills a request lacks, the first ``max_candidates`` in that order are tried; this bound is part
    of the question asked, not a shortcut. ``scorer`` adds ``score_col`` and keeps the other columns; one
    that has ``kept``, as ``PayScorer``, scores additions from what it worked out once for the request.
    ``request_id`` must be unique.

    The request is scored once, then all its candidates, which carry the score along. Boosts up to
    ``min_gain`` are dropped and each task keeps its best ``k`` for a request before the shuffle.
    """
    columns = requests.columns
    ready = requests.withColumn(skills_col, owned_skills(requests, skills_col))
    base = _scored(ready, scorer, columns, score_col)
    return _gains(
        base, vocabulary, scorer, min_gain, k, max_candidates, order, request_col, skills_col, score_col
    )


def predict_with_boosts(
    requests: DataFrame,
    vocabulary: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    demand: Callable[[DataFrame], DataFrame],
    min_gain: float = WHAT_IF_MIN_GAIN,
    k: int = WHAT_IF_BEST,
    max_candidates: int = WHAT_IF_CANDIDATES,
    order: str = "alphabetical",
    request_col: str = "request_id",
    skills_col: str = "skills",
    score_col: str = "prediction",
) -> DataFrame:
    """The whole answer to each request: (request, predicted_salary, demand_score, boosts).

    ``boosts`` is an array of at most ``k`` (skill, boost_amount), best first and empty if no addition
    gains enough; see ``what_if`` for the candidates. ``demand`` adds ``demand_score``. Requests are
    scored once and stored; the boosts are found from the stored scores.
    """
    columns = requests.columns
    ready = demand(requests.withColumn(skills_col, owned_skills(requests, skills_col)))
    ready = ready.withColumnRenamed("demand_score", "_demand")
    base = materialize(_scored(ready, scorer, [*columns, "_demand"], score_col), "scored")
    gains = _gains(
        base.drop("_demand"), vocabulary, scorer, min_gain, k, max_candidates, order, request_col, skills_col, score_col
    )
    listed = F.array_sort(F.collect_list(F.struct("rank", "skill", "boost_amount")))
    boosts = gains.groupBy(F.col(request_col).alias("_asked")).agg(listed.alias("_listed"))
    kind = f"array<struct<skill:string,boost_amount:{gains.schema['boost_amount'].dataType.simpleString()}>>"
    pairs = F.transform("_listed", lambda x: F.struct(x["skill"].alias("skill"), x["boost_amount"].alias("boost_amount")))
    score = F.col("_base_score")
    whole = base.schema["_base_score"].dataType.typeName() in ("long", "integer")
    return base.join(boosts, F.col(request_col) == F.col("_asked"), "left").select(
        request_col,
        (score if whole else round_money(score)).alias("predicted_salary"),
        F.col("_demand").alias("demand_score"),
        F.coalesce(pairs, F.array().cast(kind)).alias("boosts"),
    )
