"""Pay and demand statistics.

Every result is one grouped aggregation of the same additive columns (``_tally``). Spark combines
them inside each map task before the shuffle, so a key that holds a third of all postings sends no
more rows than any other key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from ..fixed_values import BAND_CUTS, BAND_LABELS, REMOTE, TOP_SKILLS
from ..functions.bands import band, band_rank
from ..functions.money import mean_money, money_sums, share
from ..schema import COLUMNS, Columns

_ROWS, _IDS, _REMOTE = "n_rows", "n_ids", "n_remote"


def _tally(grouped: GroupedData, amount: Column, has_id: Column, remote: Column) -> DataFrame:
    return grouped.agg(
        F.count(F.lit(1)).alias(_ROWS),
        F.count_if(has_id).alias(_IDS),
        F.count_if(remote).alias(_REMOTE),
        *money_sums(amount),
    )


def _tally_by(df: DataFrame, keys: Sequence[str], c: Columns, measure: str | None = None, remote: str = REMOTE) -> DataFrame:
    return _tally(
        df.groupBy(*keys), F.col(measure or c.salary), F.col(c.job_id).isNotNull(), F.col(c.job_type) == remote
    )


# ---- from a tally to the five results -------------------------------------------------------


def _overall(tally: DataFrame) -> DataFrame:
    return tally.select(
        F.col(_ROWS).alias("total_jobs"),
        mean_money().alias("average_salary"),
        F.coalesce(share(F.col(_REMOTE), F.col(_ROWS)), F.lit(0.0)).alias("remote_percentage"),
    )


def _groups(tally: DataFrame, keys: Sequence[str]) -> DataFrame:
    return tally.select(*keys, mean_money().alias("avg_salary"), F.col(_IDS).alias("job_count")).orderBy(*keys)


def _skills(tally: DataFrame) -> DataFrame:
    return tally.select("skill", F.col(_IDS).alias("frequency"), mean_money().alias("avg_salary")).orderBy(
        F.desc("frequency"), "skill"
    )


def _industries(tally: DataFrame, industry: str) -> DataFrame:
    return tally.select(
        industry,
        F.col(_IDS).alias("job_count"),
        mean_money().alias("avg_salary"),
        share(F.col(_REMOTE), F.col(_IDS)).alias("remote_percentage"),
    ).orderBy(F.desc("job_count"), industry)


def _bands(counts: DataFrame, labels: Sequence[str], fill: bool) -> DataFrame:
    if fill:
        names = F.array(*[F.lit(x) for x in labels])
        empty = counts.sparkSession.range(1).select(F.explode(names).alias("salary_band"), F.lit(0).alias("count"))
        counts = counts.unionByName(empty).groupBy("salary_band").agg(F.sum("count").alias("count"))
    return counts.orderBy(band_rank(F.col("salary_band"), labels), "salary_band")


# ---- one result each -------------------------------------------------------------------------


def overall_stats(df: DataFrame, c: Columns = COLUMNS, remote: str = REMOTE) -> DataFrame:
    """One row: postings, mean salary (null if none) and remote share (0 if none)."""
    return _overall(_tally_by(df, [], c, remote=remote))


def group_stats(
    df: DataFrame, keys: Sequence[str], measure: str | None = None, c: Columns = COLUMNS
) -> DataFrame:
    """Mean of ``measure`` and number of non-null ids for each group, in key order."""
    return _groups(_tally_by(df, keys, c, measure), keys)


def salary_by_title_exp(df: DataFrame, c: Columns = COLUMNS) -> DataFrame:
    return group_stats(df, (c.title, c.level), c=c)


def skill_stats(df: DataFrame, c: Columns = COLUMNS) -> DataFrame:
    """Popularity and mean salary of each skill, most frequent first, equal ones by name."""
    listed = df.select(c.job_id, c.job_type, c.salary, F.explode(c.skills).alias("skill"))
    return _skills(_tally_by(listed, ["skill"], c))


def top_skills(df: DataFrame, n: int = TOP_SKILLS, c: Columns = COLUMNS) -> DataFrame:
    return skill_stats(df, c).limit(n)


def industry_metrics(df: DataFrame, c: Columns = COLUMNS, remote: str = REMOTE) -> DataFrame:
    """Postings, mean salary and remote share of each industry, largest first."""
    return _industries(_tally_by(df, [c.industry], c, remote=remote), c.industry)


def with_band(
    df: DataFrame,
    col: str = "salary",
    cuts: Sequence[float] = BAND_CUTS,
    labels: Sequence[str] = BAND_LABELS,
    out: str = "salary_band",
) -> DataFrame:
    return df.withColumn(out, band(F.col(col), cuts, labels))


def salary_distribution(
    df: DataFrame,
    cuts: Sequence[float] = BAND_CUTS,
    labels: Sequence[str] = BAND_LABELS,
    fill: bool = False,
    c: Columns = COLUMNS,
) -> DataFrame:
    """Postings for each band in band order; bands without postings appear only with ``fill``."""
    counts = with_band(df, c.salary, cuts, labels).groupBy("salary_band").agg(F.count(F.lit(1)).alias("count"))
    return _bands(counts, labels, fill)


# ---- all five from one scan ------------------------------------------------------------------

_OVERALL, _TITLE, _INDUSTRY, _BAND, _SKILL = range(5)
# All other columns of a tally add up.
TALLY_KEYS = ("result", "key", "key2")


def market_tally(
    df: DataFrame,
    cuts: Sequence[float] = BAND_CUTS,
    labels: Sequence[str] = BAND_LABELS,
    c: Columns = COLUMNS,
    remote: str = REMOTE,
) -> DataFrame:
    """Long table that holds all five statistics, from one scan and one shuffle.

    A posting yields one row for each statistic it counts in, told apart by their position. All of
    it is combined in the map task, so what is shuffled grows with the number of distinct keys and
    not with the postings. Store the result, then read it with ``results_from_tally``.
    """
    keys = F.concat(
        F.array(
            F.lit(None).cast("string"),
            F.col(c.title).cast("string"),
            F.col(c.industry).cast("string"),
            band(F.col(c.salary), cuts, labels),
        ),
        F.coalesce(c.skills, F.array().cast("array<string>")),
    )
    slots = df.select(
        F.posexplode(keys).alias("pos", "key"),
        c.level,
        F.col(c.salary).alias("amount"),
        F.col(c.job_id).isNotNull().alias("has_id"),
        (F.col(c.job_type) == remote).alias("remote"),
    ).select(
        F.least("pos", F.lit(_SKILL)).alias("result"),
        "key",
        F.when(F.col("pos") == _TITLE, F.col(c.level)).alias("key2"),
        "amount",
        "has_id",
        "remote",
    )
    return _tally(slots.groupBy(*TALLY_KEYS), F.col("amount"), F.col("has_id"), F.col("remote"))


def results_from_tally(
    tally: DataFrame, labels: Sequence[str] = BAND_LABELS, fill: bool = False, c: Columns = COLUMNS
) -> dict[str, DataFrame]:
    """The five results by name, equal to those of the single operators."""

    def part(result: int) -> DataFrame:
        return tally.filter(F.col("result") == result)

    # The overall row is summed once more, so that no postings still give one row.
    columns = [x for x in tally.columns if x not in TALLY_KEYS]
    sums = [F.sum(x).alias(x) for x in columns]
    overall = part(_OVERALL).agg(*sums).fillna(0, subset=[_ROWS, _IDS, _REMOTE, "pay_n", "pay_odd"])
    bands = part(_BAND).select(F.col("key").alias("salary_band"), F.col(_ROWS).alias("count"))
    return {
        "overall_stats": _overall(overall),
        "salary_by_title_exp": _groups(
            part(_TITLE).withColumnsRenamed({"key": c.title, "key2": c.level}), (c.title, c.level)
        ),
        "skills_analysis": _skills(part(_SKILL).withColumnRenamed("key", "skill")),
        "industry_metrics": _industries(part(_INDUSTRY).withColumnRenamed("key", c.industry), c.industry),
        "salary_distribution": _bands(bands, labels, fill),
    }
