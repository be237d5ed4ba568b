"""Scores from explicit rules: demand points and expected pay."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.skills import has_any
from ..schema import COLUMNS, Columns


@dataclass(frozen=True)
class DemandRules:
    hot_skills: Sequence[str] = V.HOT_SKILLS
    levels: Sequence[str] = V.BUSY_LEVELS
    industries: Sequence[str] = V.BUSY_INDUSTRIES
    high_from: int = V.HIGH_FROM
    medium_from: int = V.MEDIUM_FROM
    remote: str = V.REMOTE
    remote_points: int = V.REMOTE_POINTS
    hot_skill_points: int = V.HOT_SKILL_POINTS
    level_points: int = V.LEVEL_POINTS
    industry_points: int = V.INDUSTRY_POINTS
    labels: Sequence[str] = V.DEMAND_LABELS


@dataclass(frozen=True)
class PayRules:
    """``base`` may be a dict or, for a long list of titles, a DataFrame (title, base_pay); of rows that
    repeat a title the highest pay counts."""

    base: Mapping[str, int] | DataFrame = field(default_factory=lambda: V.BASE_PAY)
    level_percent: Mapping[str, int] = field(default_factory=lambda: V.LEVEL_PERCENT)
    type_step: Mapping[str, int] = field(default_factory=lambda: V.JOB_TYPE_STEP)
    tiers: Sequence[tuple[int, Sequence[str]]] = V.SKILL_TIERS
    floor: int = V.PAY_FLOOR


def _points(test: Column, n: int) -> Column:
    return F.when(test, n).otherwise(0)


def _look_up(table: Mapping[str, int], key: Column) -> Column:
    """Value for ``key`` as bigint, null if it is not in the table."""
    out = F.lit(None).cast("bigint")
    for name, value in reversed(list(table.items())):
        out = F.when(key == name, F.lit(value).cast("bigint")).otherwise(out)
    return out


def with_demand(
    df: DataFrame, rules: DemandRules = DemandRules(), out: str = "demand_score", c: Columns = COLUMNS
) -> DataFrame:
    """High, Medium or Low from points for remote work, hot skills, level and industry."""
    points = (
        _points(F.col(c.job_type) == rules.remote, rules.remote_points)
        + _points(has_any(F.col(c.skills), rules.hot_skills), rules.hot_skill_points)
        + _points(F.col(c.level).isin(*rules.levels), rules.level_points)
        + _points(F.col(c.industry).isin(*rules.industries), rules.industry_points)
    )
    low, medium, high = rules.labels
    label = F.when(points >= rules.high_from, high).when(points >= rules.medium_from, medium).otherwise(low)
    return df.withColumn(out, label)


def _worth(skill: Column, tiers: Sequence[tuple[int, Sequence[str]]]) -> Column:
    out = F.lit(0).cast("bigint")
    for amount, names in reversed(tiers):
        out = F.when(skill.isin(*names), F.lit(amount).cast("bigint")).otherwise(out)
    return out


def _premium(skills: Column, tiers: Sequence[tuple[int, Sequence[str]]]) -> Column:
    total = F.aggregate(skills, F.lit(0).cast("bigint"), lambda acc, x: acc + _worth(x, tiers))
    return F.coalesce(total, F.lit(0).cast("bigint"))


def with_skill_premium(
    df: DataFrame,
    tiers: Sequence[tuple[int, Sequence[str]]] = V.SKILL_TIERS,
    out: str = "skill_premium",
    c: Columns = COLUMNS,
) -> DataFrame:
    """Sum over the skill list; the first tier that names a skill counts, repeats count again."""
    return df.withColumn(out, _premium(F.col(c.skills), tiers))


def _pay_parts(df: DataFrame, rules: PayRules, c: Columns) -> tuple[DataFrame, Column, Column]:
    """``df``, perhaps with more columns, with the pay for title and level, times 100, and what is added to it."""
    if isinstance(rules.base, DataFrame):
        title, pay = rules.base.columns
        table = rules.base.groupBy(F.col(title).alias("_rule_title")).agg(F.max(pay).cast("bigint").alias("_rule_pay"))
        df = df.join(table, F.col(c.title) == F.col("_rule_title"), "left")
        base = F.col("_rule_pay")
    else:
        base = _look_up(rules.base, F.col(c.title))
    scaled = base * _look_up(rules.level_percent, F.col(c.level))
    step = F.coalesce(_look_up(rules.type_step, F.col(c.job_type)), F.lit(0).cast("bigint"))
    return df, scaled, _premium(F.col(c.skills), rules.tiers) + step


def _pay(scaled: Column, added: Column, rules: PayRules) -> Column:
    # In hundredths until the rounding, so that a percentage leaves no fraction.
    hundredths = scaled + added * 100
    nearest = (F.bround(hundredths, -4) / 100).cast("bigint")
    # greatest() skips nulls: without the test an unknown title would score the floor. The test reads
    # the look-ups alone, since Spark would work out the premium once more for each mention of it.
    return F.when(scaled.isNotNull(), F.greatest(nearest, F.lit(rules.floor).cast("bigint")))


def with_expected_salary(
    df: DataFrame, rules: PayRules = PayRules(), out: str = "expected_salary", c: Columns = COLUMNS
) -> DataFrame:
    """Base pay x level percent + skill premium + job-type step, to the nearest 100 (halves to
    even), at least ``floor``. Whole numbers throughout. Null for a title or level without a rule."""
    df, scaled, added = _pay_parts(df, rules, c)
    return df.withColumn(out, _pay(scaled, added, rules)).drop("_rule_title", "_rule_pay")


@dataclass(frozen=True)
class PayScorer:
    """The pay rules as a scorer for ``what_if``.

    A premium is a sum over the skill list, so ``prepared`` works it out once for a request, in the columns
    ``kept``, and ``with_addition`` scores the request with one more skill from them.
    """

    rules: PayRules
    out: str
    c: Columns
    kept: Sequence[str] = ("_pay_scaled", "_pay_added")

    def __call__(self, df: DataFrame) -> DataFrame:
        return with_expected_salary(df, self.rules, self.out, self.c)

    def prepared(self, df: DataFrame) -> DataFrame:
        df, *parts = _pay_parts(df, self.rules, self.c)
        df = df.withColumns(dict(zip(self.kept, parts))).drop("_rule_title", "_rule_pay")
        return df.withColumn(self.out, _pay(*map(F.col, self.kept), self.rules))

    def with_addition(self, df: DataFrame, skill: str) -> DataFrame:
        scaled, added = map(F.col, self.kept)
        return df.withColumn(self.out, _pay(scaled, added + _worth(F.col(skill), self.rules.tiers), self.rules))


def pay_scorer(rules: PayRules = PayRules(), out: str = "prediction", c: Columns = COLUMNS) -> PayScorer:
    """The pay rules as a scorer for ``what_if``."""
    return PayScorer(rules, out, c)
