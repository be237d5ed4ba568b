"""Quality of predictions, each in one pass over (label, prediction)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import DEMAND_LABELS

_DIGITS = 6


# Labels and predictions in millionths.
_EXACT, _WHOLE, _SUM = "decimal(19,6)", "decimal(19,0)", "decimal(38,0)"


def regression_report(df: DataFrame, label: str = "label", pred: str = "prediction", digits: int | None = _DIGITS) -> DataFrame:
    """One row (n, r2, mae) over the rows that have both values.

    Values count in whole millionths, below 1e13; with larger ones, or NaN, both numbers are NaN. All sums
    are exact, so the numbers are the same on one partition and on a thousand, to the last bit if
    ``digits`` is None. A constant label gives r2 1 if every prediction is exact, else 0.
    """

    def millionths(col: str):
        return (F.col(col).try_cast(_EXACT) * 1_000_000).try_cast(_WHOLE)

    def square(x):
        return (x * x).cast(_SUM)

    rows = df.filter(F.col(label).isNotNull() & F.col(pred).isNotNull()).select(millionths(label).alias("y"), millionths(pred).alias("p"))
    sums = rows.select("y", (F.col("y") - F.col("p")).cast(_WHOLE).alias("miss")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("miss").isNull()).alias("odd"),
        F.sum(square(F.col("miss"))).alias("missed"),
        F.sum(F.abs("miss")).cast(_SUM).alias("away"),
        F.sum("y").cast(_SUM).alias("total"),
        F.sum(square(F.col("y"))).alias("squares"),
    )
    # Squares around the whole part of the mean are exact, and so is what that part leaves of the sum:
    # nothing large is subtracted from something as large in doubles.
    mean = F.expr("total div n").cast(_WHOLE)
    count = F.col("n").cast(_WHOLE)
    around = (F.col("squares") - (mean * F.col("total")).cast(_SUM) * 2 + (mean * mean).cast(_SUM) * count).cast(_SUM)
    rest = (F.col("total") - (mean * count).cast(_SUM)).cast("double")
    spread = around.cast("double") - rest * rest / F.col("n")
    r2 = F.when(spread > 0, 1 - F.col("missed").cast("double") / spread).otherwise(F.when(F.col("missed") == 0, 1.0).otherwise(0.0))
    mae = F.col("away").cast("double") / 1e6 / F.col("n")

    def shown(x):
        x = F.when(F.col("odd") > 0, F.lit(float("nan"))).when(F.col("n") > 0, x)
        return x if digits is None else F.round(x, digits)

    return sums.select("n", shown(r2).alias("r2"), shown(mae).alias("mae"))


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """One row (n, accuracy) over the rows that have a label."""
    hit = F.coalesce(F.col(label) == F.col(pred), F.lit(False)).cast("double")
    rows = df.filter(F.col(label).isNotNull())
    return rows.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(hit), _DIGITS).alias("accuracy"))


def classification_report(
    df: DataFrame, label: str = "label", pred: str = "prediction", classes: Sequence[str] = DEMAND_LABELS
) -> DataFrame:
    """Rows (class, precision, recall, f1_score, support): one for each class, then ``accuracy``
    (in f1_score, as it is printed), ``macro avg`` and ``weighted avg``.

    The rows are first counted by (label, prediction); all that follows works on those few counts.
    A class listed in ``classes`` appears even without rows. Zero denominators give 0. A row without a
    prediction counts as a miss of its label.
    """
    counts = (
        df.filter(F.col(label).isNotNull())
        .groupBy(F.col(label).alias("y"), F.col(pred).alias("p"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    zero = F.lit(0).cast("bigint")

    def seen(name, true, predicted, hit):
        return F.struct(name.alias("class"), true.alias("support"), predicted.alias("predicted"), hit.alias("hit"))

    n = F.col("n")
    sides = counts.select(
        F.explode(
            F.array(
                seen(F.col("y"), n, zero, F.when(F.col("y") == F.col("p"), n).otherwise(zero)),
                seen(F.col("p"), zero, n, zero),
            )
        ).alias("s")
    ).select("s.*").filter(F.col("class").isNotNull())
    listed = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(x) for x in classes])).alias("class"),
        zero.alias("support"),
        zero.alias("predicted"),
        zero.alias("hit"),
    )
    totals = (
        sides.unionByName(listed)
        .groupBy("class")
        .agg(*[F.sum(x).alias(x) for x in ("support", "predicted", "hit")])
    )
    hit = F.col("hit").cast("double")
    none = F.lit(0.0)
    per_class = totals.withColumns(
        {
            "precision": F.coalesce(F.try_divide(hit, F.col("predicted")), none),
            "recall": F.coalesce(F.try_divide(hit, F.col("support")), none),
            "f1_score": F.coalesce(F.try_divide(2 * hit, F.col("predicted") + F.col("support")), none),
        }
    )
    names = ("precision", "recall", "f1_score")
    weighted = [
        F.coalesce(F.try_divide(F.sum(F.col(x) * F.col("support")), F.sum("support")), none).alias(f"w_{x}")
        for x in names
    ]
    both = per_class.groupingSets([["class"], []], "class").agg(
        F.grouping("class").alias("all"),
        *[F.avg(x).alias(x) for x in names],
        *weighted,
        F.sum("support").alias("support"),
        F.coalesce(F.try_divide(F.sum(hit), F.sum("support")), none).alias("accuracy"),
    )

    def row(name, precision, recall, f1):
        values = [F.round(x, _DIGITS).alias(y) for x, y in zip((precision, recall, f1), names)]
        return F.struct(name.alias("class"), *values, F.col("support").alias("support"))

    unset = F.lit(None).cast("double")
    summary = F.array(
        row(F.lit("accuracy"), unset, unset, F.col("accuracy")),
        row(F.lit("macro avg"), *[F.col(x) for x in names]),
        row(F.lit("weighted avg"), *[F.col(f"w_{x}") for x in names]),
    )
    single = F.array(row(F.col("class"), *[F.col(x) for x in names]))
    return both.select(F.explode(F.when(F.col("all") == 1, summary).otherwise(single)).alias("r")).select("r.*")
