"""Drop postings that cannot be analysed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import COLUMNS, Columns


def _typed(df: DataFrame, c: Columns) -> DataFrame:
    # Cast before the null test: text that is no number then counts as a missing salary. Already
    # numeric columns keep their plain reference, so the null test still reaches the Parquet scan.
    if df.schema[c.salary].dataType.typeName() == "double":
        return df
    return df.withColumn(c.salary, F.col(c.salary).try_cast("double"))


def _usable(c: Columns, required: Sequence[str]) -> Column:
    keep = ~F.isnan(c.salary)
    for name in required:
        keep = keep & F.col(name).isNotNull()
    return keep


def clean(df: DataFrame, required: Sequence[str] | None = None, c: Columns = COLUMNS) -> DataFrame:
    """Postings with title, a numeric salary and a skill list (an empty list is kept)."""
    return _typed(df, c).filter(_usable(c, required or (c.title, c.salary, c.skills)))


def rejected(df: DataFrame, required: Sequence[str] | None = None, c: Columns = COLUMNS) -> DataFrame:
    """The rows ``clean`` drops, as they came in."""
    raw = "_raw_salary"
    required = required or (c.title, c.salary, c.skills)
    typed = _typed(df.withColumn(raw, F.col(c.salary)), c)
    dropped = typed.filter(~F.coalesce(_usable(c, required), F.lit(False)))
    return dropped.withColumn(c.salary, F.col(raw)).drop(raw)
