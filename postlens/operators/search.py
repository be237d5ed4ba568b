"""Search over postings, raw or cleaned."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import SEARCH_LIMIT
from ..schema import COLUMNS, Columns


def search_postings(
    df: DataFrame,
    title: str | None = None,
    industry: str | None = None,
    job_type: str | None = None,
    limit: int | None = SEARCH_LIMIT,
    order_by: Sequence[str] | None = None,
    c: Columns = COLUMNS,
) -> DataFrame:
    """First ``limit`` matches in ``order_by`` order (the id by default), ignoring case.

    ``title`` may be any part of the title and is taken literally. None and "" do not filter. A null
    field matches no filter. Without ``limit`` all matches come back, unsorted.
    """
    tests = []
    if title:
        tests.append(F.contains(F.lower(c.title), F.lower(F.lit(title))))
    for col, wanted in ((c.industry, industry), (c.job_type, job_type)):
        if wanted:
            tests.append(F.lower(col) == F.lower(F.lit(wanted)))
    found = df.filter(reduce(lambda a, b: a & b, tests)) if tests else df
    if limit is None:
        return found
    first = list(order_by or (c.job_id,))
    # The other columns break ties, so that equal ids give the same page on every run.
    ties = [f.name for f in df.schema if f.name not in first and not isinstance(f.dataType, T.MapType)]
    return found.orderBy(*first, *ties).limit(limit)
