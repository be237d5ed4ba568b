"""Answer equal requests once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def by_profile(
    requests: DataFrame, answer: Callable[[DataFrame], DataFrame], request_col: str = "request_id"
) -> DataFrame:
    """``answer(requests)``, worked out for distinct requests only and handed to all equal ones.

    Requests are equal if all columns but the id are; lists count as equal in any order. Worth it
    where many requests repeat and an answer is costly, as with a forest: titles, levels and a few
    skills have far fewer combinations than a large table has rows. Repeats are removed inside the
    map tasks. A request that a third of the table repeats makes a hot key of the join back, which
    adaptive execution splits, since each key has few answers.

    ``answer`` sees a table (request_id, other columns) with unique ids and keeps the id column.
    """
    columns = [x for x in requests.columns if x != request_col]
    lists = {f.name for f in requests.schema if isinstance(f.dataType, T.ArrayType)}
    same = {x: F.array_sort(F.array_compact(F.coalesce(x, F.array()))) if x in lists else F.col(x) for x in columns}
    # A null field is left out of the text, so it differs from an empty one.
    profile = F.sha2(F.to_json(F.struct(*[F.col(x) for x in columns])), 256)
    keyed = requests.select(request_col, *[same[x].alias(x) for x in columns]).withColumn("_profile", profile)
    distinct = requests.select(*[same[x].alias(x) for x in columns]).distinct().withColumn(request_col, profile)
    answers = answer(distinct.select(*requests.columns)).withColumnRenamed(request_col, "_profile")
    others = [x for x in answers.columns if x != "_profile"]
    return keyed.select(request_col, "_profile").join(answers, "_profile").select(request_col, *others)
