"""Salary bands from a list of cut points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(amount: Column, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the half-open interval that holds ``amount``; null for null and NaN."""
    if len(labels) != len(cuts) + 1:
        raise ValueError(f"{len(cuts)} cut points need {len(cuts) + 1} labels, got {len(labels)}")
    if list(cuts) != sorted(set(cuts)):
        raise ValueError("cut points must be strictly increasing")
    chain = F.when(amount.isNull() | F.isnan(amount), F.lit(None).cast("string"))
    for cut, label in zip(cuts, labels):
        chain = chain.when(amount < cut, label)
    return chain.otherwise(labels[-1])


def band_rank(label: Column, labels: Sequence[str]) -> Column:
    """1 for the first label and so on; unknown labels and null come after all known ones."""
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), label)
    return F.when(position > 0, position).otherwise(F.lit(len(labels) + 1))
