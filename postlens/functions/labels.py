"""Demand labels as numbers for model training, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import DEMAND_LABELS


def demand_code(label: Column, labels: Sequence[str] = DEMAND_LABELS) -> Column:
    """Position of the label as double; null for any other text."""
    chain = F.when(label == labels[0], F.lit(0.0))
    for code, name in enumerate(labels[1:], start=1):
        chain = chain.when(label == name, F.lit(float(code)))
    return chain


def demand_label(code: Column, labels: Sequence[str] = DEMAND_LABELS) -> Column:
    """Label at the position ``code``; null outside the list."""
    return F.get(F.array(*[F.lit(x) for x in labels]), code.cast("int"))


def encode_demand(df: DataFrame, label_col: str = "demand_score", out: str = "demand_code") -> DataFrame:
    return df.withColumn(out, demand_code(F.col(label_col)))


def decode_demand(df: DataFrame, code_col: str = "demand_code", out: str = "demand_score") -> DataFrame:
    return df.withColumn(out, demand_label(F.col(code_col)))
