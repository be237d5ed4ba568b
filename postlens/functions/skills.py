"""Expressions over skill lists. All are built-in array functions; nulls mean "no skills"."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _no_skills() -> Column:
    return F.array().cast("array<string>")


def parse_skill_list(text: Column) -> Column:
    """Comma list to array: items stripped of white space, empty ones dropped."""
    items = F.transform(F.split(text, ","), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.coalesce(F.filter(items, lambda x: x != ""), _no_skills())


def owned_skills(df: DataFrame, col: str) -> Column:
    """A person's or request's skills as an array without nulls, from a comma list or an array."""
    if isinstance(df.schema[col].dataType, T.StringType):
        return parse_skill_list(F.col(col))
    return F.coalesce(F.array_compact(F.col(col)), _no_skills())


def has_any(skills: Column, names: Iterable[str]) -> Column:
    """True if any of ``names`` is listed; never null."""
    wanted = [F.lit(x) for x in names]
    if not wanted:
        return F.lit(False)
    return F.coalesce(F.arrays_overlap(skills, F.array(*wanted)), F.lit(False))


def add_skill(skills: Column, skill: Column) -> Column:
    """The list with one more skill; unchanged where ``skill`` is null."""
    return F.when(skill.isNull(), skills).otherwise(F.array_append(skills, skill))
