"""Postings as model features, and the train/test split."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    OneHotEncoder,
    SQLTransformer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import CATEGORICAL, TEST_PERCENT
from ..schema import COLUMNS

FEATURES = "features"
# Default bound of the levels that reach the driver; see fit_features.
MAX_LEVELS = 1_000_000


def category_values(
    df: DataFrame, cols: Sequence[str] = CATEGORICAL, array_cols: Sequence[str] = (COLUMNS.skills,)
) -> DataFrame:
    """Distinct non-null values of every column as sorted rows (field, value), from one scan.

    Repeats are removed inside each map task, before the shuffle.
    """
    fields = [F.struct(F.lit(x).alias("field"), F.array(F.col(x).cast("string")).alias("values")) for x in cols]
    fields += [F.struct(F.lit(x).alias("field"), F.col(x).cast("array<string>").alias("values")) for x in array_cols]
    return (
        df.select(F.explode(F.array(*fields)).alias("f"))
        .select("f.field", F.explode("f.values").alias("value"))
        .filter(F.col("value").isNotNull())
        .distinct()
        .orderBy("field", "value")
    )


def category_lists(values: DataFrame) -> DataFrame:
    """``category_values`` with one row for each field and its values as one sorted array."""
    return values.groupBy("field").agg(F.sort_array(F.collect_list("value")).alias("values"))


@dataclass(frozen=True)
class FeatureModel:
    """Fitted feature stages and the names of the vector's slots, in order."""

    stages: PipelineModel
    names: tuple[str, ...]
    cols: tuple[str, ...] = ()
    skills_col: str = COLUMNS.skills

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``features`` and nothing else."""
        return self.stages.transform(df).select(*df.columns, FEATURES)

    def levels(self) -> dict[tuple[str, str], int]:
        """Slot of each known (column, value); skills stand under the skills column."""
        out: dict[tuple[str, str], int] = {}
        for stage in self.stages.stages:
            if isinstance(stage, StringIndexerModel):
                known = [(stage.getInputCol(), label) for label in stage.labels]
            elif isinstance(stage, CountVectorizerModel):
                known = [(self.skills_col, skill) for skill in stage.vocabulary]
            else:
                continue
            out.update(zip(known, range(len(out), len(out) + len(known))))
        return out

    def save(self, path: str) -> None:
        self.stages.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> FeatureModel:
        return cls.from_stages(PipelineModel.load(path))

    @classmethod
    def from_stages(cls, stages: PipelineModel) -> FeatureModel:
        names: list[str] = []
        cols: list[str] = []
        skills_col = COLUMNS.skills
        for stage in stages.stages:
            if isinstance(stage, StringIndexerModel):
                cols.append(stage.getInputCol())
                names += [f"{stage.getInputCol()}_{label}" for label in stage.labels]
            elif isinstance(stage, CountVectorizerModel):
                names += stage.vocabulary
            elif isinstance(stage, SQLTransformer):
                skills_col = re.search(r"coalesce\(`(.*?)`, ", stage.getStatement()).group(1)
        return cls(stages, tuple(names), tuple(cols), skills_col)


def fit_features(
    df: DataFrame,
    cols: Sequence[str] = CATEGORICAL,
    skills_col: str = COLUMNS.skills,
    levels: Mapping[str, Sequence[str]] | DataFrame | None = None,
    max_levels: int = MAX_LEVELS,
) -> FeatureModel:
    """One-hot categories ++ multi-hot skills, levels sorted; unknown and null levels give zeros.

    The levels come from one scan, or from ``levels`` if they are known already, as field -> values or
    as a table like that of ``category_values``. They reach the driver, so more than ``max_levels`` of
    them fail: group rare ones before training.
    """
    if levels is None or isinstance(levels, DataFrame):
        table = category_values(df, cols, (skills_col,)) if levels is None else levels.orderBy("field", "value")
        found = table.limit(max_levels + 1).collect()
        if len(found) > max_levels:
            raise ValueError(f"more than {max_levels} distinct levels: group rare ones before training")
        levels = {}
        for field, value in found:
            levels.setdefault(field, []).append(value)
    known = [x for x in cols if levels.get(x)]
    vocabulary = list(levels.get(skills_col, ()))
    parts: list[str] = []
    stages: list = [
        # Null lists would fail and null items match nothing.
        SQLTransformer(
            statement=f"SELECT *, array_compact(coalesce(`{skills_col}`, cast(array() AS array<string>)))"
            " AS _skills FROM __THIS__"
        )
    ]
    if known:
        indexed, encoded = [f"_{x}_index" for x in known], [f"_{x}_onehot" for x in known]
        # "keep" puts unknown levels and null in a slot of their own, and dropLast drops that slot.
        # One indexer for each column: a joint one pads the shorter label lists with nulls.
        for col, index in zip(known, indexed):
            stages.append(StringIndexerModel.from_labels(list(levels[col]), col, index, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True))
        parts += encoded
    if vocabulary:
        counts = CountVectorizerModel.from_vocabulary(vocabulary, "_skills", "_skills_multihot")
        stages.append(counts.setBinary(True))
        parts.append("_skills_multihot")
    if not parts:
        raise ValueError("no categories and no skills to learn from")
    stages.append(VectorAssembler(inputCols=parts, outputCol=FEATURES))
    # Fitting only reads column metadata: every level is known by now.
    return FeatureModel.from_stages(Pipeline(stages=stages).fit(df))


def features_long(
    df: DataFrame,
    levels: DataFrame,
    id_col: str = COLUMNS.job_id,
    cols: Sequence[str] = CATEGORICAL,
    skills_col: str = COLUMNS.skills,
) -> DataFrame:
    """The non-zero features of each row as (id, feature, value), with the names of ``fit_features``.

    ``levels`` is a table (field, value) like that of ``category_values``; what it lacks has no
    feature. A row meets only its own values, so the work grows with the rows and not with the number
    of features.
    """
    own = F.array_distinct(F.coalesce(F.col(skills_col).cast("array<string>"), F.array().cast("array<string>")))
    pairs = [F.array(F.struct(F.lit(x).alias("field"), F.col(x).cast("string").alias("value"))) for x in cols]
    skills = F.transform(own, lambda x: F.struct(F.lit(skills_col).alias("field"), x.alias("value")))
    found = df.select(id_col, F.explode(F.concat(*pairs, skills)).alias("f")).select(id_col, "f.field", "f.value")
    name = F.when(F.col("field") == skills_col, F.col("value")).otherwise(F.concat_ws("_", "field", "value"))
    known = levels.select("field", "value").distinct()
    return found.join(known, ["field", "value"]).select(id_col, name.alias("feature"), F.lit(1.0).alias("value"))


def with_split(
    df: DataFrame, id_col: str = COLUMNS.job_id, pct: int = TEST_PERCENT, out: str = "split"
) -> DataFrame:
    """Marks each row ``test`` (about ``pct`` percent) or ``train`` by a hash of its id, so a row
    stays on its side however the table is partitioned or extended. A row without an id goes by a hash
    of all its columns."""
    row = F.to_json(F.struct(*[F.col(x) for x in df.columns]))
    digits = F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), row)), 1, 8)
    bucket = F.conv(digits, 16, 10).cast("bigint") % 100
    return df.withColumn(out, F.when(bucket < pct, "test").otherwise("train"))


def split(df: DataFrame, id_col: str = COLUMNS.job_id, pct: int = TEST_PERCENT) -> tuple[DataFrame, DataFrame]:
    """(train, test)"""
    marked = with_split(df, id_col, pct, "_split")
    return tuple(marked.filter(F.col("_split") == side).drop("_split") for side in ("train", "test"))
