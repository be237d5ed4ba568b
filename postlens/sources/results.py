"""Recorded results: write, read back in order, and the bundle that a dashboard shows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import BAND_LABELS, TOP_SKILLS
from ..functions.bands import band_rank
from ..schema import RESULT_SCHEMAS
from .versions import current_version

MARKET_RESULTS = (
    "overall_stats",
    "salary_by_title_exp",
    "skills_analysis",
    "industry_metrics",
    "salary_distribution",
)


def write_result(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Writes a result as JSON lines or Parquet in place of an older one."""
    df.write.mode("overwrite").format(fmt).save(path)


def _in_order(df: DataFrame, name: str) -> DataFrame:
    # Files have no order among each other, so it is restored from the values.
    orders = {
        "salary_by_title_exp": ["job_title", "experience_level"],
        "skills_analysis": [F.desc("frequency"), "skill"],
        "industry_metrics": [F.desc("job_count"), "industry"],
        "salary_distribution": [band_rank(F.col("salary_band"), BAND_LABELS), "salary_band"],
        "metadata_options": ["field", "value"],
        "feature_importances": ["position"],
    }
    return df.orderBy(*orders[name]) if name in orders else df


def read_result(spark: SparkSession, path: str, name: str, fmt: str = "json") -> DataFrame:
    """The recorded result ``name`` (a key of ``RESULT_SCHEMAS``) in its order."""
    reader = spark.read.format(fmt)
    if fmt == "json":
        reader = reader.schema(RESULT_SCHEMAS[name])
    return _in_order(reader.load(path), name)


def insights(
    spark: SparkSession, results_dir: str, top_skills: int = TOP_SKILLS, fmt: str = "json"
) -> dict[str, DataFrame]:
    """The five recorded results by name, skills cut to the first ``top_skills``.

    All come from one run: the newest that is whole, also while another is being recorded. Fails if
    one of them is missing.
    """
    results_dir = current_version(spark, results_dir)
    bundle = {name: read_result(spark, f"{results_dir}/{name}", name, fmt) for name in MARKET_RESULTS}
    bundle["skills_analysis"] = bundle["skills_analysis"].limit(top_skills)
    return bundle
