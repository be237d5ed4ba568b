"""Declared schemas and the column names operators use by default."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Columns:
    """Names of the posting columns; pass another instance for a table named differently."""

    job_id: str = "job_id"
    title: str = "job_title"
    level: str = "experience_level"
    job_type: str = "job_type"
    salary: str = "salary"
    skills: str = "skills"
    industry: str = "industry"


COLUMNS = Columns()


def posting_schema(salary: T.DataType = T.DoubleType()) -> T.StructType:
    """The eleven posting fields. Raw input keeps ``salary`` as text until ``clean`` casts it."""
    text = T.StringType()
    return T.StructType(
        [
            T.StructField("job_id", text),
            T.StructField("job_title", text),
            T.StructField("company", text),
            T.StructField("location", text),
            T.StructField("experience_level", text),
            T.StructField("job_type", text),
            T.StructField("salary", salary),
            T.StructField("skills", T.ArrayType(text)),
            T.StructField("industry", text),
            T.StructField("post_date", text),
            T.StructField("demand_score", text),
        ]
    )


# Text, because a JSON number reads losslessly as text while text never reads as a double.
RAW_SCHEMA = posting_schema(T.StringType())

RESULT_SCHEMAS = {
    "overall_stats": "total_jobs long, average_salary double, remote_percentage double",
    "salary_by_title_exp": "job_title string, experience_level string, avg_salary double, job_count long",
    "skills_analysis": "skill string, frequency long, avg_salary double",
    "industry_metrics": "industry string, job_count long, avg_salary double, remote_percentage double",
    "salary_distribution": "salary_band string, count long",
    "metadata_options": "field string, value string",
    "feature_importances": "position long, feature string, importance double",
}
