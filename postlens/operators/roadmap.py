"""Skill roadmaps for tables of people and role roadmaps for tables of requests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import DEFAULT_ROLE, ROADMAP_HIGH_ABOVE, ROADMAP_REASON, ROADMAP_STEPS, ROLE_FRAMEWORKS
from ..functions.money import format_money
from ..functions.ranking import ranked, with_missing_ranks
from ..functions.skills import owned_skills

def skill_roadmap(
    users: DataFrame,
    skill_stats: DataFrame,
    k: int = ROADMAP_STEPS,
    high: float = ROADMAP_HIGH_ABOVE,
    user_col: str = "user_id",
    skills_col: str = "skills",
    reason: str = ROADMAP_REASON,
) -> DataFrame:
    """For each user the ``k`` most frequent skills they lack, as numbered steps.

    ``skills_col`` is an array or a comma list; ``user_col`` must be unique. Users without skills get
    no rows. Repeated skills of ``skill_stats`` count once, and skills without a frequency not at all.
    Users meet the ranked table by the skills they own and by the ranks they lack, so neither side is
    paired with the whole of the other and nothing is handed to the tasks in full.
    """
    ranks = ranked(skill_stats, "skill", [("frequency", True), ("skill", False)], ["avg_salary"])
    people = users.select(user_col, owned_skills(users, skills_col).alias("_own")).filter(F.size("_own") > 0)
    lacked = with_missing_ranks(people, ranks, user_col, "_own", "skill", k)
    steps = lacked.select(user_col, F.posexplode("_missing").alias("_pos", "rank")).join(ranks, "rank")
    before, after = reason.split("{}")
    return steps.withColumn("target_avg_salary", F.col("avg_salary")).select(
        user_col,
        (F.col("_pos") + 1).cast("bigint").alias("step"),
        "skill",
        "target_avg_salary",
        F.concat(F.lit(before), format_money(F.col("target_avg_salary")), F.lit(after)).alias("reason"),
        F.when(F.col("target_avg_salary") > high, "High").otherwise("Medium").alias("priority"),
    )


def frameworks_table(
    spark: SparkSession,
    frameworks: Mapping[str, Sequence[tuple[str, str, Sequence[str]]]] = ROLE_FRAMEWORKS,
) -> DataFrame:
    """Role -> ordered milestones as a table (role, step, title, description, base_skills)."""
    rows = [
        {"role": role, "step": step, "title": title, "description": text, "base_skills": list(skills)}
        for role, milestones in frameworks.items()
        for step, (title, text, skills) in enumerate(milestones, start=1)
    ]
    schema = pa.schema(
        [
            ("role", pa.string()),
            ("step", pa.int64()),
            ("title", pa.string()),
            ("description", pa.string()),
            ("base_skills", pa.list_(pa.string())),
        ]
    )
    # From Arrow, Spark knows the size of the table and plans its joins by it.
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema))


def role_roadmap(
    requests: DataFrame,
    frameworks: DataFrame,
    skill_stats: DataFrame,
    default_role: str = DEFAULT_ROLE,
    request_col: str = "request_id",
) -> DataFrame:
    """Milestones of the requested role, or of ``default_role`` for an unknown one, one row for each
    skill, with the skill's statistics where it has any.

    The frameworks are joined with the statistics first, so the requests meet one small table.
    """
    steps = frameworks.withColumnRenamed("role", "_framework")
    listed = steps.select(
        "_framework", "step", "title", "description", F.posexplode_outer("base_skills").alias("_pos", "skill")
    )
    milestones = listed.join(skill_stats.select("skill", "frequency", "avg_salary"), "skill", "left")
    known = steps.select("_framework").distinct()
    framework = F.coalesce("_framework", F.lit(default_role))
    placed = requests.select(request_col, "role").join(known, F.col("role") == F.col("_framework"), "left")
    return (
        placed.withColumn("_framework", framework)
        .join(milestones, "_framework", "left")
        .select(
            request_col,
            "role",
            "step",
            "title",
            "description",
            "skill",
            (F.col("_pos") + 1).cast("bigint").alias("skill_pos"),
            "frequency",
            "avg_salary",
        )
    )


def nested_roadmap(roadmap: DataFrame, request_col: str = "request_id") -> DataFrame:
    """``role_roadmap`` with one row for each milestone and its skills as an ordered array."""
    skill = F.when(F.col("skill").isNotNull(), F.struct("skill_pos", "skill", "frequency", "avg_salary"))
    listed = F.array_sort(F.collect_list(skill)).alias("listed")
    grouped = roadmap.groupBy(request_col, "role", "step", "title", "description").agg(listed)
    return grouped.select(
        request_col, "role", "step", "title", "description",
        F.transform("listed", lambda x: F.struct(x["skill"].alias("skill"), x["frequency"].alias("frequency"), x["avg_salary"].alias("avg_salary"))).alias("skills"),
    )
