"""A table of postings seen in the driver's order tables, and the inputs derived from it.

One order is one posting: its customer's market segment is the title, the brands on its lines are
the skills, and so on (FIXTURES.md). Rule constants for these names are at the top.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.operators.roadmap import frameworks_table
from postlens.operators.rules import DemandRules, PayRules, with_demand, with_expected_salary

HOT_BRANDS = ("Brand#1", "Brand#2", "Brand#3", "Brand#4")
TIER_A = ("Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5")
TIER_B = ("Brand#6", "Brand#7", "Brand#8", "Brand#9", "Brand#10")
DEMAND = DemandRules(hot_skills=HOT_BRANDS, industries=("ASIA", "EUROPE"))
# The same rules with other thresholds: a second opinion to compare the first with.
SHIFTED_DEMAND = DemandRules(
    hot_skills=HOT_BRANDS, industries=("ASIA", "EUROPE"), high_from=4, medium_from=2
)
PAY = PayRules(
    base={"AUTOMOBILE": 95000, "BUILDING": 85000, "FURNITURE": 90000, "HOUSEHOLD": 105000, "MACHINERY": 125000},
    tiers=((8000, TIER_A), (4000, TIER_B)),
)
HIGH_ABOVE = 250000
# No order costs as much as the last two bands ask.
WIDE_CUTS = (60000, 120000, 240000, 600000, 900000)
WIDE_LABELS = ("Under $60k", "$60k - $120k", "$120k - $240k", "$240k - $600k", "$600k - $900k", "Over $900k")
DEFAULT_ROLE = "Analyst"
FRAMEWORKS = {
    "Analyst": [
        ("Query", "Ask tables.", ["Brand#1", "Brand#2"]),
        ("Show", "Draw charts.", ["Brand#3"]),
        ("Share", "Keep versions.", ["Brand#4", "Brand#99"]),
    ],
    "Builder": [
        ("Store", "Lay out files.", ["Brand#5"]),
        ("Move", "Load and join.", ["Brand#6", "Brand#7", "Brand#8"]),
        ("Run", "Schedule jobs.", ["Brand#9"]),
    ],
    "Modeler": [
        ("Prepare", "Clean and encode.", ["Brand#10", "Brand#11"]),
        ("Fit", "Train and judge.", ["Brand#12"]),
        ("Serve", "Score tables.", ["Brand#13", "Brand#14"]),
    ],
}


# The columns the view uses. Declared, so that building a query starts no job to look them up.
_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "lineitem": "l_orderkey bigint, l_partkey bigint",
    "part": "p_partkey bigint, p_brand string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One posting for each order; skills are null for an order without lines.

    A brand counts once for an order: collect_set drops repeats inside the map tasks, and there are
    25 brands, so the list of an order stays short however many lines it has.
    """
    lines, parts = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "part")
    skills = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(F.sort_array(F.collect_set("p_brand")).alias("skills"))
    )
    places = (
        _table(spark, sf_dir, "nation")
        .join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    customers = (
        _table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_name", "c_mktsegment", "n_name", "r_name")
    )
    level = F.substring("o_orderpriority", 1, 1)
    status = F.col("o_orderstatus")
    job_type = F.when(status == "O", "Remote").when(status == "P", "Hybrid").otherwise("Onsite")
    rows = (
        _table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(skills, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").cast("string").alias("job_id"),
            F.col("c_mktsegment").alias("job_title"),
            F.col("c_name").alias("company"),
            F.when(F.col("o_orderstatus") == "O", "Remote").otherwise(F.col("n_name")).alias("location"),
            F.when(level == "1", "Lead")
            .when(level == "2", "Senior")
            .when(level == "3", "Mid-level")
            .otherwise("Entry-level")
            .alias("experience_level"),
            job_type.alias("job_type"),
            F.col("o_totalprice").alias("salary"),
            "skills",
            F.col("r_name").alias("industry"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("post_date"),
            F.col("o_custkey").alias("customer"),
        )
    )
    return with_demand(rows, DEMAND)


def some_users(postings: DataFrame) -> DataFrame:
    """People who know about a third of their brands, picked by a hash of customer and brand."""
    known = postings.select("customer", F.explode("skills").alias("skill")).distinct()
    digit = F.conv(F.substring(F.md5(F.concat_ws("/", F.col("customer").cast("string"), "skill")), 1, 4), 16, 10)
    return (
        known.filter(digit.cast("int") % 3 == 0)
        .groupBy(F.col("customer").alias("user_id"))
        .agg(F.sort_array(F.collect_list("skill")).alias("skills"))
    )


def odd_postings(postings: DataFrame) -> DataFrame:
    """The raw postings with, by fixed residues of the order's number, null levels, ids and titles, empty
    and repeated skills, a percent sign in the title, and salaries of four decimals."""
    number = F.col("job_id").cast("bigint")

    def every(n):
        return number % n == 0

    percent = every(37)
    return (
        postings.withColumn("experience_level", F.when(~every(17), F.col("experience_level")))
        .withColumn("salary", F.col("salary") + (number % 10000) / F.lit(10000.0))
        .withColumn(
            "skills",
            F.when(every(29), F.array().cast("array<string>"))
            .when(every(31), F.concat("skills", "skills"))
            .otherwise(F.col("skills")),
        )
        .withColumn(
            "job_title",
            F.when(percent, F.concat(F.lit("100% "), "job_title")).when(~every(23), F.col("job_title")),
        )
        .withColumn("job_id", F.when(percent | ~every(19), F.col("job_id")))
    )


def odd_pay() -> PayRules:
    """Base pay that leaves fractions of 100, and steps that meet the floor."""
    base = {"AUTOMOBILE": 95130, "BUILDING": 85055, "FURNITURE": 21017, "HOUSEHOLD": 105250, "MACHINERY": 125199}
    return PayRules(base=base, tiers=PAY.tiers)


def text_salaries(postings: DataFrame) -> DataFrame:
    """Salaries as text; those of one title in one industry are no numbers."""
    broken = (F.col("job_title") == "BUILDING") & (F.col("industry") == "ASIA")
    return postings.withColumn("salary", F.when(broken, "n/a").otherwise(F.col("salary").cast("string")))


def requests(postings: DataFrame) -> DataFrame:
    """Each posting asks for its own prediction."""
    return postings.select(
        F.col("job_id").alias("request_id"), "job_title", "experience_level", "job_type", "industry", "skills"
    )


def role_requests(postings: DataFrame) -> DataFrame:
    """Each posting asks for a role by its level; Entry-level asks for one that is not known."""
    level = F.col("experience_level")
    role = F.when(level == "Lead", "Builder").when(level == "Senior", "Modeler").when(level == "Mid-level", "Analyst")
    return postings.select(F.col("job_id").alias("request_id"), F.coalesce(role, F.lit("Poet")).alias("role"))


def users(postings: DataFrame) -> DataFrame:
    """One person for each customer: all brands of their postings as a comma list with stray blanks;
    some know nothing, some also a skill nobody asks for."""
    known = (
        postings.select("customer", F.explode("skills").alias("skill"))
        .groupBy("customer")
        .agg(F.sort_array(F.collect_set("skill")).alias("all_skills"))
    )
    listed = (
        F.when(F.col("customer") % 11 == 0, F.lit(" , "))
        .when(F.col("customer") % 13 == 0, F.array_join("all_skills", ","))
        .when(F.col("customer") % 17 == 0, F.concat(F.lit("Cobol,, "), F.array_join("all_skills", " , ")))
        .otherwise(F.array_join("all_skills", " , "))
    )
    return known.select(F.col("customer").alias("user_id"), listed.alias("skills"))


def scored_rows(postings: DataFrame) -> DataFrame:
    """Postings with a second salary and a second demand label, to report on."""
    return with_demand(with_expected_salary(postings, PAY), SHIFTED_DEMAND, out="other_demand")


def frameworks(spark: SparkSession) -> DataFrame:
    return frameworks_table(spark, FRAMEWORKS)
