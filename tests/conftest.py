import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.driver.memory", "4g")
        # Short queries: the quick compiler alone is faster than both.
        .config("spark.driver.extraJavaOptions", "-XX:TieredStopAtLevel=1")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-"))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "3")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


COLUMNS = (
    "job_id string, job_title string, company string, location string, experience_level string, job_type string,"
    " salary double, skills array<string>, industry string, post_date string, demand_score string"
)


def posting(job_id="1", job_title="Data Engineer", **values):
    row = {
        "job_id": job_id,
        "job_title": job_title,
        "company": "Acme",
        "location": "Remote",
        "experience_level": "Senior",
        "job_type": "Remote",
        "salary": 100000.0,
        "skills": ["SQL", "Go"],
        "industry": "Tech",
        "post_date": "2026-01-02",
        "demand_score": "High",
    }
    row.update(values)
    return tuple(row.values())


@pytest.fixture
def postings(spark):
    def build(*rows, salary="double"):
        return spark.createDataFrame(list(rows), COLUMNS.replace("salary double", f"salary {salary}"))

    return build


def rows_of(df):
    return [tuple(x) for x in df.collect()]
