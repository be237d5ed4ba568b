import json

import pytest
from conftest import posting, rows_of
from pyspark.errors import AnalysisException

from postlens import operators as O
from postlens import plans, sources
from postlens.schema import RAW_SCHEMA

RECORDS = [
    {"job_id": "1", "job_title": 'A "quoted", {b}\n  }', "salary": 30000, "skills": ["x"], "job_type": "Remote"},
    {"job_id": "2", "job_title": "T]", "salary": 65000.5, "skills": [], "industry": None},
    {"job_id": "3", "job_title": "[T", "salary": "n/a", "skills": ["y", "z"]},
    {"job_id": "4", "job_title": "U", "salary": "70000", "skills": ["y"], "extra": {"deep": [1, {"er": 2}]}},
]


def text_of(df):
    return sorted((x.job_id, x.job_title, x.salary, tuple(x.skills)) for x in df.collect())


WANT = [
    ("1", 'A "quoted", {b}\n  }', "30000", ("x",)),
    ("2", "T]", "65000.5", ()),
    ("3", "[T", "n/a", ("y", "z")),
    ("4", "U", "70000", ("y",)),
]


def test_read_json_array_and_lines(spark, tmp_path):
    (tmp_path / "array.json").write_text(json.dumps(RECORDS))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(x) for x in RECORDS))
    assert text_of(sources.read_postings(spark, str(tmp_path / "array.json"), indent=None)) == WANT
    lines = sources.read_postings(spark, str(tmp_path / "lines.json"), multi_line=False)
    assert text_of(lines) == WANT
    assert lines.schema == RAW_SCHEMA
    assert rows_of(O.clean(lines).select("job_id", "salary").orderBy("job_id")) == [
        ("1", 30000.0),
        ("2", 65000.5),
        ("4", 70000.0),
    ]


@pytest.mark.parametrize("indent", [2, 4])
@pytest.mark.parametrize("end", ["", "\n", "\r\n\n"])
def test_read_indented_array(spark, tmp_path, indent, end):
    path = tmp_path / "pretty.json"
    path.write_bytes((json.dumps(RECORDS, indent=indent) + end).encode())
    df = sources.read_postings(spark, str(path), indent=indent, keep_corrupt=True)
    assert text_of(df) == WANT
    assert sources.corrupt_records(df).count() == 0


@pytest.mark.parametrize("text", [json.dumps(RECORDS), json.dumps(RECORDS, indent=4), json.dumps([{}, *RECORDS], indent=2)])
def test_wrong_indent_is_an_error(spark, tmp_path, text):
    (tmp_path / "other.json").write_text(text)
    with pytest.raises(Exception, match="no JSON array indented by 2"):
        sources.read_postings(spark, str(tmp_path / "other.json"), indent=2).collect()


def test_indented_array_is_read_by_many_tasks(spark, tmp_path):
    rows = [dict(RECORDS[0], job_id=str(i), company="c" * 50) for i in range(2000)]
    (tmp_path / "big.json").write_text(json.dumps(rows, indent=2))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = sources.read_postings(spark, str(tmp_path / "big.json"), indent=2)
        assert df.rdd.getNumPartitions() > 5
        assert sorted(int(x.job_id) for x in df.collect()) == list(range(2000))
        (tmp_path / "none.json").write_text("[]")
        assert sources.read_postings(spark, str(tmp_path / "none.json"), indent=2).count() == 0
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)


def test_corrupt_records(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"job_id": "1"}\nnot json\n{"job_id": "2", "skills": 5}\n')
    df = sources.read_postings(spark, str(tmp_path / "lines.json"), multi_line=False, keep_corrupt=True)
    assert sorted(rows_of(sources.corrupt_records(df))) == [("not json",), ('{"job_id": "2", "skills": 5}',)]
    (tmp_path / "pretty.json").write_text('[\n  {\n    "job_id": "1"\n  },\n  {\n    "job_id": oops\n  }\n]')
    df = sources.read_postings(spark, str(tmp_path / "pretty.json"), indent=2, keep_corrupt=True)
    assert "oops" in rows_of(sources.corrupt_records(df))[0][0]


def test_missing_path_and_format(spark, tmp_path):
    for options in ({}, {"multi_line": False}, {"indent": 2}, {"fmt": "parquet"}):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            sources.read_postings(spark, str(tmp_path / "absent"), **options)
    with pytest.raises(ValueError):
        sources.read_postings(spark, str(tmp_path), fmt="csv")


def test_parquet(spark, postings, tmp_path):
    df = postings(posting("1"), posting("2"))
    sources.write_result(df, str(tmp_path / "p"), "parquet")
    assert sorted(rows_of(sources.read_postings(spark, str(tmp_path / "p"), fmt="parquet"))) == sorted(rows_of(df))


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_recorded_market(spark, postings, tmp_path, fmt):
    df = postings(
        *[posting(str(i), skills=[f"s{i % 20:02}", "all"], salary=50000.0 + i * 1000) for i in range(100)],
        posting("bad", salary=None),
    )
    out = str(tmp_path / "out")
    with pytest.raises(AnalysisException):
        sources.insights(spark, out, fmt=fmt)
    for _ in range(2):
        run = plans.record_market(df, out, fmt)
    bundle = sources.insights(spark, out, fmt=fmt)
    kept = O.clean(df)
    assert rows_of(bundle["overall_stats"]) == rows_of(O.overall_stats(kept))
    assert rows_of(bundle["skills_analysis"]) == rows_of(O.top_skills(kept))
    assert rows_of(bundle["salary_by_title_exp"]) == rows_of(O.salary_by_title_exp(kept))
    assert rows_of(bundle["industry_metrics"]) == rows_of(O.industry_metrics(kept))
    assert rows_of(bundle["salary_distribution"]) == rows_of(O.salary_distribution(kept))
    extract = spark.read.parquet(run.extract_path)
    assert extract.count() == 100
    assert extract.columns[1:] == sources.training_extract(df).columns


def test_shared_dir_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = sources.shared_dir(spark)
    assert folder == sources.shared_dir(spark)
    assert folder.startswith(named or spark.sparkContext.getCheckpointDir())
    assert folder.endswith(spark.sparkContext.applicationId)
    table = sources.materialize(spark.range(10), "ten")
    assert table.count() == 10 and folder in table.inputFiles()[0]


def test_plans_take_other_column_names(spark, postings, tmp_path):
    from postlens.schema import Columns

    c = Columns(job_id="id", title="role", level="rank", job_type="kind", salary="pay", skills="tools", industry="field")
    names = {"job_id": "id", "job_title": "role", "experience_level": "rank", "job_type": "kind"}
    names |= {"salary": "pay", "skills": "tools", "industry": "field"}
    rows = [posting(str(i), job_title="AB"[i % 2], skills=["x"] if i % 3 else ["y"], salary=100.0 + i % 2) for i in range(60)]
    df = postings(*rows)
    run = plans.record_market(df.withColumnsRenamed(names), str(tmp_path / "a"), c=c)
    plain = plans.record_market(df, str(tmp_path / "b"))
    for folder in ("overall_stats", "skills_analysis", "salary_distribution"):
        read = [sorted(rows_of(spark.read.json(f"{r.version_dir}/{folder}"))) for r in (run, plain)]
        assert read[0] == read[1]
    trained = plans.train(spark.read.parquet(run.extract_path), trees=2, depth=2, c=c)
    assert "role_A" in trained.models.features.names


def test_nothing_temporary_is_left(spark, postings, tmp_path):
    from pathlib import Path
    from urllib.parse import urlparse

    folder = Path(urlparse(sources.shared_dir(spark)).path)
    before = set(folder.glob("*"))
    plans.record_market(postings(posting("1")), str(tmp_path / "m"))
    with sources.temporary_tables(spark):
        assert sources.materialize(spark.range(5)).count() == 5
    assert set(folder.glob("*")) == before
