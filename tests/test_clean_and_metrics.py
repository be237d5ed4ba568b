import math

import pytest
from conftest import posting, rows_of
from pyspark.sql import functions as F

from postlens import operators as O
from postlens.fixed_values import BAND_LABELS
from postlens.functions import mean_money, money_sums, round_money


def test_clean_drops_incomplete_rows(postings):
    df = postings(
        posting("1"),
        posting("2", job_title=None),
        posting("3", salary=None),
        posting("4", skills=None),
        posting("5", salary=math.nan),
        posting("6", skills=[]),
        posting(None, experience_level=None),
    )
    assert {x[0] for x in rows_of(O.clean(df).select("job_id"))} == {"1", "6", None}
    assert {x[0] for x in rows_of(O.rejected(df).select("job_id"))} == {"2", "3", "4", "5"}


def test_clean_casts_text_before_the_null_test(postings):
    df = postings(
        posting("1", salary="100.50"),
        posting("2", salary="n/a"),
        posting("3", salary="NaN"),
        posting("4", salary=" 7e3 "),
        salary="string",
    )
    assert rows_of(O.clean(df).select("job_id", "salary").orderBy("job_id")) == [("1", 100.5), ("4", 7000.0)]
    assert rows_of(O.rejected(df).select("job_id", "salary").orderBy("job_id")) == [("2", "n/a"), ("3", "NaN")]


def test_null_test_reaches_the_scan(spark, postings, tmp_path):
    postings(posting()).write.parquet(str(tmp_path / "p"))
    plan = O.overall_stats(O.clean(spark.read.parquet(str(tmp_path / "p"))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(salary)" in text and "IsNotNull(skills)" in text
    assert "company" not in text


def test_overall_stats(postings):
    df = postings(
        posting("1", salary=10.0),
        posting(None, salary=20.01, job_type="Onsite"),
        posting("3", salary=30.0, job_type=None),
    )
    assert rows_of(O.overall_stats(df)) == [(3, 20.0, 33.33)]


def test_overall_stats_of_nothing(postings):
    df = postings(posting()).filter("false")
    assert rows_of(O.overall_stats(df)) == [(0, None, 0.0)]


def test_groups_count_ids_and_sort_null_first(postings):
    df = postings(
        posting("1", experience_level="Lead", salary=1.0),
        posting("2", experience_level=None, salary=2.0),
        posting(None, experience_level="Lead", salary=4.0),
    )
    assert rows_of(O.salary_by_title_exp(df)) == [("Data Engineer", None, 2.0, 1), ("Data Engineer", "Lead", 2.5, 1)]


def test_skills_count_repeats_and_skip_empty_lists(postings):
    df = postings(
        posting("1", skills=["B", "B"], salary=10.0),
        posting("2", skills=["A", "C"], salary=20.0),
        posting("3", skills=["C"], salary=21.0),
        posting("4", skills=[], salary=99.0),
    )
    assert rows_of(O.skill_stats(df)) == [("B", 2, 10.0), ("C", 2, 20.5), ("A", 1, 20.0)]
    assert rows_of(O.top_skills(df, 2)) == [("B", 2, 10.0), ("C", 2, 20.5)]


def test_industry_share_is_null_without_ids(postings):
    df = postings(
        posting("1", industry="A"),
        posting("2", industry="A", job_type="Hybrid"),
        posting(None, industry="B"),
        posting("3", industry=None, salary=5.0, job_type="Onsite"),
    )
    assert rows_of(O.industry_metrics(df)) == [
        ("A", 2, 100000.0, 50.0),
        (None, 1, 5.0, 0.0),
        ("B", 0, 100000.0, None),
    ]


def test_band_edges(postings):
    amounts = [59999.99, 60000.0, 89999.99, 90000.0, 120000.0, 150000.0, 179999.99, 180000.0]
    df = O.with_band(postings(*[posting(str(i), salary=x) for i, x in enumerate(amounts)]))
    bands = [x[0] for x in rows_of(df.orderBy("job_id").select("salary_band"))]
    assert [BAND_LABELS.index(x) for x in bands] == [0, 1, 1, 2, 3, 4, 4, 5]
    odd = O.with_band(postings(posting("1", salary=None), posting("2", salary=math.nan)))
    assert rows_of(odd.select("salary_band")) == [(None,), (None,)]


def test_band_histogram_order_and_fill(postings):
    df = postings(posting("1", salary=200000.0), posting("2", salary=1.0), posting("3", salary=2.0))
    assert rows_of(O.salary_distribution(df)) == [("Under $60k", 2), ("Over $180k", 1)]
    assert rows_of(O.salary_distribution(df, fill=True)) == [(x, {0: 2, 5: 1}.get(i, 0)) for i, x in enumerate(BAND_LABELS)]
    with pytest.raises(ValueError):
        O.with_band(df, labels=["a"])


def test_one_scan_equals_the_single_operators(postings):
    df = postings(
        posting("1", skills=["A", "A", "B"], salary=61000.0),
        posting("2", job_title="X", skills=[], industry=None, salary=5.55),
        posting(None, experience_level=None, job_type="Onsite", skills=["B"]),
    )
    results = O.results_from_tally(O.market_tally(df))
    single = {
        "overall_stats": O.overall_stats(df),
        "salary_by_title_exp": O.salary_by_title_exp(df),
        "skills_analysis": O.skill_stats(df),
        "industry_metrics": O.industry_metrics(df),
        "salary_distribution": O.salary_distribution(df),
    }
    for name, expected in single.items():
        assert results[name].columns == expected.columns
        assert rows_of(results[name]) == rows_of(expected), name
    nothing = O.results_from_tally(O.market_tally(df.filter("false")))
    assert rows_of(nothing["overall_stats"]) == [(0, None, 0.0)]
    assert rows_of(nothing["skills_analysis"]) == []


def test_results_do_not_depend_on_partitioning(spark, sf_dir):
    import bindings

    df = O.clean(bindings.raw_postings(spark, sf_dir)).cache()
    for operator in (O.overall_stats, O.salary_by_title_exp, O.skill_stats, O.industry_metrics, O.salary_distribution):
        assert rows_of(operator(df)) == rows_of(operator(df.repartition(7, "salary")))
    df.unpersist()


def test_invariants(spark, sf_dir):
    import bindings

    df = O.clean(bindings.raw_postings(spark, sf_dir)).cache()
    total, mean, remote = rows_of(O.overall_stats(df))[0]
    titles, industries = rows_of(O.salary_by_title_exp(df)), rows_of(O.industry_metrics(df))
    assert sum(x[3] for x in titles) == sum(x[1] for x in industries) == total
    assert sum(x[1] for x in rows_of(O.salary_distribution(df))) == total
    assert sum(x[2] * x[3] for x in titles) / total == pytest.approx(mean, abs=0.01)
    assert sum(x[3] * x[1] for x in industries) / total == pytest.approx(remote, abs=0.01)
    df.unpersist()


def test_money(spark):
    df = spark.createDataFrame([(2.675,), (1.005,), (-2.675,), (None,), (1e300,)], "x double")
    assert [x[0] for x in rows_of(df.select(round_money(F.col("x"))))] == [2.68, 1.01, -2.68, None, 1e300]

    def mean(*amounts):
        table = spark.createDataFrame([(x,) for x in amounts], "x double")
        return rows_of(table.agg(*money_sums(F.col("x"))).select(mean_money()))[0][0]

    assert mean(0.1, 0.2) == 0.15
    assert mean(-1.0, -2.01) == -1.51
    assert mean(None, 5.0) == 5.0
    assert mean() is None
    assert mean(8e13, 8e13, 8e13) == 8e13
    assert mean(9e18, 9e18) == 9e18
    # Rounded once, at the end, and not each amount before.
    assert mean(10.0051, 10.0) == 10.0 and mean(10.006, 10.004) == 10.01
    assert math.isnan(mean(1e300, 1.0)) and math.isnan(mean(math.nan, 1.0)) and math.isnan(mean(math.inf, 1.0))
