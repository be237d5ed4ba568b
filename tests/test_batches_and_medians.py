"""Tallies by batch, exact medians, and reports that do not depend on the layout."""

import random
import statistics

import pytest
from postlens import operators as O
from postlens import plans
from postlens.sources import versions
from pyspark.sql import functions as F

from conftest import posting, rows_of


def test_batches_equal_one_run_in_any_split(spark, postings, tmp_path):
    draw = random.Random(3)
    rows = [
        posting(str(i) if i % 9 else None, job_title="AB"[i % 2], experience_level=[None, "Lead"][i % 5 == 0], salary=draw.choice([0.1, 99999.995, 7e5]) + i,
                skills=["x", "y", "x"][: i % 4], industry=[None, "Tech", "Law"][i % 3], job_type=["Remote", "Onsite"][i % 4 == 0])
        for i in range(60)
    ]
    whole = O.results_from_tally(O.market_tally(postings(*rows)))
    out = str(tmp_path / "b")
    with pytest.raises(ValueError, match="no batch"):
        plans.merged_tally(spark, out)
    plans.add_batch(postings(*rows[:10]), out, "day/1 ü")
    plans.add_batch(postings(*rows[:20]), out, "day/1 ü")
    plans.add_batch(postings(*rows[20:21]), out, "2")
    plans.add_batch(postings(*rows[21:]).repartition(7), out, "3")
    plans.add_batch(postings(*rows).limit(0), out, "empty")
    assert plans.batches(spark, out) == ["2", "3", "day/1 ü", "empty"]
    for name, result in plans.market_so_far(spark, out).items():
        assert rows_of(result) == rows_of(whole[name]), name
    with pytest.raises(ValueError, match="name"):
        plans.add_batch(postings(*rows), out, "")


def test_a_batch_that_fails_counts_as_before(spark, postings, tmp_path, monkeypatch):
    out = str(tmp_path / "b")
    plans.add_batch(postings(posting("1"), posting("2")), out, "1")
    monkeypatch.setattr(versions, "_announce", lambda *a: (_ for _ in ()).throw(OSError))
    with pytest.raises(OSError):
        plans.add_batch(postings(posting("1"), posting("2"), posting("3")), out, "1")
    with pytest.raises(OSError):
        plans.add_batch(postings(posting("4")), out, "2")
    assert plans.batches(spark, out) == ["1"]
    assert rows_of(plans.market_so_far(spark, out)["overall_stats"])[0][0] == 2


@pytest.mark.parametrize("bins", [100, 4096])
def test_medians(spark, bins):
    draw = random.Random(bins)
    rows = [(draw.choice(["a", "b", None]), draw.choice([5.25, -3.5, 1e9, draw.random() * 1000, round(draw.gauss(0, 50), 2)]), 1) for _ in range(400)]
    rows += [("one", 7.0, 1), ("two", 1.01, 1), ("two", 1.02, 1), ("same", 4.0, 1), ("same", 4.0, 1), ("none", None, 1), ("nan", float("nan"), 1)]
    rows += [("big", 1e15, 1), ("low", -3.9e12, 1), ("low", 3.9e12, 1)]
    df = spark.createDataFrame(rows, "key string, pay double, n int").repartition(5)
    want = {}
    for key, pay, _ in rows:
        if pay is not None and pay == pay and abs(pay) < 4e12:
            want.setdefault(key, []).append(round(pay, 6))
    got = {r.key: (r.median, r.n) for r in O.group_medians(df, ["key"], "pay", bins=bins).collect()}
    assert set(got) == set(want)
    for key, values in want.items():
        assert got[key] == (pytest.approx(statistics.median(values), abs=1e-6), len(values))
    assert O.group_medians(df.limit(0), ["key"], "pay").count() == 0
    every = O.group_medians(df, [], "pay", bins=bins).collect()
    assert every[0]["n"] == sum(map(len, want.values()))


def test_reports_are_equal_to_the_last_bit_in_any_layout(spark):
    draw = random.Random(5)
    rows = [(1e9 + draw.gauss(0, 1), 1e9 + draw.gauss(0, 1)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    reports = [rows_of(O.regression_report(x, digits=None)) for x in (df.coalesce(1), df.repartition(50), df.orderBy("label"))]
    assert reports[0] == reports[1] == reports[2]
    mean = statistics.fmean(y for y, _ in rows)
    r2 = 1 - sum((y - p) ** 2 for y, p in rows) / sum((y - mean) ** 2 for y, _ in rows)
    assert reports[0][0][1] == pytest.approx(r2, abs=1e-5)
    odd = spark.createDataFrame([(1.0, float("nan")), (2.0, 2.0), (None, 1.0)], "label double, prediction double")
    assert rows_of(O.regression_report(odd))[0][0] == 2 and str(rows_of(O.regression_report(odd))[0][1]) == "nan"
    assert rows_of(O.regression_report(df.limit(0))) == [(0, None, None)]
    assert rows_of(O.regression_report(df.limit(1).select("label", F.col("label").alias("prediction")))) == [(1, 1.0, 0.0)]
