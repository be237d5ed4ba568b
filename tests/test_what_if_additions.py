"""Additions scored from what is known of a request equal those scored from the whole list."""

import pytest
from postlens import operators as O
from postlens.functions import missing_keys, with_missing_ranks
from pyspark.sql import functions as F

from conftest import rows_of

SCHEMA = "request_id string, job_title string, experience_level string, job_type string, industry string, skills array<string>"
ROWS = [
    ("1", "Clerk", "Senior", "Remote", "Tech", ["SQL", "SQL"]),
    ("2", "Clerk", "Senior", "Hybrid", None, None),
    ("2", "Clerk", "Lead", "Onsite", "Tech", [None, "b", "zzz"]),
    ("2", "Clerk", "Lead", "Onsite", "Tech", [None, "b", "zzz"]),
    ("3", "Poet", "Lead", "Onsite", "Tech", ["a"]),
    ("4", "Cook", None, "Remote", "Tech", ["a"]),
    (None, "Cook", "Mid-level", None, "Tech", ["a", "a", "c"]),
    ("5", None, "Mid-level", "Remote", "Tech", []),
    ("6", "Cook", "Entry-level", "Remote", "Tech", ["d", "e", "f"]),
]
TIERS = ((1730, ("a", "b")), (949, ("b", "c", "SQL")), (-9000, ("d",)))
BASE = {"Clerk": 60055, "Cook": 21017}


@pytest.fixture
def asked(spark):
    table = [("d", 1.0), *((x, float(i)) for i, x in enumerate("abcef")), ("SQL", 9.0), ("a", 0.5), (None, 7.0), ("zzz", None)]
    return spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(table, "skill string, importance double")


@pytest.mark.parametrize("order", ["alphabetical", "importance"])
@pytest.mark.parametrize("as_table", [False, True])
def test_additions_equal_whole_scores(spark, asked, order, as_table):
    base = spark.createDataFrame([*BASE.items(), ("Clerk", 1)], "title string, pay bigint") if as_table else BASE
    scorer = O.pay_scorer(O.PayRules(base=base, tiers=TIERS))
    for options in ({"min_gain": 0}, {"min_gain": -1e9, "k": 9}, {"max_candidates": 2}):
        quick = O.what_if(*asked, scorer, order=order, **options)
        whole = O.what_if(*asked, lambda df: scorer(df), order=order, **options)
        assert sorted(map(str, rows_of(quick))) == sorted(map(str, rows_of(whole))) and quick.schema == whole.schema
        assert options.get("k", 0) < 9 or quick.count() > 9


def test_a_premium_is_summed_once_for_a_request(asked):
    plan = O.what_if(*asked, O.pay_scorer(O.PayRules(base=BASE, tiers=TIERS)))._jdf.queryExecution().optimizedPlan().toString()
    above, marker, _ = plan.partition("Generate posexplode")
    assert marker and "lambda" not in above and plan.count("aggregate(") == 1


@pytest.mark.parametrize("few", [0, 1000])
def test_missing_keys_are_the_missing_ranks(spark, few):
    ranks = spark.createDataFrame([(x, i) for i, x in enumerate("gcafdbe", 1)], "key string, rank int")
    people = spark.createDataFrame([(1, ["c", "x"]), (2, []), (3, list("abcdefg")), (4, ["g", "g", "f"])], "id int, own array<string>")
    got = missing_keys(people, ranks, "id", "own", "key", 3, few).select("id", "_pos", "key")
    held = with_missing_ranks(people, ranks, "id", "own", "key", 3, few).select("id", F.posexplode("_missing").alias("_pos", "rank"))
    want = held.join(ranks, "rank").select("id", "_pos", "key")
    assert sorted(rows_of(got)) == sorted(rows_of(want)) and got.filter("id = 2").count() == 3
