import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from postlens import operators as O
from postlens.fixed_values import DEFAULT_ROLE, ROLE_FRAMEWORKS

STATS = [("SQL", 9, 115000.0), ("Go", 7, 115000.01), ("Ada", 7, 1234567.5), ("C", 2, 1.0), ("R", 1, 2.0)]


@pytest.fixture
def stats(spark):
    return spark.createDataFrame(STATS, "skill string, frequency bigint, avg_salary double")


def test_skill_roadmap_text(spark, stats):
    users = spark.createDataFrame(
        [("u", " SQL , ,go"), ("none", " , "), ("null", None), ("all", "SQL,Go,Ada,C,R"), ("odd", "Cobol,C,C")],
        "user_id string, skills string",
    )
    got = rows_of(O.skill_roadmap(users, stats, k=2).orderBy("user_id", "step"))
    ada = ("Ada", 1234567.5, "Expands market capability, average salary is $1,234,567.50.", "High")
    sql = ("SQL", 115000.0, "Expands market capability, average salary is $115,000.00.", "Medium")
    go = ("Go", 115000.01, "Expands market capability, average salary is $115,000.01.", "High")
    # Matching skills respects case, so "go" is not "Go".
    assert got == [("odd", 1, *sql), ("odd", 2, *ada), ("u", 1, *ada), ("u", 2, *go)]


def test_skill_roadmap_equals_brute_force(spark):
    rnd = random.Random(7)
    table = [(f"s{i:02}", rnd.randint(1, 9), float(i)) for i in range(40)]
    people = [(i, rnd.sample([x[0] for x in table], rnd.randint(0, 38)) + ["x"] * rnd.randint(0, 2)) for i in range(60)]
    stats = spark.createDataFrame(table, "skill string, frequency bigint, avg_salary double")
    users = spark.createDataFrame(people, "user_id bigint, skills array<string>").repartition(5)
    got = rows_of(O.skill_roadmap(users, stats).select("user_id", "step", "skill"))
    want = []
    ranked = sorted(table, key=lambda x: (-x[1], x[0]))
    for user, own in people:
        if own:
            missing = [x[0] for x in ranked if x[0] not in own][:5]
            want += [(user, step, skill) for step, skill in enumerate(missing, start=1)]
    assert sorted(got) == sorted(want)


def test_ranking_ignores_repeats_and_missing_keys(spark):
    """Repeated skills, null and NaN keys neither use up the answer nor come first."""
    nan = float("nan")
    table = [("AWS", 9, 1.0), *[("AWS", 8, 2.0)] * 5, ("Go", 5, 3.0), ("SQL", None, 4.0), (None, 7, 5.0), ("C", 4, 6.0)]
    stats = spark.createDataFrame(table, "skill string, frequency bigint, avg_salary double")
    users = spark.createDataFrame([(1, ["x"] * 10 + ["Go"]), (2, ["AWS", "C"])], "user_id bigint, skills array<string>")
    got = rows_of(O.skill_roadmap(users, stats, k=2).select("user_id", "step", "skill", "target_avg_salary"))
    assert sorted(got) == [(1, 1, "AWS", 1.0), (1, 2, "C", 6.0), (2, 1, "Go", 3.0)]
    ranked = [("AWS", None), ("Go", nan), ("PySpark", 0.2), ("Python", 0.5), ("Python", 0.5), ("Python", 0.1), ("Docker", 0.4)]
    vocabulary = spark.createDataFrame(ranked, "skill string, importance double")
    requests = spark.createDataFrame([request("1", ["SQL"])], SCHEMA)
    got = O.what_if(requests, vocabulary, O.pay_scorer(), max_candidates=2, order="importance")
    assert rows_of(got.orderBy("rank")) == [("1", 1, "Python", 4000), ("1", 2, "Docker", 4000)]


def test_lists_longer_than_the_vocabulary(spark, stats):
    own = [f"x{i}" for i in range(5000)]
    users = spark.createDataFrame([(1, own), (2, own + ["SQL"])], "user_id bigint, skills array<string>")
    names = [r.skill for r in stats.orderBy(F.desc("frequency"), "skill").collect()]
    got = rows_of(O.skill_roadmap(users, stats).select("user_id", "step", "skill"))
    want = [(1, i, x) for i, x in enumerate(names[:5], 1)]
    want += [(2, i, x) for i, x in enumerate([x for x in names if x != "SQL"][:5], 1)]
    assert sorted(got) == sorted(want)


def test_answers_hold_salary_demand_and_boosts(spark):
    requests = spark.createDataFrame([request("1", ["SQL"]), request("2", ["AWS", "Go"])], SCHEMA)
    got = O.predict_with_boosts(requests, words(spark, "Go", "AWS"), O.pay_scorer(), O.with_demand).orderBy("request_id")
    first, second = got.collect()
    assert [tuple(x) for x in first.boosts] == [("AWS", 8000), ("Go", 8000)] and second.boosts == []
    assert second.predicted_salary - first.predicted_salary == 16000 and first.demand_score in ("Low", "Medium", "High")


def test_nested_roadmap(spark, stats):
    requests = spark.createDataFrame([("1", "A")], "request_id string, role string")
    frameworks = O.frameworks_table(spark, {"A": [("t1", "d1", ["Missing", "SQL"]), ("t2", "d2", [])]})
    nested = O.nested_roadmap(O.role_roadmap(requests, frameworks, stats, default_role="A")).orderBy("step").collect()
    assert [[x.skill for x in r.skills] for r in nested] == [["Missing", "SQL"], []]


def test_role_roadmap(spark, stats):
    requests = spark.createDataFrame([("1", "Poet"), ("2", "B"), ("3", None)], "request_id string, role string")
    frameworks = O.frameworks_table(
        spark, {"A": [("t1", "d1", ["SQL", "Missing"]), ("t2", "d2", [])], "B": [("t3", "d3", ["Go"])]}
    )
    got = rows_of(
        O.role_roadmap(requests, frameworks, stats, default_role="A").orderBy("request_id", "step", "skill_pos")
    )
    a = [
        (1, "t1", "d1", "SQL", 1, 9, 115000.0),
        (1, "t1", "d1", "Missing", 2, None, None),
        (2, "t2", "d2", None, None, None, None),
    ]
    assert got == [
        *[("1", "Poet", *x) for x in a],
        ("2", "B", 1, "t3", "d3", "Go", 1, 7, 115000.01),
        *[("3", None, *x) for x in a],
    ]


def test_built_in_frameworks(spark, stats):
    table = rows_of(O.frameworks_table(spark))
    assert len(table) == sum(len(x) for x in ROLE_FRAMEWORKS.values())
    assert {x[0] for x in table} == set(ROLE_FRAMEWORKS)
    request = spark.createDataFrame([("1", "Astronaut")], "request_id string, role string")
    got = O.role_roadmap(request, O.frameworks_table(spark), stats)
    assert {x.title for x in got.collect()} == {x[0] for x in ROLE_FRAMEWORKS[DEFAULT_ROLE]}


def request(name, skills, title="Data Engineer", level="Senior"):
    return (name, title, level, "Hybrid", "Tech", skills)


SCHEMA = (
    "request_id string, job_title string, experience_level string, job_type string, industry string,"
    " skills array<string>"
)


def request(name, skills, title="Data Engineer", level="Senior"):
    return (name, title, level, "Hybrid", "Tech", skills)


def words(spark, *names):
    return spark.createDataFrame([(x,) for x in names], "skill string")


def test_what_if_rules(spark):
    requests = spark.createDataFrame(
        [request("1", ["SQL"]), request("2", None), request("3", ["AWS", "Go", "Python"]), request("4", ["x"], "Poet")],
        SCHEMA,
    )
    got = O.what_if(requests, words(spark, "SQL", "Python", "Go", "AWS"), O.pay_scorer())
    best = [(1, "AWS", 8000), (2, "Go", 8000), (3, "Python", 4000)]
    assert rows_of(got.orderBy("request_id", "rank")) == [("1", *x) for x in best] + [("2", *x) for x in best]


def test_what_if_tries_candidates_in_order(spark):
    requests = spark.createDataFrame([request("1", ["AWS"])], SCHEMA)
    vocabulary = spark.createDataFrame(
        [("AWS", 0.9), ("Go", 0.1), ("PySpark", 0.5), ("Cobol", 0.2), (None, 1.0)], "skill string, importance double"
    )
    by_name = O.what_if(requests, vocabulary, O.pay_scorer(), max_candidates=2)
    assert rows_of(by_name) == [("1", 1, "Go", 8000)]
    by_importance = O.what_if(requests, vocabulary, O.pay_scorer(), max_candidates=2, order="importance")
    assert rows_of(by_importance) == [("1", 1, "PySpark", 8000)]
    with pytest.raises(ValueError):
        O.what_if(requests, vocabulary, O.pay_scorer(), order="random")


def test_what_if_gain_is_strict_and_rounded(spark):
    requests = spark.createDataFrame([request("1", ["z"])], SCHEMA)
    gain = F.when(F.array_contains("skills", "a"), 500.0).when(F.array_contains("skills", "b"), 500.005).otherwise(0.0)
    got = O.what_if(requests, words(spark, "a", "b", "c"), lambda df: df.withColumn("prediction", gain))
    assert rows_of(got) == [("1", 1, "b", 500.01)]


def test_boost_is_the_difference_of_two_scores(spark, sf_dir):
    import bindings

    requests = bindings.requests(O.clean(bindings.raw_postings(spark, sf_dir))).cache()
    vocabulary = requests.select(F.explode("skills").alias("skill")).distinct()
    score = O.pay_scorer(bindings.PAY)
    found = O.what_if(requests, vocabulary, score)
    again = found.join(requests, "request_id")
    before = score(again).withColumnRenamed("prediction", "before")
    after = score(before.withColumn("skills", F.array_append("skills", F.col("skill"))))
    assert after.filter(F.col("prediction") - F.col("before") != F.col("boost_amount")).count() == 0
    assert after.filter(F.array_contains("skills", F.col("skill")) & (F.col("boost_amount") <= 500)).count() == 0
    requests.unpersist()


def test_equal_requests_are_answered_once(spark):
    rows = [request(str(i), ["SQL", "AWS"] if i % 2 else ["AWS", "SQL", None]) for i in range(20)]
    rows += [request("null", None), request("none", []), request("other", ["Go"]), (None, *request("", ["Go"])[1:])]
    rows += [("t", None, "Senior", "Hybrid", "Tech", []), ("e", "", "Senior", "Hybrid", "Tech", [])]
    requests = spark.createDataFrame(rows, SCHEMA)
    asked = []

    def answer(df):
        asked.append(df)
        return O.what_if(df, words(spark, "Go", "Python"), O.pay_scorer())

    got = rows_of(O.by_profile(requests, answer))
    want = rows_of(answer(requests.filter("request_id is not null")))
    assert sorted(x for x in got if x[0] is not None) == sorted(want)
    assert [x[1:] for x in got if x[0] is None] == [x[1:] for x in want if x[0] == "other"]
    # Two orders of one list, no skills twice, Go, a null title and an empty one.
    assert asked[0].count() == 5
