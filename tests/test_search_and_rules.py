from conftest import posting, rows_of
from pyspark.sql import functions as F

from postlens import operators as O
from postlens.functions import decode_demand, encode_demand, has_any, parse_skill_list


def ids(df):
    return [x.job_id for x in df.collect()]


def test_search_filters(postings):
    df = postings(
        posting("b", job_title="Data Engineer"),
        posting("a", job_title="DATA Analyst", industry="finance", job_type="Onsite"),
        posting("c", job_title=None, industry=None),
        posting("d", job_title="100% Remote_Ops"),
    )
    assert ids(O.search_postings(df)) == ["a", "b", "c", "d"]
    assert ids(O.search_postings(df, title="", industry="", job_type=None)) == ["a", "b", "c", "d"]
    assert ids(O.search_postings(df, title="dAtA")) == ["a", "b"]
    assert ids(O.search_postings(df, title="%")) == ["d"]
    assert ids(O.search_postings(df, title="_")) == ["d"]
    assert ids(O.search_postings(df, title="data", industry="FINANCE", job_type="onsite")) == ["a"]
    assert ids(O.search_postings(df, industry="fin")) == []
    assert ids(O.search_postings(df, limit=1)) == ["a"]
    assert set(ids(O.search_postings(df, title="data", limit=None))) == {"a", "b"}


def test_search_keeps_only_the_first_rows_of_each_task(postings):
    plan = O.search_postings(postings(posting()), title="x")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_demand_points(postings):
    df = postings(
        posting("1", skills=["Python"], experience_level="Entry-level"),
        posting("2", skills=["Python"], experience_level="Lead", industry="Education"),
        posting("3", skills=["Cobol"], experience_level="Lead", job_type="Onsite"),
        posting("4", skills=None, experience_level=None, job_type=None, industry=None),
        posting("5", skills=[None, "Cobol"], experience_level="Lead"),
    )
    got = O.with_demand(df).orderBy("job_id").select("demand_score")
    assert [x[0] for x in rows_of(got)] == ["High", "Medium", "Low", "Low", "Medium"]


def test_skill_premium(postings):
    df = postings(
        posting("1", skills=["Go", "Python", "Go", "Cobol"]),
        posting("2", skills=[]),
        posting("3", skills=None),
        posting("4", skills=[None, "AWS"]),
    )
    got = O.with_skill_premium(df).orderBy("job_id").select("skill_premium")
    assert [x[0] for x in rows_of(got)] == [20000, 0, 0, 8000]
    both = O.with_skill_premium(df, [(10, ["Go"]), (1, ["Go", "Cobol"])]).orderBy("job_id").select("skill_premium")
    assert rows_of(both)[0] == (21,)


def test_expected_salary(postings, spark):
    df = postings(
        posting("1", job_title="Data Engineer", experience_level="Senior", skills=["PySpark"]),
        posting("2", job_title="Frontend Developer", experience_level="Entry-level", job_type="Onsite", skills=[]),
        posting("3", job_title="Poet"),
        posting("4", experience_level="Chief"),
        posting("5", job_title="Data Engineer", experience_level="Mid-level", job_type="Hybrid", skills=None),
    )
    want = [(100000 * 140 // 100 + 8000 + 5000,), (56500,), (None,), (None,), (100000,)]
    assert rows_of(O.with_expected_salary(df).orderBy("job_id").select("expected_salary")) == want
    base = spark.createDataFrame([("Data Engineer", 100000), ("Frontend Developer", 85000)], "t string, p int")
    joined = O.with_expected_salary(df, O.PayRules(base=base))
    assert rows_of(joined.orderBy("job_id").select("expected_salary")) == want
    assert joined.columns == df.columns + ["expected_salary"]


def test_expected_salary_rounds_halves_to_even_and_has_a_floor(postings):
    def pay(base, percent=100):
        rules = O.PayRules(base={"X": base}, level_percent={"Senior": percent}, type_step={}, tiers=())
        df = postings(posting("1", job_title="X"))
        return rows_of(O.with_expected_salary(df, rules).select("expected_salary"))[0][0]

    assert pay(40150) == 40200
    assert pay(40250) == 40200
    assert pay(40251) == 40300
    assert pay(50001, 70) == 35000
    assert pay(1000) == 30000


def test_demand_codes(postings):
    df = postings(*[posting(str(i), demand_score=x) for i, x in enumerate(["Low", "Medium", "High", "Huge", None])])
    coded = decode_demand(encode_demand(df), "demand_code", "back").orderBy("job_id").select("demand_code", "back")
    assert rows_of(coded) == [(0.0, "Low"), (1.0, "Medium"), (2.0, "High"), (None, None), (None, None)]


def test_skill_list_text(spark):
    df = spark.createDataFrame([(" Python , ,SQL ",), ("",), (None,), ("\tA B\n,C",)], "s string")
    assert [x[0] for x in rows_of(df.select(parse_skill_list(F.col("s"))))] == [["Python", "SQL"], [], [], ["A B", "C"]]


def test_has_any_is_never_null(spark):
    df = spark.createDataFrame([([None, "a"],), (None,), (["b"],)], "s array<string>")
    assert [x[0] for x in rows_of(df.select(has_any(F.col("s"), ["b"])))] == [False, False, True]
    assert [x[0] for x in rows_of(df.select(has_any(F.col("s"), [])))] == [False, False, False]


def test_pay_table_may_repeat_titles(postings, spark):
    base = spark.createDataFrame([("Data Engineer", 100000), ("Data Engineer", 90000)], "title string, pay bigint")
    df = postings(posting("1"), posting("2"))
    got = O.with_expected_salary(df, O.PayRules(base=base)).select("job_id", "expected_salary").orderBy("job_id")
    want = O.with_expected_salary(df).select("job_id", "expected_salary").orderBy("job_id")
    assert rows_of(got) == rows_of(want)


def test_demand_rules_are_arguments(postings):
    rules = O.DemandRules(remote="Anywhere", remote_points=9, labels=("l", "m", "h"))
    df = postings(posting("1", job_type="Anywhere"), posting("2", skills=[], industry="x", experience_level="x"))
    assert [r.demand_score for r in O.with_demand(df, rules).orderBy("job_id").collect()] == ["h", "l"]
