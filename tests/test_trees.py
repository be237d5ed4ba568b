"""Forests as tables: nodes, leaf paths, walks and reproducible bagging."""

import math

import duckdb
import numpy as np
import pytest
from postlens import operators as O
from postlens.operators import bagging, trees
from pyspark.sql import functions as F

from conftest import COLUMNS, posting, rows_of

SKILLS = ["A", "B", "C", "D", "E", "F"]


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    draw = np.random.default_rng(5)
    rows = []
    for i in range(300):
        own = [s for s in SKILLS if draw.random() < 0.4]
        level = ["Senior", "Lead", None][i % 3]
        pay = 50_000 + 9000 * ("A" in own) + 4000 * ("B" in own) * ("C" not in own) + 3000 * len(own) + 2000 * (level == "Lead")
        rows.append(posting(str(i), "Engineer" if i % 2 else "Analyst", skills=own, experience_level=level, salary=float(pay),
                            demand_score=["Low", "Medium", "High"][len(own) % 3]))
    df = spark.createDataFrame(rows, COLUMNS).cache()
    features = O.fit_features(df)
    sizes = {"trees": 6, "depth": 5}
    models = O.Models(features, O.fit_salary(df, features, **sizes), O.fit_demand(df, features, **sizes))
    path = str(tmp_path_factory.mktemp("models"))
    O.save_models(models, path)
    return df, models, path


def requests_of(df):
    asked = df.select(F.col("job_id").alias("request_id"), "job_title", "experience_level", "job_type", "industry", "skills")
    spark = df.sparkSession
    odd = [("x1", "Poet", None, None, None, None), ("x2", None, "Lead", "Remote", "Tech", ["A", None, "A", "Z"]), ("x3", "Analyst", "", "", "", [])]
    return asked.unionByName(spark.createDataFrame(odd, asked.schema))


def vocabulary_of(spark, *extra):
    return spark.createDataFrame([(s, float(i)) for i, s in enumerate([*SKILLS, *extra])], "skill string, importance double")


def test_levels_are_the_slots_of_the_vector(fitted):
    _, models, _ = fitted
    levels = models.features.levels()
    for (field, value), slot in levels.items():
        name = value if field == "skills" else f"{field}_{value}"
        assert models.features.names[slot] == name
    assert sorted(levels.values()) == list(range(len(models.features.names)))


def test_walk_equals_scoring_each_candidate(spark, fitted):
    df, models, path = fitted
    nodes = O.forest_nodes(spark, f"{path}/salary")
    asked = requests_of(df)
    scorer = O.salary_scorer(models.features, models.salary)
    extra = spark.createDataFrame([("B", 99.0), ("Q", None), ("R", float("nan")), (None, 5.0)], "skill string, importance double")
    vocabulary = vocabulary_of(spark, "AA", "Z").unionByName(extra)
    for options in ({}, {"order": "importance"}, {"max_candidates": 2, "k": 1, "min_gain": 0}, {"min_gain": -1e9, "k": 9}):
        want = sorted(rows_of(O.what_if(asked, vocabulary, scorer, **options)))
        got = sorted(rows_of(O.what_if_by_walk(asked, vocabulary, models.features, nodes, **options)))
        assert got == want and want
    assert O.what_if_by_walk(asked.limit(0), vocabulary, models.features, nodes).count() == 0
    assert O.what_if_by_walk(asked, vocabulary.limit(0), models.features, nodes).count() == 0
    with pytest.raises(ValueError, match="order"):
        O.what_if_by_walk(asked, vocabulary, models.features, nodes, order="size")
    with pytest.raises(ValueError, match="nodes"):
        O.what_if_by_walk(asked, vocabulary, models.features, nodes, max_nodes=3)
    with pytest.raises(ValueError, match="skills"):
        O.what_if_by_walk(asked, vocabulary, models.features, nodes, max_levels=3)


def test_node_tables_predict_as_the_models(spark, fitted):
    df, models, path = fitted
    asked = requests_of(df)
    salary, demand = (O.forest_nodes(spark, f"{path}/{x}") for x in ("salary", "demand"))
    want = sorted(rows_of(O.predict(asked, models)))
    assert sorted(rows_of(O.predict_by_nodes(asked, models.features, salary, demand, 5))) == want


def test_leaf_paths_in_sql(spark, fitted):
    """Every request reaches one leaf of each tree, and the answer to any addition follows from the paths."""
    df, models, path = fitted
    nodes = O.forest_nodes(spark, f"{path}/salary")
    paths = O.leaf_paths(nodes).toPandas()  # noqa: F841
    assert len(paths) == nodes.filter("feature is null").count()
    assert not O.leaf_paths(nodes.limit(0)).count()
    levels = models.features.levels()
    skills = {s: levels["skills", s] for s in SKILLS if ("skills", s) in levels}
    base = trees.owned_features(requests_of(df), models.features).select("request_id", "_owned").toPandas()
    rows = [(r, None, list(own)) for r, own in zip(base.request_id, base._owned)]
    rows += [(r, s, [*own, f]) for r, _, own in rows for s, f in skills.items() if f not in own]
    asked = spark.createDataFrame(rows, "request_id string, skill string, owned array<int>").toArrow()  # noqa: F841
    found = duckdb.sql("""
        WITH reached AS (
          SELECT request_id, skill, tree, value FROM asked, paths
          WHERE list_has_all(owned, required) AND len(list_intersect(owned, forbidden)) = 0
        ),
        scores AS (
          SELECT request_id, skill, count(*) AS n, count(DISTINCT tree) AS trees, avg(value) AS score FROM reached GROUP BY ALL
        )
        SELECT a.request_id, a.skill, a.score - b.score AS boost, a.n, a.trees
        FROM scores a JOIN scores b ON a.request_id = b.request_id AND b.skill IS NULL
    """).fetchall()
    assert len(found) == len(rows) and all(n == t == 6 for *_, n, t in found)
    got = O.what_if_by_walk(requests_of(df), vocabulary_of(spark), models.features, nodes, min_gain=-1e9, k=99).collect()
    boosts = {(r.request_id, r.skill): r.boost_amount for r in got}
    for request, skill, boost, _, _ in found:
        if skill is not None:
            assert abs(boosts[request, skill] - boost) < 0.01


def test_bagged_forest_is_the_same_in_any_layout(spark, fitted, tmp_path):
    df, models, _ = fitted
    tables = []
    for i, layout in enumerate((df, df.repartition(5).orderBy(F.desc("salary")))):
        salary = O.fit_bagged_salary(layout, models.features, trees=3, depth=4)
        demand = O.fit_bagged_demand(layout, models.features, trees=3, depth=4)
        O.save_models(O.Models(models.features, salary, demand), f"{tmp_path}/{i}")
        tables.append([sorted(map(str, O.forest_nodes(spark, f"{tmp_path}/{i}/{x}").collect())) for x in ("salary", "demand")])
        back = O.load_models(f"{tmp_path}/{i}")
        assert back.salary.getNumTrees == back.demand.getNumTrees == 3
        assert abs(sum(back.salary.featureImportances.toArray()) - 1) < 1e-9
        assert sorted(rows_of(O.predict(requests_of(df), back)))[0][1] > 0
    assert tables[0] == tables[1]
    assert len({str(x) for x in tables[0][0]}) > 3


def test_bag_weights_are_poisson(spark):
    steps = bagging.poisson_steps()
    assert steps[:3] == [math.floor(2**32 * x) for x in (math.exp(-1), 2 * math.exp(-1), 2.5 * math.exp(-1))]
    rows = spark.range(20_000).select(*[bagging.bag_weight(F.col("id").cast("string"), t).alias(f"w{t}") for t in (0, 1)])
    mean, variance, both = rows.agg(F.avg("w0"), F.var_pop("w0"), F.corr("w0", "w1")).first()
    assert abs(mean - 1) < 0.03 and abs(variance - 1) < 0.05 and abs(both) < 0.03
