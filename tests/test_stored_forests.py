"""Large forests stay in their folder and answer as the models of ``pyspark.ml``."""

import pytest
from conftest import COLUMNS, posting, rows_of
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from postlens import operators as O
from postlens.operators import stored
from postlens.operators.features import FEATURES

SKILLS = ["A", "B", "C", "D", "E", "F"]


@pytest.fixture(scope="module")
def postings_of_all_kinds(spark):
    rows = []
    for i in range(400):
        own = [s for k, s in enumerate(SKILLS) if (i * 7919 >> k) % 3 == 0]
        pay = 50_000.25 + 9000 * ("A" in own) + 4000 * ("B" in own) * ("C" not in own) + 300 * (i % 11)
        label = ["Low", "Medium", "High"][(len(own) + (i % 5 == 0)) % 3]
        rows.append(posting(str(i), "Engineer" if i % 2 else "Analyst", skills=own, salary=pay, demand_score=label))
    return spark.createDataFrame(rows, COLUMNS).cache()


@pytest.fixture
def large(spark, postings_of_all_kinds, monkeypatch):
    monkeypatch.setattr(stored, "LOADED_NODES", 10)
    df = postings_of_all_kinds
    features = O.fit_features(df)
    sizes = {"trees": 7, "depth": 6, "blocks": 4}
    return df, O.Models(features, O.fit_salary(df, features, **sizes), O.fit_demand(df, features, **sizes))


def test_large_forests_answer_as_their_models(spark, large, tmp_path):
    df, models = large
    assert isinstance(models.salary, stored.Forest) and isinstance(models.demand, stored.Forest)
    # Nothing so far has built the forest's objects on the driver.
    assert "loaded" not in vars(models.salary) and "loaded" not in vars(models.demand)
    odd = spark.createDataFrame([(Vectors.dense([0.0] * len(models.features.names)),), (Vectors.dense([1.0] * len(models.features.names)),)], [FEATURES])
    asked = models.features.transform(df).select(FEATURES).unionByName(odd)
    for forest in (models.salary, models.demand):
        both = forest.transform(asked).withColumnRenamed("prediction", "walked")
        found = rows_of(forest.loaded.transform(both).select("walked", "prediction"))
        assert len(found) == 402 and len(set(found)) > 2 and all(a == b for a, b in found)
        assert rows_of(forest.transform(asked.limit(0))) == []
        want = forest.loaded.featureImportances.toArray()
        assert forest.featureImportances.toArray() == pytest.approx(want, abs=1e-12) and sum(want) == pytest.approx(1)
        assert forest.getNumTrees == forest.loaded.getNumTrees == 7 and forest.totalNumNodes == forest.loaded.totalNumNodes
        assert forest.numFeatures == forest.loaded.numFeatures
    requests = df.select(F.col("job_id").alias("request_id"), "job_title", "experience_level", "job_type", "industry", "skills")
    assert sorted(rows_of(O.predict(requests, models))) == sorted(rows_of(O.predict(requests, models.loaded())))


def test_large_forests_are_saved_as_models_are(spark, large, tmp_path, monkeypatch):
    df, models = large
    path = str(tmp_path / "m")
    O.save_models(models, path)
    O.save_models(models, path)
    with pytest.raises(OSError, match="exists"):
        models.salary.save(f"{path}/salary")
    back = O.load_models(path)
    assert isinstance(back.salary, stored.Forest) and "loaded" not in vars(models.salary)
    monkeypatch.setattr(stored, "LOADED_NODES", 100_000)
    small = O.load_models(path)
    assert not isinstance(small.salary, stored.Forest)
    requests = df.select(F.col("job_id").alias("request_id"), "job_title", "experience_level", "job_type", "industry", "skills")
    assert sorted(rows_of(O.predict(requests, back))) == sorted(rows_of(O.predict(requests, small)))
