"""

Every query reads the driver's tables through ``bindings``, whole.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import bindings as B  # noqa: E402
from oracles import ORACLES  # noqa: E402
from postlens import operators as O  # noqa: E402
from postlens import plans, sources  # noqa: E402
from postlens.fixed_values import FOREST_DEPTH  # noqa: E402
from postlens.functions import decode_demand, encode_demand, parse_skill_list, round_money  # noqa: E402

# Equal profiles are averaged into this many weighted rows before the full-size forests are trained.
BLOCKS = 8
_fitted: dict[tuple[str, str], tuple[str, str]] = {}
# Loaded once as well: reading fifty deep trees takes longer than asking them.
_loaded: dict[str, O.Models] = {}

try:
    import corpus_pipeline
    from postlens.llm import queries as text
except ImportError:  # the text operators are an optional part
    TEXT_QUERIES, TEXT_ORACLES = {}, {}
else:
    TEXT_QUERIES, TEXT_ORACLES = {**text.QUERIES, "pipeline": corpus_pipeline.run}, text.ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.clean(B.raw_postings(spark, sf_dir))


def _on_clean(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_clean(spark, sf_dir))


def _on_raw(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(B.raw_postings(spark, sf_dir))


def _flat(df: DataFrame) -> DataFrame:
    """Skill lists as text, which any engine can compare."""
    return df.withColumn("skills", F.array_join("skills", ",")).drop("customer")


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned postings in a table of their own, for queries that read them more than once."""
    columns = ("job_id", "job_title", "experience_level", "job_type", "industry", "salary", "skills", "customer")
    return sources.materialize(_clean(spark, sf_dir).select(*columns), "postings")


def _stored_skill_stats(postings: DataFrame) -> DataFrame:
    return sources.materialize(O.skill_stats(postings), "skill_stats")


def _market_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five results, from one scan, in one table."""
    tally = sources.materialize(O.market_tally(_clean(spark, sf_dir)), "market_tally")
    shapes = {
        "overall_stats": (None, None, "total_jobs", "average_salary", "remote_percentage"),
        "salary_by_title_exp": ("job_title", "experience_level", "job_count", "avg_salary", None),
        "skills_analysis": ("skill", None, "frequency", "avg_salary", None),
        "industry_metrics": ("industry", None, "job_count", "avg_salary", "remote_percentage"),
        "salary_distribution": ("salary_band", None, "count", None, None),
    }
    types = ("string", "string", "bigint", "double", "double")
    names = ("key", "key2", "n", "mean", "remote")
    parts = [
        result.select(
            F.lit(name).alias("result"),
            *[
                (F.lit(None) if col is None else F.col(col)).cast(kind).alias(out)
                for col, kind, out in zip(shapes[name], types, names)
            ],
        )
        for name, result in O.results_from_tally(tally).items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _insights_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{sources.shared_dir(spark)}/insights-{uuid4().hex}"
    run = plans.record_market(B.raw_postings(spark, sf_dir), folder)
    return sources.insights(spark, run.results_dir)["skills_analysis"]


def _republished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded twice to one place, first without the remote postings: readers see the second run."""
    folder = f"{sources.shared_dir(spark)}/market-{uuid4().hex}"
    raw = B.raw_postings(spark, sf_dir)
    plans.record_market(raw.filter(F.col("job_type") != "Remote"), folder)
    plans.record_market(raw, folder)
    sources.remove_old_versions(spark, folder, keep=1)
    return sources.insights(spark, folder)["industry_metrics"]


def _market_by_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Industries from three batches of postings, one of them sent twice, the first time only in part."""
    folder = f"{sources.shared_dir(spark)}/batches-{uuid4().hex}"
    postings = _stored(spark, sf_dir)
    number = F.pmod(F.xxhash64("job_id"), F.lit(3))
    plans.add_batch(postings.filter((number == 1) & (F.col("job_type") != "Remote")), folder, "1")
    for i in range(3):
        plans.add_batch(postings.filter(number == i), folder, str(i))
    return plans.market_so_far(spark, folder)["industry_metrics"]


def _median_of_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    medians = O.group_medians(_stored(spark, sf_dir), ["job_title", "experience_level"], out="median_salary")
    return medians.withColumn("median_salary", F.round("median_salary", 4))


def _median_of_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = sources.materialize(_clean(spark, sf_dir).select(F.explode("skills").alias("skill"), "salary"), "skill_pay")
    return O.group_medians(each, ["skill"], out="median_salary").withColumn("median_salary", F.round("median_salary", 4))


def _json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sources.shared_dir(spark)}/postings-{uuid4().hex}"
    sources.write_result(B.raw_postings(spark, sf_dir).drop("customer"), path)
    return _flat(O.clean(sources.read_postings(spark, path, multi_line=False)))


def _skill_roadmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = _stored(spark, sf_dir)
    people = sources.materialize(B.users(postings), "users")
    return O.skill_roadmap(people, _stored_skill_stats(postings), high=B.HIGH_ABOVE)


def _role_roadmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = _stored(spark, sf_dir)
    stats = _stored_skill_stats(postings)
    return O.role_roadmap(B.role_requests(postings), B.frameworks(spark), stats, default_role=B.DEFAULT_ROLE)


def _what_if_rule(order: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        postings = _stored(spark, sf_dir)
        vocabulary = _stored_skill_stats(postings).withColumnRenamed("avg_salary", "importance")
        return O.what_if(B.requests(postings), vocabulary, O.pay_scorer(B.PAY), order=order)

    return build


def _what_if_rule_by_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = B.requests(_stored(spark, sf_dir))
    return O.by_profile(requests, lambda df: O.what_if(df, _vocabulary(requests), O.pay_scorer(B.PAY)))


def _vocabulary(rows: DataFrame) -> DataFrame:
    return O.category_values(rows, (), ("skills",)).select(F.col("value").alias("skill"))


def _roadmap_of_some(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A statistics table with repeats and missing frequencies, and people who know a few skills."""
    postings = _stored(spark, sf_dir)
    stats = _stored_skill_stats(postings)
    again = stats.withColumn("frequency", F.col("frequency") - 1).unionByName(stats).unionByName(stats)
    unknown = stats.withColumn("frequency", F.lit(None).cast("bigint"))
    return O.skill_roadmap(B.some_users(postings), again.unionByName(unknown), high=B.HIGH_ABOVE)


def _boost_text(answers: DataFrame) -> DataFrame:
    """Answers with their boosts as text, which any engine can compare."""
    one = lambda x: F.concat(x["skill"], F.lit(":"), x["boost_amount"].cast("bigint").cast("string"))
    return answers.withColumn("boosts", F.array_join(F.transform("boosts", one), "|"))


def _answers_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = B.requests(_stored(spark, sf_dir))
    demand = lambda df: O.with_demand(df, B.DEMAND)
    return _boost_text(O.predict_with_boosts(requests, _vocabulary(requests), O.pay_scorer(B.PAY), demand))


def _nested_role_roadmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = O.nested_roadmap(_role_roadmap(spark, sf_dir))
    return nested.withColumn("skills", F.array_join(F.transform("skills", lambda x: x["skill"]), ","))


def _array_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as indented arrays and read with the default settings."""
    path = f"{sources.shared_dir(spark)}/arrays-{uuid4().hex}"
    raw = B.raw_postings(spark, sf_dir).drop("customer")

    def written(name):
        one = F.to_json(F.array(name))
        return F.concat(F.lit(f'    "{name}": '), one.substr(F.lit(2), F.length(one) - 2))

    fields = [written(name) for name in raw.columns]
    record = F.concat(F.lit("  {\n"), F.concat_ws(",\n", *fields), F.lit("\n  }"))
    # One file for each array of some thousand records.
    group = F.pmod(F.xxhash64("job_id"), F.lit(raw.count() // 4000 + 1)).alias("file")
    arrays = raw.select(record.alias("value"), group).groupBy("file").agg(F.collect_list("value").alias("records"))
    text = F.concat(F.lit("[\n"), F.array_join("records", ",\n"), F.lit("\n]"))
    arrays.select("file", text.alias("value")).write.partitionBy("file").text(path)
    return _flat(O.clean(sources.read_postings(spark, path)))


def _any_array_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as arrays in one line, whose texts hold braces and quotes, and read without a known layout."""
    path = f"{sources.shared_dir(spark)}/lines-{uuid4().hex}"
    raw = B.raw_postings(spark, sf_dir).drop("customer")
    awkward = raw.withColumn("company", F.concat(F.lit('} "{\\" ]['), "company"))
    group = F.pmod(F.xxhash64("job_id"), F.lit(raw.count() // 4000 + 1)).alias("file")
    arrays = awkward.select(F.to_json(F.struct(*awkward.columns)).alias("value"), group).groupBy("file")
    text = arrays.agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value"))
    text.write.partitionBy("file").text(path)
    return _flat(O.clean(sources.read_postings(spark, path, indent="any")))


def _parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sources.shared_dir(spark)}/parquet-{uuid4().hex}"
    sources.write_result(B.raw_postings(spark, sf_dir).drop("customer"), path, "parquet")
    return _flat(O.clean(sources.read_postings(spark, path, fmt="parquet")))


def _expected_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pay rules as a table that repeats titles with lower pay."""
    rows = [(title, pay - less) for title, pay in B.PAY.base.items() for less in (0, 5000)]
    base = spark.createDataFrame(rows, "title string, base_pay bigint")
    rules = O.PayRules(base=base, tiers=B.PAY.tiers)
    return O.with_expected_salary(_clean(spark, sf_dir), rules).select("job_id", "expected_salary")


def _odd(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(O.clean(B.odd_postings(B.raw_postings(spark, sf_dir))))


def _with_pay(df: DataFrame) -> DataFrame:
    paid = O.with_expected_salary(df, B.odd_pay())
    return O.with_skill_premium(paid, B.PAY.tiers).select("job_id", "job_title", "expected_salary", "skill_premium")


def _unknown_predictions(build: Callable[[DataFrame, str, str], DataFrame]) -> Query:
    """On demand labels and a second opinion that is missing where the level is."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        both = O.with_demand(B.raw_postings(spark, sf_dir), B.SHIFTED_DEMAND, out="other_demand")
        odd = O.clean(B.odd_postings(both))
        known = F.when(F.col("experience_level").isNotNull(), F.col("other_demand"))
        return build(odd.withColumn("other_demand", known), "demand_score", "other_demand")

    return run


def _features_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = _clean(spark, sf_dir)
    return O.features_long(postings, O.category_values(postings))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored training rows with a salary that the features explain."""
    paid = O.with_expected_salary(_clean(spark, sf_dir), B.PAY)
    rows = paid.withColumn("salary", F.col("expected_salary").cast("double"))
    return sources.materialize(sources.training_extract(rows, id_col="job_id"), "extract")


def _fit_once(kind: str, fit: Callable[[DataFrame, str], None]):
    """(rows, models) of a table folder, fitted by the first query that asks, then loaded."""

    def load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, O.Models]:
        key = (f"{spark.sparkContext.applicationId}/{kind}", sf_dir)
        if key not in _fitted:
            rows, out = _labelled(spark, sf_dir), f"{sources.shared_dir(spark)}/{kind}-{uuid4().hex}"
            rows_path = f"{out}/rows"
            sources.write_result(rows, rows_path, "parquet")
            fit(spark.read.parquet(rows_path), out)
            _fitted[key] = (rows_path, f"{sources.current_version(spark, out)}/models")
        rows_path, models = _fitted[key]
        if models not in _loaded:
            _loaded[models] = O.load_models(models)
        return spark.read.parquet(rows_path), _loaded[models]

    return load


_forests = _fit_once("forests", lambda rows, out: plans.train(rows, out, blocks=BLOCKS))


def _fit_tree(rows: DataFrame, out: str) -> None:
    """One tree of depth 2 on all rows, which SQL can fit as well; it learns the skills' premium."""
    features = O.fit_features(rows)
    paid = O.with_skill_premium(rows, B.PAY.tiers)
    exact = {"trees": 1, "depth": 2, "bootstrap": False}
    salary = O.fit_salary(paid, features, label="skill_premium", **exact)
    O.save_models(O.Models(features, salary, O.fit_demand(paid, features, **exact)), f"{out}/models")


_tree = _fit_once("tree", _fit_tree)


def _fit_bagged(rows: DataFrame, out: str) -> None:
    """Three bagged trees of depth 2 on one row a posting, which SQL can fit as well."""
    features = O.fit_features(rows)
    paid = O.with_skill_premium(rows, B.PAY.tiers)
    sizes = {"trees": 3, "depth": 2}
    salary = O.fit_bagged_salary(paid, features, label="skill_premium", **sizes)
    O.save_models(O.Models(features, salary, O.fit_bagged_demand(paid, features, **sizes)), f"{out}/models")


_bagged = _fit_once("bagged", _fit_bagged)


def _nodes(spark: SparkSession, sf_dir: str, kind: str, model: str = "salary") -> DataFrame:
    """Node table of a model that ``_fit_once`` has saved."""
    return O.forest_nodes(spark, f"{_saved(spark, sf_dir, kind)}/{model}")


def _saved(spark: SparkSession, sf_dir: str, kind: str) -> str:
    return _fitted[f"{spark.sparkContext.applicationId}/{kind}", sf_dir][1]


def _node_predictions(fitted, kind: str, depth: int) -> Query:
    """Predictions by walking the saved node tables down."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, models = fitted(spark, sf_dir)
        salary, demand = (_nodes(spark, sf_dir, kind, x) for x in ("salary", "demand"))
        return O.predict_by_nodes(B.requests(rows), models.features, salary, demand, depth)

    return build


def _nodes_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the full-size forests answer each request as their node tables do."""
    rows, models = _forests(spark, sf_dir)
    walked = _node_predictions(_forests, "forests", FOREST_DEPTH)(spark, sf_dir).select(
        F.col("request_id").alias("_id"), F.struct("predicted_salary", "demand_score").alias("walked")
    )
    answers = O.predict(B.requests(rows), models.loaded()).select("request_id", F.struct("predicted_salary", "demand_score").alias("answer"))
    both = answers.join(walked, F.col("request_id") == F.col("_id"), "left")
    return both.select("request_id", F.col("answer").eqNullSafe(F.col("walked")).alias("same"))


def _leaf_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths to the leaves of the single tree, features by name."""
    _, models = _tree(spark, sf_dir)
    names = F.array(*[F.lit(x) for x in models.features.names])
    listed = [F.array_join(F.array_sort(F.transform(x, lambda i: F.get(names, i))), ",").alias(x) for x in ("required", "forbidden")]
    return O.leaf_paths(_nodes(spark, sf_dir, "tree")).select(*listed, F.round("value", 6).alias("value"))


def _recorded(fitted, kind: str, name: str) -> Query:
    """A result that training has recorded beside the models, read back."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        fitted(spark, sf_dir)
        folder = _saved(spark, sf_dir, kind).removesuffix("/models")
        return sources.read_result(spark, f"{folder}/{name}", name)

    return build


def _salary_predictions(fitted) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, models = fitted(spark, sf_dir)
        scored = O.salary_scorer(models.features, models.salary)(B.requests(rows))
        return scored.select("request_id", round_money(F.col("prediction")).alias("predicted_salary"))

    return build


def _demand_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, models = _forests(spark, sf_dir)
    scored = models.demand.transform(models.features.transform(B.requests(rows)))
    return decode_demand(scored, "prediction").select("request_id", "demand_score")


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, models = _forests(spark, sf_dir)
    return O.predict(B.requests(rows), models)


def _importances(fitted) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, models = fitted(spark, sf_dir)
        return O.feature_importances(models.salary, models.features, rows).drop("position")

    return build


def _rounded_importances(build: Query) -> Query:
    return lambda spark, sf_dir: build(spark, sf_dir).withColumn("importance", F.round("importance", 6))


def _what_if_scored(fitted) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, models = fitted(spark, sf_dir)
        return O.what_if(B.requests(rows), _vocabulary(rows), O.salary_scorer(models.features, models.salary))

    return build


def _what_if_walked(fitted, kind: str, order: str = "alphabetical") -> Query:
    """``order="importance"`` tries the skills that matter most to the model first."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, models = fitted(spark, sf_dir)
        vocabulary = _vocabulary(rows)
        if order == "importance":
            importances = O.feature_importances(models.salary, models.features, rows).select("feature", "importance")
            vocabulary = vocabulary.join(importances, F.col("skill") == F.col("feature")).select("skill", "importance")
        return O.what_if_by_walk(B.requests(rows), vocabulary, models.features, _nodes(spark, sf_dir, kind), order=order)

    return build


def _forest_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for the full-size forests whatever trees they grew."""
    rows, models = _forests(spark, sf_dir)
    answers = O.predict(B.requests(rows), models).join(rows.select("job_id", "salary"), F.col("request_id") == F.col("job_id"))
    quality = O.regression_report(answers, "salary", "predicted_salary")
    whole = F.col("predicted_salary").isNotNull() & F.col("demand_score").isin("Low", "Medium", "High")
    parts = O.feature_importances(models.salary, models.features, rows).agg(
        F.count("*").alias("features"), F.round(F.sum("importance"), 6).alias("importance_sum")
    )
    counted = answers.agg(F.count_distinct("request_id").alias("requests"), F.count_if(whole).alias("answered"))
    return counted.crossJoin(parts).crossJoin(quality.select((F.col("r2") > 0.9).alias("good_fit")))


def drop_stored(spark: SparkSession) -> None:
    """Removes what queries have stored for themselves; models that were fitted are fitted anew."""
    sources.remove_tables(spark)
    for key in [k for k in _fitted if k[0].startswith(spark.sparkContext.applicationId)]:
        _loaded.pop(_fitted.pop(key)[1], None)


def entry(spark: SparkSession) -> DataFrame:
    """Popularity and mean pay of each skill."""
    return O.skill_stats(_clean(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Query]:
    return {
        "clean_postings": _on_clean(_flat),
        "clean_text_salary": _on_raw(lambda df: _flat(O.clean(B.text_salaries(df)))),
        "rejected_postings": _on_raw(lambda df: _flat(O.rejected(df))),
        "overall_stats": _on_clean(O.overall_stats),
        "salary_by_title_exp": _on_clean(O.salary_by_title_exp),
        "skills_analysis": _on_clean(O.skill_stats),
        "industry_metrics": _on_clean(O.industry_metrics),
        "salary_distribution": _on_clean(O.salary_distribution),
        "salary_distribution_filled": _on_clean(
            lambda df: O.salary_distribution(df, B.WIDE_CUTS, B.WIDE_LABELS, fill=True)
        ),
        "salary_bands": _on_clean(lambda df: O.with_band(df).select("job_id", "salary_band")),
        "top_skills": _on_clean(O.top_skills),
        "market_results": _market_results,
        "insights_skills": _insights_skills,
        "republished_industries": _republished,
        "market_by_batches": _market_by_batches,
        "median_by_title_exp": _median_of_titles,
        "median_by_skill": _median_of_skills,
        "odd_medians": _odd(
            lambda df: O.group_medians(sources.materialize(df.select("experience_level", "salary"), "odd"), ["experience_level"]).withColumn(
                "median", F.round("median", 5)
            )
        ),
        "json_round_trip": _json_round_trip,
        "training_extract": _on_clean(lambda df: _flat(sources.training_extract(df))),
        "search_all": _on_raw(lambda df: _flat(O.search_postings(df, title="", industry=None))),
        "search_title": _on_raw(lambda df: _flat(O.search_postings(df, title="UILD"))),
        "search_title_literal": _on_raw(lambda df: _flat(O.search_postings(df, title="%"))),
        "search_title_industry_type": _on_raw(
            lambda df: _flat(O.search_postings(df, title="mach", industry="Europe", job_type="REMOTE"))
        ),
        "demand_rule": _on_clean(lambda df: O.with_demand(df, B.DEMAND).select("job_id", "demand_score")),
        "skill_premium": _on_clean(
            lambda df: O.with_skill_premium(df, B.PAY.tiers).select("job_id", "skill_premium")
        ),
        "expected_salary": _on_clean(
            lambda df: O.with_expected_salary(df, B.PAY).select("job_id", "expected_salary")
        ),
        "parse_skill_list": _on_clean(
            lambda df: B.users(df).select(
                "user_id", F.array_join(parse_skill_list(F.col("skills")), "|").alias("skills")
            )
        ),
        "skill_roadmap": _skill_roadmap,
        "role_roadmap": _role_roadmap,
        "what_if_rule": _what_if_rule("alphabetical"),
        "what_if_rule_by_profile": _what_if_rule_by_profile,
        "what_if_rule_by_importance": _what_if_rule("importance"),
        "regression_report": _on_clean(
            lambda df: O.regression_report(B.scored_rows(df), "salary", "expected_salary")
        ),
        "accuracy": _on_clean(lambda df: O.accuracy(B.scored_rows(df), "demand_score", "other_demand")),
        "classification_report": _on_clean(
            lambda df: O.classification_report(B.scored_rows(df), "demand_score", "other_demand")
        ),
        "category_values": _on_clean(O.category_values),
        "category_lists": _on_clean(
            lambda df: O.category_lists(O.category_values(df)).withColumn("values", F.array_join("values", ","))
        ),
        "features_long": _features_long,
        "train_test_split": _on_clean(lambda df: O.with_split(df).select("job_id", "split")),
        "demand_codes": _on_clean(
            lambda df: decode_demand(encode_demand(df), "demand_code", "decoded").select(
                "job_id", "demand_code", "decoded"
            )
        ),
        "salary_forest_predictions": _salary_predictions(_forests),
        "demand_forest_predictions": _demand_predictions,
        "predictions": _predictions,
        "feature_importances": _importances(_forests),
        "top_features": lambda spark, sf_dir: O.top_features(_importances(_forests)(spark, sf_dir)),
        "what_if_forest": _what_if_walked(_forests, "forests"),
        "what_if_forest_by_importance": _what_if_walked(_forests, "forests", "importance"),
        "forest_nodes_agree": _nodes_agree,
        "recorded_metadata": _recorded(_forests, "forests", "metadata_options"),
        "forest_facts": _forest_facts,
        "tree_predictions": _salary_predictions(_tree),
        "tree_importances": _rounded_importances(_importances(_tree)),
        "tree_top_features": lambda spark, sf_dir: O.top_features(
            _rounded_importances(_importances(_tree))(spark, sf_dir), k=2
        ),
        "tree_what_if": _what_if_scored(_tree),
        "tree_what_if_walk": _what_if_walked(_tree, "tree"),
        "tree_node_predictions": lambda spark, sf_dir: _node_predictions(_tree, "tree", 2)(spark, sf_dir).drop("demand_score"),
        "tree_leaf_paths": _leaf_paths,
        "bagged_predictions": _salary_predictions(_bagged),
        "bagged_node_predictions": lambda spark, sf_dir: _node_predictions(_bagged, "bagged", 2)(spark, sf_dir).drop(
            "demand_score"
        ),
        "skill_roadmap_repeats": _roadmap_of_some,
        "answers_rule": _answers_rule,
        "nested_role_roadmap": _nested_role_roadmap,
        "array_round_trip": _array_round_trip,
        "any_array_round_trip": _any_array_round_trip,
        "parquet_round_trip": _parquet_round_trip,
        "expected_salary_table": _expected_from_table,
        "odd_clean": _odd(_flat),
        "odd_overall_stats": _odd(O.overall_stats),
        "odd_salary_by_title_exp": _odd(O.salary_by_title_exp),
        "odd_skills_analysis": _odd(O.skill_stats),
        "odd_industry_metrics": _odd(O.industry_metrics),
        "odd_salary_distribution": _odd(O.salary_distribution),
        "odd_pay": _odd(_with_pay),
        "odd_search_percent": lambda spark, sf_dir: _flat(
            O.search_postings(B.odd_postings(B.raw_postings(spark, sf_dir)), title="0% b")
        ),
        "odd_accuracy": _unknown_predictions(O.accuracy),
        "odd_classification_report": _unknown_predictions(O.classification_report),
        **TEXT_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    return {**ORACLES, **TEXT_ORACLES}
