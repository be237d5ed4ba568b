"""Small tables are a few files, however many partitions a shuffle has: every file starts a process or two."""

from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline
from postlens.llm import components, mixing, ngram_join, queries, token_files
from postlens.sources import materialize, shared_dir

MANY = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@contextmanager
def many_partitions(spark):
    before = {k: spark.conf.get(k) for k in MANY}
    try:
        for k, v in MANY.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def stored(spark):
    """Files of each table that this application has stored."""
    tables = Path(shared_dir(spark).removeprefix("file://").removeprefix("file:")).glob("*-*")
    return {t.name: len(list(t.glob("part-*.parquet"))) for t in tables if t.is_dir()}


def made_by(spark, work):
    known = stored(spark)
    with many_partitions(spark):
        result = work()
        return result, {k: v for k, v in stored(spark).items() if k not in known}


def texts(n=120):
    base = [" ".join(f"w{(7 * i + j * j) % 900}" for j in range(40)) for i in range(n // 3)]
    return [(i, base[i // 3] + (" end" if i % 3 == 2 else ""), f"s{i % 4}") for i in range(n)]


def test_groups_of_few_documents_are_few_files(spark):
    docs = spark.createDataFrame(texts(), "doc_id long, text string, source string")
    rows, files = made_by(spark, lambda: ngram_join.ngram_groups(docs, k=4, percent=85).collect())
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: i // 3 * 3 for i in range(120)}
    assert len(files) > 12 and max(files.values()) == 1


def test_links_of_a_few_nodes_are_few_files(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(200, 300)], "a long, b long")
    labels, files = made_by(spark, lambda: components.connected_components(edges, 21).collect())
    assert dict(map(tuple, labels)) == {i: 0 for i in range(21)} | {200: 200, 300: 200}
    assert len(files) > 4 and max(files.values()) == 1


def test_a_bound_that_is_too_low_loses_no_link(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(12)], "a long, b long")
    assert {r["component"] for r in components.connected_components(edges, 0).collect()} == {0}


def test_mix_and_token_files_of_few_documents(spark):
    docs = spark.createDataFrame(texts(), "doc_id long, text string, source string")
    mixed, files = made_by(spark, lambda: mixing.mix_sources(docs).collect())
    assert len(mixed) == 120 and max(files.values()) == 1
    path = corpus_pipeline.tokenizer_path("word_bpe_49k.json")
    index, files = made_by(spark, lambda: token_files.token_files(docs, path, queries.END_ID).collect())
    assert sorted(r["doc_id"] for r in index) == list(range(120))
    assert len({r["shard"] for r in index}) > 20 and [v for k, v in files.items() if k.startswith("token_manifest")] == [1]


def test_stage_that_drops_copies_leaves_few_files(spark):
    docs = spark.createDataFrame(texts(), "doc_id long, text string, source string").coalesce(2)
    left, files = made_by(spark, lambda: corpus_pipeline.keep_one_of_each_group(spark, docs, "").collect())
    assert sorted(r["doc_id"] for r in left) == list(range(0, 120, 3))
    assert len(files) == 2 and max(files.values()) <= 2


def test_rows_bound_the_files_of_a_table(spark):
    with many_partitions(spark):
        counted = spark.range(2000).groupBy((F.col("id") % 1500).alias("id")).count()
        assert len(materialize(counted, "bounded", rows=2000).inputFiles()) == 1
        assert len(materialize(counted, "bounded", rows=120_000).inputFiles()) == 3
        assert len(materialize(counted, "bounded").inputFiles()) == 40
