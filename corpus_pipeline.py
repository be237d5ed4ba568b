"""From raw documents to token files: toxic texts go, one of each group of near-copies stays, benchmark
leaks go, sources are mixed to their target weights, and what is left is written as token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's result as
Parquet and reads it back as the next one's documents. What a stage stores on its way, but for what its
result is read from, is gone when it returns. All but the last return the columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm import decontaminate, mixing, ngram_join, token_files, toxicity
from postlens.llm.common import TASK_TEXTS
from postlens.llm.queries import END_ID, held_out, read, tokenizer_path
from postlens.sources import few_tasks, materialize, temporary_tables


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from this stage's labelled documents.

    Every row is judged by its own text, also one without an id or that repeats another; null and empty
    texts are judged as texts without words. Without labels of both classes nothing is told apart.
    """
    labels = read(spark, sf_dir, "labels").filter(~held_out())
    return toxicity.drop_toxic(docs, toxicity.train_toxicity(docs, labels))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five words, similarity 0.8 or more.

    It is the one with the smallest id; one without an id stays only where no other has one. Rows count
    each for itself, so of equal rows, or of two texts with one id that are alike, one stays. Null, empty
    and blank texts are in no group and all stay. An empty table stays empty.
    """
    key = "_row"
    while key in docs.columns:
        key += "_"
    # Stored, so that a row keeps its number.
    rows = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "numbered")
    n = rows.count()
    with temporary_tables(spark):
        groups = ngram_join.ngram_groups(rows, k=5, percent=80, id_col=key).select(F.col(key).alias("_of"), "component_id")
        ids = rows.select(key, F.struct(F.col("doc_id").isNull(), "doc_id", key).alias("_order"))
        placed = ids.join(groups, F.col(key) == F.col("_of")).select(key, "_order", "component_id")
        placed = materialize(placed, "placed_rows", rows=n)
        first = placed.groupBy("component_id").agg(F.min("_order").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
        # Those that go are far fewer than those that stay.
        later = placed.join(first, "component_id").filter(F.col("_order") != F.col("_first")).select(key)
        later = materialize(later, "near_copies", lasting=True, rows=n)
    return rows.join(later, key, "left_anti").select([F.col(f"`{c}`") for c in docs.columns])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go. A key from id and text stands for ids that are null.

    Rows that repeat a leak go with it; null and empty texts hold no passage and stay, and so does
    everything if the benchmark is empty.
    """
    key = F.xxhash64("doc_id", "text")
    with temporary_tables(spark):
        hits = decontaminate.contaminated(docs.select(key.alias("doc_id"), "text"), read(spark, sf_dir, "benchmark"))
        leaks = materialize(hits.select(F.col("doc_id").alias("_leak_key")).distinct(), "leaks", lasting=True, rows=docs.count())
    return docs.join(leaks, key == leaks["_leak_key"], "left_anti").select([docs[c] for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once, or more often.

    Documents without words are taken as often as the whole part of their source's share says, and cost no
    words; a null source is a source of its own; rows that
    agree in id, source and size are taken alike. An empty table stays empty.
    """
    with temporary_tables(spark):
        mixed = mixing.mix_sources(docs)
        taken = mixed.filter(F.col("copies") > 0).select(
            F.col("doc_id").alias("_mix_id"),
            F.col("source").alias("_mix_source"),
            F.col("size").alias("_mix_size"),
            F.col("copies").cast("int").alias("_mix_copies"),
        )
        n = docs.count()
        taken = materialize(taken.distinct(), "mix_copies", lasting=True, rows=n)
    same = (
        docs["doc_id"].eqNullSafe(taken["_mix_id"])
        & docs["source"].eqNullSafe(taken["_mix_source"])
        & (mixing.word_count(docs["text"]) == taken["_mix_size"])
    )
    row = F.struct(*[docs[c] for c in docs.columns])
    mixed = docs.join(taken, same).select(F.explode(F.array_repeat(row, taken["_mix_copies"])).alias("_doc")).select("_doc.*")
    return few_tasks(mixed, n, TASK_TEXTS)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files; one row for each document and copy, read back from them. Null and empty texts have
    just the end id; ids may be null or repeat."""
    return token_files.token_files(docs, tokenizer_path("word_bpe_49k.json"), END_ID)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", keep_one_of_each_group),
    ("decontamination", drop_leaks),
    ("source_mix", mix),
    ("token_files", write_tokens),
]

# The classifier, the latent search and the drawn copies are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
