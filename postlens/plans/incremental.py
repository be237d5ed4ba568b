"""Market results kept up to date batch by batch, without reading old postings again."""

from __future__ import annotations

from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metrics import TALLY_KEYS, market_tally, results_from_tally
from ..schema import COLUMNS, Columns
from ..sources.versions import batch_folders, current_version, new_version


def _folder(out_dir: str, batch: str) -> str:
    if not batch:
        raise ValueError("a batch needs a name")
    return f"{out_dir}/batch-{quote(batch, safe='')}"


def add_batch(postings: DataFrame, out_dir: str, batch: str, c: Columns = COLUMNS) -> None:
    """Tallies cleaned ``postings`` and stores the tally under the name ``batch`` below ``out_dir``.

    A batch that is sent again, after a failure or with corrections, replaces what it gave before, so it
    counts once. It is there from the moment its tally is whole. A tally has a row for each distinct
    key, however many postings there are. Batches must not share postings.
    """
    with new_version(postings.sparkSession, _folder(out_dir, batch)) as path:
        market_tally(postings, c=c).write.parquet(path)


def merged_tally(spark: SparkSession, out_dir: str) -> DataFrame:
    """The tally of all batches; fails if there is none.

    Each is as large as its keys are many, and sums are exact decimals, so the merged tally equals that of
    all postings at once, in any split.
    """
    folders = [current_version(spark, f"{out_dir}/{name}") for name in batch_folders(spark, out_dir)]
    if not folders:
        raise ValueError(f"no batch below {out_dir}")
    parts = spark.read.parquet(*folders)
    sums = [x for x in parts.columns if x not in TALLY_KEYS]
    merged = parts.groupBy(*TALLY_KEYS).agg(*[F.sum(x).cast(parts.schema[x].dataType).alias(x) for x in sums])
    return merged.select(parts.columns)


def batches(spark: SparkSession, out_dir: str) -> list[str]:
    """Names of the batches that count."""
    return sorted(unquote(name.removeprefix("batch-")) for name in batch_folders(spark, out_dir))


def market_so_far(spark: SparkSession, out_dir: str, c: Columns = COLUMNS) -> dict[str, DataFrame]:
    """The five results over all batches, by name."""
    return results_from_tally(merged_tally(spark, out_dir), c=c)
