"""From raw postings to the recorded results and the training extract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..fixed_values import EXTRACT_COLUMNS
from ..operators.clean import clean
from ..operators.metrics import market_tally, results_from_tally
from ..schema import COLUMNS, Columns
from ..sources.postings import training_extract
from ..sources.results import write_result
from ..sources.shared import materialize, temporary_tables
from ..sources.versions import new_version


@dataclass(frozen=True)
class MarketRun:
    """``results_dir`` leads to the newest run, ``version_dir`` and ``extract_path`` to this one."""

    results_dir: str
    extract_path: str
    version_dir: str


def record_market(
    raw: DataFrame, out_dir: str, fmt: str = "json", extract_fmt: str = "parquet", c: Columns = COLUMNS
) -> MarketRun:
    """Cleans ``raw`` and writes the five results and the training extract as a new version of ``out_dir``.

    Readers (``insights``) see the whole run when its last result is there, and the run before until then.
    The input is read once, by the tasks that write the extract; the results come from the extract.
    Nothing is cached, so there is nothing to lose or spill.
    """
    spark = raw.sparkSession
    ours = {v: k for k, v in vars(COLUMNS).items()}
    columns = [getattr(c, ours[x]) if x in ours else x for x in EXTRACT_COLUMNS]
    # The id goes along, because the split into training and test rows needs one.
    extract = training_extract(clean(raw, c=c), c.job_id, [x for x in columns if x in raw.columns])
    with new_version(spark, out_dir) as version:
        extract_path = f"{version}/ml_training_data"
        write_result(extract, extract_path, extract_fmt)
        postings = spark.read.format(extract_fmt).schema(extract.schema).load(extract_path)
        with temporary_tables(spark):
            tally = materialize(market_tally(postings, c=c), "market_tally")
            for name, result in results_from_tally(tally, c=c).items():
                write_result(result, f"{version}/{name}", fmt)
    return MarketRun(out_dir, extract_path, version)
