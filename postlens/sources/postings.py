"""Reading postings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import EXTRACT_COLUMNS
from ..schema import CORRUPT, RAW_SCHEMA
from .arrays import array_records


def read_postings(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    multi_line: bool = True,
    indent: int | str | None = 2,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Postings from JSON or Parquet. A missing path fails at once.

    JSON comes as one array (``multi_line``) or as one object per line. An array is taken to be
    pretty-printed with ``indent`` spaces: records are told apart by the line that closes them, and a
    large file is read by many tasks; another indent fails. ``indent="any"`` reads arrays of any layout in
    many tasks, from two or three scans of the text (``array_records``). ``indent=None`` reads any array once,
    but in a single task, whatever its size.

    The schema is declared, so there is no inference pass; ``salary`` stays text until ``clean``.
    Records that do not parse have nulls, and their text in ``_corrupt_record`` if ``keep_corrupt``.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt != "json":
        raise ValueError(f"fmt must be json or parquet, got {fmt!r}")
    corrupt = [T.StructField(CORRUPT, T.StringType())] if keep_corrupt else []
    schema = T.StructType([*RAW_SCHEMA.fields, *corrupt])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if multi_line and indent == "any":
        # Through inline(), since filters on a plain projection would be moved below it and parse again.
        parsed = F.from_json("record", schema, options)
        return array_records(spark, path).select(F.inline(F.array(parsed)))
    if multi_line and indent is not None:
        return _read_indented(spark, path, schema, indent, options)
    return spark.read.schema(schema).options(**options).option("multiLine", multi_line).json(path)


def _read_indented(
    spark: SparkSession, path: str, schema: T.StructType, indent: int, options: dict[str, str]
) -> DataFrame:
    # A line break inside a JSON string is always escaped and nested objects are indented deeper, so
    # this text occurs at the end of a record and nowhere else.
    end = "\n" + " " * indent + "}"
    lines = spark.read.text(path, lineSep=end)
    # What is left around a record: the opening bracket of the array, a comma, its closing bracket.
    body = F.regexp_replace("value", r"^\s*[\[,]?\s*", "")
    records = lines.select(body.alias("body"))
    rest = F.col("body").rlike(r"^\]?\s*$")
    # With another indent several records would pass for one and all but the first would be lost.
    fits = F.col("body").rlike(r"^\{\s*?\n {%d}\"" % (2 * indent))
    wrong = F.raise_error(F.lit(f"{path} is no JSON array indented by {indent}")).cast("string")
    # The rest gets by without an error here too, as Spark may parse before it filters.
    checked = F.when(fits, F.concat("body", F.lit(end))).when(~rest, wrong)
    # Through inline(), since filters on a plain projection would be moved below it and parse again.
    return records.filter(~rest).select(F.inline(F.array(F.from_json(checked, schema, options))))


def corrupt_records(postings: DataFrame) -> DataFrame:
    """Text of the records that did not parse, from a table read with ``keep_corrupt``."""
    # The second test is always true, but it names every column: Spark parses only the columns a
    # query names, and would neither see the faults of the others nor scan for this column alone.
    data = [x for x in postings.columns if x != CORRUPT]
    every_column_read = F.hash(*data) >= F.lit(-(2**31))
    bad = postings.filter(F.col(CORRUPT).isNotNull() & every_column_read)
    return bad.select(F.col(CORRUPT).alias("record"))


def training_extract(
    df: DataFrame, id_col: str | None = None, columns: Sequence[str] = EXTRACT_COLUMNS
) -> DataFrame:
    """The columns that training reads, after ``id_col`` if that is wanted."""
    return df.select(*([id_col] if id_col else []), *columns)
