"""Repeated lines, kept only in the first document that holds them."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import materialize

_SPACE = " \t\n\x0b\f\r"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased.

    ``lower`` is faster than ``translate`` and equal to it where all characters are of one byte.
    """
    bare = F.btrim(line, F.lit(_SPACE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, ascii_uppercase, ascii_lowercase))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2
) -> DataFrame:
    """(id, n_lines, n_dropped, kept_text) for each row of ``docs``, made of built-in functions only.

    Lines whose key has at least ``min_chars`` code points and occurs in at least ``min_docs``
    documents are dropped everywhere but in the smallest id that holds them; the others stay, joined
    by a line feed. Repeats inside that smallest document stay as well.

    Null or empty text is one empty line. Rows that repeat an id are one document to the count, and
    each keeps its own text. A row without an id is no document to the count and never the keeper,
    but loses the lines that are dropped elsewhere. Other columns are ignored.

    Only 16-byte keys travel to be counted, combined in the map tasks, so a line that a third of all
    documents share is one row of each task. Keys are stored and
    joined with those that repeat; adaptive execution splits that join where a line is frequent.
    Texts move once.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    marked = rows.select("_id", F.xxhash64("_text").alias("_print"), F.split("_text", "\n").alias("_lines"))
    keys = (
        marked.select("_id", "_print", F.posexplode("_lines").alias("_pos", "_line"))
        .select("_id", "_print", "_pos", line_key(F.col("_line")).alias("_key"))
        .filter(F.char_length("_key") >= min_chars)
        .select("_id", "_print", "_pos", F.unhex(F.md5("_key")).alias("_hash"))
    )
    keys = materialize(keys, "line_keys")
    repeated = (
        keys.groupBy("_hash")
        .agg(F.count_distinct("_id").alias("_docs"), F.min("_id").alias("_first"))
        .filter(F.col("_docs") >= min_docs)
        .select("_hash", "_first")
    )
    dropped = (
        keys.join(materialize(repeated, "repeated_lines"), "_hash")
        .filter(~F.col("_id").eqNullSafe(F.col("_first")))
        .groupBy(F.col("_id").alias("_drop_id"), F.col("_print").alias("_drop_print"))
        .agg(F.collect_set("_pos").alias("_dropped"))
    )
    same = F.col("_id").eqNullSafe(F.col("_drop_id")) & (F.col("_print") == F.col("_drop_print"))
    n_lines = F.size("_lines")
    kept = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.coalesce("_dropped", F.array().cast("array<int>")))
    return (
        marked.join(dropped, same, "left")
        .select("_id", "_lines", n_lines.cast("bigint").alias("n_lines"), kept.alias("_kept"))
        .select(
            F.col("_id").alias(id_col),
            "n_lines",
            (F.col("n_lines") - F.size("_kept")).alias("n_dropped"),
            F.array_join(F.transform("_kept", lambda i: F.col("_lines")[i]), "\n").alias("kept_text"),
        )
    )
