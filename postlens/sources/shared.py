"""Intermediate tables in a folder that every executor can reach."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Rows that a task writes at least, where their number is known. Every file costs the executor a process or two to set
# its mode, so a small table should not have one for each shuffle partition.
FILE_ROWS = 50_000
# Of this thread or task alone: plans that run side by side do not see each other's tables.
_open_scope: ContextVar[list[str] | None] = ContextVar("open_scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder for the tables of this application, below ``spark.checkpoint.dir``.

    Where that is unset, a session on one machine uses a folder beside its warehouse; a cluster must
    name one, since a folder of one machine would be out of reach, or lost, for the others.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        context.setCheckpointDir(f"{warehouse.rstrip('/')}/_tables")
        root = context.getCheckpointDir()
    root = root if "://" in root or not root.startswith("file:") else Path(root.removeprefix("file:")).as_uri()
    return f"{root.rstrip('/')}/{context.applicationId}"


def few_tasks(df: DataFrame, rows: int, task_rows: int = FILE_ROWS) -> DataFrame:
    """``df``, whose last stage has a task for each ``task_rows`` of ``rows`` at most; never more than it had."""
    return df.coalesce(max(1, -(-rows // task_rows)))


def materialize(df: DataFrame, name: str = "table", lasting: bool = False, rows: int | None = None) -> DataFrame:
    """Writes ``df`` once and reads it back.

    ``rows``, where it is known, is about how many rows ``df`` has at most: its last stage is as many tasks as
    that asks for, and each writes a file. So it should come after a shuffle, not after a scan of long rows.

    What is read later does not depend on any executor that took part in the work, and the file sizes
    tell Catalyst how large the table is, so it broadcasts the table only if that fits. Inside
    ``temporary_tables`` the files are removed at its end, unless the table is ``lasting``; otherwise they
    stay until ``remove_tables``, since a result that is not computed yet may read them.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid4().hex}"
    (df if rows is None else few_tasks(df, rows)).write.parquet(path)
    scope = _open_scope.get()
    if scope is not None and not lasting:
        scope.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_table(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Removes, at the end, the tables that were stored inside."""
    made: list[str] = []
    token = _open_scope.set(made)
    try:
        yield
    finally:
        _open_scope.reset(token)
        for path in made:
            remove_table(spark, path)


def remove_tables(spark: SparkSession) -> None:
    """Removes all tables that this application has stored, when its results have been taken."""
    remove_table(spark, shared_dir(spark))
