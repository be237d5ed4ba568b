"""Sets of results that appear all at once.

A set is written to a folder of its own that no reader knows yet. When it is whole, one small file is
renamed into the list of versions, and that is the moment at which readers see the set, all of it.
They take the newest version and read every result from it, so they never mix two sets, and an
interrupted write leaves no trace but an unlisted folder.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_LIST, _SETS = "_versions", "_sets"


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the listed versions, oldest first."""
    target, files = _files(spark, f"{folder}/{_LIST}")
    if not files.exists(target):
        return []
    names = [status.getPath().getName() for status in files.listStatus(target)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith((".", "_")))


def _entry(folder: str, number: int) -> str:
    return f"{folder}/{_LIST}/{number:012d}.json"


def _listed(spark: SparkSession, folder: str, number: int) -> str:
    text = "\n".join(r[0] for r in spark.read.text(_entry(folder, number)).collect())
    return f"{folder}/{_SETS}/{json.loads(text)['set']}"


def _announce(spark: SparkSession, folder: str, name: str) -> int:
    """Adds a version to the list under the first free number; a rival who takes it first is no harm."""
    jvm = spark._jvm
    target, files = _files(spark, f"{folder}/{_LIST}/_{name}")
    out = files.create(target)
    out.write(bytearray(json.dumps({"set": name}).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    # Without options, a rename fails where the new name exists.
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    number = (_numbers(spark, folder) or [0])[-1] + 1
    while True:
        place = jvm.org.apache.hadoop.fs.Path(_entry(folder, number))
        try:
            context.rename(target, place, options)
            return number
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            number += 1


@contextmanager
def new_version(spark: SparkSession, folder: str) -> Iterator[str]:
    """A folder to write a set of results to; at the end it becomes the newest version of ``folder``.

    If the body fails nothing becomes visible. Versions may be written side by side; the one that ends
    last is the newest.
    """
    name = uuid4().hex
    path = f"{folder}/{_SETS}/{name}"
    yield path
    _announce(spark, folder, name)


def current_version(spark: SparkSession, folder: str) -> str:
    """Folder of the newest whole set; ``folder`` itself if it holds results without versions."""
    numbers = _numbers(spark, folder)
    return _listed(spark, folder, numbers[-1]) if numbers else folder


def batch_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly below ``folder`` that hold a whole version."""
    target, files = _files(spark, folder)
    if not files.exists(target):
        return []
    names = sorted(x.getPath().getName() for x in files.listStatus(target) if x.isDirectory())
    return [name for name in names if not name.startswith("_") and _numbers(spark, f"{folder}/{name}")]


def remove_old_versions(spark: SparkSession, folder: str, keep: int = 2) -> int:
    """Removes all versions but the last ``keep``, first from the list and then their files. Returns how
    many. Keep as many as readers may still be at."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    gone = _numbers(spark, folder)[:-keep]
    for number in gone:
        path = _listed(spark, folder, number)
        for old in (_entry(folder, number), path):
            target, files = _files(spark, old)
            files.delete(target, True)
    return len(gone)


def publish(spark: SparkSession, folder: str, write: Callable[[str], None]) -> str:
    """``new_version`` for a function that writes below the path it gets; returns that path."""
    with new_version(spark, folder) as path:
        write(path)
    return path
