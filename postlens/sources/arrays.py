"""JSON arrays of any layout, each file read by many tasks.

Files are read as text that ends at "}", which Spark can begin anywhere in a file. Whether such a piece
lies inside a string, and how deep, depends on all text before it. So every range of a file is scanned for
both answers to the first question, which gives what the range does to either state; a short fold over
the ranges of each file then tells the true state at the start of each; and a second scan cuts the
records. Only where a record crosses ranges, a third one collects the fragments, of which a range has two
at most. The pieces of a batch are scanned together, as arrays of the places of quotes and braces.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OPEN, _END, _QUOTE = 1, 2, 3
_KINDS = np.zeros(256, np.int8)
_KINDS[[ord("{"), ord("}"), ord('"')]] = _OPEN, _END, _QUOTE
# Ranges of all files together, whose states are sent to the tasks: 64 TB at 64 MB each.
MAX_RANGES = 1_000_000
_RANGE = "file string, start long, end0 int, depth0 long, least0 long, end1 int, depth1 long, least1 long"
_BEGIN = "file string, start long, inside int, depth long, origin long, left long"


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """(file, start, text) of the ranges in each batch; a text is whole pieces, each with its "}"."""
    for batch in batches:
        pieces, files, starts = batch.columns
        if not len(pieces):
            continue
        codes, places = files.dictionary_encode().indices.to_numpy(), starts.to_numpy()
        borders = np.flatnonzero((np.diff(codes) != 0) | (np.diff(places) != 0)) + 1
        for a, b in pairwise([0, *borders.tolist(), len(pieces)]):
            one = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), pieces.slice(a, b - a))
            yield files[a].as_py(), starts[a].as_py(), pc.binary_join(one, "}")[0].as_buffer().to_pybytes() + b"}"


def _marks(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and kinds of the braces, and of the quotes that no backslash escapes."""
    data = np.frombuffer(text, np.uint8)
    kinds = _KINDS[data]
    at = np.flatnonzero(kinds)
    kinds = kinds[at]
    if b"\\" in text:
        slashes = np.flatnonzero(data == ord("\\"))
        fresh = np.diff(slashes, prepend=-2) != 1
        # In a row of backslashes every other one is escaped itself.
        active = (slashes - slashes[fresh][np.cumsum(fresh) - 1]) % 2 == 0
        escaped = np.zeros(len(data) + 1, bool)
        escaped[slashes[active] + 1] = True
        kept = (kinds != _QUOTE) | ~escaped[at]
        at, kinds = at[kept], kinds[kept]
    return at, kinds


def _walk(at: np.ndarray, kinds: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """After each piece, whether a string is open and the change of depth since the start; and the places
    of "{" outside strings."""
    within = (np.cumsum(kinds == _QUOTE) + inside) & 1
    opens, ends = kinds == _OPEN, kinds == _END
    outside = within == 0
    depth = np.cumsum((opens & outside).astype(np.int64) - (ends & outside))
    return within[ends], depth[ends], at[opens & outside]


def _effect(piece: str) -> tuple[tuple[int, int], tuple[int, int]]:
    """(whether the text after ``piece`` and its "}" is inside a string, change of depth) for a piece that
    starts outside a string, and for one that starts inside."""
    walks = [_walk(*_marks(piece.encode() + b"}"), inside) for inside in (0, 1)]
    return tuple((int(within[-1]), int(change[-1])) for within, change, _ in walks)


def _scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each range does: for a start outside and inside a string, the state at its end, the change
    of depth and the least depth on the way, after a piece."""
    rows: list[list] = []
    here = None
    for file, start, text in _texts(batches):
        if (file, start) != here:
            here = (file, start)
            rows.append([file, start, 0, 0, 1 << 40, 1, 0, 1 << 40])
        last, marks = rows[-1], _marks(text)
        for at in (2, 5):
            within, change, _ = _walk(*marks, last[at])
            last[at + 2] = min(last[at + 2], last[at + 1] + int(change.min()))
            last[at], last[at + 1] = int(within[-1]), last[at + 1] + int(change[-1])
    names = [x.split()[0] for x in _RANGE.split(", ")]
    types = [pa.string(), pa.int64(), *[pa.int32(), pa.int64(), pa.int64()] * 2]
    columns = list(zip(*rows)) or [()] * len(names)
    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names=names)


def _folded(table: pa.Table) -> pa.Table:
    """State at the start of each range of one file, the range where the record open there began, and the
    depth at its end."""
    rows = sorted(table.to_pylist(), key=lambda r: r["start"])
    inside, depth, origin = 0, 0, -1
    out = []
    for r in rows:
        begin = (r["file"], r["start"], inside, depth, origin)
        end, change, least = (r[f"{name}{inside}"] for name in ("end", "depth", "least"))
        # After a border, or where no record was open, the open one has begun here.
        if depth <= 0 or depth + least <= 0:
            origin = r["start"]
        inside, depth = end, max(0, depth + change)
        out.append((*begin, depth))
    names = [x.split()[0] for x in _BEGIN.split(", ")]
    types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    columns = list(zip(*out)) or [()] * len(names)
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types)})


def _cut(states, fragments: bool):
    """Whole records of a range, or only the fragments of those that cross its ends."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = states.value
        here, held, inside, depth, origin = None, [], 0, 0, -1
        for file, start, text in _texts(batches):
            if (file, start) != here:
                if fragments and here is not None and depth > 0:
                    yield _fragment(*here, origin, held)
                here, held = (file, start), []
                inside, depth, origin = begin[here]
            at, kinds = _marks(text)
            within, change, opens = _walk(at, kinds, inside)
            ends = at[kinds == _END]
            # As if a depth below 0 were set to 0 after each piece.
            after = depth + change
            after -= np.minimum(0, np.minimum.accumulate(after))
            before = np.concatenate(([depth], after[:-1]))
            first = np.append(opens, len(text))[np.searchsorted(opens, np.concatenate(([0], ends[:-1] + 1)))]
            # What stands between records and at the ends of the array is in pieces without "{".
            opened = first < ends
            begins = first[(before == 0) & opened]
            closes = ends[(after == 0) & ((before > 0) | opened)] + 1
            if depth > 0:
                held.append(text[: closes[0] if len(closes) else len(text)])
                if len(closes):
                    if fragments and origin != start:
                        yield _fragment(file, start, origin, held)
                    elif not fragments and origin == start:
                        yield _records(pa.array([b"".join(held)], pa.binary()).view(pa.string()))
                    closes = closes[1:]
            if not fragments and len(closes):
                # Records and what is between them in turn, of which every other one stays.
                places = np.stack([begins[: len(closes)], closes], axis=1).astype(np.int32).ravel()
                parts = pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(places), pa.py_buffer(text))
                yield _records(parts.take(pa.array(np.arange(0, len(parts), 2))))
            if len(begins) > len(closes):
                held, origin = [text[begins[-1] :]], start
            inside, depth = int(within[-1]), int(after[-1])
        if fragments and here is not None and depth > 0:
            yield _fragment(*here, origin, held)

    return run


def _records(texts: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([texts], names=["record"])


def _fragment(file: str, start: int, origin: int, held: list[bytes]) -> pa.RecordBatch:
    text = pa.array([b"".join(held)], pa.binary()).view(pa.string())
    columns = [pa.array([file], pa.string()), pa.array([origin], pa.int64()), pa.array([start], pa.int64()), text]
    return pa.RecordBatch.from_arrays(columns, names=["file", "origin", "start", "record"])


def array_records(spark: SparkSession, path: str, max_ranges: int = MAX_RANGES) -> DataFrame:
    """(record): the text of every object in the JSON arrays below ``path``, indented, compact or in one
    line, nested or not.

    Ranges are as large as ``spark.sql.files.maxPartitionBytes`` says. What stands between objects is
    skipped, so numbers and texts in an array are no records. A file that breaks off gives its last
    object as far as it goes. Compressed files are read by one task each; empty ones give nothing.
    """
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    pieces = spark.read.text(path, lineSep="}").select("value", *place)
    ranges = pieces.mapInArrow(_scanned, _RANGE).groupBy("file").applyInArrow(_folded, _BEGIN)
    found = ranges.limit(max_ranges + 1).toArrow().to_pylist()
    if len(found) > max_ranges:
        raise ValueError(f"more than {max_ranges} ranges below {path}: raise spark.sql.files.maxPartitionBytes")
    states = spark.sparkContext.broadcast({(r["file"], r["start"]): (r["inside"], r["depth"], r["origin"]) for r in found})
    whole = pieces.mapInArrow(_cut(states, False), "record string")
    if not any(r["depth"] > 0 or r["left"] > 0 for r in found):
        return whole
    # Two for each range at most, so little is moved.
    schema = "file string, origin long, start long, record string"
    parts = pieces.mapInArrow(_cut(states, True), schema).groupBy("file", "origin")
    ordered = F.array_sort(F.collect_list(F.struct("start", "record")))
    joined = parts.agg(F.array_join(F.transform(ordered, lambda x: x["record"]), "").alias("record")).select("record")
    return whole.unionByName(joined)
