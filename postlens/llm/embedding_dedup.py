"""Near-copies among embeddings by an exact metric range join.

On unit vectors a cosine of at least c is a distance of at most r = sqrt(2 - 2c). Pivots cut the space
into cells by the nearest pivot. A vector is also copied to every other cell where a partner may lie:
within r of the border between the two pivots, and, by the triangle inequality, no farther from that
cell's pivot than the cell's radius plus r. Then every cell joins its own vectors with all copies in
it, independently of the others, and every link of a vector is seen in the vector's own cell.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import materialize
from .components import connected_components

_SLACK = 1e-9
_COARSE = 2e-5


def _unit(data: list[bytes]) -> np.ndarray:
    rows = np.frombuffer(b"".join(data), dtype="<f8").reshape(len(data), -1)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, digest of the values, dimension, values), nulls where a vector links with nothing."""
    for batch in batches:
        for start in range(0, batch.num_rows, 2048):
            part = batch.slice(start, 2048)
            ids, data, sizes, high, low = part.column(0), [], [], [], []
            for values in part.column(1).to_pylist():
                row = None
                if values and not any(x is None for x in values):
                    row = np.array(values, dtype=np.float64) + 0.0
                    # Scaled first, so that no square overflows or vanishes.
                    top = np.abs(row).max()
                    row = row / top if np.isfinite(top) and top > 0 else None
                if row is None:
                    data.append(None), sizes.append(None), high.append(None), low.append(None)
                    continue
                raw = row.astype("<f8").tobytes()
                h, l = np.frombuffer(xxhash.xxh3_128_digest(raw), dtype="<i8")
                data.append(raw), sizes.append(len(row)), high.append(int(h)), low.append(int(l))
            types = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            arrays = [ids.cast(pa.int64()), *(pa.array(x, t) for x, t in zip((high, low, sizes, data), types))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "hi", "lo", "dim", "data"])


def _spread_pivots(vectors: np.ndarray, k: int) -> np.ndarray:
    """``k`` of the vectors, each the farthest from those before it."""
    chosen = [0]
    nearest = vectors @ vectors[0]
    while len(chosen) < min(k, len(vectors)):
        far = int(np.argmin(nearest))
        chosen.append(far)
        nearest = np.maximum(nearest, vectors @ vectors[far])
    return vectors[chosen]


def _homes(pivots: dict[int, np.ndarray]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, data = np.array(batch.column("dim").to_pylist()), batch.column("data").to_pylist()
            home, gap = np.zeros(len(data), np.int64), np.zeros(len(data))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                near = _unit([data[i] for i in at]) @ pivots[int(dim)].T
                home[at] = near.argmax(axis=1)
                gap[at] = np.sqrt(np.clip(2 - 2 * near.max(axis=1), 0, None))
            out = [batch.column("dim"), pa.array(home), pa.array(gap)]
            yield pa.RecordBatch.from_arrays(out, names=["dim", "home", "gap"])

    return run


def _copies(pivots: dict[int, np.ndarray], radius: dict[tuple[int, int], float], r: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                dims, data = np.array(batch.column("dim").to_pylist()), batch.column("data").to_pylist()
                rows, cells, own = [], [], []
                for dim in np.unique(dims):
                    at = np.flatnonzero(dims == dim)
                    centres = pivots[int(dim)]
                    near = _unit([data[i] for i in at]) @ centres.T
                    home = near.argmax(axis=1)
                    apart = np.sqrt(np.clip(2 - 2 * (centres @ centres.T), 0, None))
                    border = near.max(axis=1)[:, None] - near <= r * apart[home] + _SLACK
                    reach = np.array([radius.get((int(dim), c), -9.0) for c in range(len(centres))])
                    inside = np.sqrt(np.clip(2 - 2 * near, 0, None)) <= reach[None, :] + r + 1e-7
                    hit, cell = np.nonzero(border & inside | (np.arange(len(centres)) == home[:, None]))
                    rows.append(at[hit]), cells.append(cell), own.append(home[hit] == cell)
                rows, cells, own = map(np.concatenate, (rows, cells, own))
                picked = batch.take(pa.array(rows))
                out = [picked.column("dim"), pa.array(cells.astype(np.int32)), picked.column("rep"), picked.column("weight")]
                out += [pa.array(own), picked.column("data")]
                yield pa.RecordBatch.from_arrays(out, names=["dim", "cell", "rep", "weight", "own", "data"])

    return run


def _join_cell(cosine: float):
    def run(table: pa.Table) -> pa.Table:
        asks = np.array(table.column("asks").to_pylist(), dtype=bool)
        rep = table.column("rep").to_numpy()
        weight = table.column("weight").to_numpy()
        vectors = _unit(table.column("data").to_pylist())
        queries, index = np.flatnonzero(asks), np.flatnonzero(~asks)
        a, b, n = [], [], []
        if len(queries) and len(index):
            coarse = vectors[index].astype(np.float32).T.copy()
            names, place = np.unique(rep, return_inverse=True)
            component = np.arange(len(names))
            for start in range(0, len(queries), 512):
                rows = queries[start : start + 512]
                near = vectors[rows].astype(np.float32) @ coarse >= cosine - _COARSE
                row, col = np.nonzero(near)
                row, col = rows[row], index[col]
                exact = np.empty(len(row))
                for at in range(0, len(row), 65536):
                    span = slice(at, at + 65536)
                    exact[span] = np.einsum("ij,ij->i", vectors[row[span]], vectors[col[span]])
                good = (exact >= cosine) & (rep[row] != rep[col])
                row, col = row[good], col[good]
                if not len(row):
                    continue
                cuts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1], [True]]))
                for first, last in zip(cuts[:-1], cuts[1:]):
                    asked, others = row[first], col[first:last]
                    a.append(int(rep[asked])), b.append(None), n.append(int(weight[others].sum()))
                    mine = place[asked]
                    for group in np.unique(component[place[others]]):
                        if group != component[mine]:
                            member = others[component[place[others]] == group][0]
                            a.append(int(rep[asked])), b.append(int(rep[member])), n.append(0)
                            component[component == group] = component[mine]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    return run


def embedding_groups(
    vectors: DataFrame,
    cosine: float = 0.95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cell_rows: int = 8192,
    max_pivots: int = 1024,
    sample: int = 8192,
    query_rows: int = 4096,
    index_rows: int = 16384,
) -> DataFrame:
    """(id, n_links, component_id, kept) for each row of ``vectors``.

    Rows link when the cosine of their vectors, in double precision, is at least ``cosine``. Vectors
    that are null, empty or zero, or hold null or non-finite components, link with nothing, and so do
    vectors of different dimension. A row without an id links with nothing, has a null component and
    is kept. Rows that repeat an id are vectors of their own to the count and share a component. Equal
    vectors are one row of the join, with their number. Other columns are ignored.

    Pivots are picked far apart from the first ``sample`` vectors by a hash, about one for
    ``cell_rows`` vectors and at most ``max_pivots``; they decide where work is done, not what is
    found. Inside a cell, parts of ``query_rows`` meet parts of ``index_rows``, so a hot cell is many
    tasks and each holds a bounded number of vectors. Links are counted there and only a spanning
    forest of them leaves the task.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be in (0, 1]")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    read = materialize(rows.mapInArrow(_vectors, "id long, hi long, lo long, dim int, data binary"), "vectors")
    usable = read.filter(F.col("data").isNotNull() & F.col("id").isNotNull())
    classes = usable.groupBy("hi", "lo", "dim").agg(
        F.min("id").alias("first_id"), F.count("*").alias("weight"), F.first("data").alias("data")
    )
    # A class of equal vectors has a key of its own, since an id may stand for several; numbered when stored.
    classes = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "vector_classes")
    counts = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}
    pivots = {}
    for dim, count in counts.items():
        picked = classes.filter(F.col("dim") == dim).orderBy("hi", "lo").limit(sample).select("data").collect()
        pivots[dim] = _spread_pivots(_unit([bytes(r[0]) for r in picked]), min(max_pivots, -(-count // cell_rows)))
    homes = classes.select("dim", "data").mapInArrow(_homes(pivots), "dim int, home long, gap double")
    radius = {(r[0], r[1]): r[2] for r in homes.groupBy("dim", "home").agg(F.max("gap")).collect()}
    r = float(np.sqrt(2 - 2 * cosine)) + 1e-9
    dealt = classes.select("dim", "rep", "weight", "data").mapInArrow(
        _copies(pivots, radius, r), "dim int, cell int, rep long, weight long, own boolean, data binary"
    )
    dealt = materialize(dealt, "vector_cells")
    parts = dealt.groupBy("dim", "cell").agg(
        F.ceil(F.count_if("own") / query_rows).cast("int").alias("asks_in"), F.ceil(F.count("*") / index_rows).cast("int").alias("kept_in")
    )
    sized = dealt.join(parts, ["dim", "cell"])
    spot = F.xxhash64("rep")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.greatest(F.col(n), F.lit(1)) - 1))
    asking = sized.filter("own").select(
        "dim", "cell", F.pmod(spot, "asks_in").cast("int").alias("q"), every("kept_in").alias("i"), "rep", "weight", F.lit(True).alias("asks"), "data"
    )
    looked_up = sized.select(
        "dim", "cell", every("asks_in").alias("q"), F.pmod(spot, "kept_in").cast("int").alias("i"), "rep", "weight", F.lit(False).alias("asks"), "data"
    )
    found = asking.unionByName(looked_up).groupBy("dim", "cell", "q", "i").applyInArrow(_join_cell(cosine), "a long, b long, n long")
    found = materialize(found, "vector_links")
    per_class = found.filter(F.col("b").isNull()).groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    owned = usable.join(classes.select("hi", "lo", "dim", "rep", "weight"), ["hi", "lo", "dim"])
    several = owned.groupBy("id").agg(F.collect_set("rep").alias("reps")).filter(F.size("reps") > 1)
    several = several.select(F.array_min("reps").alias("a"), F.explode("reps").alias("b"))
    labels = connected_components(found.filter(F.col("b").isNotNull()).select("a", "b").unionByName(several))
    per_class = classes.select("hi", "lo", "dim", "rep", "first_id", "weight").join(per_class, "rep", "left").join(
        labels, F.col("rep") == F.col("node"), "left"
    )
    per_class = materialize(
        per_class.select(
            "hi", "lo", "dim", "first_id",
            (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("links"),
            F.coalesce("component", "rep").alias("group"),
        ),
        "vector_results",
    )
    smallest = per_class.groupBy("group").agg(F.min("first_id").alias("root"))
    per_class = per_class.join(smallest, "group").select("hi", "lo", "dim", "links", "root")
    linked = F.col("id").isNotNull() & F.col("links").isNotNull()
    component = F.when(linked, F.col("root")).otherwise(F.col("id"))
    return read.drop("data").join(per_class, ["hi", "lo", "dim"], "left").select(
        F.col("id").alias(id_col),
        F.when(linked, F.col("links")).otherwise(F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"),
    )
