"""Hard negatives by an inverted multi-index, exact.

Every vector is split in two halves, each half goes to the nearest centre of its half's codebook, and
the pair of centres is the vector's cell. For an anchor, the inner product with any half-vector of a
centre is at most that with the centre plus the anchor's length times the centre's radius. The two
lists of half-bounds are sorted, and a heap visits their sums from the highest down (the multi-sequence
walk). A search ends for an anchor when no cell left can reach the lowest score that its windows still
need: what it has found is then certified.

Cells are groups of rows on the cluster, cut into parts of bounded size. A round lets every open
anchor ask for its next cells, up to a growing number of rows, and a part answers each anchor with the
few best rows for each of its windows that reach what is already known.

All values are whole numbers: centres are rounded and radii rounded up, so bounds do not depend on
the machine that computes them.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import materialize
from .vectors import is_finite, matrix, padded, products, whole


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks, radii and the size of each cell. Its size is bounded by the number of centres."""

    width: int
    cut: int
    centres: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray
    part_rows: int

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.cut], x[:, self.cut :]

    def parts(self, i: int, j: int) -> int:
        return max(1, math.ceil(int(self.counts[i, j]) / self.part_rows))

    def bounds(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(upper, lower) bounds of the inner products with the rows of each centre, for each half."""
        out = []
        for half, centres, radii in zip(self.halves(x), self.centres, self.radii):
            middle = products(half, centres).astype(np.float64)
            length = np.sqrt(np.square(half.astype(np.float64)).sum(axis=1, keepdims=True))
            # One more for each rounding of lengths and radii.
            reach = np.ceil(length * radii * (1 + 1e-12) + 1)
            out.append((middle + reach, middle - reach))
        return out


def walk(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) over all pairs of the two lists, from the highest sum down."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    if not len(a) or not len(b):
        return
    heap = [(-(first[a[0]] + second[b[0]]), 0, 0)]
    while heap:
        total, i, j = heappop(heap)
        yield -total, int(a[i]), int(b[j])
        if j + 1 < len(b):
            heappush(heap, (-(first[a[i]] + second[b[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heappush(heap, (-(first[a[i + 1]] + second[b[0]]), i + 1, 0))


def _codebook(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centres of a sample by Lloyd's rounds, begun with rows spread over the sample, rounded."""
    if not rows.size:
        return np.zeros((1, rows.shape[1]), np.int64)
    rows = rows.astype(np.float64)
    distinct = np.unique(rows, axis=0)
    if len(distinct) <= k:
        return distinct.astype(np.int64)
    centres = distinct[np.linspace(0, len(distinct) - 1, k).astype(int)]
    for _ in range(rounds):
        near = (np.square(centres).sum(axis=1) - 2 * rows @ centres.T).argmin(axis=1)
        sums, sizes = np.zeros_like(centres), np.bincount(near, minlength=k)
        np.add.at(sums, near, rows)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return np.unique(np.rint(centres), axis=0).astype(np.int64)


def _placed(width: int, cut: int, centres: tuple[np.ndarray, np.ndarray]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), width).astype(np.float64)
            columns = []
            for half, book in zip((x[:, :cut], x[:, cut:]), (c.astype(np.float64) for c in centres)):
                near = np.empty(len(half), np.int32)
                gap = np.empty(len(half))
                for start in range(0, len(half), 1024):
                    part = half[start : start + 1024]
                    at = (np.square(book).sum(axis=1) - 2 * part @ book.T).argmin(axis=1)
                    near[start : start + 1024] = at
                    gap[start : start + 1024] = np.square(part - book[at]).sum(axis=1)
                columns += [pa.array(near), pa.array(np.ceil(np.sqrt(gap) * (1 + 1e-12)))]
            names = [*batch.schema.names, "i", "gap_i", "j", "gap_j"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=names)

    return run


def build_index(rows: DataFrame, width: int, cell_rows: int, part_rows: int, max_centres: int, sample: int):
    """(rows with their cell, index) for rows of padded whole vectors ``x`` with a key ``r``.

    The codebooks are fitted on ``sample`` rows, drawn by a hash of the key; every row is placed, and
    radii and sizes come from all rows. As many centres as give cells of ``cell_rows`` rows on average,
    up to ``max_centres`` for each half; beyond that, cells just have more parts.
    """
    n = rows.count()
    drawn = rows.orderBy(F.xxhash64("r"), "r").limit(sample).select("x").toArrow()
    x = matrix(drawn.column("x").combine_chunks(), width) if len(drawn) else np.zeros((0, width), np.int64)
    k, cut = min(max_centres, max(1, math.ceil(math.sqrt(n / cell_rows)))), width // 2
    centres = (_codebook(x[:, :cut], k), _codebook(x[:, cut:], k))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    schema += ", i int, gap_i double, j int, gap_j double"
    placed = materialize(rows.mapInArrow(_placed(width, cut, centres), schema), "placed_vectors")
    counts = np.zeros((len(centres[0]), len(centres[1])), np.int64)
    radii = (np.zeros(len(centres[0])), np.zeros(len(centres[1])))
    sizes = placed.groupBy("i", "j").agg(F.count("*").alias("c"), F.max("gap_i").alias("a"), F.max("gap_j").alias("b"))
    for i, j, count, a, b in sizes.collect():
        counts[i, j] = count
        radii[0][i], radii[1][j] = max(radii[0][i], a), max(radii[1][j], b)
    index = MultiIndex(width, cut, centres, radii, counts, part_rows)
    cell = F.col("i").cast("long") * len(centres[1]) + F.col("j")
    parts = F.greatest(F.lit(1), F.ceil(F.col("c") / part_rows)).cast("int")
    number = sizes.select(F.col("i").alias("_i"), F.col("j").alias("_j"), parts.alias("_parts"))
    part = F.pmod(F.xxhash64("r"), F.col("_parts")).cast("int")
    joined = placed.join(number, (F.col("i") == F.col("_i")) & (F.col("j") == F.col("_j")))
    return joined.select("r", "id", "label", "x", cell.alias("cell"), part.alias("part")), index


_ASK = "kind int, r long, id long, label string, x array<long>, cell long, part int, salt int, slots array<int>, low array<long>, high array<long>"


def _requests(index, budget: int, salts: int):
    """The next cells of each open anchor, up to ``budget`` rows in all rounds so far.

    ``done`` tells how many of its cells an anchor has visited; ``low`` holds, for each of its windows, the
    lowest score that could still enter it, ``high`` the highest that may.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: MultiIndex = index.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256)
                x = matrix(rows.column("x"), ix.width)
                (up_i, down_i), (up_j, down_j) = ix.bounds(x)
                data = {name: rows.column(name).to_pylist() for name in ("r", "done", "low", "high")}
                ask, cells, parts, last, certified = [], [], [], [], []
                for at in range(len(x)):
                    least, most = min(data["low"][at]), max(data["high"][at])
                    seen, met, sure = 0, 0, True
                    for total, i, j in walk(up_i[at], up_j[at]):
                        if total < least:
                            break
                        if met >= budget:
                            sure = False
                            break
                        seen += 1
                        met += int(ix.counts[i, j])
                        # A cell that lies above all windows, or that is empty, has nothing to give.
                        if seen <= data["done"][at] or not ix.counts[i, j] or down_i[at, i] + down_j[at, j] > most:
                            continue
                        n = ix.parts(i, j)
                        ask += [at] * n
                        cells += [i * ix.counts.shape[1] + j] * n
                        parts += range(n)
                    last.append(seen), certified.append(sure)
                # One more row for each anchor: how far it has come.
                whole_ = np.array([*ask, *range(len(x))], np.int64)
                marks = len(ask)
                column = rows.take(pa.array(whole_))
                out = {
                    "kind": np.array([1] * marks + [2 + int(c) for c in certified], np.int32),
                    "cell": np.array([*cells, *last], np.int64),
                    "part": np.array([*parts, *[0] * len(x)], np.int32),
                    "salt": np.array([hash(data["r"][at]) % salts for at in whole_], np.int32),
                }
                arrays = []
                for field in _ASK.split(", "):
                    name = field.split()[0]
                    arrays.append(pa.array(out[name]) if name in out else column.column(name))
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in _ASK.split(", ")])

    return run


def _best(anchors: dict, scores: np.ndarray, held: dict, same: bool, k: int) -> Iterator[tuple]:
    """(anchor, window, score, id, row) of the best ``k`` held rows for each window of each anchor."""
    ids, missing, keys = held["id"], held["missing"], held["r"]
    for at, row in enumerate(scores):
        fits = (held["label"] == anchors["label"][at]) == same
        fits &= keys != anchors["r"][at]
        for slot, low, high in zip(anchors["slots"][at], anchors["low"][at], anchors["high"][at]):
            hit = np.flatnonzero(fits & (row >= low) & (row <= high))
            if len(hit) > k:
                edge = np.partition(row[hit], len(hit) - k)[len(hit) - k]
                hit = hit[row[hit] >= edge]
            order = np.lexsort((keys[hit], ids[hit], missing[hit], -row[hit]))[:k]
            for pick in hit[order]:
                yield anchors["r"][at], slot, int(row[pick]), None if missing[pick] else int(ids[pick]), int(keys[pick])


_FOUND = "a long, slot int, score long, id long, r long"


def _search(width: int, same: bool, k: int):
    """Reads parts in order, in each first its rows, then the anchors that ask for it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, held, found = None, [], None, []

        def answer() -> pa.RecordBatch:
            columns = list(zip(*found)) or [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = [f.split()[0] for f in _FOUND.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            places = [batch.column(n).to_numpy() for n in ("cell", "part", "salt", "kind")]
            change = np.any([p[1:] != p[:-1] for p in places], axis=0)
            cuts = np.flatnonzero(np.concatenate([[True], change, [True]])) if batch.num_rows else []
            for a, b in zip(cuts[:-1], cuts[1:]):
                here = tuple(int(p[a]) for p in places[:3])
                if here != key:
                    key, rows, held = here, [], None
                for start in range(a, b, 512):
                    part = batch.slice(start, min(512, b - start))
                    if places[3][a] == 0:
                        rows.append(part)
                        continue
                    if held is None:
                        table = pa.Table.from_batches(rows) if rows else part.slice(0, 0)
                        ids = table.column("id").to_pylist()
                        held = {
                            "x": np.concatenate([matrix(p.column("x"), width) for p in rows] or [np.zeros((0, width), np.int64)]),
                            "id": np.array([0 if v is None else v for v in ids], np.int64),
                            "missing": np.array([v is None for v in ids], bool),
                            "label": np.array(table.column("label").to_pylist(), object),
                            "r": np.array(table.column("r").to_pylist(), np.int64),
                        }
                    names = ("r", "label", "slots", "low", "high")
                    anchors = {n: part.column(n).to_pylist() for n in names}
                    found += _best(anchors, products(matrix(part.column("x"), width), held["x"]), held, same, k)
            if len(found) > 10_000:
                yield answer()
                found = []
        if found:
            yield answer()

    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each window: by score, then id, a missing one last."""
    order = Window.partitionBy("a", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "r")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def search_windows(
    indexed: DataFrame, index: MultiIndex, anchors: DataFrame, same: bool, k: int, first_rows: int, growth: int, salt_rows: int
) -> DataFrame:
    """(a, slot, score, id, r, place): the best ``k`` rows of each window of each anchor, exactly.

    ``anchors`` has a row each: its key ``r``, ``label``, ``x`` and its windows as lists ``slots``, ``low``
    and ``high`` (scores from low to high). ``same`` asks for rows of the anchor's label, otherwise of
    others. Rounds go on until every anchor is certified; each visits ``growth`` times as many rows.
    """
    spark = indexed.sparkSession
    shared = spark.sparkContext.broadcast(index)
    n = anchors.count()
    salts = n // salt_rows + 1
    state = anchors.withColumn("done", F.lit(0).cast("long"))
    best, budget = spark.createDataFrame([], _FOUND), first_rows
    while n:
        # Stored, since it is read for its cells, its answers and how far each anchor has come.
        asked = materialize(state.mapInArrow(_requests(shared, budget, salts), _ASK), "requests")
        wanted = asked.filter("kind = 1")
        named = wanted.select("cell", "part", "salt").distinct()
        rows = indexed.join(named, ["cell", "part"]).select(
            F.lit(0).alias("kind"), "r", "id", "label", "x", "cell", "part", "salt",
            *[F.lit(None).cast(t).alias(c) for c, t in (("slots", "array<int>"), ("low", "array<long>"), ("high", "array<long>"))],
        )
        met = rows.unionByName(wanted).repartition("cell", "part", "salt").sortWithinPartitions("cell", "part", "salt", "kind")
        found = met.mapInArrow(_search(index.width, same, k), _FOUND)
        best = materialize(_top(best.unionByName(found), k).drop("place"), "windows")
        open_ = asked.filter("kind = 2").select(F.col("r").alias("_r"), F.col("cell").alias("_done"))
        n = open_.count()
        if n:
            full = best.groupBy("a", "slot").agg(F.min("score").alias("s"), F.count("*").alias("c")).filter(F.col("c") >= k)
            lows = full.groupBy("a").agg(F.map_from_entries(F.collect_list(F.struct("slot", "s"))).alias("_lows"))
            joined = state.join(open_, F.col("r") == F.col("_r")).join(lows, F.col("r") == F.col("a"), "left")
            known = F.coalesce(F.col("_lows"), F.create_map().cast("map<int,bigint>"))
            low = F.zip_with("slots", "low", lambda s, v: F.greatest(v, F.coalesce(F.try_element_at(known, s), v)))
            cut = joined.withColumn("low", low).withColumn("done", F.col("_done"))
            state = materialize(cut.select(*state.columns), "anchors")
        budget *= growth
    return _top(best, k)


def mine_hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: float = 256,
    cell_rows: int = 2048,
    part_rows: int = 4096,
    max_centres: int = 256,
    sample: int = 16_384,
    first_rows: int = 4096,
    growth: int = 16,
    salt_rows: int = 65_536,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Entries become ``floor(scale * entry)``; a score is the exact inner product with the anchor, and
    higher scores come first, equal ones by the smaller id. The ``positives`` best other rows with the
    label of an anchor are its positives. For each, the ``negatives`` best rows of other labels whose score
    lies from ``low`` to ``high`` percent of the positive's are returned, fewer if there are no more; a
    positive of negative score has no such window.

    Rows with a null label or vector, or with null or non-finite entries, take no part; shorter vectors
    count as followed by zeros. Rows that repeat an id are rows of their own, in either role, and those
    without an id come last among equals and are no anchors unless ``anchors`` says so. Equal rows are
    told apart by an inner key, so an anchor's copy is one of its positives. Other columns are not
    looked at. An empty table, or one without anchors, gives no rows. A score beyond long fails.
    """
    usable = vectors.filter(F.col(label_col).isNotNull() & is_finite(vector_col))
    named = usable.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        whole(vector_col, scale).alias("x"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    wide, width = padded(named, "x")
    # Numbered when stored, so that a row keeps its key.
    rows = materialize(wide.withColumn("r", F.monotonically_increasing_id()), "vectors")
    plain = rows.select("r", "id", "label", "x")
    placed, index = build_index(plain, width, cell_rows, part_rows, max_centres, sample)
    indexed = materialize(placed, "indexed_vectors")
    asking = rows.filter("anchor").select("r", F.lit(None).cast("long").alias("id"), "label", "x")
    least, most = -(1 << 62), 1 << 62

    def windows(slots: Column, from_: Column, to: Column) -> DataFrame:
        return asking.withColumn("slots", slots).withColumn("low", from_).withColumn("high", to)

    limits = (first_rows, growth, salt_rows)
    one = windows(F.array(F.lit(1)), F.array(F.lit(least).cast("long")), F.array(F.lit(most).cast("long")))
    best = materialize(search_windows(indexed, index, materialize(one, "anchors"), True, positives, *limits), "positives")
    # A window is the same for positives of one score, and so is its answer: each is asked for once.
    from_ = F.expr(f"({int(low)} * score + 99) div 100")
    to = F.expr(f"({int(high)} * score) div 100")
    bounds = best.filter("score >= 0").select("a", F.col("score").alias("s"), from_.alias("f"), to.alias("t")).distinct()
    numbered = bounds.withColumn("slot", F.row_number().over(Window.partitionBy("a").orderBy("s")))
    numbered = materialize(numbered, "score_windows")
    entry = F.array_sort(F.collect_list(F.struct("slot", "f", "t")))
    lists = numbered.groupBy("a").agg(entry.alias("w"))
    slots = [F.col(f"w.{n}").alias(c) for n, c in (("slot", "slots"), ("f", "low"), ("t", "high"))]
    two = asking.join(lists, F.col("r") == F.col("a")).select("r", "id", "label", "x", *slots)
    lower = search_windows(indexed, index, materialize(two, "anchors"), False, negatives, *limits)
    answers = lower.select(
        F.col("a").alias("_a"), F.col("slot").alias("_slot"), "place", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    names = rows.filter("anchor").select(F.col("r").alias("_r"), F.col("id").alias("anchor_id"))
    pairs = best.select("a", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    own = numbered.select(F.col("a").alias("_b"), "s", "slot")
    pairs = pairs.join(own, (F.col("a") == F.col("_b")) & (F.col("positive_score") == F.col("s")))
    kind = vectors.schema[id_col].dataType
    return (
        pairs.join(answers, (F.col("a") == F.col("_a")) & (F.col("slot") == F.col("_slot")))
        .join(names, F.col("a") == F.col("_r"))
        .select(
            F.col("anchor_id").cast(kind),
            F.col("positive_id").cast(kind),
            F.col("place").cast("int").alias("rank"),
            F.col("negative_id").cast(kind),
            "positive_score",
            "negative_score",
        )
    )
