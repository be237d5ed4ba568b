"""Groups of near-copies by a T-occurrence search over the shingles' inverted lists.

Two documents whose shingle sets have a Jaccard similarity of at least ``percent`` share at least T
shingles, and T - 1 of a document's inverted lists, the longest, can be left out of the search: a
partner still turns up in a shorter one. So only the short lists are merged to find candidates, and
the long ones are probed for those candidates alone. The work is laid out as Spark jobs:

1. Tasks turn texts into sorted shingle hashes and send them, packed by blocks of documents, to the
   range of hashes they belong to. There the list lengths become known and go back to the blocks.
   A shingle that is frequent in a block travels as one number, so no list is gathered in one task.
2. Each document keeps the shingles that may be in a short list. One that no other document has
   finds no partner, and most documents are done here. Equal sets are one class with one member.
3. Documents that share a short list are dealt to cells of bounded size, with all documents that
   their lists name; every cell merges, counts and probes on its own.
4. The links found, at most a spanning forest for each cell, are joined into components.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import few_tasks, materialize
from .common import TASK_TEXTS, WordHashes, shingles, slices, words_of
from .components import connected_components

_DOCS, _HOT, _LIST, _SUM, _DF = range(5)
_PACKED = "kind int, route int, block long, data binary"
_DOC_LIMIT = 60_000
_EVERY = np.uint64(0xFFFF)
_IDX_BITS = np.uint64(16)


def shingle_set(text: bytes | None, k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of the whole text."""
    return np.unique(shingles(hashes.of(words_of(text)), k))


def set_digest(values: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    import xxhash

    digest = xxhash.xxh3_128_digest(values.tobytes())
    return tuple(int(x) for x in np.frombuffer(digest, dtype="<i8"))


def least_overlap(n: int, m: int, percent: int) -> int:
    """Shared shingles that sets of ``n`` and ``m`` need."""
    return -(-percent * (n + m) // (100 + percent))


def _packed(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    kinds, routes, blocks, data = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(kinds, pa.int32()), pa.array(routes, pa.int32()), pa.array(blocks, pa.int64()), pa.array(data, pa.binary())],
        names=["kind", "route", "block", "data"],
    )


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    if not len(sorted_values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    return starts, np.diff(np.append(starts, len(sorted_values)))


_DOC_ROW = np.dtype([("known", "u1"), ("id", "<i8"), ("n", "<i4"), ("hi", "<i8"), ("lo", "<i8")])
_DF_ROW = np.dtype([("key", "<u8"), ("df", "<u4")])
_HOT_ROW = np.dtype([("token", "<u8"), ("count", "<u4")])


def _pack(k: int, routes: int, block_shingles: int, hot_share: int):
    """Texts to packed blocks: document rows, shingles by route, and lists of frequent shingles."""

    def flush(block: int, docs: list[tuple], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        home = block % routes
        yield _packed([(_DOCS, home, block, np.array(docs, dtype=_DOC_ROW).tobytes())])
        sizes = [len(x) for x in sets]
        if not sum(sizes):
            return
        owner = np.repeat(np.arange(len(sets), dtype=np.uint64), sizes)
        # 48 bits of the hash and the document's place in the block; a clash only adds a candidate.
        keys = np.concatenate(sets)
        keys &= ~_EVERY
        keys |= owner
        del owner
        keys.sort()
        tokens = keys >> _IDX_BITS
        starts, lengths = _runs(tokens)
        hot = lengths > max(64, len(sets) // hot_share)
        out = []
        if hot.any():
            in_hot = np.repeat(hot, lengths)
            out.append((_HOT, home, block, keys[in_hot].tobytes()))
            sums = np.zeros(int(hot.sum()), dtype=_HOT_ROW)
            sums["token"], sums["count"] = tokens[starts[hot]], lengths[hot]
            keys, tokens = keys[~in_hot], tokens[~in_hot]
        edges = np.array([(i << 48) // routes for i in range(1, routes)], dtype=np.uint64)
        cuts = np.concatenate([[0], np.searchsorted(tokens, edges), [len(tokens)]])
        for route in range(routes):
            if cuts[route] < cuts[route + 1]:
                out.append((_LIST, route, block, keys[cuts[route] : cuts[route + 1]].tobytes()))
        if hot.any():
            cuts = np.concatenate([[0], np.searchsorted(sums["token"], edges), [len(sums)]])
            for route in range(routes):
                if cuts[route] < cuts[route + 1]:
                    out.append((_SUM, route, block, sums[cuts[route] : cuts[route + 1]].tobytes()))
        for at in range(0, len(out), 512):
            yield _packed(out[at : at + 512])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # The same for every attempt of a task, since a task reads the same rows in the same order.
        block = TaskContext.get().partitionId() << 32
        hashes, docs, sets, held = WordHashes(), [], [], 0
        for part in slices(batches):
            for doc_id, text in zip(part["_id"], part["_text"]):
                found = shingle_set(text, k, hashes)
                docs.append((doc_id is not None, doc_id or 0, len(found), *set_digest(found)))
                sets.append(found)
                held += len(found)
                if held >= block_shingles or len(docs) >= _DOC_LIMIT:
                    yield from flush(block, docs, sets)
                    block, docs, sets, held = block + 1, [], [], 0
        if docs:
            yield from flush(block, docs, sets)

    return run


def _list_lengths(table: pa.Table) -> pa.Table:
    """Of one range of hashes: the length of every list of at least two, told to each block in it."""
    rows = list(zip(*(table.column(c).to_pylist() for c in ("kind", "route", "block", "data"))))
    out = [r for r in rows if r[0] in (_DOCS, _HOT)]
    lists = [(b, np.frombuffer(d, dtype="<u8")) for kind, _, b, d in rows if kind == _LIST]
    sums = [(b, np.frombuffer(d, dtype=_HOT_ROW)) for kind, _, b, d in rows if kind == _SUM]
    if lists or sums:
        keys = [x for _, x in lists] + [(x["token"] << _IDX_BITS) | _EVERY for _, x in sums]
        counts = [np.ones(len(x), np.int64) for _, x in lists] + [x["count"].astype(np.int64) for _, x in sums]
        blocks = [b for b, _ in lists] + [b for b, _ in sums]
        source = np.repeat(np.arange(len(keys)), [len(x) for x in keys])
        key, count = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key >> _IDX_BITS, kind="stable")
        starts, lengths = _runs((key >> _IDX_BITS)[order])
        df = np.repeat(np.add.reduceat(count[order], starts), lengths)
        shared = df > 1
        order, df = order[shared], np.minimum(df[shared], 0xFFFFFFFF)
        by_source = np.argsort(source[order], kind="stable")
        order, df = order[by_source], df[by_source]
        cuts = np.searchsorted(source[order], np.arange(len(keys) + 1))
        for i, block in enumerate(blocks):
            if cuts[i] < cuts[i + 1]:
                span = slice(cuts[i], cuts[i + 1])
                told = np.zeros(cuts[i + 1] - cuts[i], dtype=_DF_ROW)
                told["key"], told["df"] = key[order[span]], df[span]
                out.append((_DF, 0, block, told.tobytes()))
    if not out:
        return pa.Table.from_batches([], schema=_packed([(0, 0, 0, b"")]).schema)
    return pa.Table.from_batches([_packed(out)])


def _short_lists(percent: int):
    """Of one block: the shingles by which each document is to be searched."""

    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(table.column("kind").to_pylist(), table.column("data").to_pylist()))
        docs = np.concatenate([np.frombuffer(d, dtype=_DOC_ROW) for kind, d in rows if kind == _DOCS])
        hot = [np.frombuffer(d, dtype="<u8") for kind, d in rows if kind == _HOT]
        told = [np.frombuffer(d, dtype=_DF_ROW) for kind, d in rows if kind == _DF]
        told = np.concatenate(told) if told else np.empty(0, dtype=_DF_ROW)
        whole = (told["key"] & _EVERY) == _EVERY
        key, df = told["key"][~whole], told["df"][~whole]
        if hot:
            # Frequent shingles: one length each, spread over the block's own list.
            lengths = told[whole]
            lengths = lengths[np.argsort(lengths["key"], kind="stable")]
            listed = np.concatenate(hot)
            at = np.searchsorted(lengths["key"] >> _IDX_BITS, listed >> _IDX_BITS)
            key, df = np.concatenate([key, listed]), np.concatenate([df, lengths["df"][at]])
        owner, token = (key & _EVERY).astype(np.int64), (key >> _IDX_BITS).astype(np.int64)
        order = np.lexsort((token, df, owner))
        owner, token = owner[order], token[order]
        shared = np.bincount(owner, minlength=len(docs))
        n = docs["n"].astype(np.int64)
        # T - 1 lists may be skipped for the smallest partner allowed, a set of percent * n.
        short = n - -(-percent * n // 100) + 1
        left = np.clip(short - (n - shared), 0, None)
        rank = np.arange(len(owner)) - np.repeat(np.cumsum(shared) - shared, shared)
        kept = (rank < left[owner]) & (docs["known"][owner] == 1)
        who = docs[owner[kept]]
        return pa.table(
            {
                "token": pa.array(token[kept], pa.int64()),
                "doc": pa.array(who["id"].astype(np.int64), pa.int64()),
                "n": pa.array(who["n"].astype(np.int32), pa.int32()),
                "hi": pa.array(who["hi"].astype(np.int64), pa.int64()),
                "lo": pa.array(who["lo"].astype(np.int64), pa.int64()),
            }
        )

    return run


def _unpack_docs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("data").to_pylist():
            docs = np.frombuffer(data, dtype=_DOC_ROW)
            ids = pa.array(docs["id"].astype(np.int64), pa.int64(), mask=docs["known"] == 0)
            rest = [pa.array(docs[c].astype(np.int64), pa.int64()) for c in ("n", "hi", "lo")]
            yield pa.RecordBatch.from_arrays([ids, *rest], names=["doc", "n", "hi", "lo"])


def t_occurrence(sets: list[np.ndarray], queries: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links that a DivideSkip search of ``queries`` in ``sets`` finds.

    Inverted lists are runs of one sorted array. For a query, lists go by length; the long ones, whose
    number grows with T, are left out and all others are merged, as sorted runs. A set met in at least
    T minus the number of long lists is a candidate, and only candidates are looked up in the long
    lists, by binary search. Sets that are in the query's component already are passed over: they
    could add no component.
    """
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    starts, lengths = _runs(flat)
    names = flat[starts]
    found = []
    component = np.arange(len(sets))
    for q in queries:
        n = int(sizes[q])
        at = np.searchsorted(names, sets[q])
        at = at[lengths[at] > 1]
        need = least_overlap(n, -(-percent * n // 100), percent)
        if len(at) < need:
            continue
        at = at[np.argsort(lengths[at], kind="stable")]
        longest = int(lengths[at[-1]])
        long_lists = min(need - 1, int(need / (0.01 * np.log2(longest + 1) + 1)))
        short, long_ = at[: len(at) - long_lists], at[len(at) - long_lists :]
        spans = lengths[short]
        first = np.repeat(starts[short] - np.cumsum(spans) + spans, spans)
        met = owner[first + np.arange(len(first))]
        met = met[component[met] != component[q]]
        if not len(met):
            continue
        cand, count = np.unique(met, return_counts=True)
        m = sizes[cand]
        needed = -(-percent * (n + m) // (100 + percent))
        fits = (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (count >= needed - long_lists)
        cand, count, needed = cand[fits], count[fits], needed[fits]
        for lst in long_:
            if not len(cand):
                break
            run = owner[starts[lst] : starts[lst] + lengths[lst]]
            place = np.searchsorted(run, cand)
            count = count + (run[np.minimum(place, len(run) - 1)] == cand)
        for other in cand[count >= needed].tolist():
            if component[other] != component[q]:
                found.append((int(q), other))
                component[component == component[other]] = component[q]
    return found


def _search(percent: int):
    def run(table: pa.Table) -> pa.Table:
        # A class comes once for being named and once for asking; its set is the same both times.
        keys = table.column("doc").to_numpy()
        asking = table.column("asks").to_numpy()
        docs, first = np.unique(keys, return_index=True)
        asks = dict.fromkeys(keys[asking].tolist(), True)
        docs = docs.tolist()
        data = table.column("data").take(pa.array(first))
        sets = [np.frombuffer(x.as_py(), dtype="<u8") for x in data]
        queries = np.array([i for i, d in enumerate(docs) if d in asks], dtype=np.int64)
        links = t_occurrence(sets, queries, percent) if len(queries) else []
        return pa.table(
            {"a": pa.array([docs[x] for x, _ in links], pa.int64()), "b": pa.array([docs[y] for _, y in links], pa.int64())}
        )

    return run


def ngram_groups(
    docs: DataFrame,
    k: int = 4,
    percent: int = 85,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_shingles: int = 2_000_000,
    hot_share: int = 8,
    cell_queries: int = 1024,
    cell_sets: int = 4096,
    cell_shingles: int = 1_000_000,
) -> DataFrame:
    """(id, n_shingles, component_id) for each row of ``docs``.

    Sets are the distinct runs of ``k`` lower-cased words of the whole text; with fewer words, the
    whole sequence. Two documents link when 100 * shared >= ``percent`` * all of their shingles;
    ``component_id`` is the smallest id that links lead to, the document's own included.

    Null, empty and blank texts have no shingles and link with nothing. A row without an id links with
    nothing and has a null component. Rows that repeat an id are one document with the links of all
    its rows. Empty tables give no rows; other columns are ignored.

    ``block_shingles``, ``cell_queries``, ``cell_sets`` and ``cell_shingles`` bound what a task holds, not
    what is found.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    routes = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = rows.mapInArrow(_pack(k, routes, block_shingles, hot_share), _PACKED)
    texts_in = rows.count()
    told = packed.groupBy("route").applyInArrow(_list_lengths, _PACKED)
    told = materialize(few_tasks(told, texts_in, TASK_TEXTS), "ngram_lists")

    ids = told.filter(F.col("kind") == _DOCS).select("data").mapInArrow(_unpack_docs, "doc long, n long, hi long, lo long")
    ids = materialize(ids, "ngram_ids")
    full = ids.filter((F.col("n") > 0) & F.col("doc").isNotNull())
    # A class of equal sets has a key of its own, since an id may stand for several; numbered when stored.
    classes = full.groupBy("hi", "lo").agg(F.min("doc").alias("rep"))
    n_full = full.count()
    classes = materialize(classes.withColumn("class", F.monotonically_increasing_id()), "ngram_classes", rows=n_full)
    # As in _short_lists: no set keeps more of its shingles.
    kept = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    n_kept = full.agg(F.coalesce(F.sum(kept), F.lit(0))).first()[0]

    searched = told.groupBy("block").applyInArrow(
        _short_lists(percent), "token long, doc long, n int, hi long, lo long"
    )
    member = classes.select("hi", "lo", F.col("rep").alias("doc"), "class")
    entries = searched.join(member, ["hi", "lo", "doc"]).select("token", "class", F.col("doc").alias("rep"), "n", "hi", "lo")
    entries = materialize(entries.distinct(), "ngram_entries", rows=n_kept)
    n_entries = entries.count()
    lists = entries.groupBy("token").agg(F.count_distinct("class").alias("c"), F.min("class").alias("lead"))
    lists = materialize(lists.filter(F.col("c") > 1), "ngram_leads", rows=n_entries)
    shared = materialize(entries.join(lists, "token"), "ngram_shared", rows=n_entries)
    n_shared = shared.count()

    # Cells: classes with the same lead stay together, small groups share a cell.
    groups = shared.groupBy("class").agg(F.min("lead").alias("lead"), F.max("n").cast("bigint").alias("n"))
    sizes = materialize(groups.groupBy("lead").agg(F.count("*").alias("c"), F.sum("n").alias("s")), "ngram_sizes", rows=n_shared)
    total, held = sizes.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("s"), F.lit(0))).first()
    cells = max(1, -(-total // cell_queries), -(-held // cell_shingles))
    split = F.greatest(F.ceil(F.col("c") / cell_queries), F.ceil(F.col("s") / cell_shingles)).cast("bigint")
    small = F.xxhash64(F.lit("small"), F.pmod(F.xxhash64("lead"), F.lit(cells)))
    large = F.xxhash64("lead", F.pmod(F.xxhash64("class"), split))
    cell = F.when(split > 1, large).otherwise(small)
    asked = materialize(groups.join(sizes, "lead").select("class", cell.alias("cell")), "ngram_cells", rows=n_shared)
    keyed = shared.withColumnRenamed("c", "named").select("token", "named", "class").join(asked, "class")
    keyed = materialize(keyed.select("token", "named", "cell").distinct(), "ngram_cell_tokens", rows=n_shared)
    most_named = keyed.agg(F.coalesce(F.sum("named"), F.lit(0))).first()[0]
    named = keyed.select("token", "cell").join(shared.select("token", "class", "n"), "token")
    named = named.select("cell", "class", "n").distinct()
    named = materialize(named, "ngram_named", rows=most_named)
    # Of a cell that names many classes, each part gets a share of them and all queries.
    count = F.greatest(F.ceil(F.count("*") / cell_sets), F.ceil(F.sum("n") / cell_shingles)).cast("bigint")
    parts = materialize(named.groupBy("cell").agg(count.alias("parts")), "ngram_parts", rows=total)
    looked_up = named.join(parts, "cell").select(
        "cell", F.pmod(F.xxhash64(F.lit("part"), "class"), "parts").alias("part"), F.col("class").alias("doc"), F.lit(False).alias("asks")
    )
    asking = asked.join(parts, "cell").select(
        "cell",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"),
        F.col("class").alias("doc"),
        F.lit(True).alias("asks"),
    )

    wanted = shared.select("rep", "class", "hi", "lo").distinct()
    texts = rows.join(wanted, F.col("_id") == F.col("rep")).select("class", "hi", "lo", "_text")

    def sets_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for part in slices(batches):
            made = [shingle_set(x, k, hashes) for x in part["_text"]]
            same = [i for i, x in enumerate(made) if set_digest(x) == (part["hi"][i], part["lo"][i])]
            ids_, data = [part["class"][i] for i in same], [made[i].tobytes() for i in same]
            yield pa.RecordBatch.from_arrays([pa.array(ids_, pa.int64()), pa.array(data, pa.binary())], names=["doc", "data"])

    sets = texts.mapInArrow(sets_of, "doc long, data binary")
    sets = materialize(few_tasks(sets, texts_in, TASK_TEXTS), "ngram_sets")
    dealt = looked_up.unionByName(asking).join(sets, "doc")
    links = dealt.groupBy("cell", "part").applyInArrow(_search(percent), "a long, b long")

    # An id whose rows fall into several classes joins them.
    owned = full.join(classes, ["hi", "lo"])
    several = owned.groupBy("doc").agg(F.collect_set("class").alias("of")).filter(F.size("of") > 1)
    several = several.select(F.array_min("of").alias("a"), F.explode("of").alias("b"))
    # A cell's links are fewer than its sets, so there are about as many as the rows dealt.
    asking_rows = asked.join(parts, "cell").agg(F.coalesce(F.sum("parts"), F.lit(0))).first()[0]
    labels = connected_components(links.unionByName(several), named.count() + asking_rows + n_full)
    placed = classes.join(labels, F.col("class") == F.col("node"), "left")
    placed = placed.select("hi", "lo", "rep", F.coalesce("component", "class").alias("component"))
    placed = materialize(placed, "ngram_placed", rows=n_full)
    smallest = placed.groupBy("component").agg(F.min("rep").alias("first"))
    named_classes = placed.join(smallest, "component").select("hi", "lo", "first")
    grouped = ids.join(named_classes, ["hi", "lo"], "left")
    linked = (F.col("n") > 0) & F.col("doc").isNotNull()
    return grouped.select(
        F.col("doc").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(linked, F.col("first")).otherwise(F.col("doc")).alias("component_id"),
    )
