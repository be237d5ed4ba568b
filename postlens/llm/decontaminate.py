"""Benchmark passages in documents, also reworded ones, by latent semantic retrieval.

Documents are cut into overlapping passages of words. Each text is cut into words once, and the columns
of its words are stored. The passages' TF-IDF matrix is reduced by a randomised SVD that runs as three
scans of these columns: document frequencies, the product of the matrix with a random block and back,
and the search. Columns are the slots of words that the benchmark uses, since no other
word can bring a passage closer to an item. Passages near an item in the latent space are compared
with it word by word.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import materialize
from .common import LONG_WORD, REMEMBERED, slices

_PUNCTUATION = b".,;:!?\"'()[]{}"
_LOWER = bytes(range(256)).lower()
_ASCII = bytes(range(128))
_SLOTS = 1 << 16
_STRIPE = 1024
_COMMON = 256
_NONE = np.empty(0, np.int64)


def _fold(text: bytes) -> bytes:
    """Case-folded and composed; some marks are composed to ASCII ones."""
    folded = unicodedata.normalize("NFC", text.decode("utf-8", "surrogateescape")).casefold()
    return unicodedata.normalize("NFC", folded).encode("utf-8", "surrogateescape").translate(None, _PUNCTUATION)


class _FoldedChars(dict):
    """Bytes of each character and of its folded form; None if it may join the character before it."""

    def __missing__(self, char: str) -> tuple[bytes, bytes] | None:
        text = char.encode("utf-8", "surrogateescape")
        joins = unicodedata.category(char)[0] == "M" or "\u1100" <= char <= "\u11ff"
        value = self[char] = None if joins else (text, _fold(text))
        return value


class _FoldedWords(dict):
    """Folded form of each word beyond ASCII, made once for each distinct word of a task."""

    def __missing__(self, word: bytes) -> bytes:
        value = _fold(word)
        if len(word) <= LONG_WORD:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = value
        return value


_FOLDED_CHARS, _FOLDED_WORDS = _FoldedChars(), _FoldedWords()


def plain_words(text: bytes | None) -> list[bytes]:
    """Words without case, in composed form and without punctuation marks."""
    if not text:
        return []
    plain = text.translate(_LOWER, _PUNCTUATION)
    if plain.isascii():
        return plain.split()
    changes = [_FOLDED_CHARS[x] for x in set(plain.translate(None, _ASCII).decode("utf-8", "surrogateescape"))]
    if None in changes:
        return [x for w in plain.split() if (x := w if w.isascii() else _FOLDED_WORDS[w])]
    for char, folded in changes:
        if char != folded:
            plain = plain.replace(char, folded)
    return plain.split()


def _slot(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) & (_SLOTS - 1)


class _Columns:
    """Column of each word, -1 for words that the benchmark does not use."""

    def __init__(self, columns: dict[bytes, int]):
        self.columns = columns

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.columns.get, words, repeat(-1)), dtype=np.int64, count=len(words))


@dataclass(frozen=True)
class Item:
    """A part of a benchmark item of at most one passage, and the words of its answer."""

    item_id: int
    words: tuple[bytes, ...]
    answer: tuple[bytes, ...]
    counts: Counter = field(compare=False)


def _items(rows: Iterable[tuple[int, str | None, str | None]], width: int, verbatim: float) -> list[Item]:
    out = []
    for item_id, text, answer in rows:
        words = plain_words((text or "").encode())
        if answer is None:
            # Without an answer of its own, an item's last sentence takes its place.
            last = (text or "").rstrip().rstrip(".!?").replace("!", ".").replace("?", ".").rpartition(".")[2]
            reply = tuple(plain_words(last.encode()))
            if len(reply) > verbatim * len(words):
                # Whoever has all of that has the item: its end has to do.
                reply = reply[-max(1, len(words) // 4) :]
        else:
            reply = tuple(plain_words(answer.encode()))
        # Parts begin at every quarter of a passage, so that any excerpt nearly fills one; the last ends with the item.
        starts = [*range(0, max(0, len(words) - width), max(1, width // 4)), max(0, len(words) - width)]
        parts = (tuple(words[i : i + width]) for i in starts)
        out += [Item(item_id, part, reply, Counter(part)) for part in parts if part]
    return out


def common_length(a: tuple[bytes, ...], b: list[bytes]) -> int:
    """Length of the longest common subsequence, with one bit for each word of ``a``."""
    masks: dict[bytes, int] = {}
    for i, word in enumerate(a):
        masks[word] = masks.get(word, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for word in b:
        hit = state & masks.get(word, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


_STORED = "_id long, _text binary, words long, columns binary, steps binary"


def _prepared(columns: dict[bytes, int]):
    """Each text with the number of its words and, for those that have one, their columns and the steps
    from one such word to the next."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Columns(columns)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                counts, found, steps = [], [], []
                for text in part.column("_text"):
                    words = plain_words(text.as_py())
                    column = known.of(words)
                    at = np.flatnonzero(column >= 0)
                    counts.append(len(words))
                    found.append(column[at].astype("<u2").tobytes())
                    steps.append(np.diff(at, prepend=0).astype("<u4").tobytes())
                out = [*part.columns, pa.array(counts, pa.int64()), pa.array(found, pa.binary()), pa.array(steps, pa.binary())]
                yield pa.RecordBatch.from_arrays(out, names=[f.split()[0] for f in _STORED.split(", ")])

    return run


@dataclass(frozen=True)
class _Doc:
    """Number of words of a stored text, and the columns and places of those that have one."""

    words: int
    columns: np.ndarray
    places: np.ndarray


def _docs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict[str, list], list[_Doc]]]:
    for part in slices(batches):
        columns = [np.frombuffer(x, "<u2").astype(np.int64) for x in part["columns"]]
        places = [np.cumsum(np.frombuffer(x, "<u4"), dtype=np.int64) for x in part["steps"]]
        yield part, [_Doc(*x) for x in zip(part["words"], columns, places)]


Piece = tuple[int, int, int]


def _pieces(docs: list[_Doc], half: int, limit: int = 16_384) -> Iterator[list[Piece]]:
    """Groups of (document, first word, number of words) of about ``limit`` words at most.

    A longer document is cut where halves begin; its pieces share one half, so that each of its
    passages lies in exactly one of them.
    """
    step = max(half, limit // half * half)
    group: list[Piece] = []
    held = 0
    for number, doc in enumerate(docs):
        start = 0
        while True:
            size = max(0, min(step + half, doc.words - start))
            if group and held + size > limit:
                yield group
                group, held = [], 0
            group.append((number, start, size))
            held += size
            start += step
            if start + half >= doc.words:
                break
    if group:
        yield group


class _Halves:
    """Half passages of a few pieces in a row; two neighbours of one piece make a passage."""

    def __init__(self, docs: list[_Doc], pieces: list[Piece], half: int):
        lengths = np.array([size for _, _, size in pieces], dtype=np.int64)
        self.per_doc = np.maximum(1, -(-lengths // half))
        self.first = np.cumsum(self.per_doc) - self.per_doc
        self.n = int(self.per_doc.sum())
        columns, segments = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for (number, start, size), first in zip(pieces, self.first):
            doc = docs[number]
            a, b = np.searchsorted(doc.places, (start, start + size)) if size < doc.words else (0, len(doc.places))
            columns.append(doc.columns[a:b]), segments.append((doc.places[a:b] - start) // half + first)
        self.columns, self.segment = np.concatenate(columns), np.concatenate(segments)
        self.parted = None
        # A passage starts at every half but the last of a document, or at the only one.
        last = np.zeros(self.n, dtype=bool)
        last[self.first + self.per_doc - 1] = True
        alone = np.repeat(self.per_doc, self.per_doc) == 1
        self.joined = np.flatnonzero(~last)
        self.starts = ~last | alone

    def split(self, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(counts of the ``common`` columns in each half, columns and segments of all other words)."""
        if self.parted is not None and self.parted[0] is common:
            return self.parted[1]
        place = np.full(int(max(common.max(initial=0), self.columns.max(initial=0))) + 1, -1)
        place[common] = np.arange(len(common))
        at = place[self.columns]
        inside = at >= 0
        cells = np.bincount(self.segment[inside] * len(common) + at[inside], minlength=self.n * len(common))
        counts = cells.reshape(self.n, len(common)).astype(np.float32)
        self.parted = (common, (counts, self.columns[~inside], self.segment[~inside]))
        return self.parted[1]

    def passages(self, weighted: np.ndarray, common: np.ndarray = _NONE) -> np.ndarray:
        """Sum of the words' rows over the passage that starts at each half; zeros where none does.

        A few ``common`` columns hold most words: they are counted and multiplied as a dense matrix.
        """
        counts, columns, segment = self.split(common)
        sums = counts @ weighted[common].astype(np.float32)
        if len(columns):
            runs = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            sums[segment[runs]] += np.add.reduceat(weighted[columns], runs, axis=0)
        made = sums.copy()
        made[self.joined] += sums[self.joined + 1]
        made[~self.starts] = 0
        return made

    def columns_times(self, rows: np.ndarray, total: np.ndarray, common: np.ndarray = _NONE) -> None:
        """Adds to ``total``, for each column, the ``rows`` of the halves its words lie in."""
        counts, columns, segment = self.split(common)
        total[common] += counts.T @ rows
        if len(columns):
            order = np.argsort(columns, kind="stable")
            column = columns[order]
            runs = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
            total[column[runs]] += np.add.reduceat(rows[segment[order]], runs, axis=0)

    def around(self, made: np.ndarray) -> np.ndarray:
        """Sum of the passages that each half lies in."""
        out = made.copy()
        out[self.joined + 1] += made[self.joined]
        return out


def _all_halves(batches: Iterable[pa.RecordBatch], half: int) -> Iterator[_Halves]:
    for _, docs in _docs(batches):
        for pieces in _pieces(docs, half):
            yield _Halves(docs, pieces, half)


def _frequencies(width: int, half: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(width, np.int64)
        for halves in _all_halves(batches, half):
            # A half lies in its own passage and in the one before; a word counts once in each.
            both = np.concatenate([halves.segment, halves.segment - 1])
            inside = np.concatenate([halves.starts[halves.segment], np.isin(halves.segment - 1, halves.joined)])
            pairs = (both * width + np.concatenate([halves.columns, halves.columns]))[inside]
            df += np.bincount(np.unique(pairs) % width, minlength=width)
        used = np.flatnonzero(df)
        out = [pa.array(used, pa.int64()), pa.array(df[used], pa.int64())]
        yield pa.RecordBatch.from_arrays(out, names=["column", "df"])

    return run


def _range_finder(width: int, half: int, idf: np.ndarray, common: np.ndarray, rank: int, seed: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        weighted = _random_block(width, rank, seed) * idf[:, None]
        total = np.zeros((width, rank), dtype=np.float64)
        for halves in _all_halves(batches, half):
            if len(halves.columns):
                halves.columns_times(halves.around(halves.passages(weighted, common)), total, common)
        total *= idf[:, None]
        for stripe in range(0, width, _STRIPE):
            data = total[stripe : stripe + _STRIPE].tobytes()
            columns = [pa.array([stripe // _STRIPE], pa.int64()), pa.array([task], pa.int64()), pa.array([data], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["stripe", "part", "data"])

    return run


_STRIPES = "stripe long, part long, data binary"


def _add_stripes(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), dtype=np.float64) for x in table.column("data"))
    data = pa.array([total.tobytes()], pa.binary())
    return pa.table({"stripe": table.column("stripe").slice(0, 1), "part": table.column("part").slice(0, 1), "data": data})


def _sum_stripes(stripes: DataFrame, fan: int = 32) -> DataFrame:
    """One row for each stripe: the parts of all tasks are added ``fan`` at a time, level by level."""
    while True:
        up = stripes.withColumn("part", F.floor(F.col("part") / fan))
        stripes = materialize(up.groupBy("stripe", "part").applyInArrow(_add_stripes, _STRIPES), "latent")
        if not stripes.agg(F.max("part")).first()[0]:
            return stripes


def _search(
    half: int, basis: np.ndarray, common: np.ndarray, items: list[Item], latent: np.ndarray, near: np.ndarray,
    verbatim: float, reworded: float,
):
    def compare(item: Item, around: list[bytes]) -> float:
        """Share of the item that is found, 0 if that is too little."""
        if sum((item.counts & Counter(around)).values()) < reworded * len(item.words):
            return 0.0
        ratio = common_length(item.words, around) / len(item.words)
        if ratio >= verbatim:
            return ratio
        told = bool(item.answer) and common_length(item.answer, around) == len(item.answer)
        return ratio if ratio >= reworded and (told or not item.answer) else 0.0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, docs in _docs(batches):
            words: dict[int, list[bytes]] = {}
            hits: dict[tuple[int, int], tuple[float, float]] = {}
            for pieces in _pieces(docs, half):
                halves = _Halves(docs, pieces, half)
                made = halves.passages(basis, common)
                norms = np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-12)
                cosines = (made / norms) @ latent.T
                places, which = np.nonzero(cosines >= near[None, :])
                owners = np.searchsorted(halves.first, places, side="right") - 1
                for owner, place, i in zip(owners.tolist(), places.tolist(), which.tolist()):
                    doc, offset, _ = pieces[owner]
                    item, start = items[i], offset + (place - int(halves.first[owner])) * half
                    best = hits.get((doc, item.item_id), (0.0, 0.0))
                    if best[0] < 1.0:
                        if doc not in words:
                            words[doc] = plain_words(part["_text"][doc])
                        ratio = compare(item, words[doc][max(0, start - half) : start + 3 * half])
                        if ratio > 0:
                            hits[doc, item.item_id] = max(best, (ratio, float(cosines[place, i])))
            found = sorted(hits.items())
            ids = [part["_id"][doc] for (doc, _), _ in found]
            rest = [[item for (_, item), _ in found], [x for _, (x, _) in found], [x for _, (_, x) in found]]
            types = (pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(x, t) for x, t in zip(rest, types))],
                names=["doc_id", "item_id", "common", "cosine"],
            )

    return run


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    item_answer: str | None = None,
    width: int = 48,
    rank: int = 128,
    oversample: int = 16,
    near: float = 0.55,
    verbatim: float = 0.75,
    reworded: float = 0.6,
    seed: int = 11,
    item_block: int = 20_000,
) -> DataFrame:
    """(doc_id, item_id, common, cosine): one row for each document and the item found in it.

    Passages are ``width`` words and overlap by half. A passage is a candidate for an item if their
    cosine in the ``rank`` latent dimensions reaches ``near`` times the share of the passage that the
    item can fill, as a root. A candidate counts if the longest common subsequence of the item and
    the passage's surroundings is at least ``verbatim`` of the item, or at least ``reworded`` while
    the whole answer occurs too, in order. An item without an answer column answers with its last
    sentence, or with its last quarter if that sentence is more than ``verbatim`` of it. Items longer
    than a passage are searched by parts that overlap by three quarters, up to the last word.

    Null and empty documents and items match nothing; a document without an id is searched but its
    rows carry a null id; repeated rows give repeated rows; an empty benchmark or table gives none.

    All statistics come from every document. At most 65,536 word slots exist, so the vectors that
    travel are bounded whatever the tables' size; items are searched in blocks of ``item_block``. The
    benchmark, its words and its items are what every task is asked about and travel whole.
    """
    spark = docs.sparkSession
    half = width // 2
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    answer = F.col(item_answer).cast("string") if item_answer else F.lit(None).cast("string")
    asked = benchmark.filter(F.col(item_id).isNotNull()).select(
        F.col(item_id).cast("bigint"), F.col(item_text).cast("string"), answer
    )
    items = _items(sorted(set(map(tuple, asked.collect())), key=repr), width, verbatim)
    empty = spark.createDataFrame([], "doc_id long, item_id long, common double, cosine double")
    used = sorted({w for item in items for w in item.words})
    if not used:
        return empty
    place = {slot: i for i, slot in enumerate(sorted(set(map(_slot, used))))}
    columns, n = {w: place[_slot(w)] for w in used}, len(place)
    rows = materialize(rows.mapInArrow(_prepared(columns), _STORED), "prepared_texts")
    narrow = rows.select("words", "columns", "steps")
    counted = narrow.mapInArrow(_frequencies(n, half), "column long, df long")
    df = np.zeros(n)
    for column, total in counted.groupBy("column").agg(F.sum("df")).collect():
        df[column] = total
    # Inverse document frequency in its power form, up to a constant: columns of like length.
    idf = (1.0 / np.sqrt(df + 1.0)).astype(np.float32)
    common = np.sort(np.argsort(-df, kind="stable")[:_COMMON])
    wide = min(n, rank + oversample)
    stripes = _sum_stripes(narrow.mapInArrow(_range_finder(n, half, idf, common, wide, seed), _STRIPES))
    parts = {r[0]: np.frombuffer(bytes(r[2]), dtype=np.float64) for r in stripes.collect()}
    if not parts:
        return empty
    back = np.concatenate([parts[i] for i in sorted(parts)]).reshape(n, wide)
    weighted = latent_basis(back, _random_block(n, wide, seed), rank) * idf[:, None]
    weighted = weighted.astype(np.float32)
    out = None
    for start in range(0, len(items), item_block):
        block = items[start : start + item_block]
        latent = np.stack([weighted[[columns[w] for w in x.words]].sum(axis=0) for x in block])
        latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
        level = near * np.sqrt([min(1.0, len(x.words) / width) for x in block])
        hits = rows.mapInArrow(
            _search(half, weighted, common, block, latent.astype(np.float32), level.astype(np.float32), verbatim, reworded),
            "doc_id long, item_id long, common double, cosine double",
        )
        out = hits if out is None else out.unionByName(hits)
    return out


def _random_block(rows: int, columns: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((rows, columns)).astype(np.float32)


def latent_basis(back: np.ndarray, omega: np.ndarray, rank: int) -> np.ndarray:
    """Map to the latent space: right singular vectors of A over their singular values.

    ``back`` is A'A omega. The eigenvectors of back (omega' back)^-1 back' approximate those of A'A (a
    one-pass Nystroem step); its core is small, and a floor under its eigenvalues makes a deficient
    rank harmless. Dividing by the singular values, as in folding in, keeps the few directions that
    all prose shares from hiding the others.
    """
    core = omega.T.astype(np.float64) @ back
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    floor = max(float(values.max()) * 1e-10, 1e-300)
    left, singular, _ = np.linalg.svd(back @ (vectors / np.sqrt(np.maximum(values, floor))), full_matrices=False)
    kept = singular[:rank] > max(singular[0], 1e-300) * 1e-6
    return left[:, :rank] * np.where(kept, 1.0 / np.maximum(singular[:rank], 1e-300), 0.0)
