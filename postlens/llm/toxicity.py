"""Toxicity of whole texts from a counterfactually regularised linear classifier."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LONG_WORD, REMEMBERED, slices, words_of

# Pairs of names of groups that are swapped in training texts; a score should not move with them.
IDENTITY_PAIRS = (
    ("men", "women"), ("man", "woman"), ("boys", "girls"), ("boy", "girl"), ("muslim", "christian"),
    ("muslims", "christians"), ("jewish", "hindu"), ("black", "white"), ("gay", "straight"), ("old", "young"),
    ("immigrants", "natives"), ("immigrant", "native"), ("männer", "frauen"), ("hommes", "femmes"),
    ("hombres", "mujeres"), ("juden", "christen"), ("musulmans", "chrétiens"), ("musulmanes", "cristianos"),
)
_PUNCTUATION = b".,;:!?\"'()[]{}<>*_-~`#&/\\|"
_SPACE_BITS = 20
_STEMS = (4, 5, 6)


def _slot(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) & ((1 << _SPACE_BITS) - 1)


def word_features(word: bytes) -> tuple[int, ...]:
    """Slots of a word: itself and its first letters, so that unseen endings still count."""
    word = word.strip(_PUNCTUATION)
    if not word:
        return ()
    text = word.decode("utf-8", "replace")
    stems = [b"\x00%d" % n + text[:n].encode() for n in _STEMS if len(text) > n]
    return (_slot(word), *map(_slot, stems))


def text_features(text: bytes | None) -> np.ndarray:
    """Distinct slots of the whole text, sorted."""
    slots: set[int] = set()
    for word in set(words_of(text)):
        slots.update(word_features(word))
    return np.array(sorted(slots), dtype=np.int32)


def swapped(text: bytes | None, pairs: Sequence[tuple[str, str]] = IDENTITY_PAIRS) -> bytes | None:
    """The text with each identity term replaced by its partner; None if it has none."""
    partner = {x.encode(): y.encode() for a, b in pairs for x, y in ((a, b), (b, a))}
    words = words_of(text)
    bare = [w.strip(_PUNCTUATION) for w in words]
    if not any(b in partner for b in bare):
        return None
    return b" ".join(w.replace(b, partner[b]) if b in partner else w for w, b in zip(words, bare))


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of a few thousand slots at most; ``counterparts`` is the number of training texts that name
    a group, whose swapped form the fit was held to. Without any, the penalty had nothing to act on."""

    slots: np.ndarray
    weights: np.ndarray
    bias: float
    counterparts: int = 0

    def scorer(self):
        """Function from a text to a score in [0, 1]; remembers words inside a task."""
        weight_of = dict(zip(self.slots.tolist(), self.weights.tolist()))
        known: dict[bytes, tuple[int, ...]] = {}

        def score(text: bytes | None) -> float:
            found: set[int] = set()
            for word in set(words_of(text)):
                slots = known.get(word)
                if slots is None:
                    slots = tuple(x for x in word_features(word) if x in weight_of)
                    if len(word) <= LONG_WORD:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[word] = slots
                if slots:
                    found.update(slots)
            total = self.bias + sum(weight_of[x] for x in sorted(found))
            return float(1.0 / (1.0 + np.exp(-np.clip(total, -60.0, 60.0))))

        return score


def _sums(rows: np.ndarray, slots: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=weights[slots], minlength=n)


def fit_model(
    slots: Sequence[np.ndarray],
    labels: np.ndarray,
    counterparts: Sequence[np.ndarray | None],
    max_slots: int = 4096,
    least_z: float = 4.0,
    l2: float = 1e-4,
    swap_penalty: float = 1.0,
    steps: int = 600,
    rate: float = 0.1,
) -> ToxicityModel:
    """Logistic regression with balanced classes on the slots that tell the classes apart.

    Slots are kept by the z of their share among label 1 against label 0. The loss adds
    ``swap_penalty`` times the mean square of the change in the linear score between a text and its
    counterpart with identity terms swapped, so weights of those terms are pulled together.
    """
    labels = np.asarray(labels, dtype=np.float64)
    n, ones = len(labels), labels.sum()
    if n == 0 or ones in (0, n):
        return ToxicityModel(np.empty(0, np.int32), np.empty(0), -5.0 if ones == 0 else 5.0)
    lengths = np.array([len(x) for x in slots])
    flat = np.concatenate([np.asarray(x, np.int32) for x in slots])
    row = np.repeat(np.arange(n, dtype=np.int32), lengths)
    size = 1 << _SPACE_BITS
    with_one = np.bincount(flat, weights=labels[row], minlength=size)
    with_any = np.bincount(flat, minlength=size).astype(np.float64)
    share1, share0 = (with_one + 0.5) / (ones + 1), (with_any - with_one + 0.5) / (n - ones + 1)
    pooled = (with_any + 1) / (n + 2)
    z = (share1 - share0) / np.sqrt(pooled * (1 - pooled) * (1 / ones + 1 / (n - ones)) + 1e-12)
    z[with_any == 0] = 0
    kept = np.flatnonzero(np.abs(z) >= least_z)
    kept = np.sort(kept[np.argsort(-np.abs(z[kept]), kind="stable")][:max_slots])
    place = np.full(size, -1, dtype=np.int32)
    place[kept] = np.arange(len(kept))
    del with_one, with_any, share1, share0, pooled, z

    def compact(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = place[values]
        return rows[at >= 0], at[at >= 0]

    rows, cols = compact(row, flat)
    changed = [i for i, x in enumerate(counterparts) if x is not None]
    pair_row = np.concatenate([np.full(len(slots[i]), k) for k, i in enumerate(changed)] or [np.empty(0, int)])
    twin_row = np.concatenate([np.full(len(counterparts[i]), k) for k, i in enumerate(changed)] or [np.empty(0, int)])
    a_rows, a_cols = compact(pair_row, np.concatenate([slots[i] for i in changed] or [np.empty(0, int)]).astype(int))
    b_rows, b_cols = compact(
        twin_row, np.concatenate([counterparts[i] for i in changed] or [np.empty(0, int)]).astype(int)
    )
    m = len(changed)
    balance = np.where(labels == 1, 0.5 / ones, 0.5 / (n - ones))
    weights, bias = np.zeros(len(kept)), 0.0
    first, second = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, steps + 1):
        logits = _sums(rows, cols, weights, n) + bias
        error = (1 / (1 + np.exp(-np.clip(logits, -60, 60))) - labels) * balance
        gradient = np.bincount(cols, weights=error[rows], minlength=len(kept)) + l2 * weights
        if m:
            moved = (_sums(a_rows, a_cols, weights, m) - _sums(b_rows, b_cols, weights, m)) * (2 * swap_penalty / m)
            gradient += np.bincount(a_cols, weights=moved[a_rows], minlength=len(kept))
            gradient -= np.bincount(b_cols, weights=moved[b_rows], minlength=len(kept))
        full = np.append(gradient, error.sum())
        first, second = 0.9 * first + 0.1 * full, 0.999 * second + 0.001 * full**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        weights, bias = weights - move[:-1], bias - move[-1]
    return ToxicityModel(kept.astype(np.int32), weights, float(bias), m)


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    label_id: str = "doc_id",
    max_per_class: int = 3000,
    pairs: Sequence[tuple[str, str]] = IDENTITY_PAIRS,
    **params,
) -> ToxicityModel:
    """Fits on at most ``max_per_class`` labelled texts of each class, the first by a hash of the id.

    Whole texts become sets of slots in the tasks; only those sets come to the driver. Labels or ids
    that are null are left out; an id labelled both ways counts as 1.
    """
    known = labels.filter(F.col(label_id).isNotNull() & F.col(label_col).isin(0, 1))
    known = known.groupBy(F.col(label_id).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
    chosen = None
    for value in (0, 1):
        side = known.filter(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(max_per_class)
        chosen = side if chosen is None else chosen.unionByName(side)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            twins = [swapped(x, pairs) for x in part["_text"]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part["_id"], pa.int64()),
                    pa.array(part["_label"], pa.int32()),
                    pa.array([text_features(x) for x in part["_text"]], pa.list_(pa.int32())),
                    pa.array([None if x is None else text_features(x) for x in twins], pa.list_(pa.int32())),
                ],
                names=["id", "label", "slots", "twin"],
            )

    joined = texts.join(F.broadcast(chosen), "_id").select("_id", "_label", "_text")
    made = joined.mapInArrow(features, "id long, label int, slots array<int>, twin array<int>").toArrow()
    ids, marks = made.column("id").to_numpy(), made.column("label").to_numpy()
    slots, twins = _lists(made.column("slots")), _lists(made.column("twin"))
    # The same order on every run, whatever order the tasks' rows came in.
    digests = [xxhash.xxh3_64_intdigest(x.tobytes()) for x in slots]
    order = sorted(range(len(slots)), key=lambda i: (ids[i], marks[i], digests[i]))
    return fit_model([slots[i] for i in order], marks[order], [twins[i] for i in order], **params)


def _lists(column: pa.ChunkedArray) -> list[np.ndarray | None]:
    """Views of the lists in an Arrow column, None where it is null."""
    out: list[np.ndarray | None] = []
    for chunk in column.chunks:
        values, offsets = chunk.values.to_numpy(zero_copy_only=False), chunk.offsets.to_numpy()
        for i, known in enumerate(chunk.is_valid().to_pylist()):
            out.append(values[offsets[i] : offsets[i + 1]] if known else None)
    return out


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with all their columns.

    Rows stay and go each by its own text; null and empty texts get the score of a text without words.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary())
            yield batch.filter(pa.array([score(x.as_py()) < threshold for x in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    threshold: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """(``keep`` columns, id, score, predicted) for each row; the whole text is read.

    Null and empty texts get the score of a text without words. The model is a few thousand numbers
    and travels with the tasks; nothing is shuffled.
    """
    columns = list(dict.fromkeys([id_col, *keep]))
    rows = docs.select(*columns, F.col(text_col).cast("binary").alias("_scored_text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            texts = batch.column("_scored_text")
            scores = []
            for start in range(0, len(texts), 256):
                scores += [score(x) for x in texts.slice(start, 256).to_pylist()]
            values = np.array(scores, dtype=np.float64)
            out = [batch.column(c) for c in columns]
            out += [pa.array(values), pa.array((values >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(out, names=[*columns, "score", "predicted"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", score double, predicted int"
    return rows.mapInArrow(run, schema)
