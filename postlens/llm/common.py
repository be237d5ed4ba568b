"""Words, shingles and row batches, as every operator here counts them.

A word is a run of bytes other than the six ASCII white space characters; lower-casing touches A-Z
only. ``bytes.split`` and ``bytes.lower`` do just that, so texts are handled as UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

# Texts that a task writes at least, whose rows may be long.
TASK_TEXTS = 1000
# Words remembered by a task at most; beyond it the memory is emptied and filled anew.
REMEMBERED = 250_000
# Longer words, in bytes, are not remembered: so what a task remembers is bounded in bytes too.
LONG_WORD = 256
_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64
)


class WordHashes(dict):
    """64-bit hash of each word, computed once for each distinct word of a task."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONG_WORD:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words; none for null."""
    return text.lower().split() if text else []


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over their whole range."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words, in order; of the whole sequence where it is shorter."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    width = min(n, k)
    count = n - width + 1
    total = np.full(count, np.uint64(width), dtype=np.uint64)
    for i in range(width):
        total = mixed(total * _MULTIPLIERS[i % len(_MULTIPLIERS)] + hashes[i : i + count])
    return total


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[dict[str, list]]:
    """Columns of a few rows at a time as Python lists, so that a task holds few long texts at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield dict(zip(part.schema.names, (x.to_pylist() for x in part.columns)))


def fraction(values: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit hashes."""
    return (values >> np.uint64(11)).astype(np.float64) / float(1 << 53)
