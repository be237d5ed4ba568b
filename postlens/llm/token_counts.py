"""Token counts under a unigram vocabulary, with the best scores of shared prefixes computed once."""

from __future__ import annotations

import math
from array import array
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LONG_WORD, REMEMBERED, slices, words_of

MARK = "▁"
Score = tuple[float, int]


def zipf_scores(pieces: Iterable[str]) -> dict[str, float]:
    """Log probabilities of pieces in order of frequency, by the law p ~ 1 / (rank + 2.7)."""
    ranked = list(dict.fromkeys(pieces))
    total = math.fsum(1.0 / (i + 2.7) for i in range(1, len(ranked) + 1))
    return {x: -math.log((i + 2.7) * total) for i, x in enumerate(ranked, 1)}


def sentencepiece_pieces(path: str) -> list[str]:
    """The ordinary pieces of a vocabulary file, in its order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


class Trie:
    """Pre-tokens in a trie; each node holds the best segmentation of the prefix it stands for.

    A node's score is found once, from the nodes above it, when the node is made: the best over all
    vocabulary pieces that end there. Pre-tokens that share a prefix share those nodes, and the node
    where a pre-token ends stores its number of tokens. Equal scores go to fewer tokens, then to the
    shorter last piece. A character that is no piece costs ``byte_score`` for each UTF-8 byte, and
    each of these bytes is a token. Before it would exceed ``most_nodes`` the trie starts anew.
    """

    def __init__(self, scores: dict[str, float], byte_score: float, most_nodes: int = 1_000_000):
        self.scores, self.byte_score, self.most_nodes = scores, byte_score, most_nodes
        # What no piece ends with, no longer piece ends with either.
        self.endings = {x[i:] for x in scores for i in range(len(x))}
        self.clear()

    def clear(self) -> None:
        self.edges: dict[int, int] = {}
        self.log_prob, self.tokens = array("d", [0.0]), array("q", [0])

    def insert(self, word: str) -> Score:
        """(best log probability, number of tokens) of a pre-token."""
        if len(word) > self.most_nodes:
            return self._alone(word)
        if len(self.tokens) + len(word) > self.most_nodes:
            self.clear()
        edges, logs, counts = self.edges, self.log_prob, self.tokens
        scores, endings = self.scores, self.endings
        path, node = [0], 0
        for end, char in enumerate(word, 1):
            edge = node << 21 | ord(char)
            child = edges.get(edge)
            if child is None:
                best, fewest, start = -math.inf, 0, end - 1
                if char not in scores:
                    width = len(char.encode("utf-8", "replace"))
                    best, fewest = logs[node] + self.byte_score * width, counts[node] + width
                while start >= 0:
                    piece = word[start:end]
                    if piece not in endings:
                        break
                    gain = scores.get(piece)
                    if gain is not None:
                        above = path[start]
                        total = logs[above] + gain
                        if total > best or (total == best and counts[above] + 1 < fewest):
                            best, fewest = total, counts[above] + 1
                    start -= 1
                child = edges[edge] = len(counts)
                logs.append(best)
                counts.append(fewest)
            path.append(child)
            node = child
        return logs[node], counts[node]

    def _alone(self, word: str) -> Score:
        """The same for a word too long for the trie: only as many steps back as the longest piece
        reaches are held."""
        reach = max(map(len, self.scores), default=1)
        held: deque[Score] = deque([(0.0, 0)], maxlen=reach)
        for end, char in enumerate(word, 1):
            best, fewest = -math.inf, 0
            if char not in self.scores:
                width = len(char.encode("utf-8", "replace"))
                best, fewest = held[-1][0] + self.byte_score * width, held[-1][1] + width
            for back in range(1, len(held) + 1):
                piece = word[end - back : end]
                if piece not in self.endings:
                    break
                gain = self.scores.get(piece)
                if gain is not None:
                    total, count = held[-back][0] + gain, held[-back][1] + 1
                    if total > best or (total == best and count < fewest):
                        best, fewest = total, count
            held.append((best, fewest))
        return held[-1]


def count_tokens(
    docs: DataFrame,
    pieces: Callable[[], dict[str, float]],
    id_col: str = "doc_id",
    text_col: str = "text",
    most_nodes: int = 1_000_000,
) -> DataFrame:
    """(id, n_words, n_tokens, log_prob) for each row of ``docs``, from whole texts.

    Pre-tokens are lower-cased words with a mark in front; ``pieces`` builds the vocabulary's scores
    inside the task. Their best segmentation is the one of highest probability (``Trie``). A document
    has the sum over its pre-tokens; without words, null or empty, all three are 0. Repeated rows and
    rows without an id are rows like any other; other columns are ignored. Nothing is shuffled, and a
    task forgets its trie before it has more than ``most_nodes`` nodes, and a longer word is cut without
    one, so memory is bounded however many different words there are and however long.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = pieces()
        trie = Trie(scores, min(scores.values(), default=-1.0) - 1.0, most_nodes)
        met: dict[bytes, Score] = {}
        for batch in batches:
            words, tokens, logs = [], [], []
            for start in range(0, batch.num_rows, 256):
                for text in batch.column("_text").slice(start, 256).to_pylist():
                    split = words_of(text)
                    found = []
                    for word in split:
                        score = met.get(word)
                        if score is None:
                            score = trie.insert(MARK + word.decode("utf-8", "replace"))
                            if len(word) <= LONG_WORD:
                                if len(met) >= REMEMBERED:
                                    met.clear()
                                met[word] = score
                        found.append(score)
                    words.append(len(split))
                    tokens.append(sum(n for _, n in found))
                    logs.append(math.fsum(s for s, _ in found))
            out = [batch.column("_id"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64()), pa.array(np.array(logs, float))]
            yield pa.RecordBatch.from_arrays(out, names=["_id", "n_words", "n_tokens", "log_prob"])

    kind = rows.schema["_id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"_id {kind}, n_words long, n_tokens long, log_prob double")
    return counted.withColumnRenamed("_id", id_col)
