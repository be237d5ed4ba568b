"""Byte-level BPE: every distinct word of the corpus is encoded once, and ids are joined back.

Texts are cut into pre-tokens ("words") by a pattern. A block of documents keeps, for every document,
the numbers of its words in order of position, and each distinct word of the block with its number.
The words of all blocks are spread over shards by a hash, so that equal ones meet in one task and are
encoded once; their ids go back to the blocks, where every document is put together by position. Only
a block's distinct words travel, compressed, so a word that fills a third of the corpus is one entry for
each block. Blocks are stored in buckets by their key and need not move when the ids come back. A block is
stored as several rows, whose documents are few, so that no single value is large.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import shared_dir

# Bounds of a rank file, which is read by the driver and sent to every executor.
MAX_TOKENS, MAX_FILE = 1_000_000, 64 << 20
# Words whose ids a task remembers at most, and characters whose words are one stored row.
REMEMBERED, ROW_CHARS = 100_000, 1 << 20


def token_table(path: str) -> tuple[list[bytes], list[int]]:
    """(token bytes, ids) of a rank file: a base64 token and its rank a line."""
    with open(path, "rb") as file:
        raw = file.read(MAX_FILE + 1)
    rows = [line.split() for line in raw.splitlines() if line.strip()]
    if len(raw) > MAX_FILE or len(rows) > MAX_TOKENS:
        raise ValueError(f"{path} is larger than {MAX_FILE} bytes or {MAX_TOKENS} tokens")
    return [base64.b64decode(a) for a, _ in rows], [int(b) for _, b in rows]


def token_bytes(spark: SparkSession, path: str) -> DataFrame:
    """The token-byte table (token_id, token) of a rank file."""
    tokens, ids = token_table(path)
    table = pa.table({"token_id": pa.array(ids, pa.int64()), "token": pa.array(tokens, pa.binary())})
    return spark.createDataFrame(table)


def library_pattern(pattern: str) -> tuple[str, str]:
    r"""(``pattern`` for texts with younger code points, these code points).

    The regex library and tiktoken's engine both follow Unicode, but not always the same version of it:
    letters and numbers that only the younger one knows would part words differently. Code points that
    Python's tables lack are therefore put to tiktoken itself, with ranks that join the letter "a", or a
    "1", to any first byte just where no border lies between them.
    """
    import regex
    import tiktoken

    unknown = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn")
    ranks = {bytes([b]): b for b in range(256)} | {bytes([x, b]): 256 + 256 * i + b for i, x in enumerate(b"a1") for b in range(256)}
    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    found = ""
    for kind, before in (("L", "a"), ("N", "1")):
        claimed = regex.findall(rf"\p{{{kind}}}", unknown)
        younger = "".join(c for c in claimed if probe.encode_ordinary(before + c)[0] < 256)
        found += younger
        points = set(map(ord, younger))
        firsts = [c for c in sorted(points) if c - 1 not in points]
        lasts = [c for c in sorted(points) if c + 1 not in points]
        if points:
            listed = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(firsts, lasts))
            pattern = pattern.replace(rf"\p{{{kind}}}", rf"[\p{{{kind}}}--[{listed}]]")
    return pattern, found


def word_finder(pattern: str, careful: str, younger: str):
    """A function that cuts a text into its pre-tokens."""
    import regex

    plain, exact, rare = regex.compile(pattern, regex.V1).findall, regex.compile(careful, regex.V1).findall, frozenset(younger)
    # Sets of ranges are slow to match, and hardly any text needs them.
    return lambda text: plain(text) if text.isascii() or rare.isdisjoint(text) else exact(text)


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: its own rank if it has one, else the pair of lowest rank is merged, the
    leftmost of equals first, until none is left. A heap keeps long words near linear."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    stop, before = list(range(1, n + 1)), list(range(-1, n))
    pairs = [(ranks[word[i : i + 2]], i, i + 1, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapify(pairs)
    while pairs:
        _, start, middle, end = heappop(pairs)
        if stop[start] != middle or stop[middle] != end:
            continue  # one of the two has been merged since
        stop[start], stop[middle], before[end] = end, -1, start
        if start:
            rank = ranks.get(word[before[start] : end])
            if rank is not None:
                heappush(pairs, (rank, before[start], start, end))
        if end < n:
            rank = ranks.get(word[start : stop[end]])
            if rank is not None:
                heappush(pairs, (rank, start, end, stop[end]))
    out, at = [], 0
    while at < n:
        out.append(ranks[word[at : stop[at]]])
        at = stop[at]
    return out


_BLOCK = "block long, doc_ids array<long>, counts array<long>, words long, positions binary, dictionary binary"


def _packed(numbers: np.ndarray, pieces: list[bytes] = ()) -> bytes:
    """Numbers, one byte plane after the other since the high ones are nearly all zero, and pieces."""
    import zstandard

    sizes = np.fromiter(map(len, pieces), np.uint32, len(pieces))
    head = np.array([len(numbers), len(sizes)], "<u8").tobytes()
    planes = [(x >> (8 * i)).astype(np.uint8).tobytes() for x in (numbers, sizes) for i in range(4)]
    return zstandard.ZstdCompressor(level=3).compress(b"".join([head, *planes, *pieces]))


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(numbers, sizes of the pieces, all pieces as one)."""
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    lengths, at, out = np.frombuffer(raw, "<u8", 2), 16, []
    for n in map(int, lengths):
        values = np.zeros(n, np.uint32)
        for i in range(4):
            values |= np.frombuffer(raw, np.uint8, n, at).astype(np.uint32) << np.uint32(8 * i)
            at += n
        out.append(values)
    return out[0], out[1], raw[at:]


def _split(sizes: np.ndarray, joined: bytes) -> list[bytes]:
    ends = np.cumsum(sizes, dtype=np.int64).tolist()
    return [joined[a:b] for a, b in zip([0, *ends[:-1]], ends)]


class _Numbers(dict):
    """Number of each distinct word, in order of appearance."""

    def __missing__(self, word: str) -> int:
        value = self[word] = len(self)
        return value


def _blocks(patterns: tuple[str, str, str], block_chars: int, block_docs: int, row_chars: int = ROW_CHARS):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words_of = word_finder(*patterns)
        # Unique in the stored table: the task's number and that of the block in it.
        block = TaskContext.get().partitionId() << 32
        types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary())
        names = [field.split()[0] for field in _BLOCK.split(", ")]
        number, ids, counts, parts, sizes, held = _Numbers(), [], [], [], [], 0

        def close() -> Iterator[pa.RecordBatch]:
            # Frequent words get small numbers, which take less room.
            met = np.bincount(np.concatenate(parts), minlength=len(number))
            order = np.argsort(-met, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            words = list(number)
            dictionary = _packed(np.empty(0, np.uint32), [words[i].encode() for i in order])
            at = 0
            while at < len(ids):
                stop, chars = at + 1, sizes[at]
                while stop < len(ids) and chars + sizes[stop] <= row_chars:
                    chars += sizes[stop]
                    stop += 1
                positions = _packed(rank[np.concatenate(parts[at:stop])])
                row = ([block], [ids[at:stop]], [counts[at:stop]], [0 if at else len(number)], [positions], [None if at else dictionary])
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types)], names=names)
                at = stop

        for batch in batches:
            for id_, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py() or ""
                words = words_of(text)
                found = np.fromiter(map(number.__getitem__, words), np.uint32, len(words))
                ids.append(id_.as_py()), counts.append(len(found)), parts.append(found), sizes.append(len(text))
                held += len(text)
                if held >= block_chars or len(ids) >= block_docs:
                    yield from close()
                    block += 1
                    number, ids, counts, parts, sizes, held = _Numbers(), [], [], [], [], 0
        if ids:
            yield from close()

    return run


def _shards(shards: int):
    """The words of each block by shard, with their numbers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for block, dictionary in zip(batch.column("block").to_pylist(), batch.column("dictionary")):
                _, sizes, joined = _unpacked(dictionary.as_py())
                words = _split(sizes, joined)
                shard = np.fromiter((xxhash.xxh3_64_intdigest(w) % shards for w in words), np.int64, len(words))
                order = np.argsort(shard, kind="stable")
                shard = shard[order]
                cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else []
                spans = list(zip(cuts[:-1], cuts[1:]))
                data = [_packed(order[a:b].astype(np.uint32), [words[i] for i in order[a:b]]) for a, b in spans]
                columns = [pa.array([block] * len(spans), pa.int64()), pa.array([shard[a] for a, _ in spans], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(data, pa.binary())], names=["block", "shard", "words"])

    return run


def _encoder(table):
    """Ids in place of words. Shards come one after the other, and each distinct word of a shard is encoded once for
    as long as it is remembered."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, last, known = dict(zip(*table.value)), None, {}
        for batch in batches:
            keys, counts, out = batch.column("block"), [], []
            for shard, data in zip(batch.column("shard").to_pylist(), batch.column("words")):
                if shard != last:
                    last, known = shard, {}
                numbers, sizes, joined = _unpacked(data.as_py())
                words = _split(sizes, joined)
                if len(known) > REMEMBERED:
                    known = {}
                for word in words:
                    if word not in known:
                        known[word] = merge_bytes(word, ranks)
                lengths = np.fromiter((len(known[word]) for word in words), np.uint32, len(words))
                flat = np.fromiter(chain.from_iterable(map(known.__getitem__, words)), np.uint32, int(lengths.sum()))
                counts.append(len(words)), out.append(_packed(np.concatenate([numbers, lengths, flat])))
            yield pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64()), pa.array(out, pa.binary())], names=["key", "n", "ids"])

    return run


def spell(symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, store: np.ndarray) -> np.ndarray:
    """The stored runs of ``symbols``, one after the other."""
    sizes = lengths[symbols]
    stops = np.cumsum(sizes)
    total = int(stops[-1]) if len(stops) else 0
    return store[np.repeat(starts[symbols] - (stops - sizes), sizes) + np.arange(total)]


def _runs(pieces: list[bytes], dtype: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    store = np.frombuffer(b"".join(pieces), dtype)
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces)) // store.itemsize
    return np.cumsum(lengths) - lengths, lengths, store


def _assemble(blocks: pa.Table, words: pa.Table) -> pa.Table:
    number, length, store = [np.empty(0, np.uint32)], [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
    for count, data in zip(words.column("n").to_pylist(), words.column("ids")):
        values = _unpacked(data.as_py())[0]
        number.append(values[:count]), length.append(values[count : 2 * count].astype(np.int64)), store.append(values[2 * count :])
    number, length, store = np.concatenate(number), np.concatenate(length), np.concatenate(store)
    starts, lengths = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
    starts[number], lengths[number] = np.cumsum(length) - length, length
    schema, out = pa.schema({"doc_id": pa.int64(), "ids": pa.binary()}), []
    for row in range(blocks.num_rows):
        symbols = _unpacked(blocks.column("positions")[row].as_py())[0]
        ends = np.cumsum(blocks.column("counts")[row].values.to_numpy())
        found = [spell(symbols[a:b], starts, lengths, store).astype("<u4", copy=False).tobytes() for a, b in zip([0, *ends[:-1]], ends)]
        ids = blocks.column("doc_ids")[row].values
        # One batch for each stored row, as small as that.
        out.append(pa.RecordBatch.from_arrays([ids, pa.array(found, pa.binary())], schema=schema))
    return pa.Table.from_batches(out, schema)


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` stored in buckets by ``key``, which later groups and joins on ``key`` use as they are."""
    spark = df.sparkSession
    name = f"buckets_{uuid4().hex}"
    writer = df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).format("parquet")
    writer.option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    stored = spark.table(name)
    # The files stay: only the name, which nothing needs any longer, leaves the catalogue.
    spark.sql(f"DROP TABLE {name}")
    return stored


def encode_documents(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = 6 << 20,
    block_docs: int = 100_000,
    shard_words: int = 500_000,
) -> DataFrame:
    """(doc_id, ids) for every row of ``docs``; ``ids`` holds unsigned 32-bit integers, lowest byte first.

    ``path`` is a rank file and ``pattern`` cuts a text into pre-tokens, each of which is encoded by
    itself, without special tokens. A null or empty text has no ids. Rows are independent, so rows that repeat an
    id, or have none, give a row each; an empty table gives none; other columns are not looked at. A task
    holds one block, ``block_chars`` characters and ``block_docs`` rows or a single longer text, and the
    words of one shard, about ``shard_words``, of which it remembers the ids of some.
    """
    spark = docs.sparkSession
    tokens, ids = token_table(path)
    table = spark.sparkContext.broadcast((tokens, ids))
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    cut = _blocks((pattern, *library_pattern(pattern)), block_chars, block_docs)
    blocks = _bucketed(named.mapInArrow(cut, _BLOCK), "block")
    # As many shards as keep the words of one in a task's memory.
    total = blocks.agg(F.sum("words")).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // shard_words + 1)
    words = blocks.filter("dictionary IS NOT NULL").select("block", "dictionary").mapInArrow(_shards(shards), "block long, shard long, words binary")
    met = words.repartition(shards, "shard").sortWithinPartitions("shard")
    back = met.mapInArrow(_encoder(table), "key long, n long, ids binary")
    texts = blocks.select("block", "doc_ids", "counts", "positions")
    return texts.groupBy("block").cogroup(back.groupBy("key")).applyInArrow(_assemble, "doc_id long, ids binary")


def _decoder(table):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, ids = table.value
        pieces = [b""] * (max(ids, default=-1) + 1)
        for id_, token in zip(ids, tokens):
            pieces[id_] = token
        runs = _runs(pieces, "u1")
        known = np.zeros(len(pieces), bool)
        known[ids] = True
        # Few rows at a time: a batch goes back twice as large.
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            column, out = batch.column(batch.schema.get_field_index("ids")), []
            for row in column:
                raw = row.as_py()
                symbols = np.frombuffer(raw or b"", "<u4")
                if len(symbols) and (symbols.max() >= len(known) or not known[symbols].all()):
                    raise ValueError("an id is not in the token-byte table")
                out.append(None if raw is None else spell(symbols, *runs).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    return run


def decode_documents(encoded: DataFrame, tokens: DataFrame) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ``ids`` by the token-byte table ``tokens``.

    The join is by position in the sent table, which is a vocabulary and bounded: more than
    ``MAX_TOKENS`` rows or ``MAX_FILE`` bytes fail. Null ids give null; an id without a token, or with
    two, fails.
    """
    count, size, distinct = tokens.agg(
        F.count("*"), F.coalesce(F.sum(F.octet_length("token")), F.lit(0)), F.count_distinct("token_id")
    ).first()
    if count > MAX_TOKENS or size > MAX_FILE or distinct != count:
        raise ValueError(f"{count} tokens of {size} bytes: too many, or repeated")
    rows = tokens.select("token", "token_id").collect()
    table = encoded.sparkSession.sparkContext.broadcast(([bytes(r[0]) for r in rows], [r[1] for r in rows]))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(_decoder(table), f"{fields}, decoded binary")
