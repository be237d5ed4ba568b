"""Token ids in seekable zstandard files: one frame for each document, seek table at the end.

Layout of a shard::

    frame 0 | frame 1 | ... | id frame | seek table

Each data frame is an independent zstandard frame with one document's ids as little-endian unsigned
32-bit integers. The id frame is a skippable frame with one record of 9 bytes per document: 1 if it
has an id, and the id as a signed 64-bit integer. The seek table is the skippable frame of the public
seekable format: compressed size, decompressed size and checksum (the low 32 bits of XXH64 of the
decompressed bytes) of each frame, then the footer. A reader fetches the tail and then only the
frames it wants.
"""

from __future__ import annotations

import json
import os
import string
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import materialize, shared_dir
from .common import TASK_TEXTS, slices

SKIPPABLE_IDS = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
_ENTRY = np.dtype([("compressed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
_ID = np.dtype([("known", "u1"), ("id", "<i8")])
_REMEMBERED = 300_000
_REMEMBERED_BYTES = 32 << 20
# Characters of texts that are cut at once; a longer text is cut by itself.
_AT_ONCE = 4 << 20
MANIFEST = "shard int, path string, first_id long, docs long, tokens long, bytes long"
INDEX = "doc_id long, shard int, pos long, n_tokens long, ids_crc32 long"

Encoder = Callable[[list[str]], list[np.ndarray]]


# A run of these after letters is one pre-token by itself.
_TAIL = string.punctuation
_LETTERS = "[\\p{L}]+"


def _plain_bpe(path: str) -> bool:
    """Whether a run of lower-case letters is one pre-token that goes to a byte-level BPE as it is."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    normalizers = (spec.get("normalizer") or {}).get("normalizers", [])
    splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        spec["model"].get("type") == "BPE"
        and not spec["model"].get("dropout")
        and {x["type"] for x in normalizers} <= {"NFC", "Replace", "Lowercase"}
        and [x.get("content") for x in normalizers if x["type"] == "Replace"] in ([], [" "])
        and [x["type"] for x in splits] == ["Split", "ByteLevel"]
        and splits[0].get("invert") is True
        and _LETTERS in splits[0]["pattern"].get("Regex", "").split("|")
        and splits[1].get("add_prefix_space") is False
    )


def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves, others move past 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _spelled(words: list[str]) -> list[str]:
    """``words``, none with a line feed, in the letters of their bytes."""
    points = np.array([ord("\n") if b == 10 else ord(c) for b, c in sorted(_byte_letters().items())], "<u2")
    raw = np.frombuffer("\n".join(words).encode(), np.uint8)
    return points[raw].tobytes().decode("utf-16-le").split("\n")


def _bounded(texts: list[str], chars: int) -> Iterator[list[str]]:
    """``texts`` in order, in lists of at most ``chars`` characters or of one text."""
    part, held = [], 0
    for text in texts:
        if part and held + len(text) > chars:
            yield part
            part, held = [], 0
        part.append(text)
        held += len(text)
    if part:
        yield part


class _Words(dict):
    """Number of each word met; new words queue up until their ids are looked up."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []
        self.held = 0

    def clear(self) -> None:
        super().clear()
        self.held = 0

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        # In bytes, at most.
        self.held += len(word) if word.isascii() else 4 * len(word)
        return number


@lru_cache(maxsize=2)
def _loaded(path: str, stamp: int) -> tuple:
    """(tokenizer, whether it is plain) of a file. Loading takes as long as a good many texts, so a Python worker
    does it once for all of its tasks."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path), _plain_bpe(path)


def word_encoder(path: str, end_id: int) -> Callable[[], Encoder]:
    """Encoder for a tokenizer file whose pre-tokenizer never looks across white space and that does
    not tell A-Z from a-z.

    Arrow cuts the texts and numbers the distinct words between ASCII white space, each of which is encoded by
    the library once for as long as it is remembered; the pieces are put together: the ids equal those of the whole text. Words of
    letters only, after which punctuation may stand, go to the library's model straight away where the file's settings allow it (``_plain_bpe``); all others go through its pipeline.
    """

    def build() -> Encoder:
        import unicodedata

        tokenizer, plain = _loaded(path, os.stat(path).st_mtime_ns)
        # Added tokens are matched as they are written, before the library lower-cases anything.
        marks = [x.content.encode().lower().decode() for x in tokenizer.get_added_tokens_decoder().values()]
        tokenize = tokenizer.model.tokenize
        words, tails = _Words(), {}
        store = {"ids": np.empty(0, "<u4"), "lengths": np.empty(0, np.int64)}

        def whole(word: str) -> list[int]:
            return tokenizer.encode(word, add_special_tokens=False).ids

        def ids_of(split: list[str]) -> list[list[int]]:
            if not plain:
                return [whole(word) for word in split]
            cores, out = [word.rstrip(_TAIL) for word in split], []
            for word, core, spelled in zip(split, cores, _spelled(cores)):
                if not core.isalpha():
                    out.append(whole(word))
                elif not core.isascii() and not (core == core.lower() and unicodedata.is_normalized("NFC", core)):
                    out.append(whole(word))
                else:
                    found = [x.id for x in tokenize(spelled)]
                    if len(core) < len(word):
                        tail = word[len(core) :]
                        if tail not in tails and len(tails) < 10_000:
                            tails[tail] = whole(tail)
                        found += tails[tail] if tail in tails else whole(tail)
                    out.append(found)
            return out

        def encode(texts: list[str]) -> list[np.ndarray]:
            return [ids for part in _bounded(texts, _AT_ONCE) for ids in encode_part(part)]

        def encode_part(texts: list[str]) -> list[np.ndarray]:
            if len(words) > _REMEMBERED or words.held > _REMEMBERED_BYTES:
                words.clear()
                store.update(ids=np.empty(0, "<u4"), lengths=np.empty(0, np.int64))
            # Words of all texts; an empty one, before or after white space at a text's end, has no ids.
            raw = pa.array(texts, pa.large_string())
            split = pc.ascii_split_whitespace(pc.ascii_lower(raw))
            found = split.flatten()
            for mark in marks:
                holds = pc.match_substring(found, mark)
                if pc.any(holds).as_py():
                    found = pc.if_else(holds, pc.ascii_split_whitespace(raw).flatten(), found)
            coded = found.dictionary_encode()
            distinct = coded.dictionary.to_numpy(zero_copy_only=False)
            numbers = np.fromiter(map(words.__getitem__, distinct), dtype=np.int64, count=len(distinct))
            bounds = split.offsets.to_numpy()
            at_all = coded.indices.to_numpy()
            placed = (numbers[at_all[a:b]] for a, b in zip(bounds[:-1], bounds[1:]))
            if words.fresh:
                made = ids_of(words.fresh)
                words.fresh.clear()
                lengths = np.fromiter(map(len, made), dtype=np.int64, count=len(made))
                flat = np.fromiter(chain.from_iterable(made), dtype="<u4", count=int(lengths.sum()))
                store["ids"] = np.concatenate([store["ids"], flat])
                store["lengths"] = np.concatenate([store["lengths"], lengths])
            ends = np.cumsum(store["lengths"])
            out = []
            for at in placed:
                sizes = store["lengths"][at]
                stops = np.cumsum(sizes)
                total = int(stops[-1]) if len(stops) else 0
                ids = np.empty(total + 1, dtype="<u4")
                # Position of each id in the store: the start of its word's piece plus its rank in it.
                ids[:-1] = store["ids"][np.repeat(ends[at] - stops, sizes) + np.arange(total)]
                ids[-1] = end_id
                out.append(ids)
            return out

        return encode

    return build


class ShardWriter:
    """Writes one shard. The caller may use any file object that has ``write``."""

    def __init__(self, sink, level: int = 1):
        self.sink, self.level = sink, level
        self.codec = zstandard.ZstdCompressor(level=level, write_content_size=True, write_checksum=False)
        self.entries: list[tuple[int, int, int]] = []
        self.ids: list[tuple[int, int]] = []
        self.written = 0

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.written += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        raw = ids.astype("<u4", copy=False).tobytes()
        frame = self.codec.compress(raw)
        self.entries.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.ids.append((0, 0) if doc_id is None else (1, doc_id))
        self._put(frame)

    def close(self) -> None:
        body = np.array(self.ids, dtype=_ID).tobytes()
        self._put(struct.pack("<II", SKIPPABLE_IDS, len(body)) + body)
        # The id frame is an entry of the table too, as the format asks of every frame.
        rows = [*self.entries, (len(body) + 8, 0, 0)]
        table = np.array(rows, dtype=_ENTRY).tobytes() + struct.pack("<IBI", len(rows), 0x80, SEEK_MAGIC)
        self._put(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)


class ShardReader:
    """Random access to the documents of a shard. ``source`` is a seekable binary file."""

    def __init__(self, source):
        self.source = source
        source.seek(0, 2)
        size = source.tell()
        if size < 17:
            raise ValueError("not a token shard: too short")
        source.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEK_MAGIC or not flags & 0x80:
            raise ValueError("not a token shard: no seek table with checksums")
        width = count * _ENTRY.itemsize
        source.seek(size - 9 - width - 8)
        head, length = struct.unpack("<II", source.read(8))
        if head != SKIPPABLE_SEEK or length != width + 9:
            raise ValueError("damaged seek table")
        self.entries = np.frombuffer(source.read(width), dtype=_ENTRY)
        self.starts = np.concatenate([[0], np.cumsum(self.entries["compressed"].astype(np.int64))])
        source.seek(int(self.starts[-2]))
        head, length = struct.unpack("<II", source.read(8))
        if head != SKIPPABLE_IDS or length != (count - 1) * _ID.itemsize:
            raise ValueError("damaged id frame")
        self.ids = np.frombuffer(source.read(length), dtype=_ID)
        self.codec = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.ids)

    def doc_id(self, pos: int) -> int | None:
        return int(self.ids["id"][pos]) if self.ids["known"][pos] else None

    def read(self, pos: int) -> np.ndarray:
        """Ids of the document at ``pos``; fails if the frame is damaged."""
        self.source.seek(int(self.starts[pos]))
        raw = self.codec.decompress(self.source.read(int(self.entries["compressed"][pos])))
        if len(raw) != self.entries["size"][pos] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.entries["checksum"][pos]:
            raise ValueError(f"damaged frame {pos}")
        return np.frombuffer(raw, dtype="<u4")


def write_token_files(
    docs: DataFrame, encoder: Callable[[], Encoder], folder: str, shards: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Writes ``shards`` files of token ids below ``folder`` and returns their manifest, stored.

    Documents lie in ascending order of id, null ids first, equal ids by text; null text is empty and
    yields the end id only. Every row is written, repeated rows too. Empty shards have no file.

    ``folder`` is a URI that all executors reach. A task writes to a name of its own attempt and only
    the manifest names files, so files of failed or repeated attempts are never read. Compressed
    bytes leave the task frame by frame: it holds one document's ids and 24 bytes per document.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    )
    ordered = rows.repartitionByRange(shards, "_id").sortWithinPartitions("_id", "_text")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, sink, writer, first, tokens = encoder(), None, None, None, 0
        shard = TaskContext.get().partitionId()
        fs, root = pafs.FileSystem.from_uri(folder)
        path = f"shard-{shard:06d}-{uuid4().hex}.tok.zst"
        for part in slices(batches):
            if writer is None:
                fs.create_dir(root, recursive=True)
                sink = fs.open_output_stream(f"{root}/{path}", compression=None)
                writer, first = ShardWriter(sink), part["_id"][0]
            for doc_id, ids in zip(part["_id"], encode(part["_text"])):
                writer.add(doc_id, ids)
                tokens += len(ids)
        if writer is not None:
            writer.close()
            sink.close()
            row = [[shard], [path], [first], [len(writer.entries)], [tokens], [writer.written]]
            types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            names = ["shard", "path", "first_id", "docs", "tokens", "bytes"]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types)], names=names)

    # One row for each shard.
    return materialize(ordered.mapInArrow(write, MANIFEST).repartition(1), "token_manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, shard, pos, n_tokens, ids_crc32, start) of every document, from the files' frames.

    ``start`` counts the ids of all documents before it. One row per shard passes through one task to
    sum up the shards' lengths; documents are summed inside their shard.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for part in slices(batches):
            for shard, path, base in zip(part["shard"], part["path"], part["base"]):
                with fs.open_input_file(f"{root}/{path}") as source:
                    reader = ShardReader(source)
                    lengths = (reader.entries["size"][:-1] // 4).astype(np.int64)
                    starts = base + np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
                    for at in range(0, len(reader), 4096):
                        span = range(at, min(at + 4096, len(reader)))
                        found = [reader.read(i) for i in span]
                        columns = [
                            pa.array([reader.doc_id(i) for i in span], pa.int64()),
                            pa.array([shard] * len(span), pa.int32()),
                            pa.array(list(span), pa.int64()),
                            pa.array([len(x) for x in found], pa.int64()),
                            pa.array([zlib.crc32(x.tobytes()) for x in found], pa.int64()),
                            pa.array(starts[at : at + 4096].tolist(), pa.int64()),
                        ]
                        names = ["doc_id", "shard", "pos", "n_tokens", "ids_crc32", "start"]
                        yield pa.RecordBatch.from_arrays(columns, names=names)

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.select("shard", "path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    # Rows after the window lie in one partition. One task per shard, or for several small ones.
    shards, texts = manifest.agg(F.count("*"), F.coalesce(F.sum("docs"), F.lit(0))).first()
    spread = based.repartition(max(1, min(shards, -(-texts // TASK_TEXTS))))
    return spread.mapInArrow(read, INDEX + ", start long")


def read_documents(path: str, wanted: Iterable[int]) -> dict[int, np.ndarray]:
    """Ids of the wanted documents of one shard; other frames are not decompressed."""
    fs, name = pafs.FileSystem.from_uri(path)
    with fs.open_input_file(name) as source:
        reader = ShardReader(source)
        asked = np.array(sorted(set(wanted)), dtype=np.int64)
        hits = np.flatnonzero(np.isin(reader.ids["id"], asked) & (reader.ids["known"] == 1))
        return {reader.doc_id(i): reader.read(i) for i in map(int, hits)}


def token_files(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    shards: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str | None = None,
) -> DataFrame:
    """Writes the files and reads them back: (doc_id, start, n_tokens, ids_crc32, shard, pos).

    ``shards`` defaults to the session's number of shuffle partitions. See ``write_token_files`` for
    nulls, repeats and order; an empty table has no shards and no rows.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/tokens-{uuid4().hex}"
    if "://" not in folder and not folder.startswith("/"):
        folder = folder.replace("file:", "file://", 1)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    manifest = write_token_files(docs, word_encoder(tokenizer, end_id), folder, shards, id_col, text_col)
    index = read_token_files(manifest, folder)
    return index.select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "pos")
