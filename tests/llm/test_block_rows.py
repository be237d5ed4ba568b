"""Blocks of the byte-level BPE are stored and answered in small rows, and a task remembers few words."""

import types

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyspark

from postlens.llm import byte_bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = ["a few words in a text", None, "words, words and words", "", "x" * 50, "one more text of a few words"] * 3


def parts(monkeypatch, block_chars, row_chars):
    context = types.SimpleNamespace(partitionId=lambda: 1)
    monkeypatch.setattr(pyspark.TaskContext, "get", staticmethod(lambda: context))
    patterns = (public_tokenizers.PATTERN, *byte_bpe.library_pattern(public_tokenizers.PATTERN))
    rows = pa.record_batch({"doc_id": pa.array(range(len(TEXTS)), pa.int64()), "text": pa.array(TEXTS)})
    blocks = pa.Table.from_batches(byte_bpe._blocks(patterns, block_chars, 1000, row_chars)([rows]))
    words = blocks.filter(blocks.column("dictionary").is_valid()).select(["block", "dictionary"])
    pieces = pa.Table.from_batches(byte_bpe._shards(3)(words.to_batches())).sort_by("shard")
    table = types.SimpleNamespace(value=byte_bpe.token_table(RANKS))
    return blocks, pieces, pa.Table.from_batches(byte_bpe._encoder(table)(pieces.to_batches()))


def ids_by_word(text):
    ranks = dict(zip(*byte_bpe.token_table(RANKS)))
    finder = byte_bpe.word_finder(public_tokenizers.PATTERN, *byte_bpe.library_pattern(public_tokenizers.PATTERN))
    return [i for w in finder(text or "") for i in byte_bpe.merge_bytes(w.encode(), ranks)]


def test_rows_of_a_block_are_small_and_put_together(monkeypatch):
    blocks, _, ids = parts(monkeypatch, 10_000, 60)
    assert len(set(blocks.column("block").to_pylist())) == 1
    for docs in blocks.column("doc_ids").to_pylist():
        assert len(docs) == 1 or sum(len(TEXTS[d] or "") for d in docs) <= 60
    assert blocks.column("dictionary").null_count == blocks.num_rows - 1
    got = byte_bpe._assemble(blocks, ids)
    # One batch for each stored row.
    assert len(got.to_batches()) == blocks.num_rows > 5
    found = dict(zip(got.column("doc_id").to_pylist(), got.column("ids").to_pylist()))
    assert {d: np.frombuffer(x, "<u4").tolist() for d, x in found.items()} == {d: ids_by_word(t) for d, t in enumerate(TEXTS)}


def test_few_words_are_remembered(monkeypatch):
    made, merge = [], byte_bpe.merge_bytes
    monkeypatch.setattr(byte_bpe, "merge_bytes", lambda word, ranks: made.append(word) or merge(word, ranks))
    _, pieces, ids = parts(monkeypatch, 30, 30)
    once = len(made)
    assert once == len(set(made))
    made.clear()
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 0)
    _, _, again = parts(monkeypatch, 30, 30)
    assert len(made) > once and again.equals(ids)


def test_batches_are_decoded_a_few_rows_at_a_time():
    tokens, ids = byte_bpe.token_table(RANKS)
    rows = pa.record_batch({"ids": pa.array([np.array([ids[5]], "<u4").tobytes()] * 600 + [None], pa.binary())})
    out = list(byte_bpe._decoder(types.SimpleNamespace(value=(tokens, ids)))([rows]))
    assert [b.num_rows for b in out] == [256, 256, 89]
    assert pa.Table.from_batches(out).column("decoded").to_pylist() == [tokens[5]] * 600 + [None]
