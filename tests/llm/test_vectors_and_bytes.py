"""Whitening, byte-level BPE and hard negatives against brute force, numpy and the library."""

import base64
import hashlib
import time

import numpy as np
import pytest
from postlens.llm import byte_bpe, hard_negatives, queries, whitening
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VECTORS = "vec_id long, embedding array<double>, label int, x string, id string, r string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], VECTORS)


def odd_vectors(seed, n, d, spread=1.0):
    """Vectors with copies, repeated and missing ids, short and broken ones, ties and null labels."""
    draw = np.random.default_rng(seed)
    base = draw.normal(scale=spread, size=(n, d)) * np.linspace(2, 0.5, d) if d else np.zeros((n, 0))
    rows = [(i, [float(v) for v in base[i]], int(draw.integers(3))) for i in range(n)]
    rows += [(n + i, rows[1][1], i % 3) for i in range(n // 2)]
    rows += [(5, rows[2][1], 1), (5, rows[3][1], 2), (5, rows[3][1], 2), (None, rows[4][1], 0), (None, rows[5][1], 1)]
    rows += [(900, None, 1), (901, [None] * d, 1), (902, [1.0, None], 1), (903, [float("nan")], 2), (904, [1.0, float("inf")], 0)]
    rows += [(910, [], 1), (911, [0.5], 2), (912, [-0.0] * d, 0), (913, rows[6][1], None), (1000, rows[7][1], 0)]
    return rows


def usable(rows):
    return [r for r in rows if r[1] is not None and all(v is not None and np.isfinite(v) for v in r[1])]


def whole(rows, d):
    return np.array([[int(np.floor(256 * v)) for v in r[1]] + [0] * (d - len(r[1])) for r in rows], dtype=object).reshape(len(rows), d)


def minres_by_matrix(a, shift, right, q):
    p = np.eye(len(a)) - q @ q.T
    return np.linalg.lstsq(p @ (a - shift * np.eye(len(a))) @ p, p @ right, rcond=None)[0]


def test_inner_solver_and_eigenpairs():
    draw = np.random.default_rng(1)
    for d in (1, 2, 5, 40, 150):
        half = draw.normal(size=(d, d + 3))
        a = half @ half.T
        values, vectors = np.linalg.eigh(a)
        found, columns = whitening.jacobi_davidson(lambda v: a @ v, d, 4, float(np.trace(a)))
        k = min(4, d)
        assert np.allclose(found, values[::-1][:k], rtol=1e-12)
        assert np.allclose(np.abs(columns.T @ vectors[:, ::-1][:, :k]), np.eye(k), atol=1e-9)
        assert np.linalg.norm(a @ columns - columns * found) < 1e-13 * np.trace(a)
    q = vectors[:, -1:]
    right = draw.normal(size=(d, 2))
    shifts = values[-1] * np.array([1.1, 1.3])
    got = whitening.minres(lambda v: a @ v, shifts, right, q, 400, 1e-12)
    want = np.column_stack([minres_by_matrix(a, s, right[:, i], q) for i, s in enumerate(shifts)])
    assert np.allclose(got, want, atol=1e-7 * np.abs(want).max())
    # Equal eigenvalues, and a matrix of lower rank.
    assert np.allclose(whitening.jacobi_davidson(lambda v: 3 * v, 30, 4, 90.0)[0], 3)
    thin = draw.normal(size=(30, 2))
    assert np.allclose(whitening.jacobi_davidson(lambda v: thin @ (thin.T @ v), 30, 4, float((thin**2).sum()))[0][2:], 0, atol=1e-12)


@pytest.mark.parametrize("d", [1, 6, 30])
def test_whitening_equals_dense(spark, d):
    rows = odd_vectors(3, 60, d)
    good = usable(rows)
    x = whole(good, d)
    fit = np.unique(x.astype(np.int64), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    z = fit - sums / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    k = min(4, d)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    want = (x.astype(float) - sums / n) @ vectors / np.sqrt(values)
    frame = vectors_of(spark, rows).withColumn("place", F.monotonically_increasing_id())
    got = whitening.whiten(frame, id_col="place").collect()
    assert len(got) == len(good) * k
    places = sorted({r.place for r in got})
    white = {(r.place, r.component): r for r in got}
    for c in range(k):
        column = np.array([white[p, c + 1].whitened for p in places])
        sign = np.sign(column @ want[:, c])
        assert np.allclose(column * sign, want[:, c], atol=1e-9)
    for i, p in enumerate(places):
        for c in range(1, k + 1):
            r = white[p, c]
            assert r.n == n and int(r.deviation) == sum(int(v) ** 2 for v in n * x[i] - sums.astype(object))
            assert abs(r.explained - values[c - 1] * n / (z**2).sum()) < 1e-9 and r.identity_error < 1e-9


def test_whitening_odd_tables(spark):
    def run(rows):
        return whitening.whiten(vectors_of(spark, rows)).collect()

    assert run([]) == [] and run([(1, None, 1), (2, [None], 1), (3, [], 0)]) == []
    assert run([(i, [1.0, 2.0], 1) for i in range(5)]) == []
    # Two distinct vectors span one dimension; ids may be missing or repeat.
    got = run([(None, [1.0, 2.0], 1), (7, [3.0, 2.0], 1), (7, [3.0, 2.0], 2)])
    assert sorted((str(r.vec_id), r.component, round(abs(r.whitened), 9)) for r in got) == [("7", 1, 1.0), ("7", 1, 1.0), ("None", 1, 1.0)]
    # Whole numbers too large for squares of long.
    big = run([(1, [2.0**40, 0.0], 1), (2, [0.0, 1.0], 1)])
    assert {int(r.deviation) for r in big} == {2**96 + 256**2}


def library(texts):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return [coder.encode_ordinary(t or "") for t in texts]


def encoded(spark, rows, **limits):
    docs = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, text string, block long, word string")
    ids = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, **limits)
    return byte_bpe.decode_documents(ids, byte_bpe.token_bytes(spark, RANKS))


TEXTS = [
    None, "", " ", "   \n\n\t  x  ", "Hello world's we'll  it's 'quoted' don't", "a" * 5000, "ab" * 3000, "é" * 999, "日本語のテキスト、です。 ",
    "mixed123 4567 x9y", "  wide　space\x1c\x1d\x85end", "emoji 👩‍👩‍👧 flags 🇩🇪🇫🇷", "<|endoftext|> is text", "İstanbul ŞİŞLİ ǅ ß",
    "new letters \U00016ea0\U00016ebb a\U00010ee7a \U000323b0\U00033000 ᲉꟋ꟎", "…—“quotes”", "\x00\x01\x7f", "x\r\ny\r\n\r\n z",
    "combining é ạ̈", "१२३ ४५ Ⅷ ½ ²", "the the the the", "the the the the",
]


def test_byte_bpe_equals_library(spark):
    rows = [(i % 15 if i % 7 else None, t) for i, t in enumerate(TEXTS)]
    want = sorted((str(d), ids, (t or "").encode()) for (d, t), ids in zip(rows, library(TEXTS)))
    for limits in ({}, {"block_docs": 3}, {"block_chars": 10}):
        got = encoded(spark, rows, **limits).collect()
        assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in got) == want
    assert encoded(spark, []).collect() == []


def test_every_code_point_is_cut_like_the_library():
    finder = byte_bpe.word_finder(public_tokenizers.PATTERN, *byte_bpe.library_pattern(public_tokenizers.PATTERN))
    ranks = dict(zip(*byte_bpe.token_table(RANKS)))
    points = [chr(c) for c in (*range(0x3400), *range(0xA000, 0xD800), *range(0xE000, 0x20000, 3), *range(0x32000, 0x34000, 5))]
    texts = [f"a{c}a 1{c}1 .{c}. {c} {c}{c}b" for c in points]
    for text, ids in zip(texts, library(texts)):
        assert [i for w in finder(text) for i in byte_bpe.merge_bytes(w.encode(), ranks)] == ids


def test_byte_bpe_of_long_words_and_bad_tables(spark):
    ranks = dict(zip(*byte_bpe.token_table(RANKS)))
    start = time.perf_counter()
    ids = byte_bpe.merge_bytes(b"abcde" * 100_000, ranks)
    assert time.perf_counter() - start < 20
    back = {v: k for k, v in ranks.items()}
    assert b"".join(back[i] for i in ids) == b"abcde" * 100_000
    tokens = byte_bpe.token_bytes(spark, RANKS)
    some = spark.createDataFrame([(1, np.array([3, 70_000], "<u4").tobytes()), (2, None)], "doc_id long, ids binary")
    assert byte_bpe.decode_documents(some.filter("doc_id = 2"), tokens).collect()[0].decoded is None
    with pytest.raises(Exception, match="not in the token-byte table"):
        byte_bpe.decode_documents(some, tokens).collect()
    with pytest.raises(ValueError, match="repeated"):
        byte_bpe.decode_documents(some, tokens.unionAll(tokens.limit(1)))


def test_byte_bpe_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in queries.read(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    got = queries.byte_bpe_query(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r, ids in zip(got, library([docs[r.doc_id] for r in got])):
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()


def negatives_by_force(rows, d, is_anchor, n_pos=5, n_neg=5):
    good = [r for r in usable(rows) if r[2] is not None]
    x = whole(good, d)
    out = []

    def order(i, score):
        return (-score, good[i][0] is None, good[i][0] or 0)

    for a, row in enumerate(good):
        if not is_anchor(row[0]):
            continue
        scores = [int(x[a] @ x[i]) for i in range(len(good))]
        same = sorted((i for i in range(len(good)) if i != a and good[i][2] == row[2]), key=lambda i: order(i, scores[i]))
        for p in same[:n_pos]:
            fits = [i for i in range(len(good)) if good[i][2] != row[2] and 80 * scores[p] <= 100 * scores[i] <= 100 * scores[p]]
            for rank, i in enumerate(sorted(fits, key=lambda i: order(i, scores[i]))[:n_neg]):
                out.append((row[0], good[p][0], rank + 1, good[i][0], scores[p], scores[i]))
    return sorted(out, key=str)


@pytest.mark.parametrize(
    "d, limits",
    [
        (6, {}),
        (6, {"cell_rows": 4, "part_rows": 3, "first_rows": 5, "growth": 2, "salt_rows": 3}),
        (1, {"cell_rows": 8}),
        (9, {"cell_rows": 2, "sample": 20, "max_centres": 3, "first_rows": 1}),
    ],
)
def test_hard_negatives_equal_brute_force(spark, d, limits):
    rows = odd_vectors(d, 50, d)
    found = hard_negatives.mine_hard_negatives(vectors_of(spark, rows), F.col("vec_id") % 10 == 0, **limits)
    assert sorted(map(tuple, found.collect()), key=str) == negatives_by_force(rows, d, lambda i: i is not None and i % 10 == 0)


def test_hard_negatives_odd_tables(spark):
    def run(rows, anchors=F.lit(True)):
        return sorted(map(tuple, hard_negatives.mine_hard_negatives(vectors_of(spark, rows), anchors).collect()), key=str)

    assert run([]) == [] and run([(1, None, 1), (2, [1.0], None)]) == [] and run([(1, [1.0], 1)], F.lit(False)) == []
    assert run([(0, [1.0], 1), (1, [1.0], 1), (2, [-1.0], 2)]) == []
    assert run([(None, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)], F.col("vec_id").isNull()) == [(None, 1, 1, 2, 65536, 58880)]


def test_walk_visits_all_cells_in_order():
    draw = np.random.default_rng(0)
    first, second = draw.integers(-9, 9, 7), draw.integers(-9, 9, 5)
    seen = list(hard_negatives.walk(first, second))
    assert [s for s, _, _ in seen] == sorted((int(a + b) for a in first for b in second), reverse=True)
    assert {(i, j) for _, i, j in seen} == {(i, j) for i in range(7) for j in range(5)}
