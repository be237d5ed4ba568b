"""Operators on documents against brute force, with nulls, blanks, repeats, ties and odd columns."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from postlens.llm import common, line_dedup, mixing, ngram_join, token_counts, token_files, toxicity
from postlens.llm.queries import END_ID, tokenizer_path
from tokenizers import Tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, key string, copies string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
TEXTS = [
    (1, "The Same Long Line\nfirst of its kind here\n\nshort"),
    (2, "  the same long line \t\nsecond text of the table\nshort"),
    (3, "THE SAME LONG LINE\r\nThe same long line\nÄpfel und Birnen"),
    (4, "äpfel und birnen\nÄPFEL und Birnen"),
    (5, None),
    (6, ""),
    (7, " \n\t "),
    (8, LONG),
    (9, LONG + " tail"),
    (10, "a b c"),
    (11, "A  b\tC"),
    (12, "a b c d"),
    (None, "the same long line\nno id"),
    (13, "it's <|endoftext|> été café! 1234 don't--stop  x\x1cy Don'T ß İ \U0001f600\U0001f600"),
    (14, "stupid idiot women"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, f"s{(i or 0) % 4}" if i != 10 else None, 7, "x", "y", "z") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def by_id(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_line_dedup(docs, none):
    space = " \t\n\x0b\f\r"
    split = [(i, (t or "").split("\n")) for i, t in TEXTS]
    held = {}
    for i, lines in split:
        for line in lines:
            if len(lower(line.strip(space))) >= 10 and i is not None:
                held.setdefault(lower(line.strip(space)), set()).add(i)
    want = []
    for i, lines in split:
        gone = [len(held.get(lower(x.strip(space)), ())) > 1 and min(held[lower(x.strip(space))]) != i for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        want.append((i, len(lines), sum(gone), kept))
    got = by_id(line_dedup.dedup_lines(docs), "doc_id", "n_lines", "n_dropped", "kept_text")
    assert got == sorted(want, key=repr)
    assert line_dedup.dedup_lines(none).count() == 0


def test_line_dedup_repeated_rows_and_thresholds(spark):
    rows = [(1, "one line of text\nx"), (1, "one line of text\nx"), (2, "one line of text"), (3, "one line of text\ny")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(line_dedup.dedup_lines(df), "doc_id", "n_dropped", "kept_text")
    assert got == [(1, 0, "one line of text\nx"), (1, 0, "one line of text\nx"), (2, 1, ""), (3, 1, "y")]
    assert by_id(line_dedup.dedup_lines(df, min_docs=4), "doc_id", "n_dropped") == [(1, 0), (1, 0), (2, 0), (3, 0)]


def jaccard_groups(rows, k, percent):
    sets = []
    for i, text in rows:
        words = WORD.findall(lower(text or ""))
        width = max(1, len(words) - k + 1)
        sets.append((i, {tuple(words[j : j + k]) for j in range(width)} if words else set()))
    up = {i: i for i, _ in sets if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[a + 1 :]:
            if i is not None and j is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return sorted(((i, len(s), root(i) if i is not None else None) for i, s in sets), key=repr)


def test_ngram_groups_odd_rows(docs, none):
    got = by_id(ngram_join.ngram_groups(docs), "doc_id", "n_shingles", "component_id")
    assert got == jaccard_groups(TEXTS, 4, 85)
    assert ngram_join.ngram_groups(none).count() == 0


@pytest.mark.parametrize("sizes", [{}, {"block_shingles": 300, "hot_share": 1000, "cell_queries": 4, "cell_sets": 8}])
def test_ngram_groups_near_copies(spark, sizes):
    """Chains of near-copies, a passage that all share, and the borders of the similarity."""
    rng = np.random.default_rng(5)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = []
    for g in range(12):
        words = [f"w{x}" for x in rng.integers(0, 400, 60)]
        for c in range(9):
            rows.append((len(rows) * 3 % 997, " ".join(words) + " " + passage))
            words = list(words)
            words[int(rng.integers(0, 60))] = f"n{rng.integers(0, 10**6)}"
    rows += [(rows[0][0], "another text under a known id " + passage), (2000, rows[5][1]), (2001, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(ngram_join.ngram_groups(df, percent=80, **sizes), "doc_id", "n_shingles", "component_id")
    assert got == jaccard_groups(rows, 4, 80)


def test_t_occurrence_finds_all_links():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 40)).astype(np.uint64) for _ in range(80)]
    links = ngram_join.t_occurrence(sets, np.arange(80), 60)
    up = list(range(80))
    for a, b in links:
        x, y = up[a], up[b]
        up = [min(x, y) if v in (x, y) else v for v in up]
        assert 100 * len(np.intersect1d(sets[a], sets[b])) >= 60 * len(np.union1d(sets[a], sets[b]))
    for a in range(80):
        for b in range(a):
            if 100 * len(np.intersect1d(sets[a], sets[b])) >= 60 * len(np.union1d(sets[a], sets[b])):
                assert up[a] == up[b]


def test_token_files_equal_whole_texts(spark, docs, none, tmp_path):
    path = tokenizer_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    start, want = 0, []
    for i, text in sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [END_ID], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    for shards in (1, 5):
        got = token_files.token_files(docs, path, END_ID, shards=shards, folder=f"file://{tmp_path}/{shards}")
        assert by_id(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)
    assert token_files.token_files(none, path, END_ID).count() == 0


def test_token_file_reads_only_what_is_asked_and_sees_damage(tmp_path):
    path = tmp_path / "a.tok.zst"
    ids = [np.arange(n, dtype="<u4") for n in (5, 0, 70_000)]
    with path.open("wb") as sink:
        writer = token_files.ShardWriter(sink)
        for doc_id, x in zip((3, None, 9), ids):
            writer.add(doc_id, x)
        writer.close()
    found = token_files.read_documents(f"file://{path}", [9, 4])
    assert list(found) == [9] and np.array_equal(found[9], ids[2])
    data = bytearray(path.read_bytes())
    data[2] ^= 0xFF
    path.write_bytes(data)
    assert list(token_files.read_documents(f"file://{path}", [9])) == [9]
    with pytest.raises(Exception):
        token_files.read_documents(f"file://{path}", [3])
    path.write_bytes(data[:-3])
    with pytest.raises(ValueError):
        token_files.read_documents(f"file://{path}", [9])


def best_segmentation(word, scores, byte_score):
    best = [(0.0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        options = []
        for start in range(end):
            if word[start:end] in scores:
                options.append((best[start][0] + scores[word[start:end]], best[start][1] + 1))
        if word[end - 1] not in scores:
            width = len(word[end - 1].encode())
            options.append((best[end - 1][0] + byte_score * width, best[end - 1][1] + width))
        best[end] = max(options, key=lambda x: (x[0], -x[1]))
    return best[-1]


@pytest.mark.parametrize("most_nodes", [40, 1_000_000])
def test_token_counts(docs, none, most_nodes):
    path = tokenizer_path("piece_bpe_32k.model")

    def pieces():
        return token_counts.zipf_scores(token_counts.sentencepiece_pieces(path))

    scores = pieces()
    floor = min(scores.values()) - 1.0
    want = []
    for i, text in TEXTS:
        words = [w.decode() for w in (text or "").encode().lower().split()]
        found = [best_segmentation("▁" + w, scores, floor) for w in words]
        want.append((i, len(words), sum(n for _, n in found), round(math.fsum(s for s, _ in found), 6)))
    got = token_counts.count_tokens(docs, pieces, most_nodes=most_nodes).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_tokens, round(r.log_prob, 6)) for r in got), key=repr) == sorted(want, key=repr)
    assert token_counts.count_tokens(none, pieces).count() == 0


def level_by_rounds(sizes, weights, share, most):
    names = sorted(sizes, key=lambda x: (x is None, (x or "").encode()))
    weight = {x: weights[i % len(weights)] for i, x in enumerate(names)}
    target, free, rest = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while free and rest > 1e-9:
        total = sum(weight[x] for x in free)
        part = rest / total
        rest = 0.0
        for x in list(free):
            target[x] += part * weight[x]
            if target[x] >= most * sizes[x]:
                rest += target[x] - most * sizes[x]
                target[x] = most * sizes[x]
                free.discard(x)
    return target


def test_mix(spark, docs, none):
    rng = np.random.default_rng(3)
    rows = [(i, " w" * int(rng.integers(0, 40)), f"s{min(i % 9, 5)}" if i % 7 else None) for i in range(900)]
    rows += [(5, "a b", "s5"), (5, "a b", "s5"), (None, "x y z", "s1"), (None, None, "s1"), (901, "", "only blank")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = level_by_rounds(sizes, (5, 2, 1), 1.5, 2.0)
    got = mixing.mix_sources(df, bucket_rows=20, fan_in=3)
    found = got.collect()
    assert sorted(((r.doc_id, r.source, r.size) for r in found), key=repr) == sorted(
        ((i, s, len(WORD.findall(t or ""))) for i, t, s in rows), key=repr
    )
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for source in sizes:
        assert abs(taken[source] - want[source]) <= 20
    again = mixing.mix_sources(df.repartition(7), bucket_rows=20, fan_in=3)
    assert by_id(again, "doc_id", "source", "size", "copies") == by_id(got, "doc_id", "source", "size", "copies")
    assert mixing.mix_sources(none).count() == 0
    assert mixing.mix_sources(docs).count() == len(TEXTS)


def test_targets_with_small_first_sources(spark):
    """Later sources are full at a lower level than the first ones."""
    for sizes in ({"a": 10, "b": 1000, "c": 5, "d": 300}, {"a": 1000, "b": 2, "c": 900}, {"x": 0, "y": 0}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(df, (5, 2, 1), 1.5, 2.0).collect()}
        assert got == pytest.approx(level_by_rounds(sizes, (5, 2, 1), 1.5, 2.0))


def test_pivotal_keeps_mass_and_expectation():
    rng = np.random.default_rng(1)
    p, weight = rng.random(60), rng.integers(1, 50, 60).astype(float)
    sums = np.zeros(60)
    for _ in range(400):
        rounded, held = mixing.pivotal(p, weight, rng.random(60))
        assert ((rounded == 0) | (rounded == 1)).sum() >= 59
        assert (rounded * weight).sum() == pytest.approx((p * weight).sum())
        sums += rounded
    assert np.abs(sums / 400 - p).max() < 0.12


def test_word_count(spark):
    texts = ["", None, " ", "a", " a\t\nb  c\r", " ", "a b c"]
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    assert [r[0] for r in df.select(mixing.word_count(df.t)).collect()] == [len(WORD.findall(x or "")) for x in texts]


def sentences(rng, n, bad):
    plain = [f"word{i}" for i in range(300)]
    out = []
    for _ in range(n):
        words = list(rng.choice(plain, int(rng.integers(3, 60))))
        if bad:
            words.insert(int(rng.integers(0, len(words))), rng.choice(["vilest", "vileness", "Vile!"]))
        out.append(" ".join(words))
    return out


def test_toxicity(spark, docs, none):
    rng = np.random.default_rng(8)
    texts = [(i, t, int(i % 4 == 0)) for i, t in enumerate(x for k in range(800) for x in sentences(rng, 1, k % 4 == 0))]
    df = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in texts if i < 500] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(df, labels)
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(df, model).collect()}
    held = [(got[i], y) for i, _, y in texts if i >= 500]
    assert np.mean([a == b for a, b in held]) > 0.98
    odd = toxicity.score_toxicity(docs, model).collect()
    assert len(odd) == len(TEXTS) and all(0 <= r.score <= 1 for r in odd)
    assert len({r.score for r in odd if r.doc_id in (5, 6, 7)}) == 1
    assert toxicity.score_toxicity(none, model).count() == 0
    empty = toxicity.train_toxicity(none, labels)
    assert toxicity.score_toxicity(docs, empty).count() == len(TEXTS)


def test_swapped_terms_move_the_score_less():
    """Toxic training texts name one group more often; the penalty takes that away."""
    rng = np.random.default_rng(4)
    texts, labels = [], []
    for i in range(600):
        bad = i % 2 == 0
        group = "women" if rng.random() < (0.9 if bad else 0.1) else "men"
        texts.append((sentences(rng, 1, bad and rng.random() < 0.7)[0] + " " + group).encode())
        labels.append(int(bad))
    slots = [toxicity.text_features(x) for x in texts]
    twins = [toxicity.text_features(toxicity.swapped(x)) for x in texts]

    def gap(penalty):
        score = toxicity.fit_model(slots, labels, twins, swap_penalty=penalty).scorer()
        return abs(score(b"all women here") - score(b"all men here"))

    assert gap(50.0) < 0.1 < gap(0.0)
    plain = toxicity.fit_model(slots, labels, twins)
    assert plain.counterparts == sum(x is not None for x in twins) > 500
    score = plain.scorer()
    assert abs(score(b"all women here") - score(b"all men here")) < 0.05 * gap(0.0)
    assert score(b"all women here") < 0.7 and score(b"all men here") < 0.7
    assert toxicity.swapped(b"no such term") is None
    assert toxicity.swapped(b"The Women, and men.") == b"the men, and women."


def test_digests_and_words():
    assert common.words_of("A b Ç".encode()) == ["a b".encode(), "Ç".encode()]
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
    hashes = common.WordHashes()
    one = common.shingles(hashes.of([b"a", b"b", b"c"]), 4)
    assert len(one) == 1 and one[0] != common.shingles(hashes.of([b"a", b"b", b"c", b"d"]), 4)[0]
    assert len(common.shingles(hashes.of([]), 4)) == 0
