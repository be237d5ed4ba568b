"""Repeated and missing ids, very long words and odd spellings, where they once gave wrong results."""

import re

import numpy as np
from postlens.llm import common, embedding_dedup, ngram_join, queries, token_counts, token_files

import corpus_pipeline

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components(nodes, links):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if (root[a], root[b]) != (low, low):
                root[a] = root[b] = low
                changed = True
    return root


def shingle_sets(rows, k):
    out = []
    for _, text in rows:
        words = [w.lower() for w in WORD.findall(text or "")]
        n = min(k, len(words))
        out.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    return out


def test_ngram_links_of_ids_with_several_texts(spark):
    draw = np.random.default_rng(2)
    base = [" ".join(draw.choice([f"w{i}" for i in range(400)], 40)) for _ in range(6)]
    near = [f"{b} zz" for b in base]
    rows = [(1, base[0]), (1, base[1]), (2, near[0]), (3, near[1]), (1, base[0]), (4, base[2]), (4, base[3]), (5, near[2]), (6, near[3])]
    rows += [(5, base[4]), (7, base[4]), (8, "a b"), (8, "a b"), (9, "A  B"), (10, ""), (10, None), (11, None), (None, base[0]), (None, "")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, class long, rep string")
    sets = shingle_sets(rows, 4)
    nodes = {i for i, _ in rows if i is not None}
    links = [
        (rows[a][0], rows[b][0])
        for a in range(len(rows)) for b in range(len(rows))
        if None not in (rows[a][0], rows[b][0]) and sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    root = components(nodes, links)
    want = sorted(((i, len(s), root.get(i)) for (i, _), s in zip(rows, sets)), key=str)
    for sizes in ({}, {"cell_queries": 2, "cell_sets": 3, "block_shingles": 50}, {"cell_shingles": 40}):
        got = ngram_join.ngram_groups(df, k=4, percent=85, **sizes).collect()
        assert sorted(map(tuple, got), key=str) == want
    assert root[2] == root[3] == 1 and root[7] == root[6] == 4


def test_embedding_links_of_ids_with_several_vectors(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(5, 12))

    def near(i):
        return [float(x) for x in base[i] + draw.normal(scale=0.02, size=12)]

    rows = [(1, [float(x) for x in base[0]]), (1, [float(x) for x in base[1]]), (2, near(0)), (3, near(1)), (4, near(1)), (4, near(1))]
    rows += [(5, near(2)), (5, near(2)), (6, near(3)), (7, near(4)), (8, near(4)), (1, near(0)), (9, rows[0][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rep long")
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = (x @ x.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    root = components({i for i, _ in rows}, [(rows[a][0], rows[b][0]) for a, b in zip(*np.nonzero(linked))])
    want = sorted((i, int(linked[at].sum()), root[i], root[i] == i) for at, (i, _) in enumerate(rows))
    for sizes in ({}, {"cell_rows": 3, "query_rows": 2, "index_rows": 3}):
        assert sorted(map(tuple, embedding_dedup.embedding_groups(df, **sizes).collect())) == want


def test_token_ids_of_special_tokens_in_any_case(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["<|EndOfText|> x", "a<|STARTOFTEXT|>b", "<|endoftext|> <|startoftext|>", "A <| B |> c", "<|ENDOFTEXT|><|endoftext|>", "Plain TEXT"]
    encode = token_files.word_encoder(path, 2)()
    for text, ids in zip(texts, encode(texts)):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]


def test_token_counts_of_very_long_words():
    pieces = {"▁": -2.0, "a": -1.5, "b": -1.7, "ab": -2.1, "aba": -2.9, "▁a": -1.9}
    draw = np.random.default_rng(4)
    words = ["▁" + "".join(draw.choice(list("abcé"), int(n))) for n in (1, 5, 30, 200, 999)]
    wide, narrow = token_counts.Trie(pieces, -9.0), token_counts.Trie(pieces, -9.0, most_nodes=40)
    for word in words * 2:
        assert narrow.insert(word) == wide.insert(word)
        assert len(narrow.tokens) <= 41
    small = token_counts.Trie(pieces, -9.0, most_nodes=1000)
    assert small.insert("▁" + "ab" * 500_000)[1] > 0 and len(small.tokens) == 1


def test_long_words_are_not_remembered():
    hashes = common.WordHashes()
    hashes.of([b"x" * 1000, b"short"])
    assert list(hashes) == [b"short"]


def test_pipeline_keeps_one_row_of_each_group(spark, sf_dir):
    draw = np.random.default_rng(5)
    a, b, c = (" ".join(draw.choice([f"w{i}" for i in range(300)], 60)) for _ in range(3))
    rows = [(None, a), (None, a), (7, b), (7, b), (8, b), (9, c), (None, c + " zz"), (3, None), (3, None), (4, ""), (5, "x"), (7, "y z")]
    df = spark.createDataFrame([(*r, "s", 1, 2) for r in rows], "doc_id long, text string, source string, _row int, component_id int")
    got = corpus_pipeline.keep_one_of_each_group(spark, df, sf_dir)
    assert got.columns == df.columns
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted(
        [(None, a), (7, b), (9, c), (3, None), (3, None), (4, ""), (5, "x"), (7, "y z")], key=str
    )
    empty = df.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty.drop("_row", "component_id"), sf_dir)
        assert (name, out.count(), out.columns) == (name, 0, ["doc_id", "text", "source"])
