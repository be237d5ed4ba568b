"""Pages, urls, vectors, benchmark items and the pipeline against brute force and fixtures."""

import html
import re
import unicodedata

import duckdb
import numpy as np
import pytest
from postlens.llm import decontaminate, embedding_dedup, html_extract, queries, url_filter
from postlens.llm.components import connected_components
from pyspark.sql import functions as F

import corpus_pipeline

PAGES = "page_id long, url string, html string, _id string, host string, text string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], PAGES)


def fits(host, path, pattern):
    domain, _, rest = pattern.partition("/")
    return (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest)


def test_url_rules_and_templates(spark):
    odd = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x", "http://example.net", "ftp://x.org/fr/?q#f",
           "http://fr.org/fr/a", "http://org/fr/", "http://notexample.com/de/1", "http://m.example.com/de/1#x", "a://b://c/d",
           "http://h.com/" + "a/" * 50]
    learned = [f"http://site.com/{'spam' if i % 2 else 'news'}/{i}.html" for i in range(120)]
    rows = [(i, u, None) for i, u in enumerate(odd + learned)] + [(0, None, None), (None, "http://site.com/spam/x", None)]
    labels = [(i, i >= len(odd) and (i - len(odd)) % 2 == 1) for i in range(len(odd), len(rows) - 20)] + [(None, True), (7, None)]
    labels = spark.createDataFrame(labels, "doc_id long, bad boolean")
    got = url_filter.judge_urls(pages_of(spark, rows), labels, queries.RULES).collect()
    assert len(got) == len(rows)
    urls = {i: u for i, u, _ in rows}
    for r in got:
        rest = (urls[r.page_id] or "").partition("://")[2]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        hits = [x for x in queries.RULES if fits(host, path, x.pattern)]
        best = max(hits, key=lambda x: len(x.pattern), default=None)
        assert (r.host, r.path, r.rule) == (host, path, best and best.pattern)
        if best:
            assert r.verdict == best.verdict
        elif host == "site.com":
            assert r.verdict == ("block" if "/spam/" in path else "allow") and r.template.endswith("/*")
        else:
            assert r.verdict == "allow"
    none = pages_of(spark, [])
    assert url_filter.judge_urls(none, labels, queries.RULES).count() == 0
    assert url_filter.judge_urls(pages_of(spark, rows), labels.limit(0), queries.RULES).filter("rule is null and verdict='block'").count() == 0


def test_alike_branches_are_merged(spark):
    rows = [(i, f"http://one.com/{'abc'[i % 3]}/{i}", None) for i in range(300)]
    labels = spark.createDataFrame([(i, i % 10 < 6) for i in range(300)], "doc_id long, bad boolean")
    got = url_filter.judge_urls(pages_of(spark, rows), labels, ()).collect()
    assert len({r.bad_share for r in got}) == 1 and {r.template for r in got} == {"/a/*", "/b/*", "/c/*"}


@pytest.mark.parametrize("sections", [24, 40])
def test_bad_section_among_many(spark, sections):
    """Also below eight segments, and where rare children lie beside it."""
    names = ["spam", *(f"s{i}" for i in range(1, sections))]
    rows = [(i, f"http://big.com/{names[i % sections]}/{i}", None) for i in range(40 * sections)]
    deep = "http://deep.com/" + "d/" * 9
    rows += [(10_000 + i, deep + f"{names[i % 2]}/{i}", None) for i in range(80)]
    rows += [(20_000 + i, f"http://deep.com/{'d/' * 12}once/{'e/' * 9}", None) for i in range(2)]
    rows += [(30_000 + i, f"http://big.com/rare{i}/{i}", None) for i in range(30)]
    labels = spark.createDataFrame([(i, "/spam/" in u) for i, u, _ in rows], "doc_id long, bad boolean")
    got = url_filter.judge_urls(pages_of(spark, rows), labels, ()).collect()
    urls = {i: u for i, u, _ in rows}
    assert len(got) == len(rows)
    assert all(r.verdict == ("block" if "/spam/" in urls[r.page_id] else "allow") for r in got)
    template = {r.page_id: r.template for r in got}
    assert template[0] == "/spam/*" and template[1] == "/s1/*" and template[30_000] == "/*/*"
    assert template[10_000] == "/d" * 9 + "/spam/*" and template[20_000] == "/d" * 12 + "/once" + "/e" * 9


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
<div class="cookie-notice">We use cookies</div><header><h2>Site</h2></header><nav><ul><li><a href=x>One</a></li></ul></nav>
<aside>Side</aside><article><h1>Title {n} &amp; more</h1><p><b>First   line
{n}.<br>still<p>Second&nbsp;one &lt;{n}&gt;</p><div class="share">Share!</div><form>Mail <input></form><blockquote>Quoted {n}</blockquote>
<section class="comments"><p>Nice read</p></section></article><footer>&copy; Site</footer></body></html>"""


def test_main_text_of_one_page():
    text = html_extract.main_text(html_extract.parse(PAGE.format(n=1)))
    assert text == "Title 1 & more\n\nFirst line 1. still\n\nSecond one <1>\n\nQuoted 1"
    assert html_extract.main_text(html_extract.parse(None)) == ""
    assert html_extract.main_text(html_extract.parse("just text")) == "just text"
    assert html_extract.main_text(html_extract.parse("<nav>menu</nav>")) == ""
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    assert html_extract.main_text(html_extract.parse(deep)) == "deep"
    lists = "<body><ul><li>a<li>b<ul><li>c</ul>d</ul><table><tr><td>e<td>f</table></body>"
    assert html_extract.main_text(html_extract.parse(lists)).split("\n\n") == ["a", "b", "c", "d", "e", "f"]
    assert html_extract.main_text(html_extract.parse("<p>a<script>x</script>b</p>")) == "ab"


def test_site_style_tree_cuts_what_all_pages_share(spark):
    """Unnamed blocks: only the tree can tell the slogan from the text."""
    body = "<body><div><div id=x1><p>Buy our things today</p></div><div id=x2><p>Own text {n} of page</p></div></div></body>"
    rows = [(i, f"http://a.com/{i}", body.format(n=i)) for i in range(40)]
    rows += [(100 + i, f"http://b.com/{i}", "<body><p>Same everywhere</p></body>") for i in range(30)]
    rows += [(200, "http://c.com/", PAGE.format(n=3)), (201, None, None), (201, None, None), (None, "x", "<p>y</p>")]
    got = html_extract.extract_pages(pages_of(spark, rows), group_pages=7).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    text = {r.page_id: r.text for r in got}
    assert all(text[i] == f"Own text {i} of page" for i in range(40))
    assert all(text[100 + i] == "Same everywhere" for i in range(30))
    assert text[200].startswith("Title 3 & more") and text[201] == "" and text[None] == "y"
    assert html_extract.extract_pages(pages_of(spark, [])).count() == 0


def test_copies_and_noise_do_not_cut_articles(spark):
    page = "<body><div class=ad><p>Advert {ad}</p></div><header><p>{ad}</p></header>{text}<footer>{ad}</footer></body>"
    article = "<article><h1>Title {n}</h1><p>Text {n}</p><div class=ad>Buy {ad}</div></article>"
    want, rows = {}, []

    def add(host, text, ad, expected):
        want[len(rows)] = expected
        rows.append((len(rows), f"http://{host}/{len(rows)}", page.format(text=text, ad=ad)))

    for i in range(40):
        add("one.com", article.format(n="one", ad=i), i, "Title one\n\nText one")
        add("plain.com", "<p>Same everywhere</p>", i, "Same everywhere")
        add("side.com", article.format(n="one", ad=i) + f"<div id=x><p>{i}</p></div>", i, "Title one\n\nText one")
        add("mixed.com", f"<div>Own text {i}<div class=ad>{i}</div></div><p>Slogan</p>", i, f"Own text {i}")
    for i in range(600):
        n = i if i < 30 else "copy"
        add("copies.com", article.format(n=n, ad=i), i, f"Title {n}\n\nText {n}")
    got = {r.page_id: r.text for r in html_extract.extract_pages(pages_of(spark, rows), group_pages=70).collect()}
    assert got == want


def test_weak_paths_leave_a_marked_article():
    root = html_extract.parse("<body><div><article><p class=x>Note</p><p>Text</p></article></div><p>Other</p></body>")
    paths = {"/body", "/body/div", "/body/div/article"}
    assert html_extract.main_text(root, frozenset(paths)) == "Note\n\nText"
    assert html_extract.main_text(root, frozenset(paths | {"/body/div/article/p.x"})) == "Text"
    assert html_extract.main_text(root, frozenset(paths | {"/body/div/article/p.x", "/body/div/article/p"})) == "Note\n\nText"


def test_pages_of_the_tables(spark, sf_dir):
    pages = queries.read(spark, sf_dir, "pages")
    got = {r.page_id: r.text for r in html_extract.extract_pages(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)(</article>|<footer)", r.html, re.S).group(1)
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside))
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


def brute_links(vectors, cosine):
    unit = {k: [x / np.linalg.norm(x) for x in v] for k, v in vectors.items()}
    names = [(k, i) for k, v in unit.items() for i in range(len(v))]
    links = {n: set() for n in names}
    for a in names:
        for b in names:
            x, y = unit[a[0]][a[1]], unit[b[0]][b[1]]
            if a != b and len(x) == len(y) and x @ y >= cosine:
                links[a].add(b)
    return links


@pytest.mark.parametrize("sizes", [{}, {"cell_rows": 20, "query_rows": 8, "index_rows": 16, "sample": 64}])
def test_embedding_groups(spark, sizes):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((25, 12))
    rows = [(i, (centres[i % 25] + rng.standard_normal(12) * 0.12 * (i % 4)).tolist()) for i in range(220)]
    rows += [(1000 + i, rows[4][1]) for i in range(15)] + [(2000, (np.array(rows[4][1]) * 7).tolist())]
    rows += [(3000, [1.0, 2.0]), (3001, [2.0, 4.0])]
    good = {}
    for i, v in rows:
        good.setdefault(i, []).append(np.array(v))
    bad = [(5000, None), (5001, []), (5002, [0.0] * 12), (5003, [1.0, None] * 6), (5004, [float("nan")] * 12),
           (5005, [float("inf")] + [1.0] * 11), (None, rows[4][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows + bad], "vec_id long, embedding array<double>, rep string")
    links = brute_links(good, 0.95)
    component = {n: n[0] for n in links}
    changed = True
    while changed:
        new = {n: min([component[n], *(component[m] for m in links[n])]) for n in links}
        changed, component = new != component, new
    got = {r.vec_id: r for r in embedding_dedup.embedding_groups(df, **sizes).collect()}
    assert len(got) == len(rows) + len(bad)
    for (i, _), linked in links.items():
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(linked), component[i, 0], component[i, 0] == i)
    for i, _ in bad:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert embedding_dedup.embedding_groups(df.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (None, 3), (200, 159), (60, 41), (60, 5)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in [*range(42), 60]}, **{i: 100 for i in [*range(100, 160), 200]}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_decontamination(spark):
    rng = np.random.default_rng(9)
    word = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(word, int(rng.integers(15, 60)))) + ". " + " ".join(rng.choice(word, 4))) for i in range(30)]
    items += [(30, " ".join(rng.choice(word, 130))), (31, None), (32, ""), (33, "!!!"), (None, "w1 w2 w3")]
    docs, want = [], set()
    for d in range(400):
        words = list(rng.choice(word, int(rng.integers(1, 300)))) + ["w1"] * (d % 50)
        if d % 8 == 0:
            item, text = items[d // 8 % 31]
            leak = text.upper().split() if d % 16 else text.split()
            if d % 24 == 0:  # reworded: a few words differ, the answer stays
                leak = [x if i % 6 or i > len(leak) - 5 else "other" for i, x in enumerate(leak)]
            at = int(rng.integers(0, len(words)))
            words[at:at] = leak
            want.add((d, item))
        docs.append((d, " ".join(words)))
    docs += [(900, None), (901, ""), (None, items[3][1]), (902, items[5][1]), (902, items[5][1])]
    df = spark.createDataFrame([(*r, 1.0) for r in docs], "doc_id long, text string, cosine double")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()]
    assert set(got) == want | {(None, 3), (902, 5)} and got.count((902, 5)) == 2
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(df.limit(0), bench).count() == 0


def test_pieces_hold_every_passage_once():
    rng = np.random.default_rng(3)
    docs = []
    for n in (0, 1, 23, 24, 25, 48, 49, 500, 96, 97, 120, 3):
        columns = rng.integers(-10, 30, n)
        docs.append(decontaminate._Doc(n, columns[columns >= 0], np.flatnonzero(columns >= 0)))
    weighted = rng.standard_normal((30, 4)).astype(np.float32)
    whole = decontaminate._Halves(docs, [(i, 0, x.words) for i, x in enumerate(docs)], 24)
    made, around = np.zeros(4), np.zeros((30, 4))
    common = np.array([3, 7, 8, 29])
    for pieces in decontaminate._pieces(docs, 24, limit=50):
        assert sum(size for _, _, size in pieces) <= 50 + 24
        halves = decontaminate._Halves(docs, pieces, 24)
        made += halves.passages(weighted, common).sum(axis=0)
        halves.columns_times(halves.around(halves.passages(weighted)), around, common)
    expected = np.zeros((30, 4))
    np.add.at(expected, whole.columns, whole.around(whole.passages(weighted))[whole.segment])
    assert np.allclose(made, whole.passages(weighted).sum(axis=0), atol=1e-3) and np.allclose(around, expected, atol=1e-3)


def test_stripes_are_summed_level_by_level(spark):
    parts = [(s, p, np.array([s + p / 8, 1.0]).tobytes()) for s in range(2) for p in range(75)]
    got = decontaminate._sum_stripes(spark.createDataFrame(parts, decontaminate._STRIPES), fan=4).collect()
    sums = {r.stripe: np.frombuffer(r.data).tolist() for r in got}
    assert len(got) == 2 and sums == {s: [75 * s + 75 * 37 / 8, 75.0] for s in range(2)}
    assert decontaminate._sum_stripes(spark.createDataFrame([], decontaminate._STRIPES)).count() == 0


def test_contaminated_equals_comparing_all(spark):
    """Against the longest common subsequence of every document's passages with every item."""
    rng = np.random.default_rng(21)
    word = [f"v{i}" for i in range(800)]
    items = [(i, " ".join(rng.choice(word, int(rng.integers(20, 48))))) for i in range(25)]
    docs = []
    for d in range(150):
        words = list(rng.choice(word, int(rng.integers(5, 200))))
        leak = items[d % 25][1].split()
        if d % 3 == 0:  # from all of the item to half of it, words left out at random
            keep = rng.random(len(leak)) < rng.choice([1.0, 0.9, 0.8, 0.7, 0.5])
            at = int(rng.integers(0, len(words)))
            words[at:at] = [w for w, k in zip(leak, keep) if k]
        docs.append((d, " ".join(words)))
    want = set()
    for d, text in docs:
        words, half = decontaminate.plain_words(text.encode()), 24
        for i, item in items:
            part = tuple(decontaminate.plain_words(item.encode()))
            answer = part if len(part) <= 0.75 * len(part) else part[-max(1, len(part) // 4) :]
            for start in range(0, max(1, len(words) - half), half):
                around = words[max(0, start - half) : start + 3 * half]
                ratio = decontaminate.common_length(part, around) / len(part)
                told = decontaminate.common_length(answer, around) == len(answer)
                if ratio >= 0.75 or (ratio >= 0.6 and told):
                    want.add((d, i))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()}
    # The candidate search is approximate, the comparison exact.
    assert got <= want and len(got) >= 0.9 * len(want) and len(want) > 20


def test_answer_decides_on_reworded_passages(spark):
    rng = np.random.default_rng(10)
    words = [f"w{i}" for i in range(40)]
    filler = [(i, " ".join(rng.choice([f"f{i}" for i in range(500)], 100))) for i in range(60)]
    changed = [w if i % 3 else "other" for i, w in enumerate(words)]
    docs = filler + [(100, " ".join(changed)), (101, " ".join(changed) + " forty two")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words), "Forty two")], "item_id long, text string, answer string")
    got = decontaminate.contaminated(df, bench, item_answer="answer").collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(101, 1)]


def test_excerpts_of_long_items_and_items_of_one_sentence(spark):
    rng = np.random.default_rng(12)
    word = [f"w{i}" for i in range(3000)]
    long, middle, single = (list(rng.choice(word, n, replace=False)) for n in (130, 66, 30))
    filler = [(10_000 + i, " ".join(rng.choice(word, 150))) for i in range(1000)]
    docs = [(1000 + at, long[at : at + n]) for at, n in ((12, 70), (14, 60), (0, 48), (82, 48), (36, 48), (60, 70))]
    docs += [(2000, middle[20:]), (2001, middle[:48]), (2002, middle[9:57])]
    # Two of three words stay, with the last ones in 3000 only.
    docs += [(3000, [x if i % 3 or i > 22 else "other" for i, x in enumerate(single)])]
    docs += [(3001, [x if i % 3 != 2 else "other" for i, x in enumerate(single)])]
    before = " ".join(rng.choice(word, 17))
    df = spark.createDataFrame(filler + [(i, f"{before} {' '.join(x)} {before}") for i, x in docs], "doc_id long, text string")
    bench = [(1, " ".join(long)), (2, " ".join(middle)), (3, " ".join(single) + ".")]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, spark.createDataFrame(bench, "item_id long, text string")).collect()}
    assert got == {(i, i // 1000) for i, _ in docs if i != 3001}
    items = decontaminate._items([(1, "A b c d e f g h. I", None), (2, "A b c d e f g h.", None), (3, "A b c d", "A b c d")], 48, 0.75)
    assert [x.answer for x in items] == [(b"i",), (b"g", b"h"), (b"a", b"b", b"c", b"d")]


def test_case_of_accented_words(spark):
    text = "ciónmiírr éenaitreoiaux ñezll straße œuvre ångström σοφός привет ýta ñasquera dość größe"
    decomposed = unicodedata.normalize("NFD", text.upper())
    docs = [(1, text.upper()), (2, decomposed), (3, text.title()), (4, "ÉENAITREOIAUX autre chose"), (5, text)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for item in (text, text.upper(), decomposed):
        bench = spark.createDataFrame([(1, item, "DOŚĆ größe")], "item_id long, text string, answer string")
        got = decontaminate.contaminated(df, bench, item_answer="answer").collect()
        assert sorted((r.doc_id, r.common) for r in got) == [(1, 1.0), (2, 1.0), (3, 1.0), (5, 1.0)]
    odd = [None, b"", b"\xff\xc3 A\xff", "a\u037e \u037e É.".encode()]
    assert [decontaminate.plain_words(x) for x in odd] == [[], [], [b"\xff\xc3", b"a\xff"], [b"a", "é".encode()]]


def test_common_length():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (list(map(bytes, rng.integers(0, 5, (int(rng.integers(1, 30)), 1), dtype=np.uint8))) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontaminate.common_length(tuple(a), b) == table[-1, -1]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    answer = connection.execute(queries.ORACLES[name])
    columns = [x[0] for x in answer.description]
    got = queries.QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(answer.fetchall())


def test_pipeline_stages(spark, sf_dir):
    """Each stage does its work on what it gets, odd rows and columns included."""
    docs = queries.read(spark, sf_dir, "documents").withColumn("copies", F.lit("x")).withColumn("score", F.lit(1))
    columns = docs.columns
    bench = queries.read(spark, sf_dir, "benchmark").orderBy("item_id").first()
    odd = [(90001, None, "en", None, 0), (None, "", "en", "s", 0), (90002, bench.text, "en", "s", 0), (90003, "stupid moron idiot scum trash", "en", "s", 5)]
    extra = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.unionByName(extra.withColumn("copies", F.lit("y")).withColumn("score", F.lit(2)))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, sf_dir)
        if name != "token_files":
            assert made.columns == columns
            docs = corpus_pipeline.materialize(made, "test_stage")
            kept[name] = [r.doc_id for r in docs.collect()]
    assert 90003 not in kept["toxicity"] and {90001, None, 90002} <= set(kept["toxicity"])
    assert len(kept["ngram_join"]) == len(set(kept["ngram_join"])) < len(kept["toxicity"])
    assert 90002 in kept["ngram_join"] and 90002 not in kept["decontamination"]
    assert max(map(kept["source_mix"].count, set(kept["source_mix"]))) == 2
    index = made.collect()
    assert sorted((r.doc_id for r in index), key=repr) == sorted(kept["source_mix"], key=repr)
    rows = sorted(index, key=lambda r: r.start)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
