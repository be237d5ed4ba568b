"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe,
    decontaminate,
    embedding_dedup,
    hard_negatives,
    html_extract,
    line_dedup,
    mixing,
    ngram_join,
    token_counts,
    token_files,
    toxicity,
    url_filter,
    whitening,
)

RULES = (
    url_filter.Rule("block", "net/"),
    url_filter.Rule("allow", "example.net/en/"),
    url_filter.Rule("block", "example.com/de/"),
    url_filter.Rule("allow", "org/fr/"),
)
TOKENIZERS = "/opt/tokenizers"
END_ID = 2


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Texts are long: a Python worker should get few of them at a time.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str, folder: str = TOKENIZERS) -> str:
    """A vocabulary file of the public tokenizers' folder."""
    return str(Path(folder) / name)


def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def ngram_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_groups(read(spark, sf_dir, "documents"), k=4, percent=85)


def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("piece_bpe_32k.model")

    def scores() -> dict[str, float]:
        return token_counts.zipf_scores(token_counts.sentencepiece_pieces(path))

    return token_counts.count_tokens(read(spark, sf_dir, "documents"), scores)


def embedding_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_groups(read(spark, sf_dir, "embeddings"), cosine=0.95)


def html_extract_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(read(spark, sf_dir, "pages"))


def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def url_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number in a url is the document the page shows, so that is the label of the page."""
    labels = read(spark, sf_dir, "labels")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    document = F.expr("try_cast(regexp_extract(url, '/([0-9]+)', 1) AS bigint)")
    return url_filter.judge_urls(
        read(spark, sf_dir, "pages"), labels.select("doc_id", bad.alias("bad")), RULES, label_key=document
    )


def url_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the url filter that do not depend on what is learned."""
    return url_filter_query(spark, sf_dir).select("page_id", "host", "path", "rule")


def source_targets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the mix that do not depend on draws."""
    mixed = mixing.mix_sources(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


def token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return token_files.token_files(docs, tokenizer_path("word_bpe_49k.json"), END_ID)


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def held_out(id_col: str = "doc_id") -> F.Column:
    return F.crc32(F.col(id_col).cast("string")) % 3 == 1


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.train_toxicity(docs, labels.filter(~held_out()))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def whitening_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(read(spark, sf_dir, "embeddings"), components=4)
    return white.withColumn("deviation", F.col("deviation").cast("long"))


def byte_bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode_documents(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    both = byte_bpe.decode_documents(encoded, byte_bpe.token_bytes(spark, path))
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def hard_negatives_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


LINE_DEDUP_SQL = """
WITH lines AS (
    SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
),
keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
),
repeated AS (
    SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2
),
marked AS (
    SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id <> r.first_doc AS dropped
    FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

NGRAM_JOIN_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]) END AS s
    FROM words
),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reach AS (
    SELECT doc_id AS node, doc_id AS start FROM sets
    UNION SELECT l.b, r.start FROM reach r JOIN links l ON l.a = r.node
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.start) AS component_id
FROM sets s JOIN reach r ON r.node = s.doc_id GROUP BY s.doc_id, len(s.s)
"""

EMBEDDING_DEDUP_SQL = """
WITH RECURSIVE usable AS (
    SELECT vec_id, [v::DOUBLE for v in embedding] AS e FROM embeddings
    WHERE len(embedding) > 0 AND len([v for v in embedding if v IS NULL OR NOT isfinite(v)]) = 0
      AND len([v for v in embedding if v <> 0]) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a, usable b
    WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
),
reach AS (
    SELECT vec_id AS node, vec_id AS start FROM embeddings
    UNION SELECT l.b, r.start FROM reach r JOIN links l ON l.a = r.node
),
found AS (SELECT node AS vec_id, min(start) AS component_id FROM reach GROUP BY node)
SELECT f.vec_id, (SELECT count(*) FROM links l WHERE l.a = f.vec_id) AS n_links, f.component_id,
       f.vec_id = f.component_id AS kept
FROM found f
"""

URL_RULES_SQL = """
WITH rests AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests
),
rules(rule, rule_host, rule_path) AS (
    VALUES ('net/', 'net', '/'), ('example.net/en/', 'example.net', '/en/'), ('example.com/de/', 'example.com', '/de/'), ('org/fr/', 'org', '/fr/')
)
SELECT page_id, any_value(host) AS host, any_value(path) AS path, arg_max(rule, length(rule)) AS rule
FROM parts LEFT JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY page_id
"""

# Sources are filled to their limit in the order in which a rising water level meets it.
SOURCE_TARGETS_SQL = r"""
WITH sizes AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
    FROM sizes GROUP BY source
),
levels AS (
    SELECT *, 2 * source_size / weight AS level,
           coalesce(sum(2 * source_size) OVER w, 0)::DOUBLE AS full_before, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weight_left,
           1.5 * sum(source_size) OVER () AS total
    FROM sources WINDOW w AS (ORDER BY 2 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
water AS (SELECT max((total - full_before) / weight_left) AS height FROM levels WHERE (total - full_before) / weight_left <= level)
SELECT s.doc_id, s.size, l.source_size, round(least(2.0 * l.source_size, l.weight * coalesce(height, 1e300)), 3) AS target
FROM sizes s JOIN levels l ON s.source IS NOT DISTINCT FROM l.source, water
"""

HARD_NEGATIVES_SQL = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * v::DOUBLE) for v in embedding] AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len([v for v in embedding if v IS NULL OR NOT isfinite(v)]) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
    FROM rows a, rows b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
fits AS (
    SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM fits WHERE rank <= 5
"""

QUERIES = {
    "op1_line_dedup": line_dedup_query,
    "op2_ngram_join": ngram_join_query,
    "op3_token_counts": token_counts_query,
    "op4_url_filters": url_filter_query,
    "op5_embedding_dedup": embedding_dedup_query,
    "op6_html_extract": html_extract_query,
    "op7_decontamination": decontaminate_query,
    "op8_token_files": token_files_query,
    "op9_source_mix": mixing_query,
    "op10_toxicity": toxicity_query,
    "op11_whitening": whitening_query,
    "op12_byte_bpe": byte_bpe_query,
    "op13_hard_negatives": hard_negatives_query,
    "url_rules": url_rules_query,
    "source_targets": source_targets_query,
}
ORACLES = {
    "op1_line_dedup": LINE_DEDUP_SQL,
    "op2_ngram_join": NGRAM_JOIN_SQL,
    "op5_embedding_dedup": EMBEDDING_DEDUP_SQL,
    "url_rules": URL_RULES_SQL,
    "source_targets": SOURCE_TARGETS_SQL,
    "op13_hard_negatives": HARD_NEGATIVES_SQL,
}
