"""The registered queries of this folder: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskframe.llm import centroids, exact_dedup, hnsw, html_extract, langid, mixing, ngram_join, packing, sharding, topk, toxicity, viterbi, whitening
from maskframe.llm.common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(modulus: int, remainder: int):
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) == remainder


def op1_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(rows, rows.filter(F.col("vec_id") % 50 == 0), k=5, scale=256)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = html_extract.extract(pages, html_extract.fit(html_extract.labelled_pages(spark)))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def language_model(docs: DataFrame) -> langid.Model:
    return langid.fit(docs.filter(~held_out(4, 2)))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.identify(docs.select("doc_id", "text"), language_model(docs))
    return out.select("doc_id", held_out(4, 2).alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score", "language.share")


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), least=0.95)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "text_class", "class_id", "n_links")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, spans = mixing.mix(table(spark, sf_dir, "documents"))
    return mixing.taken(documents, spans).select("doc_id", "source", "size", "source_size", "target", "taken")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer("piece_bpe_32k.model")).select("doc_id", "n_tokens", "token_score")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    placed = sharding.assign(docs, ["doc_id"], dict.fromkeys(range(24), 1.0))
    placed = sharding.assign(placed, ["doc_id"], dict.fromkeys(range(25), 1.0), "grown_shard")
    out = sharding.with_slots(placed, ["doc_id"], ["text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.fit(docs.filter(~held_out(5, 0)), labels.filter(~held_out(5, 0)))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.scored(docs, toxicity_model(docs, table(spark, sf_dir, "labels")), out="score")
    return out.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), components=16, scale=64, shift=1_000_000)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), k=8, rounds=10, scale=1024, dim=64, salt="3")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.memberships(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_maxscore": op1_maxscore,
    "op2_packing": op2_packing,
    "op3_html_text": op3_html_text,
    "op4_language_id": op4_language_id,
    "op5_near_vectors": op5_near_vectors,
    "op6_ngram_join": op6_ngram_join,
    "op7_mixing": op7_mixing,
    "op8_token_counts": op8_token_counts,
    "op9_sharding": op9_sharding,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_centroids": op12_centroids,
    "op13_exact_dedup": op13_exact_dedup,
}


def lloyd_sql(k: int = 8, rounds: int = 10, scale: int = 1024, dim: int = 64, salt: str = "3") -> str:
    """The rounds of operator 12 as one chain of common table expressions, every vector against every centroid."""
    far = "CAST(list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - c.v[i]) * (p.v[i] - c.v[i]))) AS BIGINT)"
    steps = [
        f"""part AS MATERIALIZED (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS place, list_transform(v, lambda x: CAST(floor({scale} * x) AS BIGINT)) AS v
  FROM (SELECT id AS vec_id, v FROM ({VECTORS})) WHERE len(v) = {dim}
)""",
        f"""centroid0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS cluster, v
  FROM (SELECT sha256('{salt}:' || CAST(vec_id AS VARCHAR)) AS h, v FROM part ORDER BY h, v LIMIT {k})
)""",
    ]
    for r in range(rounds + 1):
        steps.append(f"""assigned{r} AS MATERIALIZED (
  SELECT place, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (SELECT p.place, c.cluster, {far} AS d FROM part p, centroid{r} c) GROUP BY place
)""")
        if r < rounds:
            steps.append(f"""centroid{r + 1} AS MATERIALIZED (
  WITH sums AS (
    SELECT cluster, i, sum(x)::HUGEINT AS s, count(*) AS n
    FROM (SELECT a.cluster, unnest(p.v) AS x, generate_subscripts(p.v, 1) AS i FROM assigned{r} a JOIN part p USING (place)) GROUP BY ALL
  ), means AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM sums GROUP BY cluster)
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM centroid{r} c LEFT JOIN means m USING (cluster)
)""")
    return f"""
WITH {", ".join(steps)}
SELECT p.vec_id, a.cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM part p JOIN assigned{rounds} a USING (place) JOIN centroid{rounds} c USING (cluster)
"""

#: rows of embeddings that take part: (id, vector in double precision)
VECTORS = """
  SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
"""

ORACLES: dict[str, str] = {
    "op1_maxscore": f"""
WITH part AS (SELECT DISTINCT id, list_transform(v, lambda x: CAST(floor(256 * x) AS BIGINT)) AS v FROM ({VECTORS})),
scored AS (
  SELECT q.id AS query_id, c.id AS vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM part q JOIN part c ON c.id <> q.id AND len(c.v) = len(q.v) WHERE q.id % 50 = 0
), ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op5_near_vectors": f"""
WITH RECURSIVE part AS (
  SELECT id, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS v FROM ({VECTORS})
  WHERE len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.id AS a, b.id AS b FROM part a JOIN part b ON a.id <> b.id AND len(a.v) = len(b.v)
  WHERE list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) >= 0.95
), reach AS (SELECT id AS a, id AS b FROM part UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a), own AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(o.n, 0) AS n_links, coalesce(r.root, e.vec_id) AS component_id, e.vec_id = coalesce(r.root, e.vec_id) AS kept
FROM embeddings e LEFT JOIN roots r ON r.a = e.vec_id LEFT JOIN own o ON o.a = e.vec_id
""",
    "op6_ngram_join": """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS w FROM documents WHERE doc_id IS NOT NULL
), grams AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
  FROM words WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b, i = p.n AND i = q.n AS equal_sets FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 5 * i >= 4 * (p.n + q.n - i)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a),
own AS (SELECT a, count(*) AS n_links, min(CASE WHEN equal_sets THEN b END) AS twin FROM links GROUP BY a)
SELECT d.doc_id, least(d.doc_id, coalesce(o.twin, d.doc_id)) AS text_class, coalesce(r.root, d.doc_id) AS class_id, coalesce(o.n_links, 0) AS n_links
FROM documents d LEFT JOIN roots r ON r.a = d.doc_id LEFT JOIN own o ON o.a = d.doc_id WHERE d.doc_id IS NOT NULL
""",
    "op12_centroids": lloyd_sql(),
    "op13_exact_dedup": """
WITH hashed AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM hashed WINDOW same AS (PARTITION BY text_sha256)
""",
}
