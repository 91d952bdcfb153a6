"""Rows that break naive code, and columns named like the operators' own, through every operator on documents."""

import pytest

from maskframe.llm import centroids, exact_dedup, hnsw, html_extract, langid, mixing, ngram_join, packing, sharding, topk, toxicity, viterbi, whitening
from maskframe.llm import queries as Q
from maskframe.llm.common import free_names, running, written

SF = "/root/testdata/sf0.001"
OWN = ["_b", "_v", "_i", "_0", "_k0", "_h", "_text", "_gone", "_again", "_c", "_th", "_key", "_key2", "_tc", "_rank", "_p", "_spans", "_pass", "_source", "_doc_id", "_copy", "_digest", "_language", "_toxicity", "_bucket", "_place", "_own", "_start", "_total", "row", "h", "k0", "digest", "size", "src", "copy", "target"]


@pytest.fixture(scope="module")
def docs(spark):
    long = "word " * 100_000
    texts = [None, "", " ", "\n" * 1_000_000, " " * 1_000_000, "\t \r\n" * 250_000, "<" * 300_000, "x" * 300_000, long, long, "!?" * 100_000, "é\U0001f600\u0000", "plain words that say nothing much at all, twice", "plain words that say nothing much at all, twice"]
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else f"s{i % 2}", None) for i, t in enumerate(texts)]
    rows += [(3, "an id that comes twice, with another text", "en", "s1", 1), (None, "no id at all", None, None, None), (None, None, None, None, None)]
    base = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return base.selectExpr("*", *[f"concat('{c}', doc_id) AS `{c}`" for c in OWN])


def untouched(before, after):
    """The user's columns come back, each with what it held."""
    for c in OWN:
        bad = after.filter(f"`{c}` IS NOT NULL AND `{c}` <> concat('{c}', doc_id)").count()
        assert c in after.columns and bad == 0, c
    assert set(before.columns) <= set(after.columns)


def test_names_are_free():
    assert free_names(["a", "_A", "__b"], "a", "b", "b") == ["__a", "_b", "___b"]


def test_frames_that_keep_the_users_columns(spark, docs, tokenizer_path):
    n = docs.count()
    outs = {
        "running": running(docs, ["source"], ["doc_id", "text"], Q.F.lit(1), "slot"),
        "slots": sharding.with_slots(sharding.assign(docs, ["doc_id"], {0: 1.0, 1: 1.0}), ["doc_id"], ["text"]),
        "tokens": viterbi.token_counts(docs, tokenizer_path("piece_bpe_32k.model")),
    }
    for name, out in outs.items():
        assert out.count() == n, name
        untouched(docs, out)
    for out in (ngram_join.keep_one(docs), exact_dedup.keep_first(docs), mixing.mixed_documents(docs)):
        assert out.columns == docs.columns
        untouched(docs, out)


def test_every_document_once(spark, docs, tokenizer_path):
    n, named = docs.count(), docs.filter("doc_id IS NOT NULL").count()
    pieces = packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))
    assert pieces.filter("start = 0").count() == n
    assert pieces.filter("doc_id = 3").agg({"length": "sum"}).first()[0] > 2
    assert ngram_join.join(docs).count() == named
    assert exact_dedup.memberships(docs).count() == n
    documents, spans = mixing.mix(docs)
    assert mixing.taken(documents, spans).count() == n
    assert langid.identify(docs, Q.language_model(spark.read.parquet(f"{SF}/documents.parquet"))).count() == n
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    scores = [r["score"] for r in toxicity.scored(docs, model, out="score").collect()]
    assert len(scores) == n and all(0 <= s <= 1 for s in scores)


def test_pages_and_vectors(spark, docs):
    model = html_extract.fit(html_extract.labelled_pages(spark))
    pages = docs.withColumn("html", Q.F.concat(Q.F.lit("<p data-label='x\">"), "text"))
    out = html_extract.extract(pages, model, out="main")
    assert out.filter("main IS NOT NULL").count() == docs.count()
    untouched(docs, out)
    v = docs.selectExpr("doc_id AS vec_id", "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE array(float(doc_id), float(-1), float(doc_id % 3)) END AS embedding", *[f"`{c}`" for c in OWN])
    real = v.filter("embedding IS NOT NULL AND vec_id IS NOT NULL").count()
    assert hnsw.near_duplicates(v).count() == docs.count()
    assert centroids.clusters(v, dim=3).count() == real
    assert whitening.whiten(v).filter("component = 1").count() == real
    assert topk.top_k(v, v, k=1).count() == v.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").select("vec_id").distinct().count()


def test_pipeline_on_hostile_rows(spark, docs):
    import corpus_pipeline as P

    out = spark.read.parquet(f"{SF}/documents.parquet").unionByName(docs.select("doc_id", "text", "lang", "source", "n_chars"))
    for _, stage in P.STAGES:
        out = written(stage(spark, out, SF), "hostile")
    assert out.count() > 0
