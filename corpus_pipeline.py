"""The corpus pipeline: documents through language identification, toxicity, near-duplicate removal, mixing and packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes to the shared folder and reads again
as the next stage's documents. All stages but the last return the columns of documents; the last returns the packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskframe.llm import langid, mixing, ngram_join, packing, queries, toxicity
from maskframe.llm.common import table, written

#: share of a text's n-grams that its language must contain, and the toxicity score at which a document goes
LEAST_SHARE, TOXIC = 0.1, 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no known language (operator 4): null texts, texts without a letter, and texts of which less than
    ``LEAST_SHARE`` is in the best language. All others stay as they are."""
    model = queries.language_model(docs)
    kept = langid.identify(docs, model, out="_language").filter((F.col("_language.lang") != "und") & (F.col("_language.share") >= LEAST_SHARE))
    return kept.select(*docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the toxicity model scores ``TOXIC`` or more (operator 10); labels come from the table."""
    model = queries.toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, out="_toxicity").filter(F.col("_toxicity") < TOXIC).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (operator 6): the smallest doc_id of the group. Documents without
    an id or a word belong to no group and stay."""
    return ngram_join.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources to their target weights (operator 7): a document appears once for each pass that takes words of
    it, whole or cut to the words taken."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences (operator 2), one row per piece."""
    return packing.pack_documents(docs, queries.tokenizer("byte_bpe_50k.json"))


STAGES = [("language ID", language), ("toxicity", toxic), ("n-gram Jaccard join", near_duplicates), ("mixing sources to target weights", mixture), ("best-fit packing", packed)]

#: none: models and hashing cannot be put in SQL; tests/llm holds the stages against brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = written(stage(spark, out, sf_dir), name.replace(" ", "-").lower())
    return out
