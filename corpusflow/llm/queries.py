"""One registered query per operator, over its whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import ann, bpe, decontaminate, lexical, licenses, pii, prefix_trie, quality, simhash, token_rollups, topk, toxicity, url_filter
from corpusflow.llm.common import held_out
from corpusflow.session import read_table, shared_path

#: Name of the tokenizer file in the installed collection of public ones.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    return ann.nearest(e, e.where(F.col("vec_id") % 20 == 0), 20)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    fold = held_out(F.col("doc_id"), 5, 0)
    model = quality.fit_quality(docs, labels, ~fold)
    return quality.quality_scores(docs, model).select("doc_id", fold.alias("held_out"), "score", "predicted")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    """Fitted on ``docs`` outside of the held-out fold."""
    return toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id"), 4, 2))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scores = toxicity.toxicity_scores(docs, toxicity_model(spark, docs, sf_dir))
    return scores.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans"))


def op5_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches over all documents: all are inserted; a
    seventh is deleted; a fifth is revised (their texts doubled) and an
    eleventh moves to another source; the last two batches are sent again."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    store = token_rollups.RollupStore(spark, shared_path(spark, f"rollups/{uuid.uuid4().hex[:16]}"))
    gone = docs.where("doc_id % 7 = 3").select("doc_id")
    kept = docs.where("doc_id % 7 != 3")
    twice = kept.where("doc_id % 5 = 1").withColumn("text", F.concat("text", F.lit(" "), "text"))
    moved = kept.where("doc_id % 11 = 2 and doc_id % 5 != 1").withColumn("source", F.lit("moved"))
    store.apply(1, token_rollups.count_rows(docs))
    store.apply(2, deletes=gone)
    for _ in range(2):
        store.apply(3, token_rollups.count_rows(twice))
        store.apply(4, token_rollups.count_rows(moved))
    return store.totals()


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_spans(read_table(spark, sf_dir, "documents"), pii.fit_pii())


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read_table(spark, sf_dir, "documents")).drop("detections")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), size=10)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page shows the document whose number stands in its path; that
    document's quality label marks the page."""
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("key"), (1 - F.col("quality")).alias("bad"))
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), labels)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(*prefix_trie.graft(prefix_trie.turn_rows(read_table(spark, sf_dir, "conversations"))))


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), 10)


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    return topk.exact_topk(e, e.where(F.col("vec_id") % 50 == 0), 5)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_nearest, op2_quality, op3_simhash, op4_toxicity, op5_token_rollups, op6_pii, op7_licenses, op8_bpe, op9_decontaminate,
        op10_url_filter, op11_prefix_trie, op12_ranked, op13_topk, pipeline,
    )
}
