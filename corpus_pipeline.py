"""From raw documents to token digests, in five stages.

Every stage works on all that its predecessor kept and writes its result as
Parquet into the shared checkpoint folder; the next stage reads that.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import bpe, decontaminate, pii, simhash, toxicity
from corpusflow.llm.queries import tokenizer_path, toxicity_model
from corpusflow.plans.strategy import bounded_broadcast, materialize
from corpusflow.session import read_table, shared_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold, learnt from the labels of
    ``sf_dir`` outside of the held-out fold."""
    model = toxicity_model(spark, docs, sf_dir)
    name = _free(docs, "_toxic")
    scored = docs.withColumn(name, toxicity.toxicity_column(F.col("text"), model)["score"])
    return scored.where(F.col(name) < toxicity.THRESHOLD).drop(name)


def _keyed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with a key of id and text, 128 bits in two columns: rows that
    share it are the same document, rows that share an id alone are not."""
    names = [_free(docs, "_key1"), _free(docs, "_key2")]
    whole = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text").isNull(), F.col("text")]
    return docs.select("*", *(F.xxhash64(F.lit(i), *whole).alias(n) for i, n in enumerate(names))), names


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id, rows
    without an id last, then by key. Decided by id and text together: a text of
    its own stays, whatever other rows carry its id; of equal rows one stays."""
    keyed, key = _keyed(docs)
    rows = materialize(simhash.simhash_groups(keyed, shingle=4, max_bits=4, keep=tuple(key)), "groups")
    first = rows.groupBy("group_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *key)).alias("best"))
    judged = rows.join(first, "group_id").withColumn("stays", (F.col(f"best.{key[0]}") == F.col(key[0])) & (F.col(f"best.{key[1]}") == F.col(key[1])))
    judged = materialize(judged.groupBy(*key).agg(F.first("stays").alias("_stays"), F.count(F.lit(1)).alias("_n")).where("not _stays or _n > 1"), "judged")
    gone, _ = bounded_broadcast(judged.where("not _stays").select(*key))
    kept = keyed.join(gone, key, "left_anti")
    again, _ = bounded_broadcast(judged.where("_stays").select(*key))
    if not again.head(1):
        return kept.drop(*key)
    once = kept.join(again, key, "left_semi").dropDuplicates(key)
    return kept.join(again, key, "left_anti").unionByName(once).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window. Decided by id and text together;
    contaminated documents leave by an anti-join on their key."""
    keyed, key = _keyed(docs)
    found = decontaminate.contamination(keyed, read_table(spark, sf_dir, "benchmark"), size=10, keep=tuple(key))
    bad, _ = bounded_broadcast(found.where("contaminated").select(*key).distinct())
    return keyed.join(bad, key, "left_anti").select(docs.columns)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    name = _free(docs, "_pii")
    out = docs.withColumn(name, pii.pii_column(F.col("text"), pii.fit_pii(), redacted=True)["redacted"])
    clean = F.when(F.col("text").isNull(), F.lit(None)).otherwise(F.col(name))
    return out.withColumn("text", clean).withColumn("n_chars", F.char_length("text").cast("long")).drop(name)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the digests of ids and decoded text."""
    return bpe.bpe_digest(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("pii", redact_pii),
    ("bpe", tokenize),
]

#: The models of the first and fourth stage cannot be written in SQL.
ORACLE_SQL = None


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have, in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the table ``documents`` of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    base = shared_path(spark, f"pipeline/{uuid.uuid4().hex[:16]}")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
