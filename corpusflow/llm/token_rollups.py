"""Token counts as delta-maintained rollups.

A store is a folder of committed batches. A batch holds signed rows: an insert
adds a document's count, a delete takes its current count away, a revision
takes the old count away and adds the new one. Totals by source, language and
tokenizer version are sums of signed rows, so they change by the batch alone.
A batch id is committed once; repeating it changes nothing.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
ROWS = "doc_id long, source string, lang string, tokenizer string, docs long, tokens long"
TOTALS = "source string, lang string, tokenizer string, docs long, tokens long"


def word_count(text: Column) -> Column:
    """Runs of other characters than ASCII white space; null text has none."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, r"[\x20\x09-\x0D]+"))).cast("long")


def quarter_count(text: Column) -> Column:
    """A quarter of the code points, rounded up; null text has none."""
    return F.ceil(F.char_length(F.coalesce(text, F.lit(""))) / 4).cast("long")


#: Tokenizer versions: name -> count of a text.
TOKENIZERS = {"words-1": word_count, "quarter-1": quarter_count}


def count_rows(docs: DataFrame, tokenizers=TOKENIZERS) -> DataFrame:
    """(doc_id, source, lang, tokenizer, tokens): one row per document and
    tokenizer version, in one scan. Null source or language is ''."""
    counts = F.array(*[F.struct(F.lit(n).alias("tokenizer"), f(F.col("text")).alias("tokens")) for n, f in tokenizers.items()])
    d = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"), F.explode(counts).alias("c"))
    return d.select("doc_id", "source", "lang", "c.tokenizer", "c.tokens")


class RollupStore:
    """Signed rows and totals of committed batches below ``path`` (a folder
    that all executors share).

    ``rows/batch=N`` holds a batch's signed rows per document, ``totals/batch=N``
    their sums and ``commits/batch=N`` its commit, written last. A batch whose
    commit is missing was interrupted: its rows are overwritten by the next
    try and never read before. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _at(self, kind: str, batch: int | None = None) -> str:
        return os.path.join(self.path, kind, *([f"batch={batch}"] if batch is not None else []))

    def _exists(self, path: str) -> bool:
        try:
            self.spark.read.schema("n long").parquet(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return False
            raise
        return True

    def committed(self) -> list[int]:
        if not self._exists(self._at("commits")):
            return []
        rows = self.spark.read.schema("n long").parquet(self._at("commits")).select("n").distinct().collect()
        return sorted(r["n"] for r in rows)

    def _read(self, kind: str, schema: str) -> DataFrame:
        done = self.committed()
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self._at(kind, n) for n in done])

    def ledger(self) -> DataFrame:
        """Current count of every (doc_id, tokenizer) with a document."""
        s = self._read("rows", ROWS).groupBy("doc_id", *KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return s.where("docs != 0")

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, docs, tokens``; groups without documents
        are left out. Sums of per-batch sums, not of documents."""
        t = self._read("totals", TOTALS).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return t.where("docs != 0 or tokens != 0")

    def apply(self, batch: int, upserts: DataFrame | None = None, deletes: DataFrame | None = None) -> bool:
        """Commit a batch: ``upserts`` (rows of ``count_rows``; a document that
        is there already is revised, also to another source or language) and
        ``deletes(doc_id)``. False if the batch was committed before.

        Rows that repeat a (doc_id, tokenizer) inside a batch count once, the
        one with the greatest (tokens, source, lang); a document in both
        frames is deleted; deletes of unknown documents change nothing; a null
        doc_id is ignored.
        """
        if batch in self.committed():
            return False
        spark = self.spark
        plus = spark.createDataFrame([], ROWS).drop("docs") if upserts is None else upserts
        gone = (spark.createDataFrame([], "doc_id long") if deletes is None else deletes.select(F.col("doc_id").cast("long"))).where("doc_id is not null").distinct()
        plus = plus.where("doc_id is not null").groupBy("doc_id", "tokenizer").agg(F.max(F.struct("tokens", "source", "lang")).alias("r"))
        plus = plus.select("doc_id", "r.source", "r.lang", "tokenizer", F.lit(1).cast("long").alias("docs"), F.col("r.tokens").alias("tokens"))
        plus = plus.join(gone, "doc_id", "left_anti")
        rows = plus
        if self.committed():
            held = self.ledger()
            touched = plus.select("doc_id", "tokenizer").distinct()
            old = held.join(gone, "doc_id", "left_semi").unionByName(held.join(gone, "doc_id", "left_anti").join(touched, ["doc_id", "tokenizer"], "left_semi"))
            minus = old.select("doc_id", *KEYS, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
            rows = plus.unionByName(minus.select(plus.columns))
            # A revision to the same group is one signed row.
            rows = rows.groupBy("doc_id", *KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs != 0 or tokens != 0")
        rows.select("doc_id", *KEYS, "docs", "tokens").write.mode("overwrite").parquet(self._at("rows", batch))
        written = spark.read.schema(ROWS).parquet(self._at("rows", batch))
        written.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).write.mode("overwrite").parquet(self._at("totals", batch))
        spark.createDataFrame([(batch,)], "n long").coalesce(1).write.mode("overwrite").parquet(self._at("commits", batch))
        return True
