"""Accounting (H1-H4): costs, balances, job reports, status classes.

Money is DECIMAL(18,4): every price is a multiple of 0.0001, so sums are exact
in any order and on any number of executors.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.plans.strategy import running_sum

MONEY = "decimal(18,4)"

# Credits per unit of each operation.
RATES = [
    ("url_local", "0.0020"),
    ("url_server", "0.0040"),
    ("spider", "0.0050"),
    ("chunk", "0.0005"),
    ("injection", "0.0030"),
    ("contextual", "0.0010"),
    ("js_render", "0.0050"),
    ("extract", "0.0030"),
    ("query", "0.0002"),
    ("pdf_file", "0.0020"),
    ("pdf_url", "0.0040"),
    ("inspect", "0.0000"),
]
EXTRACT_PER_FIELD = "0.0001"
EXTRACT_URL_FEE = "0.0020"

# Status classes.
STATUS_CLASSES = ["ok", "credits", "auth", "validation", "rate_limit", "busy", "server", "generic"]


def rate_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(op, Decimal(r)) for op, r in RATES], f"operation string, rate {MONEY}")


def cost_rows(usage: DataFrame, op: str = "operation", qty: str = "quantity", ok: str = "ok", fields: str = "fields") -> DataFrame:
    """H1: credits per usage row; failures cost nothing. An extract charges
    0.0030 + 0.0001 per field, plus the URL fee, per page."""
    rates = F.broadcast(rate_table(usage.sparkSession))
    u = usage.join(rates, op, "left")
    n_fields = F.coalesce(F.col(fields), F.lit(0)) if fields in usage.columns else F.lit(0)
    unit = F.when(
        F.col(op) == "extract",
        F.col("rate") + F.lit(Decimal(EXTRACT_PER_FIELD)).cast(MONEY) * n_fields + F.lit(Decimal(EXTRACT_URL_FEE)).cast(MONEY),
    ).otherwise(F.col("rate"))
    credits = F.when(F.coalesce(F.col(ok), F.lit(True)), unit * F.col(qty)).otherwise(F.lit(0))
    return u.withColumn("credits", F.coalesce(credits, F.lit(0)).cast(MONEY)).drop("rate")


def running_balance(costs: DataFrame, opening: DataFrame | float, account: str = "account", order: list[str] | None = None,
                    amount: str = "credits") -> DataFrame:
    """H2: credits_remaining after each call in time order; ``overdrawn`` when
    it falls below zero. ``opening`` is a number or a (account, opening) table."""
    order = order or ["ts"]
    c = costs.withColumn(amount, F.col(amount).cast(MONEY))
    r = running_sum(c, [account], order, amount, "_spent")
    if isinstance(opening, DataFrame):
        r = r.join(opening.select(account, F.col("opening").cast(MONEY).alias("_open")), account, "left")
    else:
        r = r.withColumn("_open", F.lit(Decimal(str(opening))).cast(MONEY))
    rem = (F.col("_open") - F.col("_spent")).cast(MONEY)
    return r.withColumn("credits_remaining", rem).withColumn("overdrawn", rem < 0).drop("_open", "_spent")


def ingest_report(files: DataFrame, chunks: DataFrame, job: str = "job", file: str = "file", error: str = "error",
                  chunk_file: str = "file", remaining: str | None = None, order: str | None = None) -> DataFrame:
    """H3: per job, files processed / failed, chunks, vectors, credits and
    status (success when no file failed, else partial). Blank files count
    as processed with no chunks. The error list is ``ingest_errors``. With
    ``remaining`` (the balance that a file's response reported) also
    ``credits_remaining``, the last one by ``order`` (the file by default) of
    the files that did not fail and reported one."""
    per_file = chunks.groupBy(chunk_file).agg(F.count(F.lit(1)).alias("_n"))
    extra = [F.col(remaining).alias("_left"), F.col(order or file).alias("_at")] if remaining else []
    f = files.select(job, file, error, *extra)
    f = f.join(per_file, F.col(file) == F.col(chunk_file), "left") if chunk_file != file else f.join(per_file, file, "left")
    fee = F.lit(Decimal("0.0005") + Decimal("0.0030")).cast(MONEY)
    failed = F.col(error).isNotNull()
    rep = f.groupBy(job).agg(
        F.count_if(~failed).alias("files_processed"),
        F.count_if(failed).alias("files_failed"),
        F.coalesce(F.sum(F.when(~failed, F.col("_n"))), F.lit(0)).cast("long").alias("total_chunks"),
        *([F.max_by("_left", F.when(~failed & F.col("_left").isNotNull(), F.col("_at"))).alias("credits_remaining")] if remaining else []),
    )
    return rep.select(
        job, "files_processed", "files_failed", "total_chunks",
        F.col("total_chunks").alias("vectors_upserted"),
        (F.col("total_chunks") * fee).cast(MONEY).alias("credits_used"),
        F.when(F.col("files_failed") == 0, F.lit("success")).otherwise(F.lit("partial")).alias("status"),
        *(["credits_remaining"] if remaining else []),
    )


def ingest_errors(files: DataFrame, job: str = "job", file: str = "file", error: str = "error") -> DataFrame:
    return files.where(F.col(error).isNotNull()).select(job, file, error)


def classify_status(log: DataFrame, status: str = "status", retry_after: str = "retry_after") -> DataFrame:
    """H4: HTTP status -> error class; 503 carries an integer retry_after
    (null when the header is missing or not an integer)."""
    s = F.col(status)
    cls = (
        F.when((s >= 200) & (s < 300), F.lit("ok"))
        .when(s == 402, F.lit("credits"))
        .when(s.isin(401, 403), F.lit("auth"))
        .when(s == 422, F.lit("validation"))
        .when(s == 429, F.lit("rate_limit"))
        .when(s == 503, F.lit("busy"))
        .when(s >= 500, F.lit("server"))
        .otherwise(F.lit("generic"))
    )
    retry = F.when(s == 503, F.col(retry_after).cast("string").try_cast("int"))
    return log.withColumn("error_class", cls).withColumn("retry_after_s", retry)


def status_counts(classified: DataFrame, group: list[str] | None = None) -> DataFrame:
    g = (group or []) + ["error_class"]
    return classified.groupBy(*g).agg(F.count(F.lit(1)).alias("n"))
