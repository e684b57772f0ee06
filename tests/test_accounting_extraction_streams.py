"""G, H, I and the skew-safe helpers."""

from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal
import itertools
import random

from pyspark.sql import functions as F

from corpusflow.operators import accounting as oa
from corpusflow.operators import extraction as oe
from corpusflow.plans.strategy import dense_position, running_sum
from corpusflow.streaming import streams as st
from tests.conftest import SF_SMALL


def test_status_table(spark):
    log = spark.createDataFrame(
        [(200, None), (201, "x"), (401, None), (402, None), (403, None), (404, None), (422, None), (429, "5"),
         (500, None), (503, "30"), (503, "soon"), (503, None), (503, " 7 ")],
        "status int, retry_after string",
    )
    got = [(r.status, r.error_class, r.retry_after_s) for r in oa.classify_status(log).collect()]
    assert got == [(200, "ok", None), (201, "ok", None), (401, "auth", None), (402, "credits", None), (403, "auth", None),
                   (404, "generic", None), (422, "validation", None), (429, "rate_limit", None), (500, "server", None),
                   (503, "busy", 30), (503, "busy", None), (503, "busy", None), (503, "busy", 7)]


def test_costs(spark):
    usage = spark.createDataFrame(
        [("chunk", 10, True, 0), ("injection", 3, False, 0), ("extract", 2, True, 4), ("inspect", 9, True, 0), ("query", 5, True, 0)],
        "operation string, quantity long, ok boolean, fields int",
    )
    got = {r.operation: r.credits for r in oa.cost_rows(usage).collect()}
    assert got == {"chunk": Decimal("0.0050"), "injection": Decimal("0.0000"), "extract": Decimal("0.0108"),
                   "inspect": Decimal("0.0000"), "query": Decimal("0.0010")}


def test_running_sum_and_positions_with_hot_key(spark):
    random.seed(7)
    rows = [("hot" if i % 3 else f"k{i % 50}", i, random.randint(1, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "acct string, t long, v long").repartition(16)
    rs = {(r.acct, r.t): r.run for r in running_sum(df, ["acct"], ["t"], "v", "run").collect()}
    pos = {(r.acct, r.t): r.position for r in dense_position(df, ["acct"], ["t"]).collect()}
    for acct, grp in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        total = 0
        for i, (_, t, v) in enumerate(grp, 1):
            total += v
            assert rs[(acct, t)] == total and pos[(acct, t)] == i


def test_balance_overdraw(spark):
    costs = spark.createDataFrame([("a", 1, Decimal("0.6")), ("a", 2, Decimal("0.6")), ("b", 1, Decimal("0.1"))],
                                  "account string, ts long, credits decimal(18,4)")
    got = {(r.account, r.ts): (r.credits_remaining, r.overdrawn) for r in oa.running_balance(costs, 1.0).collect()}
    assert got == {("a", 1): (Decimal("0.4000"), False), ("a", 2): (Decimal("-0.2000"), True), ("b", 1): (Decimal("0.9000"), False)}


def test_extraction(spark):
    spec = {"price": "number — the price", "sku": "string", "stock": "boolean - in stock", "note": "free text"}
    _, rows = oe.parse_schema(spec)
    assert rows == [("price", "number", "the price"), ("sku", "string", ""), ("stock", "boolean", "in stock"), ("note", "string", "free text")]
    pages = spark.createDataFrame([(1, "$ 12.5 sku:AB1 stock:yes"), (2, "nothing"), (3, "stock:no")], "page_id long, html string")
    rules = {"price": r"\$\s*([0-9.]+)", "sku": r"sku:(\w+)", "stock": r"stock:(\w+)", "note": r"note:(\w+)"}
    st_ = oe.page_status(oe.extract_fields(pages, spec, rules), spec)
    got = {r.page_id: (r.extracted.price, r.extracted.sku, r.extracted.stock, r.status) for r in st_.collect()}
    assert got == {1: (12.5, "AB1", True, "ok"), 2: (None, None, None, "error"), 3: (None, None, False, "ok")}
    rep = oe.extract_report(st_).collect()[0]
    assert (rep.pages_attempted, rep.pages_extracted, rep.pages_failed) == (3, 2, 1)
    lst = oe.extract_list(spark.createDataFrame([(1, "<i>a</i><i>b</i>")], "page_id long, html string"),
                          {"x": "string"}, {"x": r"<i>(\w)</i>"}).collect()
    assert [(r.item_index, r.x, r.item_count) for r in lst] == [(0, "a", 2), (1, "b", 2)]
    w = oe.model_window(spark.createDataFrame([("x" * 9000,)], "text string"), "gpt-4o-mini").collect()[0]
    assert w.window_chars == 8000 and len(w.text_sent) == 8000


def test_stream_dedupe_equals_batch(spark):
    ev = st.file_stream(spark, SF_SMALL, "events.parquet", spark.read.parquet(f"{SF_SMALL}/events.parquet").schema)
    urls = ev.select("ts", F.concat(F.lit("https://s.example.com/"), F.col("event_type"), F.lit("/#x")).alias("url"))
    out = st.stream_dedupe_urls(urls).select("nurl")
    path, ck = st.run_dir(spark, "t-dedupe"), st.run_dir(spark, "t-dedupe-ck")
    st.run_available_now(out, ck, "append", path=path)
    got = sorted(r.nurl for r in spark.read.parquet(path).collect())
    assert got == sorted({f"https://s.example.com/{t}" for t in ["signup", "error", "click", "view", "purchase"]})


def test_stream_ingest_incremental_upsert(spark):
    import os

    src = st.run_dir(spark, "t-ingest-src")
    base, ck = st.run_dir(spark, "t-ingest-index"), st.run_dir(spark, "t-ingest-ck")
    first = spark.createDataFrame([(1, "alpha beta gamma " * 10), (2, "delta epsilon")], "doc_id long, text string")
    first.write.parquet(os.path.join(src, "a"))
    schema = first.schema
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
    st.stream_ingest(stream, base, ck).awaitTermination()
    v1 = {r.chunk_id: r.content for r in st.read_index(spark, base).collect()}
    assert set(v1) == {"1:0", "2:0"}
    # a new file arrives with a new text for doc 2 and a new doc 3
    spark.createDataFrame([(2, "zeta eta"), (3, "theta")], "doc_id long, text string").write.parquet(os.path.join(src, "b"))
    st.stream_ingest(stream, base, ck).awaitTermination()
    v2 = {r.chunk_id: r.content for r in st.read_index(spark, base).collect()}
    assert v2 == {"1:0": v1["1:0"], "2:0": "zeta eta", "3:0": "theta"}
    # the checkpoint remembers the first file: nothing is ingested twice
    assert st.read_index(spark, base).count() == 3


def test_stream_ingest_replaces_all_chunks_of_a_document(spark):
    import os

    src = st.run_dir(spark, "t-shrink-src")
    base, ck = st.run_dir(spark, "t-shrink-index"), st.run_dir(spark, "t-shrink-ck")
    schema = "doc_id long, text string"
    spark.createDataFrame([(1, "word " * 1500), (2, "keep")], schema).write.parquet(os.path.join(src, "a"))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
    st.stream_ingest(stream, base, ck).awaitTermination()
    assert st.read_index(spark, base).where("doc_id = 1").count() > 2
    spark.createDataFrame([(1, "short now")], schema).write.parquet(os.path.join(src, "b"))
    st.stream_ingest(stream, base, ck).awaitTermination()
    assert {r.content for r in st.read_index(spark, base).collect()} == {"short now", "keep"}
    spark.createDataFrame([(2, "  ")], schema).write.parquet(os.path.join(src, "c"))
    st.stream_ingest(stream, base, ck).awaitTermination()
    assert {r.content for r in st.read_index(spark, base).collect()} == {"short now"}


def _run_days(spark, days, schema, query):
    """Rows that pass in each run; a run adds one day and goes on from the checkpoint."""
    src, path, ck = (st.run_dir(spark, f"t-visited{x}") for x in ("-src", "", "-ck"))
    passed, before = [], Counter()
    for rows in days:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        st.run_available_now(query(spark.readStream.schema(schema).parquet(src)), ck, "append", path=path)
        now = Counter(tuple(r) for r in spark.read.parquet(path).collect())
        passed.append(sorted((now - before).elements()))
        before = now
    return passed


def test_stream_visited_over_restarts(spark):
    days = [["https://a.com/x", "https://a.com/x#1", "https://a.com/y"], ["https://a.com/y", "https://a.com/z"], ["https://a.com/x", "https://a.com/z#top"], ["https://b.com/p"]]
    got = _run_days(spark, [[(u,) for u in day] for day in days], "url string", st.stream_visited_urls)
    assert got == [[("https://a.com/x",), ("https://a.com/y",)], [("https://a.com/z",)], [], [("https://b.com/p",)]]


def test_stream_revisits_after_the_time_to_live(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    at = lambda d, h=0: datetime(2024, 1, d, h)
    x, y = "https://a.com/x", "https://a.com/y"
    days = [
        [(x, at(1, 5)), (x + "#1", at(1, 3)), (y, at(1)), (None, at(1)), (x, None)],
        [(x, at(2)), (y, at(2, 23))],
        [(x, at(4, 3)), (x, at(4, 4)), (y, at(3, 23))],
        [(x, at(5)), (y, at(9))],
    ]
    try:
        got = _run_days(spark, days, "url string, ts timestamp", lambda s: st.stream_revisits(s, timedelta(days=3)))
    finally:
        spark.conf.unset(key)
    assert got == [[(x, at(1, 3)), (y, at(1))], [], [(x, at(4, 3))], [(y, at(9))]]
