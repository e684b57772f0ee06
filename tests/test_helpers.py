"""Small public helpers not covered elsewhere."""

import os

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import accounting as oa
from corpusflow.operators import chunking as ch
from corpusflow.operators import extraction as oe
from corpusflow.operators import index as ix
from corpusflow.session import shared_path
from corpusflow.sources import catalog as cat


def test_flatten_pages(spark):
    df = spark.createDataFrame(
        [(1, [("a", 1), ("b", 2)]), (2, [])],
        "page_id long, chunks array<struct<content string, token_estimate int>>",
    )
    got = [(r.page_id, r.chunk_index, r.content) for r in ch.flatten_pages(df).orderBy("page_id", "chunk_index").collect()]
    assert got == [(1, 0, "a"), (1, 1, "b")]


def test_index_versions_and_attach(spark):
    chunks = spark.createDataFrame([(1, 0, "x")], "doc_id long, chunk_index int, content string")
    vecs = spark.createDataFrame([(1, 0, [0.5, 0.5]), (9, 9, [1.0, 0.0])], "doc_id long, chunk_index int, embedding array<double>")
    joined = ix.attach_embeddings(chunks, vecs).collect()
    assert [(r.doc_id, r.embedding) for r in joined] == [(1, [0.5, 0.5])]
    base = shared_path(spark, "t-index-versions")
    path = ix.write_index_version(ix.index_rows(chunks, vecs), base, 1)
    assert os.path.basename(path) == "v=00000001"
    with pytest.raises(Exception):
        ix.write_index_version(ix.index_rows(chunks, vecs), base, 1)  # never overwritten
    assert ix.upserted_count(vecs).collect()[0].vectors_upserted == 2


def test_schema_frame_and_views(spark):
    sf = oe.schema_frame(spark, {"a": "number — x", "b": "text"}).collect()
    assert [(r.field, r.type, r.description, r.field_count) for r in sf] == [("a", "number", "x", 2), ("b", "string", "text", 2)]
    st = spark.createDataFrame([(1, "ok"), (2, "error"), (3, None)], "page_id long, status string")
    assert [r.page_id for r in oe.ok_results(st).collect()] == [1]
    assert sorted(r.page_id for r in oe.failed_results(st).collect()) == [2, 3]
    rep = oe.extract_report(st, discovered=spark.range(10)).collect()[0]
    assert (rep.pages_attempted, rep.pages_extracted, rep.pages_failed, rep.pages_discovered) == (3, 1, 2, 10)


def test_ingest_report_and_errors(spark):
    files = spark.createDataFrame([("j", "a", None), ("j", "b", "boom"), ("j", "c", None), ("k", "d", None)],
                                  "job string, file string, error string")
    chunks = spark.createDataFrame([("a",), ("a",), ("d",)], "file string")
    rep = {r.job: (r.files_processed, r.files_failed, r.total_chunks, r.vectors_upserted, str(r.credits_used), r.status)
           for r in oa.ingest_report(files, chunks).collect()}
    assert rep == {"j": (2, 1, 2, 2, "0.0070", "partial"), "k": (1, 0, 1, 1, "0.0035", "success")}
    assert [(r.file, r.error) for r in oa.ingest_errors(files).collect()] == [("b", "boom")]


def test_provider_catalog(spark):
    c = cat.provider_catalog()
    assert c["vector_db"].count() == 9 and c["embedding"].count() == 6 and c["llm"].count() == 3
    cfg = spark.createDataFrame([("n1", "pinecone", {"api_key": "k", "index_host": " "}), ("n2", "nope", {})],
                                "name string, provider string, config map<string,string>")
    got = sorted((r.name, r.field) for r in cat.missing_fields(cfg).collect())
    assert got == [("n1", "index_host"), ("n2", None)]
