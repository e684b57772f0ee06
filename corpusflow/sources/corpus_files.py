"""A data source that lists, reads and writes whole files, whatever their names.

Spark's own file sources leave out names that begin with a dot or an
underscore, and empty files; this one lists them all. The reader lists once
when the scan is planned, cuts the listing into partitions of balanced size and
reads each partition's files on an executor. The writer gives every row a file
of its own below the folder it is saved to.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import PurePosixPath

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

FORMAT = "corpus_files"
SCHEMA = "path string, length long, content binary, error string"
#: Bytes of a partition, what opening a file counts (so a partition holds about
#: a thousand small files: starting its task costs more than reading a hundred),
#: and bytes of one batch.
PARTITION_BYTES = 128 << 20
OPEN_BYTES = 128 << 10
BATCH_BYTES = 16 << 20


def open_store(path: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of ``path``, the path inside it, and what makes a listed
    path a full one again. Raises where the store is not one of pyarrow's."""
    store, inner = fs.FileSystem.from_uri(path)
    scheme = path.split("://", 1)[0] if "://" in path else path.split(":", 1)[0] if path.startswith("file:") else ""
    local = scheme in ("", "file")
    return store, inner, "file:" if local else scheme + "://"


def readable(path: str) -> bool:
    """Can pyarrow reach the store of ``path``?"""
    try:
        open_store(path)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


@dataclass
class Files(InputPartition):
    paths: list[str]
    lengths: list[int]


def packed(files: list[tuple[str, int]], limit: int) -> list[list[tuple[str, int]]]:
    """Consecutive files up to ``limit`` bytes together."""
    out: list[list[tuple[str, int]]] = []
    size = 0
    for path, length in files:
        cost = length + OPEN_BYTES
        if not out or size + cost > limit:
            out.append([])
            size = 0
        out[-1].append((path, length))
        size += cost
    return out


class CorpusReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.suffixes = json.loads(options["suffixes"]) if "suffixes" in options else None
        self.recursive = options.get("recursive", "true") == "true"
        self.first = int(options["first"]) if "first" in options else None
        self.content = options.get("content", "true") == "true"
        self.limit = int(options.get("partitionbytes", options.get("partitionBytes", PARTITION_BYTES)))

    def partitions(self) -> list[InputPartition]:
        store, inner, _ = open_store(self.path)
        listed = store.get_file_info(fs.FileSelector(inner, recursive=self.recursive))
        files = [
            (i.path, i.size or 0) for i in listed
            if i.type == fs.FileType.File and (self.suffixes is None or PurePosixPath(i.path).suffix.lower() in self.suffixes)
        ]
        files.sort(key=lambda f: f[0].split("/"))
        parts = packed(files[: self.first], self.limit)
        return [Files([p for p, _ in part], [n for _, n in part]) for part in parts] or [Files([], [])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _, prefix = open_store(self.path)
        rows: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            types = (pa.string(), pa.int64(), pa.binary(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["path", "length", "content", "error"])

        for path, length in zip(partition.paths, partition.lengths):
            content, error = None, None
            if self.content:
                try:
                    with store.open_input_stream(path) as f:
                        content = f.read()
                except OSError as e:  # a file that cannot be read is a row, the scan goes on
                    error = f"{type(e).__name__}: {e}"
            rows.append((prefix + path, length if content is None else len(content), content, error))
            size += len(content or b"")
            if size >= BATCH_BYTES:
                yield batch()
                rows, size = [], 0
        if rows:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    files: int


class CorpusWriter(DataSourceWriter):
    """Rows ``path`` (below the folder) and ``content`` to files. A task that
    runs again writes the same files again."""

    def __init__(self, options: dict[str, str], schema):
        self.path = options["path"]
        self.at = [schema.fieldNames().index(c) for c in ("path", "content")]

    def write(self, rows: Iterator) -> WriterCommitMessage:
        store, inner, _ = open_store(self.path)
        made: set[str] = set()
        n = 0
        for row in rows:
            name, content = (row[i] for i in self.at)
            parts = PurePosixPath(name).parts
            if not parts or name.startswith("/") or ".." in parts:
                raise ValueError(f"{name!r} does not lie below the folder")
            full = f"{inner}/{name}"
            folder = full.rsplit("/", 1)[0]
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            with store.open_output_stream(full) as f:
                f.write(content.encode() if isinstance(content, str) else bytes(content or b""))
            n += 1
        return Written(n)


class CorpusFiles(DataSource):
    """``spark.read.format("corpus_files")``: one row per file, sorted by the
    parts of its path. Options: ``suffixes`` (JSON list, compared with the
    lower-cased suffix), ``recursive``, ``first`` (files), ``content`` (false
    lists without reading), ``partitionBytes``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return CorpusReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return CorpusWriter(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CorpusFiles)
