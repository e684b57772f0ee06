"""SimHash near-dedup by multi-index hashing.

Every text gets a 64-bit fingerprint over its word shingles. Two fingerprints
within ``d`` bits must agree, in at least one of ``m`` segments, up to that
segment's share of the bits (pigeonhole), so each fingerprint enumerates the
small Hamming ball around its own value in every segment, fetches the table
entries found there and verifies the complete distance. Components of the
verified links are the groups of near copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import text_blocks
from corpusflow.llm.components import connected_components
from corpusflow.plans.strategy import materialize

BITS = 64
#: A bucket with more table entries than this is dealt out again by the bits
#: that its segment left free.
SPLIT_AT = 4096
#: Candidate pairs that one numpy block compares at once.
PAIR_BLOCK = 1 << 21

_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_LANE = (np.arange(8) * 256).astype(np.int64)


def fingerprint(text: str, shingle: int) -> int:
    """64-bit SimHash of one text, unsigned: A-Z lower-cased, words cut at
    ASCII white space, ``shingle``-word shingles with repeats joined by one
    space (fewer words: all of them; none: zero), XXH64 with seed 42; a bit is
    1 if it is set in over half of the hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(2048, np.int64)
    stops = ends[shingle - 1 :].tolist()
    for i in range(0, n, 1 << 17):
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts[i : i + (1 << 17)], stops[i : i + (1 << 17)])]
        lanes = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8) + _LANE
        counts += np.bincount(lanes.ravel(), minlength=2048)
    ones = (counts.reshape(8, 256) @ _BYTE_BITS).ravel()
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int) -> Column:
    """Fingerprint as a signed long with the same 64 bits; null text is empty."""

    @F.pandas_udf("long")
    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in it:
            fps = [fingerprint(t, shingle) for block in text_blocks(texts) for t in block]
            yield pd.Series(np.array(fps, "<u8").view("<i8"))

    return run(text)


def hex_column(fp: Column) -> Column:
    """16 lower-case hex digits of the 64 bits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _segments(bits: list[int], m: int, d: int) -> list[tuple[list[int], int]]:
    """Cut the bit positions into ``m`` runs with radii whose sum is d - m + 1:
    if every run differed by more than its radius, the total would pass d."""
    cuts = np.array_split(np.array(bits), m)
    base, more = divmod(d - m + 1, m)
    return [(c.tolist(), base + (i < more)) for i, c in enumerate(cuts)]


def _balls(bits: list[int], m: int, d: int) -> list[tuple[int, list[int]]]:
    """(mask, flips) of each segment; the first flip is 0."""
    out = []
    for seg, radius in _segments(bits, m, d):
        flips = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(seg, r)]
        out.append((sum(1 << b for b in seg), flips))
    return out


def segment_count(n: int, d: int) -> int:
    """The number of segments with the least work: probes for one fingerprint
    plus expected chance candidates among ``n``. Any choice gives the same
    links."""
    def work(m: int) -> float:
        return sum(len(f) * (1 + n / 2 ** bin(mask).count("1")) for mask, f in _balls(list(range(BITS)), m, d))

    return min(range(max(1, d // 2), d + 2), key=work)


def _deal(rows: DataFrame, paths: dict[int, list[int]], m: int, d: int) -> tuple[DataFrame, dict[int, list[int]]]:
    """Deal ``rows(bucket, path, fp, is_table)`` to sub-buckets by segments of
    the bits that ``paths[path]`` leaves free; also the next paths."""
    after: dict[int, list[int]] = {}
    table = []
    for path, bits in paths.items():
        for mask, flips in _balls(bits, min(m, len(bits)), d):
            nxt = len(after)
            after[nxt] = [b for b in bits if not mask >> b & 1]
            table += [(path, nxt, _signed(mask), _signed(f)) for f in flips]
    # One per path, segment and flip: their number does not depend on the data.
    if len(paths) == 1:
        number = lambda x: F.lit(x).cast("long")
        each = F.array(*[F.struct(number(n).alias("next"), number(x).alias("mask"), number(f).alias("flip")) for _, n, x, f in table])
        probed = rows.select("bucket", "fp", "is_table", F.inline(each))
    else:
        probed = rows.join(F.broadcast(rows.sparkSession.createDataFrame(table, "path int, next long, mask long, flip long")), "path")
    dealt = probed.select(
        F.xxhash64("bucket", "next", F.col("fp").bitwiseAND(F.col("mask")).bitwiseXOR(F.col("flip"))).alias("bucket"),
        F.col("next").cast("int").alias("path"), "fp", (F.col("is_table") & (F.col("flip") == 0)).alias("is_table"),
    )
    return dealt, after


def _near(a: np.ndarray, b: np.ndarray, d: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= d


def _local_links(table: np.ndarray, rest: np.ndarray, d: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what links of table x (table + rest) connect, a star
    per component: a breadth-first walk whose unvisited side shrinks, so a
    dense bucket costs little more than its size."""
    left_t, left_r = np.unique(table), np.setdiff1d(rest, table)
    while len(left_t):
        seed, left_t = left_t[0], left_t[1:]
        front = [(np.array([seed]), True)]
        while front:
            nodes, is_table = front.pop()
            for i in range(0, len(nodes), 64):
                some = nodes[i : i + 64, None]
                hit = _near(some, left_t[None, :], d).any(axis=0)
                got_t, left_t = left_t[hit], left_t[~hit]
                got_r = left_r[:0]
                if is_table:
                    hit = _near(some, left_r[None, :], d).any(axis=0)
                    got_r, left_r = left_r[hit], left_r[~hit]
                for got, kind in ((got_t, True), (got_r, False)):
                    if len(got):
                        front.append((got, kind))
                        yield np.full(len(got), seed), got


def _bucket_links(bucket: np.ndarray, fp: np.ndarray, is_table: np.ndarray, d: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified links inside whole buckets (rows sorted by bucket)."""
    start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    size = np.diff(np.r_[start, len(bucket)])
    tables = np.add.reduceat(is_table.astype(np.int64), start)
    live = (tables > 0) & (size > 1)
    big = live & (tables * size > PAIR_BLOCK // 8)
    for s, n in zip(start[big], size[big]):
        f, t = fp[s : s + n], is_table[s : s + n]
        yield from _local_links(f[t], f[~t], d)
    keep = np.repeat(live & ~big, size)
    if not keep.any():
        return
    group = np.repeat(np.arange(len(start)), size)[keep]
    f, t = fp[keep], is_table[keep]
    order = np.lexsort((~t, group))
    group, f, t = group[order], f[order], t[order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    width = np.add.reduceat(t.astype(np.int64), first)
    n = np.diff(np.r_[first, len(group)])
    first, width = np.repeat(first, n), np.repeat(width, n)
    done = np.cumsum(width)
    i = 0
    while i < len(f):
        j = max(i + 1, int(np.searchsorted(done, (done[i - 1] if i else 0) + PAIR_BLOCK, "right")))
        w = width[i:j]
        left = np.repeat(np.arange(i, j), w)
        right = np.repeat(first[i:j] - np.r_[0, np.cumsum(w)[:-1]], w) + np.arange(w.sum())
        ok = (f[left] != f[right]) & _near(f[left], f[right], d)
        yield f[left[ok]], f[right[ok]]
        i = j


def _links(rows: DataFrame, d: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def links(parts):
            b, f, t = (np.concatenate(x) for x in zip(*parts))
            for x, y in _bucket_links(b, f, t, d):
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view("<i8")), pa.array(y.view("<i8"))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            b = batch.column("bucket").to_numpy(zero_copy_only=False)
            f = batch.column("fp").to_numpy(zero_copy_only=False).astype("<i8").view("<u8")
            t = batch.column("is_table").to_numpy(zero_copy_only=False).astype(bool)
            cut = int(np.searchsorted(b, b[-1], "left"))  # the last bucket may go on
            if cut or (held and held[-1][0][-1] != b[0]):
                yield from links([*held, (b[:cut], f[:cut], t[:cut])])
                held = []
            held.append((b[cut:], f[cut:], t[cut:]))
        if held:
            yield from links(held)

    dealt = rows.select("bucket", "fp", "is_table").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "a long, b long")


def near_links(fps: DataFrame, max_bits: int, segments: int | None = None, split_at: int = SPLIT_AT) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints of ``fps(fp)`` that
    connect everything linked at ``max_bits`` or fewer differing bits.

    A bucket that holds more than ``split_at`` table entries is dealt out again
    by segments of its free bits until none does. Every deal fixes about a
    third of the free bits, and ``f`` free bits leave room for 2^f entries, so
    this ends, after at most five further deals at the usual sizes.
    """
    if segments is None:
        segments = segment_count(fps.count(), max_bits)
    rows = fps.select(F.lit(0).cast("long").alias("bucket"), F.lit(0).alias("path"), "fp", F.lit(True).alias("is_table"))
    paths, out, level = {0: list(range(BITS))}, None, 0
    while True:
        rows, paths = _deal(rows, paths, segments if level == 0 else min(3, max_bits + 1), max_bits)
        count = rows.where("is_table").groupBy("bucket", "path").agg(F.count(F.lit(1)).alias("n"))
        hot = materialize(count.where(F.col("n") > split_at).select("bucket", "path"), "hot")
        again = {r["path"] for r in hot.select("path").distinct().collect()}  # of the numbered paths
        calm = rows.join(hot.select("bucket"), "bucket", "left_anti") if again else rows
        links = _links(calm, max_bits)
        out = links if out is None else out.unionByName(links)
        if not again:
            return out
        rows = rows.join(hot.select("bucket"), "bucket", "left_semi")
        if level:  # no deal starts from the first one again
            rows = materialize(rows, "dense")
        paths, level = {p: b for p, b in paths.items() if p in again}, level + 1


def simhash_groups(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text",
    segments: int | None = None, split_at: int = SPLIT_AT, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits)
    and ``component_id``, the smallest id reachable over links of at most
    ``max_bits`` differing bits. ``keep`` names further columns of ``docs`` to
    return, and with them ``group_id``, a number of the component that rows
    without an id have too.

    Defined cases: a null text is empty, an empty text has fingerprint zero
    (which links like any other); repeated rows give repeated rows; a null id
    stays null and is never a component id while its group has another; an
    empty table gives no rows; other columns are ignored.

    Fingerprints are computed row by row and written once; equal ones are
    aggregated to one node before any bucket is made, so exact copies cost one
    row. Joins are plain equi-joins, whose hot keys adaptive execution splits.
    """
    rows = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"), *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)],
            fingerprint_column(F.col(text_col), shingle).alias("fp"),
        ),
        "simhash",
    )
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-nodes")
    roots = connected_components(near_links(nodes.select("fp"), max_bits, segments, split_at))
    linked = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    best = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = linked.join(best, "root").select("fp", "component_id", "root")
    kept = [F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)]
    return rows.join(named, "fp").select(
        "doc_id", hex_column(F.col("fp")).alias("fingerprint"), "component_id", *kept, *([F.col("root").alias("group_id")] if keep else [])
    )
