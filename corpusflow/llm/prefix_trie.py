"""Prefix trie of conversations as sharded tables under minimal perfect hashes.

A node is a distinct sequence of first turns. Its key is a 128-bit digest, the
running sum of hashes of (position, turn) along the conversation, so that
conversations of any length are cut across tasks and a parent's digest is the
node's own less one turn. Rows that share a digest must agree on parent, depth
and turn, else everything is keyed anew with another seed.

Nodes above more than ``CUT`` turn rows form the top; what hangs below it are
subtrees of bounded size, dealt to shards. A shard gives every node a slot by a
minimal perfect hash whose table holds the whole digests, scatters counts into
flat arrays and adds them up through the parents' slots, deepest level first.
The top, where one long conversation can stand as a chain of any length, is
taken as chains (nodes with the same smallest member): whole chains are added up
in one small table, and sums inside a chain are distributed running sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusflow.plans.strategy import bounded_broadcast, dense_position, materialize, running_sum

#: Turn rows at or below a node from which on it belongs to the top, and nodes
#: of a shard.
CUT = 32_768
#: Characters of one piece of a joined id list.
PIECE = 1 << 20
LOW32 = (1 << 32) - 1
_SUMS = ["s0", "s1", "s2", "s3"]


class PerfectTable:
    """Slots 0..n-1 for n distinct 128-bit keys. Each level hashes the keys
    still without a slot to twice as many places; a key alone on its place
    takes the next slot. Only keys equal to the stored one are found."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        n = len(hi)
        self.slot = np.full(n, -1)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        todo, base = np.arange(n), 0
        while len(todo):
            if len(self.levels) > 60:
                raise ValueError("repeated keys")
            place = _mix(hi[todo], lo[todo], len(self.levels)) % np.uint64(2 * len(todo))
            alone = np.bincount(place.astype(np.int64), minlength=2 * len(todo)) == 1
            rank = np.cumsum(alone) - 1 + base
            self.levels.append((alone, rank))
            done = alone[place]
            self.slot[todo[done]] = rank[place[done]]
            base += int(alone.sum())
            todo = todo[~done]
        self.hi, self.lo = np.empty(n, np.int64), np.empty(n, np.int64)
        self.hi[self.slot], self.lo[self.slot] = hi, lo

    def find(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that are not in the table."""
        out = np.full(len(hi), -1)
        todo = np.arange(len(hi))
        for i, (alone, rank) in enumerate(self.levels):
            place = _mix(hi[todo], lo[todo], i) % np.uint64(len(alone))
            hit = alone[place]
            at, slot = todo[hit], rank[place[hit]]
            same = (self.hi[slot] == hi[at]) & (self.lo[slot] == lo[at])
            out[at[same]] = slot[same]
            todo = todo[~hit]
        return out


def _mix(hi: np.ndarray, lo: np.ndarray, seed: int) -> np.ndarray:
    x = hi.view(np.uint64) ^ (lo.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xD1B54A32D192ED03 % (1 << 64)))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def add_up(parent: np.ndarray, depth: np.ndarray, values: list[np.ndarray]) -> None:
    """Add every slot's values to its parent's, the deepest level first."""
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[parent[level] >= 0]
        for v in values:
            np.add.at(v, parent[level], v[level])


def _hex_long(hex_digits: Column, start: int) -> Column:
    """60 bits of a hex digest."""
    return F.conv(F.substring(hex_digits, start, 15), 16, 10).cast("long")


def turn_rows(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``position`` (from 1), ``c1``, ``c2`` (120 bits of the
    SHA-256 of role and text) and ``n_bytes`` of the text, written once. Turns
    are ordered by number, a null first, equal numbers by role and digest; null
    role or text is empty; turns of a null conversation take no part."""
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    sha = F.sha2(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t), 256)
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), r.alias("role"), sha.alias("sha"),
        F.octet_length(t).cast("long").alias("n_bytes"),
    )
    placed = dense_position(rows, ["conv_id"], ["turn", "role", "sha"])
    return materialize(placed.select("conv_id", "position", _hex_long(F.col("sha"), 1).alias("c1"), _hex_long(F.col("sha"), 16).alias("c2"), "n_bytes"), "turns")


def graft(rows: DataFrame, every: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversation c starts with the first h turns of conversation c - c %
    ``every`` and goes on with its own after the first h; h is crc32 of c as
    text, modulo ``heads``. Returns the turn rows and (``conv_id``, ``n``), one
    row per conversation, also those that are left without a turn."""
    c = F.col("conv_id")
    own = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    own = own.select("conv_id", "own", (c - c % every).alias("base"), (F.crc32(c.cast("string").cast("binary")) % heads).alias("h"))
    own = materialize(own, "convs")
    stems = own.select(F.col("conv_id").alias("base"), F.col("own").alias("stem"))
    convs = own.join(stems, "base", "left").withColumn("kept", F.least("h", F.coalesce("stem", F.lit(0))))
    convs = materialize(convs.withColumn("n", F.col("kept") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "convs")
    first = rows.where((F.col("position") < heads) & (c % every == 0)).withColumnRenamed("conv_id", "base")
    head = convs.join(first, "base").where("position <= h").select("conv_id", "position", "c1", "c2", "n_bytes")
    tail = rows.join(convs, "conv_id").where("position > h").withColumn("position", F.col("position") - F.col("h") + F.col("kept"))
    return head.unionByName(tail.select("conv_id", "position", "c1", "c2", "n_bytes")), convs.select("conv_id", "n")


def prefix_rows(rows: DataFrame, convs: DataFrame, seed: int) -> DataFrame:
    """Every turn with the digest (``hi``, ``lo``) of the prefix it ends, its
    parent's (``phi``, ``plo``), ``depth``, ``n`` turns of its conversation and
    ``check``, a hash of all that must agree where digests are equal."""
    h0, h1 = (F.xxhash64(F.lit(f"{seed}.{i}"), "position", "c1", "c2") for i in (0, 1))
    parts = [h0.bitwiseAND(LOW32), F.shiftrightunsigned(h0, 32), h1.bitwiseAND(LOW32), F.shiftrightunsigned(h1, 32)]
    keyed = rows.select("*", *(p.alias(f"t{i}") for i, p in enumerate(parts)))
    keyed = keyed.repartitionByRange("conv_id", "position").sortWithinPartitions("conv_id", "position")
    out = "conv_id long, position long, c1 long, c2 long, n_bytes long, t0 long, t1 long, t2 long, t3 long, s0 long, s1 long, s2 long, s3 long, task int"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Running sums inside the task's slice of each conversation."""
        task, last, carry = TaskContext.get().partitionId(), None, np.zeros(4, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("conv_id").to_numpy(zero_copy_only=False)
            t = np.stack([batch.column(f"t{i}").to_numpy(zero_copy_only=False) for i in range(4)])
            run = np.cumsum(t, axis=1)
            new = np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1])
            length = np.diff(np.concatenate([new, [len(ids)]]))
            before = run[:, new] - t[:, new]
            if ids[0] == last:
                before[:, 0] -= carry
            run -= np.repeat(before, length, axis=1)
            last, carry = ids[-1], run[:, -1].copy()
            arrays = [*batch.columns, *(pa.array(x) for x in run), pa.array(np.full(len(ids), task, np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, *_SUMS, "task"])

    s = materialize(keyed.select("conv_id", "position", "c1", "c2", "n_bytes", "t0", "t1", "t2", "t3").mapInArrow(sums, out), "prefixes")
    slices = s.groupBy("conv_id", "task").agg(*(F.max(c).alias(c) for c in _SUMS))
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    earlier = slices.select("conv_id", "task", *(F.sum(c).over(before).alias(f"{c}_") for c in _SUMS)).where("s0_ is not null")
    earlier, _ = bounded_broadcast(earlier)  # only conversations that span tasks
    s = s.join(earlier, ["conv_id", "task"], "left").join(convs, "conv_id")
    full = [F.col(c) + F.coalesce(f"{c}_", F.lit(0)) for c in _SUMS]

    def key(a: Column, b: Column) -> Column:
        return F.shiftleft(a.bitwiseAND(LOW32), 32).bitwiseOR(b.bitwiseAND(LOW32))

    less = [x - F.col(f"t{i}") for i, x in enumerate(full)]
    s = s.select(
        "conv_id", F.col("position").alias("depth"), "n", "n_bytes", "c1", "c2", key(full[0], full[1]).alias("hi"), key(full[2], full[3]).alias("lo"),
        key(less[0], less[1]).alias("phi"), key(less[2], less[3]).alias("plo"),
    )
    return materialize(s.withColumn("check", F.xxhash64("phi", "plo", "depth", "c1", "c2")).drop("c1", "c2"), "prefixes")


def node_table(rows: DataFrame) -> DataFrame:
    """One row per digest, with the smallest and largest ``check``."""
    return materialize(
        rows.groupBy("hi", "lo").agg(
            F.max("phi").alias("phi"), F.max("plo").alias("plo"), F.max("depth").alias("depth"), F.max("n_bytes").alias("n_bytes"),
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("n") - F.col("depth") + 1).alias("weight"),
            F.min("check").alias("c_min"), F.max("check").alias("c_max"),
        ),
        "nodes",
    )


def ends(rows: DataFrame) -> DataFrame:
    """``hi``, ``lo`` and the SHA-256 of the ascending ids (``conv_id``),
    comma-joined. A range-partitioned sort deals even the ids of one node to
    many tasks, each of which joins its share into pieces; the hash then runs
    over the pieces of a node, holding one at a time."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, size = None, [], 0
        out: list[tuple] = []

        def close():
            out.append((*key, ids[0], ",".join(map(str, ids))))

        for batch in batches:
            for hi, lo, i in zip(*(batch.column(c).to_pylist() for c in ("hi", "lo", "conv_id"))):
                if (hi, lo) != key or size >= PIECE:
                    if ids:
                        close()
                    key, ids, size = (hi, lo), [], 0
                ids.append(i)
                size += 20
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["hi", "lo", "first", "ids"])
                out = []
        if ids:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["hi", "lo", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            out = []
            for hi, lo, ids in zip(*(batch.column(c).to_pylist() for c in ("hi", "lo", "ids"))):
                if (hi, lo) == key:
                    sha.update(b"," + ids.encode())
                else:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (hi, lo), hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["hi", "lo", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_pydict({"hi": [key[0]], "lo": [key[1]], "ends_sha256": [sha.hexdigest()]})

    keys = ["hi", "lo", "conv_id"]
    pieces = rows.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(join, "hi long, lo long, first long, ids string")
    return pieces.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "first").mapInArrow(digest, "hi long, lo long, ends_sha256 string")


_NODE = "hi long, lo long, phi long, plo long, conv_id long, parent_conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes sorted by shard: the finished rows of one shard at a time. A
    node whose parent is not in its shard has no ``parent_conv_id`` yet."""
    names = ["hi", "lo", "phi", "plo", "conv_id", "depth", "n_convs", "n_bytes"]

    def finish(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        hi, lo, phi, plo, conv, depth, convs, size = (np.concatenate(x) for x in zip(*parts))
        table = PerfectTable(hi, lo)
        slot = table.slot
        n = len(slot)

        def scatter(x: np.ndarray) -> np.ndarray:
            out = np.empty(n, x.dtype)
            out[slot] = x
            return out

        phi, plo, conv, depth, convs, size = map(scatter, (phi, plo, conv, depth, convs, size))
        parent = table.find(phi, plo)
        inside = parent >= 0
        children = np.bincount(parent[inside], minlength=n)
        leaves, saved = (children == 0).astype(np.int64), (convs - 1) * size
        add_up(parent, depth, [leaves, saved])
        above = pa.array(conv[np.maximum(parent, 0)], mask=~inside)
        arrays = [table.hi, table.lo, phi, plo, conv, above, depth, convs, children, leaves, saved]
        return pa.RecordBatch.from_arrays([pa.array(a) if isinstance(a, np.ndarray) else a for a in arrays], [f.split()[0] for f in _NODE.split(", ")])

    key, parts = None, []
    for batch in batches:
        shard = batch.column("shard").to_numpy(zero_copy_only=False)
        cut = np.flatnonzero(np.diff(shard)) + 1
        for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(shard)]):
            if s == e:
                continue
            if shard[s] != key:
                if parts:
                    yield finish(parts)
                key, parts = shard[s], []
            parts.append([batch.column(c).slice(s, e - s).to_numpy(zero_copy_only=False) for c in names])
    if parts:
        yield finish(parts)


def chain_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains of the top with what hangs below them added up."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    names = ["chain", "parent", "depth", "leaves", "saved"]
    chain, parent, depth, leaves, saved = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in got]) for c in names)
    order = np.argsort(chain)
    chain, parent, depth, leaves, saved = (x[order] for x in (chain, parent, depth, leaves.copy(), saved.copy()))
    at = np.searchsorted(chain, parent)
    at[parent == chain] = -1  # the chain of the root
    add_up(at, depth, [leaves, saved])
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (parent, depth - 1, leaves, saved)], ["conv_id", "depth", "leaves", "saved"]).filter(pa.array(at >= 0))


def top_nodes(top: DataFrame, hanging: DataFrame) -> DataFrame:
    """The finished rows of the top; ``hanging`` are the sums of the subtrees
    right below each of its nodes (``hi``, ``lo``, ``kids``, ``leaves``,
    ``saved``). Number of chains: see the module."""
    up = top.select(F.col("hi").alias("phi"), F.col("lo").alias("plo"), F.col("conv_id").alias("parent_conv_id"))
    inner = top.where("depth > 0").groupBy(F.col("phi").alias("hi"), F.col("plo").alias("lo")).agg(F.count(F.lit(1)).alias("inner"))
    t = top.join(up, ["phi", "plo"], "left").join(hanging, ["hi", "lo"], "left").join(inner, ["hi", "lo"], "left").na.fill(0, ["kids", "leaves", "saved", "inner"])
    t = t.withColumn("n_children", F.col("kids") + F.col("inner"))
    t = t.withColumn("leaves", F.col("leaves") + (F.col("n_children") == 0).cast("long"))
    t = t.withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("n_bytes"))
    t = t.withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("parent_conv_id")))
    t = materialize(t, "top")
    first = (F.col("depth") == 0) | (F.col("parent_conv_id") != F.col("conv_id"))
    chains = t.groupBy(F.col("conv_id").alias("chain")).agg(
        F.max(F.when(first, F.coalesce("parent_conv_id", "conv_id"))).alias("parent"), F.min("depth").alias("depth"),
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
    )
    hung = chains.coalesce(1).mapInArrow(chain_totals, "conv_id long, depth long, leaves long, saved long")
    hung = hung.groupBy("conv_id", "depth").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    t = t.join(hung, ["conv_id", "depth"], "left").na.fill(0, ["more_leaves", "more_saved"])
    t = t.withColumn("leaves", F.col("leaves") + F.col("more_leaves")).withColumn("saved", F.col("saved") + F.col("more_saved"))
    t = t.withColumn("up", -F.col("depth"))
    t = running_sum(running_sum(t, ["conv_id"], ["up"], "leaves", "n_leaves"), ["conv_id"], ["up"], "saved", "saved_tokens")
    return t.select(*(f.split()[0] for f in _NODE.split(", ")))


def prefix_nodes(rows: DataFrame, convs: DataFrame, cut: int = CUT) -> DataFrame:
    """The trie of the conversations whose turns are ``rows`` (as of
    ``turn_rows``); ``convs`` holds every conversation's ``conv_id`` and number
    ``n`` of turns. One row per node: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``, all as the contract has them.

    Defined cases: a conversation without turns is a member of the root alone;
    no conversation at all gives no node; the root has no parent and no text.
    """
    convs = materialize(convs, "convs")
    whole = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("n").alias("turns")).first()
    if not whole["n_convs"]:
        return rows.sparkSession.createDataFrame([], ", ".join(f for f in _NODE.split(", ")[4:]) + ", ends_sha256 string")
    rows = materialize(rows, "rebuilt")
    for seed in range(64):
        prefixes = prefix_rows(rows, convs, seed)
        nodes = node_table(prefixes)
        if not nodes.where("c_min != c_max or (hi = 0 and lo = 0)").head(1):
            break
    else:
        raise RuntimeError("no seed without a collision")
    zero = F.lit(0).cast("long")
    root = convs.limit(1).select(
        zero.alias("hi"), zero.alias("lo"), zero.alias("phi"), zero.alias("plo"), zero.alias("depth"), zero.alias("n_bytes"),
        F.lit(whole["conv_id"]).alias("conv_id"), F.lit(whole["n_convs"]).alias("n_convs"),
    )
    heavy = F.col("weight") > cut
    top = materialize(nodes.where(heavy).select(root.columns).unionByName(root), "top")
    keys, _ = bounded_broadcast(top.select("hi", "lo", F.lit(True).alias("in_top")))
    # A conversation's first turn below the top names the subtree of its nodes.
    place = prefixes.join(keys, ["hi", "lo"], "left").where("in_top is null").groupBy("conv_id").agg(F.min(F.struct("depth", "hi", "lo")).alias("sub"))
    n_shards = -(-nodes.count() // cut) or 1
    place = place.select("conv_id", F.pmod(F.xxhash64("sub.hi", "sub.lo"), F.lit(n_shards)).alias("shard"))
    below = nodes.where(~heavy).join(place, "conv_id").select("shard", "hi", "lo", "phi", "plo", "conv_id", "depth", "n_convs", "n_bytes")
    below = materialize(below.repartition("shard").sortWithinPartitions("shard").mapInArrow(shard_nodes, _NODE), "below")
    hanging = below.where("parent_conv_id is null").groupBy(F.col("phi").alias("hi"), F.col("plo").alias("lo")).agg(
        F.count(F.lit(1)).alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    upper, _ = bounded_broadcast(top.select(F.col("hi").alias("phi"), F.col("lo").alias("plo"), F.col("conv_id").alias("above")))
    below = below.join(upper, ["phi", "plo"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).drop("above")
    done = prefixes.where(F.col("depth") == F.col("n")).select("hi", "lo", "conv_id")
    done = done.unionByName(convs.where("n = 0").select(zero.alias("hi"), zero.alias("lo"), "conv_id"))
    out = below.unionByName(top_nodes(top, hanging)).join(ends(done), ["hi", "lo"], "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select(*(f.split()[0] for f in _NODE.split(", ")[4:]), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
