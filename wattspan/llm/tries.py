"""Prefix trie of conversations: member intervals by range minima over sorted common prefixes.

``rebuilt`` puts conversations together, ``prefix_trie`` works on any frame of
(id, turn digests, turn bytes).

1. *Order.* Conversations are range-partitioned and sorted by their turns (128
   bits of SHA-256 of role and text each) and id, so the members of every prefix
   stand side by side; many equal conversations still cut into even slices. The
   slices are checkpointed. A prefix of depth d that begins at a place is a
   candidate node where the common prefix with the place before is shorter than d.
2. *Intervals.* Each slice builds sparse tables of minima over its common prefix
   lengths and ids. Each candidate searches its right end, and the left and right
   end of its parent, by itself, in halving steps over the table. Sums over
   an interval (saved bytes, leaves) are differences of running sums: a place
   saves the bytes of what it shares with the place before it.
3. *Slices.* Nodes that reach over a slice's edge are those along its first and last
   conversation. They leave the slice as partial rows, named by a digest of their
   prefix, and are summed up; all other nodes are whole. Lists of ending ids that
   cross slices travel as text pieces of a few KB and are hashed in order, one
   piece at a time.

What is held in one row are the digests of one conversation (16 bytes a turn); the
texts stay where they are read. A SHA-256 is sequential, so the ids of one node
pass one task as text pieces, never gathered.

Turns with a null number come first; equal numbers follow their digests, so
repeated rows are turns of their own. Null roles and texts are empty. Rows without
a conversation id belong to none and are left out. A table without conversations
has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from wattspan.functions.columns import qcol, require
from wattspan.llm.batches import ragged, text_buffer
from wattspan.llm.frames import broadcast_if_small, scratch
from wattspan.operators.small import checkpointed

GROUP = 5
MOST_SHARED = 9
SLICE_TURNS = 250_000
PIECE_BYTES = 4096
NODE_BYTES = 160

_NODE = ("kind int, key binary, parent_key binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
         "n_children bigint, n_leaves bigint, shared bigint, above bigint, ends string, slice int, piece int, text binary")
_CLOSED, _OPEN, _PIECE = 0, 1, 2


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """``conv_id``, ``ds`` (a digest per turn, in order) and ``bs`` (bytes of its text)."""
    require(conversations, [conv_col, turn_col, role_col, text_col])
    role, text = (F.coalesce(qcol(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    # The role's length keeps role and text apart.
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    slim = conversations.select(
        qcol(conv_col).cast("bigint").alias("conv_id"),
        F.struct(qcol(turn_col).isNotNull().alias("has"), qcol(turn_col).cast("bigint").alias("turn"),
                 F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("d"), F.octet_length(text).cast("bigint").alias("b")).alias("t"))
    lists = slim.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    return lists.select("conv_id", F.col("ts.d").alias("ds"), F.col("ts.b").alias("bs"))


def rebuilt(lists: DataFrame, group: int = GROUP, most_shared: int = MOST_SHARED) -> DataFrame:
    """Every conversation c with its first h turns taken from conversation c - c % ``group``; h = crc32(c) % ``most_shared``."""
    bases = lists.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("_base"), *[F.slice(c, 1, most_shared).alias(f"_{c}") for c in ("ds", "bs")])
    own = lists.withColumn("_h", (F.crc32(F.col("conv_id").cast("string")) % most_shared).cast("int"))
    joined = own.join(bases, F.col("conv_id") - F.col("conv_id") % group == F.col("_base"), "left")
    mixed = lambda c: F.concat(
        F.coalesce(F.slice(f"_{c}", F.lit(1), F.col("_h")), F.slice(c, 1, 0)), F.slice(c, F.col("_h") + 1, F.size(c)))
    return joined.select("conv_id", mixed("ds").alias("ds"), mixed("bs").alias("bs"))


class Minima:
    """Sparse table: least values of all windows whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            below, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(below[:-half], below[half:]))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least value of lo..hi, both included."""
        out = np.zeros(len(lo), self.levels[0].dtype)
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            own = level == k
            row = self.levels[k]
            out[own] = np.minimum(row[lo[own]], row[hi[own] + 1 - (1 << k)])
        return out

    def right(self, at: np.ndarray, depth: np.ndarray, last: int) -> np.ndarray:
        """The last place that all values behind ``at`` up to it reach ``depth``."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            row = self.levels[k]
            go = (at + (1 << k) <= last) & (at + 1 < len(row))
            go[go] = row[at[go] + 1] >= depth[go]
            at[go] += 1 << k
        return at

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place such that all values behind it up to ``at`` reach ``depth``."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            row, step = self.levels[k], 1 << k
            go = at >= step
            go[go] = row[at[go] - step + 1] >= depth[go]
            at[go] -= step
        return at


def common(digests: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Turns that each conversation shares with the one before it; the first one's is 0."""
    out = np.zeros(len(sizes), np.int64)
    if len(sizes) < 2:
        return out
    m = np.minimum(sizes[:-1], sizes[1:])
    differ = (digests[ragged(at[:-1], m)] != digests[ragged(at[1:], m)]).any(axis=1)
    row, turn = np.repeat(np.arange(len(m)), m)[differ], ragged(np.zeros(len(m), np.int64), m)[differ]
    np.minimum.at(m, row, turn)
    out[1:] = m
    return out


def _prefix_keys(digests: np.ndarray, start: int, depth: int) -> list[bytes]:
    """Digest of each prefix up to ``depth`` turns."""
    state, keys = hashlib.sha256(), []
    for d in range(depth + 1):
        keys.append(state.digest())
        if d < depth:
            state.update(digests[start + d].tobytes())
    return keys


def slice_nodes(ids, sizes, digests, bytes_, before: int, after: int, slice_: int) -> dict[str, list | np.ndarray]:
    """All nodes of one slice of sorted conversations; ``before`` and ``after`` are what it shares with its neighbours (-1: none)."""
    n, at = len(ids), np.cumsum(sizes) - sizes
    total = np.concatenate([[0], np.cumsum(bytes_)])
    lcp = np.append(common(digests, at, sizes), after)
    lcp[0] = before
    # The first place also goes on with nodes of the slice before.
    low = lcp[:n] + 1
    low[0] = 0
    many = np.maximum(sizes - low + 1, 0)
    base = np.cumsum(many) - many
    p, d = np.repeat(np.arange(n), many), ragged(low, many)
    prefix, smallest = Minima(lcp[:n]), Minima(ids)
    right = prefix.right(p, d, n - 1)
    conv = smallest.least(p, right)
    inner = (d > low[p]) | (p == 0)
    up = p.copy()
    up[~inner] = prefix.left(p[~inner], d[~inner] - 1)
    parent = np.where(d > 0, base[up] + d - 1 - low[up], -1)
    continued = (p == 0) & (d <= before)
    open_ = continued | ((right == n - 1) & (d <= after))
    children = np.zeros(len(p), np.int64)
    np.add.at(children, parent[(d > 0) & ~continued], 1)
    sums = lambda x: np.concatenate([[0], np.cumsum(x)])
    to = lambda row, turn: total[at[row] + turn] - total[at[row]]
    kept = sums(to(np.arange(n), np.maximum(lcp[:n], 0)))
    shared = kept[right + 1] - kept[p + ~continued]
    above = to(p, np.maximum(d - 1, 0))
    ends = sums(lcp[1:] < sizes)
    # Equal conversations in a row end in one node.
    same = np.zeros(n, bool)
    same[1:] = (lcp[1:n] == sizes[1:]) & (sizes[1:] == sizes[:-1])
    first = np.flatnonzero(~same)
    stop = np.append(first[1:], n)
    stops = dict(zip(first.tolist(), stop.tolist()))
    names = np.char.mod("%d", ids) if n else np.zeros(0, str)
    nothing = hashlib.sha256().hexdigest()
    digest = [nothing] * len(p)
    keys: list[bytes | None] = [None] * len(p)
    head, tail = _prefix_keys(digests, 0, max(before, 0)), _prefix_keys(digests, int(at[-1]), max(after, 0))
    for i in np.flatnonzero(open_).tolist():
        keys[i] = head[d[i]] if continued[i] else tail[d[i]]
    pieces: list[tuple[bytes, int, bytes]] = []
    for i in np.flatnonzero(d == sizes[p]).tolist():
        text = ",".join(names[p[i]:stops[int(p[i])]]).encode()
        if open_[i]:
            pieces += [(keys[i], k, text[lo:lo + PIECE_BYTES]) for k, lo in enumerate(range(0, len(text), PIECE_BYTES))]
        else:
            digest[i] = hashlib.sha256(text).hexdigest()
    has = parent >= 0
    parent_open = has & open_[parent]
    parent_keys = [keys[k] if o else None for k, o in zip(parent.tolist(), parent_open.tolist())]
    for i in np.flatnonzero(open_ & (d > 0)).tolist():
        parent_keys[i] = head[d[i] - 1] if continued[i] else tail[d[i] - 1]
    blank = [None] * len(pieces)
    wide = lambda x: pa.concat_arrays([pa.array(x, pa.int64()), pa.nulls(len(pieces), pa.int64())])
    return {
        "kind": pa.array(np.concatenate([np.where(open_, _OPEN, _CLOSED), np.full(len(pieces), _PIECE)]).astype(np.int32)),
        "key": pa.array(keys + [x[0] for x in pieces], pa.binary()), "parent_key": pa.array(parent_keys + blank, pa.binary()),
        "conv_id": wide(conv), "depth": wide(d),
        "parent_conv_id": pa.concat_arrays([pa.array(conv[parent], pa.int64(), mask=~has | parent_open), pa.nulls(len(pieces), pa.int64())]),
        "n_convs": wide(right - p + 1), "n_children": wide(children), "n_leaves": wide(ends[right + 1] - ends[p]),
        "shared": wide(shared), "above": wide(above), "ends": pa.array(digest + blank, pa.string()),
        "slice": pa.array(np.full(len(p) + len(pieces), slice_, np.int32)),
        "piece": pa.array([None] * len(p) + [x[1] for x in pieces], pa.int32()),
        "text": pa.array([None] * len(p) + [x[2] for x in pieces], pa.binary()),
    }


def _nodes(batches):
    table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if table is None or not len(table):
        return
    table = table.combine_chunks()
    lists = table.column("ds").combine_chunks()
    data, _ = text_buffer(lists.flatten())
    sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    got = slice_nodes(
        table.column("conv_id").to_numpy(), sizes, np.ascontiguousarray(data).view(np.uint64).reshape(-1, 2),
        table.column("bs").combine_chunks().flatten().to_numpy(), table.column("before")[0].as_py(),
        table.column("after")[0].as_py(), table.column("_slice")[0].as_py())
    whole = pa.RecordBatch.from_pydict(got)
    for lo in range(0, len(whole), 50_000):
        yield whole.slice(lo, 50_000)


def _digests(batches):
    """SHA-256 of each key's pieces, in order and joined by commas where a slice's list begins."""
    key, state = None, None
    out = lambda: pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "ends": [state.hexdigest()]})
    for batch in batches:
        for k, piece, text in zip(*(batch.column(c).to_pylist() for c in ("key", "piece", "text"))):
            if k != key:
                if key is not None:
                    yield out()
                key, state = k, hashlib.sha256()
            elif piece == 0:
                state.update(b",")
            state.update(text)
    if key is not None:
        yield out()


def prefix_trie(lists: DataFrame, slices: int | None = None) -> DataFrame:
    """One row per node of the trie of (``conv_id``, ``ds``, ``bs``).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (bytes of texts of the node's subtree that more than one member holds, once less than they do) and
    ``ends_sha256`` (of the ids of members that end here, ascending, comma-joined).
    """
    spark = lists.sparkSession
    if slices is None:
        many = lists.agg(F.sum(F.size("ds"))).first()[0] or 0
        slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-many // SLICE_TURNS))
    arranged = checkpointed(
        lists.repartitionByRange(slices, "ds", "conv_id").sortWithinPartitions("ds", "conv_id")
        .withColumn("_at", F.monotonically_increasing_id()).withColumn("_slice", F.spark_partition_id()))
    # One row per slice from here to the broadcast.
    edges = arranged.groupBy("_slice").agg(F.min_by("ds", "_at").alias("head"), F.max_by("ds", "_at").alias("tail"))
    order = W.orderBy("_slice")
    meets = F.zip_with(F.lag("tail").over(order), "head", lambda x, y: x.eqNullSafe(y))
    ahead = edges.select("_slice", meets.alias("m"))
    unlike = F.array_position("m", False)
    before = ahead.select("_slice", F.coalesce(
        F.when(unlike == 0, F.size("m")).otherwise(unlike - 1), F.lit(-1)).cast("bigint").alias("before"))
    sides = before.withColumn("after", F.coalesce(F.lead("before").over(order), F.lit(-1).cast("bigint")))
    made = arranged.drop("_at").join(F.broadcast(sides), "_slice")
    nodes = scratch(made.select("_slice", "conv_id", "ds", "bs", "before", "after").mapInArrow(_nodes, _NODE), "trie")
    closed, parts, pieces = (nodes.filter(F.col("kind") == k) for k in (_CLOSED, _OPEN, _PIECE))
    ends = pieces.select("key", "slice", "piece", "text").repartition("key").sortWithinPartitions("key", "slice", "piece").select(
        "key", "piece", "text").mapInArrow(_digests, "key binary, ends string")
    opened = parts.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "shared")], F.max("above").alias("above"))
    opened = scratch(opened.join(ends, "key", "left").withColumn("ends", F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256))),
                     "open-nodes")
    parents = broadcast_if_small(opened.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_p")), opened.count(), NODE_BYTES)
    hung = lambda df: df.join(parents, "parent_key").withColumn("parent_conv_id", F.col("_p"))
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "shared", "above", "ends"]
    root = opened.withColumn("parent_conv_id", F.lit(None).cast("bigint")).filter("parent_key IS NULL")
    out = closed.filter("parent_key IS NULL").select(*cols)
    for more in (hung(closed.filter("parent_key IS NOT NULL")), hung(opened.filter("parent_key IS NOT NULL")), root):
        out = out.unionAll(more.select(*cols))
    saved = (F.col("shared") - (F.col("n_convs") - 1) * F.col("above")).alias("saved_tokens")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", saved, F.col("ends").alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, slices: int | None = None) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return prefix_trie(scratch(rebuilt(scratch(turns(conversations), "turns")), "rebuilt"), slices)
