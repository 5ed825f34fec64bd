"""Removal of repeated substrings with suffix arrays over shards of the corpus.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts earlier
(in a smaller id, or before it in the same text). Strings are judged on the
input, as bytes, inside one text.

1. *Anchors.* Of the ``GRAM``-byte grams in a string, the one with the smallest
   hash is its anchor, so equal strings have equal anchors at equal distance.
   Consecutive strings with one anchor are a piece. Pieces are ten times fewer
   than bytes, and only hashes and places of them are shuffled: a piece whose
   anchor occurs nowhere else holds no repeated string. Equal pieces are folded
   in their task before that, and again behind the shuffle; all but the first
   are repeats from end to end.
2. *Shards.* The different pieces of one anchor go, with their bytes, to one
   shard, since equal strings share their anchor. A task works through its
   pieces in shards of about ``SHARD_BYTES``: an induced suffix sort, permuted
   common prefixes, and groups of suffixes that share ``LENGTH`` bytes. In each
   group all but the earliest are repeats. An anchor with over ``MOST_PIECES``
   different pieces would not fit one shard; its strings are grouped by their
   bytes instead, with partial aggregation.
3. *Spans.* Repeats are joined per document and cut out.

Pieces are compared by a 64-bit hash beside the 64-bit hash of their anchor in
step 1; step 2 compares bytes.

Null and empty texts have 0 bytes and lose nothing; texts shorter than
``LENGTH`` stay. A null id counts as smaller than any other. Rows that repeat an
id are taken for copies of one document: they don't count as earlier than each
other and get the same spans. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattspan.functions.columns import qcol
from wattspan.llm.batches import Prefix, mix, ragged, slices, text_buffer
from wattspan.llm.frames import scratch, texts
from wattspan.llm.suffixes import permuted_prefixes, suffix_array

LENGTH = 100
GRAM = 24
SHARD_BYTES = 4 << 20
SEGMENT_BYTES = 2 << 20
FOLD_ROWS = 2 << 20
MOST_PIECES = 50_000
NO_ID = -(1 << 63)
_PLACE_BITS = 22

_U = np.uint64
_PIECE = pa.schema([("a", pa.int64()), ("p", pa.int64()), ("d", pa.int64()), ("s", pa.int64()), ("n", pa.int32())])


def segments(data: np.ndarray, off: np.ndarray):
    """Bytes and text bounds of parts of bounded size; a longer text is cut with an overlap."""
    if len(data) <= 2 * SEGMENT_BYTES - LENGTH or len(off) > 2:
        yield 0, data, off
        return
    for at in range(0, len(data), SEGMENT_BYTES):
        part = data[at:at + SEGMENT_BYTES + LENGTH - 1]
        yield at, part, np.array([0, len(part)])


def pieces(data: np.ndarray, off: np.ndarray):
    """Text, first string's start, number of strings, anchor hash and piece hash of all pieces."""
    width = LENGTH - GRAM + 1
    lengths = np.maximum(np.diff(off) - LENGTH + 1, 0)
    if not lengths.sum():
        return None
    prefix = Prefix(data)
    grams = np.arange(len(data) - GRAM + 1)
    g = prefix.of(grams, grams + GRAM)
    mask = _U((1 << _PLACE_BITS) - 1)
    keys = (g & ~mask) | grams.astype(_U)
    # Smallest key in each window, from blocks of the window's width.
    blocks = -(-len(keys) // width) + 1
    room = np.full(blocks * width, ~_U(0), _U)
    room[:len(keys)] = keys
    table = room.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    start = ragged(off[:-1], lengths)
    anchor = (np.minimum(behind[start], ahead[start + width - 1]) & mask).astype(np.int64)
    first = np.ones(len(start), bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(first)
    n = np.diff(np.append(at, len(start)))
    s = start[at]
    text = np.searchsorted(off, s, side="right") - 1
    return text, s, n, g[anchor[at]], prefix.of(s, s + n + LENGTH - 1)


def _joined(d: np.ndarray, s: np.ndarray, e: np.ndarray):
    """Overlapping or touching spans of one document as one."""
    order = np.lexsort((s, d))
    d, s, e = d[order], s[order], e[order]
    # Ends so far, restarted with each document.
    doc = np.cumsum(np.concatenate([[0], d[1:] != d[:-1]])) if len(d) else np.zeros(0, np.int64)
    shift = doc * (1 << 40)
    reach = np.maximum.accumulate(e + shift) if len(d) else e
    first = np.ones(len(d), bool)
    first[1:] = (s + shift)[1:] > reach[:-1]
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(d)) - 1
    return d[at], s[at], (reach[last] - shift[last]) if len(at) else e[at]


def _anchored(batches):
    """Pieces of a task; equal ones are folded into the first, and the others are spans already (n below 0)."""
    held: list[tuple] = []
    rows = 0

    def folded():
        a, p, d, s, n = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order = np.lexsort((s, d, p, a))
        a, p, d, s, n = a[order], p[order], d[order], s[order], n[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (p[1:] != p[:-1])
        # Rows that repeat an id have the same place; they are no repeats of each other.
        head = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
        copy = ~new & ((d != d[head]) | (s != s[head]))
        sd, ss, se = _joined(d[copy], s[copy], s[copy] + n[copy] + LENGTH - 1)
        # The spans are spread over the same partitions.
        spread = mix(sd.view(_U) ^ ss.view(_U)).view(np.int64)
        for x in ((a[new].view(np.int64), p[new].view(np.int64), d[new], s[new], n[new]),
                  (spread, np.zeros(len(sd), np.int64), sd, ss, ss - se)):
            for k in range(0, len(x[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[k:k + (1 << 16)], t) for c, t in zip(x, _PIECE.types)], schema=_PIECE)

    for batch in batches:
        for lo, hi, data, off in slices(batch.column("_text")):
            ids = batch.column("_id").slice(lo, hi - lo).to_numpy(zero_copy_only=False)
            for at, part, bounds in segments(data, off):
                got = pieces(part, bounds)
                if got is None:
                    continue
                text, s, n, a, p = got
                held.append((a, p, ids[text], s - bounds[text] + at, n))
                rows += len(a)
        if rows >= FOLD_ROWS:
            yield from folded()
            rows = 0
    if held:
        yield from folded()


def _groups(batches, key: str):
    """Record batches cut so that no run of equal keys is split; rows arrive in key order."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy()
        if held and held[-1].column(key)[-1].as_py() == k[-1]:
            held.append(batch)
            continue
        cut = len(k) - int((k == k[-1]).sum())
        if held or cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _resolved(batches):
    """Spans of repeated equal pieces, and the different pieces of anchors that have several.

    Rows arrive by anchor, piece and place. Only the last first piece is held, until the next one shows whether its
    anchor has another.
    """
    held = None  # a, p, d, s, n of the last first piece, and whether its anchor had one before
    for batch in batches:
        a, p, d, s, n = (batch.column(c).to_numpy() for c in ("a", "p", "d", "s", "n"))
        n = n.astype(np.int64)
        done = n <= 0
        spans = [(d[done], s[done], s[done] - n[done])]
        a, p, d, s, n = (x[~done] for x in (a, p, d, s, n))
        fresh = held is None
        if held is not None:
            a, p, d, s, n = (np.insert(x, 0, v) for x, v in zip((a, p, d, s, n), held))
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (p[1:] != p[:-1])
        first = np.flatnonzero(new)
        head = np.repeat(first, np.diff(np.append(first, len(a))))
        # Rows that repeat an id have the same place; they are no repeats of each other.
        copy = (d != d[head]) | (s != s[head])
        spans.append((d[copy], s[copy], s[copy] + n[copy] + LENGTH - 1))
        sd, ss, se = _joined(*(np.concatenate(x) for x in zip(*spans)))
        a, d, s, n, p = a[first], d[first], s[first], n[first], p[first]
        same = a[1:] == a[:-1]
        before = np.concatenate([[False if fresh else held[5]], same]) if len(a) else np.zeros(0, bool)
        beside = before.copy()
        beside[:-1] |= same
        if len(a):
            held = (a[-1], p[-1], d[-1], s[-1], n[-1], bool(before[-1]))
            a, d, s, n = (x[:-1][beside[:-1]] for x in (a, d, s, n))
        yield _marks(sd, ss, se, a, d, s, n)
    if held is not None and held[5]:
        a, _, d, s, n, _ = (np.array([x]) for x in held)
        none = d[:0]
        yield _marks(none, none, none, a, d, s, n)


def _marks(sd, ss, se, a, d, s, n) -> pa.RecordBatch:
    """Spans (``a`` null) and pieces to compare."""
    return pa.RecordBatch.from_pydict({
        "d": np.concatenate([sd, d]), "s": np.concatenate([ss, s]), "e": np.concatenate([se, s + n + LENGTH - 1]),
        "a": pa.array(np.concatenate([np.zeros(len(sd), np.int64), a]), pa.int64(), mask=np.arange(len(sd) + len(a)) < len(sd)),
    })


def _cut(batches):
    """Bytes of the wanted pieces."""
    for batch in batches:
        data, off = text_buffer(batch.column("_text"))
        raw = data.tobytes()
        wanted = batch.column("wanted")
        inner = wanted.values
        s, e, a = (inner.field(k).to_numpy() for k in range(3))
        bounds = wanted.offsets.to_numpy()
        doc = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
        part = slice(bounds[0], bounds[-1])
        s, e, a = s[part], e[part], a[part]
        for k in range(0, len(s), 1 << 16):
            own = slice(k, k + (1 << 16))
            base = off[doc[own]]
            yield pa.RecordBatch.from_pydict({
                "a": a[own], "d": batch.column("_id").take(pa.array(doc[own])), "s": s[own],
                "bytes": pa.array([raw[x:y] for x, y in zip((base + s[own]).tolist(), (base + e[own]).tolist())], pa.binary()),
            })


def shard_spans(raw: np.ndarray, off: np.ndarray, d: np.ndarray, s: np.ndarray):
    """Spans (d, start, end) of strings that also start earlier, among pieces with their bytes."""
    many = len(d)
    lengths = np.diff(off)
    # Bytes from 2 on, a 1 behind each piece, and one 0 at the end.
    text = np.empty(len(raw) + many + 1, np.uint16)
    begin = off[:-1] + np.arange(many)
    text[ragged(begin, lengths)] = raw[ragged(off[:-1], lengths)].astype(np.uint16) + np.uint16(2)
    text[begin + lengths] = 1
    text[-1] = 0
    sa = suffix_array(text, 258)
    longest = int(lengths.max())
    prefix = permuted_prefixes(text, sa, begin, longest + LENGTH + 8)
    group = np.cumsum(prefix[sa] < LENGTH)
    # Only strings that end inside their piece.
    place = np.full(len(text), -1, np.int64)
    starts = np.maximum(lengths - LENGTH + 1, 0)
    own = ragged(begin, starts)
    place[own] = np.repeat(np.arange(many), starts)
    keep = place[sa] >= 0
    at, group = sa[keep], group[keep]
    piece = place[at]
    pos = s[piece] + at - begin[piece]
    _, rank = np.unique(d, return_inverse=True)
    # Order of occurrences as one number; a place in a text stays below 2^40.
    order = rank[piece].astype(np.int64) << 40 | pos
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    if not len(first):
        return d[:0], s[:0], s[:0]
    least = np.repeat(np.minimum.reduceat(order, first), np.diff(np.append(first, len(group))))
    gone = order > least
    return _joined(d[piece[gone]], pos[gone], pos[gone] + LENGTH)


def _compared(batches):
    """Spans from the suffix arrays of a task's shards."""
    held, size = [], 0

    def done():
        table = pa.Table.from_batches(held) if isinstance(held[0], pa.RecordBatch) else pa.concat_tables(held)
        table = table.combine_chunks()
        raw, off = text_buffer(table.column("bytes").chunk(0))
        d, s, e = shard_spans(raw, off, table.column("d").to_numpy(), table.column("s").to_numpy())
        return pa.RecordBatch.from_pydict({"d": d, "s": s, "e": e})

    for table in _groups(batches, "a"):
        # Anchors are sorted, so a shard may end behind any group.
        for part in _parts(table):
            held.append(part)
            size += part.column("bytes").nbytes
            if size >= SHARD_BYTES:
                yield done()
                held, size = [], 0
    if held:
        yield done()


def _parts(table: pa.Table):
    """Runs of whole anchor groups of about a shard."""
    a = table.column("a").to_numpy()
    if not len(a):
        return
    edges = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    step = max(1, int(SHARD_BYTES * len(a) / max(table.nbytes, 1)))
    lo = 0
    while lo < len(a):
        k = int(np.searchsorted(edges, lo + step, side="left"))
        hi = int(edges[k]) if k < len(edges) else len(a)
        yield table.slice(lo, hi - lo)
        lo = hi


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   most_pieces: int = MOST_PIECES) -> DataFrame:
    """``d``, ``s``, ``e``: spans of bytes to remove, which may overlap; a null id is the smallest integer."""
    slim = texts(docs, id_col, text_col).select(F.coalesce("_id", F.lit(NO_ID)).alias("_id"), "_text")
    found = slim.mapInArrow(_anchored, "a bigint, p bigint, d bigint, s bigint, n int")
    marks = scratch(
        found.repartition("a").sortWithinPartitions("a", "p", "d", "s")
        .mapInArrow(_resolved, "d bigint, s bigint, e bigint, a bigint"), "marks")
    many = scratch(marks.filter("a IS NOT NULL").groupBy("a").agg(F.count(F.lit(1)).alias("many"))
                   .filter(F.col("many") > most_pieces).select("a"), "frequent")
    piece = marks.filter("a IS NOT NULL")
    cold = _bytes_of(slim, piece.join(many, "a", "left_anti"))
    spans = cold.repartition("a").sortWithinPartitions("a", "d", "s").mapInArrow(_compared, "d bigint, s bigint, e bigint")
    out = marks.filter("a IS NULL").select("d", "s", "e").union(spans)
    return out if many.isEmpty() else out.union(_frequent(_bytes_of(slim, piece.join(many, "a", "left_semi"))))


def _bytes_of(slim: DataFrame, piece: DataFrame) -> DataFrame:
    """The pieces with their bytes: ``a``, ``d``, ``s``, ``bytes``."""
    wanted = piece.groupBy(F.col("d").alias("_id")).agg(F.collect_set(F.struct("s", "e", "a")).alias("wanted"))
    return slim.join(wanted, "_id").select("_id", "_text", "wanted").mapInArrow(
        _cut, "a bigint, d bigint, s bigint, bytes binary")


def _frequent(cut: DataFrame) -> DataFrame:
    """Repeats among the pieces of anchors that have too many for one shard.

    Their strings are grouped as such: the earliest place of each is found with partial aggregation, and all others
    are repeats. The join splits strings that are frequent themselves.
    """
    at = F.explode(F.sequence(F.lit(0), F.length("bytes") - LENGTH)).alias("i")
    string = F.substring(F.col("bytes"), F.col("i") + 1, F.lit(LENGTH)).alias("string")
    rows = scratch(cut.select("d", "s", "bytes", at).select("d", (F.col("s") + F.col("i")).alias("s"), string), "strings")
    first = rows.groupBy("string").agg(F.min(F.struct("d", "s")).alias("first"))
    late = rows.join(first, "string").filter(F.struct("d", "s") > F.col("first"))
    return late.select("d", "s", (F.col("s") + LENGTH).alias("e"))


def _removed(batches):
    for batch in batches:
        for lo, hi, data, off in slices(batch.column("_text")):
            raw = data.tobytes()
            kept, n_removed, spans = [], [], []
            for k, own in enumerate(batch.column("spans").slice(lo, hi - lo)):
                text = raw[off[k]:off[k + 1]]
                if not own.is_valid:
                    kept.append(text), n_removed.append(0), spans.append([])
                    continue
                s, e = (own.values.field(i).to_numpy() for i in range(2))
                e = np.minimum(e, len(text))
                _, s, e = _joined(np.zeros(len(s), np.int64), s, e)
                s, e = s[e > s].tolist(), e[e > s].tolist()
                kept.append(b"".join(text[x:y] for x, y in zip([0, *e], [*s, len(text)])))
                n_removed.append(sum(e) - sum(s))
                spans.append([{"start": x, "end": y} for x, y in zip(s, e)])
            yield pa.RecordBatch.from_pydict({
                "_id": batch.column("_id").slice(lo, hi - lo), "n_bytes": np.diff(off), "n_removed": n_removed,
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "kept": pa.array(kept, pa.binary()),
            }) if kept else None


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   most_pieces: int = MOST_PIECES) -> DataFrame:
    """Per row: the id, ``n_bytes``, ``n_removed``, ``spans`` (maximal removed runs of bytes) and ``kept``, the other
    bytes (which may cut a character)."""
    spans = scratch(repeated_spans(docs, id_col, text_col, most_pieces), "spans").groupBy(F.col("d").alias("_d")).agg(
        F.collect_list(F.struct("s", "e")).alias("spans"))
    slim = texts(docs, id_col, text_col)
    joined = slim.join(spans, F.coalesce("_id", F.lit(NO_ID)) == F.col("_d"), "left").select("_id", "_text", "spans")
    out = joined.mapInArrow(_removed, "_id bigint, n_bytes bigint, n_removed bigint, "
                                      "spans array<struct<start: bigint, end: bigint>>, kept binary")
    return out.select(qcol("_id").alias(id_col), "n_bytes", "n_removed", "spans", "kept")
