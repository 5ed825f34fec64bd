"""Line dedup: two Bloom filters find suspected repeats, and only those are shuffled and counted exactly.

A line's key is the line without white space at both ends, A to Z in lower case.

1. Each task keeps two filters over the keys of its documents: one for keys seen
   once, one for keys seen twice. The filters of all tasks are merged segment by
   segment; a key that two tasks hold once each is set in the bitwise AND of
   their filters, so the merged second filter holds every key of two documents.
2. Only lines whose key passes the second filter leave their task, with their
   key's text. Keys are counted exactly, which also removes false alarms.
3. Keys found in enough documents lose their lines, but for the document with
   the largest id that holds them.

The filters' size follows the number of rows up to ``MOST_FILTER_BITS``, which
bounds the broadcast. Fuller filters let more lines through to the exact count;
they never change a result.

Null and empty texts are one empty line. Repeated rows count as documents of
their own; a line that stays in the largest id stays in all rows of that id. A
null id counts as smaller than any other. Other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattspan.functions.columns import qcol
from wattspan.llm.batches import IS_SPACE, Prefix, lowered, release, slices
from wattspan.llm.frames import scratch, texts

MIN_POINTS = 40
MIN_DOCUMENTS = 5
BITS_PER_ROW = 256
LEAST_FILTER_BITS = 1 << 20
MOST_FILTER_BITS = 1 << 30
SEGMENT_BYTES = 1 << 16
# Bytes of text worked on at once; each takes about ten numbers of 8 bytes.
SLICE_BYTES = 1 << 19
PROBES = 3
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64

_U = np.uint64
NO_ID = -(1 << 63)


def line_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all lines, and the first line of each text."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([off[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, off[1:]]))
    return starts, ends, np.searchsorted(breaks, off, side="left") + np.arange(len(off))


def long_keys(data: np.ndarray, off: np.ndarray, min_points: int):
    """Of the lines with long enough keys: text, line number in it, key bounds, and key hash."""
    starts, ends, first = line_bounds(data, off)
    solid = np.flatnonzero(~IS_SPACE[data])
    lo, hi = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    some = np.flatnonzero(hi - lo > 0)
    ks, ke = solid[lo[some]], solid[hi[some] - 1] + 1
    # Code points of a key: its bytes that don't continue one.
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    long_ = heads[ke] - heads[ks] >= min_points
    some, ks, ke = some[long_], ks[long_], ke[long_]
    doc = np.searchsorted(first, some, side="right") - 1
    return doc, some - first[doc], ks, ke, Prefix(lowered(data)).of(ks, ke)


def once_per_text(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """True for the first line with its hash in its text."""
    order = np.lexsort((np.arange(len(h)), h, doc))
    new = np.ones(len(h), bool)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (h[order][1:] != h[order][:-1])
    out = np.zeros(len(h), bool)
    out[order] = new
    return out


def probes(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """Bit numbers of each key."""
    step = (h >> _U(32)) | _U(1)
    return [((h + _U(i) * step) & _U(bits - 1)).astype(np.int64) for i in range(PROBES)]


def passes(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    found = np.ones(len(h), bool)
    for at in probes(h, len(bitmap) * 8):
        found &= (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return found


def put(bitmap: np.ndarray, h: np.ndarray) -> None:
    for at in probes(h, len(bitmap) * 8):
        np.bitwise_or.at(bitmap, at >> 3, (1 << (at & 7)).astype(np.uint8))


def twice_filter(docs: DataFrame, bits: int, min_points: int) -> np.ndarray:
    """The merged filter of keys in two documents or more; its size is ``bits``, a power of two."""
    size = bits // 8
    step = min(SEGMENT_BYTES, size)

    def fill(batches):
        release()
        once, twice = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
        for batch in batches:
            for _, _, data, off in slices(batch.column("_text"), SLICE_BYTES):
                doc, _, _, _, h = long_keys(data, off, min_points)
                keys, n = np.unique(h[once_per_text(doc, h)], return_counts=True)
                put(twice, keys[(n > 1) | passes(once, keys)])
                put(once, keys)
        rows = [i for i in range(0, size, step) if once[i:i + step].any()]
        pack = lambda bitmap, i: pa.compress(bitmap[i:i + step].tobytes(), codec="zstd", asbytes=True)
        for k in range(0, len(rows), 64):
            part = rows[k:k + 64]
            yield pa.RecordBatch.from_pydict({
                "segment": pa.array(part, pa.int64()), "once": [pack(once, i) for i in part],
                "twice": [pack(twice, i) for i in part],
            })

    def merge(batches):
        at, once, twice = None, None, None
        unpack = lambda x: np.frombuffer(pa.decompress(x.as_py(), step, codec="zstd", asbytes=True), np.uint8)
        out = lambda: pa.RecordBatch.from_pydict({"segment": pa.array([at], pa.int64()), "twice": [twice.tobytes()]})
        for batch in batches:
            for segment, a, b in zip(batch.column("segment").to_pylist(), batch.column("once"), batch.column("twice")):
                a, b = unpack(a), unpack(b)
                if segment != at:
                    if at is not None and twice.any():
                        yield out()
                    at, once, twice = segment, a.copy(), b.copy()
                else:
                    twice |= b | (once & a)
                    once |= a
        if at is not None and twice.any():
            yield out()

    filled = docs.select("_text").mapInArrow(fill, "segment bigint, once binary, twice binary")
    merged = filled.repartition("segment").sortWithinPartitions("segment").mapInArrow(
        merge, "segment bigint, twice binary")
    bitmap = np.zeros(size, np.uint8)
    for row in merged.toLocalIterator():
        bitmap[row.segment:row.segment + step] = np.frombuffer(row.twice, np.uint8)
    return bitmap


def suspects(docs: DataFrame, bitmap: np.ndarray, min_points: int) -> DataFrame:
    """Lines whose key passes the filter: the row's key, line number, key text, and whether the key is new in its text."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        release()
        seen = shared.value
        for batch in batches:
            for lo, hi, data, off in slices(batch.column("_text"), SLICE_BYTES):
                doc, line, ks, ke, h = long_keys(data, off, min_points)
                hit = np.flatnonzero(passes(seen, h))
                doc, line, ks, ke, h = (x[hit] for x in (doc, line, ks, ke, h))
                low = lowered(data).tobytes()
                keys = [low[s:e] for s, e in zip(ks.tolist(), ke.tolist())]
                rows = pa.array(lo + doc)
                yield pa.RecordBatch.from_pydict({
                    "_k": batch.column("_k").take(rows), "_h": batch.column("_h").take(rows), "line": line.astype(np.int32),
                    "key": pa.array(keys, pa.binary()).cast(pa.string()), "new": pa.array(once_per_text(doc, h)),
                })

    return docs.mapInArrow(run, "_k bigint, _h bigint, line int, key string, new boolean")


def filter_bits(rows: int, most: int = MOST_FILTER_BITS) -> int:
    return max(LEAST_FILTER_BITS, min(most, 1 << (rows * BITS_PER_ROW).bit_length()))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_points: int = MIN_POINTS,
                min_documents: int = MIN_DOCUMENTS, most_bits: int = MOST_FILTER_BITS) -> DataFrame:
    """All rows with ``text_col`` rewritten, plus ``n_lines`` before dropping and ``n_dropped``."""
    row = [F.coalesce(F.col("_id"), F.lit(NO_ID)).alias("_k"), F.xxhash64("_text").alias("_h")]
    slim = texts(docs, id_col, text_col).select(*row, "_text")
    bitmap = twice_filter(slim, filter_bits(docs.count(), most_bits), min_points)
    found = scratch(suspects(slim, bitmap, min_points), "suspects")
    frequent = scratch(
        found.filter("new").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("_k").alias("keeper"))
        .filter(F.col("n") >= min_documents).drop("n"), "frequent")
    size = frequent.agg(F.sum(F.octet_length("key") + ROW_BYTES)).first()[0] or 0
    drops = (
        # Beyond the bound the join shuffles, and adaptive execution splits the lines of a hot key.
        found.join(F.broadcast(frequent) if size <= BROADCAST_BYTES else frequent, "key").filter("_k <> keeper")
        .groupBy(F.col("_k").alias("_dk"), F.col("_h").alias("_dh")).agg(F.collect_set("line").alias("_drop"))
    )
    # The whole rows, under names that no column of the input has.
    whole = docs.select(F.struct("*").alias("_doc"), qcol(id_col).cast("bigint").alias("_id"),
                        qcol(text_col).cast("string").alias("_text"))
    joined = whole.join(drops, (row[0] == F.col("_dk")) & (row[1] == F.col("_dh")), "left")
    lines = F.split(F.coalesce("_text", F.lit("")), "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_drop"))
    text = F.when(F.col("_drop").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    n_lines = (F.length(F.coalesce("_text", F.lit(""))) - F.length(F.replace(F.coalesce("_text", F.lit("")), F.lit("\n")))
               + 1).cast("bigint")
    n_dropped = F.when(F.col("_drop").isNull(), F.lit(0)).otherwise(F.size("_drop")).cast("bigint")
    # Two steps: beside the expanded row, a name in a lambda could mean one of the row's own columns.
    done = joined.select("_doc", text.alias("_new"), n_lines.alias("_n"), n_dropped.alias("_d"))
    new = {text_col: F.col("_new"), "n_lines": F.col("_n"), "n_dropped": F.col("_d")}
    names = [*docs.columns, *[c for c in new if c not in docs.columns]]
    return done.select(*[new[c].alias(c) if c in new else F.col("_doc")[c].alias(c) for c in names])
