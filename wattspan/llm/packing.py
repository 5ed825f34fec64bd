"""Cost-balanced packing of documents into training sequences.

A sequence's cost is linear in its tokens plus quadratic in its pieces (attention
runs inside a piece). A task takes blocks of its documents in reading order and
packs each block by itself: the tokens of the block fix how many full sequences
there are; what is left, less than one sequence, becomes sequences whose lengths
are powers of two, which need no padding. Pieces go, dearest first, to the
cheapest sequence that has room for the whole piece. Only where none has, the
piece is cut: it fills the cheapest sequence with room, and its rest waits for
its turn. So all sequences end full.
Nothing is shuffled and no task sees more than its own rows.

Null and empty texts have the end id only. Repeated rows are packed each, like
other documents. ``sequence_id`` is unique within a result; its upper bits are
the task's number.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from wattspan.functions.columns import qcol
from wattspan.llm.batches import slices
from wattspan.llm.encode import default_path, encoder
from wattspan.llm.frames import texts

SEQUENCE_TOKENS = 2048
BLOCK_TOKENS = 1 << 21
END_ID = 1
ATTENTION_SHARE = 1 / 4096
_TASK_BITS = 33


def plan(lengths: list[int], size: int, attention: float = ATTENTION_SHARE) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one block.

    Every token lies in one piece. The first ``sum(lengths) // size`` sequences are full; those after them have
    the binary digits of the rest as lengths, each a power of two.
    """
    total = sum(lengths)
    rooms = [size] * (total // size)
    rest = total % size
    rooms += [1 << b for b in reversed(range(size.bit_length())) if rest >> b & 1]
    cost = lambda n: n + attention * n * n
    room, spent = np.array(rooms, np.int64), np.zeros(len(rooms))
    # The cheapest sequence comes from the heap; where it is too small, all of the block's sequences are looked at.
    cheapest = [(0.0, s) for s in range(len(rooms))]
    waiting = [(-n, d, 0) for d, n in enumerate(lengths) if n]
    heapq.heapify(waiting)
    out = []
    while waiting:
        minus, d, start = heapq.heappop(waiting)
        left = -minus
        while not room[cheapest[0][1]] or spent[cheapest[0][1]] != cheapest[0][0]:
            heapq.heappop(cheapest)
        s = cheapest[0][1]
        if room[s] < left:
            fits = np.flatnonzero(room >= left)
            if len(fits):
                s = int(fits[np.argmin(spent[fits])])
        n = min(left, int(room[s]))
        out.append((d, start, n, s, rooms[s] - int(room[s])))
        room[s] -= n
        spent[s] += cost(n)
        heapq.heappush(cheapest, (float(spent[s]), s))
        if n < left:
            heapq.heappush(waiting, (n - left, d, start + n))
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
         size: int = SEQUENCE_TOKENS, end_id: int = END_ID, attention: float = ATTENTION_SHARE,
         block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per piece: the id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``
    and the piece's ``ids``.

    ``size`` must be a power of two.
    """
    if size < 1 or size & (size - 1):
        raise ValueError("size must be a power of two")
    path = path or default_path()
    kinds = pa.schema([
        ("_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.int32())),
    ])

    def run(batches):
        made = TaskContext.get().partitionId() << _TASK_BITS
        held: list[tuple] = []
        tokens = 0

        def packed():
            nonlocal made
            ids = np.concatenate([x[1] for x in held])
            doc_ids = [i for x in held for i in x[0]]
            lengths = np.concatenate([x[2] for x in held])
            first = np.cumsum(lengths) - lengths
            pieces = plan(lengths.tolist(), size, attention)
            raw = ids.astype("<u4")
            for k in range(0, len(pieces), 1024):
                part = pieces[k:k + 1024]
                own = [raw[first[d] + s:first[d] + s + n] for d, s, n, _, _ in part]
                yield pa.RecordBatch.from_pydict({
                    "_id": [doc_ids[p[0]] for p in part], "start": [p[1] for p in part], "length": [p[2] for p in part],
                    "ids_crc32": [zlib.crc32(x) for x in own], "doc_tokens": [int(lengths[p[0]]) for p in part],
                    "sequence_id": [made + p[3] for p in part], "offset": [p[4] for p in part],
                    "ids": pa.ListArray.from_arrays(
                        np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32),
                        np.concatenate(own).astype(np.int32)),
                }, schema=kinds)
            made += 1 + max((p[3] for p in pieces), default=-1)
            held.clear()

        for batch in batches:
            for lo, hi, data, off in slices(batch.column("_text")):
                ids, ends = encoder(path).encode(data, off)
                ids = np.insert(ids, ends[1:], end_id)
                lengths = np.diff(ends) + 1
                held.append((batch.column("_id").slice(lo, hi - lo).to_pylist(), ids, lengths))
                tokens += len(ids)
                if tokens >= block_tokens:
                    yield from packed()
                    tokens = 0
        if held:
            yield from packed()

    schema = ("_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
              "offset bigint, ids array<int>")
    out = texts(docs, id_col, text_col).mapInArrow(run, schema)
    return out.select(qcol("_id").alias(id_col), *[c for c in out.columns if c != "_id"])
