"""Token ids as length-delimited binary records, with an offset index beside each file.

File format (little-endian). A record frames one document:

    uint64 length of the payload
    uint32 masked CRC-32 of those 8 bytes
    payload
    uint32 masked CRC-32 of the payload

The mask rotates the checksum right by 15 bits and adds 0xA282EAD8, so that a
checksum of data that hold checksums stays useful. A payload is the int64
document id, one byte with the bytes per token id (2 or 4), and the ids. The
index file next to it has one uint64 per record, where the record begins: a
reader fetches any record by itself, so reads can be shuffled.

Documents are range-partitioned by id. Each part becomes files of bounded size,
each written under a temporary name and then moved, so a task that runs again
replaces a file by the same file. Reading back deals files to tasks and verifies
lengths and checksums.

Null and empty texts have the end id only. Repeated rows are written each, equal
ids in the order of their texts. A null id is written as the smallest integer
and read back as null. An empty table gives no rows.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from wattspan.functions.columns import qcol
from wattspan.llm.batches import release, slices
from wattspan.llm.encode import default_path, encoder
from wattspan.llm.frames import scratch, texts
from wattspan.operators.small import checkpoint_dir

END_ID = 2
FILE_BYTES = 32 << 20
# Bytes of files that a reading task gets.
TASK_BYTES = 64 << 20
# Of read records a batch has at most so many, and ids of at most so many and one more record.
BATCH_RECORDS = 2048
BATCH_IDS = 1 << 19
# Fixed value: the addend of the mask.
MASK = 0xA282EAD8
NULL_ID = -(1 << 63)
_LENGTH, _CHECK, _START = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<qB")


def masked(data) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = _LENGTH.pack(len(payload))
    return b"".join([length, _CHECK.pack(masked(length)), payload, _CHECK.pack(masked(payload))])


def unframe(data, at: int) -> tuple[memoryview, int]:
    """Payload of the record that begins at ``at``, and where it ends; raises on damage."""
    view = memoryview(data)
    length = view[at:at + 8]
    if len(length) < 8 or _CHECK.unpack_from(view, at + 8)[0] != masked(length):
        raise ValueError(f"damaged record length at byte {at}")
    (n,) = _LENGTH.unpack(length)
    payload = view[at + 12:at + 12 + n]
    if len(payload) < n or _CHECK.unpack_from(view, at + 12 + n)[0] != masked(payload):
        raise ValueError(f"damaged record at byte {at}")
    return payload, at + 16 + n


def payload_of(doc_id: int | None, ids: np.ndarray) -> bytes:
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    return _START.pack(NULL_ID if doc_id is None else doc_id, width) + ids.astype(f"<u{width}").tobytes()


def parse(payload) -> tuple[int | None, np.ndarray]:
    doc_id, width = _START.unpack_from(payload)
    return None if doc_id == NULL_ID else doc_id, np.frombuffer(payload, f"<u{width}", offset=_START.size)


class Shard:
    """One record file and its index, moved to their names when complete."""

    def __init__(self, folder: str, name: str):
        self.store, self.folder = fs.FileSystem.from_uri(folder)
        self.name, self.extra = name, f".{uuid.uuid4().hex}.tmp"
        self.out = self.store.open_output_stream(f"{self.folder}/{name}.rec{self.extra}")
        self.offsets: list[int] = []
        self.size = self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        record = frame(payload_of(doc_id, ids))
        self.out.write(record)
        self.offsets.append(self.size)
        self.size += len(record)
        self.tokens += len(ids)

    def close(self) -> dict:
        self.out.close()
        with self.store.open_output_stream(f"{self.folder}/{self.name}.idx{self.extra}") as out:
            out.write(np.array(self.offsets, "<u8").tobytes())
        for kind in ("rec", "idx"):
            self.store.move(f"{self.folder}/{self.name}.{kind}{self.extra}", f"{self.folder}/{self.name}.{kind}")
        return {"shard": [self.name], "records": [len(self.offsets)], "tokens": [self.tokens], "bytes": [self.size]}


def write_records(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                  end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the files into ``folder`` (a path or URI that all executors share), ascending by id.

    Returns the manifest, written next to them: one row per file with ``shard`` (its name, in order), ``records``,
    ``tokens`` and ``bytes``.
    """
    path = path or default_path()

    def run(batches):
        part, shard, made = TaskContext.get().partitionId(), None, 0
        store, inner = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for lo, hi, data, off in slices(batch.column("_text")):
                ids, ends = encoder(path).encode(data, off)
                doc_ids = batch.column("_id").slice(lo, hi - lo).to_pylist()
                for k, doc_id in enumerate(doc_ids):
                    if shard is None:
                        store.create_dir(inner, recursive=True)
                        shard = Shard(folder, f"part-{part:08d}-{made:06d}")
                        made += 1
                    shard.add(doc_id, np.append(ids[ends[k]:ends[k + 1]], end_id))
                    if shard.size >= file_bytes:
                        yield pa.RecordBatch.from_pydict(shard.close())
                        shard = None
        if shard is not None:
            yield pa.RecordBatch.from_pydict(shard.close())

    slim = texts(docs, id_col, text_col)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Sorting on the id alone keeps texts out of the comparison; the hash only orders repeated ids.
    tie = F.xxhash64("_text")
    placed = slim.repartitionByRange(parts, "_id").sortWithinPartitions("_id", tie)
    return scratch(placed.mapInArrow(run, "shard string, records bigint, tokens bigint, bytes bigint"), "manifest")


def shard_starts(manifest: DataFrame) -> DataFrame:
    """``shard`` and ``first``, the number of ids in all files before it. The window sees one row per file."""
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return manifest.select("shard", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("first"))


def _read(manifest: DataFrame, folder: str, made, fields: list[tuple[str, pa.DataType]], schema: str) -> DataFrame:
    """Reads the files and verifies the checksums. ``made`` gives the columns ``fields`` of some records' ids."""
    kinds = pa.schema([("shard", pa.string()), ("record", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), *fields])

    def run(batches):
        release()
        for batch in batches:
            for name, start in zip(batch.column("shard").to_pylist(), batch.column("first").to_pylist()):
                store, inner = fs.FileSystem.from_uri(folder)
                with store.open_input_file(f"{inner}/{name}.rec") as f, store.open_input_file(f"{inner}/{name}.idx") as g:
                    data, offsets = f.read_buffer(), np.frombuffer(g.read_buffer(), "<u8").tolist()
                doc_ids, starts, ids, held = [], [], [], 0
                for k, at in enumerate(offsets):
                    doc_id, own = parse(unframe(data, at)[0])
                    doc_ids.append(doc_id)
                    starts.append(start)
                    ids.append(own)
                    start += len(own)
                    held += len(own)
                    if held >= BATCH_IDS or len(ids) == BATCH_RECORDS or k + 1 == len(offsets):
                        yield pa.RecordBatch.from_pydict({
                            "shard": [name] * len(ids), "record": list(range(k + 1 - len(ids), k + 1)), "doc_id": doc_ids,
                            "start": starts, **made(ids)}, schema=kinds)
                        doc_ids, starts, ids, held = [], [], [], 0

    # One file is a task's unit: it has at most file_bytes and one more record. Without a number of partitions, adaptive
    # execution would merge the few rows of the manifest, and one task would read all files.
    files, size = manifest.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    spread = max(1, min(files, max(-(-size // TASK_BYTES), manifest.sparkSession.sparkContext.defaultParallelism)))
    rows = shard_starts(manifest).repartition(spread, "shard")
    return rows.mapInArrow(run, "shard string, record bigint, doc_id bigint, start bigint, " + schema)


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """Documents of the files: ``shard``, ``record`` (its place in the file), ``doc_id``, ``start`` (ids of all records
    before it) and ``ids``."""

    def made(ids):
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        return {"ids": pa.ListArray.from_arrays(ends, np.concatenate(ids).astype(np.int32))}

    return _read(manifest, folder, made, [("ids", pa.list_(pa.int32()))], "ids array<int>")


def read_checksums(manifest: DataFrame, folder: str) -> DataFrame:
    """Like :func:`read_records`, with ``n_tokens`` and ``ids_crc32``, the CRC-32 of the ids as little-endian uint32,
    instead of the ids, which stay in the task that reads them."""

    def made(ids):
        return {"n_tokens": [len(x) for x in ids], "ids_crc32": [zlib.crc32(x.astype("<u4")) for x in ids]}

    return _read(manifest, folder, made, [("n_tokens", pa.int64()), ("ids_crc32", pa.int64())], "n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
               end_id: int = END_ID, folder: str | None = None) -> DataFrame:
    """Writes the documents, reads the files back and returns per document the id, ``start`` (ids of all documents
    before it), ``n_tokens`` and ``ids_crc32``."""
    folder = folder or f"{checkpoint_dir(docs.sparkSession)}/wattspan-llm/records-{uuid.uuid4().hex}"
    manifest = write_records(docs, folder, id_col, text_col, path, end_id)
    got = read_checksums(manifest, folder)
    return got.select(qcol("doc_id").alias(id_col), "start", "n_tokens", "ids_crc32", "shard", "record")
