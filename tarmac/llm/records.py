"""Token ids as length-delimited binary records, with an offset index beside them.

File format (all numbers little-endian).  A file is a run of frames::

    uint32 length | uint32 masked CRC of the length | payload | uint32 masked CRC of the payload | byte 0x0A

and a payload is ``int64 doc_id | uint8 flags | ids``: bit 0 of the flags says
that doc_id is null, bit 1 that ids take four bytes (two otherwise).  The CRC is
CRC-32 of zlib, masked as in TFRecord files (rotated right by 15 bits plus
0xA282EAD8) so that a checksum of data that holds checksums stays strong.

Spark's own text writer stores the frames (a frame's bytes as the line, its
last byte as the line end), so they go to any Hadoop file system under Spark's
commit protocol: a lost executor's half-written files are never seen.  Files
hold frames in order and sort by name; no file grows past ``BLOCKS_PER_FILE``
blocks of about ``BLOCK_BYTES``, except by one record that is longer.

Null text is empty text: such a document has its end id only.  Rows that share
a doc_id stay rows of their own.  An empty table gives files without frames.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import slices, values
from .bpe import default_path, encoder

BLOCK_BYTES = 1 << 20
BLOCKS_PER_FILE = 32
PIECES = 400_000  # that a worker remembers twice over
_LENGTHS, _CRC, _HEAD = struct.Struct("<II"), struct.Struct("<I"), struct.Struct("<qB")

INDEX = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("ids_before", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


class DamagedRecord(ValueError):
    """A frame whose lengths or checksums do not agree."""


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """One frame without its last byte."""
    payload = _HEAD.pack(doc_id or 0, (doc_id is None) | (width == 4) << 1) + ids
    size = struct.pack("<I", len(payload))
    return size + _CRC.pack(masked_crc(size)) + payload + _CRC.pack(masked_crc(payload))


def frames(data: bytes, start: int = 0, end: int | None = None):
    """Yield (offset, length with the last byte, doc_id, ids as uint32) of each frame; raise on damage."""
    at, end = start, len(data) if end is None else end
    while at < end:
        if at + 8 > end:
            raise DamagedRecord(f"torn frame at {at}")
        size, check = _LENGTHS.unpack_from(data, at)
        if masked_crc(data[at : at + 4]) != check or at + 13 + size > end:
            raise DamagedRecord(f"bad length at {at}")
        payload = data[at + 8 : at + 8 + size]
        if masked_crc(payload) != _CRC.unpack_from(data, at + 8 + size)[0] or data[at + 12 + size] != 0x0A:
            raise DamagedRecord(f"bad payload at {at}")
        doc_id, flags = _HEAD.unpack_from(payload)
        ids = np.frombuffer(payload, dtype="<u4" if flags & 2 else "<u2", offset=_HEAD.size).astype("<u4")
        yield at, 13 + size, None if flags & 1 else doc_id, ids
        at += 13 + size


def _blocks(path: str, end_id: int):
    def run(batches):
        enc = encoder(path, PIECES)
        width, end = enc.dtype.itemsize, enc.pack(end_id)
        held, size = [], 0
        for batch in slices(batches):
            done = []
            for doc_id, text in zip(values(batch, "doc_id"), values(batch, "text")):
                held.append(frame(doc_id, enc.encode(text or "") + end, width))
                size += len(held[-1])
                if size >= BLOCK_BYTES:
                    done.append(b"\n".join(held))
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary())], names=["block"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"\n".join(held)], pa.binary())], names=["block"])

    return run


def write_token_records(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 0) -> None:
    """Encode ``text`` of every row and write the records in ascending ``doc_id`` order (nulls first)."""
    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .repartitionByRange(F.col("doc_id"))
        .sortWithinPartitions("doc_id")
    )
    blocks = ordered.mapInArrow(_blocks(tokenizer or default_path(), end_id), "block binary")
    (
        blocks.select(F.col("block").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", BLOCKS_PER_FILE)
        .mode("error")
        .text(folder)
    )


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(folder)
        .select(F.col("path").alias("file"), "content")
    )


def _scan(batches):
    for batch in batches:
        for file, data in zip(values(batch, "file"), batch.column(1)):
            rows, before = [], 0
            for offset, size, doc_id, ids in frames(data.as_py()):
                rows.append((file, doc_id, offset, size, before, len(ids), zlib.crc32(ids.tobytes())))
                before += len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, _INDEX_TYPES)], names=INDEX.names
            )


_INDEX_TYPES = [pa.string()] + [pa.int64()] * 6


def index_records(spark: SparkSession, folder: str) -> DataFrame:
    """Read every file back, check every frame, and return one index row per record.

    ``offset`` and ``bytes`` place the frame in ``file``; ``ids_before`` counts
    the ids of the file's earlier records; ``ids_crc32`` is over the ids as
    32-bit integers.
    """
    return _files(spark, folder).mapInArrow(_scan, INDEX)


def write_index(spark: SparkSession, folder: str, index_folder: str) -> DataFrame:
    index = index_records(spark, folder)
    index.write.mode("error").parquet(index_folder)
    return spark.read.schema(INDEX).parquet(index_folder)


def with_global_start(index: DataFrame) -> DataFrame:
    """Append ``start``: the ids of all records before, in file order.  One row per file meets in one window."""
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("__n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    base = files.select("file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    return index.join(base, "file").withColumn("start", F.col("__base") + F.col("ids_before")).drop("__base")


def read_records(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """Shuffled read: the ids of the index rows ``wanted`` (any subset, in any order) as (doc_id, ids array<bigint>).

    Only files that hold a wanted record are opened; one file's index rows and
    content meet in one task, which slices the frames out by offset.
    """

    def cut(key, rows, content):
        ids, docs = [], []
        data = content.column("content")[0].as_py() if content.num_rows else b""
        for offset, size in zip(rows.column("offset").to_pylist(), rows.column("bytes").to_pylist()):
            for _, _, doc_id, found in frames(data, offset, offset + size):
                docs.append(doc_id)
                ids.append(found)
        return pa.table({"doc_id": pa.array(docs, pa.int64()), "ids": pa.array(ids, pa.list_(pa.int64()))})

    rows = wanted.select("file", "offset", "bytes").groupBy("file")
    kept = _files(spark, folder).join(wanted.select("file").distinct(), "file", "left_semi").groupBy("file")
    return rows.cogroup(kept).applyInArrow(cut, "doc_id bigint, ids array<bigint>")
