"""Packing along a space-filling curve.

Each document's token counts are hashed into a vector, projected to a few
dimensions, and placed on a Hilbert curve.  Documents are sorted by their curve
position over all tasks, laid end to end in that order and cut every
``length`` ids, so neighbours on the curve share sequences and only the last
sequence of all is padded.

Null or empty text is a document of its end id alone.  Equal texts have equal
curve positions; a hash of doc_id spreads them over tasks, and doc_id, then the
ids, order what is still tied.  Rows with the same doc_id are packed one by
one.  An empty table gives no pieces.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import column, sized, slices, values
from .bpe import MAX_PIECES, default_path, encoder
from .storage import materialize
from .words import mix

LENGTH = 2048
DIMS, BITS, FEATURES = 4, 10, 256
TIE_BITS = 63 - DIMS * BITS
ROWS, BYTES = 2048, 1 << 22  # rows, and bytes of their ids, that are cut at a time


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (n, d), each coordinate below 2**bits (Skilling's transform)."""
    x = points.astype(np.int64).T.copy()
    d = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(d):
            upper = (x[i] & level) != 0
            swap = np.where(upper, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(upper, low, 0) ^ swap
            x[i] ^= swap
        level >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        flip ^= np.where((x[d - 1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def _projection() -> np.ndarray:
    matrix = np.random.default_rng(20).standard_normal((FEATURES, DIMS))
    return matrix / np.linalg.norm(matrix, axis=0)


_MATRIX = _projection()


@lru_cache(maxsize=2)
def _hashed_ids(size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, sign) that each id below ``size`` is hashed to."""
    h = mix(np.arange(1, size + 1, dtype=np.uint64))
    return (h >> np.uint64(8)).astype(np.int64) % FEATURES, np.where(h & np.uint64(1), 1.0, -1.0)


def _features(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One row per document of ``sizes`` ids, laid end to end: signed token counts hashed to ``FEATURES`` places, the sums
    log-damped, at unit length.  The whole batch is counted at once."""
    place, sign = _hashed_ids(max(1 << 16, int(ids.max(initial=0)) + 1))
    owner = np.repeat(np.arange(len(sizes)) * FEATURES, sizes)
    sums = np.bincount(owner + place[ids], weights=sign[ids], minlength=len(sizes) * FEATURES).reshape(-1, FEATURES)
    vectors = np.sign(sums) * np.log1p(np.abs(sums))
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms > 0, norms, 1.0)


def curve_positions(vectors: np.ndarray) -> np.ndarray:
    """Hilbert keys of unit vectors: projected, squashed to (0, 1), cut into 2**BITS steps."""
    cells = 0.5 + 0.5 * np.tanh(3.0 * (vectors @ _MATRIX))
    return hilbert_keys(np.minimum((cells * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def _encode(path: str, end_id: int, max_pieces: int):
    def run(batches):
        enc = encoder(path, max_pieces)
        end = enc.pack(end_id)
        for batch in slices(batches):
            packed = [enc.encode(t or "") + end for t in values(batch, "text")]
            sizes = np.array([len(p) // enc.dtype.itemsize for p in packed], dtype=np.int64)
            vectors = _features(np.frombuffer(b"".join(packed), enc.dtype), sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id"),
                    pa.array(packed, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(curve_positions(vectors), pa.int64()),
                ],
                names=["doc_id", "ids", "doc_tokens", "curve"],
            )

    return run


PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, curve bigint, "
    "sequence_id bigint, offset bigint"
)


def _pieces(bases: dict[int, int], length: int, width: int):
    """mapInArrow over rows sorted by part and position: cut the stream of ids at multiples of ``length``."""
    dtype = "<u2" if width == 2 else "<u4"

    def run(batches):
        part, at = None, 0
        for batch in sized(slices(batches, ROWS), "ids", BYTES):
            parts, packed = np.asarray(column(batch, "part")), values(batch, "ids")
            sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // width
            # Place of each row's first id in the stream; a part begins at its base.
            first = np.flatnonzero(np.r_[parts[0] != part, parts[1:] != parts[:-1]])
            begin = np.cumsum(sizes) - sizes
            shift = np.r_[at, np.array([bases[p] for p in parts[first].tolist()], dtype=np.int64) - begin[first]]
            begin += shift[np.searchsorted(first, np.arange(len(parts)), side="right")]
            end = begin + sizes
            part, at = parts[-1], int(end[-1])

            n = np.where(sizes > 0, (end - 1) // length - begin // length + 1, 0)
            row = np.repeat(np.arange(len(n)), n)
            sequence = begin[row] // length + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start, stop = np.maximum(begin[row], sequence * length), np.minimum(end[row], (sequence + 1) * length)
            # The pieces lie end to end as the rows do.
            edges = np.r_[0, 4 * np.cumsum(stop - start)].astype(np.int32)
            ids = np.frombuffer(b"".join(packed), dtype).astype("<u4")
            binary = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(edges), pa.py_buffer(ids)])
            doc_id, curve = (column(batch, c).take(pa.array(row)) for c in ("doc_id", "curve"))
            longs = (pa.array(c, pa.int64()) for c in (start - begin[row], stop - start, sizes[row], sequence, start % length))
            start, size, doc_tokens, sequence, offset = longs
            yield pa.RecordBatch.from_arrays(
                [doc_id, start, size, binary, doc_tokens, curve, sequence, offset],
                names=[x.split()[0] for x in PIECES.split(", ")],
            )

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    end_id: int = 1,
    length: int = LENGTH,
    parts: int | None = None,
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    """One row per piece: ``ids`` (32-bit little-endian) of a document from its id ``start`` on, lying at ``offset``
    of sequence ``sequence_id``.  Columns of ``docs`` besides doc_id and text are not read.  A worker remembers up to
    twice ``max_pieces`` pieces of text; with fewer it takes less memory, and encodes rare ones again.
    """
    spark = docs.sparkSession
    path = tokenizer or default_path()
    width = encoder(path).dtype.itemsize
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    encoded = materialize(
        source.mapInArrow(_encode(path, end_id, max_pieces), "doc_id bigint, ids binary, doc_tokens bigint, curve bigint"), "encoded"
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = parts or 16 * tasks
    tie = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - TIE_BITS)
    placed = encoded.withColumn("place", F.shiftleft("curve", TIE_BITS).bitwiseOR(tie))

    # Cuts between parts: about equal rows; any cut is right, as the order decides.
    cuts = placed.agg(F.percentile_approx("place", [i / parts for i in range(1, parts)], 10 * parts)).first()[0] or []
    bounds = np.unique(np.array(cuts, dtype=np.int64))

    @F.pandas_udf("int")
    def part_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, place.to_numpy(np.int64), side="right").astype(np.int32))

    sums = placed.groupBy(part_of("place").alias("part")).agg(F.sum("doc_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One number per part reaches the driver.
    found = sums.select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).collect()
    bases = {r.part: r.base for r in found}
    # Neighbouring parts share a task, about as many ids in each: long documents may lie close together.
    total = max(1, sum(r.n for r in found))
    tasks_of = np.zeros(len(bounds) + 1, dtype=np.int32)
    for r in found:
        tasks_of[r.part] = r.base * tasks // total

    # From the place itself, not from the part: each task then needs one Python worker for both.
    @F.pandas_udf("int")
    def task_of(place: pd.Series) -> pd.Series:
        return pd.Series(tasks_of[np.searchsorted(bounds, place.to_numpy(np.int64), side="right")])

    dealt = placed.select("*", part_of("place").alias("part"), task_of("place").alias("task"))
    ordered = dealt.repartitionById(tasks, "task").sortWithinPartitions("part", "place", "doc_id", "doc_tokens", "ids")
    return ordered.select("part", "doc_id", "curve", "ids").mapInArrow(_pieces(bases, length, width), PIECES)


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """Assemble ``sequence_id, ids array<bigint>`` (padded to ``length``) and ``starts`` (offset of each piece)."""

    def join(key, rows):
        rows = rows.sort_by("offset")
        ids = np.frombuffer(b"".join(rows.column("ids").to_pylist()), "<u4").astype(np.int64)
        ids = np.r_[ids, np.full(length - len(ids), pad_id, dtype=np.int64)]
        return pa.table(
            {
                "sequence_id": pa.array([key[0].as_py()], pa.int64()),
                "ids": pa.array([ids], pa.list_(pa.int64())),
                "starts": pa.array([rows.column("offset").to_pylist()], pa.list_(pa.int64())),
            }
        )

    return pieces.groupBy("sequence_id").applyInArrow(join, "sequence_id bigint, ids array<bigint>, starts array<bigint>")
