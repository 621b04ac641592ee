"""Near-duplicate vectors by randomly rotated binary codes with correction factors (after RaBitQ).

Vectors of equal label (of any type but a map) and length link when their cosine is at least
``threshold``.

*Codes.*  A unit vector x is rotated at random and kept as its signs, the unit
vector s(x) with entries +-1/sqrt(D), and the factor a(x) = <s(x), x>.  For a
unit vector y, <s(x), y> / a(x) estimates <x, y> without bias; its error is
sqrt(1 - <x,y>**2) * sqrt(1 - a**2) / a times the cosine of two directions, so
it is bounded whatever the rotation.  y enters as four-bit numbers, whose
rounding error is known too.  A pair whose estimate plus bound stays under the
threshold is dropped; the others, and only they, are computed again in double
precision.  The bound holds always, so the codes lose no link.

*Candidates.*  Pairs are estimated where the first bits of their codes agree,
under one of several further rotations (tables).  Bits and tables follow from
the largest label's size, such that a pair at the threshold misses all tables
with a chance below ``MISS``; pairs above it, less.

Equal vectors are combined first and weigh as many as they are.  A bucket of
more than ``CHUNK`` vectors is compared chunk against chunk.  No pair leaves a
task: a task sends counts, and links enough to connect what it found.  A pair
counts in the first table that holds it.

A vector that is null, empty, zero, or has null or non-finite entries, or whose
label or vec_id is null, links with nothing.  Rows that share a vec_id are
vectors of their own but one node of the components.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import column, slices, values
from .components import connected_components
from .storage import materialize

THRESHOLD, MISS = 0.98, 1e-7
CHUNK = 1024
QUERY_BITS = 4
PER_BUCKET = 64  # vectors that a bucket of the largest label should hold
SEED = 11


@lru_cache(maxsize=256)
def rotation(dim: int, table: int, rows: int) -> np.ndarray:
    """``rows`` orthonormal random rows; table 0 is the codes' own rotation."""
    gauss = np.random.default_rng([SEED, dim, table]).standard_normal((dim, rows))
    q, r = np.linalg.qr(gauss)
    return (q * np.sign(np.diag(r))).T


def plan(largest: int, threshold: float) -> tuple[int, int]:
    """(bits, tables) for labels of up to ``largest`` vectors."""
    bits = min(24, max(2, round(math.log2(max(2, largest) / PER_BUCKET)))) if largest > PER_BUCKET else 2
    meet = 0.97 * (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - meet))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _packed_bits(signs: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    data = np.packbits(signs, axis=1, bitorder="little")
    pad = -data.shape[1] % 8
    return np.ascontiguousarray(np.pad(data, ((0, 0), (0, pad)))).view(np.uint64)


def encode(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, factors) of unit vectors."""
    dim = u.shape[1]
    turned = u @ rotation(dim, 0, dim).T
    return _packed_bits(turned > 0), np.abs(turned).sum(axis=1) / math.sqrt(dim)


def buckets(u: np.ndarray, bits: int, tables: int) -> np.ndarray:
    dim = u.shape[1]
    bits = min(bits, dim)
    weights = 1 << np.arange(bits)
    return np.stack([((u @ rotation(dim, t, bits).T) > 0) @ weights for t in range(1, tables + 1)], axis=1).astype(np.int32)


class Queries:
    """Rotated unit vectors as bit planes of four-bit numbers."""

    def __init__(self, u: np.ndarray):
        dim = u.shape[1]
        turned = u @ rotation(dim, 0, dim).T
        self.low = turned.min(axis=1)
        top = (1 << QUERY_BITS) - 1
        self.step = np.maximum((turned.max(axis=1) - self.low) / top, 1e-300)
        numbers = np.clip(np.rint((turned - self.low[:, None]) / self.step[:, None]), 0, top).astype(np.int64)
        self.planes = [_packed_bits((numbers >> b) & 1 == 1) for b in range(QUERY_BITS)]
        self.sum = dim * self.low + self.step * numbers.sum(axis=1)
        rounded = self.low[:, None] + self.step[:, None] * numbers
        self.off = np.linalg.norm(turned - rounded, axis=1)
        self.dim = dim

    def estimate(self, codes: np.ndarray, factors: np.ndarray) -> np.ndarray:
        """Estimated inner products, (codes, queries)."""
        def common(plane):
            return np.bitwise_count(codes[:, None, :] & plane[None, :, :]).sum(axis=2, dtype=np.int64)

        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        picked = self.low * ones[:, None] + self.step * sum(common(p) << b for b, p in enumerate(self.planes))
        return (2 * picked - self.sum) / (math.sqrt(self.dim) * factors[:, None])


def floor_of(factors: np.ndarray, off: np.ndarray, threshold: float) -> np.ndarray:
    """Least estimate that a pair at the threshold or above can have."""
    spread = math.sqrt(1 - threshold**2) * np.sqrt(np.maximum(0, 1 - factors**2))
    return threshold - (spread[:, None] + off[None, :]) / factors[:, None] - 1e-9


def links_in(u, codes, factors, buckets_, table, chunk, threshold):
    """Yield (i, partners j > i) of one bucket: pairs at the threshold that no earlier table holds; if the rows are of
    two chunks, pairs across them only."""
    n, slab = len(u), 128
    queries = Queries(u)
    across = (chunk != chunk[0]).any()
    for at in range(0, n, slab):
        rows = np.arange(at, min(n, at + slab))
        maybe = queries.estimate(codes[rows], factors[rows]) >= floor_of(factors[rows], queries.off, threshold)
        maybe &= np.arange(n)[None, :] > rows[:, None]
        if across:
            maybe &= chunk[rows][:, None] != chunk[None, :]
        if maybe.sum() * 8 > maybe.size:
            linked = maybe & (u[rows] @ u.T >= threshold)
        else:
            i, j = np.nonzero(maybe)
            linked = np.zeros_like(maybe)
            linked[i, j] = np.einsum("ij,ij->i", u[rows[i]], u[j]) >= threshold
        for t in range(table):
            if not linked.any():
                break
            linked &= buckets_[rows, t][:, None] != buckets_[None, :, t]
        for k in np.flatnonzero(linked.any(axis=1)):
            yield rows[k], np.flatnonzero(linked[k])


_PREPARED = "vec_id bigint, label string, dim int, digest binary, raw binary"


def _prepare(batches):
    """Usable vectors in the narrowest exact form; the others with null ``raw``."""
    for batch in slices(batches):
        dims, digests, raws = [], [], []
        for vector, label, vec_id in zip(values(batch, "embedding"), values(batch, "label"), values(batch, "vec_id")):
            x = np.array([np.nan if v is None else v for v in vector or ()], dtype=np.float64) + 0.0
            if label is None or vec_id is None or not len(x) or not np.isfinite(x).all() or not x.any():
                dims.append(0), digests.append(None), raws.append(None)
                continue
            with np.errstate(over="ignore"):
                short = x.astype(np.float32)
            raw = (short if (short == x).all() else x).tobytes()
            dims.append(len(x)), digests.append(xxhash.xxh3_128_digest(x.tobytes())), raws.append(raw)
        yield pa.RecordBatch.from_arrays(
            [
                column(batch, "vec_id"),
                column(batch, "label"),
                pa.array(dims, pa.int32()),
                pa.array(digests, pa.binary()),
                pa.array(raws, pa.binary()),
            ],
            names=["vec_id", "label", "dim", "digest", "raw"],
        )


def _matrix(raws: list[bytes], dim: int) -> np.ndarray:
    return np.stack([np.frombuffer(r, "<f4" if len(r) == 4 * dim else "<f8").astype(np.float64) for r in raws])


def _code(bits: int, tables: int):
    def run(batches):
        for batch in slices(batches):
            n = batch.num_rows
            codes, factors, places = [None] * n, [0.0] * n, [None] * n
            dims, raws = values(batch, "dim"), values(batch, "raw")
            for dim in set(dims):
                own = [i for i in range(n) if dims[i] == dim]
                u = unit(_matrix([raws[i] for i in own], dim))
                for i, code, factor, place in zip(own, *encode(u), buckets(u, bits, tables)):
                    codes[i], factors[i], places[i] = code.tobytes(), float(factor), place
            extra = [pa.array(codes, pa.binary()), pa.array(factors, pa.float64()), pa.array(places, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *extra], names=[*batch.schema.names, "code", "factor", "buckets"]
            )

    return run


_ROWS = ["place", "table", "own", "dim", "rep", "copies", "raw", "code", "factor", "buckets"]


def _compare(threshold: float):
    """Rows sorted by place (label, length, table, bucket, pair of chunks): counts of linked vectors, and links that
    connect the linked."""

    def close(rows):
        dim, table = rows["dim"][0], rows["table"][0]
        u = unit(_matrix(rows["raw"], dim))
        codes = np.stack([np.frombuffer(c, np.uint64) for c in rows["code"]])
        reps, copies = np.array(rows["rep"]), np.array(rows["copies"])
        links, label, pairs = np.zeros(len(u), np.int64), np.arange(len(u)), []
        args = np.array(rows["factor"]), np.array(rows["buckets"]), table, np.array(rows["own"])
        for i, partners in links_in(u, codes, *args, threshold):
            links[i] += copies[partners].sum()
            links[partners] += copies[i]
            for other in np.unique(label[partners], return_index=True)[1]:
                j = partners[other]
                if label[j] != label[i]:
                    pairs.append((reps[i], reps[j]))
                    label[label == label[j]] = label[i]
        some = np.flatnonzero(links)
        out = [(int(reps[i]), int(links[i]), None, None) for i in some] + [(None, None, int(a), int(b)) for a, b in pairs]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 4)], names=["rep", "links", "u", "v"]
        )

    def run(batches):
        held = {c: [] for c in _ROWS}
        for batch in slices(batches):
            columns = [values(batch, c) for c in _ROWS]
            for row in zip(*columns):
                if held["place"] and row[0] != held["place"][0]:
                    if len(held["place"]) > 1:
                        yield close(held)
                    held = {c: [] for c in _ROWS}
                for c, v in zip(_ROWS, row):
                    held[c].append(v)
        if len(held["place"]) > 1:
            yield close(held)

    return run


def _label(vectors: DataFrame):
    """Labels of any type as text that is equal for equal labels only (0.0 and -0.0 are equal)."""
    label, kind = F.col("label"), vectors.select("label").schema[0].dataType.typeName()
    if kind == "binary":
        return F.base64(label)
    if kind in ("array", "struct"):
        return F.when(label.isNotNull(), F.to_json(F.struct(label.alias("label")), {"ignoreNullFields": "false"}))
    return (label + F.lit(0.0) if kind in ("float", "double") else label).cast("string")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id) for every row of ``vectors`` (vec_id, embedding, label)."""
    source = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        _label(vectors).alias("label"),
    )
    prepared = materialize(source.mapInArrow(_prepare, _PREPARED), "vectors")
    key = ["label", "dim", "digest"]
    distinct = (
        prepared.filter(F.col("raw").isNotNull())
        .groupBy(*key)
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("raw").alias("raw"))
    )
    distinct = materialize(distinct, "distinct")
    largest = distinct.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan(largest, threshold)
    schema = "label string, dim int, digest binary, rep bigint, copies bigint, raw binary, code binary, factor double, buckets array<int>"
    coded = materialize(distinct.mapInArrow(_code(bits, tables), schema), "codes")

    # Buckets above CHUNK, and per vector the number of chunks of each such bucket that it is in.
    light = coded.select(*key, F.posexplode("buckets").alias("table", "bucket"))
    hot = light.groupBy("label", "dim", "table", "bucket").count().filter(F.col("count") > CHUNK)
    hot = hot.withColumn("chunks", F.ceil(F.col("count") / CHUNK).cast("int")).drop("count")
    split = (
        light.join(hot, ["label", "dim", "table", "bucket"])
        .groupBy(*key)
        .agg(F.map_from_entries(F.collect_list(F.struct("table", "chunks"))).alias("split"))
    )
    placed = coded.join(split, key, "left").select("*", F.posexplode("buckets").alias("table", "bucket"))
    placed = placed.withColumn("chunks", F.coalesce(F.col("split")[F.col("table")], F.lit(1)))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("digest"), F.col("chunks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    place = F.struct("label", "dim", "table", "bucket", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    rows = placed.withColumn("place", F.to_json(place)).select(*_ROWS)
    compared = (
        rows.repartition("place")
        .sortWithinPartitions("place", "rep")
        .mapInArrow(_compare(threshold), "rep bigint, links bigint, u bigint, v bigint")
    )
    compared = materialize(compared, "compared")
    links = compared.filter(F.col("rep").isNotNull()).groupBy("rep").agg(F.sum("links").alias("links"))
    found = connected_components(compared.filter(F.col("u").isNotNull()).select("u", "v"))
    known = (
        distinct.select(*key, "rep", "copies")
        .join(links, "rep", "left")
        .join(found.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            *key,
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    return prepared.drop("raw").join(known, key, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
