"""Near duplicates by an exact metric-space join under the Jaccard distance.

A document is the set of its distinct ``shingle``-word runs (words split at
ASCII white space, A-Z folded).  Two documents link when their Jaccard
similarity is at least ``percent`` hundredths; the result is the connected
components of the links.  The Jaccard distance d = 1 - similarity is a metric,
and t = 1 - percent/100 is the join radius.

1. *Equal sets* meet by digest; one document stands for each set.
2. *Blocks.*  Unrelated texts are all at distance 1 from each other and from
   any pivot, where the triangle inequality prunes nothing.  So sets are first
   split exactly: with at most D shingles in which two linked sets of a size
   class may differ, D + 1 + e classes of shingles hold one that is equal in
   both and not thin; e bounds the thin classes, of few shingles or none, that
   a set may have (a set with more uses its thin classes too).  Sets that share
   an equal class are tied, and components of the ties are
   blocks; linked sets are always in one block.  Blocks that are too large for
   a task are divided exactly once more, by the shingles that are rare in them.
3. *Regions.*  A block of more than ``max_block`` sets (or ``MAX_BYTES``) is measured against
   pivots of its own.  The largest component that the pivots' links make is
   settled: its sets are not compared with each other again.  The others stay
   open.  If they are many, the block is divided: an open set goes to the
   Voronoi region of its nearest pivot, cut into rings as wide as the join
   radius, and the sets that the triangle inequality lets link with it, those
   of the same ring and the rings beside it, are copied there.  Regions that
   are still too large are divided again by new pivots; there a component is
   settled only if it hangs together with what was settled before, and its sets
   still meet the copies of sets that are open in other regions.  What pivots no
   longer divide, and few open sets, meet the rest of their block chunk by chunk.
4. *Inside a task* the join goes on by pivots: distances to one set link it,
   and retire every set whose triangle window holds only its own component.

Every comparison that links is on the whole sets.  Shingles are told apart by
64-bit hashes.  Rows that share a doc_id count as one document when it is the
smallest id of their texts.  Null doc_id, null text and text without words
link with nothing; texts shorter than a shingle are one run of all their words.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import column, slices, utf8, values
from .components import connected_components
from .storage import Scratch, materialize, release
from .words import LOWER, RunHashes, mix, word_hashes

SHINGLE, PERCENT = 4, 85
MAX_BLOCK, PIVOTS, CHUNKS, ROUNDS = 1024, 16, 16, 5
MAX_BYTES = 64 << 20  # of sets that one task compares; one set that is larger is a chunk of its own at most
_CHUNK_KEYS = 1 << 20
# When a block is divided: shingles that come last in the order (1 MB), sets that make one common, rare ones to share.
COMMON, LEAST_COMMON, SHARED = 1 << 17, 16, 8


def shingle_set(text: bytes | None, shingle: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text."""
    words = text.translate(LOWER).split() if text else []
    runs = RunHashes(word_hashes(words))
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(runs.all(shingle) if len(words) >= shingle else runs.of(np.zeros(1, np.int64), len(words)))


class Signatures:
    """Equal classes of shingles, by size class.

    Size class c holds sizes from ``edge(c)`` to below ``edge(c + 1)``.  Edges
    grow by at most 100/percent, so linked sets lie in one class or in
    neighbours, and the scheme of the smaller set's class finds them: every set
    has keys under its own class and the one below.
    """

    def __init__(self, percent: int):
        self.percent = percent
        self.edges = [1]

    def edge(self, c: int) -> int:
        while len(self.edges) <= c:
            last = self.edges[-1]
            # The largest size that can link with a set of size ``last``, plus one.
            self.edges.append(last * 100 // self.percent + 1)
        return self.edges[c]

    def size_class(self, n: int) -> int:
        c = len(self.edges) - 1
        while self.edge(c) <= n:
            c += 1
        return int(np.searchsorted(self.edges, n, side="right")) - 1

    def differing(self, c: int) -> int:
        """Most shingles in which linked sets can differ, if the smaller is in class c: the union is at most
        100/percent of the smaller set, and (100 - percent) hundredths of the union may differ."""
        most = self.edge(c + 1) - 1
        union = most * 100 // self.percent
        return union * (100 - self.percent) // 100

    @lru_cache(maxsize=None)
    def scheme(self, c: int) -> tuple[int, int, int]:
        """(classes, spare, thin) of class c: of ``differ + 1 + spare`` classes, all but a few sets have at most
        ``spare`` with no more than ``thin`` shingles.  The larger ``thin``, the less unrelated sets meet."""
        differ, least = self.differing(c), self.edge(c)
        for thin in (2, 1, 0):
            spare = 0
            while spare <= 4 + 2 * (differ + 1) // 5:
                classes = differ + 1 + spare
                mean = least / classes
                few = classes * math.exp(-mean) * sum(mean**k / math.factorial(k) for k in range(thin + 1))
                need = math.ceil(few + 3 * math.sqrt(few))
                if need <= spare or thin == 0 and spare >= 2 + differ:
                    return classes, spare, thin
                spare += max(1, (need - spare) // 2)
        return classes, spare, 0

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """Keys of a set; linked, unequal sets share one."""
        n = len(shingles)
        own = self.size_class(n) if n else 0
        out = []
        for c in (own, own - 1):
            if c < 0 or n == 0 or self.differing(c) == 0:
                continue  # sets this small link only when equal
            classes, spare, thin = self.scheme(c)
            place = (mix(shingles + np.uint64(c)) % np.uint64(classes)).astype(np.int64)
            sums = np.zeros(classes, np.uint64)
            np.add.at(sums, place, mix(shingles ^ np.uint64(0x5851F42D4C957F2D)))
            sizes = np.bincount(place, minlength=classes)
            keep = sizes > thin
            if classes - keep.sum() > spare:
                keep[:] = True  # thinner than foreseen: its thin classes, empty ones too, count as well
            tag = mix(np.arange(classes, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(c))
            out.append(mix(sums + tag)[keep])
        return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def _outline(shingle: int):
    """Per document: the size of its set and a digest of it."""

    def run(batches):
        for batch in slices(batches):
            sizes, digests = [], []
            for text in utf8(batch, "text"):
                shingles = shingle_set(text, shingle)
                sizes.append(len(shingles))
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())],
                names=["doc_id", "n_shingles", "digest"],
            )

    return run


_TIES = pa.schema([("tie", pa.bool_()), ("a", pa.int64()), ("b", pa.int64())])


def _runs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by (a, b): where each run of equal a starts, and each row's run."""
    starts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
    return starts, np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(a)]))


def _distinct_pairs(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((v, u))
    u, v = u[order], v[order]
    new = np.r_[True, (u[1:] != u[:-1]) | (v[1:] != v[:-1])] if len(u) else np.zeros(0, bool)
    return u[new], v[new]


def _ties_of(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """One key row per key (with its smallest document), and a tie from each of its other documents to that one."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    starts, run = _runs(a, b)
    heads = b[starts][run] if len(a) else b
    other = b != heads
    u, v = _distinct_pairs(heads[other], b[other])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.r_[np.zeros(len(starts), bool), np.ones(len(u), bool)]),
            pa.array(np.r_[a[starts], u]),
            pa.array(np.r_[b[starts], v]),
        ],
        schema=_TIES,
    )


def _combine(keys_of):
    """Before the shuffle: keys that meet in this task are tied here, so a very common key sends one row per chunk.
    ``keys_of`` makes (doc_id, keys) of a batch's rows."""

    def run(batches):
        keys, docs, size = [], [], 0
        for batch in slices(batches):
            for doc_id, own in keys_of(batch):
                keys.append(own.view(np.int64))
                docs.append(np.full(len(own), doc_id, dtype=np.int64))
                size += len(own)
            if size >= _CHUNK_KEYS:
                yield _ties_of(np.concatenate(keys), np.concatenate(docs))
                keys, docs, size = [], [], 0
        if size:
            yield _ties_of(np.concatenate(keys), np.concatenate(docs))

    return run


def _signature_keys(shingle: int, percent: int):
    signatures = Signatures(percent)

    def keys_of(batch):
        for doc_id, text in zip(values(batch, "doc_id"), utf8(batch, "text")):
            yield doc_id, signatures.keys(shingle_set(text, shingle))

    return keys_of


def _meet(batches):
    """After the shuffle, rows sorted by (tie, a, b): ties pass, and a key's documents are tied to its first."""
    key = head = None
    for batch in batches:
        tie, a, b = (np.asarray(batch.column(i)) for i in range(3))
        u, v = [a[tie]], [b[tie]]
        a, b = a[~tie], b[~tie]
        if len(a):
            starts, run = _runs(a, b)
            first = b[starts]
            if a[0] == key:
                first = first.copy()
                first[0] = head
            heads = first[run]
            other = b != heads
            u.append(heads[other])
            v.append(b[other])
            key, head = a[-1], heads[-1]
        u, v = _distinct_pairs(np.concatenate(u), np.concatenate(v))
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def ties(rows: DataFrame, keys_of) -> DataFrame:
    """(u, v) between documents that share a key, enough to connect all that do.  No key is stored."""
    rows = rows.mapInArrow(_combine(keys_of), "tie boolean, a bigint, b bigint")
    spread = F.when(F.col("tie"), F.col("b")).otherwise(F.col("a"))
    met = rows.repartition(F.col("tie"), spread).sortWithinPartitions("tie", "a", "b")
    return met.mapInArrow(_meet, "u bigint, v bigint").distinct()


class Block:
    """Sets that are compared in one task; shingles as small numbers."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        names, self.flat = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_inverse=True)
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)
        self.ends = np.cumsum(self.sizes)
        self.marks = np.zeros(len(names), dtype=bool)

    def overlap(self, i: int) -> np.ndarray:
        """Shared shingles of set i with every set."""
        own = self.flat[self.ends[i] - self.sizes[i] : self.ends[i]]
        self.marks[own] = True
        shared = np.bincount(self.owner[self.marks[self.flat]], minlength=len(self.sizes))
        self.marks[own] = False
        return shared

    def against(self, i: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """(distance, linked) of set i to every set."""
        shared = self.overlap(i)
        union = self.sizes + self.sizes[i] - shared
        return 1.0 - shared / np.maximum(union, 1), 100 * shared >= percent * union


OPEN, SETTLED, GUEST, HOME = 0, 1, 2, 3


def links_in(docs: np.ndarray, sets: list[np.ndarray], state: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Enough links to connect whatever the links of the ``OPEN`` sets, and those between ``HOME`` and ``GUEST`` sets,
    connect.  ``SETTLED`` and ``HOME`` sets are one component already, ``GUEST`` sets have their home elsewhere.  A
    guest may be settled there in another component, so a set settled here, in its home, still has to meet it."""
    n, radius = len(sets), 1 - percent / 100 + 1e-9
    block = Block(sets)
    label = np.arange(n)
    home, guest = state == HOME, state == GUEST
    label[home | (state == SETTLED)] = -1
    waiting, out = state == OPEN, []
    if home.any() and guest.any():
        waiting |= home if home.sum() <= guest.sum() else guest
    while waiting.any() and (label != label[0]).any():
        pivot = int(np.flatnonzero(waiting)[0])
        waiting[pivot] = False
        distance, linked = block.against(pivot, percent)
        for other in np.flatnonzero(linked):
            if label[other] != label[pivot]:
                out.append((int(docs[pivot]), int(docs[other])))
                label[label == label[other]] = label[pivot]
        order = np.argsort(distance, kind="stable")
        near, names = distance[order], label[order]
        changes = np.r_[0, np.cumsum(names[1:] != names[:-1])]
        low = np.searchsorted(near, near - radius, side="left")
        high = np.searchsorted(near, near + radius, side="right") - 1
        waiting[order[changes[low] == changes[high]]] = False
    return out


_SET = "block bigint, doc_id bigint, state int, shingles binary"


def _shingles(shingle: int):
    def run(batches):
        for batch in slices(batches):
            packed = [shingle_set(t, shingle).tobytes() for t in utf8(batch, "text")]
            n = len(packed)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "block"), column(batch, "doc_id"), pa.array([OPEN] * n, pa.int32()), pa.array(packed, pa.binary())],
                names=["block", "doc_id", "state", "shingles"],
            )

    return run


def _unpack(rows: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(r, np.uint64) for r in rows]


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _join_blocks(percent: int):
    """Rows sorted by block, at most ``max_block`` of each."""

    def run(batches):
        block, held = None, ([], [], [])

        def close():
            docs, states, packed = held
            return _edges(links_in(np.array(docs, np.int64), _unpack(packed), np.array(states), percent))

        for batch in slices(batches):
            for now, *row in zip(*(values(batch, c) for c in ("block", "doc_id", "state", "shingles"))):
                if now != block and held[0]:
                    yield close()
                    held = ([], [], [])
                block = now
                for part, value in zip(held, row):
                    part.append(value)
        if held[0]:
            yield close()

    return run


_MEASURED = "block bigint, doc_id bigint, state int, shingles binary, mask int, rings array<int>, home int, linked array<bigint>"


def _measure(percent: int):
    """Distances of a part of a block to the block's pivots, as rings of the join radius's width."""
    width = 1 - percent / 100

    def run(rows, pivots):
        sets, at = _unpack(rows.column("shingles").to_pylist()), _unpack(pivots.column("shingles").to_pylist())
        names = np.asarray(pivots.column("doc_id"))
        known = np.unique(np.concatenate(at))
        member = np.stack([np.isin(known, p, assume_unique=True) for p in at], axis=1)
        sizes = np.array([len(p) for p in at])
        masks, rings, homes, linked = [], [], [], []
        for state, own in zip(rows.column("state").to_pylist(), sets):
            place = np.minimum(np.searchsorted(known, own), len(known) - 1)
            shared = member[place[known[place] == own]].sum(axis=0)
            union = len(own) + sizes - shared
            link = 100 * shared >= percent * union
            distance = 1.0 - shared / union
            masks.append(int((link << np.arange(len(at))).sum()) | (1 << PIVOTS if state in (SETTLED, HOME) else 0))
            rings.append(np.floor(distance / width + 1e-9).astype(np.int32))
            homes.append(int(np.argmin(distance)))
            linked.append(names[link])
        kinds = [pa.int32(), pa.list_(pa.int32()), pa.int32(), pa.list_(pa.int64())]
        extra = [pa.array(c, k) for c, k in zip((masks, rings, homes, linked), kinds)]
        out = rows.select(["block", "doc_id", "state", "shingles"])
        for name, c in zip(("mask", "rings", "home", "linked"), extra):
            out = out.append_column(name, c)
        return out

    return run


def _largest_star(settled: int):
    """Of each block, the pivots (bits) that hang together with the settled sets, which count as one pivot (bit
    ``settled``); if none are settled, those that hang together and have the most sets.  So settled sets of a block
    stay one component."""

    def run(batches):
        for batch in slices(batches):
            mains = []
            for stars in values(batch, "stars"):
                groups: list[list[int]] = []
                for star in stars:
                    bits, n = star["mask"], star["n"]
                    rest = []
                    for g in groups:
                        if g[0] & bits:
                            bits, n = bits | g[0], n + g[1]
                        else:
                            rest.append(g)
                    groups = [*rest, [bits, n]] if bits else groups
                mains.append(max(groups, key=lambda g: (g[0] & settled, g[1], g[0]))[0] if groups else 0)
            yield pa.RecordBatch.from_arrays([column(batch, "block"), pa.array(mains, pa.int32())], names=["block", "main"])

    return run


def _round(
    sets: DataFrame, counts: DataFrame, percent: int, part: int, settled: int, scratch: Scratch, step: int
) -> tuple[DataFrame, DataFrame]:
    """Measure blocks that are too large for a task against pivots of their own: (measured sets with new states,
    links to pivots).  Open sets that settle become ``settled``."""
    by_hash = Window.partitionBy("block").orderBy("settled", F.xxhash64("doc_id"), "doc_id")
    chosen = sets.filter(F.col("state").isin(OPEN, HOME)).groupBy("block", "doc_id")
    chosen = chosen.agg(F.min(F.col("state") != OPEN).alias("settled"))  # open sets first
    chosen = chosen.withColumn("rank", F.row_number().over(by_hash)).filter(F.col("rank") <= PIVOTS)
    chosen = chosen.select("block", "doc_id")
    pivots = sets.join(chosen, ["block", "doc_id"]).groupBy("block", "doc_id").agg(F.min("shingles").alias("shingles"))
    by_count, by_size = _total("n") / part, _total("bytes") / MAX_BYTES
    parts = counts.select("block", F.ceil(F.greatest(by_count, by_size)).cast("int").alias("parts"))
    left = sets.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    right = pivots.join(parts, "block").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = scratch.write(right, f"pivots-{step}")
    measured = scratch.write(
        left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(_measure(percent), _MEASURED),
        f"measured-{step}",
    )
    stars = measured.groupBy("block", "mask").agg(F.count(F.lit(1)).alias("n"))
    # At most 2**(PIVOTS + 1) masks per block.
    stars = stars.groupBy("block").agg(F.collect_list(F.struct("mask", "n")).alias("stars"))
    mains = stars.mapInArrow(_largest_star(1 << PIVOTS), "block bigint, main int")
    joins, state = F.col("mask").bitwiseAND(F.col("main")) != 0, F.col("state")
    now = F.when(joins & (state == OPEN), settled).when(joins & (state == GUEST), SETTLED).otherwise(state)
    links = measured.select(F.explode("linked").alias("u"), F.col("doc_id").alias("v")).filter("u <> v")
    states = scratch.write(measured.join(mains, "block").withColumn("state", now).drop("linked", "mask", "main"), f"states-{step}")
    return states, scratch.write(links, f"near-{step}")


def _cells(sets: DataFrame) -> DataFrame:
    """Voronoi regions, by ring: an open set goes to the ring of its nearest pivot; any set that the triangle
    inequality lets link with it (a ring beside it, of the same pivot) is copied there, as a guest if it is open
    elsewhere.  So are the guests of a settled set that has its home here.  Only cells that are some set's home arise."""
    ring = F.col("rings")[F.col("home")]
    is_open, is_home = F.col("state") == OPEN, F.col("state") == HOME
    cells = sets.filter(is_open | is_home).select("block", F.col("home").alias("pivot"), ring.alias("ring")).distinct()
    reach = F.posexplode("rings").alias("pivot", "own")
    copies = sets.select("block", "doc_id", "state", "shingles", "home", ring.alias("home_ring"), reach)
    copies = copies.withColumn("ring", F.explode(F.array(*(F.col("own") + d for d in (-1, 0, 1)))))
    placed = copies.join(cells, ["block", "pivot", "ring"])
    at_home = (F.col("pivot") == F.col("home")) & (F.col("ring") == F.col("home_ring"))
    state = F.when(is_open & ~at_home, GUEST).when(is_home & ~at_home, SETTLED).otherwise(F.col("state"))
    return placed.select(F.xxhash64("block", "pivot", "ring").alias("block"), "doc_id", state.alias("state"), "shingles")


# In this order, open sets meet all kinds and guests meet the two kinds before them.
_KINDS = {"open": OPEN, "home": HOME, "guest": GUEST, "settled": SETTLED}


def _chunk_pairs(sets: DataFrame, counts: DataFrame, chunk: int) -> DataFrame:
    """Every pair of chunks of a block with open sets in one of them, or with settled sets at home in one and guests in
    the other, as a block of its own."""
    joined = sets.select("block", "doc_id", "state", "shingles").join(counts, "block")
    starts = [F.lit(0)]
    for kind in _KINDS:
        size = F.greatest(F.col(f"n_{kind}") / chunk, F.col(f"bytes_{kind}") * 2 / MAX_BYTES)
        starts.append(starts[-1] + F.ceil(size).cast("int"))
    _, opened, homes, guests, end = starts

    def span(first, last):
        return F.when(last > first, F.sequence(first, last - 1)).otherwise(F.array().cast("array<int>"))

    meets = {
        OPEN: span(F.lit(0), end),
        HOME: F.concat(span(F.lit(0), opened), span(homes, guests)),
        GUEST: span(F.lit(0), homes),
        SETTLED: span(F.lit(0), opened),
    }
    own, others = F.lit(None).cast("int"), F.lit(None).cast("array<int>")
    for state, first, last in zip(_KINDS.values(), starts, starts[1:]):
        is_kind = F.col("state") == state
        own = F.when(is_kind, first + F.pmod(F.xxhash64("doc_id", F.lit(7)), last - first).cast("int")).otherwise(own)
        others = F.when(is_kind, meets[state]).otherwise(others)
    paired = joined.withColumn("own", own).withColumn("other", F.explode(others))
    pair = F.xxhash64("block", F.least("own", "other"), F.greatest("own", "other"))
    return paired.select(pair.alias("block"), "doc_id", "state", "shingles")


def _total(measure: str):
    return sum((F.col(f"{measure}_{kind}") for kind in _KINDS), F.lit(0))


def _fits(max_block: int):
    """Whether a block is joined in one task."""
    return (_total("n") <= max_block) & (_total("bytes") <= MAX_BYTES)


def _counts(sets: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Sets and bytes of each block by state; ``sets`` has the sets or, in their place, their ``size``."""
    size = F.col("size") if "size" in sets.columns else F.octet_length("shingles").cast("bigint")
    parts = []
    for kind, state in _KINDS.items():
        is_kind = F.col("state") == state
        parts.append(F.count(F.when(is_kind, 1)).alias(f"n_{kind}"))
        parts.append(F.sum(F.when(is_kind, size).otherwise(0)).alias(f"bytes_{kind}"))
    counts = sets.groupBy("block").agg(*parts)
    unmet = (F.col("n_open") > 0) | (F.col("n_home") > 0) & (F.col("n_guest") > 0)
    return scratch.write(counts.filter(unmet & (_total("n") > 1)), f"sizes-{name}")


def _packed(numbers: np.ndarray, ends: np.ndarray) -> pa.Array:
    """32-bit numbers as binary values, cut at ``ends``."""
    buffers = [None, pa.py_buffer(np.r_[0, 4 * ends].astype(np.int32)), pa.py_buffer(numbers.astype(np.uint32))]
    return pa.Array.from_buffers(pa.binary(), len(ends), buffers)


def _count_shingles(bits: int):
    """Before the shuffle: in how many sets of a chunk each shingle is.  A shingle goes by its first ``bits`` + 32 bits,
    its name: a row for each value of the first ``bits`` has the other 32 of the names of one set, then those of more
    sets and of how many.  So most shingles take four bytes."""

    def close(held):
        names, times = np.unique(np.concatenate(held) >> np.uint64(32 - bits), return_counts=True)
        parts, one = np.unique(names >> np.uint64(32)), times == 1
        once, more = (np.searchsorted(names[kind] >> np.uint64(32), parts, side="right") for kind in (one, ~one))
        columns = [pa.array(parts, pa.int32()), _packed(names[one], once), _packed(names[~one], more), _packed(times[~one], more)]
        return pa.RecordBatch.from_arrays(columns, names=["part", "once", "more", "times"])

    def run(batches):
        held, size = [], 0
        for batch in slices(batches):
            for own in _unpack(values(batch, "shingles")):
                held.append(own)
                size += len(own)
                if size >= _CHUNK_KEYS:
                    yield close(held)
                    held, size = [], 0
        if size:
            yield close(held)

    return run


def _add_counts(batches):
    """After the shuffle, rows sorted by part: (name, n) of the names that are in ``LEAST_COMMON`` sets or more."""
    part, held = None, []

    def close():
        once, more, times = (np.frombuffer(b"".join(c), np.uint32) for c in zip(*held))
        names, times = np.r_[once, more], np.r_[np.ones(len(once), np.int64), times.astype(np.int64)]
        order = np.argsort(names, kind="stable")
        names, times = names[order], times[order]
        starts = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
        n = np.add.reduceat(times, starts)
        enough = n >= LEAST_COMMON
        full = names[starts][enough].astype(np.int64) + (part << 32)
        return pa.RecordBatch.from_arrays([pa.array(full), pa.array(n[enough])], names=["name", "n"])

    for batch in slices(batches):
        for now, *row in zip(*(values(batch, c) for c in ("part", "once", "more", "times"))):
            if now != part and held:
                yield close()
                held = []
            part = now
            held.append(row)
    if held:
        yield close()


def _common_names(sets: DataFrame, bits: int) -> np.ndarray:
    """Names of the ``COMMON`` shingles that most of the sets have, the least frequent first."""
    sent = sets.mapInArrow(_count_shingles(bits), "part int, once binary, more binary, times binary")
    counts = sent.repartition("part").sortWithinPartitions("part").mapInArrow(_add_counts, "name bigint, n bigint")
    top = counts.orderBy(F.desc("n"), "name").limit(COMMON).collect()
    return np.array([r.name for r in reversed(top)], dtype=np.uint64)


def _rare_keys(percent: int, common: np.ndarray, rank: np.ndarray, bits: int):
    """(documents, keys, needs) of a batch: the shingles of each set that come first when those of ``common`` names come
    last, by rank, and how many of them a linked set shares at least."""

    def keys_of(batch):
        docs, keys, needs = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for block, doc_id, own in zip(values(batch, "block"), values(batch, "doc_id"), _unpack(values(batch, "shingles"))):
            n = len(own)
            overlap = -(-percent * n // 100)
            need = min(SHARED, overlap)
            names = own >> np.uint64(32 - bits)
            place = np.minimum(np.searchsorted(common, names), max(0, len(common) - 1))
            last = np.where(common[place] == names, rank[place], 0) if len(common) else np.zeros(n, np.int64)
            first = own[np.lexsort((mix(own), last))[: n - overlap + need]]
            keys.append(mix(first ^ mix(np.array([block], np.int64).view(np.uint64))))
            docs.append(np.full(len(first), doc_id, dtype=np.int64))
            needs.append(np.full(len(first), need, dtype=np.int64))
        return np.concatenate(docs), np.concatenate(keys).view(np.int64), np.concatenate(needs)

    return keys_of


_RARE = pa.schema([("key", pa.int64()), ("u", pa.int64()), ("v", pa.int64()), ("need", pa.int64())])


def _send_rare(keys_of):
    """Before the shuffle, rows (key, document, null, need).  A key that many documents of a chunk share sends its first
    document only, with need 0, and ties the others to it (key null)."""

    def close(docs, keys, needs):
        order = np.lexsort((docs, keys))
        docs, keys, needs = docs[order], keys[order], needs[order]
        starts, run = _runs(keys, docs)
        many = np.diff(np.r_[starts, len(keys)])[run] >= LEAST_COMMON if len(keys) else np.zeros(0, bool)
        head = np.zeros(len(keys), bool)
        head[starts] = True
        sent = ~many | head
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[sent]), pa.array(docs[sent]), pa.nulls(int(sent.sum()), pa.int64()), pa.array(np.where(many, 0, needs)[sent])],
            schema=_RARE,
        )
        u, v = _distinct_pairs(docs[starts][run][~sent], docs[~sent]) if len(keys) else (docs, docs)
        if len(u):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(u), pa.int64()), pa.array(u), pa.array(v), pa.array(np.zeros(len(u), np.int64))], schema=_RARE
            )

    def run(batches):
        held, size = [], 0
        for batch in slices(batches):
            held.append(keys_of(batch))
            size += len(held[-1][0])
            if size >= _CHUNK_KEYS:
                yield from close(*(np.concatenate(c) for c in zip(*held)))
                held, size = [], 0
        if held:
            yield from close(*(np.concatenate(c) for c in zip(*held)))

    return run


_PAIRS = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("shared", pa.int64()), ("need", pa.int64())])


def _add_pairs(parts: list[tuple]) -> tuple:
    """Pairs (u, v, shared, need) of several lists as one row each: what they share is added, the least need holds."""
    u, v, shared, need = (np.concatenate(c) for c in zip(*parts))
    if not len(u):
        return u, v, shared, need
    order = np.lexsort((v, u))
    u, v, shared, need = u[order], v[order], shared[order], need[order]
    starts = np.flatnonzero(np.r_[True, (u[1:] != u[:-1]) | (v[1:] != v[:-1])])
    return u[starts], v[starts], np.add.reduceat(shared, starts), np.minimum.reduceat(need, starts)


def _meet_rare(batches):
    """After the shuffle, rows sorted by key: pairs of the documents of a key, with what they need to share, if fewer than
    ``LEAST_COMMON`` share it; else each is tied to the first, needing nothing.  Pairs that meet under several keys of
    this task are added up here, at most ``_CHUNK_KEYS`` at a time."""

    def pairs(key, docs, needs):
        starts, run = _runs(key, docs)
        sizes = np.diff(np.r_[starts, len(key)])
        many = ((sizes >= LEAST_COMMON) | (np.minimum.reduceat(needs, starts) == 0))[run] if len(key) else np.zeros(0, bool)
        heads = docs[starts][run] if len(key) else docs
        tied = many & (docs != heads)
        u, v, need = [heads[tied]], [docs[tied]], [np.zeros(int(tied.sum()), np.int64)]
        for step in range(1, min(LEAST_COMMON, len(key))):
            same = np.flatnonzero((key[step:] == key[:-step]) & ~many[step:])
            if not len(same):
                break
            a, b = docs[same], docs[same + step]
            other = a != b
            u.append(np.minimum(a, b)[other])
            v.append(np.maximum(a, b)[other])
            need.append(np.minimum(needs[same], needs[same + step])[other])
        u = np.concatenate(u)
        return u, np.concatenate(v), np.ones(len(u), np.int64), np.concatenate(need)

    def rows(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_PAIRS)

    held, found, size = [np.zeros(0, np.int64)] * 3, [], 0
    for batch in batches:
        key, docs, needs = (np.concatenate([h, np.asarray(batch.column(i))]) for h, i in zip(held, (0, 1, 3)))
        if not len(key):
            continue
        whole = np.searchsorted(key, key[-1]) if key[0] != key[-1] else 0
        new = [pairs(key[:whole], docs[:whole], needs[:whole])]
        held = [key[whole:], docs[whole:], needs[whole:]]
        if len(held[0]) > _CHUNK_KEYS:  # a key of very many documents: its first stands for those seen
            new.append(pairs(*held))
            held = [held[0][:1], held[1][:1], np.zeros(1, np.int64)]
        found += new
        size += sum(len(n[0]) for n in new)
        if size >= _CHUNK_KEYS:
            found = [_add_pairs(found)]
            size = len(found[0][0])
            if size >= _CHUNK_KEYS // 2:
                yield rows(found[0])
                found, size = [], 0
    yield rows(_add_pairs([*found, pairs(*held)]))


def split_by_rare(sets: DataFrame, percent: int, scratch: Scratch, sets_of=None, n_shingles: int = 0) -> DataFrame:
    """Blocks divided exactly: sets stay together if pairs that share enough rare shingles connect them.

    Linked sets of n shingles share at least o = ceil(percent n / 100) of them, so in any one order of all shingles
    they share k of the first n - o + k of either (a prefix filter; k = ``SHARED``, or o if that is less).  The order
    puts the ``COMMON`` most frequent shingles of these blocks last, the others by hash.  A shingle that fewer than
    ``LEAST_COMMON`` sets send gives their pairs, which are counted; one that more send ties them all, whatever else
    they share.  Both numbers decide only how small the parts get.  Sets that nothing connects have no link and are
    dropped.

    With ``sets_of``, which makes the sets of (doc_id, block) anew, ``sets`` is the scratch table "large": it is removed
    as soon as its keys are sent.  ``n_shingles``, of all sets, decides in how many parts they are counted."""
    bits = min(16, max(8, (n_shingles >> 21).bit_length()))
    common = _common_names(sets, bits)
    release(sets.sparkSession)
    order = np.argsort(common)
    keys_of = _rare_keys(percent, common[order], np.arange(1, len(common) + 1)[order], bits)
    schema = "key bigint, u bigint, v bigint, need bigint"
    sent = scratch.write(sets.mapInArrow(_send_rare(keys_of), schema), "rare-keys")
    if sets_of is not None:
        scratch.drop("large")
    met = sent.filter("key is not null").repartition("key").sortWithinPartitions("key")
    met = met.mapInArrow(_meet_rare, "u bigint, v bigint, shared bigint, need bigint")
    tied_early = sent.filter("key is null").select("u", "v", F.lit(1).cast("bigint").alias("shared"), "need")
    pairs = met.unionByName(tied_early).groupBy("u", "v")
    pairs = pairs.agg(F.sum("shared").alias("shared"), F.min("need").alias("need")).filter("shared >= need")
    tied = scratch.write(pairs.select("u", "v"), "rare-ties")
    parts = connected_components(tied, f"{scratch.folder}/rare-tied")
    parts = parts.select(F.col("node").alias("doc_id"), F.col("component").alias("block"))
    scratch.drop("rare-keys", "rare-ties")
    divided = sets.drop("block").join(parts.hint("merge"), "doc_id") if sets_of is None else sets_of(parts)
    divided = scratch.write(divided.select("block", "doc_id", "state", "shingles"), "rare-sets")
    scratch.drop("rare-tied")
    return divided


def verified_links(sets: DataFrame, percent: int = PERCENT, max_block: int = MAX_BLOCK) -> DataFrame:
    """(u, v): links that connect what all links within blocks (``sets``: block, doc_id, state, shingles) connect.  A
    table on the shared folder; what leads to it is removed."""
    return _links_in(sets, lambda found: sets.join(found.select("block"), "block", "left_semi"), None, percent, max_block)


def _links_in(sizes: DataFrame, in_blocks, sets_of, percent: int, max_block: int) -> DataFrame:
    """As ``verified_links``, with ``in_blocks`` (blocks → their sets) in place of sets; ``sizes`` has the sets or their
    block, state and size.  With ``sets_of`` (documents and blocks → sets) no table has all sets: those of blocks that fit
    a task are made on their way to it, those of larger blocks are a table until their keys are sent, and the ones that
    these connect are made anew."""
    scratch = Scratch(sizes.sparkSession, "blocks")
    fits, chunk = _fits(max_block), max(1, max_block // 2)
    counts = _counts(sizes, scratch, "first")
    tasks = [in_blocks(counts.filter(fits))]
    links = []
    large = counts.filter(~fits)
    if large.take(1):
        n_shingles = large.agg(F.sum(_total("bytes"))).first()[0] // 8
        sets = in_blocks(large)
        if sets_of is not None:
            sets = scratch.write(sets, "large")
            release(sizes.sparkSession)
        sets = split_by_rare(sets, percent, scratch, sets_of, n_shingles)
        counts = _counts(sets, scratch, "rare")
        tasks.append(sets.join(counts.filter(fits).select("block"), "block", "left_semi"))
        large = counts.filter(~fits)
    for step in range(ROUNDS):
        if not large.take(1):
            break
        # Guests arise with the first regions.
        states, near = _round(
            sets.join(large.select("block"), "block", "left_semi"), large, percent, 4 * chunk, HOME if step else SETTLED, scratch, step
        )
        scratch.drop(f"pivots-{step}", f"measured-{step}")
        links.append(near)
        now = _counts(states, scratch, f"states-{step}")
        # Few enough open sets meet the rest chunk by chunk; more are divided first.
        unmet = F.greatest(F.col("n_open"), F.least("n_home", "n_guest"))
        few = now.filter(unmet <= CHUNKS * chunk) if step + 1 < ROUNDS else now
        tasks.append(_chunk_pairs(states, few, chunk))
        many = now.join(few.select("block"), "block", "left_anti").select("block")
        if not many.take(1):
            break
        sets = scratch.write(_cells(states.join(many, "block", "left_semi")), f"cells-{step}")
        counts = _counts(sets, scratch, f"cells-{step}")
        tasks.append(sets.join(counts.filter(fits).select("block"), "block", "left_semi"))
        large = counts.filter(~fits)
    rows = tasks[0]
    for more in tasks[1:]:
        rows = rows.unionByName(more)
    ordered = rows.repartition("block").sortWithinPartitions("block")
    out = ordered.mapInArrow(_join_blocks(percent), "u bigint, v bigint")
    for more in links:
        out = out.unionByName(more)
    out = materialize(out, "links")
    scratch.drop("")
    return out


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, max_block: int = MAX_BLOCK
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text); its other columns are not read.

    component_id is the smallest doc_id reachable by links, itself included (null for a null doc_id).  The result is a
    table on the shared folder; every intermediate one is removed after its last reader.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-duplicates")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    outline = scratch.write(texts.mapInArrow(_outline(shingle), "doc_id bigint, n_shingles bigint, digest binary"), "outline")
    firsts = scratch.write(
        outline.filter(F.col("n_shingles") > 0).groupBy("digest").agg(F.min("doc_id").alias("first")), "firsts"
    )
    # One document of each set is compared, the smallest that has it: copies send no keys and no text.
    heads = firsts.select(F.col("first").alias("doc_id")).distinct()
    one_each = texts.join(heads.hint("merge"), "doc_id", "left_semi")
    tied = scratch.write(ties(one_each, _signature_keys(shingle, percent)), "ties")
    release(spark)
    blocks = connected_components(tied, f"{scratch.folder}/tied").select(F.col("node").alias("doc_id"), F.col("component").alias("block"))
    blocks = scratch.write(blocks, "blocks")
    scratch.drop("ties", "tied")

    def sets_of(placed):
        rows = texts.join(placed.hint("merge"), "doc_id").select("block", "doc_id", "text")
        return rows.mapInArrow(_shingles(shingle), _SET)

    def in_blocks(found):
        return sets_of(blocks.join(found.select("block"), "block", "left_semi"))

    sizes = outline.join(blocks.hint("merge"), "doc_id")
    sizes = sizes.select("block", F.lit(OPEN).alias("state"), (8 * F.col("n_shingles")).alias("size"))
    links = _links_in(sizes, in_blocks, sets_of, percent, max_block)
    scratch.drop("blocks")
    found = connected_components(links, f"{scratch.folder}/linked")
    firsts = firsts.join(found, F.col("first") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "first").alias("component")
    )
    joined = outline.join(firsts, "digest", "left")
    own = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("component"))
    groups = joined.select("doc_id", "n_shingles", F.coalesce(own, F.col("doc_id")).alias("component_id"))
    groups = materialize(groups, "groups")
    scratch.drop("")
    return groups


def keep_first(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without those that a document of smaller doc_id stands for."""
    groups = near_duplicates(docs, shingle, percent)
    gone = groups.filter("component_id < doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
