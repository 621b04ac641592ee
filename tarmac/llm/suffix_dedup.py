"""Substring dedup by suffix arrays over content-defined phrases.

The law: a byte goes if some run of ``window`` bytes that covers it also starts
anywhere else, in another document or in the same one.

*Blocks.*  Each run of ``window`` bytes elects the byte group with the smallest
hash in it, its anchor; neighbouring runs with equal anchors make a block, the
stretch of bytes that they cover.  Equal runs elect equal anchors, so only
blocks with the same anchor have to meet, and only if the corpus holds that
anchor twice (or one block does).  A block that occurs twice whole is a duplicate; of each distinct
block one copy goes on, to the task of its anchor.

*Suffix arrays.*  A task lays the blocks of its anchors end to end, cuts them
where the last bytes hash to zero (or no such place came for long), and ranks
the phrases between cuts by their bytes.  The suffix array of the sequence of
phrases is built by linear grouping (Baier 2016, "Linear-time suffix sorting"):
suffixes start in groups of equal first symbols; groups are taken in descending
order, each suffix points to the previous smaller one, whose group is refined
by the group that points to it, until groups share their longest Lyndon prefix;
then one ascending pass emits the order inside the groups along the same
pointers.  Nothing is renamed and nothing recurs.

*Matches.*  A run of bytes starts shortly before the first cut that its own
bytes make certain.  Two runs are equal if the bytes before that cut are, and if
the suffixes at the cut share the rest: that is, lie in one stretch of the
suffix array over which neighbours share as many bytes.  Neighbours are compared
byte by byte; bytes before cuts by 64-bit hashes, whole blocks by 128.

Blocks of an anchor that are more than ``GROUP`` bytes together do not go to one
task: their runs meet by 128-bit hash over all tasks, each task sending every
distinct run once.

Null and empty texts have no bytes.  Matches never cross documents.  Rows are
told apart by a hash of doc_id and text, which both may be null or repeated:
rows with equal texts remove each other's runs.  Texts are read in pieces of
``PIECE`` bytes, so long ones need no more memory.  The columns of a row are in
the struct ``row``, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import column, slices, utf8, values
from .storage import Scratch, dealt_anew
from .words import RunHashes, mix

WINDOW = 400
PIECE = 1 << 20  # bytes of a text that are hashed at a time
BATCH = 1 << 19  # bytes of blocks that make one suffix array
GROUP = 1 << 20  # bytes of blocks of one anchor that one task takes


@lru_cache(maxsize=2)
def _letters(seed: int) -> np.ndarray:
    """A 64-bit number for each byte."""
    return mix(np.arange(256, dtype=np.uint64) + np.uint64(256 * seed + 1))


def run_hashes(data: np.ndarray, seed: int = 0) -> RunHashes:
    return RunHashes(_letters(seed)[data])


class Shape:
    """Lengths that follow from the window: of anchors, of the bytes that make a cut, and of the longest way to one."""

    def __init__(self, window: int):
        if window < 16:
            raise ValueError("a window has 16 bytes or more")
        self.window = window
        self.anchor = window * 4 // 25
        self.gram = min(8, window // 8)
        self.gap = min(192, window // 2 - self.gram)
        self.rate = max(2, window // 12)  # one place in so many is a cut


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= size:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    rest = size - reach
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def _several(groups: np.ndarray, elected: np.ndarray, first: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Whether a block holds its anchor more than once: only then its own runs may be equal."""
    reach = len(groups) - len(elected)
    padded = np.full(len(groups) + reach, ~np.uint64(0))
    padded[reach : reach + len(elected)] = ~elected
    places = np.flatnonzero(groups == ~_sliding_min(padded, reach + 1))  # of groups that some run elects
    names, name = np.unique(groups[places], return_inverse=True)
    width = len(groups) + 1
    keys = np.sort(name * width + places)
    own = np.searchsorted(names, elected[first]) * width + first
    return np.searchsorted(keys, own + runs - 1 + reach, side="right") - np.searchsorted(keys, own) > 1


def blocks_of(data: np.ndarray, bounds: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, runs, anchor, several) of the blocks of texts laid end to end in ``data``, text i ending at ``bounds[i]``;
    ``several`` if the block holds its anchor more than once."""
    none = np.zeros(0, np.int64)
    if len(data) < shape.window:
        return none, none, none, none.astype(bool)
    groups = run_hashes(data).all(shape.anchor)
    elected = _sliding_min(groups, shape.window - shape.anchor + 1)
    starts = np.r_[0, bounds[:-1]]
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    long = bounds - starts >= shape.window
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, bounds[long] - shape.window + 1, -1)
    valid = np.cumsum(inside[: len(elected)]) > 0
    fresh = np.r_[True, elected[1:] != elected[:-1]] | np.r_[True, ~valid[:-1]]
    fresh[starts[starts < len(fresh)]] = True
    first = np.flatnonzero(fresh & valid)
    ends = np.flatnonzero(np.r_[fresh[1:] | ~valid[1:], True] & valid)
    runs = ends - first + 1
    return first, runs, elected[first].view(np.int64), _several(groups, np.where(valid, elected, 0), first, runs)


def _pieces(texts: list[bytes | None], window: int):
    """Groups of (row, offset, bytes), each group of about ``PIECE`` bytes; neighbours in a text overlap by a run."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(0, len(text or b"") - window + 1), PIECE):
            piece = text[at : at + PIECE + window - 1]
            held.append((i, at, piece))
            size += len(piece)
            if size >= PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


_BLOCKS = "k1 bigint, k2 bigint, anchor bigint, h1 bigint, h2 bigint, first bigint, runs bigint, several boolean"


def _find_blocks(shape: Shape):
    def run(batches):
        for batch in slices(batches):
            keys = np.stack([np.asarray(column(batch, k)) for k in ("k1", "k2")], axis=1)
            for held in _pieces(utf8(batch, "text"), shape.window):
                joined = b"".join(p for _, _, p in held)
                bounds = np.cumsum([len(p) for _, _, p in held])
                first, runs, anchor, several = blocks_of(np.frombuffer(joined, np.uint8), bounds, shape)
                owner = np.searchsorted(bounds, first, side="right")
                view = memoryview(joined)
                spans = zip(first.tolist(), (first + runs + shape.window - 1).tolist())
                digests = b"".join([xxhash.xxh3_128_digest(view[a:b]) for a, b in spans])
                hashes = np.frombuffer(digests, np.int64).reshape(-1, 2)
                row = np.array([i for i, _, _ in held], dtype=np.int64)[owner]
                offset = np.array([at for _, at, _ in held], dtype=np.int64) - np.r_[0, bounds[:-1]]
                cols = [keys[row, 0], keys[row, 1], anchor, hashes[:, 0], hashes[:, 1], first + offset[owner], runs, several]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=[c.split()[0] for c in _BLOCKS.split(", ")])

    return run


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of ``symbols`` (whole numbers above 0) in ascending order."""
    s = np.r_[np.asarray(symbols, dtype=np.int64), 0]
    n = len(s)
    order = np.argsort(s, kind="stable")
    starts = np.flatnonzero(np.r_[True, s[order[1:]] != s[order[:-1]]])
    sizes = np.diff(np.r_[starts, n])
    by_start, by_suffix, inverse = np.zeros(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
    by_start[starts] = sizes
    by_suffix[order] = np.repeat(starts, sizes)
    inverse[order] = np.arange(n)
    array, place, group, size = order.tolist(), inverse.tolist(), by_suffix.tolist(), by_start.tolist()
    previous = [-1] * n

    # Groups from the highest down; a group that is reached has its longest Lyndon prefix.
    high = n - 1
    while high > 0:
        g = group[array[high]]
        members = sorted(array[g : high + 1]) if g < high else (array[g],)
        high = g - 1
        times: dict[int, int] = {}
        for i in members:
            p = i - 1
            while p >= 0 and group[p] >= g:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        if not times:
            continue
        # Suffixes that this group follows more often come higher among those they were equal to.
        if len(times) == 1 or max(times.values()) == 1:
            rounds = [list(times)]
        else:
            by_times = defaultdict(list)
            for p, k in times.items():
                by_times[k].append(p)
            rounds = [by_times[k] for k in sorted(by_times, reverse=True)]
        for followed in rounds:
            moved: dict[int, int] = {}
            for p in followed:
                a = group[p]
                last = a + size[a] - 1
                at, q = place[p], array[last]
                array[at], place[q], array[last], place[p] = q, at, p, last
                size[a] -= 1
                moved[a] = moved.get(a, 0) + 1
            new = {}
            for a, count in moved.items():
                new[a] = start = a + size[a]
                size[start] = count
            for p in followed:
                group[p] = new[group[p]]

    # In ascending order, each suffix places those whose next smaller suffix it is.
    slot = list(range(n))
    out, placed = [-1] * n, [False] * n
    out[0], placed[n - 1], slot[0] = n - 1, True, 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[slot[g]] = j
            slot[g] += 1
            placed[j] = True
            j = previous[j]
    return np.array(out[1:], dtype=np.int64)


class Phrases:
    """Blocks laid end to end, cut into phrases; block i holds the bytes from ``starts[i]`` to ``ends[i]``."""

    def __init__(self, blocks: list[bytes], shape: Shape):
        self.shape = shape
        self.text = b"".join(blocks)
        self.data = np.frombuffer(self.text, np.uint8)
        sizes = np.array([len(b) for b in blocks], dtype=np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.hashes = run_hashes(self.data)
        n = len(self.data)
        gram, gap = shape.gram, shape.gap
        owner_start = np.repeat(self.starts, sizes)
        at = np.arange(n)
        chosen = np.zeros(n, dtype=bool)  # the gram before a place hashes to zero
        grams = self.hashes.all(gram)
        chosen[gram:] = ((grams >> np.uint64(32)) * np.uint64(shape.rate) >> np.uint64(32) == 0)[: n - gram]
        chosen &= at >= owner_start + gram
        places = np.flatnonzero(chosen)
        before = np.r_[-1, places][np.searchsorted(places, at, side="right")]
        forced = (before < at - gap) & (at >= owner_start + gram + gap)
        self.cuts = np.flatnonzero(chosen | forced)
        self.next_chosen = np.r_[places, n + gap + 1]
        self.places = places
        self.cut_at = np.full(n + 1, -1, dtype=np.int64)
        self.cut_at[self.cuts] = np.arange(len(self.cuts))

    def ordered(self) -> tuple[np.ndarray, np.ndarray]:
        """(rank of every cut among the suffixes at cuts, bytes that each of them shares with the one before)."""
        block = np.searchsorted(self.ends, self.cuts, side="right")
        stops = np.minimum(np.r_[self.cuts[1:], len(self.data)], self.ends[block])
        phrases = [self.text[a:b] for a, b in zip(self.cuts.tolist(), stops.tolist())]
        ranks = {p: i for i, p in enumerate(sorted(set(phrases)), 2)}
        # A separator, lower than every phrase, ends each block.
        last = np.flatnonzero(np.r_[block[1:] != block[:-1], True])
        symbols = np.insert(np.fromiter(map(ranks.__getitem__, phrases), np.int64, len(phrases)), last + 1, 1)
        cut_of = np.insert(np.arange(len(self.cuts)), last + 1, -1)
        order = cut_of[suffix_array(symbols)]
        order = order[order >= 0]
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        return rank, self._shared(self.cuts[order], (self.ends[block] - self.cuts)[order])

    def _shared(self, at: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Equal bytes of neighbours, at most ``window``, within their blocks."""
        window = self.shape.window
        padded = np.r_[self.data, np.zeros(window, np.uint8)]
        reach = np.arange(window)
        out = np.zeros(len(at), dtype=np.int64)
        for k in range(1, len(at), 2048):
            a, b = at[k - 1 : k + 2047], at[k : k + 2048]
            a = a[: len(b)]
            differ = padded[a[:, None] + reach] != padded[b[:, None] + reach]
            out[k : k + 2048] = np.where(differ.any(axis=1), differ.argmax(axis=1), window)
        out[1:] = np.minimum(out[1:], np.minimum(left[1:], left[:-1]))
        return out

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """(start, repeated) of every run of ``window`` bytes inside a block: whether the bytes start elsewhere, too."""
        shape = self.shape
        counts = self.ends - self.starts - shape.window + 1
        start = np.repeat(self.starts - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
        rank, shared = self.ordered()
        certain = start + shape.gram
        cut = np.minimum(self.next_chosen[np.searchsorted(self.places, certain)], certain + shape.gap)
        lead = cut - start
        where = rank[self.cut_at[cut]]
        key = mix(self.hashes.of(start, lead))
        order = np.argsort(lead, kind="stable")
        leads, at = np.unique(lead[order], return_index=True)
        for t, sel in zip(leads.tolist(), np.split(order, at[1:])):
            stretch = np.cumsum(shared < shape.window - t)
            key[sel] += mix(stretch[where[sel]].astype(np.uint64) * np.uint64(1024) + np.uint64(t))
        _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
        return start, times[inverse] > 1


_SPANS = "k1 bigint, k2 bigint, first bigint, last bigint"


def _span_rows(k1, k2, first, last) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (k1, k2, first, last)], names=["k1", "k2", "first", "last"])


def _spans(flags: np.ndarray, block: np.ndarray, at: np.ndarray, k1, k2) -> pa.RecordBatch:
    """Stretches of flagged runs: ``block`` and position ``at`` (in the document) of each run, in order."""
    flagged = np.flatnonzero(flags)
    joined = (np.diff(flagged) == 1) & (np.diff(block[flagged]) == 0) if len(flagged) else np.zeros(0, bool)
    first, last = flagged[np.r_[True, ~joined][: len(flagged)]], flagged[np.r_[~joined, True][: len(flagged)]]
    return _span_rows(k1[block[first]], k2[block[first]], at[first], at[last])


def _suffix_matches(shape: Shape):
    """Rows sorted by anchor: the runs of blocks that are no duplicates whole, but occur in other blocks."""

    def close(held):
        phrases = Phrases([h[4] for h in held], shape)
        start, found = phrases.repeated()
        block = np.searchsorted(phrases.ends, start, side="right")
        k1, k2, first = (np.array([h[i] for h in held], dtype=np.int64) for i in range(3))
        found &= ~np.array([h[3] for h in held], dtype=bool)[block]
        return _spans(found, block, start - phrases.starts[block] + first[block], k1, k2)

    def run(batches):
        held, size, anchor = [], 0, None
        for batch in slices(batches):
            rows = zip(*(values(batch, c) for c in ("anchor", "k1", "k2", "first", "whole", "bytes")))
            for now, *row in rows:
                if size >= BATCH and now != anchor:
                    yield close(held)
                    held, size = [], 0
                anchor = now
                held.append(row)
                size += len(row[4])
        if held:
            yield close(held)

    return run


_RUNS = "w1 bigint, w2 bigint, known boolean, " + _SPANS


def _send_runs(shape: Shape):
    """Every distinct run of a batch of blocks, by its hash; runs that repeat within the batch are known duplicates."""

    def close(held):
        data = np.frombuffer(b"".join(h[4] for h in held), np.uint8)
        ends = np.cumsum([len(h[4]) for h in held])
        sizes = np.diff(np.r_[0, ends])
        counts = sizes - shape.window + 1
        block = np.repeat(np.arange(len(held)), counts)
        inside = np.arange(len(block)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = (ends - sizes)[block] + inside
        w1, w2 = (run_hashes(data, seed).of(start, shape.window).view(np.int64) for seed in (0, 1))
        order = np.lexsort((w2, w1))
        fresh = np.r_[True, (np.diff(w1[order]) != 0) | (np.diff(w2[order]) != 0)]
        name = np.cumsum(fresh) - 1
        times = np.bincount(name)
        repeats = np.zeros(len(block), dtype=bool)
        repeats[order] = times[name] > 1
        k1, k2, first = (np.array([h[i] for h in held], dtype=np.int64) for i in range(3))
        whole = np.array([h[3] for h in held], dtype=bool)
        at = inside + first[block]
        own = _spans(repeats & ~whole[block], block, at, k1, k2)
        sent = order[fresh]
        known = (times > 1) | whole[block[sent]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (w1[sent], w2[sent], known, k1[block[sent]], k2[block[sent]], at[sent], at[sent])],
            names=[c.split()[0] for c in _RUNS.split(", ")],
        )
        if own.num_rows:  # null w1 for what is settled already
            none = pa.nulls(own.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, pa.nulls(own.num_rows, pa.bool_()), *own.columns], names=[c.split()[0] for c in _RUNS.split(", ")]
            )

    def run(batches):
        held, size = [], 0
        for batch in slices(batches):
            for row in zip(*(values(batch, c) for c in ("k1", "k2", "first", "whole", "bytes"))):
                held.append(row)
                size += len(row[4])
                if size >= BATCH:
                    yield from close(held)
                    held, size = [], 0
        if held:
            yield from close(held)

    return run


def _meet_runs(batches):
    """Rows sorted by hash, a row per batch and run: those that more than one batch sent are duplicates."""
    carry = None  # the last run of the rows so far, if only one batch has sent it: it may go on
    seen = None
    for batch in batches:
        w1, w2, known, k1, k2, first = (np.asarray(batch.column(i)) for i in (0, 1, 2, 3, 4, 5))
        if not len(w1):
            continue
        same = (w1[1:] == w1[:-1]) & (w2[1:] == w2[:-1])
        head = seen is not None and seen == (w1[0], w2[0])
        met = np.r_[head, same] | np.r_[same, False]
        out = met & ~known.astype(bool)
        if head and carry is not None:
            yield carry
        yield _span_rows(k1[out], k2[out], first[out], first[out])
        seen = (w1[-1], w2[-1])
        alone = not met[-1] and not known[-1]
        carry = _span_rows(k1[-1:], k2[-1:], first[-1:], first[-1:]) if alone else None


def _cut_blocks(shape: Shape):
    def run(batches):
        for batch in slices(batches, 64):
            rows = []
            for k1, k2, text, blocks in zip(*(values(batch, k) for k in ("k1", "k2")), utf8(batch, "text"), values(batch, "blocks")):
                for b in blocks:
                    piece = text[b["first"] : b["first"] + b["runs"] + shape.window - 1]
                    rows.append((k1, k2, b["anchor"], b["first"], b["whole"], b["large"], piece))
            kinds = [pa.int64()] * 4 + [pa.bool_()] * 2 + [pa.binary()]
            cols = zip(*rows) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)], names=["k1", "k2", "anchor", "first", "whole", "large", "bytes"]
            )

    return run


KEY = ["k1", "k2"]


def _keyed(docs: DataFrame, *more) -> DataFrame:
    """Two hashes of doc_id and text (equal rows share them), and the text."""
    text = F.col("text").cast("string")
    return docs.select(
        *more, F.xxhash64("doc_id", text).alias("k1"), F.xxhash64(F.lit(7), text, "doc_id").alias("k2"), text.alias("text")
    )


def repeated_spans(docs: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """(k1, k2, spans): for every text (see ``_keyed``) with repeated runs, the first and last of the starts of each
    stretch of them."""
    shape, spark = Shape(window), docs.sparkSession
    scratch = Scratch(spark, "suffix-dedup")
    texts = _keyed(docs)
    long = texts.filter(F.octet_length("text") >= window)
    blocks = scratch.write(
        long.mapInArrow(_find_blocks(shape), _BLOCKS).withColumn("id", F.monotonically_increasing_id()), "blocks"
    )
    twice = blocks.groupBy("anchor").agg(F.count(F.lit(1)).alias("times"), F.max("several").alias("several"))
    twice = twice.filter("times > 1 or several").select("anchor")
    met = scratch.write(blocks.join(dealt_anew(twice, "anchor"), "anchor"), "met")
    scratch.drop("blocks")

    # One row per distinct block, and per anchor how much its distinct blocks are.
    name = ["anchor", "h1", "h2"]
    kinds = scratch.write(
        met.groupBy(*name, "runs", "several").agg(F.count(F.lit(1)).alias("times"), F.min("id").alias("sent")), "kinds"
    )
    sums = kinds.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum(F.col("runs") + (window - 1)).alias("size")
    )
    kinds = kinds.join(dealt_anew(sums, "anchor"), "anchor")
    kinds = scratch.write(
        kinds.select(
            *name,
            "runs",
            (F.col("times") > 1).alias("whole"),
            F.when((F.col("kinds") > 1) | F.col("several"), F.col("sent")).alias("sent"),
            (F.col("size") > group).alias("large"),
        ),
        "named",
    )
    tagged = scratch.write(
        met.join(kinds, [*name, "runs"]).select(
            *KEY, "anchor", "first", "runs", "whole", "large", (F.col("id") == F.col("sent")).alias("sent")
        ),
        "tagged",
    )
    scratch.drop("met", "kinds", "named")

    block = F.struct("anchor", "first", "runs", "whole", "large")
    wanted = scratch.write(tagged.filter("sent").groupBy(*KEY).agg(F.collect_list(block).alias("blocks")), "wanted")
    sent = scratch.write(
        long.join(wanted.hint("merge"), KEY).mapInArrow(
            _cut_blocks(shape), "k1 bigint, k2 bigint, anchor bigint, first bigint, whole boolean, large boolean, bytes binary"
        ),
        "sent",
    )
    scratch.drop("wanted")
    small = sent.filter("not large").repartition("anchor").sortWithinPartitions("anchor")
    runs = sent.filter("large").mapInArrow(_send_runs(shape), _RUNS)
    # Runs are spread by their hash; what is settled, by its document.
    runs = runs.repartition(F.coalesce("w1", F.xxhash64("k1", "first"))).sortWithinPartitions("w1", "w2")
    apart = runs.filter("w1 is not null").mapInArrow(_meet_runs, _SPANS)
    found = scratch.write(
        small.mapInArrow(_suffix_matches(shape), _SPANS)
        .unionByName(apart)
        .unionByName(runs.filter("w1 is null").select("k1", "k2", "first", "last")),
        "found",
    )
    scratch.drop("sent")
    whole = tagged.filter("whole").select(*KEY, "first", (F.col("first") + F.col("runs") - 1).alias("last"))
    spans = found.unionByName(whole).groupBy(*KEY).agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    spans = Scratch(spark, "suffix-spans").write(spans, "spans")
    scratch.drop("tagged", "found")
    return spans


_REMOVED = "n_bytes bigint, n_removed bigint, kept binary, removed array<struct<start:bigint,end:bigint>>"


def removed_spans(n: int, spans: list[dict], window: int) -> np.ndarray:
    """(start, end) of the maximal stretches that the runs cover, one row each."""
    steps = np.zeros(n + 1, dtype=np.int32)
    np.add.at(steps, np.array([s["first"] for s in spans], dtype=np.int64), 1)
    np.add.at(steps, np.array([s["last"] for s in spans], dtype=np.int64) + window, -1)
    gone = np.r_[False, np.cumsum(steps[:-1]) > 0, False]
    return np.flatnonzero(gone[1:] != gone[:-1]).reshape(-1, 2)


def _remove(window: int):
    def run(batches):
        for batch in slices(batches):
            sizes, counts, kept, removed = [], [], [], []
            for text, spans in zip(utf8(batch, "text"), values(batch, "spans")):
                text = text or b""
                gone = removed_spans(len(text), spans, window) if spans else np.zeros((0, 2), np.int64)
                edges = [0, *gone.ravel().tolist(), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                sizes.append(len(text))
                counts.append(len(text) - len(kept[-1]))
                removed.append([{"start": a, "end": b} for a, b in gone.tolist()])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "row"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array(kept, pa.binary()), pa.array(removed, kind)],
                names=["row", "n_bytes", "n_removed", "kept", "removed"],
            )

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Each row of ``docs`` (doc_id, text and others) as the struct ``row``, with ``n_bytes``, ``n_removed``, ``kept``
    (the bytes that stay) and ``removed`` (start and end of every stretch that goes)."""
    spans = repeated_spans(docs, window, group)
    packed = _keyed(docs, F.struct("*").alias("row"))
    joined = packed.join(spans.hint("merge"), KEY, "left").select("row", "text", "spans")
    columns = [c.split(maxsplit=1) for c in _REMOVED.split(", ")]
    schema = joined.selectExpr("row", *(f"cast(null as {kind}) as {c}" for c, kind in columns)).schema
    return joined.mapInArrow(_remove(window), schema)
