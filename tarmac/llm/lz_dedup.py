"""Substring dedup against every earlier document, by content-defined blocks and run hashes.

This stands in for a Relative Lempel-Ziv parse: no factor is extended past one block.

The law: a word goes if some run of ``window`` consecutive words that covers it
also stands in a document with a smaller doc_id, as the input has it.

Every document is a reference.  It is cut at places that its own words choose:
each run of ``window`` words elects the word group with the smallest hash in
it (its anchor), and neighbouring runs with the same anchor make a *reference
block*, the stretch of words that they cover.  A passage that two documents
share elects the same anchors in both, so blocks meet by hash wherever they
lie.

The search goes in two steps, both by joins on hashes:

1. whole blocks: a block that an earlier document also has is a factor, and
   all its words go;
2. factor boundaries: blocks that no earlier document has whole, but whose
   anchor another document has, are checked run by run, since a factor may end
   inside them.

Only the first document of each distinct block enters step 2, so a passage that
a third of all documents share is looked up once, and the index keeps one row
(the smallest doc_id) per block or run, combined before the shuffle.  Documents
with equal words count once: of those, all but the smallest doc_id go whole.

Runs are told apart by 64-bit hashes of two kinds (the anchor's and the run's),
so two different runs are taken for one with a chance near 2**-128 a pair.
Rows with null doc_id keep their words and serve nobody.  Rows that share a
doc_id do not delete each other's words; they are told apart by their texts.  Null or empty text, and texts shorter
than ``window``, have nothing to remove.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import column, slices, utf8, values
from .storage import Scratch, dealt_anew, materialize
from .words import RunHashes, word_hashes

WINDOW = 50


def anchor_length(window: int) -> int:
    """Words of the groups that runs elect anchors from: two fifths of a run."""
    return max(1, window * 2 // 5)


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Least value of every ``size`` neighbours, by doubling."""
    reach = 1
    while 2 * reach <= size:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    rest = size - reach
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


class Parsed:
    """A document's runs of ``window`` words, cut into blocks of equal anchors."""

    def __init__(self, words: list[bytes], window: int):
        self.window = window
        self.hashes = word_hashes(words)
        self.runs = RunHashes(self.hashes)
        n = len(words) - window + 1
        if n < 1:
            self.first = self.last = np.zeros(0, np.int64)
            self.anchors = np.zeros(0, np.int64)
            return
        size = anchor_length(window)
        groups = self.runs.all(size)
        elected = _sliding_min(groups, window - size + 1)
        self.first = np.flatnonzero(np.r_[True, elected[1:] != elected[:-1]])
        self.last = np.r_[self.first[1:] - 1, n - 1]
        self.anchors = elected[self.first].view(np.int64)

    def block_hashes(self) -> np.ndarray:
        """Hash of each block's words."""
        return self.runs.of(self.first, self.last - self.first + self.window).view(np.int64)

    def run_hashes(self, block: int) -> np.ndarray:
        starts = np.arange(self.first[block], self.last[block] + 1)
        return self.runs.of(starts, self.window).view(np.int64)


def _words(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def _outline(window: int):
    """Per document: words, digest of them all, and the distinct anchors."""

    def run(batches):
        for batch in slices(batches):
            counts, digests, anchors = [], [], []
            for text in utf8(batch, "text"):
                words = _words(text)
                parsed = Parsed(words, window)
                counts.append(len(words))
                digests.append(xxhash.xxh3_128_digest(parsed.hashes.tobytes()))
                anchors.append(np.unique(parsed.anchors))
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id"),
                    column(batch, "text_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(anchors, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_id", "n_words", "digest", "anchors"],
            )

    return run


_BLOCKS = "doc_id bigint, text_id bigint, anchor bigint, block bigint, first bigint, runs array<bigint>"


def _cut(window: int):
    """Blocks (with the hash of each run) whose anchor is in ``shared``."""

    def run(batches):
        for batch in slices(batches, 64):
            rows = []
            columns = values(batch, "doc_id"), values(batch, "text_id"), utf8(batch, "text"), values(batch, "shared")
            for doc_id, text_id, text, shared in zip(*columns):
                parsed = Parsed(_words(text), window)
                names = parsed.block_hashes()
                for b in np.flatnonzero(np.isin(parsed.anchors, np.array(shared, dtype=np.int64))):
                    rows.append((doc_id, text_id, parsed.anchors[b], names[b], parsed.first[b], parsed.run_hashes(b)))
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, kinds)],
                names=[x.split()[0] for x in _BLOCKS.split(", ")],
            )

    return run


def _keyed(docs: DataFrame, *more) -> DataFrame:
    """doc_id, text_id (a hash of the text: rows may share a doc_id) and text of each row."""
    text = F.col("text").cast("string")
    return docs.select(*more, F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_id"), text.alias("text"))


ROW = ["doc_id", "text_id"]


def duplicate_runs(docs: DataFrame, window: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(whole, runs): the (doc_id, text_id) whose words all go with an earlier equal text; and for the other documents
    rows (doc_id, text_id, first, last) of word positions at which duplicate runs start.  Both read tables of ``scratch``.
    """
    texts = _keyed(docs)
    outline = scratch.write(
        texts.mapInArrow(
            _outline(window), "doc_id bigint, text_id bigint, n_words bigint, digest binary, anchors array<bigint>"
        ),
        "outline",
    )
    firsts = dealt_anew(outline.groupBy("digest").agg(F.min("doc_id").alias("same_as")), "digest")
    equal = outline.select(*ROW, "digest").filter(F.col("n_words") >= window).join(firsts, "digest")
    whole = scratch.write(equal.filter("doc_id > same_as").select(*ROW).distinct(), "whole")

    anchors = (
        outline.filter(F.col("doc_id").isNotNull())
        .select(*ROW, "anchors")
        .join(whole, ROW, "left_anti")
        .select(*ROW, F.explode("anchors").alias("anchor"))
    )
    common = (
        anchors.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b").select("anchor")
    )
    wanted = anchors.join(dealt_anew(common, "anchor"), "anchor").groupBy(*ROW).agg(F.collect_set("anchor").alias("shared"))
    wanted = scratch.write(wanted, "wanted")
    scratch.drop("outline")
    blocks = scratch.write(texts.join(wanted.hint("merge"), ROW).mapInArrow(_cut(window), _BLOCKS), "blocks")
    scratch.drop("wanted")

    # Step 1: whole blocks.  The index row of a block is its smallest document.
    blocks = blocks.withColumn("n", F.size("runs"))
    key = ["anchor", "block", "n"]
    index = dealt_anew(blocks.groupBy(*key).agg(F.min("doc_id").alias("source")), "block")
    found = scratch.write(
        blocks.join(index, key).select(
            *ROW, "anchor", "first", "n", F.when(F.col("doc_id") == F.col("source"), F.col("runs")).alias("runs")
        ),
        "found",
    )
    scratch.drop("blocks")
    factors = found.filter(F.col("runs").isNull()).select(*ROW, "first", (F.col("first") + F.col("n") - 1).alias("last"))

    # Step 2: the first holders of a block are checked run by run.
    runs = found.filter(F.col("runs").isNotNull()).select(*ROW, "anchor", "first", F.posexplode("runs").alias("at", "run"))
    runs = runs.select(*ROW, "anchor", "run", (F.col("first") + F.col("at")).alias("first"))
    sources = (
        runs.groupBy("anchor", "run")
        .agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("other"))
        .filter("source < other")
        .drop("other")
    )
    ends = runs.join(dealt_anew(sources, "run"), ["anchor", "run"]).filter("doc_id > source")
    return whole, factors.unionByName(ends.select(*ROW, "first", F.col("first").alias("last")))


def removed_mask(n: int, firsts: list[int], lasts: list[int], window: int) -> np.ndarray:
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, np.array(firsts, dtype=np.int64), 1)
    np.add.at(steps, np.array(lasts, dtype=np.int64) + window, -1)
    return np.cumsum(steps[:-1]) > 0


def _remove(window: int):
    def run(batches):
        for batch in slices(batches):
            counts, removed, kept = [], [], []
            for text, whole, spans in zip(utf8(batch, "text"), values(batch, "whole"), values(batch, "spans")):
                words = _words(text)
                counts.append(len(words))
                if whole:
                    words = []
                elif spans:
                    gone = removed_mask(len(words), [s["first"] for s in spans], [s["last"] for s in spans], window)
                    words = [w for w, g in zip(words, gone) if not g]
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "row"),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["row", "n_words", "n_removed", "kept"],
            )

    return run


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Each row of ``docs`` as the struct ``row``, with ``n_words``, ``n_removed`` and ``kept``: the words that stay,
    joined by one space.
    """
    scratch = Scratch(docs.sparkSession, "run-dedup")
    whole, runs = duplicate_runs(docs, window, scratch)
    empty = F.expr("cast(array() as array<struct<first:bigint,last:bigint>>)")
    # Only documents that lose words have a row here, and one row each: those that go whole have no runs.
    spans = runs.groupBy(*ROW).agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    losses = materialize(
        spans.select(*ROW, F.lit(False).alias("whole"), "spans").unionByName(
            whole.select(*ROW, F.lit(True).alias("whole"), empty.alias("spans"))
        ),
        "losses",
    )
    scratch.drop("")
    packed = _keyed(docs, F.struct("*").alias("row"))
    joined = packed.join(losses.hint("merge"), ROW, "left").select("row", "text", "whole", "spans")
    schema = joined.selectExpr("row", "0L as n_words", "0L as n_removed", "'' as kept").schema
    return joined.mapInArrow(_remove(window), schema)
