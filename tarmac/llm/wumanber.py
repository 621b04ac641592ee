"""Benchmark decontamination by Wu-Manber search for many word strings at once.

A benchmark item gives every run of ``window`` consecutive words as a string;
an item of fewer words, but not none, gives one string.  Strings of one length
share a machine:

* a *shift table* maps a block of two words to how far the search may jump: the
  least distance from such a block to a string's end, or past the block if no
  string holds it;
* where the shift is 0, the *suffix bucket* of that block lists the strings that
  end in it;
* each is compared word by word, so a hit is an occurrence and nothing else.

Words are case-folded for A-Z only and are runs of letters, digits and
non-ASCII characters.  Null text has no words; an empty benchmark finds
nothing.  Rows that share a doc_id are searched one by one, as are repeated
items.  An item without an id marks words but cannot be listed.

The strings are sent to every task, so their size is bounded: the benchmark is
measured first and split into blocks of at most ``block_bytes``; each block is
searched against all rows, one after another over the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices, utf8, values
from .storage import materialize

WINDOW = 10
BLOCK_BYTES = 32 << 20
_CHAINED = 4  # blocks searched in one pass over the rows

_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD_BYTES).split()


class Machine:
    """The strings of one length."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, list[tuple[list[bytes], set]]] = {}
        self.known: dict[tuple, set] = {}

    def add(self, words: list[bytes], item) -> None:
        string = tuple(words)
        if string in self.known:
            self.known[string].add(item)
            return
        self.known[string] = items = {item}
        for end in range(self.block, self.length + 1):
            block = string[end - self.block : end]
            self.shift[block] = min(self.shift.get(block, self.far), self.length - end)
        self.bucket.setdefault(string[-self.block :], []).append((words, items))

    def search(self, words: list[bytes], spans: list[tuple[int, int]], found: set) -> None:
        length, block, far, shift = self.length, self.block, self.far, self.shift
        end, n = length, len(words)
        while end <= n:
            key = tuple(words[end - block : end])
            step = shift.get(key, far)
            if step:
                end += step
                continue
            start = end - length
            for string, items in self.bucket.get(key, ()):
                if words[start:end] == string:
                    spans.append((start, end))
                    found |= items
            end += 1


def machines(items: Iterable[tuple[object, bytes | None]], window: int) -> list[Machine]:
    by_length: dict[int, Machine] = {}
    for item, text in items:
        words = words_of(text)
        length = min(window, len(words))
        if length:
            machine = by_length.setdefault(length, Machine(length))
            for at in range(len(words) - length + 1):
                machine.add(words[at : at + length], item)
    return [by_length[k] for k in sorted(by_length)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _search(shared, window: int):
    def run(batches):
        search = machines(shared.value, window)
        for batch in slices(batches):
            counts, spans, found = [], [], []
            earlier = zip(values(batch, "spans"), values(batch, "items"))
            for text, (old_spans, old_items) in zip(utf8(batch, "text"), earlier):
                words = words_of(text)
                hits, items = [(s["start"], s["end"]) for s in old_spans], set(old_items)
                for machine in search:
                    machine.search(words, hits, items)
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in merged(hits)])
                found.append(sorted(i for i in items if i is not None))
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(names.index("row")),
                    batch.column(names.index("text")),
                    pa.array(counts, pa.int64()),
                    pa.array(spans, _SPANS),
                    pa.array(found, pa.list_(pa.string())),
                ],
                names=["row", "text", "n_words", "spans", "items"],
            )

    return run


def find_items(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Each row of ``docs`` as the struct ``row``, with ``n_words``, ``spans`` (word ranges that occurrences cover,
    disjoint and in order) and ``items`` (ids of the items that occur, as strings in string order).
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + F.lit(64))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    out = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text")).select(
        "row",
        "text",
        F.lit(0).cast("bigint").alias("n_words"),
        F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    # A frame without columns of its own still has rows: schema of the packed row as it is.
    schema = out.schema
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for k in range(blocks):
        strings = [(r.item_id, r.text.encode()) for r in items.filter(part == k).toLocalIterator() if r.text]
        out = out.mapInArrow(_search(spark.sparkContext.broadcast(strings), window), schema)
        if k % _CHAINED == _CHAINED - 1 and k + 1 < blocks:
            out = materialize(out, "search")
    return out.drop("text")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no benchmark string occurs, with their own columns."""
    return find_items(docs, benchmark, window).filter(F.size("spans") == 0).select("row.*")
