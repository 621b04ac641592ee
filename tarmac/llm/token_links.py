"""Alignment of two tokenizers over the same bytes, and how often their tokens link in the whole corpus.

Each text is encoded by a byte-level BPE (A, of a space and the text) and by a
SentencePiece model (B, which puts that space itself).  Both spell the same
bytes, so their tokens are two ways to cut one string.  The ends of a batch of
documents lie in two flat arrays, and one state vector holds a pair of
pointers for every lane, a lane being at most ``LANE`` bytes of a document.
Every step compares the two ends of all lanes at once, emits a link and a cut
where they are equal, advances the pointer of the smaller end (both, if equal)
and compacts the lanes that are through.  A long document is many lanes, so the
number of steps does not grow with its length.

A *link* is a token of A and a token of B whose byte ranges end together, a
*group* the tokens of both between two such ends.  The count of an id pair is
the number of links of the corpus that hold it; counts are summed by Spark,
within tasks first, and come back to the documents by a join that broadcasts
them only if they are few (``MAX_BROADCAST`` pairs), and shuffles otherwise.

Null and empty texts, and texts that one of the tokenizers does not spell byte
for byte, have no tokens.  Strings of special tokens inside a text are plain
text.  Rows are told apart by a key of their own, so doc_id may be null or
repeated; the other columns are returned in the struct ``row``, whatever their
names.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import column, slices, values
from .bpe import default_path, plain_encoder, token_bytes
from .storage import Scratch, materialize

LANE = 512
ROWS = 128  # documents that a task aligns at a time
MAX_BROADCAST = 1 << 19  # id pairs, about 40 bytes each in a hash table


def default_pieces_path() -> str:
    """The 32k SentencePiece model of the installed ``public_tokenizers``."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A SentencePiece model and the bytes that each of its ids stands for."""

    def __init__(self, path: str):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._spelled(i) for i in range(self.lib.get_piece_size())]
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)

    def _spelled(self, i: int) -> bytes:
        piece = self.lib.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.lib.is_byte(i) else piece.replace("▁", " ").encode("utf-8")

    def encode(self, texts: list[str]):
        """The ids of one text after the other."""
        return (self.lib.encode(t) for t in texts)

    def spells(self, ids: list[int], data: bytes) -> bool:
        return b"".join(map(self.bytes.__getitem__, ids)) == data


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


@lru_cache(maxsize=2)
def _byte_lengths(path: str) -> np.ndarray:
    spelled = token_bytes(path)
    lengths = np.zeros(max(spelled, default=0) + 1, dtype=np.int64)
    for i, b in spelled.items():
        lengths[i] = len(b)
    return lengths


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``a_ends`` and ``b_ends`` (both ascending) of equal ends, lanes ``low < end <= high`` side by side."""
    a, b = np.searchsorted(a_ends, low, side="right"), np.searchsorted(b_ends, low, side="right")
    a_stop, b_stop = np.searchsorted(a_ends, high, side="right"), np.searchsorted(b_ends, high, side="right")
    linked_a, linked_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while True:
        live = (a < a_stop) & (b < b_stop)
        if not live.all():
            a, b, a_stop, b_stop = a[live], b[live], a_stop[live], b_stop[live]
        if not len(a):
            break
        x, y = a_ends[a], b_ends[b]
        same = x == y
        linked_a.append(a[same])
        linked_b.append(b[same])
        a, b = a + (x <= y), b + (y <= x)
    return np.sort(np.concatenate(linked_a)), np.sort(np.concatenate(linked_b))


def lanes(sizes: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of at most ``lane`` bytes that cover documents of these sizes, laid end to end."""
    ends = np.cumsum(sizes)
    parts = -(-sizes // lane)
    owner = np.repeat(np.arange(len(sizes)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    low = (ends - sizes)[owner] + nth * lane
    return low, np.minimum(low + lane, ends[owner])


def _flat(ids: list) -> np.ndarray:
    return np.concatenate([np.asarray(x, dtype=np.int64) for x in ids]) if ids else np.zeros(0, np.int64)


def _offsets(counts) -> np.ndarray:
    return np.r_[0, np.cumsum(np.asarray(counts, dtype=np.int64))].astype(np.int64)


@lru_cache(maxsize=None)
def _spelled(size: int, mark: str) -> np.ndarray:
    """Every id below ``size`` in decimal, with a mark behind it."""
    return np.array([f"{i}{mark}" for i in range(size)], dtype=object)


def groups_texts(a, b, link_a, link_b, ends, sizes=(1 << 16, 1 << 16)) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each document: each group's A ids, then its B ids.  ``a`` and ``b`` are the ids of the
    documents one after the other, ``link_a`` and ``link_b`` the last of each group, ``ends`` the last A id and the last B
    id of each document, plus one."""
    sizes = max(sizes[0], int(a.max(initial=0)) + 1), max(sizes[1], int(b.max(initial=0)) + 1)
    words_a, words_b = _spelled(sizes[0], ",")[a], _spelled(sizes[1], ",")[b]
    words_a[link_a], words_b[link_b] = _spelled(sizes[0], "|")[a[link_a]], _spelled(sizes[1], ";")[b[link_b]]
    group_a = np.searchsorted(link_a, np.arange(len(a)))
    group_b = np.searchsorted(link_b, np.arange(len(b)))
    out = np.empty(len(a) + len(b), dtype=object)
    out[np.arange(len(a)) + np.r_[0, link_b + 1][group_a]] = words_a
    out[np.arange(len(b)) + (link_a + 1)[group_b]] = words_b
    bounds = np.r_[0, np.add(*ends)].tolist()
    return ["".join(out[i:j].tolist())[:-1] for i, j in zip(bounds, bounds[1:])]


INTS, LONGS = pa.list_(pa.int32()), pa.list_(pa.int64())
KINDS = {
    "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(),
    "a_ids": INTS, "b_ids": INTS, "a_cuts": INTS, "b_cuts": INTS, "links": LONGS,
}
DDL = {c: "bigint" if k == pa.int64() else "string" if k == pa.string() else "array<int>" if k == INTS else "array<bigint>" for c, k in KINDS.items()}


def _align(a_path: str, b_path: str, lane: int, columns: tuple[str, ...]):
    def lists(flat: np.ndarray, offsets: np.ndarray, name: str) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, KINDS[name].value_type))

    def run(batches):
        enc, sp, a_lengths = plain_encoder(a_path), pieces(b_path), _byte_lengths(a_path)
        for batch in slices(batches, ROWS):
            texts = values(batch, "text")
            a_ids: list = [[]] * len(texts)
            b_ids: list = [[]] * len(texts)
            sizes = np.zeros(len(texts), dtype=np.int64)
            full = [i for i, t in enumerate(texts) if t]
            for i, b in zip(full, sp.encode([texts[i] for i in full])):
                spaced = " " + texts[i]
                data = spaced.encode("utf-8")
                a = np.frombuffer(enc.encode(spaced), enc.dtype)
                if sp.spells(b, data) and a_lengths[a].sum() == len(data):
                    a_ids[i], b_ids[i], sizes[i] = a, np.array(b, dtype=np.int64), len(data)
            a, b = _flat(a_ids), _flat(b_ids)
            a_from, b_from = _offsets([len(x) for x in a_ids]), _offsets([len(x) for x in b_ids])
            link_a, link_b = lockstep(np.cumsum(a_lengths[a]), np.cumsum(sp.lengths[b]), *lanes(sizes, lane))
            cuts = np.searchsorted(link_a, a_from)
            owner = np.repeat(np.arange(len(texts)), np.diff(cuts))

            def digests():
                found = groups_texts(a, b, link_a, link_b, (a_from[1:], b_from[1:]))
                return [hashlib.sha256(g.encode("ascii")).hexdigest() if g else "" for g in found]

            make = {
                "n_a": lambda: np.diff(a_from),
                "n_b": lambda: np.diff(b_from),
                "n_groups": lambda: np.diff(cuts),
                "n_links": lambda: np.diff(cuts),
                "groups_sha256": digests,
                "a_ids": lambda: lists(a, a_from, "a_ids"),
                "b_ids": lambda: lists(b, b_from, "b_ids"),
                "a_cuts": lambda: lists(link_a + 1 - a_from[owner], cuts, "a_cuts"),
                "b_cuts": lambda: lists(link_b + 1 - b_from[owner], cuts, "b_cuts"),
                "links": lambda: lists((b[link_b] << 32) | a[link_a], cuts, "links"),
            }
            made = [make[c]() for c in columns]
            made = [m if isinstance(m, pa.Array) else pa.array(m, KINDS[c]) for c, m in zip(columns, made)]
            yield pa.RecordBatch.from_arrays([column(batch, "row"), *made], names=["row", *columns])

    return run


def align(
    docs: DataFrame,
    columns: tuple[str, ...] = ("a_ids", "b_ids", "a_cuts", "b_cuts", "links"),
    a_path: str | None = None,
    b_path: str | None = None,
    lane: int = LANE,
) -> DataFrame:
    """``row`` (a document's columns but the text) and what is asked for of: ``a_ids``, ``b_ids``; ``a_cuts``, ``b_cuts``
    (tokens up to the end of each group); ``links`` (B id * 2**32 + A id of each); the numbers ``n_a``, ``n_b``,
    ``n_groups``, ``n_links``; and ``groups_sha256`` of the groups' ids ('' without tokens)."""
    a_path, b_path = a_path or default_path(), b_path or default_pieces_path()
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    packed = docs.select(F.struct(*(others or [F.lit(0).alias("none")])).alias("row"), F.col("text").cast("string").alias("text"))
    schema = packed.selectExpr("row", *(f"cast(null as {DDL[c]}) as {c}" for c in columns)).schema
    return packed.mapInArrow(_align(a_path, b_path, lane, tuple(columns)), schema)


def link_counts(aligned: DataFrame) -> DataFrame:
    """(link, n, best): how many links hold each id pair, and whether no pair with the same B id has more."""
    counts = aligned.select(F.explode("links").alias("link")).groupBy("link").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts.withColumn("b", F.shiftright("link", 32)), "link-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return materialize(counts.join(most, "b").select("link", "n", (F.col("n") == F.col("most")).alias("best")), "link-scores")


def link_sums(aligned: DataFrame, counts: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """(key, n_best, count_sum) of the documents with links."""
    links = aligned.select("key", F.explode("links").alias("link"))
    if counts.count() <= max_broadcast:
        counts = F.broadcast(counts)
    else:
        links = links.groupBy("key", "link").agg(F.count(F.lit(1)).alias("times"))
    times = F.col("times") if "times" in links.columns else F.lit(1).cast("bigint")
    return (
        links.join(counts, "link")
        .groupBy("key")
        .agg(F.sum(times * F.col("best").cast("bigint")).alias("n_best"), F.sum(times * F.col("n")).alias("count_sum"))
    )


SUMMARY = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def summary(docs: DataFrame, lane: int = LANE, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """One row per document: ``row``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and
    ``groups_sha256``."""
    scratch = Scratch(docs.sparkSession, "links")
    found = align(docs, (*SUMMARY, "links"), lane=lane)
    found = scratch.write(found.withColumn("key", F.monotonically_increasing_id()), "aligned")
    sums = scratch.write(link_sums(found, link_counts(found), max_broadcast), "sums")
    zero = F.lit(0).cast("bigint")
    sums = found.select("key", "row", *SUMMARY).join(sums, "key", "left")
    return sums.select("row", *SUMMARY[:-1], *(F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum")), SUMMARY[-1])
