"""Edit-aware token counts.

A document's text is cut into the tokenizer's pieces, and a segment tree over
them keeps, for every span of pieces, its characters and its tokens.  An edit
descends to the pieces it touches, cuts the text anew from the last boundary
that it cannot have moved until a new boundary falls on an old one, encodes
only the pieces in between, and updates the sums above them.

Pieces depend on at most two characters after their end, and cutting from a
boundary depends on what follows only; so the boundaries up to two characters
before an edit stay, and once a boundary behind the edit is met again, so does
all that follows.

A tree is kept as its leaves (``tree``: characters and tokens of each piece,
32-bit); the sums above are rebuilt from them when it is loaded.  A text that
the pieces' cut does not cover (see ``bpe``) is one leaf, encoded whole after
every edit; all of its pieces count as encoded each time.

Edits apply in order, each to the text that the earlier ones left; offsets are
in characters, and are cut to the text's ends.  Null text is empty; null edits
are none; a null replacement deletes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import column, slices, values
from .bpe import Encoder, default_path, encoder

_BACK = 2  # characters after its end on which a piece may depend


def leaves_of(enc: Encoder, text: str) -> np.ndarray:
    """Characters and tokens of each piece, as two rows."""
    if enc.covers(text):
        pieces = enc.cut(text)
        return np.array([list(map(len, pieces)), enc.counts(pieces)], dtype=np.int64).reshape(2, -1)
    return np.array([[len(text)], [enc.count(text)]], dtype=np.int64)


class PieceTree:
    """Text with a segment tree of (characters, tokens) over slots; a slot holds the pieces that one region was cut into."""

    def __init__(self, enc: Encoder, text: str, leaves: np.ndarray | None = None):
        self.enc, self.encoded = enc, 0
        self.plain = enc.covers(text)
        if leaves is None:
            leaves = leaves_of(enc, text)
        ends = np.cumsum(leaves[0])
        self.slots = [text[a:b] for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())]
        self.size = 1 << max(0, (max(1, len(self.slots)) - 1).bit_length())
        self.sums = np.zeros((2, 2 * self.size), dtype=np.int64)
        self.sums[:, self.size : self.size + len(self.slots)] = leaves
        level = self.size
        while level > 1:
            row = self.sums[:, level : 2 * level]
            self.sums[:, level // 2 : level] = row[:, 0::2] + row[:, 1::2]
            level //= 2

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    @property
    def chars(self) -> int:
        return int(self.sums[0, 1])

    @property
    def text(self) -> str:
        return "".join(self.slots)

    def leaves(self) -> np.ndarray:
        """The tree's leaves; slots that hold several pieces or none are cut back into pieces."""
        if not self.plain:
            return leaves_of(self.enc, self.text)
        kept = self.sums[:, self.size : self.size + len(self.slots)]
        out = []
        for k, s in enumerate(self.slots):
            if s:
                pieces = self.enc.cut(s)
                out.append(kept[:, k : k + 1] if len(pieces) == 1 else leaves_of(self.enc, s))
        return np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)

    def find(self, at: int) -> tuple[int, int]:
        """(slot, its first character) of the slot that holds character ``at``: a descent by character sums."""
        node, first = 1, 0
        while node < self.size:
            node *= 2
            left = int(self.sums[0, node])
            if at >= first + left:
                first += left
                node += 1
        return node - self.size, first

    def _put(self, slot: int, text: str, tokens: int) -> None:
        self.slots[slot] = text
        node = slot + self.size
        change = np.array([len(text), tokens]) - self.sums[:, node]
        while node:
            self.sums[:, node] += change
            node //= 2

    def _rebuild(self, text: str) -> None:
        encoded = self.encoded
        self.__init__(self.enc, text)
        self.encoded = encoded + max(1, len(self.slots) if self.plain else self.enc.n_pieces(text))

    def _around(self, start: int, end: int, replacement: str) -> str:
        """The replacement with as much text on both sides as a special token can reach over."""
        reach = max((len(s) for s in self.enc.special), default=0)
        left, right = [], []
        slot, first = self.find(min(start, self.chars - 1))
        left.append(self.slots[slot][: start - first])
        while slot > 0 and sum(map(len, left)) < reach:
            slot -= 1
            left.append(self.slots[slot])
        slot, first = self.find(min(end, self.chars - 1))
        right.append(self.slots[slot][end - first :])
        while slot + 1 < len(self.slots) and sum(map(len, right)) < reach:
            slot += 1
            right.append(self.slots[slot])
        return "".join(reversed(left)) + replacement + "".join(right)

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replace characters [start, end)."""
        start = max(0, min(start, self.chars))
        end = max(start, min(end, self.chars))
        if not self.plain or not self.chars or not self.enc.covers(self._around(start, end, replacement)):
            text = self.text
            self._rebuild(text[:start] + replacement + text[end:])
            return
        slot, first = self.find(max(0, start - _BACK))
        last, stop = slot, first + len(self.slots[slot])
        old = [self.slots[slot]]
        reach = 1
        while True:
            while last + 1 < len(self.slots) and (stop < end or reach):
                last += 1
                old.append(self.slots[last])
                if stop >= end and self.slots[last]:
                    reach -= 1
                stop += len(self.slots[last])
            window = "".join(old)
            new = window[: start - first] + replacement + window[end - first :]
            closed = last + 1 >= len(self.slots)
            met = self._meet(new, old, slot, first, end, start, len(replacement), closed)
            if met is not None:
                through, pieces = met
                break
            reach = 2 * len(old)
        counts = self.enc.counts(pieces)
        self.encoded += len(pieces)
        self._put(slot, "".join(pieces), sum(counts))
        for empty in range(slot + 1, through + 1):
            if self.slots[empty]:
                self._put(empty, "", 0)

    def _meet(self, new, old, slot, first, end, start, added, closed):
        """(last slot replaced, new pieces) if a new boundary falls on an old one behind the edit, else None."""
        shift = added - (end - start)
        boundaries, at = {}, first
        for i, s in enumerate(old):
            at += len(s)
            if at >= end:
                boundaries.setdefault(at + shift - first, slot + i)
        at, pieces = 0, []
        if not new:
            return (slot + len(old) - 1, []) if closed else None
        for piece in self.enc.cut(new):
            at += len(piece)
            pieces.append(piece)
            if closed and at == len(new):
                return slot + len(old) - 1, pieces
            if at >= start - first + added and at in boundaries and at + _BACK < len(new):
                return boundaries[at], pieces
        return None


_TREE = pa.binary()


def _build(path: str):
    def run(batches):
        enc = encoder(path)
        for batch in slices(batches):
            packed = []
            for text in values(batch, "text"):
                packed.append(leaves_of(enc, text or "").astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [column(batch, "row"), column(batch, "text"), pa.array(packed, _TREE)], names=["row", "text", "tree"]
            )

    return run


def build_trees(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Each row of ``docs`` as the struct ``row``, its ``text``, and its ``tree``."""
    packed = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    schema = packed.withColumn("tree", F.lit(b"")).schema
    return packed.mapInArrow(_build(tokenizer or default_path()), schema)


def _apply(path: str):
    def run(batches):
        enc = encoder(path)
        for batch in slices(batches):
            texts, trees, stats = [], [], []
            for text, tree, edits in zip(values(batch, "text"), values(batch, "tree"), values(batch, "edits")):
                leaves = np.frombuffer(tree, "<u4").reshape(2, -1).astype(np.int64)
                before = int(leaves[1].sum())
                if not edits:
                    texts.append(text), trees.append(tree), stats.append((0, before, before, leaves.shape[1], 0))
                    continue
                state = PieceTree(enc, text or "", leaves)
                for start, end, new in _absolute(edits):
                    state.edit(start, end, new)
                after = state.text
                texts.append(after), trees.append(state.leaves().astype("<u4").tobytes())
                stats.append((len(edits), before, state.tokens, leaves.shape[1], state.encoded))
            names = ["n_edits", "tokens_before", "tokens_after", "n_pieces", "n_encoded"]
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "row"),
                    pa.array(texts, pa.string()),
                    pa.array(trees, _TREE),
                    *(pa.array(c, pa.int64()) for c in (zip(*stats) if stats else [[]] * 5)),
                ],
                names=["row", "text", "tree", *names],
            )

    return run


def apply_edits(trees: DataFrame, edits: Column, tokenizer: str | None = None) -> DataFrame:
    """Apply each row's ``edits`` (array<struct<start, end, replacement>>, or <skip, length, replacement> as
    ``redactions`` gives them; may use the row's columns) to its text and tree.  Returns row, text and tree after the edits, ``n_edits``, ``tokens_before``, ``tokens_after``, ``n_pieces``
    (before) and ``n_encoded``: pieces that were encoded for the edits.
    """
    ready = trees.select("row", "text", "tree", edits.alias("edits"))
    counts = [F.lit(0).cast("bigint").alias(c) for c in ("n_edits", "tokens_before", "tokens_after", "n_pieces", "n_encoded")]
    schema = trees.select("row", "text", "tree", *counts).schema
    return ready.mapInArrow(_apply(tokenizer or default_path()), schema)


def redactions(text: Column, pattern: str, replacement: str) -> Column:
    """Edits that replace every match of ``pattern``: for each, the characters kept since the match before (``skip``),
    and the match's (``length``).  The pattern runs once over the text; the rest is linear in the matches."""
    mark = "\x00"
    marked = F.regexp_replace(F.translate(text, mark, " "), f"({pattern})", f"{mark}$1{mark}")
    none = F.expr("cast(array() as array<struct<skip:int,length:int,replacement:string>>)")

    def edits_of(parts):  # kept, match, kept, match, ..., kept
        def edit(i):
            skip, length = F.length(parts[2 * i]), F.length(parts[2 * i + 1])
            return F.struct(skip.alias("skip"), length.alias("length"), F.lit(replacement).alias("replacement"))

        matches = F.floor(F.size(parts) / 2).cast("int")
        return F.when(matches > 0, F.transform(F.sequence(F.lit(0), matches - 1), edit)).otherwise(none)

    # The parts are one element of an array, so that they are bound once and not computed for every edit.
    bound = F.transform(F.array(F.split(marked, mark)), edits_of)
    return F.when(text.isNotNull(), bound[0])


def _absolute(edits: list[dict]) -> list[tuple[int, int, str]]:
    """(start, end, replacement), each in the text that the earlier ones left."""
    if not edits or "start" in edits[0]:
        return [(e["start"], e["end"], e["replacement"] or "") for e in edits or ()]
    out, at = [], 0
    for e in edits:
        start = at + e["skip"]
        at = start + e["length"]
        out.append((start, at, e["replacement"] or ""))
    return out[::-1]  # from the last, so that offsets hold
