"""Conversations as one prefix tree of formatted turns.

Each turn is formatted as ``<|im_start|>role\\ntext<|im_end|>\\n`` and encoded to
ids.  Control strings inside a text cannot be taken for the template's: ``<``,
any number of backslashes and ``|`` get one more backslash, which reading
removes; a role's line breaks and backslashes are escaped too.

Conversations that begin with the same turns share those turns' nodes.  Nodes
are laid end to end in depth-first order, each once, and carry

* ``start``: place of their first id in that stream;
* ``position``: position id of their first id, counted along their own
  conversation from 0;
* ``segment``: the run of nodes, from a branch down, that one conversation
  adds to the stream; ids of a segment attend to what lies before them in it
  and to the segment's ``attends`` intervals of the stream: its ancestors.

Depth-first order needs no walk: conversations are sorted by the hashes of
their prefixes, so those with a common beginning are neighbours, and every node
belongs to the first conversation that has it.  The sort runs over all tasks,
so a first turn that a third of all conversations share is no burden.

Rows of a conversation are ordered by turn, then role, then text (nulls first);
null role or text is empty.  Null conv_id is a conversation like any other.
Repeated rows are repeated turns.  Equal conversations share all nodes.  An
empty table gives an empty tree.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import slices, values
from .bpe import decoder, default_path, encoder
from .offsets import running_total
from .storage import materialize, write_table

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parse_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    if not formatted.startswith(START) or not formatted.endswith(END):
        raise ValueError("not a formatted turn")
    role, text = formatted[len(START) : -len(END)].split("\n", 1)
    return unescape_role(role), unescape(text)


@dataclass
class Tree:
    """``nodes``: node, ids, start, position, n_ids, loss_start, loss_ids (within ids), segment.
    ``segments``: segment, attends (disjoint stream intervals in order).
    ``conversations``: conv_id, path (node of each turn)."""

    nodes: DataFrame
    segments: DataFrame
    conversations: DataFrame


_TURNS = "conv_id bigint, path array<binary>, sort_key binary, lengths array<bigint>"


def _paths(batches):
    """Node ids along each conversation: a hash of everything up to and including the turn."""
    for batch in slices(batches):
        ids, paths = [], []
        for conv_id, turns in zip(values(batch, "conv_id"), values(batch, "turns")):
            path, above = [], b""
            for t in turns:
                role, text = t["role"].encode(), t["text"].encode()
                above = xxhash.xxh3_128_digest(above + len(role).to_bytes(8, "little") + role + text)
                path.append(above)
            ids.append(conv_id)
            paths.append(path)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                batch.column(batch.schema.names.index("turns")),
                pa.array(paths, pa.list_(pa.binary())),
                pa.array([b"".join(p) for p in paths], pa.binary()),
            ],
            names=["conv_id", "turns", "path", "sort_key"],
        )


_NODE = "node binary, rank bigint, depth int, n_ids bigint, loss_start bigint, loss_ids bigint, ids binary"


def _encode(path: str):
    def run(batches):
        enc = encoder(path)
        width = enc.dtype.itemsize
        for batch in slices(batches):
            rows = []
            for role, text in zip(values(batch, "role"), values(batch, "text")):
                head = enc.encode(f"{START}{escape_role(role)}\n")
                body = enc.encode(escape(text))
                ids = head + body + enc.encode(END)
                rows.append((len(ids) // width, len(head) // width, len(body) // width if role == LEARNED else 0, ids))
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(batch.schema.names.index(c)) for c in ("node", "rank", "depth")),
                    *(pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.binary()])),
                ],
                names=[x.split()[0] for x in _NODE.split(", ")],
            )

    return run


def build_tree(conversations: DataFrame, folder: str, tokenizer: str | None = None) -> Tree:
    """Format ``conversations`` (conv_id, turn, role, text), write the tree under ``folder`` and return its tables."""
    tokenizer = tokenizer or default_path()
    empty = F.lit("")
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )
    # One conversation is one sequence: it is hashed in order, by one task.
    grouped = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("turn"))
    grouped = grouped.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    turns_type = grouped.schema["turns"].dataType.simpleString()
    paths = grouped.mapInArrow(_paths, f"conv_id bigint, turns {turns_type}, path array<binary>, sort_key binary")
    paths = materialize(paths.withColumn("one", F.lit(1).cast("bigint")), "paths")
    ranked = running_total(paths.select("conv_id", "path", "sort_key", "one"), ["sort_key", "conv_id"], "one", "rank")
    ranked = materialize(ranked.select("conv_id", "path", "rank"), "ranked")

    # Each node goes to the first conversation that has it.
    steps = ranked.select("conv_id", "rank", F.posexplode("path").alias("depth", "node"))
    owners = materialize(steps.groupBy("node").agg(F.min("rank").alias("rank"), F.first("depth").alias("depth")), "owners")
    texts = (
        paths.select("conv_id", F.arrays_zip("path", "turns").alias("zipped"))
        .select("conv_id", F.explode("zipped").alias("z"))
        .select("conv_id", F.col("z.path").alias("node"), F.col("z.turns.role").alias("role"), F.col("z.turns.text").alias("text"))
    )
    holders = owners.join(ranked.select("rank", F.col("conv_id").alias("owner")), "rank")
    mine = texts.join(holders, (texts["node"] == holders["node"]) & texts["conv_id"].eqNullSafe(holders["owner"]))
    mine = mine.select(holders["node"], "rank", "depth", "role", "text")
    encoded = materialize(mine.mapInArrow(_encode(tokenizer), _NODE), "nodes")
    placed = running_total(encoded, ["rank", "depth"], "n_ids", "start")
    placed = materialize(placed.select("node", "rank", "depth", "n_ids", "start", "loss_start", "loss_ids", "ids"), "placed")

    # Along each conversation, what one segment holds is one interval of the stream.
    spots = placed.select("node", F.col("rank").alias("segment"), "start", "n_ids")
    along = steps.select("rank", "node").join(spots, "node")
    pieces = along.groupBy("rank", "segment").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("n_ids")).alias("end"), F.sum("n_ids").alias("n")
    )
    above = pieces.filter("segment <> rank").groupBy("rank").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("attends"), F.sum("n").alias("position")
    )
    segments = pieces.filter("segment = rank").select("rank", F.col("start").alias("segment_start")).join(above, "rank", "left")
    no_interval = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    segments = materialize(
        segments.select(
            F.col("rank").alias("segment"),
            "segment_start",
            F.coalesce("position", F.lit(0).cast("bigint")).alias("position"),
            F.coalesce("attends", no_interval).alias("attends"),
        ),
        "segments",
    )
    nodes = placed.withColumnRenamed("rank", "segment").join(
        segments.select("segment", "segment_start", F.col("position").alias("base")), "segment"
    )
    nodes = nodes.select(
        "node", "segment", "start", "n_ids", "loss_start", "loss_ids", "ids",
        (F.col("base") + F.col("start") - F.col("segment_start")).alias("position"),
    )
    return Tree(
        write_table(nodes, f"{folder}/nodes"),
        write_table(segments, f"{folder}/segments"),
        write_table(ranked.select("conv_id", "path"), f"{folder}/conversations"),
    )


def read_tree(spark: SparkSession, folder: str) -> Tree:
    return Tree(*(spark.read.parquet(f"{folder}/{part}") for part in ("nodes", "segments", "conversations")))


def _read(path: str):
    def run(batches):
        enc, dec = encoder(path), decoder(path)
        for batch in slices(batches, 64):
            rows = []
            for conv_id, parts in zip(values(batch, "conv_id"), values(batch, "parts")):
                formatted, learned, n = [], [], 0
                for p in parts:
                    ids = np.frombuffer(p["ids"], enc.dtype)
                    formatted.append(dec.decode(ids.tolist()))
                    if p["loss_ids"]:
                        own = ids[p["loss_start"] : p["loss_start"] + p["loss_ids"]]
                        learned.append(unescape(dec.decode(own.tolist())))
                turns = [parse_turn(f) for f in formatted]
                digest = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest()
                loss = "".join(learned)
                n = sum(map(len, formatted))
                rows.append((conv_id, len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), n))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, kinds)],
                names=[x.split()[0] for x in DIGEST.split(", ")],
            )

    return run


DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def read_conversations(tree: Tree, tokenizer: str | None = None) -> DataFrame:
    """Put each conversation together from the tree's nodes, parse it, and digest its turns and what the loss covers."""
    steps = tree.conversations.withColumn("row", F.monotonically_increasing_id()).select(
        "row", "conv_id", F.posexplode("path").alias("depth", "node")
    )
    parts = steps.join(tree.nodes.select("node", "ids", "loss_start", "loss_ids"), "node")
    whole = parts.groupBy("row", "conv_id").agg(
        F.array_sort(F.collect_list(F.struct("depth", "ids", "loss_start", "loss_ids"))).alias("parts")
    )
    return whole.select("conv_id", "parts").mapInArrow(_read(tokenizer or default_path()), DIGEST)
