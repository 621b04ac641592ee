"""Encoder, records, packing, edit-aware counts and shards."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_data import awkward, docs, empty, prose
from pyspark.sql import functions as F

from tarmac.llm import bpe, curve_packing, records, sharding, storage, token_tree

PATH = bpe.default_path()
ALPHABET = ["a", "the", " ", "  ", "\n", "'", "s", "'re", "1", "23", ".", "!?", "é", "ß", "²", "\t", "\xa0", "\x85", "\x1c", "ɏ"]
BEYOND = ["<|", "endoftext", "|>", "中", "٣", "ɐ", "　"]


def library(text):
    return bpe.encoder(PATH).lib.encode(text, add_special_tokens=False).ids


def test_encoder_equals_the_library_below_the_covered_limit():
    enc = bpe.encoder(PATH)
    for c in map(chr, range(0x250)):
        for text in (c, f"a{c}b", f" {c} {c}{c} 1{c}", f"{c}'s{c}\n {c}"):
            assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == library(text), repr(text)


def test_encoder_and_decoder_round_trip():
    enc, dec, rnd = bpe.Encoder(PATH, max_pieces=20), bpe.decoder(PATH), random.Random(1)
    for _ in range(1500):
        text = "".join(rnd.choice(ALPHABET + BEYOND) for _ in range(rnd.randint(0, 30)))
        ids = np.frombuffer(enc.encode(text), enc.dtype).tolist()
        assert ids == library(text) and dec.decode(ids) == text


def test_records_remember_more_pieces_than_the_default(monkeypatch):
    asked = []
    monkeypatch.setattr(records, "encoder", lambda *args: asked.append(args) or bpe.Encoder(*args))
    batch = pa.record_batch({"doc_id": pa.array([1, None]), "text": pa.array(["a \n b é", None])})
    blocks = [b for out in records._blocks(PATH, 0)(iter([batch])) for b in out.column(0).to_pylist()]
    found = [(doc_id, ids.tolist()) for _, _, doc_id, ids in records.frames(b"".join(b + b"\n" for b in blocks))]
    assert found == [(1, [*library("a \n b é"), 0]), (None, [0])]
    assert asked == [(PATH, records.PIECES)] and records.PIECES > bpe.MAX_PIECES


def test_piece_tree_counts_after_every_edit():
    enc, rnd = bpe.encoder(PATH), random.Random(2)
    for k in range(400):
        letters = ALPHABET + BEYOND if k % 4 == 0 else ALPHABET
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40)))
        tree = token_tree.PieceTree(enc, text)
        for _ in range(6):
            start = rnd.randint(0, len(text))
            end = min(len(text), start + rnd.choice([0, 0, 1, 2, 9]))
            new = "".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 2, 4])))
            text = text[:start] + new + text[end:]
            tree.edit(start, end, new)
            assert tree.text == text and tree.tokens == len(library(text)), repr(text)


def test_a_special_token_that_an_edit_completes():
    tree = token_tree.PieceTree(bpe.encoder(PATH), "say <|endof|> now and then")
    tree.edit(11, 11, "text")
    assert tree.tokens == len(library("say <|endoftext|> now and then"))


def test_a_text_encoded_whole_counts_all_its_pieces():
    enc = bpe.encoder(PATH)
    tree = token_tree.PieceTree(enc, "one “two” three " * 50)
    for k in (1, 2):
        tree.edit(0, 1, "x")
        assert tree.encoded == k * len(enc.lib.pre_tokenizer.pre_tokenize_str(tree.text)) and tree.encoded >= k * 200
    plain, special = "one two, three", enc.special[0]
    assert enc.n_pieces(plain) == len(enc.lib.pre_tokenizer.pre_tokenize_str(plain))
    assert enc.n_pieces(plain + special + plain) == 2 * enc.n_pieces(plain) + 1


def test_edits_touch_little(spark):
    from pyspark.sql import functions as F

    long = " ".join(prose(1, 5000))
    frame = docs(spark, [(1, long + " mail me@x.org now"), (2, None), (3, ""), (4, "a@b.cc a@b.cc"), (5, "é 中 1234567")])
    trees = token_tree.build_trees(frame)
    out = token_tree.apply_edits(trees, token_tree.redactions(F.col("text"), r"\w+@\w+\.\w+|\d{5,}", "[x]"))
    got = {r.row.doc_id: r for r in out.collect()}
    assert got[1].text.endswith(" mail [x] now") and got[1].n_edits == 1 and got[1].n_encoded < 12
    assert got[4].text == "[x] [x]" and got[4].n_edits == 2 and got[5].text == "é 中 [x]"
    assert got[2].text is None and got[2].tokens_after == 0 and got[3].n_edits == 0
    for r in got.values():
        assert r.tokens_after == len(library(r.text or "")) and np.frombuffer(r.tree, "<u4").reshape(2, -1)[1].sum() == r.tokens_after
    again = token_tree.apply_edits(
        out.select("row", "text", "tree"), F.expr("array(struct(0 as start, 2 as end, cast(null as string) as replacement))")
    )
    for r in again.collect():
        assert r.tokens_after == len(library((r.text or "")))


def test_records_round_trip(spark):
    rows, frame = awkward(spark)
    folder = storage.run_folder(spark, "t")
    records.write_token_records(frame, folder, end_id=0)
    index = records.write_index(spark, folder, storage.run_folder(spark, "i"))
    placed = records.with_global_start(index).orderBy("start").collect()
    assert [r.doc_id for r in placed] == [None, None, *sorted(i for i, _ in rows)]
    at = 0
    for r in placed:
        assert r.start == at
        at += r.n_tokens
    want = sorted((i, zlib.crc32(np.array([*library(t or ""), 0], "<u4").tobytes())) for i, t in rows)
    assert sorted((r.doc_id, r.ids_crc32) for r in placed if r.doc_id is not None) == want
    some = records.read_records(spark, folder, index.filter("doc_id in (5, 9, 16)")).collect()
    assert sorted((r.doc_id, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in some) == [w for w in want if w[0] in (5, 9, 16)]


def test_empty_records(spark):
    folder = storage.run_folder(spark, "t")
    records.write_token_records(empty(spark), folder)
    assert records.index_records(spark, folder).count() == 0


def test_damage_is_found():
    whole = records.frame(7, b"\x01\x00\x02\x00", 2) + b"\n"
    assert [(d, i.tolist()) for _, _, d, i in records.frames(whole * 2)] == [(7, [1, 2])] * 2
    for k in range(len(whole)):
        bad = bytearray(whole)
        bad[k] ^= 4
        with pytest.raises(records.DamagedRecord):
            list(records.frames(bytes(bad)))
    with pytest.raises(records.DamagedRecord):
        list(records.frames(whole[:-3]))


def test_packing_deals_rows_with_one_python_worker_a_task(spark):
    """A second Python step in a task takes a second worker, which stays in the executor's memory."""
    pieces = curve_packing.pack_documents(awkward(spark)[1], length=64)
    plan = pieces._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_hilbert_curve_visits_neighbours():
    bits, dims = 3, 3
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = curve_packing.hilbert_keys(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


@pytest.mark.parametrize("parts", [None, 1, 3])
def test_packing_covers_every_id_once(spark, parts):
    rows, frame = awkward(spark)
    pieces = curve_packing.pack_documents(frame, end_id=1, length=64, parts=parts).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens, p.curve), []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    texts = {tuple([*library(t or ""), 1]) for _, t in rows}
    for p in by_doc.values():
        p.sort(key=lambda p: p.start)
    seen = sorted(p.doc_id for p in pieces if p.start == 0 and p.doc_id is not None)
    assert seen == sorted(i for i, _ in rows)
    stream = []
    for k in sorted(by_sequence):
        at = 0
        for p in sorted(by_sequence[k], key=lambda p: p.offset):
            assert p.offset == at and p.length == len(p.ids) // 4
            stream += np.frombuffer(p.ids, "<u4").tolist()
            at += p.length
        assert at == 64 or k == max(by_sequence)
    assert len(stream) == sum(len(library(t or "")) + 1 for _, t in rows) + len(library(rows[4][1])) + 2
    packed, one = [], []
    for i in stream:
        one.append(i)
        if i == 1:
            packed.append(tuple(one))
            one = []
    assert not one and texts.issubset(set(packed))


def test_pieces_are_cut_many_rows_at_once():
    rnd, length = random.Random(5), 7
    parts = sorted(rnd.randint(0, 3) for _ in range(300))
    ids = [np.arange(k, k + rnd.choice([0, 1, 6, 7, 8, 40]), dtype="<u2") for k in range(300)]
    bases, at, want = {}, 10, []
    for i, (part, row) in enumerate(zip(parts, ids)):
        bases.setdefault(part, at)
        for start in sorted({0, *range(-at % length, len(row), length)} if len(row) else ()):
            here = at + start
            size = min(length - here % length, len(row) - start)
            piece = row[start : start + size].astype("<u4").tobytes()
            want.append((i or None, start, size, piece, len(row), -i, here // length, here % length))
        at += len(row)
    rows = pa.record_batch(
        {
            "part": pa.array(parts, pa.int32()),
            "doc_id": pa.array([i or None for i in range(300)], pa.int64()),
            "curve": pa.array([-i for i in range(300)], pa.int64()),
            "ids": pa.array([row.tobytes() for row in ids], pa.binary()),
        }
    )
    cut = curve_packing._pieces(bases, length, 2)
    for batches in ([rows], [rows.slice(0, 100), rows.slice(100, 1), rows.slice(101)]):
        out = list(cut(iter(batches)))
        assert len(out) == len(batches)
        assert [tuple(r.values()) for b in out for r in b.to_pylist()] == want


def test_an_encoder_remembers_as_many_pieces_as_asked():
    assert bpe.encoder(PATH, 30).pieces.limit == 30 and bpe.encoder(PATH).pieces.limit == bpe.MAX_PIECES


def test_sequences_are_padded(spark):
    _, frame = awkward(spark)
    pieces = curve_packing.pack_documents(frame, length=128)
    out = curve_packing.sequences(pieces, 128, pad_id=9).collect()
    assert all(len(r.ids) == 128 for r in out) and sorted(r.sequence_id for r in out) == list(range(len(out)))
    assert curve_packing.pack_documents(empty(spark)).count() == 0


def _jump(key, shards):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_loop():
    keys = np.array([0, 1, -1, 7, 1 << 62, -(1 << 63), 123456789], np.int64)
    for shards in (1, 2, 16, 17, 1000):
        assert sharding.jump_hash(keys, shards).tolist() == [_jump(int(k), shards) for k in keys]


def test_growth_moves_only_into_the_new_shard():
    keys = np.arange(50_000)
    old, new = sharding.jump_hash(keys, 16), sharding.jump_hash(keys, 17)
    moved = old != new
    assert (new[moved] == 16).all() and abs(moved.mean() - 1 / 17) < 0.01
    assert np.bincount(old).max() < 1.1 * len(keys) / 16


def test_slots_are_gapless(spark):
    rows, frame = awkward(spark)
    out = sharding.number_in_shards(sharding.assign_shards(frame, "doc_id", 4), "doc_id").collect()
    assert len(out) == len(rows) + 2
    for shard in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))
    by_text = sharding.assign_shards(frame, "text", 4).collect()
    assert len({r.shard for r in by_text if r.doc_id in (5, 6)}) == 1
    assert sharding.number_in_shards(sharding.assign_shards(empty(spark), "doc_id", 4), "doc_id").count() == 0


def test_shards_keep_columns_with_the_names_of_new_ones(spark):
    rows = [(i % 5 if i % 7 else None, f"s{i}", i, i, i) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, shard string, slot bigint, __one bigint, __part bigint")
    out = sharding.number_in_shards(sharding.assign_shards(df, "doc_id", 4), "doc_id")
    assert out.columns == ["doc_id", "shard_", "slot_", "__one", "__part", "shard", "slot"]
    got = out.collect()
    assert sorted((r.shard_, r.slot_, r["__one"], r["__part"]) for r in got) == sorted((s, a, b, c) for _, s, a, b, c in rows)
    for shard in range(4):
        mine = sorted((r.slot, r.doc_id is not None, r.doc_id or 0) for r in got if r.shard == shard)
        assert [m[0] for m in mine] == list(range(len(mine))) and [m[1:] for m in mine] == sorted(m[1:] for m in mine)


def test_a_null_key_spreads_over_tasks(spark, monkeypatch):
    from tarmac.llm import offsets

    df = spark.range(8000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), F.col("id").alias("v"))
    seen, real = [], offsets.materialize
    monkeypatch.setattr(offsets, "materialize", lambda frame, label: seen.append(real(frame, label)) or seen[-1])
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # so few rows would be one task
    try:
        sharding.number_in_shards(sharding.assign_shards(df, "doc_id", 4), "doc_id")
    finally:
        spark.conf.unset(key)
    held = seen[0].filter("key is null").groupBy("__part").count().collect()
    assert len(held) > 1 and max(r["count"] for r in held) < 3000


def test_registered_token_queries_against_the_library(spark):
    """op3, op4 and op7 as registered, row by row."""
    from tarmac.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    source = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    ids = {i: library(t) for i, t in source.items()}
    start = 0
    found = {r.doc_id: r for r in QUERIES["op4_token_records"](spark, sf).collect()}
    for i in sorted(source):
        packed = np.array([*ids[i], 0], "<u4").tobytes()
        r = found[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids[i]) + 1, zlib.crc32(packed))
        start += r.n_tokens
    pieces = {}
    for r in QUERIES["op7_hilbert_packing"](spark, sf).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    lengths = {}
    for i, rows in pieces.items():
        rows.sort(key=lambda r: r.start)
        whole, at = [*ids[i], 1], 0
        for r in rows:
            part = np.array(whole[at : at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(whole), zlib.crc32(part))
            lengths.setdefault(r.sequence_id, []).append((r.offset, r.length))
            at += r.length
        assert at == len(whole)
    assert set(pieces) == set(source)
    for spans in lengths.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))] and sum(n for _, n in spans) <= 2048
    slots = {}
    for r in QUERIES["op3_jump_shards"](spark, sf).collect():
        data = source[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.shard == jump(r.doc_id, 16) and r.grown_shard == jump(r.doc_id, 17) and r.grown_shard in (r.shard, 16)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and sum(map(len, slots.values())) == len(source)


def jump(key, shards):
    """The published algorithm, one key at a time."""
    state, bucket, at = key % 2**64, -1, 0
    while at < shards:
        bucket = at
        state = (state * 2862933555777941757 + 1) % 2**64
        at = int((bucket + 1) * (float(1 << 31) / float((state >> 33) + 1)))
    return bucket


def test_redactions_are_linear_in_the_matches_and_whole(spark):
    import re

    pattern = r"[a-z]+@[a-z]+(?:\.[a-z]+)+|\d{5,}"
    texts = ["mail a@b.cd now", "12345", "", None, "x" * 50, "a@b.c 123456 \x00 z@y.x", "no 1234 match", "é 99999 ü@x.y q@w.er", "12345 q " * 20_000]
    frame = docs(spark, list(enumerate(texts)))
    trees = token_tree.build_trees(frame)
    out = token_tree.apply_edits(trees, token_tree.redactions(F.col("text"), pattern, "[x]"))
    for r in out.collect():
        text = texts[r.row.doc_id]
        assert r.text == (None if text is None else re.sub(pattern, "[x]", text))
        assert r.n_edits == len(re.findall(pattern, text or ""))
        assert r.tokens_after == len(library(r.text or ""))
