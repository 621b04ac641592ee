"""Suffix arrays and repeated bytes against brute force."""

import random

import numpy as np
import pytest
from llm_data import awkward, docs, empty
from pyspark.sql import functions as F

from tarmac.llm import queries, suffix_dedup


def test_suffix_array_equals_sorted_suffixes():
    rnd = random.Random(4)
    for k in range(3000):
        n = rnd.randrange(0, 60)
        s = [rnd.randint(1, rnd.choice([1, 2, 3, 30])) for _ in range(n)]
        if k % 5 == 0 and n:
            s = (s[: rnd.randint(1, 4)] * n)[:n]
        assert suffix_dedup.suffix_array(np.array(s, dtype=np.int64)).tolist() == sorted(range(n), key=lambda i: s[i:]), s


def law(texts, window):
    """(n_bytes, n_removed, spans, kept) of every text by the definition."""
    data = [(t or "").encode() for t in texts]
    times = {}
    for b in data:
        for i in range(len(b) - window + 1):
            run = b[i : i + window]
            times[run] = times.get(run, 0) + 1
    out = []
    for b in data:
        gone = [False] * len(b)
        for i in range(len(b) - window + 1):
            if times[b[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return out


def found(frame):
    rows = frame.select("row.doc_id", "row.text", "n_bytes", "n_removed", F.size("removed"), "kept").collect()
    return sorted(((r[0], r[1]), (*r[2:5], bytes(r[5]))) for r in rows if r[0] is not None)


def texts_like(seed, n, alphabet, window):
    """Texts of few letters that share pieces of about a window with each other and with themselves."""
    rnd = random.Random(seed)
    shared = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(window - 3, 3 * window))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            s = rnd.choice(shared)
            cut = rnd.randint(0, 6)
            parts.append(rnd.choice([s, s[cut:], s[: len(s) - cut], "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 2 * window)))]))
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("group", [1 << 20, 0])
@pytest.mark.parametrize("window, alphabet", [(16, "ab"), (24, "abcdefgh é"), (40, "a "), (64, "xyz中 ")])
def test_random_texts_against_brute_force(spark, window, alphabet, group):
    texts = texts_like(window, 60, alphabet, window) + [None, "", alphabet[0] * 300, alphabet[0] * 301, (alphabet * 99)[:300]]
    got = found(suffix_dedup.remove_repeats(docs(spark, list(enumerate(texts))), window, group))
    want = law(texts, window)
    for ((i, _), row) in got:
        assert row == want[i], (i, texts[i])
    assert len(got) == len(texts)


def test_phrases_find_what_brute_force_finds():
    """In one suffix array, without Spark: also where no cut comes for long."""
    for window, alphabet in [(16, "ab"), (20, "abc"), (100, "a"), (400, "ab cd"), (400, "\x00\x01\x02é")]:
        shape = suffix_dedup.Shape(window)
        blocks = [t.encode() for t in texts_like(window + 1, 25, alphabet, window)]
        blocks = [b for b in blocks if len(b) >= window] + [b"a" * (window + 3)]
        start, got = suffix_dedup.Phrases(blocks, shape).repeated()
        times, runs = {}, []
        for b in blocks:
            for i in range(len(b) - window + 1):
                runs.append(b[i : i + window])
                times[runs[-1]] = times.get(runs[-1], 0) + 1
        assert got.tolist() == [times[r] > 1 for r in runs]


def test_pieces_of_long_texts_meet(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 97)  # also in the workers: local functions carry the module's state
    texts = texts_like(9, 30, "abcd ", 24)
    shape = suffix_dedup.Shape(24)
    rows = [(i, at, p) for held in suffix_dedup._pieces([t.encode() for t in texts], 24) for i, at, p in held]
    starts = {}
    for i, at, p in rows:
        data = np.frombuffer(p, np.uint8)
        first, runs, _, _ = suffix_dedup.blocks_of(data, np.array([len(p)]), shape)
        for a, n in zip(first.tolist(), runs.tolist()):
            starts.setdefault(i, []).extend(range(at + a, at + a + n))
    for i, t in enumerate(texts):
        assert sorted(starts.get(i, [])) == list(range(max(0, len(t.encode()) - 23)))


@pytest.mark.parametrize("group", [suffix_dedup.GROUP, 1500])
def test_awkward_rows_against_brute_force(spark, group):
    rows, frame = awkward(spark)
    rows = [*rows, (None, rows[4][1]), (None, None)]
    got = found(suffix_dedup.remove_repeats(frame, 400, group))
    want = sorted(((i, t), row) for (i, t), row in zip(rows, law([t for _, t in rows], 400)) if i is not None)
    assert [r for _, r in sorted(got, key=repr)] == [r for _, r in sorted(want, key=repr)]
    out = suffix_dedup.remove_repeats(frame.withColumn("k1", F.lit("k")).withColumn("spans", F.lit(1)))
    assert out.select("row.k1", "row.spans", "row.row").distinct().collect() == [("k", 1, "row")]
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_registered_query_against_brute_force(spark):
    import hashlib

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = [(i, n, r, s, hashlib.sha256(k).hexdigest()) for (i, _), (n, r, s, k) in zip(rows, law([t for _, t in rows], 400))]
    got = queries.QUERIES["op12_lyndon_suffix_dedup"](spark, sf)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
