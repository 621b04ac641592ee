"""Two tokenizers' links against a plain merge of their ends."""

import hashlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from llm_data import awkward, docs, empty
from pyspark.sql import functions as F

from tarmac.llm import bpe, queries, token_links

A, B = bpe.default_path(), token_links.default_pieces_path()


@lru_cache
def library():
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(A)
    lib.encode_special_tokens = True
    return lib, bpe.token_bytes(A), token_links.pieces(B)


def tokens(text):
    """(A ids, A ends, B ids, B ends) from the libraries."""
    lib, spelled, sp = library()
    if not text:
        return [], [], [], []
    a = lib.encode(" " + text, add_special_tokens=False).ids
    b = sp.lib.encode(text)
    data = (" " + text).encode()
    if b"".join(spelled[i] for i in a) != data or b"".join(sp.bytes[i] for i in b) != data:
        return [], [], [], []
    return a, np.cumsum([len(spelled[i]) for i in a]).tolist(), b, np.cumsum([len(sp.bytes[i]) for i in b]).tolist()


def brute(rows):
    aligned, counts = [], Counter()
    for i, text in rows:
        a, a_ends, b, b_ends = tokens(text)
        at = {f: y for y, f in enumerate(b_ends)}
        links = [(x, at[e]) for x, e in enumerate(a_ends) if e in at]
        groups, p, q = [], 0, 0
        for x, y in links:
            groups.append(",".join(map(str, a[p : x + 1])) + "|" + ",".join(map(str, b[q : y + 1])))
            p, q = x + 1, y + 1
        pairs = [(a[x], b[y]) for x, y in links]
        counts.update(pairs)
        aligned.append((i, a, b, groups, pairs))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(n, best.get(y, 0))
    return [
        (
            i,
            len(a),
            len(b),
            len(g),
            len(p),
            sum(counts[x] == best[x[1]] for x in p),
            sum(counts[x] for x in p),
            hashlib.sha256(";".join(g).encode()).hexdigest() if a else "",
        )
        for i, a, b, g, p in aligned
    ]


def found(frame):
    return sorted(
        (tuple(r) for r in frame.select(F.col("row.doc_id"), *[c for c in frame.columns if c != "row"]).collect()),
        key=lambda r: (r[0] is None, r),
    )


@pytest.mark.parametrize("lane", [1, 7, 512])
def test_awkward_rows_against_brute_force(spark, lane):
    rows, frame = awkward(spark)
    rows = [*rows, (None, rows[4][1]), (None, None)]
    rows += [(20, "a▁b"), (21, "tab\tand  two"), (22, "<s> <|endoftext|> <0x41>"), (23, "é“x” 😀 中文"), (24, " lead"), (25, "\x00\x01")]
    frame = frame.unionByName(docs(spark, rows[-6:]))
    got = found(token_links.summary(frame, lane=lane))
    assert got == sorted(brute(rows), key=lambda r: (r[0] is None, r))
    assert {r[0]: r[1] for r in got}[20] == 0  # the model takes U+2581 for a space


def test_counts_come_back_alike_with_and_without_broadcast(spark):
    _, frame = awkward(spark)
    aligned = token_links.align(frame).withColumn("key", F.monotonically_increasing_id())
    counts = token_links.link_counts(aligned)
    small = token_links.link_sums(aligned, counts, max_broadcast=10**9)
    large = token_links.link_sums(aligned, counts, max_broadcast=0)
    assert sorted(small.collect()) == sorted(large.collect())


def test_other_columns_stay_and_an_empty_table_has_no_rows(spark):
    _, frame = awkward(spark)
    clash = frame.withColumn("key", F.lit("k")).withColumn("a_ids", F.lit(1)).withColumn("links", F.lit(2))
    out = token_links.summary(clash)
    assert out.select("row.key", "row.a_ids", "row.links").distinct().collect() == [("k", 1, 2)]
    assert out.count() == frame.count()
    assert token_links.summary(empty(spark)).count() == 0
    assert token_links.align(frame.select("text")).count() == frame.count()


def test_ids_and_cuts_of_every_row(spark):
    rows, frame = awkward(spark)
    got = {}
    for r in token_links.align(frame, ("a_ids", "b_ids", "a_cuts", "b_cuts"), lane=40).collect():
        got.setdefault(r.row.doc_id, []).append(r)
    for i, text in rows:
        a, a_ends, b, b_ends = tokens(text)
        r = next(r for r in got[i] if r.a_ids == a)
        both = sorted(set(a_ends) & set(b_ends))
        assert r.b_ids == b and [a_ends[c - 1] for c in r.a_cuts] == both == [b_ends[c - 1] for c in r.b_cuts]


def test_registered_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op11_lockstep_links"](spark, sf)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(rows))
