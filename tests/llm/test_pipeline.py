"""The corpus pipeline: each stage on its own input against a brute-force version, and the chain."""

import zlib

import corpus_pipeline
import numpy as np
import pytest
from llm_data import DOCS, awkward, jaccard_components, prose, window_law
from test_texts import _hits, _languages
from test_tokens import library

from tarmac.llm import langid

ITEMS = [(1, " ".join(prose(70, 30))), (2, "same same"), (3, None), (4, "")]
FIELDS = [f.split()[0] for f in DOCS.split(", ")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows = {i: t for i, t in awkward(spark)[0] if i != 9} | {9: " ".join(prose(2, 70) + prose(5, 40))}
    passage = prose(2, 70)
    rows |= {
        20: " ".join(passage),  # all of it stands in an earlier document
        21: " ".join(prose(71, 40) + prose(70, 30)[5:20] + prose(72, 40)),  # holds a benchmark string
        22: "Пример текста на другом языке " * 20,
        23: "123 !? 456",
        24: " ".join(prose(73, 900)),  # its copy of 25 differs in few words
        25: " ".join(prose(73, 900)[:895] + ["odd"]),
    }
    full = [(i, t, "en" if i != 22 else None) for i, t in rows.items()] + [(1000 + i, t, g) for i, t, g in _languages(spark)[:90]]
    full += [(None, rows[5], "en"), (None, None, "en"), (2000, rows[24] + " tail", None)]
    frame = spark.createDataFrame([(i, t, g, "s", len(t) if t is not None else None, "row", ["x"]) for i, t, g in full], DOCS)
    path = f"{tmp_path_factory.mktemp('corpus')}"
    frame.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def _same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def _language_id(spark, rows):
    """The fitted model's own answers, text by text; training rows are picked here."""
    learn = [r for r in rows if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5]
    model = langid.train(spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in learn], DOCS))
    return [r for r in rows if not model.predict([(r["text"] or "").encode()])[2][0]]


def _near_duplicates(spark, rows):
    groups = jaccard_components([(r["doc_id"], r["text"]) for r in rows if r["doc_id"] is not None], 5, 80)
    gone = {i for i, _, first in groups if first < i}
    return [r for r in rows if r["doc_id"] not in gone]


def _substring_dedup(spark, rows):
    law = {i: (removed, kept) for i, _, removed, kept in window_law([(r["doc_id"], r["text"]) for r in rows if r["doc_id"] is not None])}
    out = []
    for r in rows:
        removed, kept = law.get(r["doc_id"], (0, None))
        if removed and kept:
            out.append(r | {"text": kept, "n_chars": len(kept)})
        elif not removed:
            out.append(r)
    return out


def _decontamination(spark, rows):
    hits = _hits(list(enumerate(r["text"] for r in rows)), ITEMS, 10)
    return [rows[at] for at, _, n, _ in hits if not n]


BRUTE = {
    "language_id": _language_id,
    "near_duplicates": _near_duplicates,
    "substring_dedup": _substring_dedup,
    "decontamination": _decontamination,
}


def test_every_stage_and_the_chain(spark, folder):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [*BRUTE, "packing"]
    rows = [r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    for name, brute in BRUTE.items():
        frame = spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows], DOCS)
        got = stages[name](spark, frame, folder)
        assert got.columns == frame.columns
        want = brute(spark, rows)
        assert 0 < len(want) < len(rows) or any(r not in rows for r in want), name
        _same([r.asDict() for r in got.collect()], want)
        rows = want
    ids = {r["doc_id"] for r in rows}
    assert {20, 21, 22, 23, 25, 2000} & ids == set() and {8, 9, 24} - ids == set()

    pieces = corpus_pipeline.run(spark, folder).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    packed = []
    for i, parts in by_doc.items():
        parts.sort(key=lambda p: p.start)
        assert i is None or [p.start for p in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
        packed.append((i, sum(p.length for p in parts), i is not None and np.frombuffer(b"".join(p.ids for p in parts), "<u4").tolist()))
    want = [(r["doc_id"], [*library(r["text"] or ""), 1]) for r in rows]
    nulls = sum(len(t) for i, t in want if i is None)
    _same(packed, [(i, len(t), t) for i, t in want if i is not None] + ([(None, nulls, False)] if nulls else []))
    for k, parts in by_sequence.items():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == [sum(q.length for q in parts[:n]) for n in range(len(parts))]
        assert sum(p.length for p in parts) == 2048 or k == max(by_sequence)
