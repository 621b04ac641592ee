"""Substring dedup, benchmark search, near duplicates and language ID."""

import random
import tracemalloc
import zlib
from pathlib import Path
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow.parquet as pq
import pytest
from llm_data import DOCS, awkward, components, docs, empty, fold, jaccard_components, prose, window_law
from pyspark.sql import functions as F

from tarmac.llm import jaccard_join, langid, lz_dedup, queries, wumanber
from tarmac.llm.components import connected_components
from tarmac.session import checkpoint_dir


def test_lempel_ziv_follows_the_window_law(spark):
    rows, frame = awkward(spark)
    out = lz_dedup.dedup_substrings(frame)
    assert out.select("row.*").columns == frame.columns
    got = out.select("row.doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == window_law(rows)
    assert [r.n_removed for r in got if r.doc_id is None] == [0, 0]


@pytest.mark.parametrize("window", [1, 2, 7, 20])
def test_lempel_ziv_other_windows(spark, window):
    rows = [(i, " ".join(prose(i % 3, 40 + i, 6) + prose(i, 30, 5))) for i in range(12)]
    got = lz_dedup.dedup_substrings(docs(spark, rows), window).select("row.doc_id", "n_words", "n_removed", "kept")
    assert sorted(tuple(r) for r in got.collect()) == window_law(rows, window)


def test_empty_tables(spark):
    none = empty(spark)
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert lz_dedup.dedup_substrings(none).count() == 0
    assert wumanber.find_items(none, items).count() == 0
    assert jaccard_join.near_duplicates(none).count() == 0
    assert langid.identify(none, langid.train(none)).count() == 0
    rows, frame = awkward(spark)
    assert wumanber.drop_contaminated(frame, items).count() == len(rows) + 2
    assert {r.lang_pred for r in langid.identify(frame, langid.train(none)).collect()} == {"und"}


def _hits(rows, items, window):
    strings = {}
    for item, text in items:
        words = wumanber.words_of((text or "").encode())
        m = min(window, len(words))
        for k in range(len(words) - m + 1 if m else 0):
            strings.setdefault(tuple(words[k : k + m]), set()).add(item)
    out = []
    for i, text in rows:
        words, hit, found = wumanber.words_of((text or "").encode()), set(), set()
        for k in range(len(words)):
            for m in {len(s) for s in strings}:
                ids = strings.get(tuple(words[k : k + m]))
                if ids and k + m <= len(words):
                    hit |= set(range(k, k + m))
                    found |= ids
        out.append((i, len(words), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [wumanber.BLOCK_BYTES, 200])
def test_wu_manber_is_exact(spark, block_bytes):
    rows, frame = awkward(spark)
    items = [
        (1, " ".join(prose(2, 70)[10:30])),
        (1, "repeated id"),
        (2, "A, B; c!"),
        (3, None),
        (4, ""),
        (5, "same"),
        (6, "Same SAME same"),
        (10, "ünïcödé 中文"),
        (None, "changed"),
        (7, " ".join(prose(6, 5000)[-40:])),
    ]
    out = wumanber.find_items(frame, spark.createDataFrame(items, "item_id bigint, text string"), 10, block_bytes)
    got = []
    for r in out.collect():
        if r.row.doc_id is not None:
            covered = {k for s in r.spans for k in range(s.start, s.end)}
            assert len(covered) == sum(s.end - s.start for s in r.spans)
            got.append((r.row.doc_id, r.n_words, len(covered), r["items"]))
    assert sorted(got, key=str) == _hits(rows, items, 10)
    clean = wumanber.drop_contaminated(frame, spark.createDataFrame(items, "item_id bigint, text string"))
    assert clean.columns == frame.columns


def test_shift_tables_skip_and_buckets_confirm():
    [machine] = wumanber.machines([(1, b"a b c d e f g h i j k")], 10)
    assert machine.far == 9 and machine.shift[(b"i", b"j")] == 0 and machine.shift[(b"a", b"b")] == 8
    spans, found = [], set()
    machine.search(b"x a b c d e f g h i j y b c d e f g h i j".split(), spans, found)
    assert spans == [(1, 11)] and found == {1}


@pytest.mark.parametrize("max_block, max_bytes", [(1024, jaccard_join.MAX_BYTES), (3, jaccard_join.MAX_BYTES), (1024, 4000)])
def test_jaccard_join_is_exact(spark, monkeypatch, max_block, max_bytes):
    monkeypatch.setattr(jaccard_join, "MAX_BYTES", max_bytes)
    rows, frame = awkward(spark)
    # A family of near copies that chains, some equal, and one shared line in unrelated texts.
    rows = [r for r in rows if r[0] != 9]
    stem = prose(40, 60)
    for i in range(24):
        copy = list(stem)
        for k in range(i):
            copy[2 * k] = f"new{k}"
        rows.append((100 + i, " ".join(copy)))
        rows.append((200 + i, "shared line of some words here " + " ".join(prose(50 + i, 25))))
    got = jaccard_join.near_duplicates(docs(spark, rows), 4, 85, max_block).collect()
    assert sorted(tuple(r) for r in got) == jaccard_components(rows, 4, 85)
    nulls = jaccard_join.near_duplicates(frame.filter("doc_id is null")).collect()
    assert all(r.component_id is None for r in nulls) and len(nulls) == 2


def test_sets_of_large_blocks_are_on_disk_only_until_their_keys_are_sent(spark, monkeypatch):
    """No set is stored before blocks are known to be too large for a task, and none while parts of these are sought; of
    their sets, only those that rare shingles connect are made again."""
    rows = [(i, "a line that all of these texts have in front " + " ".join(prose(60 + i, 30))) for i in range(20)]
    rows += [(100 + i, rows[i][1] + " tail") for i in range(4)] + [(200, " ".join(prose(90, 40))), (201, " ".join(prose(90, 41)))]
    root = Path(unquote(urlparse(checkpoint_dir(spark)).path), "tarmac-llm")
    old, seen = {*root.rglob("*.parquet")}, {}

    def tables():
        files = [f for f in {*root.rglob("*.parquet")} - old if "shingles" in pq.read_schema(f).names]
        return {f.parent.name: sum(pq.read_metadata(g).num_rows for g in files if g.parent == f.parent) for f in files}

    def components_of(edges, folder=None):
        seen["parts" if folder.endswith("rare-tied") else "rest"] = tables()
        return connected_components(edges, folder)

    def counts(sets, scratch, name):
        seen[name] = tables()
        return count(sets, scratch, name)

    # One block of the texts that share a line, as on large inputs.
    count, low = jaccard_join._counts, F.when(F.col("doc_id") < 200, 0).otherwise(200).cast("bigint")
    monkeypatch.setattr(jaccard_join, "connected_components", components_of)
    monkeypatch.setattr(jaccard_join, "_counts", counts)
    monkeypatch.setattr(jaccard_join, "ties", lambda rows, keys_of: rows.select(low.alias("u"), F.col("doc_id").alias("v")))
    got = jaccard_join.near_duplicates(docs(spark, rows), 4, 80, 6).collect()
    assert sorted(tuple(r) for r in got) == jaccard_components(rows, 4, 80)
    assert seen["first"] == seen["parts"] == seen["rest"] == {}
    assert seen["rare"] == {"rare-sets": 8}


def _family(rnd, first):
    """(doc_id, set) of near copies that chain, branch and lie beside each other at about the join radius."""
    stems = [{rnd.getrandbits(62) for _ in range(rnd.choice((12, 20, 30)))} for _ in range(rnd.randint(1, 3))]
    sets = [frozenset(s) for s in stems]
    while len(sets) < 60:
        copy = set(rnd.choice(sets))
        for _ in range(rnd.choice((1, 1, 2, 3, 5))):
            if rnd.random() < 0.7:
                copy.discard(rnd.choice(sorted(copy)))
            copy.add(rnd.getrandbits(62))
        sets.append(frozenset(copy))
    return [(first + i, s) for i, s in enumerate(dict.fromkeys(sets))]


@pytest.mark.parametrize("max_block, chunks, pivots", [(4, 1, 2), (2, 1, 1), (6, 2, 3)])
def test_blocks_divided_again_and_again_lose_no_link(spark, monkeypatch, max_block, chunks, pivots):
    import random

    import numpy as np

    monkeypatch.setattr(jaccard_join, "CHUNKS", chunks)
    monkeypatch.setattr(jaccard_join, "PIVOTS", pivots)
    rounds, divide = [], jaccard_join._round
    monkeypatch.setattr(jaccard_join, "_round", lambda *args: rounds.append(1) or divide(*args))
    rnd, rows, links = random.Random(11), [], []
    for block in range(40):
        family = _family(rnd, 1000 * block)
        rows += [(block, i, 0, bytearray(np.array(sorted(s), np.uint64).tobytes())) for i, s in family]
        links += [
            (i, j) for i, s in family for j, t in family if j < i and 100 * len(s & t) >= 85 * len(s | t)
        ]
    sets = spark.createDataFrame(rows, "block bigint, doc_id bigint, state int, shingles binary")
    got = [tuple(r) for r in jaccard_join.verified_links(sets, 85, max_block).collect()]
    ids = [r[1] for r in rows]
    assert components(ids, got) == components(ids, links) and len(rounds) >= 3


def test_jaccard_signatures_meet_for_every_linked_pair():
    import random

    import numpy as np

    rnd, signatures, met = random.Random(3), jaccard_join.Signatures(85), 0
    for n in [6, 7, 9, 13, 20, 21, 35, 64, 200, 700]:
        for _ in range(60):
            a = {rnd.getrandbits(63) for _ in range(n)}
            b = set(rnd.sample(sorted(a), n - rnd.randint(0, max(1, n // 8))))
            b |= {rnd.getrandbits(63) for _ in range(rnd.randint(0, max(1, n // 8)))}
            if a != b and 100 * len(a & b) >= 85 * len(a | b):
                keys = [signatures.keys(np.array(sorted(s), np.uint64)) for s in (a, b)]
                assert np.intersect1d(*keys).size, n
                met += 1
    assert met > 100


def test_keep_first_keeps_one_of_each_group(spark):
    rows, frame = awkward(spark)
    kept = jaccard_join.keep_first(frame, 5, 80)
    assert kept.columns == frame.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert 5 in ids and not {6, 7, 13, 15} & set(ids) and 14 in ids and {1, 2, 3}.issubset(ids)


def _languages(spark):
    stems = {"aa": "ka lo mi ta".split(), "bb": "ßen üch ott ier".split(), "cc": "zqu xw vv yy".split()}
    rows = []
    for i in range(240):
        lang = ("aa", "bb", "cc")[i % 3]
        words = prose(i, 5 + i % 60, 50)
        rows.append((i, " ".join(stems[lang][int(w[1:]) % 4] * (1 + int(w[1:]) % 2) for w in words), lang))
    return rows


def test_language_of_held_out_texts(spark):
    rows = _languages(spark)
    frame = spark.createDataFrame([(i, t, g, "s", 1, "row", ["x"]) for i, t, g in rows], DOCS)
    assert [r[0] for r in frame.select(langid.held_out()).collect()] == [zlib.crc32(str(i).encode()) % 5 == 0 for i, _, _ in rows]
    model = langid.train(frame.filter(~langid.held_out()), sample=40)
    out = langid.identify(frame, model)
    tested = [r for r in out.filter(langid.held_out("row.doc_id")).collect()]
    assert len(tested) > 20 and all(r.lang_pred == r.row.lang and 0 <= r.score <= 1 and not r.rejected for r in tested)
    strange = docs(spark, [(1, None), (2, ""), (3, "123 !? 456"), (4, "Пример текста на другом языке " * 20), (5, "Ka lo")])
    got = {r.row.doc_id: (r.lang_pred, r.rejected) for r in langid.identify(strange, model).collect()}
    assert [got[i] for i in (1, 2, 3)] == [("und", True)] * 3
    assert got[4][1] and got[5] == ("aa", False)
    assert [r.doc_id for r in langid.drop_unknown(strange, model).collect()] == [5]
    assert langid.drop_unknown(strange, model).columns == strange.columns
    # The text as another column than the last or first, in another case, or as bytes; more rows than a slice.
    many = spark.range(600).selectExpr("id as doc_id", "'Ka lo' as a", "if(id = 599, null, 'Ka lo') as Text", "7 as row")
    for frame in (many, many.selectExpr("doc_id", "cast(Text as binary) as text", "a")):
        got = langid.identify(frame.coalesce(1), model).select("row.doc_id", "lang_pred").collect()
        assert [r.lang_pred for r in sorted(got, key=lambda r: r.doc_id)] == ["aa"] * 599 + ["und"]


def test_grams_of_a_long_text_are_all_counted(monkeypatch):
    text = "".join(random.Random(4).choices("abc déZ.9", k=5000)).encode()
    whole = langid.gram_counts(text)
    for size in (1, 7, 1000, 5000):
        monkeypatch.setattr(langid, "_GRAMS_AT_ONCE", size)
        assert (langid.gram_counts(text) == whole).all() and langid.gram_counts(b"").sum() == 0


def test_prediction_holds_a_batch_once():
    """256 texts are 8 MB of 32-bit rows; their counts as whole numbers and doubles would be over 60 MB."""
    n = 256
    centres = np.zeros((1, langid.SIZE), np.float32)
    model = langid.Model(np.ones(langid.SIZE), centres, ["en"], np.zeros((1, langid.BUCKETS)))
    texts = [" ".join(prose(i, 40)).encode() for i in range(n)]
    model.predict(texts[:1])
    tracemalloc.start()
    model.predict(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * 4 * langid.SIZE * n


def test_sampled_rows_are_those_of_the_smallest_hashes(spark):
    """For hashes at both ends of the range, ties, and a language of fewer rows than are sampled."""
    rnd = random.Random(9)
    rows = [("aa", rnd.randrange(-(2**63), 2**63)) for _ in range(3000)] + [("bb", rnd.randrange(-(2**63), 2**63)) for _ in range(30)]
    rows += [("cc", -(2**63) + i) for i in range(300)] + [("cc", 2**63 - 1)] * 5 + [("dd", 77)] * 900
    frame = spark.createDataFrame(rows, "lang string, pick bigint").repartition(5)
    limits = langid.pick_limits(frame, 100)
    kept = frame.join(limits, "lang").filter(langid.step_of(frame["pick"]) <= limits["last"]).select("lang", "pick").collect()
    for lang, most in (("aa", 125), ("bb", 30), ("cc", 305), ("dd", 900)):
        own = sorted(p for g, p in rows if g == lang)
        got = sorted(r.pick for r in kept if r.lang == lang)
        assert got[:100] == own[:100] and got == own[: len(got)] and len(got) <= most
    assert langid.pick_limits(frame.limit(0), 100).count() == 0


def test_odd_training_rows_do_not_let_other_languages_in(spark):
    given = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.train(given.filter(~langid.held_out()))
    passage = (
        "Questa è una frase scritta in lingua italiana che non appartiene a nessuna delle lingue imparate, e parla del "
        "tempo, della casa e della famiglia che abita vicino al mare. Il giorno dopo siamo andati al mercato per "
        "comprare frutta, verdura e un poco di pane fresco, poi abbiamo camminato lungo la strada fino alla chiesa. "
    ) * 6
    foreign = [passage[at : at + n].encode() for n in (400, 1000) for at in range(0, 200, 10)]
    assert all(model.predict(foreign)[2])
    tested = langid.identify(given.filter(langid.held_out() & (F.length("text") >= 20)), model).collect()
    assert len(tested) > 1900 and not any(r.rejected for r in tested)


def test_floors_are_set_by_many_rows():
    buckets, cosines = np.repeat([6, 9, 12], 400), np.repeat([0.4, 0.6, 0.8], 400)
    cosines[[0, 400, 401, 800]] = 0.01  # odd rows
    floors = langid.floors_of(buckets, cosines, langid.ODD)
    assert np.allclose(floors[[0, 6, 9, 12, 40]], [0.4, 0.4, 0.6, 0.8, 0.8])


def test_language_of_the_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    tested = queries.QUERIES["op10_centroid_language"](spark, sf).filter("held_out").collect()
    assert sum(r.lang_pred == langs[r.doc_id] for r in tested) / len(tested) >= 0.97
    assert not any(r.rejected for r in tested)


def test_fold_is_ascii_only():
    assert fold("ÄBC") == "Äbc"
