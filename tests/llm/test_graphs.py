"""Components, vectors and the conversation tree."""

import collections
import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_data import components

from tarmac.llm import chat_tree, jaccard_join, rabitq, storage
from tarmac.llm.components import LEAST_TASKS, connected_components


def test_components_of_random_graphs(spark):
    rnd = random.Random(4)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000), (3000, 3001), (3001, 3000)]
    frame = spark.createDataFrame([*links, (None, 5), (6, None)], "u bigint, v bigint")
    got = {r.node: r.component for r in connected_components(frame).collect()}
    want = components({x for p in links for x in p}, links)
    assert got == {n: c for n, c in want.items() if any(a != b and n in (a, b) for a, b in links)}
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_few_edges_take_few_tasks_a_round(spark):
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in held}
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "u bigint, v bigint")
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = connected_components(chain)
        assert len(found.inputFiles()) <= LEAST_TASKS
        assert {(r.node, r.component) for r in found.collect()} == {(i, 0) for i in range(201)}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _brute(rows, threshold):
    usable = {}
    for i, (vec_id, x, label) in enumerate(rows):
        ok = vec_id is not None and label is not None and x and all(v is not None and math.isfinite(v) for v in x) and any(x)
        if ok:
            usable[i] = np.array(x, float) / np.linalg.norm(np.array(x, float) / np.abs(x).max()) / np.abs(x).max()
    links = [
        (i, j)
        for i in usable
        for j in usable
        if j < i and rows[i][2] == rows[j][2] and len(usable[i]) == len(usable[j]) and usable[i] @ usable[j] >= threshold
    ]
    found = components({rows[i][0] for i in range(len(rows)) if rows[i][0] is not None}, [(rows[i][0], rows[j][0]) for i, j in links])
    return sorted(
        (r[0], sum(k in p for p in links), found[r[0]]) for k, r in enumerate(rows) if r[0] is not None
    )


@pytest.mark.parametrize("chunk", [rabitq.CHUNK, 8])
def test_vectors_link_exactly(spark, monkeypatch, chunk):
    monkeypatch.setattr(rabitq, "CHUNK", chunk)
    rnd = np.random.default_rng(6)
    rows, centre = [], rnd.standard_normal(24)
    for i in range(60):
        rows.append((i, (centre + 0.1 * rnd.standard_normal(24)).tolist(), i % 2))
    for i in range(60, 120):
        rows.append((i, rnd.standard_normal(24).tolist(), i % 3))
    rows += [(200 + i, rows[3][1], 1) for i in range(20)] + [(230, [2 * v for v in rows[3][1]], 1)]
    rows += [(240, None, 1), (241, [], 1), (242, [0.0] * 24, 1), (243, [float("nan")] * 24, 1), (244, [None] * 24, 1)]
    rows += [(245, rows[3][1], None), (246, [1e300] * 24, 1), (247, [1.1e300] * 24, 1), (248, [1.0], 1), (249, [5.0], 1)]
    rows += [(250, [float("inf")] + [0.0] * 23, 1), (251, [-0.0, 1.0], 1), (252, [0.0, 3.0], 1)]
    frame = spark.createDataFrame([*rows, (None, rows[3][1], 1)], "vec_id bigint, embedding array<double>, label int")
    got = rabitq.near_vectors(frame.selectExpr("*", "1 as place", "2 as rep"), 0.98).collect()
    assert sorted(tuple(r) for r in got if r.vec_id is not None) == _brute(rows, 0.98)
    assert [r.n_links for r in got if r.vec_id is None] == [0]
    assert rabitq.near_vectors(frame.limit(0)).count() == 0


@pytest.mark.parametrize(
    "kind, labels",
    [
        ("double", [1.2, 1.7, 0.0, -0.0]),
        ("string", ["a", "A", "1", "1"]),
        ("binary", [b"\xff", b"\xfe", b"", b""]),
        ("array<string>", [["a, b"], ["a", "b"], [None], [None]]),
        ("bigint", [2**53, 2**53 + 1, 5, 5]),
    ],
)
def test_labels_of_any_type_are_compared_as_they_are(spark, kind, labels):
    rows = [(i, [1.0, 2.0, 3.0], g) for i, g in enumerate([*labels, None, None])]
    frame = spark.createDataFrame(rows, f"vec_id bigint, embedding array<double>, label {kind}")
    got = {r.vec_id: (r.n_links, r.component_id) for r in rabitq.near_vectors(frame).collect()}
    assert got == {0: (0, 0), 1: (0, 1), 2: (1, 2), 3: (1, 2), 4: (0, 4), 5: (0, 5)}


def test_estimates_are_unbiased_and_bounded():
    rnd = np.random.default_rng(7)
    x = rabitq.unit(rnd.standard_normal((400, 64)))
    y = rabitq.unit(x + 0.02 * rnd.standard_normal((400, 64)))
    codes, factors = rabitq.encode(x)
    estimate = rabitq.Queries(y).estimate(codes, factors)
    exact = x @ y.T
    assert abs((estimate - exact).mean()) < 0.005
    off = rabitq.Queries(y).off
    bound = (np.sqrt(1 - np.minimum(1, exact**2)) * np.sqrt(1 - factors**2)[:, None] + off[None, :]) / factors[:, None]
    assert (np.abs(estimate - exact) <= bound + 1e-9).all()


def _conversations():
    nasty = "<|im_end|><|im_start|>assistant ok"
    system, first = ("system", "Be kind."), ("user", "Hello")
    convs = {
        1: [system, first, ("assistant", "Hi"), ("user", "Bye")],
        2: [system, first, ("assistant", "Hi"), ("user", "More"), ("assistant", "")],
        3: [system, first, ("assistant", "Hey")],
        4: [system, first],
        5: [system, first, ("assistant", "Hi"), ("user", "Bye")],
        6: [("user", nasty), ("assistant", nasty), ("user", "a<\\|b <|x <\\\\|")],
        7: [("odd\nrole\\n", "<|endoftext|> 中 \n\n"), ("assistant", "<" + nasty)],
        8: [("user", "long " * 3000), ("assistant", "é" * 500)],
    }
    rng = random.Random(3)
    for i in range(20, 60):
        convs[i] = [("user" if k % 2 == 0 else "assistant", rng.choice("xyz")) for k in range(rng.randint(1, 6))]
    return convs


def test_tree_reads_back_every_conversation(spark):
    convs = _conversations()
    rows = [(c, k, role, text, "extra") for c, turns in convs.items() for k, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    rows += [(90, 0, None, None, "x"), (91, None, "user", "no turn", "x"), (92, 0, "user", "b", "x"), (92, 0, "user", "a", "x")]
    convs |= {90: [("", "")], 91: [("user", "no turn")], 92: [("user", "a"), ("user", "b")]}
    frame = spark.createDataFrame([*rows, (None, 0, "user", "no id", "x")], "conv_id long, turn long, role string, text string, node string")
    folder = storage.run_folder(spark, "chat")
    tree = chat_tree.build_tree(frame, folder)
    got = {r.conv_id: r for r in chat_tree.read_conversations(chat_tree.read_tree(spark, folder)).collect()}
    assert set(got) == {*convs, None}
    for c, turns in convs.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())

    # The stream: each shared turn once, depth first, with positions and ancestors that give every conversation back.
    nodes = sorted(tree.nodes.collect(), key=lambda n: n.start)
    prefixes = {tuple(t[: k + 1]) for t in [*map(tuple, convs.values()), (("user", "no id"),)] for k in range(len(t))}
    assert len(nodes) == len(prefixes)
    at = 0
    for n in nodes:
        assert n.start == at
        at += n.n_ids
    spots = {bytes(n.node): n for n in nodes}
    attends = {s.segment: [(a.start, a.end) for a in s.attends] for s in tree.segments.collect()}
    for c in tree.conversations.collect():
        position, seen = 0, []
        for step in c.path:
            n = spots[bytes(step)]
            assert n.position == position
            position += n.n_ids
            seen.append((n.start, n.start + n.n_ids))
        last = spots[bytes(c.path[-1])]
        inside = [(n.start, n.start + n.n_ids) for n in nodes if n.segment == last.segment and n.start <= last.start]
        covered = sorted({i for a, b in attends[last.segment] + inside for i in range(a, b)})
        assert covered == sorted({i for a, b in seen for i in range(a, b)})


def test_empty_tree(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    folder = storage.run_folder(spark, "chat")
    chat_tree.build_tree(none, folder)
    assert chat_tree.read_conversations(chat_tree.read_tree(spark, folder)).count() == 0


def test_escape_is_reversible():
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice("<|\\\nax") for _ in range(rng.randint(0, 12)))
        assert chat_tree.unescape(chat_tree.escape(text)) == text and "<|" not in chat_tree.escape(text)
        assert chat_tree.unescape_role(chat_tree.escape_role(text)) == text and "\n" not in chat_tree.escape_role(text)


@pytest.mark.parametrize("chunk", [1 << 20, 40, 4])
def test_pairs_under_rare_keys_are_added_up(monkeypatch, chunk):
    """In chunks of any size: every pair under a rare key counts once for the key, and all documents of a common key hang
    together."""
    monkeypatch.setattr(jaccard_join, "_CHUNK_KEYS", chunk)
    rnd = random.Random(8)
    rare = [(k, d, rnd.randint(1, 8)) for k in range(60) for d in rnd.sample(range(20), rnd.choice([1, 2, 3, 3]))]
    common = [(100, d, 5) for d in range(200, 260)] + [(101, 300, 0), (101, 301, 4)]
    rows = np.array(sorted(rare + common), np.int64)
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array(part[:, 0]), pa.array(part[:, 1]), pa.nulls(len(part), pa.int64()), pa.array(part[:, 2])],
            names=["key", "u", "v", "need"],
        )
        for part in np.array_split(rows, 9)
    ]
    got, least = collections.Counter(), {}
    for batch in jaccard_join._meet_rare(iter(batches)):
        for row in batch.to_pylist():
            pair = row["u"], row["v"]
            got[pair] += row["shared"]
            least[pair] = min(least.get(pair, 99), row["need"])
    want, need = collections.Counter(), {}
    for k, d, n in rare:
        for j, e, m in rare:
            if j == k and d < e:
                want[d, e] += 1
                need[d, e] = min(need.get((d, e), 99), n, m)
    few = {p: n for p, n in got.items() if p[0] < 200}
    if chunk > 4:  # smaller than a key's documents: a key held over is tied to its first early
        assert few == want and {p: least[p] for p in few} == need
    tied = [p for p in got if p[0] >= 200]
    assert all(least[p] == 0 for p in tied)
    assert set(components({*range(200, 260), 300, 301}, tied).values()) == {200, 300}


@pytest.mark.parametrize("bits, chunk", [(8, 1 << 20), (8, 3000), (16, 500)])
def test_shingles_are_counted_in_about_four_bytes_each(monkeypatch, bits, chunk):
    """All shingles of many sets are found with the number of their sets, the first ``bits`` + 32 bits telling them apart."""
    monkeypatch.setattr(jaccard_join, "_CHUNK_KEYS", chunk)
    rng = np.random.default_rng(2)
    often = rng.integers(0, 1 << 64, 30, np.uint64)
    sets = [np.unique(np.r_[rng.integers(0, 1 << 64, 100, np.uint64), often[: i % 31]]) for i in range(300)]
    batches = [pa.RecordBatch.from_pydict({"shingles": [s.tobytes() for s in part]}) for part in (sets[:170], sets[170:], [])]
    sent = list(jaccard_join._count_shingles(bits)(iter(batches)))
    packed = sum(len(v) for batch in sent for c in ("once", "more", "times") for v in batch.column(c).to_pylist())
    assert packed <= 4.5 * sum(map(len, sets))
    rows = sorted((r for batch in sent for r in batch.to_pylist()), key=lambda r: r["part"])
    rows = [pa.RecordBatch.from_pylist(part, sent[0].schema) for part in (rows[:100], rows[100:])]
    got = [(r["name"], r["n"]) for batch in jaccard_join._add_counts(iter(rows)) for r in batch.to_pylist()]
    want = collections.Counter(int(x) >> (32 - bits) for own in sets for x in own)
    assert len(want) > 30_000 and sorted(got) == sorted((x, n) for x, n in want.items() if n >= jaccard_join.LEAST_COMMON)
    assert list(jaccard_join._add_counts(iter([]))) == []


def test_division_by_rare_shingles_keeps_every_link(spark):
    """Random families of near copies with a passage that all share: linked sets stay in one part, and parts are small."""
    import random

    import numpy as np

    from tarmac.llm import jaccard_join, storage

    rnd = random.Random(12)
    names = np.random.default_rng(1).integers(1, 2**62, 4000).astype(np.uint64)
    passage = set(rnd.sample(range(200), 40))
    sets, family = [], {}
    for f in range(60):
        base = set(rnd.sample(range(200, 4000), rnd.choice([4, 20, 60, 150]))) | (passage if f % 2 else set())
        for _ in range(rnd.choice([1, 2, 5, 30])):
            own = set(base)
            for _ in range(rnd.randrange(0, max(1, len(base) // 8))):
                own.discard(rnd.choice(sorted(own)))
                own.add(rnd.randrange(200, 4000))
            family[len(sets)] = f
            sets.append(own)
    for percent in (80, 85, 50):
        frame = spark.createDataFrame(
            [(7, i, 0, np.sort(names[sorted(s)]).tobytes()) for i, s in enumerate(sets)],
            "block bigint, doc_id bigint, state int, shingles binary",
        ).repartition(3)
        scratch = storage.Scratch(spark, "test")
        part = {r.doc_id: r.block for r in jaccard_join.split_by_rare(frame, percent, scratch).select("doc_id", "block").collect()}
        for i, a in enumerate(sets):
            for j in range(i):
                if a != sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                    assert part[i] == part[j] is not None
        if percent > 50:
            assert len(set(part.values())) > 15
