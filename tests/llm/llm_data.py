"""Small frames with every awkward row, and brute-force versions."""

from __future__ import annotations

import random
import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, words array<string>"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def prose(seed: int, n: int, vocabulary: int = 4000) -> list[str]:
    rnd = random.Random(seed)
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


def docs(spark, rows):
    """A frame like ``documents`` with extra columns whose names clash with those that operators use."""
    full = [(i, t, "en", "s", len(t) if t is not None else None, "row", ["x"]) for i, t in rows]
    return spark.createDataFrame(full, DOCS)


def awkward(spark):
    """Nulls, empty and blank texts, ties, repeated rows, null ids, one long text, shared passages, near copies."""
    base, passage = prose(1, 120), prose(2, 70)
    near = list(base)
    near[60] = "changed"
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "one"),
        (5, " ".join(base)),
        (6, " ".join(base)),
        (7, "\n".join(near)),
        (8, " ".join(prose(3, 30) + passage + prose(4, 30))),
        (9, " ".join(passage + prose(5, 40))),
        (9, " ".join(passage + prose(5, 40))),
        (10, " ".join(prose(6, 5000) + passage[5:65] + prose(7, 5000))),
        (11, "same " * 200),
        (12, "same " * 130),
        (13, " ".join(w.upper() for w in base)),
        (14, "a b c"),
        (15, "a b c"),
        (16, "ünïcödé 中文 text ٣ <|endoftext|> <|im_end|>"),
        (9, "another text under a used id"),
    ]
    return rows, docs(spark, [*rows, (None, " ".join(base)), (None, None)])


def empty(spark):
    return docs(spark, [])


def window_law(rows, window=50):
    """(doc_id, n_words, n_removed, kept) by the definition."""
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    source: dict[tuple, int] = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            run = tuple(w[k : k + window])
            source[run] = min(i, source.get(run, i))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if source[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), " ".join(kept)))
    return sorted(out)


def shingles(text, k):
    w = WORD.findall(fold(text))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_components(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    links = [
        (a, b)
        for x, (a, s) in enumerate(sets)
        for b, t in sets[:x]
        if a != b and s and t and 100 * len(s & t) >= percent * len(s | t)
    ]
    found = components([i for i, _ in sets], links)
    return sorted((i, len(s), found[i]) for i, s in sets)
