"""Language identification by the nearest of several centroids per language.

A text becomes counts of its hashed three-byte grams (UTF-8, A-Z folded, other
ASCII but letters taken as one space), damped, weighted by inverse document
frequency and scaled to unit length.  Each language has up to ``clusters``
centroids, found by spherical k-means; the prediction is the language of the
centroid with the largest cosine.

Document frequencies count every labelled training row.  Centroids are fitted
on at most ``sample`` rows per language (those with the smallest hashes of
doc_id), a bounded sample.

Rejection is by distance: a language's sampled rows of like length (powers of
two of letter bytes), each held against centroids fitted without it, say how
small its cosines are.  A text nearest to a language, but below ``slack`` times
the low quantile ``odd`` of those, is in no learned language; so a few odd rows
of a language, junk or mislabelled, do not set its floor, and never another's.
Lengths with fewer than ``SUPPORT`` rows borrow those of the lengths beside
them.  Null text, and text without a letter, is ``und`` with score 0 and is
rejected.  With nothing to learn from, every text is
``und``.  Repeated rows are predicted alike, as only the text counts.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import column, slices, utf8, values

GRAM_BITS = 13
SIZE = 1 << GRAM_BITS
CLUSTERS, SAMPLE, ROUNDS, SLACK = 3, 1000, 10, 0.5
ODD, FOLDS, SUPPORT = 0.01, 5, 200
UNKNOWN = "und"
_GRAMS_AT_ONCE = 1 << 18  # a long text is counted piece by piece
BUCKETS = 64
STEPS = 16  # of the scale of hashes that sampled rows are counted by, per power of two

_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_BLANK = ((0x20 << 16 | 0x20 << 8 | 0x20) * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - GRAM_BITS)


def gram_counts(text: bytes) -> np.ndarray:
    """Counts of hashed grams of a whole text; the gram of blanks counts nothing."""
    folded = np.frombuffer(b" " + text.translate(_FOLD) + b" ", dtype=np.uint8)
    counts = np.zeros(SIZE, dtype=np.int64)
    for at in range(0, len(folded) - 2, _GRAMS_AT_ONCE):
        a = folded[at : at + _GRAMS_AT_ONCE + 2].astype(np.uint32)
        grams = ((a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]) * np.uint32(0x9E3779B1)
        counts += np.bincount(grams >> np.uint32(32 - GRAM_BITS), minlength=SIZE)
    counts[_BLANK] = 0
    return counts


def has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "replace"))) if text else False


def length_bucket(counts: np.ndarray) -> int:
    return int(counts.sum()).bit_length()


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit tf-idf rows of a count matrix."""
    x = np.log1p(counts) * idf
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(norms > 0, norms, 1)).astype(np.float32)


def weighed(texts: list[bytes], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit tf-idf rows, length buckets) of texts, one at a time: the rows are held once, as 32-bit numbers."""
    x, lengths = np.empty((len(texts), SIZE), np.float32), np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        counts = gram_counts(text)
        x[i], lengths[i] = weigh(counts[None], idf)[0], length_bucket(counts)
    return x, lengths


def cluster(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means; starts at the mean's nearest row, then always at the row farthest from the chosen."""
    best = x @ x.mean(axis=0)
    seeds = [int(np.argmax(best))]
    near = x @ x[seeds[0]]
    while len(seeds) < min(k, len(x)):
        seeds.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[seeds[-1]])
    centres = x[seeds].copy()
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        for c in range(len(centres)):
            if (own == c).any():
                mean = x[own == c].mean(axis=0)
                centres[c] = mean / (np.linalg.norm(mean) or 1)
    return centres


def held_aside(x: np.ndarray, fold: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Largest cosine of each row with centroids fitted on the rows of the other folds."""
    out = np.zeros(len(x))
    for f in np.unique(fold):
        aside = fold == f
        rest = x[~aside] if not aside.all() else x
        out[aside] = (x[aside] @ cluster(rest, k, rounds).T).max(axis=1)
    return out


def floors_of(buckets: np.ndarray, cosines: np.ndarray, odd: float) -> np.ndarray:
    """The low quantile ``odd`` of the cosines for each length; never higher for a shorter text, which lies farther off."""
    out = np.zeros(BUCKETS)
    for b in range(BUCKETS):
        reach = np.sort(np.abs(buckets - b))[min(SUPPORT, len(buckets)) - 1]
        out[b] = np.quantile(cosines[np.abs(buckets - b) <= reach], odd)
    return np.minimum.accumulate(out[::-1])[::-1]


@dataclass
class Model:
    idf: np.ndarray
    centres: np.ndarray
    langs: list[str]
    floors: np.ndarray  # of each centre's language, by length

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], list[float], list[bool]]:
        """(language, cosine, rejected) of each text."""
        n = len(texts)
        out, score, rejected = [UNKNOWN] * n, [0.0] * n, [True] * n
        known = [i for i, t in enumerate(texts) if t and len(self.langs) and has_letter(t)]
        if known:
            x, lengths = weighed([texts[i] for i in known], self.idf)
            cosines = x @ self.centres.T
            best = np.argmax(cosines, axis=1)
            for i, length, c, near in zip(known, lengths, best, cosines[np.arange(len(best)), best]):
                out[i], score[i] = self.langs[c], float(min(1.0, max(0.0, near)))
                rejected[i] = bool(near < self.floors[c, length])
        return out, score, rejected


def _frequencies(batches):
    seen, rows = np.zeros(SIZE, dtype=np.int64), 0
    for batch in slices(batches):
        for text in utf8(batch, "text"):
            if text:
                seen += gram_counts(text) > 0
                rows += 1
    places = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.r_[-1, places], pa.int64()), pa.array(np.r_[rows, seen[places]], pa.int64())], names=["gram", "n"]
    )


def step_of(pick):
    """Column: a coarse scale of 64-bit hashes, ascending with them; a step holds about a twentieth as many hashes as all
    steps below it together."""
    return F.floor(STEPS * F.log2(pick.cast("double") + F.lit(2.0**63) + F.lit(1.0))).cast("int")


def pick_limits(rows: DataFrame, sample: int) -> DataFrame:
    """(lang, last): the step up to which a language has ``sample`` rows, its last step if it has fewer.

    Rows are counted by language and step in their own tasks (64 x ``STEPS`` + 1 steps at most), so that no task reads a
    language's rows; the rows up to ``last`` are about a twentieth more than ``sample``."""
    counts = rows.groupBy("lang", step_of(F.col("pick")).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("step").rowsBetween(Window.unboundedPreceding, -1))
    needed = counts.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < sample)
    return needed.groupBy("lang").agg(F.max("step").alias("last"))


def train(
    docs: DataFrame,
    clusters: int = CLUSTERS,
    sample: int = SAMPLE,
    rounds: int = ROUNDS,
    slack: float = SLACK,
    odd: float = ODD,
) -> Model:
    """Fit on the rows of ``docs`` (doc_id, text, lang) whose text and lang are not null."""
    rows = docs.select(
        F.xxhash64("doc_id").alias("pick"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    # SIZE + 1 sums at most reach the driver.
    sums = rows.select("text").mapInArrow(_frequencies, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = {r.gram: r.n for r in sums.collect()}
    total = counts.pop(-1, 0)
    seen = np.zeros(SIZE)
    for gram, n in counts.items():
        seen[gram] = n
    idf = np.log((1 + total) / (1 + seen)) + 0.05

    limits = F.broadcast(pick_limits(rows, sample))  # one row per language
    chosen = rows.join(limits, "lang").filter(step_of(F.col("pick")) <= F.col("last"))
    # Repeated doc_ids tie: the bound holds all the same.
    chosen = chosen.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("pick", "text")))
    chosen = chosen.filter(F.col("rank") <= sample).select("lang", "text")

    def fit(key, table):
        texts = table.column("text").cast(pa.binary()).to_pylist()
        x, lengths = weighed(texts, idf)
        centres = cluster(x, clusters, rounds)
        # Copies of a text are in one fold.
        cosines = held_aside(x, np.array([zlib.crc32(t) % FOLDS for t in texts]), clusters, rounds)
        floors = slack * floors_of(lengths, cosines, odd)
        return pa.table(
            {
                "lang": pa.array([key[0].as_py()], pa.string()),
                "centres": pa.array([centres.astype("<f4").tobytes()], pa.binary()),
                "floors": pa.array([floors.tolist()], pa.list_(pa.float64())),
            }
        )

    fitted = chosen.groupBy("lang").applyInArrow(fit, "lang string, centres binary, floors array<double>").collect()
    centres, langs, floors = [np.zeros((0, SIZE), np.float32)], [], [np.zeros((0, BUCKETS))]
    for r in sorted(fitted, key=lambda r: r.lang):
        own = np.frombuffer(r.centres, "<f4").reshape(-1, SIZE)
        centres.append(own)
        langs += [r.lang] * len(own)
        floors.append(np.tile(r.floors, (len(own), 1)))
    return Model(idf, np.concatenate(centres), langs, np.concatenate(floors))


_PREDICTED = ["row", "lang_pred", "score", "rejected"]


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Each row of ``docs`` as the struct ``row``, with ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    packed = docs.select(F.struct("*").alias("row"))
    # A text that is a string is read out of its row: it is sent to the worker once.
    text = docs.select("text").schema[0]
    names = docs.columns
    at = names.index("text") if "text" in names else [n.lower() for n in names].index("text")
    if text.dataType.simpleString() != "string":
        packed, at = packed.withColumn("text", F.col("row.text").cast("string")), None

    def run(batches):
        for batch in slices(batches):
            texts = utf8(batch, "text") if at is None else column(batch, "row").field(at).cast(pa.binary()).to_pylist()
            langs, scores, rejected = shared.value.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.names.index("row")),
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                names=_PREDICTED,
            )

    out = packed.selectExpr("row", "'' as lang_pred", "0D as score", "false as rejected").schema
    return packed.mapInArrow(run, out)


def held_out(doc_id="doc_id"):
    """Column: whether a document is kept out of training (crc32 of its id as text, modulo 5, is 0); null ids are not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def drop_unknown(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that are not rejected, with their own columns."""
    return identify(docs, model).filter(~F.col("rejected")).select("row.*")
