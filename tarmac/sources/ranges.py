"""CSV files whose quoted fields hold line breaks, read by byte ranges.

A reader that starts inside a file cannot tell whether its first line break ends
a record or lies in quotes.  The number of quotes before it tells: it is odd
inside a quoted field (a doubled quote counts twice).  So:

1. every range counts its quotes, and a sum over the ranges before it in the
   file says with which parity a range starts (one number per range, of the
   size of a Spark input split, reaches the driver);
2. every range is read again as lines, in many tasks; with its parity known, it
   joins the lines of a record and passes whole records on;
3. where a range starts in the middle of a record, the pieces at the ends of
   the ranges are collected and joined; only files with such ranges are read a
   third time.

The records are then parsed by Spark's own CSV parser, and each file's header is
compared with the first one's.  Quotes are as in RFC 4180: a field that holds
one is quoted, and quotes inside are doubled; a file with a quote left open
raises.
"""

from __future__ import annotations

import csv
import io

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHOLE, HEAD, TAIL = 0, 1, 2
_PIECES = "kind int, file string, start bigint, text string"


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file of a source (a listing; no contents are read)."""
    return spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0


def split_bytes(spark: SparkSession) -> int:
    """Bytes above which Spark divides a file."""
    return spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def _fixed_splits(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings that divides every file above ``maxPartitionBytes`` at its multiples: with
    one partition asked for, the size of a split is not lowered to a core's share of the bytes read."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    return own


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def odd_starts(lines: DataFrame) -> dict[str, dict[int, bool]]:
    """For every range of every file: whether it starts inside quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    window = Window.partitionBy("file").orderBy("start")
    before = F.sum("quotes").over(window.rowsBetween(Window.unboundedPreceding, -1))
    end = F.sum("quotes").over(window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    found: dict[str, dict[int, bool]] = {}
    for r in counted.select("file", "start", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("odd"), (end % 2 == 1).alias("open")).collect():
        if r.open:
            raise ValueError(f"{r.file}: a quoted field is left open")
        found.setdefault(r.file, {})[r.start] = r.odd
    return found


class _Range:
    """The lines of one range, one after the other."""

    def __init__(self, file: str, start: int, odd: bool, header: list[str], first: bool):
        self.file, self.start, self.header = file, start, header
        self.inside, self.head, self.held = odd, odd, []
        self.wants_header = first

    def record(self, text: str) -> str | None:
        text = text.removesuffix("\r")
        if self.wants_header:
            self.wants_header = False
            found = next(csv.reader(io.StringIO(text, newline="")), [])
            if [h.removeprefix("﻿") for h in found] != self.header:
                raise ValueError(f"{self.file}: its header is {found}, the first file's {self.header}")
            return None
        return text or None  # an empty line is no record

    def take(self, line: str, odd: bool):
        """(kind, text) of what a line, with an odd number of quotes or not, completes; nothing inside a record."""
        if not (self.inside or odd):
            text = self.record(line)
            return None if text is None else (WHOLE, text)
        self.held.append(line)
        self.inside ^= odd
        if self.inside:
            return None
        text, self.held = "\n".join(self.held), []
        if self.head:
            self.head = False
            return HEAD, text
        text = self.record(text)
        return None if text is None else (WHOLE, text)

    def close(self):
        """What the range leaves to the next one."""
        if not self.held:
            return None
        if self.wants_header:
            raise ValueError(f"{self.file}: the header does not end within the first range")
        return (HEAD if self.head else TAIL), "\n".join(self.held)


def _records(odd: dict[str, dict[int, bool]], header: list[str]):
    """mapInArrow over lines in file order: records, and pieces of those that cross the ends of a range."""

    def rows(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.string()]
        cols = zip(*found) if found else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["kind", "file", "start", "text"])

    def run(batches):
        at: _Range | None = None
        for batch in batches:
            quotes = pc.bit_wise_and(pc.count_substring(batch.column(0), '"'), 1)
            found = []
            for line, file, start, n in zip(*(batch.column(i).to_pylist() for i in range(3)), quotes.to_pylist()):
                if at is None or at.file != file or at.start != start:
                    if at is not None and (left := at.close()):
                        found.append((left[0], at.file, at.start, left[1]))
                    starts = odd.get(file, {})
                    if start not in starts:
                        raise RuntimeError(f"{file}: its ranges or files have changed since its quotes were counted")
                    at = _Range(file, start, starts[start], header, start == min(starts))
                if done := at.take(line, bool(n)):
                    found.append((done[0], at.file, at.start, done[1]))
            yield rows(found)
        if at is not None and (left := at.close()):
            yield rows([(left[0], at.file, at.start, left[1])])

    return run


def records(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """``text`` of every record of the files but their headers."""
    lines = _lines(spark, path)
    odd = odd_starts(lines)
    found = lines.mapInArrow(_records(odd, header), _PIECES)
    whole = found.filter(F.col("kind") == WHOLE).select("text")
    crossed = [file for file, starts in odd.items() if any(starts.values())]
    if not crossed:
        return whole
    pieces = lines.filter(F.col("file").isin(crossed)).mapInArrow(_records(odd, header), _PIECES).filter(F.col("kind") != WHOLE)
    # The pieces of a record: a tail, then the heads of the ranges that it goes on in.
    in_order = Window.partitionBy("file").orderBy("start", "kind")
    pieces = pieces.withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(in_order))
    parts = F.array_sort(F.collect_list(F.struct("start", "kind", "text")))
    joined = pieces.groupBy("file", "record").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))
    return whole.unionByName(joined.select(F.regexp_replace("text", "\r$", "").alias("text")))


def read_ranges(spark: SparkSession, path: str, header: list[str], options: dict[str, str]) -> DataFrame:
    """All fields as text, one column per header."""
    names = [f"c{i}" for i in range(len(header))]
    schema = ", ".join(f"{c} string" for c in names)
    parsed = F.from_csv("text", schema, {**options, "mode": "FAILFAST", "multiLine": "true"})
    found = records(_fixed_splits(spark), path, header).select(parsed.alias("r")).select(*(F.col(f"r.{c}") for c in names))
    return DataFrame(found._jdf, spark)  # tables are written and looked up in the caller's session
