"""Splittable reading of CSV files whose quoted fields may hold line breaks.

A line break ends a record only outside quotes, and a byte range can't tell by
itself whether it begins inside a quoted field. Quote parity can: every quoted
field has an even number of quotes (one inside is doubled), so a position is
inside a field exactly if an odd number of quotes stands before it.

1. Every range (input split) counts its quotes and its lines with an odd
   number of them: one small row a range.
2. The counts are summed up over the ranges of a file in order; their parity
   says whether a range begins inside a quoted field.
3. Every range is cut into records at the line breaks outside quotes. Pieces
   of records that cross ranges, at most two a range, are joined afterwards.

Files without an odd line need no joining: the plain splittable reader takes
them. Otherwise lines are joined in Arrow batches and parsed by ``from_csv``.

Cases: line ends are LF or CRLF; a break inside a field is read as LF, as the
multi-line reader does; blank lines are skipped; every file must have the
expected header, and a field that never closes, or a record with another number
of fields, fails the job. A quote inside an unquoted field is no valid CSV here:
it shifts the parity, so the job fails on the field count or the open field.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandcast.session import broadcast_max_rows

QUOTE = '"'
RECORD, HEADER, HEAD, TAIL, MIDDLE = "record", "header", "head", "tail", "middle"
_OUT = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.string()), ("text", pa.string())])


def lines_of(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, start, value): the lines of each input split in order; ``start``
    is the split's offset."""
    lines = spark.read.option("lineSep", "\n").text(paths if isinstance(paths, str) else list(paths))
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _quotes():
    return (F.octet_length("value") - F.octet_length(F.replace(F.col("value"), F.lit(QUOTE), F.lit("")))).cast("long")


def ranges_of(lines: DataFrame) -> DataFrame:
    """(file, start, quotes, odd_lines): a row per range."""
    n = _quotes()
    return lines.groupBy("file", "start").agg(F.sum(n).alias("quotes"), F.sum(n % 2).alias("odd_lines"))


def inside_at_start(ranges: DataFrame) -> DataFrame:
    """(file, start, inside): whether a range begins inside a quoted field."""
    before = F.sum("quotes").over(Window.partitionBy("file").orderBy("start")) - F.col("quotes")
    return ranges.select("file", "start", (before % 2 == 1).alias("inside"))


class _Range:
    """Cuts one range into records, a batch of lines at a time."""

    def __init__(self, file: str, start: int, inside: bool):
        self.file, self.start = file, start
        self.parity = int(inside)
        self.begun_before = inside  # the open record began in an earlier range
        self.open: list[str] | None = [] if inside else None
        self.at_top = start == 0

    def cut(self, values: pa.Array) -> Iterator[tuple[str, str | pa.Array]]:
        odd = pc.count_substring(values, QUOTE).to_numpy(zero_copy_only=False) & 1
        after = (self.parity + np.cumsum(odd)) & 1
        before = after ^ odd
        self.parity = int(after[-1])
        whole = (before == 0) & (after == 0)
        if self.at_top and whole[0]:
            self.at_top, whole[0] = False, False
            yield HEADER, values[0].as_py()
            first = 1
        else:
            first = 0
        rest = np.flatnonzero(~whole)
        for i in rest[rest >= first]:
            if self.open is None:
                self.open = []
            self.open.append(values[int(i)].as_py())
            if not after[i]:
                kind = HEAD if self.begun_before else HEADER if self.at_top else RECORD
                yield kind, "\n".join(self.open)
                self.open, self.begun_before, self.at_top = None, False, False
        yield RECORD, values.filter(pa.array(whole))

    def end(self) -> Iterator[tuple[str, str]]:
        if self.open is not None:
            yield MIDDLE if self.begun_before else TAIL, "\n".join(self.open)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(r, kind, text):
        texts = text if isinstance(text, pa.Array) else pa.array([text], pa.string())
        n = len(texts)
        return pa.RecordBatch.from_arrays([pa.array([r.file] * n, pa.string()), pa.array([r.start] * n, pa.int64()),
                                           pa.array([kind] * n, pa.string()), texts.cast(pa.string())], schema=_OUT)

    now: _Range | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        files, starts = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        names = files.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((np.diff(starts) != 0) | (np.diff(names) != 0)) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows]):
            place = files[int(a)].as_py(), int(starts[a])
            if now is None or (now.file, now.start) != place:
                if now is not None:
                    yield from (out(now, *piece) for piece in now.end())
                now = _Range(*place, bool(batch.column(3)[int(a)].as_py()))
            for kind, text in now.cut(batch.column(2).slice(int(a), int(b - a))):
                if not isinstance(text, pa.Array) or len(text):
                    yield out(now, kind, text)
    if now is not None:
        yield from (out(now, *piece) for piece in now.end())


def _with_package(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it."""
    home = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, home])


def pieces_of(lines: DataFrame, ranges: DataFrame, n_ranges: int) -> DataFrame:
    """(file, start, kind, text): records, headers, and the pieces of records
    that cross ranges."""
    spark = lines.sparkSession
    _with_package(spark)
    inside = inside_at_start(ranges).filter("inside")
    numbered = lines.withColumn("at", F.monotonically_increasing_id())
    if n_ranges <= broadcast_max_rows(spark):
        # the lines keep the order in which a task reads them
        told = numbered.join(F.broadcast(inside), ["file", "start"], "left")
    else:
        told = numbered.join(inside, ["file", "start"], "left").repartition("file", "start").sortWithinPartitions("file", "start", "at")
    return told.select("file", "start", "value", F.coalesce("inside", F.lit(False)).alias("inside")).mapInArrow(
        _pieces, "file string, start long, kind string, text string")


def _joined(pieces: DataFrame) -> DataFrame:
    """Records that cross ranges: a tail, whole ranges, and a head."""
    order = Window.partitionBy("file").orderBy("start", F.when(F.col("kind") == TAIL, 1).otherwise(0))
    begin = F.last(F.when(F.col("kind") == TAIL, F.col("start")), ignorenulls=True).over(order)
    named = pieces.filter(F.col("kind").isin(HEAD, TAIL, MIDDLE)).withColumn("begin", begin)
    parts = F.array_sort(F.collect_list(F.struct("start", "text")))
    done = F.max((F.col("kind") == HEAD).cast("int"))
    joined = named.groupBy("file", "begin").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"), done.alias("done"))
    message = F.concat(F.lit("a quoted field never closes in "), F.col("file"))
    return joined.select("file", F.when(F.col("done") == 0, F.raise_error(message)).otherwise(F.col("text")).alias("text"))


def read_quoted(spark: SparkSession, paths: str | Sequence[str], names: Sequence[str], options: dict[str, str]) -> DataFrame | None:
    """The files' records with columns ``names`` as text, or None if no record
    goes over a line break (the plain reader then reads them alike)."""
    lines = lines_of(spark, paths)
    ranges = ranges_of(lines)
    counted = ranges.agg(F.sum("odd_lines").alias("odd"), F.count(F.lit(1)).alias("n")).first()
    if not counted["odd"]:
        return None
    pieces = pieces_of(lines, ranges, counted["n"])
    layout = ", ".join(f"c{i} string" for i in range(len(names)))
    parsed = F.from_csv(F.col("text"), F.lit(layout), {**options, "mode": "FAILFAST"})
    # CRLF: the record's own end goes, breaks inside fields become LF
    clean = F.replace(F.regexp_replace("text", "\r\\z", ""), F.lit("\r\n"), F.lit("\n"))
    rows = pieces.filter(F.col("kind") == RECORD).select("text").unionByName(_joined(pieces).select("text"))
    headers = pieces.filter(F.col("kind") == HEADER).select("file", F.regexp_replace(clean, "\\A\ufeff", "").alias("text")).select("file", parsed.alias("h"))
    expected = F.struct(*[F.lit(n).alias(f"c{i}") for i, n in enumerate(names)])
    strange = headers.filter(~F.col("h").eqNullSafe(expected)).select(
        F.raise_error(F.concat(F.lit("unexpected header in "), F.col("file"))).cast("string").alias("text"))
    data = rows.unionByName(strange).select(clean.alias("text")).filter(F.trim("text") != "").select(parsed.alias("r"))
    return data.select(*[F.col(f"r.c{i}") for i in range(len(names))]).toDF(*names)
