"""Records of CSV files whose fields may hold line breaks, found in parallel.

Files are read by Spark in blocks, a row per line. Whether a line begins inside a quoted field
depends on all lines before it, but a block can do only two things to that: it is scanned once for
either beginning, the blocks of a file are chained (a small row each), and then every block knows how
it begins. A record that runs over the edge of blocks is put together from its pieces, which are all
that is shuffled.

A field is quoted if a quote is its first character; it ends at the next quote that is not doubled.
Lines end with LF or CRLF, which within a field are kept as they are; a file with bare CR is one line.
Empty lines are no records, before the header neither. Files are told by a 64-bit hash of their path.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigate.scratch import new_path

BYTE_ORDER_MARK = b"\xef\xbb\xbf"
CLOSING = re.compile(rb'(?:[^"]++|"")*+"')  # what is left of a quoted field
BATCH_BYTES = 4 << 20
PINNED = "spark.sql.files.minPartitionNum"

SHAPES = "file bigint, start bigint, ends_0 boolean, ends_1 boolean, closes_0 boolean, closes_1 boolean, filled boolean"
PIECES = "file bigint, origin bigint, start bigint, first boolean, record binary"
HEADER = -1  # in place of the block where a record began: the block holds the header
Key = tuple[int, int]


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether the line's end lies in a quoted field, by whether its beginning does."""
    if b'"' not in line:
        return inside
    at = 0
    if not inside:
        at = 1 if line.startswith(b'"') else line.find(b',"') + 2
        if at == 1 and not line.startswith(b'"'):
            return False
    while closed := CLOSING.match(line, at):
        opened = line.find(b',"', closed.end())
        if opened < 0:
            return False
        at = opened + 2
    return True


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Key, list[bytes]]]:
    """Lines in their order, by block; a block may come in several runs, one after the other."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        files, starts = batch.column("file").to_numpy(), batch.column("start").to_numpy()
        lines = batch.column("line").to_pylist()
        edges = np.flatnonzero((np.diff(files) != 0) | (np.diff(starts) != 0)) + 1
        for low, high in pairwise([0, *edges.tolist(), len(lines)]):
            key, run = (int(files[low]), int(starts[low])), lines[low:high]
            if key != last and not key[1]:
                run[0] = run[0].removeprefix(BYTE_ORDER_MARK)
            yield key, run
            last = key


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and beginning (outside, inside): does it end inside, does any line end outside; is any line not empty."""
    found: list[tuple] = []
    key, ends, closes, filled = None, [False, True], [False, False], False
    for following, lines in _runs(batches):
        if following != key:
            if key is not None:
                found.append((*key, *ends, *closes, filled))
            key, ends, closes, filled = following, [False, True], [False, False], False
        filled = filled or any(line.removesuffix(b"\r") for line in lines)
        for line in lines:
            ends = [ends_inside(line, ends[0]), ends_inside(line, ends[1])]
            closes = [closes[0] or not ends[0], closes[1] or not ends[1]]
    if key is not None:
        found.append((*key, *ends, *closes, filled))
        names = [column.split()[0] for column in SHAPES.split(", ")]
        yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in found])


def _chained(blocks: pd.DataFrame) -> pd.DataFrame:
    """Blocks of a file that begin inside a field, and the block in which that record began; also the
    one with the header if only empty lines stand before it."""
    found, inside, origin, empty = [], False, 0, True
    for row in blocks.sort_values("start").itertuples():
        if empty and row.filled and row.start:
            found.append((row.file, row.start, HEADER))
        empty = empty and not row.filled
        if inside:
            found.append((row.file, row.start, origin))
        ends, closes = (row.ends_1, row.closes_1) if inside else (row.ends_0, row.closes_0)
        if ends and (closes or not inside):
            origin = row.start
        inside = ends
    return pd.DataFrame(found, columns=["file", "start", "origin"])


def _assemble(begun: dict[Key, int]):
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, pa.int64()) for n in ("file", "origin", "start")]
            + [("first", pa.bool_()), ("record", pa.binary())]
        )
        rows: list[dict] = []
        amount = 0
        key, origin, inside, first, parts = None, None, False, False, []

        def add(of: int | None, record: bytes) -> None:
            nonlocal amount, first
            rows.append({"file": key[0], "origin": of, "start": key[1], "first": first, "record": record})
            amount += len(record)
            first = False

        for following, lines in _runs(batches):
            if following != key:
                if parts:  # goes on in the next block
                    add(key[1] if origin is None else origin, b"\n".join(parts))
                key, parts = following, []
                origin = begun.get(key)
                first = origin == HEADER or not key[1]
                origin = None if origin == HEADER else origin
                inside = origin is not None
            for line in lines:
                parts.append(line)
                inside = ends_inside(line, inside)
                if inside:
                    continue
                record = b"\n".join(parts).removesuffix(b"\r")
                if record or origin is not None:
                    add(origin, record)
                origin, parts = None, []
                if amount >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, amount = [], 0
        if parts:
            add(key[1] if origin is None else origin, b"\n".join(parts))
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    return assemble


@contextmanager
def _pinned_blocks(spark: SparkSession) -> Iterator[None]:
    """Blocks that do not depend on how many cores there are at the moment."""
    before = spark.conf.get(PINNED, None)
    spark.conf.set(PINNED, "1")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PINNED)
        else:
            spark.conf.set(PINNED, before)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(first, record)``: every record as text, without its line end; a file's ``first`` is its
    header.

    Files are read twice and their records written once, to the shared folder. Blocks that begin inside
    a field, and headers after a block of empty lines, are listed for all tasks, as three numbers each: every one has a whole block before it, so
    there are at most as many as the input has times ``spark.sql.files.maxPartitionBytes`` (100 TB by
    128 MB: 800,000). No files or empty ones: no rows.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"),
    )
    written = new_path(spark, "csv-records")
    with _pinned_blocks(spark):
        begun = (
            lines.mapInArrow(_shapes, SHAPES)
            .groupBy("file")
            .applyInPandas(_chained, "file bigint, start bigint, origin bigint")
            .collect()
        )
        listed = {(row["file"], row["start"]): row["origin"] for row in begun}
        lines.mapInArrow(_assemble(listed), PIECES).write.parquet(written)
    pieces = spark.read.schema(PIECES).parquet(written).withColumn("record", F.col("record").cast("string"))
    ordered = F.array_sort(F.collect_list(F.struct("start", "record")))
    broken = (
        pieces.filter("origin is not null")
        .groupBy("file", "origin")
        .agg(F.bool_or("first").alias("first"), F.array_join(ordered["record"], "\n").alias("record"))
    )
    return pieces.filter("origin is null").select("first", "record").unionByName(broken.select("first", "record"))
