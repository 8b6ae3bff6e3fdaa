"""Repeated passages by a sparse suffix array over words.

Of all suffixes only those at content-selected positions are kept: the minimisers, that is the
position with the least hash of ``GRAM`` words in every ``SPREAD`` consecutive ones. Two places that
share ``LEAST`` words share a minimiser in the first ``SPREAD`` positions of the shared passage, hence at
least ``RUN`` = LEAST - SPREAD + 1 words from there on. Suffixes whose first ``RUN`` words no other text
has are dropped by their hash; the rest are dealt by it and sorted, each is compared with all others
of its run, at most ``HOPS`` away in the order, and the match is extended to the left and to the right.
A match of ``LEAST`` words or more marks its words. A suffix carries ``LEAST`` words to the right and
``SPREAD`` to the left, enough to decide; longer passages have further minimisers, and the marks of
all of them are merged.

A crowded run (more suffixes than ``HOPS`` + 1, or several in one text) is not compared by pairs: every
window of ``LEAST`` words around its suffixes is hashed, and one that another text has as well is marked.
Least and greatest text per hash are aggregated before the shuffle, so a very common line or passage
costs as many rows as it has words, and none of its texts is left out.

Exact copies are one text here, so a group of copies is as cheap as one of them; they are passages
in full, and get their marks back at the end. Words are runs without white space; they are compared
by hashes, of 64 bits for a run's start or a window and 32 bits for each word next to a run's start.

Cases: null and empty texts, and texts of fewer than ``LEAST`` words, have no marks; a repeated row is
a copy of the other, and both are marked; a passage that repeats only inside one text is not
marked; a null doc_id is marked, but names a partner only if no copy has an id; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexigate.llm.words import NOT_SPACE, blocks, hashed_words, shingles
from lexigate.scratch import new_path

LEAST = 50
GRAM = 5
SPREAD = 25
RUN = LEAST - SPREAD + 1
HOPS = 8  # neighbours on either side that a suffix is compared with; runs of more go by windows
SORTED_ROWS = 50_000  # suffixes per sorted partition, about

ANCHORS = "text_key bigint, doc_id bigint, n_words int, anchors array<struct<run: bigint, at: int, again: boolean>>"
SUFFIX = "text_key bigint, at int, run bigint, right binary, left binary, window bigint"
MATCH = "text_key bigint, start int, stop int, partner bigint"
_MATCH = pa.schema(
    [("text_key", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("partner", pa.int64())]
)


def minimisers(words, spread: int = SPREAD, gram: int = GRAM) -> np.ndarray:
    """Word positions that have the least hash (the first of equal ones) in some window."""
    first, value = shingles(words, gram)
    if len(first) < spread:
        return np.zeros(0, dtype=np.int64)
    best, width = np.arange(len(value)), 1
    while width < spread:
        step = min(width, spread - width)
        a, b = best[: len(best) - step], best[step:]
        best = np.where(value[b] < value[a], b, a)
        width += step
    opens = np.arange(len(best))
    # windows inside one text
    best = best[words.doc[first[opens]] == words.doc[first[opens + spread - 1]]]
    return first[np.unique(best)]


def anchors_of(words, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the next ``RUN`` words, word position) of the minimisers that have as many."""
    at = minimisers(words)
    first, value = shingles(words, RUN)
    place = np.searchsorted(first, at)
    inside = (place < len(first)) & (first[np.minimum(place, max(len(first) - 1, 0))] == at) if len(first) else np.zeros(len(at), bool)
    at, run = at[inside], value[place[inside]]
    if len(at):
        # in text that repeats a few words over and over, one anchor in every half window does
        opens = np.ones(len(at), dtype=bool)
        opens[1:] = (run[1:] != run[:-1]) | (words.doc[at[1:]] != words.doc[at[:-1]])
        since = at - at[np.flatnonzero(opens)[np.cumsum(opens) - 1]]
        step = since // (SPREAD // 2)
        kept = opens.copy()
        kept[1:] |= step[1:] != step[:-1]
        at, run = at[kept], run[kept]
    return run, at


def anchored(docs: DataFrame) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in blocks(batch.column("text")):
                rows = len(offsets) - 1
                words = hashed_words(data, offsets, NOT_SPACE)
                run, at = anchors_of(words)
                doc = words.doc[at]
                edges = np.searchsorted(words.doc, np.arange(rows + 1))
                # a text of fewer than LEAST words can't hold a passage
                long = np.diff(edges)[doc] >= LEAST
                run, at, doc = run[long], at[long], doc[long]
                order = np.lexsort((run, doc))
                same = (np.diff(run[order]) == 0) & (np.diff(doc[order]) == 0)
                again = np.zeros(len(at), dtype=bool)
                again[order[1:][same]] = True
                held = pa.StructArray.from_arrays(
                    [
                        pa.array(run.view(np.int64)),
                        pa.array((at - edges[doc]).astype(np.int32)),
                        pa.array(again),
                    ],
                    names=["run", "at", "again"],
                )
                cuts = np.searchsorted(doc, np.arange(rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("text_key").slice(row, rows),
                        batch.column("doc_id").slice(row, rows),
                        pa.array(np.diff(edges).astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(cuts), held),
                    ],
                    names=["text_key", "doc_id", "n_words", "anchors"],
                )

    return docs.mapInArrow(find, ANCHORS)


def windows_near(at: np.ndarray, n_words: int) -> np.ndarray:
    """Starts of the windows of ``LEAST`` words whose common minimiser can be one of ``at``.

    Or one that is left out after it, in text that repeats a few words.
    """
    starts = (at[:, None] + np.arange(1 - SPREAD, SPREAD // 2)[None, :]).ravel()
    return np.unique(starts[(starts >= 0) & (starts + LEAST <= n_words)])


def suffixes(texts: DataFrame) -> DataFrame:
    """For each of ``places`` in ``text`` the words after and before it, 4 bytes per word.

    For crowded ones the hashes of the windows around them instead.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
        names = ["text_key", "at", "run", "right", "left", "window"]
        for batch in batches:
            places = batch.column("places").to_pylist()
            keys = batch.column("text_key").to_pylist()
            for row, data, offsets in blocks(batch.column("text")):
                words = hashed_words(data, offsets, NOT_SPACE)
                edges = np.searchsorted(words.doc, np.arange(len(offsets)))
                code = (words.hash >> np.uint64(32)).astype(">u4")
                back = code[::-1].tobytes()
                code = code.tobytes()
                total = len(words.hash)
                first, value = shingles(words, LEAST)
                value = value.view(np.int64)
                made: list[list] = [[], [], [], [], []]
                for i, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                    crowded = []
                    for place in places[row + i]:
                        at = place["at"]
                        if place["crowded"]:
                            crowded.append(at)
                            continue
                        p = lo + at
                        stop, start = min(hi, p + LEAST), max(lo, p - SPREAD)
                        made[0].append(keys[row + i])
                        made[1].append(at)
                        made[2].append(place["run"])
                        made[3].append(code[4 * p : 4 * stop])
                        made[4].append(back[4 * (total - p) : 4 * (total - start)])
                    if crowded:
                        starts = windows_near(np.array(crowded), hi - lo)
                        n = len(starts)
                        hashes = value[np.searchsorted(first, lo + starts)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(n, keys[row + i], dtype=np.int64)),
                                pa.array(starts.astype(np.int32)),
                                pa.nulls(n, types[2]),
                                pa.nulls(n, types[3]),
                                pa.nulls(n, types[4]),
                                pa.array(hashes),
                            ],
                            names=names,
                        )
                columns = [pa.array(m, t) for m, t in zip(made, types)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.nulls(len(made[0]), types[5])], names=names
                )

    return texts.mapInArrow(cut, SUFFIX)


def _padded(column: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    values = column.to_pylist()
    sizes = np.array([len(v) // 4 for v in values], dtype=np.int64)
    raw = b"".join(v.ljust(4 * width, b"\0") for v in values)
    return np.frombuffer(raw, dtype=np.uint32).reshape(-1, width), sizes


def _shared(codes: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal words at the start of rows ``a`` and ``b``."""
    differ = codes[a] != codes[b]
    run = np.where(differ.any(axis=1), differ.argmax(axis=1), codes.shape[1])
    return np.minimum(run, np.minimum(sizes[a], sizes[b]))


def matches(table: pa.Table, least: int = LEAST) -> Iterator[pa.RecordBatch]:
    """Matches of sorted suffixes with their neighbours of other texts."""
    if not table.num_rows:
        return
    key = table["text_key"].to_numpy()
    at = table["at"].to_numpy().astype(np.int64)
    right, right_size = _padded(table["right"], LEAST)
    left, left_size = _padded(table["left"], SPREAD)
    opens = np.flatnonzero(np.diff(key, prepend=~key[:1]) != 0)
    text = np.searchsorted(opens, np.arange(len(key)), side="right") - 1
    edges = np.append(opens, len(key))
    row = np.arange(len(key))
    most_left = np.full(len(key), -1)
    most_right = np.full(len(key), -1)
    partner = np.zeros(len(key), dtype=np.int64)
    for hop in range(HOPS):
        for other in (edges[np.maximum(text - hop, 0)] - 1, edges[np.minimum(text + 1 + hop, len(opens))]):
            inside = (other >= 0) & (other < len(key))
            a, b = row[inside], other[inside]
            apart = key[a] != key[b]
            a, b = a[apart], b[apart]
            ahead = _shared(right, right_size, a, b)
            behind = _shared(left, left_size, a, b)
            good = ahead + behind >= least
            a, b, ahead, behind = a[good], b[good], ahead[good], behind[good]
            for x, y in ((a, b), (b, a)):  # the neighbour is marked as well
                np.maximum.at(most_right, x, ahead)
                np.maximum.at(most_left, x, behind)
                partner[x] = key[y]
    marked = np.flatnonzero(most_right >= 0)
    spans = (at[marked] - most_left[marked], at[marked] + most_right[marked], partner[marked])
    columns = (pa.array(key[marked]), *map(pa.array, spans))
    yield pa.RecordBatch.from_arrays(
        [c.cast(f.type) for c, f in zip(columns, _MATCH, strict=True)], schema=_MATCH
    )


def repeated(docs: DataFrame) -> DataFrame:
    """``doc_id, start_word, stop_word, n_words, partner_id`` for every repeated passage of a document.

    Words from ``start_word`` up to before ``stop_word`` also stand in document ``partner_id``.
    """
    spark = docs.sparkSession

    def written(frame: DataFrame, name: str) -> DataFrame:
        path = new_path(spark, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    keyed = docs.select(
        F.xxhash64("text").alias("text_key"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    ).filter("text is not null")
    marked = written(
        anchored(keyed).withColumn("row_key", F.monotonically_increasing_id()), "anchors"
    )
    texts = marked.groupBy("text_key").agg(
        F.count("*").alias("copies"),
        F.min_by("doc_id", "row_key").alias("of_doc"),
        F.min("row_key").alias("row_key"),
        F.min("doc_id").alias("least_id"),
        F.max("doc_id").alias("most_id"),
        F.first("n_words").alias("n_words"),
    )
    texts = written(texts, "texts")
    unique = marked.join(texts.select("row_key"), "row_key", "left_semi").select(
        "text_key", F.inline("anchors")
    )
    # written, so that the join deals both its sides itself and a very common run can be split
    shared = written(
        unique.groupBy("run")
        .agg(
            F.min("text_key").alias("a"),
            F.max("text_key").alias("b"),
            ((F.count("*") > HOPS + 1) | F.max("again")).alias("crowded"),
        )
        .filter("a <> b")
        .select("run", "crowded"),
        "shared-runs",
    )
    places = (
        unique.join(shared, "run")
        .groupBy("text_key")
        .agg(F.collect_list(F.struct("at", "run", "crowded")).alias("places"))
        .join(texts.select("text_key", "of_doc"), "text_key")
        .select(F.col("text_key").alias("key"), "of_doc", "places")
    )
    chosen = keyed.join(
        places, (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("of_doc"))
    ).select("text_key", "text", "places")
    found = written(suffixes(chosen), "suffixes")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            yield from matches(pa.Table.from_batches(held))

    few = found.filter("window is null").select("text_key", "at", "run", "right", "left")
    parts = max(1, math.ceil(few.count() / SORTED_ROWS))
    compared = (
        few.repartition(parts, "run")
        .sortWithinPartitions("right", "left", "text_key", "at")
        .mapInArrow(compare, MATCH)
    )
    around = found.filter("window is not null").select("text_key", "at", "window")
    # written, so that the join deals both its sides itself and a very common window can be split
    common = written(
        around.groupBy("window")
        .agg(F.min("text_key").alias("a"), F.max("text_key").alias("b"))
        .filter("a <> b"),
        "shared-windows",
    )
    in_windows = around.join(common, "window").select(
        "text_key",
        F.col("at").alias("start"),
        (F.col("at") + LEAST).alias("stop"),
        F.when(F.col("text_key") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("partner"),
    )
    raw = (
        compared.unionByName(in_windows)
        .groupBy("text_key", "start", "stop")
        .agg(F.min("partner").alias("partner"))
    )
    before = (
        Window.partitionBy("text_key")
        .orderBy("start", "stop")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    so_far = (
        Window.partitionBy("text_key")
        .orderBy("start", "stop")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    merged = (
        raw.withColumn("opens", (F.col("start") > F.coalesce(F.max("stop").over(before), F.lit(-1))).cast("int"))
        .withColumn("passage", F.sum("opens").over(so_far))
        .groupBy("text_key", "passage")
        .agg(
            F.min("start").alias("start_word"),
            F.max("stop").alias("stop_word"),
            F.min("partner").alias("partner"),
        )
        .join(
            texts.select(F.col("text_key").alias("partner"), F.col("least_id").alias("partner_id")),
            "partner",
        )
    )
    copied = texts.filter((F.col("copies") > 1) & (F.col("n_words") >= LEAST))
    passages = merged.join(copied.select("text_key"), "text_key", "left_anti")
    in_texts = marked.select("text_key", "doc_id").join(
        passages.select("text_key", "start_word", "stop_word", "partner_id"), "text_key"
    )
    in_copies = (
        marked.select("text_key", "doc_id")
        .join(copied.select("text_key", "n_words", "least_id", "most_id"), "text_key")
        .select(
            "text_key",
            "doc_id",
            F.lit(0).alias("start_word"),
            F.col("n_words").alias("stop_word"),
            F.when(F.col("doc_id") == F.col("least_id"), F.col("most_id"))
            .otherwise(F.col("least_id"))
            .alias("partner_id"),
        )
    )
    return in_texts.unionByName(in_copies).select(
        "doc_id",
        "start_word",
        "stop_word",
        (F.col("stop_word") - F.col("start_word")).alias("n_words"),
        "partner_id",
    )
