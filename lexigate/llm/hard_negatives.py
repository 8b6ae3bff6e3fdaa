"""Hard negatives for anchors and their positives, by slot-decomposed selection.

An anchor's positives are its best rows of the same label. Each positive opens a window of scores
below its own, and wants the best rows of other labels in it. The windows of one anchor overlap, so
they are not searched one by one: the positives' upper limits, in descending order, cut the scores
into disjoint slots. A row of another label falls into one slot, every task keeps the best ``k`` per
anchor and slot, and the slots' winners are combined the same way. The window of a positive is its
own slot and those below it, so merging slots from the lowest upwards answers all windows; a window's
lower limit then cuts its answer from below, which never lets another row in.

Anchors are a stated query set that meets all rows in blocks: rows are dealt to slices of at most
about ``SLICE`` (fewer where that would leave shuffle partitions idle), every slice sees all anchors
as a stream, a block of them at a time. A task holds a slice and a block. Rows of a hot label, or many copies of one vector, are spread over the slices like any
others; what leaves a task per anchor is at most ``k`` rows per slot.

Scores are exact integer inner products of floor(scale * x); one beyond a long is an error.

Cases: rows with a null label or vector, or a null or non-finite component, take no part; shorter
vectors count as padded with zeros; higher scores come first, ties go to the smaller vec_id (null
last), then to the earlier row; a vec_id that repeats is a row each, as anchor, positive or negative,
and only the anchor's own row is no positive of it; an anchor without positives, and a positive whose
window is empty, give no rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigate.llm.exact import products, whole
from lexigate.scratch import new_path

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # a negative's score in hundredths of the positive's
SLICE, LEAST_SLICE = 1 << 16, 1 << 11  # rows that a task compares at once
CELLS = 1 << 21  # scores that a task computes at once

FOUND = "anchor_key bigint, slot int, score bigint, vec_id bigint, row_key bigint"


def usable(embeddings: DataFrame) -> DataFrame:
    finite = (
        "label is not null and embedding is not null and forall(embedding,"
        " x -> x is not null and not isnan(x) and abs(cast(x as double)) < double('infinity'))"
    )
    return embeddings.filter(finite).select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding"
    )


def _packed(rows: DataFrame, dim: int, scale: float) -> DataFrame:
    """The rows with their scaled vectors as packed doubles of one length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("embedding")
            length = held.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            full = np.zeros((len(length), dim))
            row = np.repeat(np.arange(len(length)), length)
            first = np.repeat(np.cumsum(length) - length, length)
            full[row, np.arange(len(row)) - first] = whole(
                held.flatten().to_numpy(zero_copy_only=False), scale
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in ("row_key", "vec_id", "label")),
                    pa.array([v.tobytes() for v in full], pa.binary()),
                ],
                names=["row_key", "vec_id", "label", "packed"],
            )

    return rows.mapInArrow(pack, "row_key bigint, vec_id bigint, label bigint, packed binary")


class Slice:
    """The rows that a task compares with every anchor."""

    def __init__(self, batches: list[pa.RecordBatch], dim: int):
        table = pa.Table.from_batches(batches)
        self.keys = table["row_key"].to_numpy()
        self.labels = table["label"].to_numpy()
        self.missing = table["vec_id"].is_null().to_numpy()
        self.ids = table["vec_id"].fill_null(0).to_numpy()
        self.vectors = matrix(table["packed"], dim)

    def best(self, places: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``k`` of the places: higher scores, then smaller ids, then earlier rows."""
        if len(scores) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            places, scores = places[scores >= least], scores[scores >= least]
        order = np.lexsort(
            (self.keys[places], self.ids[places], self.missing[places], ~scores)
        )[:k]
        return places[order], scores[order]


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist())).reshape(-1, dim)


def _meet(rows: DataFrame, anchors: DataFrame, slices: int, dim: int, pick) -> DataFrame:
    """Every anchor against every slice; ``pick(slice, anchor, scores)`` yields (slot, places, scores).

    A partition is sorted by slice, each slice's rows before the anchors that meet it.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rest, held = None, [], None

        def compare(some: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            queries = matrix(some.column("packed"), dim)
            asked = some.select(["row_key", "label", "limits", "least"]).to_pylist()
            step = max(1, CELLS // len(held.keys))
            for lo in range(0, len(asked), step):
                found: list[tuple] = []
                for anchor, scores in zip(
                    asked[lo : lo + step], products(queries[lo : lo + step], held.vectors), strict=True
                ):
                    found += [(anchor["row_key"], *part) for part in pick(held, anchor, scores)]
                counts = [len(places) for _, _, places, _ in found]
                places = np.concatenate([f[2] for f in found]) if found else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.array([f[0] for f in found], np.int64), counts)),
                        pa.array(np.repeat(np.array([f[1] for f in found], np.int32), counts)),
                        pa.array(np.concatenate([f[3] for f in found]) if found else places),
                        pa.array(held.ids[places], mask=held.missing[places]),
                        pa.array(held.keys[places]),
                    ],
                    names=["anchor_key", "slot", "score", "vec_id", "row_key"],
                )

        for batch in batches:
            slice_of, is_anchor = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("slice", "asks"))
            state = slice_of.astype(np.int64) * 2 + is_anchor
            cuts = np.flatnonzero(np.diff(state, prepend=-1)).tolist()
            for lo, hi in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                if slice_of[lo] != number:
                    number, rest, held = slice_of[lo], [], None
                if not is_anchor[lo]:
                    rest.append(batch.slice(lo, hi - lo))
                    continue
                if held is None and rest:
                    held, rest = Slice(rest, dim), []
                if held is not None:
                    yield from compare(batch.slice(lo, hi - lo))

    own = F.pmod(F.xxhash64("row_key"), F.lit(slices)).cast("int")
    none = F.lit(None).cast("array<bigint>")
    every = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    columns = ("row_key", "vec_id", "label", "packed")
    both = rows.select(
        own.alias("slice"),
        F.lit(False).alias("asks"),
        *columns,
        none.alias("limits"),
        F.lit(None).cast("long").alias("least"),
    ).unionByName(
        anchors.select(every.alias("slice"), F.lit(True).alias("asks"), *columns, "limits", "least")
    )
    return both.repartition(slices, "slice").sortWithinPartitions("slice", "asks").mapInArrow(scan, FOUND)


def _first(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The first ``k`` rows of every key, with their ``rank``; tasks keep ``k`` before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), "row_key"
    )
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def merged_slots(slots: list[list[tuple]], k: int) -> list[list[tuple]]:
    """Per slot, in descending order of limits, the first ``k`` of it and all slots below.

    Entries are sorted, and whatever stands in a slot comes before all of the slots below it.
    """
    answers: list[list[tuple]] = [[] for _ in slots]
    below: list[tuple] = []
    for number in range(len(slots) - 1, -1, -1):
        below = (slots[number] + below)[:k]
        answers[number] = below
    return answers


def limits_of(scores: list[int], low: int = LOW, high: int = HIGH) -> list[tuple[int, int]]:
    """(least, most) score of a negative per positive: low * p <= 100 * n <= high * p."""
    return [(-(-low * p // 100), high * p // 100) for p in scores]


def mine(
    embeddings: DataFrame,
    is_anchor: str | Column = "vec_id % 100 = 0",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: float = SCALE,
    slice_rows: int = SLICE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` and their rows.

    ``row_key`` columns name the rows of anchor, positive and negative where ids repeat.
    """
    spark = embeddings.sparkSession

    def written(frame: DataFrame, name: str) -> DataFrame:
        path = new_path(spark, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    marked = usable(embeddings).withColumn("row_key", F.monotonically_increasing_id())
    dim = max(1, marked.agg(F.max(F.size("embedding"))).first()[0] or 0)
    rows = written(_packed(marked, dim, scale), "vectors")
    number, tasks = rows.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = max(1, math.ceil(number / slice_rows), min(tasks, math.ceil(number / LEAST_SLICE)))
    anchors = rows.filter(is_anchor).filter("vec_id is not null")
    none = F.lit(None)

    def alike(held: Slice, anchor: dict, scores: np.ndarray) -> Iterator[tuple]:
        places = np.flatnonzero((held.labels == anchor["label"]) & (held.keys != anchor["row_key"]))
        yield 0, *held.best(places, scores[places], positives)

    asked = anchors.withColumns({"limits": none.cast("array<bigint>"), "least": none.cast("long")})
    near = written(
        _first(_meet(rows, asked, slices, dim, alike), positives, "anchor_key"), "positives"
    )

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [limits_of(s, low, high) for s in batch.column("scores").to_pylist()]
            found = [[w for w in windows if w[0] <= w[1]] for windows in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_key"),
                    pa.array(
                        [sorted({b for _, b in windows}, reverse=True) for windows in found],
                        pa.list_(pa.int64()),
                    ),
                    pa.array([min((a for a, _ in w), default=None) for w in found], pa.int64()),
                ],
                names=["row_key", "limits", "least"],
            )

    limits = (
        near.groupBy(F.col("anchor_key").alias("row_key"))
        .agg(F.collect_list("score").alias("scores"))
        .mapInArrow(bounds, "row_key bigint, limits array<bigint>, least bigint")
        .filter("least is not null")
    )

    def by_slot(held: Slice, anchor: dict, scores: np.ndarray) -> Iterator[tuple]:
        upper = np.array(anchor["limits"], dtype=np.int64)
        able = (scores <= upper[0]) & (scores >= anchor["least"])
        places = np.flatnonzero(able & (held.labels != anchor["label"]))
        scores = scores[places]
        slot = len(upper) - np.searchsorted(upper[::-1], scores, side="left") - 1
        for number in range(len(upper)):
            own = slot == number
            if own.any():
                yield number, *held.best(places[own], scores[own], negatives)

    others = _meet(rows, anchors.join(limits, "row_key"), slices, dim, by_slot)
    kept = _first(others, negatives, "anchor_key", "slot").groupBy("anchor_key").agg(
        F.collect_list(F.struct("slot", "rank", "score", "vec_id", "row_key")).alias("slots")
    )
    wanted = near.groupBy("anchor_key").agg(
        F.collect_list(F.struct("rank", "score", "vec_id", "row_key")).alias("positives")
    )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for anchor in batch.to_pylist():
                windows = limits_of([p["score"] for p in anchor["positives"]], low, high)
                upper = sorted({b for a, b in windows if a <= b}, reverse=True)
                slots: list[list[dict]] = [[] for _ in upper]
                for entry in sorted(anchor["slots"], key=lambda e: (e["slot"], e["rank"])):
                    slots[entry["slot"]].append(entry)
                merged = dict(zip(upper, merged_slots(slots, negatives), strict=True))
                for p, (least, most) in zip(anchor["positives"], windows, strict=True):
                    inside = [n for n in merged.get(most, []) if n["score"] >= least]
                    rows += [
                        (
                            anchor["anchor_key"], anchor["anchor_id"], p["row_key"], p["vec_id"], rank,
                            n["row_key"], n["vec_id"], p["score"], n["score"],
                        )
                        for rank, n in enumerate(inside, 1)
                    ]
            columns = zip(*rows, strict=True) if rows else [[]] * len(_MINED)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _MINED, strict=True)], schema=_MINED
            )

    named = anchors.select(F.col("row_key").alias("anchor_key"), F.col("vec_id").alias("anchor_id"))
    return (
        wanted.join(kept, "anchor_key").join(named, "anchor_key").mapInArrow(answer, MINED)
    )


MINED = (
    "anchor_key bigint, anchor_id bigint, positive_key bigint, positive_id bigint, rank int,"
    " negative_key bigint, negative_id bigint, positive_score bigint, negative_score bigint"
)
_MINED = pa.schema(
    [
        (name, pa.int32() if kind == "int" else pa.int64())
        for name, kind in (part.split() for part in MINED.split(", "))
    ]
)
