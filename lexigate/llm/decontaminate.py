"""Benchmark passages in documents, by a prefix-filtered set join.

Every item is cut into windows of ``WINDOW`` consecutive words (a shorter item is one window), and a
window into shingles of ``SHINGLE`` words. A window counts only where all its m shingles occur, so
by the prefix principle m - m + 1 = 1 shingle, its rarest in the documents, is enough to find every
place. Documents and windows are joined on that shingle; the offset of the shingle in the window
gives the one place where the window can stand; places that would leave the document are dropped by
the length and positional bounds; the rest is verified word by word.

Documents are read once. A filter of ``FILTER_BITS`` bits, whatever the size of the benchmark,
tells which document positions may hold a benchmark shingle; those go on with the words around
them. Their exact counts order the shingles by rarity. A fuller filter lets more positions through
and changes no result.

Cases: a null or empty text has no words; items without words are left out; the windows of an item
with a null id hit like any other's, but the item has no id to be listed or counted by; equal
windows of several items are joined once; an item_id or doc_id that repeats counts per item once
and per document row; a document whose hits overlap counts each word once; a text of any length is
read whole, as a block of its own; empty tables give no hits. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexigate.llm.words import ALNUM, LOWER, blocks, hashed_words, shingles
from lexigate.scratch import new_path

WINDOW = 10
SHINGLE = 5
FILTER_BITS = 1 << 24  # 2 MB sent to every task

WINDOWS = "item_id bigint, window string, n int, size int, shingles array<bigint>"
HITS = (
    "doc_id bigint, text_key bigint, n_words bigint,"
    " runs array<struct<run: int, first: int, words: array<string>>>,"
    " hits array<struct<run: int, at: int, shingle: bigint>>"
)


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """A row per item and window: its words joined by spaces, and its shingles in order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            rows: list[dict] = []
            for row, data, offsets in blocks(batch.column("text")):
                words = hashed_words(data, offsets, ALNUM, lower=True)
                edges = np.searchsorted(words.doc, np.arange(len(offsets)))
                raw = LOWER[data].tobytes()
                for i in range(len(offsets) - 1):
                    lo, hi = int(edges[i]), int(edges[i + 1])
                    length = min(window, hi - lo)
                    if not length:
                        continue
                    size = min(shingle, length)
                    own = type(words)(*(part[lo:hi] for part in words))
                    hashes = shingles(own, size)[1].view(np.int64)
                    texts = [
                        raw[a:b].decode("utf-8", "replace")
                        for a, b in zip(own.start.tolist(), own.end.tolist(), strict=True)
                    ]
                    for at in range(hi - lo - length + 1):
                        rows.append(
                            {
                                "item_id": ids[row + i],
                                "window": " ".join(texts[at : at + length]),
                                "n": length,
                                "size": size,
                                "shingles": hashes[at : at + length - size + 1].tolist(),
                            }
                        )
            yield pa.RecordBatch.from_pylist(rows, schema=_WINDOW_SCHEMA)

    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(cut, WINDOWS)


_WINDOW_SCHEMA = pa.schema(
    [
        ("item_id", pa.int64()),
        ("window", pa.string()),
        ("n", pa.int32()),
        ("size", pa.int32()),
        ("shingles", pa.list_(pa.int64())),
    ]
)
_RUN = pa.struct([("run", pa.int32()), ("first", pa.int32()), ("words", pa.list_(pa.string()))])
_HIT = pa.struct([("run", pa.int32()), ("at", pa.int32()), ("shingle", pa.int64())])


def shingle_filter(windows: DataFrame) -> np.ndarray:
    """Bits at two places of every shingle; at most ``FILTER_BITS / 64`` rows reach the driver."""
    last = FILTER_BITS - 1
    bits = windows.select(F.explode("shingles").alias("h")).select(
        F.explode(
            F.array(F.col("h").bitwiseAND(last), F.shiftrightunsigned("h", 32).bitwiseAND(last))
        ).alias("bit")
    )
    held = (
        bits.groupBy(F.shiftright("bit", 6).alias("place"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
        .collect()
    )
    found = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for place, value in held:
        found[place] = value
    return found.view(np.uint64)


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    last = np.uint64(FILTER_BITS - 1)

    def test(place: np.ndarray) -> np.ndarray:
        return (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1

    return test(hashes & last) & test((hashes >> np.uint64(32)) & last)


def document_hits(
    docs: DataFrame, bits: np.ndarray, sizes: list[int], window: int = WINDOW
) -> DataFrame:
    """A row per document: positions that pass the filter, and runs of the words around them."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in blocks(batch.column("text")):
                words = hashed_words(data, offsets, ALNUM, lower=True)
                rows = len(offsets) - 1
                edges = np.searchsorted(words.doc, np.arange(rows + 1))
                at, span, value = [], [], []
                for size in sizes:
                    first, hashes = shingles(words, size)
                    kept = _passes(bits, hashes)
                    at.append(first[kept])
                    value.append(hashes[kept])
                    span.append(np.full(int(kept.sum()), size))
                at, span, value = map(np.concatenate, (at, span, value))
                doc = words.doc[at]
                lo = np.maximum(edges[doc], at + span - window)
                hi = np.minimum(edges[doc + 1], at + window)
                order = np.lexsort((lo, doc))
                at, value, doc, lo, hi = (x[order] for x in (at, value, doc, lo, hi))
                runs: list[list] = [[] for _ in range(rows)]
                hits: list[list] = [[] for _ in range(rows)]
                raw = LOWER[data].tobytes()
                spans: list[list[int]] = []
                for d, a, b in zip(doc.tolist(), lo.tolist(), hi.tolist(), strict=True):
                    if spans and spans[-1][0] == d and a <= spans[-1][2]:
                        spans[-1][2] = max(spans[-1][2], b)
                    else:
                        spans.append([d, a, b])
                for number, (d, a, b) in enumerate(spans):
                    cut = zip(words.start[a:b].tolist(), words.end[a:b].tolist(), strict=True)
                    texts = [raw[s:e].decode("utf-8", "replace") for s, e in cut]
                    runs[d].append({"run": number, "first": a - int(edges[d]), "words": texts})
                starts = np.array([s[1] for s in spans], dtype=np.int64)
                run = np.searchsorted(starts, lo, side="right") - 1
                within = at - edges[doc]
                for d, r, p, h in zip(
                    doc.tolist(), run.tolist(), within.tolist(), value.view(np.int64).tolist(), strict=True
                ):
                    hits[d].append({"run": r, "at": p, "shingle": h})
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, rows).cast(pa.int64()),
                        batch.column("text_key").slice(row, rows),
                        pa.array(np.diff(edges), pa.int64()),
                        pa.array(runs, pa.list_(_RUN)),
                        pa.array(hits, pa.list_(_HIT)),
                    ],
                    names=["doc_id", "text_key", "n_words", "runs", "hits"],
                )

    key = F.xxhash64("text").alias("text_key")
    return docs.select("doc_id", key, "text").mapInArrow(find, HITS)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document row: ``doc_id, n_words, n_hit, n_items, item_ids`` (sorted strings).

    ``text_key`` is the hash of the text, on which alone the rest depends.
    """
    spark = docs.sparkSession
    path = new_path(spark, "benchmark-windows")
    item_windows(items, window).write.parquet(path)
    by_item = spark.read.parquet(path)
    windows = by_item.groupBy("window").agg(
        F.first("n").alias("n"), F.first("size").alias("size"), F.first("shingles").alias("shingles")
    )
    sizes = sorted(r[0] for r in by_item.select("size").distinct().collect()) or [SHINGLE]

    path = new_path(spark, "document-hits")
    document_hits(docs, shingle_filter(windows), sizes, window).withColumn(
        "row_key", F.monotonically_increasing_id()
    ).write.parquet(path)
    marked = spark.read.parquet(path)

    hits = marked.select("row_key", "n_words", F.inline("hits"))
    counts = hits.groupBy("shingle").agg(F.count("*").alias("df"))
    prefixes = (
        windows.select("window", "n", F.posexplode("shingles").alias("offset", "shingle"))
        .join(counts, "shingle", "left")
        .groupBy("window", "n")
        .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "shingle", "offset")).alias("p"))
        .filter("p.df > 0")  # a window lacks a shingle that no document has
        .select("window", "n", "p.shingle", "p.offset")
    )
    places = (
        hits.join(prefixes, "shingle")
        .withColumn("begin", F.col("at") - F.col("offset"))
        .filter("begin >= 0 and begin + n <= n_words")
    )
    runs = marked.select("row_key", F.inline("runs"))
    found = (
        places.join(runs, ["row_key", "run"])
        .filter("begin >= first and begin + n <= first + size(words)")
        .filter("array_join(slice(words, begin - first + 1, n), ' ') = window")
        .select("row_key", "window", "begin", (F.col("begin") + F.col("n")).alias("stop"))
    )
    path = new_path(spark, "benchmark-places")
    found.write.parquet(path)
    found = spark.read.parquet(path)

    before = (
        Window.partitionBy("row_key")
        .orderBy("begin", "stop")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reached = F.coalesce(F.max("stop").over(before), F.lit(0))
    covered = (
        found.select("row_key", "begin", "stop")
        .distinct()
        .withColumn("new", F.greatest(F.lit(0), F.col("stop") - F.greatest("begin", reached)))
        .groupBy("row_key")
        .agg(F.sum("new").cast("long").alias("n_hit"))
    )
    occurring = (
        found.select("row_key", "window")
        .distinct()
        .join(by_item.select("window", "item_id").distinct(), "window")
        .groupBy("row_key")
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    none = F.array().cast("array<string>")
    return (
        marked.select("row_key", "doc_id", "text_key", "n_words")
        .join(covered, "row_key", "left")
        .join(occurring, "row_key", "left")
        .select(
            "doc_id",
            "text_key",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.size(F.coalesce("item_ids", none)).cast("long").alias("n_items"),
            F.coalesce("item_ids", none).alias("item_ids"),
        )
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in whose text no item's window stands, with all their columns."""
    hit = contamination(docs, items).filter("n_hit > 0").select("text_key").distinct()
    return docs.join(hit, F.xxhash64(docs["text"]) == hit["text_key"], "left_anti")
