"""Quality classifier: hashed word n-gram logistic regression, trained with FTRL-proximal updates.

Features of a text are its distinct word 1- and 2-grams and the 1- to 3-grams of its word shapes
(runs of capitals, small letters, digits and other bytes), each hashed to one of ``BUCKETS``
places, weighted by the log of their count and scaled to unit length. A score is the sparse dot
product of these with the weights, through a sigmoid. Labels, language, source and ids are never
features.

Training reads a sample of labelled documents, drawn by a hash of their ids, as sparse rows: at most
``MAX_ROWS`` of them, and ``MAX_BYTES`` of text at the tables' mean length, both in expectation. One
task runs the sequential updates over it and returns the non-zero weights, of which there are at most
``BUCKETS``. Scoring covers every document, in the tasks that read them.

Cases: null and empty texts score by the bias alone; a text of any length is scored whole, as a block
of its own; unlabelled documents and labels that are null
do not train; a document labelled more than once has the majority's label (ties: 1); a doc_id that
repeats trains once per row; without any training row every score is 0.5; an empty table gives no
rows; other columns are left as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigate.llm.words import NOT_SPACE, Words, blocks, hashed_words, mixed, shingles

BITS = 18
BUCKETS = 1 << BITS
MAX_ROWS, MAX_BYTES = 16_384, 128 << 20  # of the training sample
EPOCHS = 8  # passes over the sample, more if they make fewer than LEAST_UPDATES
LEAST_UPDATES = 16_384
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.2, 0.5  # of the updates
SEED = 7
FOLDS, HELD = 5, 0

# classes of bytes whose runs make up a word's shape
_SHAPES = np.full(256, 5, dtype=np.uint8)
_SHAPES[0x41:0x5B] = 1
_SHAPES[0x61:0x7B] = 2
_SHAPES[0x30:0x3A] = 3
_SHAPES[0x80:] = 2
for _byte in b".,;:!?":
    _SHAPES[_byte] = 4


def shape_words(data: np.ndarray, words: Words) -> Words:
    """The same words, with hashes of their shapes and of whether they repeat the one before."""
    kind = _SHAPES[data]
    length = words.end - words.start
    at = np.arange(int(length.sum())) + np.repeat(
        words.start - (np.cumsum(length) - length), length
    )
    first = np.cumsum(length) - length
    kinds = kind[at].astype(np.uint64)
    opens = np.ones(len(at), dtype=bool)
    opens[1:] = kinds[1:] != kinds[:-1]
    opens[first] = True
    # position among the word's runs, up to eight
    run = np.cumsum(opens)
    run = np.minimum(run - np.repeat(run[first], length), 7).astype(np.uint64)
    code = np.add.reduceat(np.where(opens, kinds << (run * np.uint64(4)), 0), first)
    again = np.zeros(len(first), dtype=np.uint64)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    return words._replace(hash=mixed(code << np.uint64(1) | again))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, weight), sorted, each pair once; the weights of a row have unit length."""
    words = hashed_words(data, offsets, NOT_SPACE)
    rows, found = [], []
    grams = [(words, 1), (words, 2)]
    if len(words.hash):
        shapes = shape_words(data, words)
        grams += [(shapes, 1), (shapes, 2), (shapes, 3)]
    for salt, (source, size) in enumerate(grams):
        first, hashes = shingles(source, size)
        rows.append(source.doc[first])
        found.append(mixed(hashes + np.uint64(salt)) >> np.uint64(64 - BITS))
    keys = np.concatenate(rows).astype(np.int64) << BITS | np.concatenate(found).astype(np.int64)
    keys, count = np.unique(keys, return_counts=True)
    row, bucket = keys >> BITS, keys & (BUCKETS - 1)
    weight = 1 + np.log(count)
    total = np.bincount(row, weights=weight * weight, minlength=len(offsets) - 1)
    return row, bucket, weight / np.sqrt(total[row])


class Model:
    """Weights by bucket, and the bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, bucket, weight = features(data, offsets)
        dot = np.bincount(row, weights=weight * self.weights[bucket], minlength=len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(dot + self.bias, -60, 60)))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = SEED) -> tuple[np.ndarray, float]:
    """Per-coordinate follow-the-regularised-leader over (bucket, weight, label) rows."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    bias = np.array([BUCKETS])
    one = np.ones(1)

    def weights(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * L1 - z[at]
        value = shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        free = at == BUCKETS  # the bias is not regularised
        value[free] = -z[at][free] * ALPHA / (BETA + np.sqrt(n[at][free]))
        return np.where((np.abs(z[at]) <= L1) & ~free, 0.0, value)

    rng = np.random.default_rng(seed)
    for _ in range(max(EPOCHS, math.ceil(LEAST_UPDATES / max(1, len(rows))))):
        for i in rng.permutation(len(rows)).tolist():
            at, x, label = rows[i]
            at, x = np.concatenate([at, bias]), np.concatenate([x, one])
            w = weights(at)
            gradient = (1 / (1 + np.exp(-np.clip(w @ x, -60, 60))) - label) * x
            squared = gradient * gradient
            z[at] += gradient - (np.sqrt(n[at] + squared) - np.sqrt(n[at])) / ALPHA * w
            n[at] += squared
    final = weights(np.arange(BUCKETS + 1))
    return final[:BUCKETS], final[BUCKETS]


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def train(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> Model:
    """Fit on the labelled documents that are not held out."""
    known = (
        labels.filter("quality is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
        .filter(fold(F.col("doc_id")) != HELD)
    )
    total = known.count()
    mean = docs.agg(F.avg(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0.0
    part = min(1.0, max_rows / max(total, 1), max_bytes / max(total * mean, 1.0))
    draw = F.xxhash64(F.lit(SEED), "doc_id")
    share = F.pmod(draw, F.lit(1 << 20)) < int(part * (1 << 20))
    # a side of about max_rows short rows, whatever the number of labels
    sample = F.broadcast(known.filter(share).orderBy(draw, "doc_id").limit(2 * max_rows))
    chosen = docs.select("doc_id", "text").join(sample, "doc_id")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, ids = batch.column("label"), batch.column("doc_id")
            for row, data, offsets in blocks(batch.column("text")):
                rows = len(offsets) - 1
                owner, bucket, weight = features(data, offsets)
                cuts = np.searchsorted(owner, np.arange(1, rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(row, rows),
                        labels.slice(row, rows),
                        pa.array([b.astype(np.int32) for b in np.split(bucket, cuts)]),
                        pa.array([w.astype(np.float32) for w in np.split(weight, cuts)]),
                    ],
                    names=["doc_id", "label", "bucket", "weight"],
                )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for i, label in enumerate(batch.column("label").to_pylist()):
                bucket = batch.column("bucket")[i].values.to_numpy()
                weight = batch.column("weight")[i].values.to_numpy()
                rows.append((bucket, weight.astype(np.float64), label))
        if not rows:
            return
        weights, bias = ftrl(rows)
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*at.tolist(), BUCKETS]), pa.array([*weights[at].tolist(), bias])],
            names=["bucket", "weight"],
        )

    fitted = (
        chosen.mapInArrow(
            sparse, "doc_id bigint, label int, bucket array<int>, weight array<float>"
        )
        .repartition(1)
        .sortWithinPartitions("doc_id", F.xxhash64("bucket"))
        .mapInArrow(fit, "bucket bigint, weight double")
        .toPandas()
    )
    weights = np.zeros(BUCKETS + 1)
    weights[fitted["bucket"].to_numpy(dtype=np.int64)] = fitted["weight"].to_numpy()
    return Model(weights[:BUCKETS], weights[BUCKETS])


def quality_score(text: Column, model: Model) -> Column:
    """Probability that a text is good, from 0 to 1."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        found = [model.score(data, offsets) for _, data, offsets in blocks(texts)]
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    return score(text)
