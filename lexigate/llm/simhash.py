"""Near duplicates by SimHash, linked by meet-in-the-middle ball hashing.

A fingerprint emits every variant within half the radius; two fingerprints within the radius share
one. The shuffle deals variants by their leading bits: a fingerprint goes once to each value that
these bits take in its variants, and the task that owns the value forms the variants there. That
moves a few dozen packed words per fingerprint in place of some two thousand rows. Fingerprints that
collide on a variant are verified and joined into classes inside the task, which returns at most
one link per fingerprint, so a group of copies never becomes all its pairs.

A value that owns more than ``heavy`` fingerprints (many near copies of one text) is cut into
slices. Every slice sends its distinct variants, with one fingerprint each, to tasks dealt by the
variant, where slices meet.

Cases: null and empty texts have fingerprint zero and are linked like others; equal fingerprints
are one class; a repeated row gives a row each; a null doc_id has a fingerprint and is linked, but
names a class only if the class has no other id; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lexigate.llm.words import LOWER, NOT_SPACE, blocks, find_words
from lexigate.scratch import new_path

SEED = 42
SHINGLE = 4
RADIUS = 4
OWNED = 8192  # fingerprints that a value of the leading bits owns on average, at most
HEAVY = 65536
AT_ONCE = 1 << 20  # variants formed at once
_CHUNK = 1 << 14
_HASHES = 1 << 16
_SALT = np.uint64(0x9E3779B97F4A7C15)


# --- fingerprints -----------------------------------------------------------------------------


def block_fingerprints(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    folded = LOWER[data]
    doc, start, end = find_words(folded, offsets, NOT_SPACE)
    rows, length = len(offsets) - 1, end - start
    number = np.arange(len(start))
    # words of all rows with one space between
    spaced = np.full(int(length.sum()) + len(start), 0x20, dtype=np.uint8)
    spaced[np.arange(int(length.sum())) + np.repeat(number, length)] = folded[NOT_SPACE[folded]]
    end = np.cumsum(length) + number
    start = end - length
    first_word = np.searchsorted(doc, np.arange(rows + 1))
    count = np.diff(first_word)
    # every run of `size` words in a row; all words of a shorter row
    last = np.minimum(number + size, first_word[doc + 1]) - 1
    opens = number[(number + size <= first_word[doc + 1]) | (number == first_word[doc])]
    last, owner = last[opens], doc[opens]
    ones = np.zeros((rows, 64), dtype=np.int64)
    view, digest = memoryview(spaced), xxhash.xxh64_intdigest
    for lo in range(0, len(opens), _HASHES):
        part = slice(lo, lo + _HASHES)
        hashes = np.array(
            [
                digest(view[a:b], SEED)
                for a, b in zip(start[opens[part]].tolist(), end[last[part]].tolist(), strict=True)
            ],
            dtype=np.uint64,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cuts = np.flatnonzero(np.diff(owner[part], prepend=-1))
        ones[owner[part][cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    shingles = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    majority = (2 * ones > shingles[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1, bitorder="little").view(np.int64).ravel()


@F.arrow_udf(LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    found = [block_fingerprints(data, offsets) for _, data, offsets in blocks(texts)]
    return pa.array(np.concatenate(found) if found else np.zeros(0, dtype=np.int64))


def fingerprint(text: Column) -> Column:
    """64 majority bits over the XXH64 of a text's word shingles, as a long."""
    return _fingerprints(text)


# --- collisions -------------------------------------------------------------------------------


def masks(bits: int, flips: int) -> np.ndarray:
    """All masks of at most ``flips`` ones among the low ``bits``."""
    single = np.uint64(1) << np.arange(bits, dtype=np.uint64)
    found = [np.zeros(1, dtype=np.uint64)]
    for _ in range(flips):
        found.append(np.unique((found[-1][:, None] ^ single[None, :]).ravel()))
    return np.unique(np.concatenate(found))


class Classes:
    """Union by smallest member, over positions."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def roots(self, members: np.ndarray) -> np.ndarray:
        found = self.parent[members]
        while True:
            above = self.parent[found]
            if np.array_equal(above, found):
                self.parent[members] = found
                return found
            found = above

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def collisions(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first owner, other owner) for owners of equal keys."""
    order = np.argsort(keys, kind="stable")
    keys, owners = keys[order], owners[order]
    same = np.flatnonzero(keys[1:] == keys[:-1]) + 1
    opens = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0)
    first = owners[opens[np.searchsorted(opens, same, side="right") - 1]]
    pairs = np.unique(first.astype(np.int64) << 32 | owners[same].astype(np.int64))
    return pairs >> 32, pairs & 0xFFFFFFFF


def variants(
    prints: np.ndarray, spare: np.ndarray, fixed: int, bit: int, fewest: int = 2
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(variants, positions in ``prints``) in parts of about ``AT_ONCE``.

    Parts to which fewer than ``fewest`` fingerprints belong are left out.

    Variants equal ``fixed`` on the bits from ``bit`` up; ``spare`` flips are left for the rest.
    """

    def within(who: np.ndarray, spare: np.ndarray, fixed: int, bit: int) -> Iterator:
        if len(who) < fewest:
            return
        total = sum(math.comb(bit, k) * int((spare >= k).sum()) for k in range(RADIUS // 2 + 1))
        if total > AT_ONCE and bit > 0:
            ones = (prints[who] >> np.uint64(bit - 1)) & np.uint64(1)
            for value in (0, 1):
                left = spare - (ones != value)
                stay = left >= 0
                yield from within(who[stay], left[stay], fixed | value << (bit - 1), bit - 1)
            return
        low = np.uint64((1 << bit) - 1)
        keys, owners = [], []
        for flips in range(RADIUS // 2 + 1):
            some = who[spare == flips]
            base = (prints[some] & low) | np.uint64(fixed)
            ball = masks(bit, flips)
            keys.append((base[:, None] ^ ball[None, :]).ravel())
            owners.append(np.repeat(some, len(ball)))
        yield np.concatenate(keys), np.concatenate(owners)

    yield from within(np.arange(len(prints)), spare, fixed, bit)


def owned(prints: np.ndarray, value: int, leading: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """The fingerprints of a value of the leading bits, with the flips that they have left."""
    prints = np.unique(prints)
    used = np.bitwise_count((prints >> np.uint64(64 - leading)) ^ np.uint64(value))
    return prints, (RADIUS // 2 - used).astype(np.int64), value << (64 - leading), 64 - leading


def link_verified(classes: Classes, prints: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    near = np.bitwise_count(prints[a] ^ prints[b]) <= RADIUS
    classes.link(a[near], b[near])


def class_links(classes: Classes, prints: np.ndarray) -> pa.RecordBatch:
    members = np.arange(len(prints))
    roots = classes.roots(members.copy())
    linked = roots != members
    return pa.RecordBatch.from_arrays(
        [
            pa.array(prints[linked].view(np.int64)),
            pa.array(prints[roots[linked]].view(np.int64)),
        ],
        names=["a", "b"],
    )


def unpacked(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64)


def links(prints: DataFrame, owned_at_most: int = OWNED, heavy: int = HEAVY) -> DataFrame:
    """Links ``a, b`` that join the column ``fingerprint`` (distinct longs) into its classes."""
    spark = prints.sparkSession
    number = prints.count()
    leading = next(
        p
        for p in range(1, 33)
        if p == 32 or number * (1 + p + p * (p - 1) / 2) <= owned_at_most * 2.0**p
    )
    shift, flips = np.uint64(64 - leading), masks(leading, RADIUS // 2)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy().view(np.uint64)
            for lo in range(0, len(every), _CHUNK):
                some = every[lo : lo + _CHUNK]
                value = ((some >> shift)[:, None] ^ flips[None, :]).ravel().astype(np.int64)
                order = np.argsort(value, kind="stable")
                value, some = value[order], np.repeat(some, len(flips))[order]
                cuts = np.flatnonzero(np.diff(value, prepend=-1))
                packed = [part.tobytes() for part in np.split(some, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(value[cuts]),
                        pa.array(packed, pa.binary()),
                        pa.array([len(part) // 8 for part in packed], pa.int64()),
                    ],
                    names=["value", "prints", "n"],
                )

    def meet(table: pa.Table) -> pa.Table:
        value = table.column("value")[0].as_py()
        some, spare, fixed, bit = owned(unpacked(table.column("prints")), value, leading)
        classes = Classes(len(some))
        for keys, owners in variants(some, spare, fixed, bit):
            link_verified(classes, some, *collisions(keys, owners))
        return pa.Table.from_batches([class_links(classes, some)])

    path = new_path(spark, "simhash-dealt")
    prints.select("fingerprint").mapInArrow(
        deal, "value bigint, prints binary, n bigint"
    ).write.parquet(path)
    dealt = spark.read.parquet(path)
    sizes = dealt.groupBy("value").agg(F.sum("n").alias("owned"))
    crowded = sizes.filter(F.col("owned") > heavy).select("value")
    found = (
        dealt.join(crowded, "value", "left_anti")
        .groupBy("value")
        .applyInArrow(meet, "a bigint, b bigint")
    )
    if crowded.isEmpty():
        return found
    return found.unionByName(_crowded_links(dealt.join(crowded, "value", "left_semi"), leading))


def _crowded_links(dealt: DataFrame, leading: int) -> DataFrame:
    spark = dealt.sparkSession
    pieces = max(1, math.ceil(dealt.agg(F.sum("n")).first()[0] * 1500 / (4 * AT_ONCE)))

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, packed in zip(
                batch.column("value").to_pylist(), batch.column("prints").to_pylist(), strict=True
            ):
                some, spare, fixed, bit = owned(np.frombuffer(packed, np.uint64), value, leading)
                # one that is alone in its slice may have neighbours in another
                for keys, owners in variants(some, spare, fixed, bit, fewest=1):
                    a, b = collisions(keys, owners)
                    keys, at = np.unique(keys, return_index=True)
                    piece = ((keys * _SALT) >> np.uint64(33)).astype(np.int64) % pieces
                    order = np.argsort(piece, kind="stable")
                    piece, keys, held = piece[order], keys[order], some[owners[at]][order]
                    cuts = np.flatnonzero(np.diff(piece, prepend=-1))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([-1, *piece[cuts].tolist()], pa.int64()),
                            pa.array([some[a].tobytes(), *map(np.ndarray.tobytes, np.split(keys, cuts[1:]))]),
                            pa.array([some[b].tobytes(), *map(np.ndarray.tobytes, np.split(held, cuts[1:]))]),
                        ],
                        names=["piece", "left", "right"],
                    )

    def meet(table: pa.Table) -> pa.Table:
        keys, prints = unpacked(table.column("left")), unpacked(table.column("right"))
        some, owners = np.unique(prints, return_inverse=True)
        classes = Classes(len(some))
        link_verified(classes, some, *collisions(keys, owners))
        return pa.Table.from_batches([class_links(classes, some)])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = unpacked(batch.column("left")), unpacked(batch.column("right"))
            some = np.unique(np.concatenate([left, right]))
            classes = Classes(len(some))
            link_verified(classes, some, np.searchsorted(some, left), np.searchsorted(some, right))
            yield class_links(classes, some)

    path = new_path(spark, "simhash-crowded")
    dealt.mapInArrow(slices, "piece bigint, left binary, right binary").write.parquet(path)
    sliced = spark.read.parquet(path)
    return (
        sliced.filter("piece >= 0")
        .groupBy("piece")
        .applyInArrow(meet, "a bigint, b bigint")
        .unionByName(
            sliced.filter("piece = -1").mapInArrow(unpack, "a bigint, b bigint")
        )
    )


# --- classes ----------------------------------------------------------------------------------


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """``a, b``: every linked node except a class's smallest, with that smallest.

    Alternating large-star and small-star steps; each round is written to the shared folder.
    """
    spark = edges.sparkSession

    def written(frame: DataFrame) -> tuple[DataFrame, tuple]:
        path = new_path(spark, "links")
        frame.write.parquet(path)
        frame = spark.read.parquet(path)
        mark = frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return frame, tuple(mark)

    high, low = F.greatest("a", "b"), F.least("a", "b")
    current, mark = written(
        edges.filter("a <> b").select(high.alias("a"), low.alias("b")).distinct()
    )
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.filter("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .filter("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        before = mark
        current, mark = written(small)
        if mark == before:
            return current


def classes(docs: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows (``row_key, doc_id, fingerprint``, and ``keep`` in a struct ``row``) and their classes.

    The classes table tells, per distinct fingerprint, its class's ``component_id`` and the
    ``row_key`` of the class's first row: smallest doc_id (null last), then place.
    """
    spark = docs.sparkSession

    def written(frame: DataFrame, name: str) -> DataFrame:
        path = new_path(spark, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    kept = [F.struct(*[F.col(f"`{name}`") for name in keep]).alias("row")] if keep else []
    marked = written(
        docs.select("doc_id", fingerprint(F.col("text")).alias("fingerprint"), *kept).withColumn(
            "row_key", F.monotonically_increasing_id()
        ),
        "simhash",
    )
    first = F.struct(F.isnull("doc_id").alias("last"), "doc_id", "row_key")
    prints = written(
        marked.groupBy("fingerprint").agg(F.min(first).alias("first")), "simhash-distinct"
    )
    roots = smallest_reachable(links(prints))
    rooted = prints.join(
        roots.withColumnsRenamed({"a": "fingerprint", "b": "root"}), "fingerprint", "left"
    ).withColumn("root", F.coalesce("root", "fingerprint"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return marked, rooted.select("fingerprint", "root").join(firsts, "root").select(
        "fingerprint",
        F.col("first.doc_id").alias("component_id"),
        F.col("first.row_key").alias("first_row"),
    )


def components(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` (long) and ``component_id``, the smallest id reachable by links."""
    marked, by_print = classes(docs)
    return marked.join(by_print, "fingerprint").select("doc_id", "fingerprint", "component_id")


def representatives(docs: DataFrame) -> DataFrame:
    """The first row of every class, with all columns of ``docs``."""
    marked, by_print = classes(docs, docs.columns)
    chosen = by_print.select(F.col("first_row").alias("row_key")).distinct()
    return marked.join(chosen, "row_key", "left_semi").select("row.*")
