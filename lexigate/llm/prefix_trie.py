"""The prefix trie of conversations, with subtree totals by time-forward processing.

Turns are numbered, and prefixes are told by the XOR of their turns' hashes (128 bits, keyed by the
turn's place), so that a conversation's prefixes are running values: rows are sorted by ranges, every
range is scanned by itself, and what a range carries into the next, at most one conversation, is added
from a table with a row per range. No task holds a conversation, however long. Equal prefixes meet in
one map-side combined aggregation; its rows are the nodes. A node is named by its smallest member.

Totals then flow from children to parents:

1. A node is light if at most ``LIGHT`` turns stand at or below it, counted once per conversation. The
   subtrees of the topmost light nodes are dealt to shards. Each shard is sorted externally in reverse
   level order; a node takes its children's messages from a priority queue that spills, and sends its
   totals to its parent's place in it.
2. What the shards' roots send to the heavy nodes above them is summed. Heavy nodes, at most rows /
   ``LIGHT`` per level, form chains of one smallest member each. The chains pass their totals up the
   same way, in one task; there are about as many as heavy subtrees, however deep they are. Along each
   chain, totals are running sums again.

The members that end at a node are hashed in numeric order: ranges of them are joined into chunks of
``CHUNK`` bytes, and the chunks of a node go through one digest, streamed.

Cases: rows with a null conv_id take no part; a null turn comes first, turns of equal number follow by
role and then by the MD5 of their text, and a repeated row is a turn each; a null role or text is
empty; texts are hashed where they are read and move no further, whatever their length; an empty
table gives no rows, not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import os
import pickle
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigate.operators.scale import bounded_side
from lexigate.scratch import new_path

FAMILY, HEADS = 5, 9  # conversations that share a head, and what bounds its length
LIGHT = 100_000
QUEUED = 1 << 17  # messages held by a queue before it spills
CHUNK = 1 << 16
TOTALS = ("n_children", "n_leaves", "saved_tokens")


# --- running values ---------------------------------------------------------------------------


def _written(frame: DataFrame, name: str) -> DataFrame:
    path = new_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def scanned(
    frame: DataFrame, key: str, order: Sequence[Column], xors: Sequence[str] = (), sums: Sequence[str] = ()
) -> DataFrame:
    """Add ``place`` (from 1) within the key, and turn the named longs into running values.

    The result is written to the shared folder.
    """
    names = [*xors, *sums]
    operators = [np.bitwise_xor] * len(xors) + [np.add] * len(sums)
    sorted_rows = (
        frame.repartitionByRange(key, *order)
        .sortWithinPartitions(key, *order)
        .withColumn("part", F.spark_partition_id())
    )
    others = [n for n in sorted_rows.columns if n not in names]
    schema = ", ".join(
        [f"`{n}` {t}" for n, t in sorted_rows.select(*others).dtypes]
        + ["place bigint", *(f"{n} bigint" for n in names)]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, [0] * (1 + len(names))
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy()
            opens = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            length = np.diff([*opens, len(keys)])
            same = last is not None and last == keys[0]
            columns = []
            inputs = [np.ones(len(keys), np.int64), *(batch.column(n).to_numpy() for n in names)]
            for i, (values, operator) in enumerate(zip(inputs, [np.add, *operators], strict=True)):
                values = values.copy()
                if same:
                    values[0] = operator(values[0], carried[i])
                total = operator.accumulate(values)
                before = np.concatenate([[np.int64(0)], total[opens[1:] - 1]])
                undo = np.bitwise_xor if operator is np.bitwise_xor else np.subtract
                total = undo(total, np.repeat(before, length))
                carried[i] = total[-1]
                columns.append(pa.array(total))
            last = keys[-1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in others), *columns], names=[*others, "place", *names]
            )

    local = _written(sorted_rows.mapInArrow(scan, schema), "scanned")
    # only the first key of a range can go on from an earlier range
    firsts = local.groupBy("part").agg(F.min(key).alias(key)).select(key).distinct()
    if local.agg(F.count_distinct("part")).first()[0] <= 1:
        return local.drop("part")
    ends = (
        local.join(F.broadcast(firsts), key)  # a row per range at most
        .groupBy(key, "part")
        .agg(F.max_by(F.struct("place", *names), "place").alias("end"))
    )
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        key,
        "part",
        F.sum("end.place").over(earlier).alias("__place"),
        *(F.expr(f"bit_xor(end.{n})").over(earlier).alias(f"__{n}") for n in xors),
        *(F.sum(f"end.{n}").over(earlier).alias(f"__{n}") for n in sums),
    ).filter("__place is not null")
    joined = local.join(F.broadcast(carry), [key, "part"], "left")
    return joined.select(
        *[n for n in others if n != "part"],
        *((F.col(n) + F.coalesce(f"__{n}", F.lit(0))).alias(n) for n in ("place", *sums)),
        *(F.col(n).bitwiseXOR(F.coalesce(f"__{n}", F.lit(0))).alias(n) for n in xors),
    )


# --- rebuilt conversations --------------------------------------------------------------------


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations with their rebuilt length ``turns``, their rebuilt turns).

    A conversation starts with the first turns of its family's first one, as many as a checksum of
    its id says, and goes on with its own turns after as many.
    """
    text = F.coalesce("text", F.lit(""))
    own = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.md5(text.cast("binary")).alias("sign"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    placed = scanned(own, "conv_id", [F.asc_nulls_first("turn"), F.col("role"), F.col("sign")]).select(
        "conv_id",
        "place",
        F.xxhash64(F.lit(1), "role", "sign").alias("r1"),
        F.xxhash64(F.lit(2), "role", "sign").alias("r2"),
        "bytes",
    )
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    lengths = placed.groupBy("conv_id").agg(F.max("place").alias("n"))
    lengths = lengths.withColumns(
        {"head": head, "base": F.col("conv_id") - F.col("conv_id") % FAMILY}
    )
    bases = lengths.filter("conv_id = base").select("base", F.col("n").alias("base_n"))
    convs = _written(
        lengths.join(bases, "base", "left")
        .withColumn("taken", F.least("head", F.coalesce("base_n", F.lit(0))))
        .withColumn("turns", F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))),
        "conversations",
    )
    rest = ("r1", "r2", "bytes", "turns")
    heads = (
        placed.filter(F.col("place") < HEADS)
        .withColumnRenamed("conv_id", "base")
        .join(convs.select("conv_id", "base", "taken", "turns"), "base")
        .filter("place <= taken")
        .select("conv_id", "place", *rest)
    )
    tails = (
        placed.join(convs.select("conv_id", "head", "taken", "turns"), "conv_id")
        .filter("place > head")
        .select("conv_id", (F.col("place") - F.col("head") + F.col("taken")).alias("place"), *rest)
    )
    return convs.select("conv_id", "turns"), heads.unionByName(tails)


# --- time-forward processing ------------------------------------------------------------------


class Messages:
    """A priority queue of tuples that spills sorted runs to Spark's local folder when it is full."""

    def __init__(self, limit: int = QUEUED):
        self.limit, self.heap, self.runs = limit, [], []

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, (message, -1))
        if len(self.heap) > self.limit + len(self.runs):
            self._spill()

    def _spill(self) -> None:
        own = sorted(m for m, run in self.heap if run < 0)
        self.heap = [entry for entry in self.heap if entry[1] >= 0]
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        file = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
        for message in own:
            pickle.dump(message, file, pickle.HIGHEST_PROTOCOL)
        file.seek(0)
        self.runs.append(file)
        heapq.heapify(self.heap)
        self._refill(len(self.runs) - 1)

    def _refill(self, run: int) -> None:
        file = self.runs[run]
        if file is not None:
            try:
                heapq.heappush(self.heap, (pickle.load(file), run))
            except EOFError:
                file.close()
                self.runs[run] = None

    def pop_for(self, target: tuple) -> Iterator[tuple]:
        """All messages that start with the target."""
        while self.heap and self.heap[0][0][: len(target)] == target:
            message, run = heapq.heappop(self.heap)
            if run >= 0:
                self._refill(run)
            yield message


LIGHT_NODES = (
    "conv_id bigint, depth bigint, x1 bigint, x2 bigint, p1 bigint, p2 bigint, parent_conv_id bigint,"
    " n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
)
_LIGHT_NODES = pa.schema([(part.split()[0], pa.int64()) for part in LIGHT_NODES.split(", ")])


def _record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _light_totals(nodes: DataFrame, queued: int) -> DataFrame:
    """Totals of nodes whose partitions hold whole subtrees, in reverse level order.

    A child is returned when its parent takes its message and tells its name; the roots of the
    subtrees are returned without the parent's name.
    """

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = Messages(queued)
        for batch in batches:
            rows = []
            columns = (batch.column(n).to_pylist() for n in batch.schema.names)
            for conv, depth, x1, x2, p1, p2, convs, size, top in zip(*columns, strict=True):
                children = leaves = 0
                saved = (convs - 1) * size
                for message in queue.pop_for((-depth, x1, x2)):
                    child = message[3:]
                    children, leaves, saved = children + 1, leaves + child[-2], saved + child[-1]
                    rows.append((child[0], depth + 1, *child[1:3], x1, x2, conv, *child[3:]))
                done = (conv, x1, x2, convs, children, leaves or 1, saved)
                if top:
                    rows.append((conv, depth, x1, x2, p1, p2, None, *done[3:]))
                else:
                    queue.push((1 - depth, p1, p2, *done))
            yield _record_batch(rows, _LIGHT_NODES)

    columns = ("conv_id", "depth", "x1", "x2", "p1", "p2", "n_convs", "bytes", "top")
    return nodes.select(*columns).mapInArrow(up, LIGHT_NODES)


CHAINS = "conv_id bigint, to_conv bigint, to_depth bigint, n_leaves bigint, saved_tokens bigint"
_CHAINS = pa.schema([(part.split()[0], pa.int64()) for part in CHAINS.split(", ")])


def _chain_totals(chains: DataFrame, queued: int) -> DataFrame:
    """Totals of whole chains: their own, and those of the chains that hang on them.

    A chain starts below the node that it hangs on, so descending starts are an order in which every
    chain comes after those that hang on it.
    """

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = Messages(queued)
        for batch in batches:
            rows = []
            columns = (batch.column(n).to_pylist() for n in batch.schema.names)
            for conv, start, to_conv, to_depth, to_start, leaves, saved in zip(*columns, strict=True):
                for message in queue.pop_for((-start, conv)):
                    leaves, saved = leaves + message[-2], saved + message[-1]
                if to_conv is not None:
                    queue.push((-to_start, to_conv, conv, leaves, saved))
                    rows.append((conv, to_conv, to_depth, leaves, saved))
            yield _record_batch(rows, _CHAINS)

    order = (F.desc("start"), "conv_id")
    return chains.repartition(1).sortWithinPartitions(*order).mapInArrow(up, CHAINS)


def _heavy_totals(heavy: DataFrame, sent: DataFrame, queued: int) -> DataFrame:
    """Heavy nodes with their totals and their parents' names; ``sent`` comes from light roots."""
    nodes = ("x1", "x2")
    below = (
        heavy.filter("depth > 0")
        .groupBy(F.col("p1").alias("x1"), F.col("p2").alias("x2"))
        .agg(F.count("*").alias("heavy_children"))
    )
    zero = F.lit(0).cast("long")
    own = (
        heavy.join(sent, [*nodes], "left")
        .join(below, [*nodes], "left")
        .withColumn(
            "n_children", F.coalesce("light_children", zero) + F.coalesce("heavy_children", zero)
        )
        .withColumn(
            "n_leaves",
            F.coalesce("light_leaves", zero) + (F.col("n_children") == 0).cast("long"),
        )
        .withColumn(
            "saved_tokens",
            F.coalesce("light_saved", zero) + (F.col("n_convs") - 1) * F.col("bytes"),
        )
        .select("conv_id", "depth", *nodes, "p1", "p2", "n_convs", *TOTALS)
    )
    own = _written(own, "heavy-nodes")
    parents = own.select(
        F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
    )
    own = _written(
        own.withColumns({p: F.when(F.col("depth") > 0, F.col(p)) for p in ("p1", "p2")}).join(
            parents, ["p1", "p2"], "left"
        ),
        "heavy-parents",
    )
    starts = own.groupBy("conv_id").agg(
        F.min("depth").alias("start"),
        F.min_by("parent_conv_id", "depth").alias("to_conv"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"),
    )
    starts = _written(starts, "chains")
    targets = starts.select(F.col("conv_id").alias("to_conv"), F.col("start").alias("to_start"))
    chains = starts.join(targets, "to_conv", "left").select(
        "conv_id",
        "start",
        "to_conv",
        (F.col("start") - 1).alias("to_depth"),
        "to_start",
        "n_leaves",
        "saved_tokens",
    )
    hung = (
        _chain_totals(chains, queued)
        .groupBy(F.col("to_conv").alias("conv_id"), F.col("to_depth").alias("depth"))
        .agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
    )
    whole = own.join(hung, ["conv_id", "depth"], "left").withColumns(
        {
            "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", zero),
            "saved_tokens": F.col("saved_tokens") + F.coalesce("more_saved", zero),
        }
    )
    return scanned(
        whole.drop("more_leaves", "more_saved"),
        "conv_id",
        [F.desc("depth")],
        sums=["n_leaves", "saved_tokens"],
    ).drop("place")


# --- members that end at a node ---------------------------------------------------------------


def _end_digests(ends: DataFrame) -> DataFrame:
    """``x1, x2, ends_sha256`` of the ``conv_id`` values of every node, in numeric order."""

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            own: list[str] = []
            size, node, first = 0, None, None
            for x1, x2, conv in zip(*(batch.column(n).to_pylist() for n in ("x1", "x2", "conv_id")), strict=True):
                if own and (node != (x1, x2) or size >= CHUNK):
                    rows.append((*node, first, ",".join(own)))
                    own, size = [], 0
                if not own:
                    node, first = (x1, x2), conv
                own.append(str(conv))
                size += len(own[-1]) + 1
            if own:
                rows.append((*node, first, ",".join(own)))
            yield _record_batch(rows, _ENDS)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held = None, None
        for batch in batches:
            rows = []
            for x1, x2, text in zip(*(batch.column(n).to_pylist() for n in ("x1", "x2", "ids")), strict=True):
                if node != (x1, x2):
                    if held is not None:
                        rows.append((*node, held.hexdigest()))
                    node, held = (x1, x2), hashlib.sha256()
                else:
                    held.update(b",")
                held.update(text.encode())
            yield _record_batch(rows, _DIGESTS)
        if held is not None:
            yield _record_batch([(*node, held.hexdigest())], _DIGESTS)

    keys = ("x1", "x2", "conv_id")
    chunks = ends.repartitionByRange(*keys).sortWithinPartitions(*keys)
    chunks = chunks.mapInArrow(chunk, "x1 bigint, x2 bigint, first bigint, ids string")
    return (
        chunks.repartition("x1", "x2")
        .sortWithinPartitions("x1", "x2", "first")
        .mapInArrow(digest, "x1 bigint, x2 bigint, ends_sha256 string")
    )


_ENDS = pa.schema(
    [("x1", pa.int64()), ("x2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]
)
_DIGESTS = pa.schema([("x1", pa.int64()), ("x2", pa.int64()), ("ends_sha256", pa.string())])


# --- the trie ---------------------------------------------------------------------------------


def trie(conversations: DataFrame, light: int = LIGHT, queued: int = QUEUED) -> DataFrame:
    """A row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``."""
    spark = conversations.sparkSession
    convs, turns = rebuilt(conversations)
    keyed = turns.withColumns(
        {
            f"x{i}": F.xxhash64(F.lit(2 + i), F.col("place"), "r1", "r2")
            for i in (1, 2)
        }
    ).withColumns({"p1": F.col("x1"), "p2": F.col("x2")})
    paths = scanned(
        keyed.select("conv_id", F.col("place").alias("depth"), "x1", "x2", "p1", "p2", "bytes", "turns"),
        "conv_id",
        [F.col("depth")],
        xors=["x1", "x2"],
    ).select(
        "conv_id",
        "depth",
        "x1",
        "x2",
        *(F.col(f"x{i}").bitwiseXOR(F.col(f"p{i}")).alias(f"p{i}") for i in (1, 2)),
        "bytes",
        "turns",
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter(
        "n_convs > 0"
    )
    nodes = _written(
        paths.groupBy("depth", "x1", "x2")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.first("p1").alias("p1"),
            F.first("p2").alias("p2"),
            F.count("*").alias("n_convs"),
            F.max("bytes").alias("bytes"),
            F.sum(F.col("turns") - F.col("depth") + 1).alias("weight"),
        )
        .unionByName(
            root.select(
                zero.alias("depth"), zero.alias("x1"), zero.alias("x2"), "conv_id",
                none.alias("p1"), none.alias("p2"), "n_convs", zero.alias("bytes"), none.alias("weight"),
            )
        ),
        "nodes",
    )
    is_heavy = F.coalesce(F.col("weight") > light, F.lit(True))
    heavy = nodes.filter(is_heavy)

    # a light node's shard is that of its smallest member's topmost light node
    above = bounded_side(heavy.select("x1", "x2"))
    tops = (
        paths.join(above, ["x1", "x2"], "left_anti")
        .groupBy("conv_id")
        .agg(F.min(F.struct("depth", "x1", "x2")).alias("root"))
    )
    dealt = nodes.filter(~is_heavy).join(tops, "conv_id").withColumn(
        "top", F.col("depth") == F.col("root.depth")
    )
    rows = nodes.filter(~is_heavy).count()
    shards = max(
        math.ceil(rows / max(1, light)), int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    below = _written(
        _light_totals(
            dealt.repartition(shards, "root.x1", "root.x2").sortWithinPartitions(
                F.desc("depth"), "x1", "x2"
            ),
            queued,
        ),
        "light-nodes",
    )
    roots = below.filter("parent_conv_id is null")
    sent = roots.groupBy(F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(
        F.count("*").alias("light_children"),
        F.sum("n_leaves").alias("light_leaves"),
        F.sum("saved_tokens").alias("light_saved"),
    )
    upper = _heavy_totals(heavy, sent, queued)
    named = upper.select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("name"))
    columns = ("conv_id", "depth", "x1", "x2", "parent_conv_id", "n_convs", *TOTALS)
    rest = ("conv_id", "depth", "x1", "x2", F.col("name").alias("parent_conv_id"), "n_convs", *TOTALS)
    every = (
        below.filter("parent_conv_id is not null")
        .select(*columns)
        .unionByName(roots.join(bounded_side(named), ["p1", "p2"]).select(*rest))
        .unionByName(upper.select(*columns))
    )
    ends = paths.filter("depth = turns").select("x1", "x2", "conv_id")
    ends = ends.unionByName(
        convs.filter("turns = 0").select(zero.alias("x1"), zero.alias("x2"), "conv_id")
    )
    nothing = hashlib.sha256().hexdigest()
    return every.join(_end_digests(ends), ["x1", "x2"], "left").select(
        *(n for n in columns if n not in ("x1", "x2")),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
