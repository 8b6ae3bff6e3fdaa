"""Exact top-k by inner product, with an M-tree searched best first.

Vectors are put on a sphere around the origin by one more coordinate, sqrt(M^2 - |x|^2), and a query
gets 0 there; then d(q, x)^2 = |q|^2 + M^2 - 2 q.x, so the largest inner products are the smallest
distances of a true metric.

The tree's root page is a bounded set of routing vectors with covering radii, known to every task. A
routing vector's objects form subtrees of at most about ``SUBTREE`` rows (a crowded one is several
subtrees with the same routing vector, so equal vectors never crowd a task), each cut further into
pages of ``PAGE`` entries. A page stores its routing object, covering radius and distance to the
parent's routing object, a leaf also the distances of its entries to its routing object.

A query first visits the subtree with the least distance bound, which gives it a 20th score to beat;
then only the subtrees whose bound can beat it. Inside a subtree pages are taken best bound first,
and pages and entries are skipped by |d(q, parent) - d(parent, object)| before any distance to them
is computed. Bounds are floating point with a margin; scores are exact integers.

Cases: vectors that are null, or hold null or non-finite components, take no part; components of any
size do, and a score that is met beyond a long is an error; shorter vectors count as padded with zeros;
ties go to the smaller vec_id (null last), then to the earlier row; a vec_id that repeats is a query per row, and only the
query's own row is left out; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexigate.llm.exact import products
from lexigate.scratch import new_path

SCALE = 64
SUBTREE = 4096
CELLS = 1024  # routing vectors in the root page, at most
FANOUT, PAGE = 16, 512
QUERY_BLOCK = 4096
SLACK = 1e-9  # of a squared distance, relative

NODE = (
    "cell int, slice int, node int, parent int, leaf boolean, radius double, parent_distance double,"
    " routing binary, ids binary, row_keys binary, vectors binary, entry_distances binary"
)
FOUND = "query_key bigint, query_id bigint, vec_id bigint, row_key bigint, score bigint"
NULL_ID = np.iinfo(np.int64).max


def quantised(embeddings: DataFrame) -> DataFrame:
    """Usable vectors as whole numbers, kept as doubles."""
    usable = (
        "embedding is not null and forall(embedding, x -> x is not null and not isnan(x)"
        " and abs(cast(x as double)) < double('infinity'))"
    )
    scaled = f"{SCALE} * cast(x as double)"
    # doubles from 2^52 on are whole
    number = (
        f"case when abs({scaled}) < {2**52} then cast(floor({scaled}) as double)"
        f" when abs({scaled}) < double('infinity') then {scaled}"
        f" else cast(raise_error('{SCALE} times a component is beyond a double') as double) end"
    )
    return embeddings.filter(usable).selectExpr(
        "cast(vec_id as bigint) as vec_id", f"transform(embedding, x -> {number}) as v"
    )


def matrix(column: pa.Array, dim: int, kind: str) -> np.ndarray:
    """Rows of packed vectors."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, dim)


def lifted(vectors: np.ndarray, sphere: float) -> np.ndarray:
    """Points on the sphere, as floats."""
    points = vectors.astype(np.float64)
    rest = np.sqrt(np.maximum(0.0, sphere - np.einsum("ij,ij->i", points, points)))
    return np.hstack([points, rest[:, None]])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(0.0, squared))


def build(points: np.ndarray, routing: np.ndarray) -> Iterator[tuple]:
    """(node, parent, members or None, routing point, radius, distance to the parent's)."""
    waiting = [(np.arange(len(points)), -1, routing, 0.0)]
    number = 0
    while waiting:
        members, parent, centre, away = waiting.pop()
        near = np.sqrt(((points[members] - centre) ** 2).sum(1))
        leaf = len(members) <= PAGE
        yield number, parent, members if leaf else None, centre, float(near.max(initial=0)), away, near
        if not leaf:
            parts = min(FANOUT, math.ceil(len(members) / (PAGE / 2)))
            # routing objects spread over the members by their distance to the parent's
            chosen = members[np.argsort(near, kind="stable")][
                np.linspace(0, len(members) - 1, parts).astype(int)
            ]
            nearest = distances(points[members], points[chosen]).argmin(1)
            if np.bincount(nearest, minlength=parts).max() > 0.9 * len(members):
                nearest = np.arange(len(members)) * parts // len(members)
            for k in range(parts):
                if (nearest == k).any():
                    child = points[chosen[k]]
                    step = float(np.sqrt(((child - centre) ** 2).sum()))
                    waiting.append((members[nearest == k], number, child, step))
        number += 1


class Subtree:
    """The pages of a subtree, for best-first search."""

    def __init__(self, nodes: pa.Table, dim: int, sphere: float, kind: str):
        self.pages = {}
        self.children: dict[int, list[int]] = {}
        for row in nodes.to_pylist():
            self.children.setdefault(row["parent"], []).append(row["node"])
            page = (row["radius"], row["parent_distance"], np.frombuffer(row["routing"]))
            if row["leaf"]:
                vectors = np.frombuffer(row["vectors"], kind).reshape(-1, dim)
                page += (
                    vectors.astype(np.float64),
                    np.frombuffer(row["ids"], np.int64),
                    np.frombuffer(row["row_keys"], np.int64),
                    np.frombuffer(row["entry_distances"]),
                    float(np.abs(vectors, dtype=np.float64).max(initial=0)),
                )
            self.pages[row["node"]] = page
        self.sphere = sphere
        # per inner page: children, their routing points, radii and distances to the page's own
        self.inner = {
            node: (
                under,
                np.stack([self.pages[c][2] for c in under]),
                np.array([self.pages[c][0] for c in under]),
                np.array([self.pages[c][1] for c in under]),
            )
            for node, under in self.children.items()
            if node >= 0
        }

    def search(self, query: np.ndarray, own: int, k: int, beat: float) -> tuple:
        """Best (scores, ids, row keys) that reach ``beat``, at most ``k``."""
        point = np.append(query, 0.0)
        base = float(query @ query) + self.sphere

        def reach(score: float) -> float:
            left = base - 2 * score
            return math.sqrt(max(0.0, left) + SLACK * (base + 1)) if score > -math.inf else math.inf

        limit = reach(beat)
        best = (np.zeros(0, np.int64),) * 3
        largest = float(np.abs(query).max(initial=0))
        root = self.children[-1][0]
        at = float(np.sqrt(((point - self.pages[root][2]) ** 2).sum()))
        queue = [(max(0.0, at - self.pages[root][0]), root, at)]
        while queue:
            bound, node, at = heapq.heappop(queue)
            if bound > limit:
                break
            if node in self.inner:
                under, routing, radii, steps = self.inner[node]
                able = np.flatnonzero(np.abs(at - steps) - radii <= limit)
                away = np.sqrt(((routing[able] - point) ** 2).sum(1))
                for i, d in zip(able.tolist(), away.tolist(), strict=True):
                    if d - radii[i] <= limit:
                        heapq.heappush(queue, (max(0.0, d - radii[i]), under[i], d))
                continue
            _, _, _, vectors, ids, keys, steps, most = self.pages[node]
            able = np.flatnonzero(np.abs(at - steps) <= limit)
            # leaving out a few entries costs more than their products
            some = vectors if 2 * len(able) > len(keys) else vectors[able]
            scores = exact_products(some, query, most * largest)
            scores = scores[able] if some is vectors else scores
            good = np.flatnonzero(scores >= beat)
            able, scores = able[good], scores[good]
            if len(able) and own in keys[able]:
                other = keys[able] != own
                able, scores = able[other], scores[other]
            if not len(able):
                continue
            scores = np.concatenate([best[0], scores])
            found = np.concatenate([best[1], ids[able]])
            rows = np.concatenate([best[2], keys[able]])
            order = np.lexsort((rows, found, -scores))[:k]
            best = (scores[order], found[order], rows[order])
            if len(order) == k:
                beat = max(beat, int(best[0][-1]))
                limit = reach(beat)
        return best


def exact_products(vectors: np.ndarray, query: np.ndarray, most: float) -> np.ndarray:
    """Integer inner products, no factor pair above ``most``; below 2^53 floats are exact."""
    if most * max(1, len(query)) < 2**53:
        return (vectors @ query).astype(np.int64)
    return products(vectors, query[None, :])[:, 0]


def top_k(embeddings: DataFrame, is_query: str = "vec_id % 20 = 0", k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score`` (and ``query_key``, the query's row), exactly."""
    spark = embeddings.sparkSession

    def written(frame: DataFrame, name: str) -> DataFrame:
        path = new_path(spark, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    rows = written(
        quantised(embeddings).withColumn("row_key", F.monotonically_increasing_id()), "vectors"
    )
    squared = F.aggregate("v", F.lit(0).cast("double"), lambda a, x: a + x.cast("double") * x)
    largest = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    number, dim, sphere, most = rows.agg(
        F.count("*"), F.max(F.size("v")), F.max(squared), F.max(largest)
    ).first()
    if not number:
        return spark.createDataFrame(
            [], "query_key bigint, query_id bigint, rank int, vec_id bigint, score bigint"
        )
    if not math.isfinite(sphere):
        raise OverflowError("a vector's squared length is beyond a double")
    dim, sphere, kind = max(1, dim), float(sphere) + 1.0, "i4" if most < 2**31 else "f8"
    cells = max(1, min(CELLS, math.ceil(number / SUBTREE)))
    centres = (
        rows.groupBy("v").agg(F.xxhash64("v").alias("h")).orderBy("h", "v").limit(cells).collect()
    )
    routing = lifted(np.array([(r["v"] + [0] * dim)[:dim] for r in centres], dtype=float), sphere)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = np.array(
                [(v + [0] * dim)[:dim] for v in batch.column("v").to_pylist()], dtype=kind
            ).reshape(-1, dim)
            near = distances(lifted(vectors, sphere), routing)
            cell = near.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("row_key"),
                    pa.array([v.tobytes() for v in vectors], pa.binary()),
                    pa.array(cell, pa.int32()),
                    pa.array(near[np.arange(len(cell)), cell]),
                ],
                names=["vec_id", "row_key", "packed", "cell", "near"],
            )

    placed = written(
        rows.mapInArrow(
            assign, "vec_id bigint, row_key bigint, packed binary, cell int, near double"
        ),
        "vector-cells",
    )
    # one row per cell, at most CELLS of them
    root_page = (
        placed.groupBy("cell")
        .agg(F.count("*").alias("n"), F.max("near").alias("radius"))
        .withColumn("slices", F.ceil(F.col("n") / (2 * SUBTREE)).cast("int"))
        .orderBy("cell")
        .collect()
    )
    own_cells = np.array([r["cell"] for r in root_page])
    radii = np.array([r["radius"] for r in root_page])
    slices = np.array([r["slices"] for r in root_page])
    at_most = F.element_at(F.create_map(*[F.lit(int(x)) for r in root_page for x in (r[0], r[3])]), F.col("cell"))

    def pages(table: pa.Table) -> pa.Table:
        vectors = matrix(table["packed"], dim, kind)
        points = lifted(vectors, sphere)
        ids = table["vec_id"].fill_null(NULL_ID).to_numpy()
        keys = table["row_key"].to_numpy()
        cell, part = table["cell"][0].as_py(), table["slice"][0].as_py()
        made = []
        for node, parent, members, centre, radius, away, near in build(points, routing[cell]):
            leaf = members is not None
            some = members if leaf else np.zeros(0, dtype=np.int64)
            made.append(
                (cell, part, node, parent, leaf, radius, away, centre.tobytes(), ids[some].tobytes(),
                 keys[some].tobytes(), vectors[some].tobytes(), near.tobytes() if leaf else b"")
            )
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), _NODE, strict=True)],
            schema=_NODE,
        )

    tree = written(
        placed.withColumn("slice", F.pmod(F.xxhash64("row_key"), at_most).cast("int"))
        .groupBy("cell", "slice")
        .applyInArrow(pages, NODE),
        "m-tree",
    )
    queries = placed.filter(is_query).select(
        F.col("row_key").alias("query_key"), F.col("vec_id").alias("query_id"), "packed"
    )
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("query_key"), F.lit(blocks)).cast("int"))

    def route(first: bool):
        """The (cell, slice) a query visits: the nearest one, or all others that can beat its bound."""

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                vectors = matrix(batch.column("packed"), dim, kind).astype(np.float64)
                points = np.hstack([vectors, np.zeros((len(vectors), 1))])
                bound = np.maximum(0.0, distances(points, routing[own_cells]) - radii)
                nearest = np.lexsort((distances(points, routing[own_cells]), bound), axis=1)[:, 0]
                start = batch.column("query_key").to_numpy() % slices[nearest]
                base = (vectors * vectors).sum(1) + sphere
                if first:
                    who, cell, part = np.arange(len(vectors)), nearest, start
                else:
                    beat = batch.column("beat").to_numpy(zero_copy_only=False).astype(np.float64)
                    limit = base - 2 * beat + SLACK * (base + 1) * 4
                    limit[np.isnan(limit)] = np.inf
                    able = bound**2 <= limit[:, None]
                    who, cell = np.nonzero(able)
                    times = slices[cell]
                    part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    who, cell = np.repeat(who, times), np.repeat(cell, times)
                    fresh = (cell != nearest[who]) | (part != start[who])
                    who, cell, part = who[fresh], cell[fresh], part[fresh]
                columns = [batch.column(n).take(pa.array(who)) for n in batch.schema.names]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(own_cells[cell], pa.int32()), pa.array(part, pa.int32())],
                    names=[*batch.schema.names, "cell", "slice"],
                )

        return send

    VISIT = "query_key bigint, query_id bigint, packed binary, block int, beat bigint, cell int, slice int"

    def visit(asked: pa.Table, nodes: pa.Table) -> pa.Table:
        made: list[list] = [[], [], [], [], []]
        if asked.num_rows and nodes.num_rows:
            subtree = Subtree(nodes, dim, sphere, kind)
            vectors = matrix(asked["packed"], dim, kind).astype(np.float64)
            for query, key, number, beat in zip(
                vectors,
                asked["query_key"].to_pylist(),
                asked["query_id"].to_pylist(),
                asked["beat"].to_pylist(),
                strict=True,
            ):
                scores, ids, keys = subtree.search(query, key, k, -math.inf if beat is None else beat)
                made[0] += [key] * len(ids)
                made[1] += [number] * len(ids)
                made[2] += [None if i == NULL_ID else i for i in ids.tolist()]
                made[3] += keys.tolist()
                made[4] += scores.tolist()
        return pa.Table.from_arrays([pa.array(m, pa.int64()) for m in made], names=FOUND_NAMES)

    def searched(asked: DataFrame) -> DataFrame:
        asked = written(asked, "visits")
        names = {"cell": "of_cell", "slice": "of_slice", "block": "of_block"}
        wanted = asked.select(*names).distinct().withColumnsRenamed(names)
        held = tree.join(
            wanted, (F.col("cell") == F.col("of_cell")) & (F.col("slice") == F.col("of_slice"))
        )
        return (
            asked.groupBy(*names)
            .cogroup(held.groupBy(*names.values()))
            .applyInArrow(visit, FOUND)
        )

    columns = ("query_key", "query_id", "packed", "block", "beat")
    asked = queries.withColumn("beat", F.lit(None).cast("long")).select(*columns)
    start = written(searched(asked.mapInArrow(route(True), VISIT)), "nearest-found")
    bounds = start.groupBy("query_key").agg(
        F.when(F.count("*") >= k, F.min("score")).alias("beat")
    )
    asked = queries.join(bounds, "query_key", "left").select(*columns)
    others = searched(asked.mapInArrow(route(False), VISIT))
    order = Window.partitionBy("query_key").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), "row_key"
    )
    return (
        start.unionByName(others)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_key", "query_id", "rank", "vec_id", "score")
    )


FOUND_NAMES = [part.split()[0] for part in FOUND.split(", ")]
_NODE = pa.schema(
    [
        ("cell", pa.int32()),
        ("slice", pa.int32()),
        ("node", pa.int32()),
        ("parent", pa.int32()),
        ("leaf", pa.bool_()),
        ("radius", pa.float64()),
        ("parent_distance", pa.float64()),
        *((n, pa.binary()) for n in ("routing", "ids", "row_keys", "vectors", "entry_distances")),
    ]
)
