"""The prefix trie against a plain version, on tables with nulls, ties, repeats and long chains."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from compare import differences, duck
from lexigate.llm import oracles, prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, x1 string, part double"
COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
)


def plain(rows: list[tuple]) -> list[tuple]:
    own: dict[int, list] = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            sign = hashlib.md5(text.encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, role, sign, text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    nodes: dict[tuple, list] = {}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        full[c] = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(full[c]) + 1):
            nodes.setdefault(full[c][:d], []).append(c)
    children: dict[tuple, int] = {}
    for node in nodes:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for node, members in nodes.items():
        size = len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(members) - 1) * size
            leaves[node[:d]] += node not in children
    return sorted(
        (
            min(members),
            len(node),
            min(nodes[node[:-1]]) if node else None,
            len(members),
            children.get(node, 0),
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(str(c) for c in sorted(members) if full[c] == node).encode()).hexdigest(),
        )
        for node, members in nodes.items()
    )


def found(frame) -> list[tuple]:
    return sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect())


def made(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["hi", "", None, "straße", "ok then", "x" * 40]
    rows = []
    for conv in [*range(-7, 60), 1000, 1003, 10**15 + 4, *range(200, 260)]:
        copied = random.Random(5) if conv >= 200 else rng  # many equal ones
        for turn in range(copied.choice([1, 2, 4, 9, 12])):
            role = copied.choice(["user", "assistant", None])
            place = None if copied.random() < 0.1 else turn // copied.choice([1, 1, 2])
            rows.append((conv, place, role, copied.choice(texts), 1, "x", 0.5))
    rows += rows[:3]  # repeated rows
    rows += [(None, 0, "user", "lost", 1, "x", 0.5)]
    rows += [(77, t, "user", f"turn {t % 3}", 1, "x", 0.5) for t in range(300)]
    rows += [(78, t, "user", f"turn {t % 3}", 1, "x", 0.5) for t in range(150)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("light", "queued"), [(100_000, 1 << 17), (40, 5), (1, 1), (0, 1)])
def test_matches_plain_version(spark, light, queued):
    rows = made(3)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(prefix_trie.trie(frame, light, queued)) == plain(rows)


def test_ids_of_a_node_fill_many_chunks(spark, monkeypatch):
    rows = [(c, 0, "user", "same", 1, "x", 0.5) for c in range(0, 4000)]
    monkeypatch.setattr(prefix_trie, "CHUNK", 100)
    assert found(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_very_long_text_counts_its_bytes(spark):
    rows = [(c, 0, "user", "é" * 3_000_000, 1, "x", 0.5) for c in (45, 50)]
    assert found(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_empty_tables_have_no_nodes(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.trie(empty).count() == 0
    lost = spark.createDataFrame([(None, 0, "user", "lost", 1, "x", 0.5)], SCHEMA)
    assert prefix_trie.trie(lost).count() == 0


def test_running_values_cross_ranges(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") < 800, 1).otherwise(F.col("id") % 7).cast("long").alias("k"),
        F.col("id").alias("at"),
        F.col("id").alias("x"),
        F.col("id").alias("s"),
    )
    out = prefix_trie.scanned(rows, "k", [F.col("at")], ["x"], ["s"]).collect()
    state: dict[int, tuple] = {}
    expected = {}
    for r in sorted(rows.collect(), key=lambda r: (r.k, r.at)):
        n, x, s = state.get(r.k, (0, 0, 0))
        expected[r.k, r.at] = state[r.k] = (n + 1, x ^ r.x, s + r.s)
    assert {(r.k, r["at"]): (r.place, r.x, r.s) for r in out} == expected


def test_queue_spills_and_keeps_its_order():
    queue, rng = prefix_trie.Messages(4), random.Random(1)
    sent = [(rng.randrange(20), rng.randrange(5), i) for i in range(200)]
    for message in sent:
        queue.push(message)
    assert [m for k in range(20) for m in queue.pop_for((k,))] == sorted(sent)
    assert not queue.heap


def test_matches_sql_on_odd_rows(spark, tmp_path):
    spark.createDataFrame(made(4), SCHEMA).select("conv_id", "turn", "role", "text").coalesce(1).write.parquet(
        str(tmp_path / "c")
    )
    connection = duck("/root/testdata/sf0.001")
    connection.execute(
        f"create or replace view conversations as select * from read_parquet('{tmp_path}/c/*.parquet')"
    )
    frame = prefix_trie.trie(spark.read.parquet(str(tmp_path / "c")))
    assert differences(frame, connection, oracles.PREFIX_TRIE) == []
