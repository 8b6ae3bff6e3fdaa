"""Hard negatives against a plain version, on odd vectors, ties, repeats and large components."""

from __future__ import annotations

import math
import random

import pytest

from compare import differences, duck
from lexigate.llm import hard_negatives as hn
from lexigate.llm import queries
from lexigate.llm.exact import products

SCHEMA = "vec_id bigint, embedding array<double>, label int, slice string, packed int, asks boolean"


def plain(rows, is_anchor, k_pos=5, k_neg=10):
    held = []
    for key, (vec, embedding, label, *_) in enumerate(rows):
        if label is None or embedding is None or any(x is None or not math.isfinite(x) for x in embedding):
            continue
        held.append((key, vec, label, [math.floor(256 * x) for x in embedding]))

    def order(entry):
        score, (key, vec, *_) = entry
        return -score, vec is None, vec or 0, key

    found = []
    for key, vec, label, v in held:
        if vec is None or not is_anchor(vec):
            continue
        scored = [(sum(a * b for a, b in zip(v, o[3])), o) for o in held if o[0] != key]
        positives = sorted((s for s in scored if s[1][2] == label), key=order)[:k_pos]
        others = sorted((s for s in scored if s[1][2] != label), key=order)
        for score, positive in positives:
            inside = [o for o in others if 30 * score <= 100 * o[0] <= 90 * score][:k_neg]
            found += [
                (vec, positive[1], rank, o[1], score, s) for rank, (s, o) in enumerate(inside, 1)
            ]
    return sorted(found, key=repr)


def mined(frame, **settings):
    return sorted(
        (
            (r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score)
            for r in hn.mine(frame, **settings).collect()
        ),
        key=repr,
    )


def made(seed=2, n=400):
    rng = random.Random(seed)
    rows = []
    for vec in range(n):
        embedding = [rng.choice([-1.0, -0.5, 0.1, 0.25, 0.5, 1.0, 2.0]) for _ in range(6)]
        rows.append((vec, embedding, rng.choice([0, 1, 1, 2]), "s", 1, True))
    same = [0.5, 0.5, 1.0, 0.0, 0.25, 1.0]
    rows += [(1000 + i, same, 1, "s", 1, True) for i in range(150)]  # copies of one vector
    rows += [
        (2000, None, 1, "s", 1, True),
        (2100, [1.0, None, 1.0], 1, "s", 1, True),
        (2200, [1.0, math.nan], 1, "s", 1, True),
        (2300, [1.0, math.inf], 1, "s", 1, True),
        (2400, [1.0] * 6, None, "s", 1, True),
        (2500, [1.0, 1.0], 0, "s", 1, True),  # shorter
        (2600, [], 0, "s", 1, True),
        (None, [1.0] * 6, 0, "s", 1, True),
        (None, [1.0] * 6, 1, "s", 1, True),
        (2700, [-3.0] * 6, 2, "s", 1, True),  # positives below zero
        rows[100],
        rows[100],  # a repeated anchor
    ]
    return rows


@pytest.mark.parametrize("slice_rows", [1 << 16, 50])
def test_matches_plain_version(spark, slice_rows):
    rows = made()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4).sortWithinPartitions("vec_id")
    expected = plain(rows, lambda v: v % 50 == 0)
    assert expected
    assert mined(frame, is_anchor="vec_id % 50 = 0", slice_rows=slice_rows) == expected


def test_blocks_of_anchors_change_nothing(spark, monkeypatch):
    rows = made(7, 150)
    monkeypatch.setattr(hn, "CELLS", 64)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert mined(frame, is_anchor="vec_id % 10 = 0") == plain(rows, lambda v: v % 10 == 0)


def test_large_components_stay_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([1e6, -3e6, 1.0, 2e6]) for _ in range(4)], i % 2, "s", 1, True) for i in range(60)]
    rows.append((100, [2.0**46 + 2.0**-6, 1.0], 0, "s", 1, True))
    rows.append((101, [1.0, 2.0**44 - 2.0**-8], 1, "s", 1, True))
    rows[0] = (0, [1.0, 1.0], 0, "s", 1, True)
    assert mined(spark.createDataFrame(rows, SCHEMA), is_anchor="vec_id % 10 = 0 and vec_id < 1") == plain(
        rows, lambda v: v == 0
    )


def test_a_score_beyond_a_long_is_an_error(spark):
    rows = [(i, [2.0**30 + i], 0, "s", 1, True) for i in range(3)]
    with pytest.raises(Exception, match="more than 64 bits"):
        hn.mine(spark.createDataFrame(rows, SCHEMA)).collect()


def test_products_are_exact_at_every_size():
    import numpy as np

    rng = random.Random(9)
    a = [[float(rng.randrange(-(2**s), 2**s)) for _ in range(3)] for s in (2, 20, 29, 30)]
    b = [[float(rng.randrange(-(2**s), 2**s)) for _ in range(3)] for s in (3, 25, 31)]
    expected = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
    assert products(np.array(a), np.array(b)).tolist() == expected


def test_merges_answer_every_window():
    rng = random.Random(3)
    for _ in range(50):
        scores = sorted((rng.randrange(100) for _ in range(30)), reverse=True)
        upper = sorted({rng.randrange(100) for _ in range(4)}, reverse=True)
        slots = [
            [s for s in scores if s <= u and (i + 1 == len(upper) or s > upper[i + 1])][:5]
            for i, u in enumerate(upper)
        ]
        assert hn.merged_slots(slots, 5) == [[s for s in scores if s <= u][:5] for u in upper]


def test_empty_table_gives_no_rows(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []


def test_query_matches_sql_with_odd_rows(spark, tmp_path):
    table = "vec_id bigint, embedding array<float>, label int"
    rows = [r[:3] for r in made()[:-2] if r[0] is not None and r[0] != 2500 and r[0] != 2600]
    spark.createDataFrame(rows, table).coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    connection = duck("/root/testdata/sf0.001")
    connection.execute(
        f"create or replace view embeddings as select * from read_parquet('{tmp_path}/embeddings.parquet/*.parquet')"
    )
    from lexigate.llm import oracles

    assert (
        differences(queries.op11_hard_negatives(spark, str(tmp_path)), connection, oracles.HARD_NEGATIVES)
        == []
    )
