"""Exact two-sample p-values: worked by hand, by enumeration, and against the series."""

from __future__ import annotations

import math
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from lexigate.operators import drift


@pytest.mark.parametrize(
    ("n", "m", "steps", "expected"),
    [
        (1, 1, 1, 1.0),
        (2, 2, 2, 2 / 6),  # apart: LLRR and RRLL of six orders
        (2, 2, 1, 1.0),
        (1, 2, 2, 2 / 3),  # the single value is first or last
        (2, 3, 6, 2 / 10),
        (3, 3, 2, 12 / 20),  # |i - j| reaches 2: 2 * C(6, 1) paths by reflection
        (5, 7, 0, 1.0),
        (20, 30, 60, 2 / math.comb(50, 20)),
    ],
)
def test_small_cases_worked_by_hand(n, m, steps, expected):
    assert drift.exact_ks_pvalue(n, m, steps) == pytest.approx(expected, rel=1e-12)


@pytest.mark.parametrize(("n", "m"), [(4, 5), (4, 6), (5, 5), (2, 7)])
def test_equals_the_count_of_all_orders(n, m):
    lcm = math.lcm(n, m)
    widest = []
    for chosen in combinations(range(n + m), n):
        i = gap = 0
        for place in range(n + m):
            i += place in chosen
            j = place + 1 - i
            gap = max(gap, abs(i * lcm // n - j * lcm // m))
        widest.append(gap)
    for steps in range(1, lcm + 1):
        share = sum(w >= steps for w in widest) / len(widest)
        assert drift.exact_ks_pvalue(n, m, steps) == pytest.approx(share, rel=1e-12)


def test_agrees_with_the_series_for_large_samples(spark):
    n, m, steps = 9000, 10_000, 1800
    statistic = steps / math.lcm(n, m)
    scaled = F.lit(statistic * math.sqrt(n * m / (n + m)))
    series = spark.range(1).select(drift.ks_pvalue(scaled).alias("p")).first()["p"]
    assert drift.exact_ks_pvalue(n, m, steps) == pytest.approx(series, rel=0.05)


def test_ties_count_once_and_the_limit_switches_to_the_series(spark, monkeypatch):
    def column(values):
        return spark.createDataFrame([(float(v),) for v in values], "x double")

    # after the ties at 1: 2/4 against 3/3, six twelfths apart
    a, b = column([1, 1, 2, 3]), column([0, 1, 1])
    (row,) = drift.ks_two_sample(a, b, ["x"]).collect()
    assert row["ks_statistic"] == pytest.approx(0.5)
    assert row["ks_pvalue"] == pytest.approx(drift.exact_ks_pvalue(4, 3, 6), rel=1e-12)
    many = column(range(10_001))
    (row,) = drift.ks_two_sample(many, b, ["x"]).collect()
    assert row["ks_statistic"] > 0.99
    scaled = row["ks_statistic"] * math.sqrt(10_001 * 3 / 10_004)
    assert row["ks_pvalue"] == pytest.approx(2 * math.exp(-2 * scaled**2), rel=1e-3)
