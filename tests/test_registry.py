import random

import pytest
from pyspark.sql import functions as F

from lexigate.operators import registry

SCHEMA = "model string, version string, new_stage string, ts timestamp, event_id int, gate_passed boolean"


def replay(events):
    """Apply requests one at a time, as a registry that keeps an index would."""
    index, refused = {}, {}
    for model, version, stage, ts, event_id, gate in sorted(events, key=lambda e: (e[3], e[4])):
        versions = index.setdefault(model, {})
        if not model or any(part in model for part in ("/", "\\", "..")):
            refused[event_id] = "unsafe_name"
        elif stage not in registry.STAGES:
            refused[event_id] = "invalid_stage"
        elif version not in versions and stage in ("production", "archived"):
            refused[event_id] = "not_registered"
        elif stage == "production" and versions[version] != "staging":
            refused[event_id] = "not_in_staging"
        elif stage in ("staging", "production") and not gate:
            refused[event_id] = "gate_not_passed"
        else:
            if stage == "production":
                for other, held in versions.items():
                    if held == "production":
                        versions[other] = "archived"
            versions[version] = stage
    return {m: v for m, v in index.items() if v}, refused


@pytest.mark.parametrize("seed,rows_per_range", [(1, 10_000), (2, 60), (3, 25)])
def test_against_replaying_each_event(spark, seed, rows_per_range):
    from datetime import datetime, timedelta

    rng = random.Random(seed)
    events = [
        (
            rng.choice(["m", "m", "m", "n", "../x", "a\\b", ""]),
            f"c{rng.randrange(5)}",
            rng.choice([*registry.STAGES, "staging", "production", "retired", None]),
            datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(400)),
            i,
            rng.choice([True, True, False, None]),
        )
        for i in range(400)
    ]
    frame = spark.createDataFrame(events, SCHEMA)
    index, refused = replay(events)
    judged = registry.judge_events(frame, rows_per_range).collect()
    assert {r["event_id"]: r["reason"] for r in judged if not r["accepted"]} == refused
    state = registry.registry_state(frame, rows_per_range).collect()
    assert {(r["model"], r["version"]): r["stage"] for r in state} == {
        (m, v): stage for m, versions in index.items() for v, stage in versions.items()
    }
    for model, versions in index.items():
        numbers = {r["version"]: r["version_number"] for r in state if r["model"] == model}
        assert sorted(numbers, key=numbers.get) == list(versions)
        assert sorted(numbers.values()) == list(range(1, len(numbers) + 1))


def lifecycle(spark, *moves):
    return spark.createDataFrame(
        [("m", v, s, None, i, g) for i, (v, s, g) in enumerate(moves)], SCHEMA
    ).withColumn("ts", F.timestamp_seconds("event_id"))


def test_promotion_archives_the_version_before_it(spark):
    events = lifecycle(
        spark,
        ("a", "staging", True), ("a", "production", True),
        ("b", "none", None), ("b", "staging", True), ("b", "production", True),
    )
    state = registry.registry_state(events)
    assert {r["version"]: (r["stage"], r["bundle_path"]) for r in state.collect()} == {
        "a": ("archived", "m/v1"), "b": ("production", "m/v2"),
    }
    assert registry.production_model(state).first()["version"] == "b"
    wanted = spark.createDataFrame([("m/v1",), ("m/v2",), ("m/v9",), ("../m/v2",)], "bundle_path string")
    status = {r["bundle_path"]: r["status"] for r in registry.serving_eligibility(wanted, state).collect()}
    assert status == {
        "m/v1": "not_production", "m/v2": "eligible", "m/v9": "unknown", "../m/v2": "outside_registry",
    }


def test_a_refused_event_does_not_count_as_a_stage(spark):
    # the refused staging in between must not make the promotion legal
    events = lifecycle(spark, ("a", "none", None), ("a", "staging", False), ("a", "production", True))
    reasons = [r["reason"] for r in registry.illegal_transitions(events).orderBy("event_id").collect()]
    assert reasons == ["gate_not_passed", "not_in_staging"]


def test_paths(spark):
    paths = ["m/v1", "a/../m/v1", "../m", "/m/v1", "a/..", "a/../../m", ".", None]
    frame = spark.createDataFrame([(p,) for p in paths], "p string")
    inside = [r[0] for r in frame.select(F.coalesce(registry.stays_inside(F.col("p")), F.lit(False))).collect()]
    assert inside == [True, True, False, False, False, False, False, False]
