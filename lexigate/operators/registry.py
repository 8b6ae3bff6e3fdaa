"""Model registry as an append-only event table; the current state is derived.

An event asks to move ``(model, version)`` to ``new_stage`` at ``(ts, event_id)``;
``gate_passed`` says whether the version's bundle passed its gate. A refused event changes
nothing, so whether a promotion is legal depends on the last *accepted* event before it. Only
moves to none, archived and (with a passed gate) staging are accepted whatever came before, which
makes the state before any event two running maxima: the latest such move, and the latest
promotion request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigate.operators.scale import ROWS_PER_RANGE, bounded_side, range_edges, running

# fixed values
STAGES = ("none", "staging", "production", "archived")

ORDER = ("ts", "event_id")


def is_safe_name(name: Column) -> Column:
    """A usable directory name: not empty, no separator, no parent reference."""
    return (
        name.isNotNull()
        & (F.length(name) > 0)
        & ~name.contains("/")
        & ~name.contains("\\")
        & ~name.contains("..")
    )


def stays_inside(path: Column) -> Column:
    """A relative path that never climbs above its root and does not end on it."""
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("lowest"))

    def step(state: Column, part: Column) -> Column:
        move = F.when(part == "..", -1).when(part.isin("", "."), 0).otherwise(1)
        depth = state["depth"] + move
        return F.struct(depth.alias("depth"), F.least(state["lowest"], depth).alias("lowest"))

    walked = F.aggregate(F.split(path, "/"), start, step)
    return (
        path.isNotNull()
        & ~path.startswith("/")
        & (walked["lowest"] >= 0)
        & (walked["depth"] > 0)
    )


def judge_events(events: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``accepted`` and ``reason`` to every event."""
    stage, gate = F.col("new_stage"), F.coalesce(F.col("gate_passed"), F.lit(False))
    well_formed = is_safe_name(F.col("model")) & F.coalesce(stage.isin(*STAGES), F.lit(False))
    to_staging = well_formed & (stage == "staging") & gate
    registers = (well_formed & (stage == "none")) | to_staging
    settles = registers | (well_formed & (stage == "archived"))
    promotes = well_formed & (stage == "production") & gate

    place = F.struct(*ORDER)
    seen = running(
        events,
        ORDER,
        last_before={
            "__registered": F.when(registers, place),
            "__settled": F.when(settles, F.struct(*ORDER, "new_stage")),
            "__requested": F.when(promotes, place),
        },
        keys=["model", "version"],
        edges=range_edges(events, ORDER[0], rows_per_range),
    )
    settled_at = F.struct(*[F.col(f"__settled.{name}").alias(name) for name in ORDER])
    in_staging = (F.col("__settled.new_stage") == "staging") & (
        F.col("__requested").isNull() | (F.col("__requested") < settled_at)
    )
    reason = (
        F.when(~is_safe_name(F.col("model")), "unsafe_name")
        .when(~well_formed, "invalid_stage")
        .when(F.col("__registered").isNull() & stage.isin("production", "archived"), "not_registered")
        .when((stage == "production") & ~F.coalesce(in_staging, F.lit(False)), "not_in_staging")
        .when(stage.isin("staging", "production") & ~gate, "gate_not_passed")
    )
    return (
        seen.withColumn("reason", reason)
        .withColumn("accepted", F.col("reason").isNull())
        .drop("__registered", "__settled", "__requested")
    )


def illegal_transitions(events: DataFrame) -> DataFrame:
    return judge_events(events).filter(~F.col("accepted")).drop("accepted")


def registry_state(events: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``(model, version, version_number, stage, registered_at, bundle_path)``.

    Versions count up in the order of registration. Promoting one archives the production
    version before it.
    """
    accepted = judge_events(events, rows_per_range).filter("accepted")
    place = F.struct(*ORDER)
    versions = accepted.groupBy("model", "version").agg(
        F.min(place).alias("first"),
        F.max(F.struct(*ORDER, "new_stage")).alias("last"),
        F.max(F.when(F.col("new_stage") == "production", place)).alias("promoted"),
    )
    promotions = versions.groupBy("model").agg(F.max("promoted").alias("latest"))
    staged = versions.join(promotions, "model").select(
        "model",
        "version",
        F.col("first.ts").alias("registered_at"),
        F.col("first.event_id").alias("registration"),
        F.when(
            (F.col("last.new_stage") == "production") & (F.col("promoted") < F.col("latest")),
            "archived",
        )
        .otherwise(F.col("last.new_stage"))
        .alias("stage"),
    )
    numbered = running(
        staged,
        ["registered_at", "registration"],
        sums={"version_number": F.lit(1).cast("bigint")},
        keys=["model"],
        edges=range_edges(events, ORDER[0], rows_per_range),
    )
    return numbered.select(
        "model",
        "version",
        "version_number",
        "stage",
        "registered_at",
        F.concat("model", F.lit("/v"), F.col("version_number").cast("string")).alias("bundle_path"),
    )


def production_model(state: DataFrame) -> DataFrame:
    """The production version of every model that has one."""
    return (
        state.filter(F.col("stage") == "production")
        .groupBy("model")
        .agg(
            F.max_by("version", "version_number").alias("version"),
            F.max("version_number").alias("version_number"),
        )
    )


def serving_eligibility(requested: DataFrame, state: DataFrame) -> DataFrame:
    """May a bundle path be served: exactly one entry has it, and that one is in production."""
    entries = state.groupBy("bundle_path").agg(
        F.count("*").alias("entries"), F.max("stage").alias("stage")
    )
    status = (
        F.when(~stays_inside(F.col("bundle_path")), "outside_registry")
        .when(F.col("entries").isNull(), "unknown")
        .when(F.col("entries") > 1, "ambiguous")
        .when(F.col("stage") != "production", "not_production")
        .otherwise("eligible")
    )
    return requested.join(bounded_side(entries), "bundle_path", "left").select(
        *requested.columns, status.alias("status")
    )
