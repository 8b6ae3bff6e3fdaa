"""Exact stratified splits and folds without sorting or shuffling the rows.

Rows of a class are ranked by a seeded hash of their id; a split is "the first so many rows of
each class". Only the key at which each class is cut has to be found:

1. count rows per (class, first four hex digits of the key): at most 65,536 cells per class,
   combined map-side;
2. running totals over the cells tell in which cell each cut falls;
3. only the rows of those cells (about 1/65,536 of a class) are ranked to find the cut key;
4. every row compares its key with the cut keys of its class, a map-only step.

The result equals ``row_number() over (partition by label order by key)``, at any class skew.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigate.functions.hashing import seeded_key
from lexigate.operators.scale import bounded_side

CELL_DIGITS = 4


class SplitError(ValueError):
    """The rows cannot be split as asked."""


def _fraction(size: float) -> Fraction:
    # from the decimal spelling: 0.1 means one tenth, not the nearest binary fraction
    return Fraction(str(size))


def class_counts(df: DataFrame, label_column: str) -> DataFrame:
    return df.groupBy(F.col(label_column).alias("label")).agg(F.count("*").alias("n"))


def _check_classes(classes: DataFrame, smallest_allowed: int = 2) -> None:
    row = classes.agg(
        F.min("n").alias("smallest"), F.count_if(F.col("label").isNull()).alias("unlabelled")
    ).first()
    if row["smallest"] is None:
        raise SplitError("There are no rows to split")
    if row["unlabelled"]:
        raise SplitError("Rows without a label cannot be stratified")
    if row["smallest"] < smallest_allowed:
        raise SplitError(
            f"The smallest class has {row['smallest']} row(s); at least {smallest_allowed} needed"
        )


def stratified_quota(classes: DataFrame, size: Fraction, counts: str, name: str) -> DataFrame:
    """Add ``name``: how many of the ``ceil(size * total)`` drawn rows each class gives.

    Whole shares first, leftover rows to the largest fractional parts, ties to the smallest
    label. All in whole numbers. ``classes`` has one row per class.
    """
    total = classes.agg(F.sum(counts).cast("decimal(19,0)")).scalar()
    p, q = size.numerator, size.denominator
    wide = classes.withColumn("__total", total).withColumn(
        "__draw", F.expr(f"cast((cast(__total as decimal(19,0)) * {p} + {q - 1}) div {q} as decimal(19,0))")
    )
    shares = wide.withColumn(
        "__product", (F.col("__draw") * F.col(counts).cast("decimal(19,0)")).cast("decimal(38,0)")
    ).select(
        *classes.columns,
        "__draw",
        F.expr("cast(__product div __total as bigint)").alias("__whole"),
        F.expr("__product % __total").alias("__rest"),
    )
    everything = Window.orderBy(F.col("__rest").desc(), F.col("label"))
    whole_total = F.sum("__whole").over(Window.partitionBy())
    return shares.select(
        *classes.columns,
        (
            F.col("__whole")
            + F.when(F.row_number().over(everything) <= F.col("__draw") - whole_total, 1).otherwise(
                0
            )
        )
        .cast("bigint")
        .alias(name),
    )


def split_quotas(classes: DataFrame, test_size: float, validation_size: float) -> DataFrame:
    """``(label, n, n_test, n_validation)``; the validation share is one of the whole table."""
    test = _fraction(test_size)
    rest = _fraction(validation_size) / (1 - test)
    quotas = stratified_quota(classes, test, "n", "n_test").withColumn(
        "__left", F.col("n") - F.col("n_test")
    )
    return stratified_quota(quotas, rest, "__left", "n_validation").drop("__left")


def cut_keys(df: DataFrame, targets: DataFrame) -> DataFrame:
    """Key of the row at each wanted rank.

    ``df`` has ``label`` and ``__key``; ``targets`` has ``(label, cut, target)``. The result has
    ``(label, cut, cut_key)``; a target of 0 has the empty key, which no row is at or below.
    """
    cell = F.substring("__key", 1, CELL_DIGITS)
    cells = df.groupBy("label", cell.alias("cell")).agg(F.count("*").alias("n"))
    # at most 65,536 rows per class
    upto = F.sum("n").over(
        Window.partitionBy("label").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = (
        cells.withColumn("upto", upto)
        .join(targets, "label")
        .filter((F.col("target") > F.col("upto") - F.col("n")) & (F.col("target") <= F.col("upto")))
        .select("label", "cell", "cut", (F.col("target") - F.col("upto") + F.col("n")).alias("nth"))
    )
    candidates = df.select("label", "__key", cell.alias("cell")).join(
        bounded_side(placed), ["label", "cell"]
    )
    rank = F.row_number().over(Window.partitionBy("label", "cell", "cut").orderBy("__key"))
    found = (
        candidates.withColumn("rank", rank)
        .filter(F.col("rank") == F.col("nth"))
        .select("label", "cut", F.col("__key").alias("cut_key"))
    )
    return targets.select("label", "cut").join(found, ["label", "cut"], "left").select(
        "label", "cut", F.coalesce("cut_key", F.lit("")).alias("cut_key")
    )


def _with_cuts(df: DataFrame, label_column: str, key: Column, targets: DataFrame) -> DataFrame:
    """Add ``__key`` and ``__cuts``, the sorted cut keys of the row's class."""
    keyed = df.withColumn("__key", key)
    cuts = (
        cut_keys(
            keyed.select(F.col(label_column).alias("label"), "__key"), bounded_side(targets)
        )
        .groupBy("label")
        .agg(F.sort_array(F.collect_list(F.struct("cut", "cut_key"))).alias("__cuts"))
        .select(F.col("label").alias("__label"), F.col("__cuts.cut_key").alias("__cuts"))
    )
    return keyed.join(
        bounded_side(cuts), keyed[label_column] == F.col("__label"), "inner"
    ).drop("__label")


def assign_splits(
    df: DataFrame,
    label_column: str = "sentiment",
    id_column: str = "row_id",
    test_size: float = 0.2,
    validation_size: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Add ``split``: test, validation or train, with exact stratified sizes from one seed."""
    classes = bounded_side(class_counts(df, label_column))
    _check_classes(classes)
    quotas = split_quotas(classes, test_size, validation_size)
    targets = quotas.select(
        "label",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("cut"), F.col("n_test").alias("target")),
                F.struct(
                    F.lit(1).alias("cut"),
                    (F.col("n_test") + F.col("n_validation")).alias("target"),
                ),
            )
        ).alias("t"),
    ).select("label", "t.*")
    keyed = _with_cuts(df, label_column, seeded_key(seed, F.col(id_column)), targets)
    split = (
        F.when(F.col("__key") <= F.col("__cuts")[0], "test")
        .when(F.col("__key") <= F.col("__cuts")[1], "validation")
        .otherwise("train")
    )
    return keyed.withColumn("split", split).drop("__key", "__cuts")


def three_way_split(
    df: DataFrame,
    label_column: str = "sentiment",
    id_column: str = "row_id",
    test_size: float = 0.2,
    validation_size: float = 0.2,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test frames."""
    assigned = assign_splits(df, label_column, id_column, test_size, validation_size, seed)
    train, validation, test = (
        assigned.filter(F.col("split") == name).drop("split")
        for name in ("train", "validation", "test")
    )
    return train, validation, test


def assign_folds(
    df: DataFrame,
    label_column: str = "sentiment",
    id_column: str = "row_id",
    folds: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Add ``fold`` (0 to folds-1), stratified and seeded.

    Class sizes per fold are those of dealing the rows, sorted by label, to the folds in turn.
    """
    classes = bounded_side(class_counts(df, label_column))
    _check_classes(classes, folds)
    # one row per class
    start = F.coalesce(
        F.sum("n").over(Window.orderBy("label").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    dealt = classes.withColumn("start", start).withColumn(
        "cut", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))
    )
    # positions start..start+n-1 that are congruent to the fold number
    def upto(position: Column) -> Column:
        return F.floor((position - F.col("cut")).cast("double") / folds)

    size = (upto(F.col("start") + F.col("n") - 1) - upto(F.col("start") - 1)).cast("bigint")
    running_size = F.sum("size").over(
        Window.partitionBy("label").orderBy("cut").rowsBetween(Window.unboundedPreceding, 0)
    )
    targets = dealt.withColumn("size", size).select(
        "label", "cut", running_size.alias("target")
    )
    keyed = _with_cuts(df, label_column, seeded_key(seed, F.col(id_column)), targets)
    fold = F.size(F.filter("__cuts", lambda cut: F.col("__key") > cut))
    return keyed.withColumn("fold", fold).drop("__key", "__cuts")


def split_sizes(assigned: DataFrame, label_column: str = "sentiment") -> DataFrame:
    return assigned.groupBy("split", F.col(label_column).alias("label")).agg(
        F.count("*").alias("n")
    )


def split_overlap(
    parts: dict[str, DataFrame], whole: DataFrame, id_column: str = "row_id"
) -> DataFrame:
    """Row counts of the pairwise intersections, and of what the union misses or adds.

    One pass: every id carries how often each part and the whole have it. Intersections count
    ids, the last two count rows.
    """
    names = sorted(parts)
    sides = [(name, parts[name]) for name in names] + [(None, whole)]
    tagged = None
    for name, frame in sides:
        one = frame.select(
            F.col(id_column).alias("id"),
            *[F.lit(int(other == name)).alias(f"in_{i}") for i, other in enumerate([*names, None])],
        )
        tagged = one if tagged is None else tagged.unionByName(one)
    held = [f"in_{i}" for i in range(len(sides))]
    per_id = tagged.groupBy("id").agg(*[F.sum(c).alias(c) for c in held])
    union = sum((F.col(c) for c in held[1:-1]), F.col(held[0]))
    missed = F.col(held[-1]) - union
    counts = {
        f"{left}&{names[j]}": F.count_if((F.col(held[i]) > 0) & (F.col(held[j]) > 0))
        for i, left in enumerate(names)
        for j in range(i + 1, len(names))
    }
    for name, excess in (("whole-union", missed), ("union-whole", -missed)):
        counts[name] = F.coalesce(F.sum(F.greatest(excess, F.lit(0))), F.lit(0))
    cells = [
        F.struct(F.lit(name).alias("relation"), F.col(f"r_{i}").alias("n"))
        for i, name in enumerate(counts)
    ]
    totals = per_id.agg(*[count.alias(f"r_{i}") for i, count in enumerate(counts.values())])
    return totals.select(F.inline(F.array(*cells)))
