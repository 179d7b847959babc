"""Splits, imputation, scaling, class weights and oversampling before training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odolytics import schema as S
from odolytics.functions import ordered
from odolytics.functions.columns import broadcast_if_small
from odolytics.functions.quantiles import quantile_values
from odolytics.session import cut_lineage

SEED = 42


HASH_SPAN = 2147483648


# Multipliers of the two rounds, and those that bring in the seed and the upper half of the number.
MIXERS = (1103515245, 1597334677)
SEED_MIXER, UPPER_MIXER = 374761393, 668265263


def row_hash(key: str | Column, seed: int = SEED) -> Column:
    """A repeatable shuffle number below ``HASH_SPAN`` from plain integer arithmetic, which SQL can repeat.

    The seed and both halves of a 64-bit number go in first; two rounds of shift, exclusive or and multiply
    carry every bit to the high ones. Take slices from the high bits (see ``slice_of``).
    """
    mask = F.lit(HASH_SPAN - 1)
    value = (F.col(key) if isinstance(key, str) else key).cast("long")
    upper = F.shiftright(value, 31).bitwiseAND(mask) * F.lit(UPPER_MIXER)
    x = value.bitwiseAND(mask).bitwiseXOR((upper + F.lit(seed * SEED_MIXER)).bitwiseAND(mask))
    for shift, by in zip((16, 13), MIXERS):
        x = (x.bitwiseXOR(F.shiftright(x, shift)) * F.lit(by)).bitwiseAND(mask)
    return x.bitwiseXOR(F.shiftright(x, 15))


def slice_of(key: str | Column, slices: str | Column, seed: int = SEED) -> Column:
    """One of ``slices`` equal shares of the hash range."""
    n = F.col(slices) if isinstance(slices, str) else slices
    return F.floor(row_hash(key, seed) * n / F.lit(HASH_SPAN)).cast("int")


def stratum_position(
    df: DataFrame, key: str, label: str, seed: int = SEED, rows_per_task: int = ordered.HOT_ROWS
) -> DataFrame:
    """Add each row's 1-based place in its class in shuffled order, and the size of the class."""
    shuffled = df.withColumn("__shuffle", row_hash(key, seed)).withColumn("__one", F.lit(1).cast("long"))
    placed = ordered.whole_order(shuffled, ["__shuffle", key], [label], rows_per_task).running(
        sums={"position": F.col("__one")}
    ).rows()
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("class_rows"))
    return placed.drop("__shuffle", "__one").join(broadcast_if_small(sizes), label)


BUCKET_BITS = 15        # of the 31 bits of the shuffle number; one bucket in 32,768 is ranked row by row


def split_points(hashed: DataFrame, key: str, label: str, shares: Sequence[float]) -> DataFrame:
    """Per class the (shuffle number, key) of the last row within each share of its rows, in shuffled order.

    Rows are counted by class and bucket of the shuffle number; only the bucket in which a share ends is ranked.
    """
    bucket = F.shiftright("__shuffle", 31 - BUCKET_BITS)
    counts = hashed.groupBy(label, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    across = Window.partitionBy(label)      # at most 32,768 rows per class
    running = counts.withColumn("upto", F.sum("n").over(across.orderBy("bucket"))).withColumn("class_rows", F.sum("n").over(across))
    ends = running.withColumn("share", F.explode(F.array(*[F.lit(float(x)) for x in shares]))).withColumn(
        "position", F.floor(F.col("class_rows") * F.col("share") / 10).cast("long")
    )
    ends = ends.where("position > upto - n AND position <= upto").select(
        label, "bucket", "share", (F.col("position") - F.col("upto") + F.col("n")).alias("within")
    )
    inside = hashed.select(label, "__shuffle", F.col(key).alias("__key"), bucket.alias("bucket")).join(
        broadcast_if_small(cut_lineage(ends)), [label, "bucket"]
    )
    place = F.row_number().over(Window.partitionBy(label, "share").orderBy("__shuffle", "__key"))
    return inside.withColumn("place", place).where("place = within").select(
        label, "share", F.struct(F.col("__shuffle"), F.col("__key")).alias("last")
    )


def stratified_split(df: DataFrame, key: str = S.KEY, label: str = "label", seed: int = SEED) -> DataFrame:
    """Exact 60/20/20 split inside each class, in a ``split`` column.

    No row is sorted or moved: two passes find where the shares end, and every row is compared with those points.
    Rows without a class are left out. Give it written rows, not a long plan.
    """
    hashed = df.withColumn("__shuffle", row_hash(key, seed))
    points = split_points(hashed, key, label, (6.0, 8.0)).groupBy(label).agg(
        F.max(F.when(F.col("share") == 6.0, F.col("last"))).alias("__train"),
        F.max(F.when(F.col("share") == 8.0, F.col("last"))).alias("__val"),
    )
    # A class of one row has no point at all: everything is test.
    here = F.struct(F.col("__shuffle"), F.col(key).alias("__key"))
    split = F.when(here <= F.col("__train"), F.lit("train")).when(here <= F.col("__val"), F.lit("val")).otherwise(F.lit("test"))
    classed = hashed.where(F.col(label).isNotNull())
    return classed.join(broadcast_if_small(cut_lineage(points)), label, "left").withColumn("split", split).drop(
        "__shuffle", "__train", "__val"
    )


def stratified_folds(
    df: DataFrame, folds: int = 3, key: str = S.KEY, label: str = "label", seed: int = SEED
) -> DataFrame:
    return (
        stratum_position(df, key, label, seed)
        .withColumn("fold", F.pmod(F.col("position"), F.lit(folds)).cast("int"))
        .drop("position", "class_rows")
    )


def impute_median(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Fill missing values with the exact medians of the fitting rows."""
    medians = quantile_values(df if fit_on is None else fit_on, columns, [0.5])
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c, 0.5])) for c in columns})


def scaling(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column (deviation 1 for a constant one)."""
    wide = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).first()
    return {c: (wide[c]["m"] or 0.0, wide[c]["s"] or 1.0) for c in columns}


def standard_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    fitted = scaling(df if fit_on is None else fit_on, columns)
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in fitted.items()})


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Per class: balanced weight n / (classes * n_class), and safe / dangerous for the positive scale."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    totals = counts.agg(
        F.sum("n_rows").alias("n"), F.count(F.lit(1)).alias("k"),
        F.sum(F.when(F.col(label) == 0, F.col("n_rows"))).alias("n0"),
        F.sum(F.when(F.col(label) == 1, F.col("n_rows"))).alias("n1"),
    ).first()
    positive_scale = totals["n0"] / totals["n1"] if totals["n0"] and totals["n1"] else None
    return counts.select(
        F.col(label).alias("label"), "n_rows",
        (F.lit(float(totals["n"])) / (F.lit(totals["k"]) * F.col("n_rows"))).alias("balanced_weight"),
        F.lit(positive_scale).cast("double").alias("positive_scale"),
    )


def add_class_weights(df: DataFrame, label: str = "label", weight: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(F.col("label").alias(label), F.col("balanced_weight").alias(weight))
    return df.join(broadcast_if_small(weights), label)
