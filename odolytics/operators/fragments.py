"""Trip features from summaries of stretches of a trip that can be combined.

A fragment sums up the rows of a trip between two points of its order: first and last row, counts, moments, sums, and
the smooth blocks that begin inside it. Neighbouring fragments combine by what their facing rows say about the step between
them; a block that is open at the end of one goes on in the next. So features of a growing trip need its fragments and the
new rows, not the rows it had before. Values are those of the training profile, whose rows look back one row only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odolytics import schema as S
from odolytics.functions import ordered
from odolytics.functions.columns import count_true
from odolytics.operators.kinematics import RAW, motion_parts, paired

SPREAD = ["speed", "accel_mag", "gyro_mag"]             # mean, deviation and largest value
ROW_FLAGS = {
    "over_80": "is_speed_over_80", "cruising": "is_cruising", "high_accel": "is_high_accel", "hard_turn": "is_hard_turn", "smooth": "is_smooth",
}
STEP_FLAGS = {"hard_brake": "is_hard_brake", "hard_accel": "is_hard_accel", "zigzag": "is_zigzag"}
STEP_SUMS = ["jerk_linear", "gyro_jerk_mag"]
SLOT = "slot"


def slot_of(width: int) -> Column:
    """Number of the stretch of time that a row lies in."""
    return F.floor(F.col(S.TIME) / F.lit(width)).cast("long")


def fold(sensor: DataFrame, slot: Column, tiebreak: Sequence[str] = (), hot_rows: int | None = ordered.HOT_ROWS) -> DataFrame:
    """Raw sensor rows -> one fragment per trip and slot. Hot stretches are cut like hot trips."""
    name = F.concat(F.col(S.KEY).cast("string"), F.lit(":"), F.coalesce(slot.cast("string"), F.lit("")))
    parts = motion_parts(sensor.withColumn(S.KEY, name), S.TRAINING, tiebreak, hot_rows)
    return ordered.union_all([_summed(p) for p in parts])


def _summed(rows: ordered.Ordered) -> DataFrame:
    inside = F.col("smooth_start") & F.col(f"prev_{S.TIME}").isNotNull()
    rows = rows.running(last={"since": F.when(inside, F.col(f"prev_{S.TIME}"))})
    order = [c for c in rows.order if c != ordered.COPY]
    place = F.struct(*rows.order)
    edge = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], *RAW, "is_smooth")
    held = F.col(S.TIME) - F.col("since")
    per = rows.df.groupBy(S.KEY).agg(
        F.min_by(edge, place).alias("first"), F.max_by(edge, place).alias("last"),
        F.count(F.lit(1)).alias("n_rows"), F.count(S.TIME).alias("n_points"), F.min(S.TIME).alias("low"), F.max(S.TIME).alias("high"),
        *[
            F.struct(
                F.count(c).alias("n"), F.coalesce(F.avg(c), F.lit(0.0)).alias("mean"),
                F.coalesce(F.var_pop(c) * F.count(c), F.lit(0.0)).alias("m2"), F.max(c).alias("max"),
            ).alias(c)
            for c in SPREAD
        ],
        *[count_true(F.col(flag)).alias(f"n_{n}") for n, flag in {**ROW_FLAGS, **STEP_FLAGS}.items()],
        *[F.sum(c).alias(f"sum_{c}") for c in STEP_SUMS],
        F.max(F.when(F.col("since").isNull(), F.col(S.TIME))).alias("head_high"),
        F.max(held).alias("longest"), F.max_by("since", place).alias("since"),
    )
    trip, slot = F.split(S.KEY, ":")[0].cast("long"), F.nullif(F.split(S.KEY, ":")[1], F.lit("")).cast("long")
    return per.withColumns({SLOT: slot, S.KEY: trip})


def combine(fragments: DataFrame, by: Sequence[str]) -> DataFrame:
    """Fragments that do not overlap in order -> one per group, as if its rows had been folded at once."""
    along = Window.partitionBy(*by).orderBy("first")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    rows = fragments.withColumn("before", F.lag("last").over(along))
    facing = paired(rows.withColumns(
        {**{c: F.col("first")[c] for c in RAW}, **{f"prev_{c}": F.col("before")[c] for c in RAW}, "__speed": F.col("speed"), "__accel": F.col("accel_mag"), "__gyro": F.col("gyro_mag")}
    ))
    joins = F.col("before").isNotNull()
    opened = F.when(joins & F.col("first.is_smooth") & ~F.col("before.is_smooth"), F.col("before")[S.TIME])
    rows = facing.withColumns(
        {
            **{f"step_{n}": F.when(joins, F.col(flag).cast("long")).otherwise(F.lit(0).cast("long")) for n, flag in STEP_FLAGS.items()},
            **{f"step_{c}": F.when(joins, F.col(c)).otherwise(F.lit(0.0)) for c in STEP_SUMS},
            "opened": opened,
        }
    ).withColumns({"speed": F.col("__speed"), "accel_mag": F.col("__accel"), "gyro_mag": F.col("__gyro")})
    newest = F.coalesce("since", "opened")
    rows = rows.withColumn("carried", F.coalesce("opened", F.last(newest, ignorenulls=True).over(earlier)))
    group = Window.partitionBy(*by)
    middle = {f"all_{c}": F.sum(F.col(c)["n"] * F.col(c)["mean"]).over(group) / F.nullif(F.sum(F.col(c)["n"]).over(group), F.lit(0)) for c in SPREAD}
    rows = rows.withColumns(middle)

    def spread(c: str) -> Column:
        n, mean, m2 = (F.col(c)[f] for f in ("n", "mean", "m2"))
        away = mean - F.col(f"all_{c}")
        return F.struct(
            F.sum(n).alias("n"), F.coalesce(F.max(f"all_{c}"), F.lit(0.0)).alias("mean"),
            F.coalesce(F.sum(m2 + n * away * away), F.lit(0.0)).alias("m2"), F.max(F.col(c)["max"]).alias("max"),
        ).alias(c)

    held = F.col("head_high") - F.col("carried")
    return rows.groupBy(*by).agg(
        F.min("first").alias("first"), F.max_by("last", "first").alias("last"),
        *[F.sum(c).alias(c) for c in ("n_rows", "n_points")], F.min("low").alias("low"), F.max("high").alias("high"),
        *[spread(c) for c in SPREAD],
        *[F.sum(f"n_{n}").alias(f"n_{n}") for n in ROW_FLAGS],
        *[F.sum(F.col(f"n_{n}") + F.col(f"step_{n}")).alias(f"n_{n}") for n in STEP_FLAGS],
        *[F.sum(F.col(f"sum_{c}") + F.col(f"step_{c}")).alias(f"sum_{c}") for c in STEP_SUMS],
        F.max(F.when(F.col("carried").isNull(), F.col("head_high"))).alias("head_high"),
        F.max(F.greatest("longest", held)).alias("longest"),
        F.max_by(newest, F.when(newest.isNotNull(), F.col("first"))).alias("since"),
    )


def features(whole: DataFrame) -> DataFrame:
    """One fragment per trip -> the trip's features."""
    n = F.col("n_rows").cast("double")

    def mean(c: str) -> Column:
        return F.when(F.col(c)["n"] > 0, F.col(c)["mean"])

    def deviation(c: str) -> Column:
        return F.when(F.col(c)["n"] > 1, F.sqrt(F.col(c)["m2"] / (F.col(c)["n"] - 1)))

    # A trip that begins smooth counts its first block from its first row.
    head = F.when(F.col("first.is_smooth"), F.col("head_high") - F.col("first")[S.TIME])
    made = {
        "trip_duration_sec": F.col("high") - F.col("low"), "n_points": F.col("n_points"),
        **{f"{c}_{name}": value for c in SPREAD for name, value in (("max", F.col(c)["max"]), ("mean", mean(c)), ("std", deviation(c)))},
        "pct_time_speed_over_80": F.col("n_over_80") / n, "pct_time_cruising": F.col("n_cruising") / n,
        "jerk_linear_mean": F.col("sum_jerk_linear") / n, "gyro_jerk_mag_mean": F.col("sum_gyro_jerk_mag") / n,
        "n_hard_accels": F.col("n_hard_accel"), "n_hard_brakes": F.col("n_hard_brake"), "n_hard_turns": F.col("n_hard_turn"),
        "n_zigzag_events": F.col("n_zigzag"), "pct_time_high_accel": F.col("n_high_accel") / n,
        "pct_time_high_gyro": F.col("n_hard_turn") / n, "pct_time_smooth": F.col("n_smooth") / n,
        "longest_smooth_segment_sec": F.coalesce(F.greatest("longest", head), F.lit(0)).cast("double"),
        "turn_sharpness_index": F.col("gyro_mag")["max"] / (mean("speed") + F.lit(S.TRAINING.thresholds.sharpness_eps)),
    }
    return whole.select(S.KEY, *[made[c].alias(c) for c in S.TRIP_FEATURES])
