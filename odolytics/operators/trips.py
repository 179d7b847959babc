"""One feature row per trip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odolytics import schema as S
from odolytics.functions import ordered
from odolytics.functions.columns import count_true, share
from odolytics.operators.kinematics import motion_parts


def _smooth_seconds(strict: bool) -> Column:
    """Longest smooth segment. ``strict`` counts smooth rows only; else a block keeps the rows that
    follow it up to the next block."""
    held = (F.col(S.TIME) - F.col("smooth_since")).cast("double")
    return F.coalesce(F.max(F.when(F.col("is_smooth"), held) if strict else held), F.lit(0.0))


def _measures(profile: S.MotionProfile, strict: bool) -> dict[str, Column]:
    shared = {
        "trip_duration_sec": F.max(S.TIME) - F.min(S.TIME),
        "n_points": F.count(S.TIME),
        "speed_max": F.max("speed"),
        "speed_mean": F.avg("speed"),
        "pct_time_speed_over_80": share(F.col("is_speed_over_80")),
        "jerk_linear_mean": F.avg("jerk_linear"),
        "pct_time_high_accel": share(F.col("is_high_accel")),
        "gyro_mag_std": F.stddev_samp("gyro_mag"),
        "gyro_jerk_mag_mean": F.avg("gyro_jerk_mag"),
    }
    if profile.name == S.SERVING.name:
        return shared
    return {
        **shared,
        "speed_std": F.stddev_samp("speed"),
        "pct_time_cruising": share(F.col("is_cruising")),
        "accel_mag_max": F.max("accel_mag"),
        "accel_mag_mean": F.avg("accel_mag"),
        "accel_mag_std": F.stddev_samp("accel_mag"),
        "n_hard_accels": count_true(F.col("is_hard_accel")),
        "n_hard_brakes": count_true(F.col("is_hard_brake")),
        "gyro_mag_max": F.max("gyro_mag"),
        "gyro_mag_mean": F.avg("gyro_mag"),
        "n_hard_turns": count_true(F.col("is_hard_turn")),
        "pct_time_high_gyro": share(F.col("is_hard_turn")),
        "n_zigzag_events": count_true(F.col("is_zigzag")),
        "longest_smooth_segment_sec": _smooth_seconds(strict),
        "pct_time_smooth": share(F.col("is_smooth")),
    }


def summarize(rows: DataFrame, profile: S.MotionProfile = S.TRAINING, strict_smooth: bool = False) -> DataFrame:
    """Motion rows -> trips. Partial sums are combined before any shuffle."""
    measures = _measures(profile, strict_smooth)
    per_trip = rows.groupBy(S.KEY).agg(*[c.alias(n) for n, c in measures.items()])
    sharpness = F.col(profile.sharpness_from) / (F.col("speed_mean") + F.lit(profile.thresholds.sharpness_eps))
    order = S.SERVING_FEATURES if profile.name == S.SERVING.name else S.TRIP_FEATURES
    return per_trip.withColumn("turn_sharpness_index", sharpness).select(S.KEY, *order)


def trip_features(
    sensor: DataFrame,
    profile: S.MotionProfile = S.TRAINING,
    tiebreak: Sequence[str] = (),
    hot_rows: int | None = ordered.HOT_ROWS,
    strict_smooth: bool = False,
) -> DataFrame:
    """Raw sensor rows -> one feature row per trip."""
    parts = motion_parts(sensor, profile, tiebreak, hot_rows)
    return ordered.union_all([summarize(p.df, profile, strict_smooth) for p in parts])


def trip_features_serving(sensor: DataFrame, tiebreak: Sequence[str] = (), **options) -> DataFrame:
    return trip_features(sensor, S.SERVING, tiebreak, **options)
