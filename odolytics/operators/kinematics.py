"""Per-second motion columns, from one sort of each trip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odolytics import schema as S
from odolytics.functions import ordered
from odolytics.functions.columns import flag, magnitude
from odolytics.operators import cleaning

RAW = [S.TIME, "speed", *S.CHANNELS]


def _mag(axes: Sequence[str], profile: S.MotionProfile, prefix: str = "") -> Column:
    cols = [F.col(prefix + a) for a in axes]
    if profile.missing_axis_zero:
        cols = [F.coalesce(c, F.lit(0.0)) for c in cols]
    return magnitude(cols)


def _change(column: str) -> Column:
    """Change since the previous row; 0 when either side is missing."""
    return F.coalesce(F.col(column) - F.col(f"prev_{column}"), F.lit(0.0))


def _jerk(axes: Sequence[str]) -> Column:
    """Size of the axis changes per time unit; 0 over no elapsed time."""
    step = F.nullif(F.col("delta_t"), F.lit(0.0))
    return magnitude([F.coalesce(_change(a) / step, F.lit(0.0)) for a in axes])


def _turn_sign(column: str, band: float) -> Column:
    """-1, 0 or 1: which side of the dead band around zero the reading lies on."""
    c = F.col(column)
    return F.when(c > F.lit(band), F.lit(1)).when(c < F.lit(-band), F.lit(-1)).otherwise(F.lit(0))


def _smooth(accel: Column, gyro: Column, t: S.Thresholds) -> Column:
    return flag((accel < F.lit(t.smooth_accel)) & (gyro < F.lit(t.smooth_gyro)))


def motion(rows: ordered.Ordered, profile: S.MotionProfile = S.TRAINING) -> ordered.Ordered:
    """Add every per-row motion column of the profile; one window specification for all of them."""
    if profile.fill_forward:
        rows = cleaning.forward_fill(rows)
    rows = rows.previous(RAW)
    df = paired(rows.df, profile)
    if profile.name != S.SERVING.name:
        rows = _smooth_blocks(rows.with_df(df))
        df = rows.df
    return rows.with_df(df)


def paired(df: DataFrame, profile: S.MotionProfile = S.TRAINING) -> DataFrame:
    """Motion columns that a row and the one before it (its readings as ``prev_...``) decide."""
    t = profile.thresholds
    df = df.withColumns(
        {
            "accel_mag": _mag(S.ACCEL_AXES, profile),
            "gyro_mag": _mag(S.GYRO_AXES, profile),
            "delta_t": F.coalesce(
                (F.col(S.TIME) - F.col(f"prev_{S.TIME}")).cast("double"), F.lit(profile.first_step)
            ),
            "delta_speed": _change("speed"),
        }
    )
    step = F.col("delta_t")
    if profile.gap_limit:
        rate = F.when((step > 0) & (step <= t.rate_gap), F.col("delta_speed") / F.nullif(step, F.lit(0.0)))
    else:
        rate = F.col("delta_speed") / F.nullif(step, F.lit(0.0))
    df = df.withColumns(
        {
            "speed_rate": F.coalesce(rate, F.lit(0.0)),
            "jerk_linear": _jerk(S.ACCEL_AXES),
            "gyro_jerk_mag": _jerk(S.GYRO_AXES),
            "is_speed_over_80": flag(F.col("speed") > F.lit(t.speed_over_80)),
            "is_high_accel": flag(F.col("accel_mag") > F.lit(t.accel_high)),
        }
    )
    return df if profile.name == S.SERVING.name else _driving_events(df, profile)


def _driving_events(df: DataFrame, profile: S.MotionProfile) -> DataFrame:
    t = profile.thresholds
    sign, before = _turn_sign("gyro_y", t.zigzag_gyro), _turn_sign("prev_gyro_y", t.zigzag_gyro)
    has_previous = F.col(f"prev_{S.TIME}").isNotNull()
    smooth = _smooth(F.col("accel_mag"), F.col("gyro_mag"), t)
    smooth_before = has_previous & _smooth(
        _mag(S.ACCEL_AXES, profile, "prev_"), _mag(S.GYRO_AXES, profile, "prev_"), t
    )
    return df.withColumns(
        {
            "is_cruising": flag(F.col("speed").between(F.lit(t.cruise_min), F.lit(t.cruise_max))),
            "is_hard_turn": flag(F.col("gyro_mag") > F.lit(t.gyro_high)),
            "is_hard_brake": F.col("speed_rate") < F.lit(t.hard_brake),
            "is_hard_accel": F.col("speed_rate") > F.lit(t.hard_accel),
            "gyro_y_sign": sign,
            "is_zigzag": (sign * before == F.lit(-1)) & (F.col("delta_t") <= F.lit(t.zigzag_gap)),
            "is_smooth": smooth,
            "smooth_start": smooth & ~smooth_before,
        }
    )


def _smooth_blocks(rows: ordered.Ordered) -> ordered.Ordered:
    """Number the smooth blocks and mark the time each one counts from.

    A block runs from its first smooth row up to the next block. Its time steps add up to "now minus
    the time of the row before the block", so the running maximum needs no second grouping or sort.
    """
    start = F.col("smooth_start")
    since = F.when(start, F.coalesce(F.col(f"prev_{S.TIME}"), F.col(S.TIME)))
    return rows.running(sums={"smooth_block": start.cast("long")}, last={"smooth_since": since})


def motion_parts(
    sensor: DataFrame,
    profile: S.MotionProfile = S.TRAINING,
    tiebreak: Sequence[str] = (),
    hot_rows: int | None = ordered.HOT_ROWS,
) -> list[ordered.Ordered]:
    """Clean, then add motion columns: ordinary trips, and hot trips (if any) in ranges."""
    clean = cleaning.clean_sensor(sensor).where(F.col(S.KEY).isNotNull())
    rows, order = ordered.by_time(
        clean.select(S.KEY, S.TIME, *tiebreak, *cleaning.READINGS), S.TIME, tiebreak, cleaning.READINGS
    )
    parts = ordered.split_by_size(rows, [S.KEY], order, hot_rows)
    return [motion(p, profile) for p in parts]


def kinematics(
    sensor: DataFrame,
    profile: S.MotionProfile = S.TRAINING,
    tiebreak: Sequence[str] = (),
    hot_rows: int | None = ordered.HOT_ROWS,
) -> DataFrame:
    """All per-row motion columns of raw sensor rows."""
    return ordered.union_all([p.rows() for p in motion_parts(sensor, profile, tiebreak, hot_rows)])
