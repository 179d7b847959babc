"""Schemas, feature lists and thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

KEY = "bookingID"
TIME = "second"

# ---------------------------------------------------------------------------
# They must equal the published ones for results to match.
# ---------------------------------------------------------------------------

ACCEL_AXES = ["acceleration_x", "acceleration_y", "acceleration_z"]
GYRO_AXES = ["gyro_x", "gyro_y", "gyro_z"]
CHANNELS = ACCEL_AXES + GYRO_AXES

# Largest plausible |x| per channel (the 99.9 % quantile of the source data).
CHANNEL_LIMITS = {
    "acceleration_x": 9.886328100000092,
    "acceleration_y": 29.507823600011807,
    "acceleration_z": 13.291296400000132,
    "gyro_x": 1.5066820000000671,
    "gyro_y": 2.5858964800000144,
    "gyro_z": 1.8445167700000504,
}

MAX_SECOND = 21600
MAX_ACCURACY = 50.0

REQUIRED_COLUMNS = [
    "bookingID", "second", "speed",
    "acceleration_x", "acceleration_y", "acceleration_z",
    "gyro_x", "gyro_y", "gyro_z", "accuracy",
]

# The trip features in output order.
TRIP_FEATURES = [
    "trip_duration_sec", "n_points",
    "speed_max", "speed_mean", "speed_std", "pct_time_speed_over_80", "pct_time_cruising",
    "accel_mag_max", "accel_mag_mean", "accel_mag_std", "jerk_linear_mean",
    "n_hard_accels", "n_hard_brakes", "pct_time_high_accel",
    "gyro_mag_max", "gyro_mag_mean", "gyro_mag_std", "gyro_jerk_mag_mean",
    "n_hard_turns", "pct_time_high_gyro", "n_zigzag_events", "turn_sharpness_index",
    "longest_smooth_segment_sec", "pct_time_smooth",
]

# The features the serving model reads.
SERVING_FEATURES = [
    "trip_duration_sec", "speed_mean", "n_points", "gyro_mag_std", "speed_max",
    "jerk_linear_mean", "pct_time_speed_over_80", "gyro_jerk_mag_mean",
    "turn_sharpness_index", "pct_time_high_accel",
]

# Columns that are never model inputs.
NON_FEATURES = [
    "bookingID", "driver_id", "label", "is_dangerous",
    "id", "name", "date_of_birth", "gender",
    "car_brand", "car_model_year", "rating_bin", "exp_bin",
]

DRIVER_RENAMES = {
    "driver_id": "id",
    "driver_name": "name",
    "data_of_birth": "date_of_birth",
    "No_of_Years_driving_exp": "no_of_years_driving_exp",
    "driver_rating": "rating",
}

# Right-closed bins: (low, high] -> name.
RATING_BINS = [(1.0, 2.5, "Very Low"), (2.5, 3.5, "Low"), (3.5, 4.5, "Medium"), (4.5, 5.1, "High")]
EXPERIENCE_BINS = [(-1, 3, "<3"), (3, 5, "3-5"), (5, 10, "5-10"), (10, 20, "10-20"), (20, 60, "20+")]

PREDICTION_LABELS = {0: "SAFE", 1: "DANGEROUS"}
HISTORY_SIZE = 50


@dataclass(frozen=True)
class Thresholds:
    speed_over_80: float = 22.2
    cruise_min: float = 8.33
    cruise_max: float = 16.67
    accel_high: float = 12.0
    gyro_high: float = 1.0
    hard_brake: float = -5.0
    hard_accel: float = 5.0
    zigzag_gyro: float = 0.5
    zigzag_gap: float = 5.0
    rate_gap: float = 10.0
    smooth_accel: float = 2.0
    smooth_gyro: float = 0.5
    sharpness_eps: float = 0.001


# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class MotionProfile:
    """How missing axes, the first row and long gaps are read.

    The training form counts a missing axis as 0, gives the first row no time step and ignores speed
    changes over long gaps; the serving form fills readings forward, keeps a magnitude with a missing
    axis missing, and gives the first row one time unit.
    """

    name: str
    first_step: float
    missing_axis_zero: bool
    fill_forward: bool
    gap_limit: bool
    sharpness_from: str
    thresholds: Thresholds = field(default_factory=Thresholds)


TRAINING = MotionProfile("training", 0.0, True, False, True, "gyro_mag_max")
SERVING = MotionProfile("serving", 1.0, False, True, False, "gyro_mag_std")

SENSOR_SCHEMA = T.StructType(
    [
        T.StructField("bookingID", T.LongType()),
        T.StructField("second", T.LongType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("bearing", T.DoubleType()),
        T.StructField("speed", T.DoubleType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in CHANNELS]
)

LABEL_SCHEMA = T.StructType(
    [
        T.StructField("bookingID", T.LongType()),
        T.StructField("driver_id", T.LongType()),
        T.StructField("label", T.IntegerType()),
    ]
)

# As found in the raw driver file: everything that needs repair arrives as text.
DRIVER_RAW_SCHEMA = T.StructType(
    [
        T.StructField("driver_id", T.LongType()),
        T.StructField("driver_name", T.StringType()),
        T.StructField("data_of_birth", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("car_brand", T.StringType()),
        T.StructField("car_model_year", T.IntegerType()),
        T.StructField("driver_rating", T.StringType()),
        T.StructField("No_of_Years_driving_exp", T.StringType()),
    ]
)
