"""Row filters and repairs on sensor, label and driver tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odolytics import schema as S
from odolytics.functions import ordered
from odolytics.functions.columns import nan_to_null, right_closed_bins
from odolytics.functions.quantiles import exact_quantiles

READINGS = [*S.CHANNELS, "speed"]


def drop_null_keys(df: DataFrame, keys: Sequence[str] = (S.KEY, S.TIME)) -> DataFrame:
    return df.na.drop(subset=list(keys))


def nulls_normalize(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column; NaN would compare as larger than any threshold."""
    return df.select(
        *[nan_to_null(F.col(n)).alias(n) if t in ("double", "float") else F.col(n) for n, t in df.dtypes]
    )


def filter_rows(df: DataFrame) -> DataFrame:
    """Keep rows within the longest trip and with known-good or unknown accuracy."""
    return df.where(
        (F.col(S.TIME) <= S.MAX_SECOND)
        & (F.col("accuracy").isNull() | (F.col("accuracy") <= S.MAX_ACCURACY))
    )


def null_negative_speed(df: DataFrame) -> DataFrame:
    return df.withColumn("speed", F.when(F.col("speed") >= 0, F.col("speed")))


def null_outliers(df: DataFrame, limits: Mapping[str, float] = S.CHANNEL_LIMITS) -> DataFrame:
    return df.withColumns({c: F.when(F.abs(c) <= F.lit(lim), F.col(c)) for c, lim in limits.items()})


def derive_limits(df: DataFrame, columns: Sequence[str] = tuple(S.CHANNELS), q: float = 0.999) -> DataFrame:
    """The quantile of |x| per channel, for choosing outlier limits on new data."""
    sizes = df.select(*[F.abs(c).alias(c) for c in columns])
    return exact_quantiles(sizes, columns, [q]).select("feature", F.col("value").alias("limit_value"))


def clean_sensor(df: DataFrame, limits: Mapping[str, float] = S.CHANNEL_LIMITS) -> DataFrame:
    return df.transform(filter_rows).transform(null_negative_speed).transform(null_outliers, limits)


def forward_fill(rows: ordered.Ordered, columns: Sequence[str] = tuple(READINGS)) -> ordered.Ordered:
    return rows.running(last={c: F.col(c) for c in columns})


def fill_forward(
    df: DataFrame, tiebreak: Sequence[str] = (), hot_rows: int | None = ordered.HOT_ROWS
) -> DataFrame:
    """Carry each reading forward inside its trip."""
    rows, order = ordered.by_time(df.where(F.col(S.KEY).isNotNull()), S.TIME, tiebreak, READINGS)
    parts = ordered.split_by_size(rows, [S.KEY], order, hot_rows)
    return ordered.union_all([forward_fill(p).rows() for p in parts])


def clean_sensor_serving(
    df: DataFrame, tiebreak: Sequence[str] = (), hot_rows: int | None = ordered.HOT_ROWS
) -> DataFrame:
    return fill_forward(clean_sensor(df), tiebreak, hot_rows)


def clean_labels(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.col("label").cast("int")).withColumn("is_dangerous", F.col("label") == 1)


def driver_age(as_of: dt.date, born: str = "date_of_birth") -> Column:
    return F.floor(F.datediff(F.lit(as_of), F.col(born)) / F.lit(365)).cast("int")


def rating_bin(column: str = "rating") -> Column:
    return right_closed_bins(F.col(column), S.RATING_BINS)


def experience_bin(column: str = "no_of_years_driving_exp") -> Column:
    return right_closed_bins(F.col(column), S.EXPERIENCE_BINS)


def repair_driver_types(raw: DataFrame) -> DataFrame:
    """Raw driver text to typed columns; a value that does not parse becomes NULL."""
    named = raw.withColumnsRenamed(S.DRIVER_RENAMES)
    return named.withColumns(
        {
            "date_of_birth": F.try_to_timestamp(F.col("date_of_birth"), F.lit("MM/dd/yyyy")).cast("date"),
            "rating": F.col("rating").try_cast("double"),
            "no_of_years_driving_exp": F.col("no_of_years_driving_exp").try_cast("int"),
        }
    )


def clean_drivers(df: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Typed drivers with age in whole years and the two binned columns."""
    day = as_of or dt.date.today()
    return df.withColumns(
        {
            "date_of_birth": F.col("date_of_birth").cast("date"),
            "rating": F.col("rating").cast("double"),
            "no_of_years_driving_exp": F.col("no_of_years_driving_exp").cast("int"),
        }
    ).withColumns({"age": driver_age(day), "rating_bin": rating_bin(), "exp_bin": experience_bin()})


def select_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    present = set(df.columns)
    return df.select(*[c for c in wanted if c in present])


def feature_names(df: DataFrame, exclude: Sequence[str] = tuple(S.NON_FEATURES)) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


# Name part -> group; a feature belongs to every group whose part its name holds.
FEATURE_GROUPS = ["speed", "accel", "gyro", "jerk", "smooth"]
DRIVER_FEATURES = ["rating", "no_of_years_driving_exp", "age"]


def feature_catalog(df: DataFrame) -> DataFrame:
    """(feature, category, n_values) for the model inputs found in the schema, from one scan."""
    names = feature_names(df)
    wide = df.agg(*[F.count(c).alias(c) for c in names])
    structs = [
        F.struct(F.lit(name).alias("feature"), F.lit(group).alias("category"), F.col(name).alias("n_values"))
        for name in names
        for group in [g for g in FEATURE_GROUPS if g in name.lower()]
        + (["driver"] if name in DRIVER_FEATURES else [])
    ]
    return wide.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.fill(0, subset=list(columns))


def select_trip(df: DataFrame, booking_id) -> DataFrame:
    return df.where(F.col(S.KEY) == F.lit(booking_id))


def list_trips(df: DataFrame) -> DataFrame:
    return df.select(S.KEY).distinct()


# name -> expression over trip features
INTERACTIONS = {
    "speed_risk_score": lambda: F.col("speed_max") * F.col("pct_time_speed_over_80"),
    "accel_risk_score": lambda: F.col("accel_mag_max") * F.col("n_hard_accels"),
    "turn_risk_score": lambda: F.col("turn_sharpness_index") * F.col("n_hard_turns"),
    "jerk_to_speed_ratio": lambda: F.col("jerk_linear_mean") / (F.col("speed_mean") + F.lit(0.001)),
    "smooth_to_total_ratio": lambda: F.col("longest_smooth_segment_sec") / (F.col("trip_duration_sec") + F.lit(1.0)),
    "gyro_accel_instability": lambda: F.col("gyro_mag_std") * F.col("accel_mag_std"),
}


def interaction_features(features: DataFrame) -> DataFrame:
    return features.withColumns({name: make() for name, make in INTERACTIONS.items()})
