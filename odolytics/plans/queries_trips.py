"""Per-second motion, trip features, and the report table."""

from __future__ import annotations

from pyspark.sql import functions as F

from odolytics import schema as S
from odolytics.operators import keys, kinematics, trips
from odolytics.plans import etl
from odolytics.plans import oracle_parts as P
from odolytics.plans.queries_ingest import AS_OF, FEATURE_ROWS, MASTER, sensor
from odolytics.plans.registry import query, rounded, sql_rounded
from odolytics.session import cut_lineage
from odolytics.sources import fixtures as X

ROW = ["bookingID", "event_id"]


def _motion(spark, folder, profile=S.TRAINING):
    return kinematics.kinematics(sensor(spark, folder), profile, X.TIEBREAK)


def _sql(columns, doubles, source="kin", ctes=P.KIN):
    parts = ['"bookingID"', "event_id", *[sql_rounded(c) if c in doubles else c for c in columns]]
    return f"WITH {ctes} SELECT {', '.join(parts)} FROM {source}"


DOUBLES = ["delta_t", "delta_speed", "speed_rate", "accel_mag", "gyro_mag", "jerk_linear", "gyro_jerk_mag"]
FLAGS = ["is_speed_over_80", "is_cruising", "is_high_accel", "is_hard_turn", "is_hard_brake", "is_hard_accel"]
PARTS = {
    "kin_delta_t": ["delta_t"],
    "kin_delta_speed": ["delta_speed"],
    "kin_speed_rate": ["speed_rate"],
    "kin_magnitudes": ["accel_mag", "gyro_mag"],
    "kin_flags": FLAGS,
    "kin_linear_jerk": ["jerk_linear"],
    "kin_gyro_jerk": ["gyro_jerk_mag"],
    "kin_zigzag": ["gyro_y_sign", "is_zigzag"],
    "kin_smooth_flag": ["is_smooth"],
    "kin_smooth_blocks": ["smooth_block"],
    "kinematics": [*DOUBLES, *FLAGS, "gyro_y_sign", "is_zigzag", "is_smooth", "smooth_block"],
}


def _register(name, columns):
    @query(name, _sql(columns, DOUBLES))
    def run(spark, folder):
        return rounded(_motion(spark, folder).select(*ROW, *columns))


for _name, _columns in PARTS.items():
    _register(_name, _columns)

SERVING_COLUMNS = ["accel_mag", "gyro_mag", "delta_t", "speed_rate", "jerk_linear", "gyro_jerk_mag", "is_speed_over_80", "is_high_accel"]


@query("kinematics_serving", _sql(SERVING_COLUMNS, DOUBLES, "skin", P.SERVING_KIN))
def kinematics_serving(spark, folder):
    return rounded(_motion(spark, folder, S.SERVING).select(*ROW, *SERVING_COLUMNS))


@query(
    "longest_smooth_segment",
    f'WITH {P.FEATURES} SELECT "bookingID", {P.r("longest_smooth_segment_sec")} FROM features',
)
def longest_smooth_segment(spark, folder):
    features = trips.trip_features(sensor(spark, folder), tiebreak=X.TIEBREAK)
    return rounded(features.select("bookingID", "longest_smooth_segment_sec"))


@query(
    "longest_smooth_segment_strict",
    f"""WITH {P.KIN}, held AS (SELECT "bookingID", smooth_block, sum(delta_t) AS held FROM kin WHERE is_smooth GROUP BY 1, 2),
    best AS (SELECT "bookingID", max(held) AS held FROM held GROUP BY 1)
    SELECT "bookingID", coalesce(held, 0.0::DOUBLE) AS longest_smooth_segment_sec
    FROM (SELECT DISTINCT "bookingID" FROM kin) LEFT JOIN best USING ("bookingID")""",
)
def longest_smooth_segment_strict(spark, folder):
    features = trips.trip_features(sensor(spark, folder), tiebreak=X.TIEBREAK, strict_smooth=True)
    return features.select("bookingID", "longest_smooth_segment_sec")


@query("trip_features", FEATURE_ROWS)
def trip_features(spark, folder):
    return rounded(trips.trip_features(sensor(spark, folder), tiebreak=X.TIEBREAK))


SERVING_ROWS = f'WITH {P.SERVING_FEATURES} SELECT "bookingID", {{}} FROM sfeatures'.format(
    ", ".join(f if f in ("trip_duration_sec", "n_points") else sql_rounded(f) for f in S.SERVING_FEATURES)
)


@query("trip_features_serving", SERVING_ROWS)
def trip_features_serving(spark, folder):
    return rounded(trips.trip_features_serving(sensor(spark, folder), X.TIEBREAK))


@query(
    "turn_sharpness",
    f"""WITH {P.FEATURES}, s AS (SELECT "bookingID", stddev_samp(gyro_mag) / (avg(speed) + 0.001::DOUBLE) AS spread_form
      FROM kin GROUP BY 1)
    SELECT "bookingID", {P.r("turn_sharpness_index")}, {P.r("spread_form")} FROM features JOIN s USING ("bookingID")""",
)
def turn_sharpness(spark, folder):
    features = trips.trip_features(sensor(spark, folder), tiebreak=X.TIEBREAK)
    spread = F.col("gyro_mag_std") / (F.col("speed_mean") + F.lit(S.Thresholds().sharpness_eps))
    return rounded(features.select("bookingID", "turn_sharpness_index", spread.alias("spread_form")))


@query(
    "features_from_any_stage",
    f"""WITH {P.SERVING_FEATURES}, given AS (SELECT unnest(['raw', 'ready']) AS given)
    SELECT given, "bookingID", {", ".join(
        f if f in ("trip_duration_sec", "n_points") else sql_rounded(f) for f in S.SERVING_FEATURES)}
    FROM sfeatures, given""",
)
def features_from_any_stage(spark, folder):
    raw = etl.features_from_any_stage(sensor(spark, folder).withColumnRenamed("bookingID", "booking_id"), X.TIEBREAK)
    ready = etl.features_from_any_stage(X.features_ready(spark, folder).withColumnRenamed("bookingID", "BookingID"))
    return rounded(raw.withColumn("given", F.lit("raw")).unionByName(ready.withColumn("given", F.lit("ready"))))


# Joins ---------------------------------------------------------------------------

@query(
    "join_labels_features",
    f"""WITH {P.FEATURES}, {P.LABEL} SELECT l."bookingID", driver_id, label, n_points, trip_duration_sec, {sql_rounded("speed_mean")}
    FROM safety_label l LEFT JOIN features f USING ("bookingID")""",
)
def join_labels_features(spark, folder):
    features = trips.trip_features(sensor(spark, folder), tiebreak=X.TIEBREAK)
    return rounded(
        keys.with_features(X.safety_label(spark, folder), features)
        .select("bookingID", "driver_id", "label", "n_points", "trip_duration_sec", "speed_mean"),
    )


@query(
    "join_drivers",
    f"WITH {P.LABEL}, {P.DRIVER} SELECT * FROM safety_label l LEFT JOIN driver d ON l.driver_id = d.id",
)
def join_drivers(spark, folder):
    return keys.with_drivers(X.safety_label(spark, folder), X.driver(spark, folder))


@query("master_table", MASTER)
def master_table(spark, folder):
    features = trips.trip_features(sensor(spark, folder), tiebreak=X.TIEBREAK)
    return rounded(keys.master_table(X.safety_label(spark, folder), features, X.driver(spark, folder), AS_OF))


@query(
    "join_longest_smooth",
    f"""WITH {P.FEATURES} SELECT agg."bookingID", n_points, coalesce(held, 0.0::DOUBLE) AS longest_smooth_segment_sec
    FROM agg LEFT JOIN (SELECT * FROM longest WHERE held > 50) USING ("bookingID")""",
)
def join_longest_smooth(spark, folder):
    features = cut_lineage(trips.trip_features(sensor(spark, folder), tiebreak=X.TIEBREAK))     # read twice
    kept = features.select("bookingID", "longest_smooth_segment_sec").where("longest_smooth_segment_sec > 50")
    return keys.with_longest_smooth(features.select("bookingID", "n_points"), kept)
