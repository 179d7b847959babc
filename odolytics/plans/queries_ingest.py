"""Scans, checks, cleaning, sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from odolytics import schema as S
from odolytics.operators import cleaning, keys, scoring, trips
from odolytics.plans import etl
from odolytics.plans import oracle_parts as P
from odolytics.plans.models_used import SCORED_TRIPS, linear_model
from odolytics.plans.registry import query, rounded, sql_rounded
from odolytics.session import cut_lineage, work_path
from odolytics.sources import fixtures as X
from odolytics.sources import readers, writers

AS_OF = dt.date(2024, 2, 1)
COLUMNS = ["bookingID", "event_id", "second", "accuracy", "speed", *S.CHANNELS]
LIST = ", ".join(f'"{c}"' for c in COLUMNS)
SENSOR_ROWS = f"WITH {P.SENSOR} SELECT {LIST} FROM sensor"


def sensor(spark, folder):
    return X.sensor(spark, folder).select(*COLUMNS)


def _csv_copy(spark, df, name):
    path = work_path(spark, name)
    writers.write_csv(df, path)
    return path


# Scans -------------------------------------------------------------------------

@query("scan_csv", SENSOR_ROWS)
def scan_csv(spark, folder):
    """A folder of files whose seconds are written ``n.0`` and whose columns stand in different orders."""
    rows = sensor(spark, folder).withColumn("second", F.col("second").cast("double"))
    path = work_path(spark, "sensor-csv")
    writers.write_csv(rows.where("event_id % 2 = 0"), f"{path}/a")
    writers.write_csv(rows.where("event_id % 2 = 1").select(*reversed(rows.columns)), f"{path}/b")
    return readers.read_csv(spark, [f"{path}/a", f"{path}/b"]).withColumn("event_id", F.col("event_id").cast("long"))


@query(
    "typed_cast_sensor",
    f"""WITH {P.SENSOR} SELECT CASE WHEN event_id % 11 <> 0 THEN "bookingID" END AS "bookingID", event_id, second,
    {", ".join(S.CHANNELS)}, CASE WHEN event_id % 7 <> 0 THEN speed END AS speed, accuracy FROM sensor""",
)
def typed_cast_sensor(spark, folder):
    """Text columns with whole numbers written ``n.0``, ids that are no numbers and readings that do not parse."""
    e, rows = F.col("event_id"), sensor(spark, folder)
    text = rows.select("event_id", *[F.col(c).cast("string").alias(c) for c in rows.columns if c != "event_id"]).withColumns({
        "second": F.concat("second", F.lit(".0")),
        "bookingID": F.when(e % 11 == 0, F.concat(F.lit("T-"), "bookingID")).otherwise(F.col("bookingID")),
        "speed": F.when(e % 7 == 0, F.lit("n/a")).otherwise(F.col("speed")),
    })
    return readers.cast_sensor(text)


@query(
    "scan_rejects",
    f"""WITH {P.SENSOR} SELECT unparsed, count(*) AS n_rows FROM (
      SELECT CASE WHEN event_id % 7 = 0 AND event_id % 11 = 0 THEN 'bookingID,speed' WHEN event_id % 7 = 0 THEN 'speed'
        WHEN event_id % 11 = 0 THEN 'bookingID' END AS unparsed FROM sensor) WHERE unparsed IS NOT NULL GROUP BY 1""",
)
def scan_rejects(spark, folder):
    """How many rows of a raw file hold values that do not parse, by column."""
    e, rows = F.col("event_id"), sensor(spark, folder)
    raw = rows.withColumns({
        "bookingID": F.when(e % 11 == 0, F.concat(F.lit("T-"), "bookingID")).otherwise(F.col("bookingID").cast("string")),
        "speed": F.when(e % 7 == 0, F.lit("n/a")).otherwise(F.col("speed").cast("string")),
    })
    text = readers.read_text(spark, _csv_copy(spark, raw, "sensor-raw"))
    names = F.array_join(F.array_sort("unparsed"), ",")
    return readers.rejects(text).groupBy(names.alias("unparsed")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "scan_multi_file_union",
    f"""WITH {P.SENSOR} SELECT "bookingID", event_id, second, {", ".join(S.CHANNELS)}, speed,
    CASE WHEN speed >= 4 THEN accuracy END AS accuracy FROM sensor""",
)
def scan_multi_file_union(spark, folder):
    rows = sensor(spark, folder)
    without = _csv_copy(spark, rows.where("speed < 4").drop("accuracy"), "sensor-part")
    with_all = _csv_copy(spark, rows.where("speed >= 4").withColumnRenamed("speed", "Speed"), "sensor-part")
    both = readers.read_csv_union(spark, [without, with_all])
    return both.withColumn("event_id", F.col("event_id").cast("long"))


@query(
    "scan_unknown_headers",
    f"""WITH {P.SENSOR} SELECT "bookingID", speed, NULL::VARCHAR AS trip, NULL::VARCHAR AS v FROM sensor WHERE event_id % 3 = 0
    UNION ALL SELECT "bookingID", NULL, NULL, NULL FROM sensor WHERE event_id % 3 = 1
    UNION ALL SELECT NULL, NULL, CAST("bookingID" AS VARCHAR), CAST(event_id AS VARCHAR) FROM sensor WHERE event_id % 3 = 2""",
)
def scan_unknown_headers(spark, folder):
    """Three inputs: known columns, known columns behind another separator, and a header that names none of them."""
    rows = sensor(spark, folder)
    known = _csv_copy(spark, rows.where("event_id % 3 = 0").select("bookingID", "speed"), "sensor-part")
    other = work_path(spark, "sensor-part")
    rows.where("event_id % 3 = 1").select("bookingID", "second").write.option("header", True).option("sep", ";").csv(other)
    strange = work_path(spark, "sensor-part")
    rows.where("event_id % 3 = 2").select(F.col("bookingID").alias("trip"), F.col("event_id").alias("v")).write.option("header", True).option("sep", ";").csv(strange)
    return readers.read_csv_union(spark, [known, other, strange]).select("bookingID", "speed", "trip", "v")


@query("scan_table", "SELECT * FROM customer")
def scan_table(spark, folder):
    X.table(spark, folder, "customer").createOrReplaceTempView("odolytics_customer")
    return readers.read_table(spark, "odolytics_customer")


HEADER_VALUES = ", ".join(f"({i}, '{c}')" for i, c in enumerate(COLUMNS))


@query("scan_header", f"SELECT CAST(position AS BIGINT) AS position, column_name FROM (VALUES {HEADER_VALUES}) t(position, column_name)")
def scan_header(spark, folder):
    path = _csv_copy(spark, sensor(spark, folder), "sensor-csv")
    return spark.createDataFrame(list(enumerate(readers.read_header(spark, path))), "position long, column_name string")


@query("standardize_columns", SENSOR_ROWS)
def standardize_columns(spark, folder):
    odd = sensor(spark, folder).withColumnsRenamed(
        {"bookingID": " Booking_ID ", "accuracy": "Accuracy", "speed": "SPEED ", "gyro_x": " Gyro_X"}
    )
    return readers.standardize_columns(odd)


@query("drop_index_columns", SENSOR_ROWS)
def drop_index_columns(spark, folder):
    indexed = sensor(spark, folder).withColumn("Unnamed: 0", F.col("event_id")).withColumn("Unnamed: 0.1", F.lit(0))
    return readers.drop_index_columns(indexed)


@query(
    "detect_stage",
    f"""WITH {P.SERVING_FEATURES}
    SELECT 'sensor' AS input, 'RAW_SENSOR' AS stage, (SELECT count(*) FROM sensor) AS n_rows
    UNION ALL SELECT 'features', 'FEATURES_READY', (SELECT count(*) FROM sfeatures)
    UNION ALL SELECT 'customer', 'UNKNOWN', (SELECT count(*) FROM customer)""",
)
def detect_stage(spark, folder):
    inputs = {
        "sensor": sensor(spark, folder).withColumnRenamed("bookingID", "booking_id"),
        "features": X.features_ready(spark, folder),
        "customer": X.table(spark, folder, "customer"),
    }
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("input"), F.lit(readers.detect_stage(df.columns)).alias("stage"), "n_rows"
        )
        for name, df in inputs.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "validate_input",
    f"WITH {P.SENSOR} "
    + " UNION ALL ".join(
        "SELECT 'gyro_z' AS column_name, false AS present, 0::BIGINT AS n_values" if c == "gyro_z"
        else f"SELECT '{c}' AS column_name, true AS present, count(\"{c}\") AS n_values FROM sensor"
        for c in S.REQUIRED_COLUMNS
    ),
)
def validate_input(spark, folder):
    return readers.validation_table(sensor(spark, folder).drop("gyro_z"))


@query(
    "typed_cast_repair",
    f"""WITH {P.DRIVER} SELECT id, name, CASE WHEN id % 13 <> 0 THEN date_of_birth END AS date_of_birth, gender, car_brand,
    car_model_year, CASE WHEN id % 11 <> 0 THEN rating END AS rating,
    CASE WHEN id % 17 <> 0 THEN no_of_years_driving_exp END AS no_of_years_driving_exp FROM driver""",
)
def typed_cast_repair(spark, folder):
    """From a raw driver file, whose dates and numbers are text."""
    path = _csv_copy(spark, X.driver_raw(spark, folder), "driver-csv")
    return cleaning.repair_driver_types(readers.read_csv(spark, path, S.DRIVER_RAW_SCHEMA))


def _holes(spark, folder):
    e = F.col("event_id")
    return sensor(spark, folder).withColumns(
        {"bookingID": F.when(e % 19 != 0, F.col("bookingID")), "second": F.when(e % 23 != 0, F.col("second"))}
    )


@query("drop_null_keys", f"WITH {P.SENSOR} SELECT {LIST} FROM sensor WHERE event_id % 19 <> 0 AND event_id % 23 <> 0")
def drop_null_keys(spark, folder):
    return cleaning.drop_null_keys(_holes(spark, folder))


@query(
    "pk_duplicate_check",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def pk_duplicate_check(spark, folder):
    return keys.duplicate_keys(X.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


ORPHANS = f"""WITH {P.SENSOR}, parent AS (SELECT c_custkey AS "bookingID" FROM customer WHERE c_acctbal >= 0),
orphan AS (SELECT s."bookingID" AS orphan_key FROM sensor s LEFT JOIN parent p USING ("bookingID") WHERE p."bookingID" IS NULL)"""


@query("fk_orphan_count", f"{ORPHANS} SELECT count(*) AS orphan_rows FROM orphan")
def fk_orphan_count(spark, folder):
    return keys.orphan_count(sensor(spark, folder), "bookingID", X.processed_trips(spark, folder), "bookingID")


@query("fk_orphan_sample", f"{ORPHANS} SELECT DISTINCT orphan_key FROM orphan ORDER BY 1 LIMIT 10")
def fk_orphan_sample(spark, folder):
    return keys.orphan_sample(sensor(spark, folder), "bookingID", X.processed_trips(spark, folder), "bookingID")


@query(
    "nulls_normalize",
    f"""WITH {P.SENSOR} SELECT * REPLACE (CASE WHEN speed >= 0 THEN speed END AS speed) FROM (SELECT {LIST} FROM sensor)""",
)
def nulls_normalize(spark, folder):
    nan = F.lit(float("nan"))
    rows = sensor(spark, folder).withColumns(
        {"speed": F.when(F.col("speed") >= 0, F.col("speed")).otherwise(nan), "accuracy": F.coalesce("accuracy", nan)}
    )
    return cleaning.nulls_normalize(rows)


DONE = """done AS (SELECT c_custkey AS "bookingID" FROM customer WHERE c_acctbal >= 0)"""


@query(
    "incremental_new_ids",
    f"""WITH {P.SENSOR}, {DONE} SELECT DISTINCT "bookingID" FROM sensor
    WHERE "bookingID" NOT IN (SELECT "bookingID" FROM done)""",
)
def incremental_new_ids(spark, folder):
    return keys.new_trips(sensor(spark, folder), X.processed_trips(spark, folder))


@query(
    "scan_by_ids",
    f"""WITH {P.SENSOR}, {DONE} SELECT {LIST} FROM sensor WHERE "bookingID" NOT IN (SELECT "bookingID" FROM done)""",
)
def scan_by_ids(spark, folder):
    rows = sensor(spark, folder)
    return keys.read_trips(rows, keys.new_trips(rows, X.processed_trips(spark, folder)))


# Sinks -------------------------------------------------------------------------

FEATURE_ROWS = f'WITH {P.FEATURES} SELECT "bookingID", {{}} FROM features'.format(
    ", ".join(
        f if f == "trip_duration_sec" or f.startswith("n_") else sql_rounded(f) for f in S.TRIP_FEATURES
    )
)


@query("sink_append", FEATURE_ROWS)
def sink_append(spark, folder):
    """Two incremental runs: the trips known before, then everything; the second adds only new trips."""
    path, rows = work_path(spark, "trip-features"), sensor(spark, folder)
    etl.update_features(keys.read_trips(rows, X.processed_trips(spark, folder)), path, X.TIEBREAK)
    etl.update_features(rows, path, X.TIEBREAK)
    return rounded(spark.read.parquet(path))


MASTER = f"""WITH {P.FEATURES}, {P.LABEL}, {P.DRIVER}, {P.DRIVER_CLEAN}
SELECT l."bookingID", l.driver_id, l.label, l.label = 1 AS is_dangerous, {", ".join(
    f"f.{c}" if c == "trip_duration_sec" or c.startswith("n_") else sql_rounded(c, source="f.") for c in S.TRIP_FEATURES)},
  d.id, d.name, d.date_of_birth, d.gender, d.car_brand, d.car_model_year, {sql_rounded("rating", source="d.")},
  d.no_of_years_driving_exp, d.age, d.rating_bin, d.exp_bin
FROM safety_label l LEFT JOIN features f USING ("bookingID") LEFT JOIN driver_clean d ON l.driver_id = d.id"""


@query("sink_replace", MASTER)
def sink_replace(spark, folder):
    """The whole incremental job: features appended, report table replaced (twice)."""
    features, master = work_path(spark, "trip-features"), work_path(spark, "master")
    for _ in range(2):
        etl.run_etl(
            sensor(spark, folder), X.safety_label(spark, folder), X.driver(spark, folder), features, master,
            tiebreak=X.TIEBREAK, as_of=AS_OF,
        )
    return rounded(spark.read.parquet(master))


@query("sink_csv", FEATURE_ROWS)
def sink_csv(spark, folder):
    features = trips.trip_features(sensor(spark, folder), tiebreak=X.TIEBREAK)
    path = _csv_copy(spark, features, "features-csv")
    return rounded(spark.read.schema(features.schema).option("header", True).csv(path))


@query(
    "export_predictions",
    SCORED_TRIPS + f"""SELECT "bookingID", prediction, prediction_label, {P.rounded(
        ["probability_safe", "probability_dangerous", "confidence"])}, 'run-1' AS run_id FROM decided""",
)
def export_predictions(spark, folder):
    features = cut_lineage(trips.trip_features(sensor(spark, folder), tiebreak=X.TIEBREAK))
    path = work_path(spark, "predictions")
    results = scoring.score_batch(features, linear_model(features))
    for _ in range(2):
        writers.export_predictions(results, path, "run-1")
    stored = spark.read.option("header", True).schema(
        "bookingID long, prediction int, prediction_label string, probability_safe double, "
        "probability_dangerous double, confidence double, run_id string"
    ).csv(path)
    return rounded(stored)


# Cleaning ----------------------------------------------------------------------

@query("clean_filter_rows", f"WITH {P.SENSOR}, {P.FILTERED} SELECT {LIST} FROM filtered")
def clean_filter_rows(spark, folder):
    return cleaning.filter_rows(sensor(spark, folder))


@query(
    "clean_negative_speed",
    f"WITH {P.SENSOR} SELECT * REPLACE (CASE WHEN speed >= 0 THEN speed END AS speed) FROM (SELECT {LIST} FROM sensor)",
)
def clean_negative_speed(spark, folder):
    return cleaning.null_negative_speed(sensor(spark, folder))


@query(
    "clean_outlier_null",
    f"WITH {P.SENSOR} SELECT * REPLACE ("
    + ", ".join(f"CASE WHEN abs({c}) > {lim!r}::DOUBLE THEN NULL ELSE {c} END AS {c}" for c, lim in S.CHANNEL_LIMITS.items())
    + f") FROM (SELECT {LIST} FROM sensor)",
)
def clean_outlier_null(spark, folder):
    return cleaning.null_outliers(sensor(spark, folder))


@query(
    "derive_p999_limits",
    f"WITH {P.SENSOR} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {P.r(f'quantile_cont(abs({c}), 0.999)', name='limit_value')} FROM sensor" for c in S.CHANNELS
    ),
)
def derive_p999_limits(spark, folder):
    return rounded(cleaning.derive_limits(sensor(spark, folder)))


@query(
    "clean_ffill",
    f"""WITH {P.SENSOR} SELECT "bookingID", event_id, second, accuracy, {", ".join(
        f"last_value({c} IGNORE NULLS) OVER {P.W[:-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
        for c in P.READINGS)}
    FROM (SELECT * REPLACE (CASE WHEN speed >= 0 THEN speed END AS speed) FROM sensor)""",
)
def clean_ffill(spark, folder):
    return cleaning.fill_forward(cleaning.null_negative_speed(sensor(spark, folder)), X.TIEBREAK)


@query("clean_sensor", f"WITH {P.SENSOR}, {P.FILTERED}, {P.CLEAN} SELECT {LIST} FROM clean")
def clean_sensor(spark, folder):
    return cleaning.clean_sensor(sensor(spark, folder))


@query("clean_sensor_serving", f"WITH {P.SENSOR}, {P.FILTERED}, {P.CLEAN}, {P.FILLED} SELECT {LIST} FROM filled")
def clean_sensor_serving(spark, folder):
    return cleaning.clean_sensor_serving(sensor(spark, folder), X.TIEBREAK)


@query("clean_safety", f'WITH {P.LABEL} SELECT *, label = 1 AS is_dangerous FROM safety_label')
def clean_safety(spark, folder):
    path = _csv_copy(spark, X.safety_label(spark, folder), "label-csv")
    return cleaning.clean_labels(readers.read_csv(spark, path, S.LABEL_SCHEMA))


@query("driver_age", f"WITH {P.DRIVER}, {P.DRIVER_CLEAN} SELECT id, age FROM driver_clean")
def driver_age(spark, folder):
    return X.driver(spark, folder).select("id", cleaning.driver_age(AS_OF).alias("age"))


@query("driver_rating_bin", f"WITH {P.DRIVER}, {P.DRIVER_CLEAN} SELECT id, rating_bin FROM driver_clean")
def driver_rating_bin(spark, folder):
    return X.driver(spark, folder).select("id", cleaning.rating_bin().alias("rating_bin"))


@query("driver_exp_bin", f"WITH {P.DRIVER}, {P.DRIVER_CLEAN} SELECT id, exp_bin FROM driver_clean")
def driver_exp_bin(spark, folder):
    return X.driver(spark, folder).select("id", cleaning.experience_bin().alias("exp_bin"))


@query("clean_drivers", f"WITH {P.DRIVER}, {P.DRIVER_CLEAN} SELECT * FROM driver_clean")
def clean_drivers(spark, folder):
    return cleaning.clean_drivers(X.driver(spark, folder), AS_OF)


@query("select_trip", f'WITH {P.SENSOR} SELECT {LIST} FROM sensor WHERE "bookingID" = 7')
def select_trip(spark, folder):
    return cleaning.select_trip(sensor(spark, folder), 7)


@query("list_trips", f'WITH {P.SENSOR} SELECT DISTINCT "bookingID" FROM sensor')
def list_trips(spark, folder):
    return cleaning.list_trips(sensor(spark, folder))


@query("select_existing", f'WITH {P.SENSOR} SELECT "bookingID", speed, gyro_y FROM sensor')
def select_existing(spark, folder):
    return cleaning.select_existing(sensor(spark, folder), ["bookingID", "heading", "speed", "gyro_y", "altitude"])


def _catalog_sql() -> str:
    names = [*S.TRIP_FEATURES, "rating", "no_of_years_driving_exp", "age"]
    rows = [(n, g) for n in names for g in cleaning.FEATURE_GROUPS if g in n]
    rows += [(n, "driver") for n in cleaning.DRIVER_FEATURES]
    return f"WITH {P.FEATURES}, {P.LABEL}, {P.DRIVER}, {P.DRIVER_CLEAN}, joined AS (" \
        'SELECT f.*, d.* FROM safety_label l LEFT JOIN features f USING ("bookingID") ' \
        "LEFT JOIN driver_clean d ON l.driver_id = d.id) " + " UNION ALL ".join(
            f"SELECT '{n}' AS feature, '{g}' AS category, count({n}) AS n_values FROM joined" for n, g in rows
        )


@query("select_features", _catalog_sql())
def select_features(spark, folder):
    master = keys.master_table(
        X.safety_label(spark, folder), trips.trip_features(sensor(spark, folder), tiebreak=X.TIEBREAK),
        X.driver(spark, folder), AS_OF,
    )
    return cleaning.feature_catalog(master)


@query(
    "fill_zero",
    f"""WITH {P.SENSOR}, {P.FILTERED}, {P.CLEAN} SELECT "bookingID", event_id, second, accuracy, {", ".join(
        f"coalesce({c}, 0.0::DOUBLE) AS {c}" for c in P.READINGS)} FROM clean""",
)
def fill_zero(spark, folder):
    return cleaning.fill_zero(cleaning.clean_sensor(sensor(spark, folder)), P.READINGS)


@query(
    "interaction_features",
    f"""WITH {P.FEATURES} SELECT "bookingID",
    {P.r("speed_max * pct_time_speed_over_80", 10, "speed_risk_score")},
    {P.r("accel_mag_max * n_hard_accels", 10, "accel_risk_score")},
    {P.r("turn_sharpness_index * n_hard_turns", 10, "turn_risk_score")},
    {P.r("jerk_linear_mean / (speed_mean + 0.001::DOUBLE)", 10, "jerk_to_speed_ratio")},
    {P.r("longest_smooth_segment_sec / (trip_duration_sec + 1.0::DOUBLE)", 10, "smooth_to_total_ratio")},
    {P.r("gyro_mag_std * accel_mag_std", 10, "gyro_accel_instability")} FROM features""",
)
def interaction_features(spark, folder):
    features = trips.trip_features(sensor(spark, folder), tiebreak=X.TIEBREAK)
    return rounded(cleaning.interaction_features(features).select("bookingID", *cleaning.INTERACTIONS), 10)
