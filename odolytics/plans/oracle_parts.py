"""SQL building blocks of the checks: the test tables as sensor, label, driver and scored tables."""

from __future__ import annotations

from odolytics import schema as S
from odolytics.operators import prepare

SENSOR = """
base AS (
  SELECT *, CASE WHEN event_type IN ('view','click') THEN 20.0::DOUBLE ELSE 1.0::DOUBLE END AS k FROM events
),
sensor AS (
  SELECT user_id AS "bookingID", event_id,
    CAST(floor((epoch(ts) - 1704067200) / 3600) AS BIGINT)
      + CASE WHEN event_id % 97 = 0 THEN 30000 ELSE 0 END AS second,
    CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 37 = 0 THEN 60.0::DOUBLE
         ELSE CAST(event_id % 45 AS DOUBLE) END AS accuracy,
    CASE WHEN event_id % 53 = 0 THEN -1.0::DOUBLE ELSE value / 5.0::DOUBLE END AS speed,
    ((event_id*37) % 2001 - 1000) / 100.0::DOUBLE / k AS acceleration_x,
    ((event_id*53) % 6001 - 3000) / 100.0::DOUBLE / k AS acceleration_y,
    ((event_id*71) % 2701 - 1350) / 100.0::DOUBLE / k AS acceleration_z,
    ((event_id*29) %  311 -  155) / 100.0::DOUBLE / k AS gyro_x,
    ((event_id*43) %  531 -  265) / 100.0::DOUBLE / k AS gyro_y,
    ((event_id*61) %  381 -  190) / 100.0::DOUBLE / k AS gyro_z,
    ts
  FROM base
)"""

FILTERED = f"""
filtered AS (
  SELECT * FROM sensor WHERE second <= {S.MAX_SECOND} AND (accuracy IS NULL OR accuracy <= 50.0::DOUBLE)
)"""

_LIMITED = ",\n    ".join(
    f"CASE WHEN abs({c}) <= {lim!r}::DOUBLE THEN {c} END AS {c}" for c, lim in S.CHANNEL_LIMITS.items()
)

CLEAN = f"""
clean AS (
  SELECT "bookingID", event_id, second, accuracy,
    CASE WHEN speed >= 0 THEN speed END AS speed,
    {_LIMITED}, ts
  FROM filtered
)"""

W = '(PARTITION BY "bookingID" ORDER BY second, event_id)'
READINGS = [*S.CHANNELS, "speed"]

FILLED = f"""
filled AS (
  SELECT "bookingID", event_id, second, accuracy, {", ".join(
      f"last_value({c} IGNORE NULLS) OVER {W[:-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
      for c in READINGS)}
  FROM clean
)"""


def _mag(axes, zero: bool, prefix: str = "") -> str:
    cols = [f"coalesce({prefix}{a}, 0)" if zero else f"{prefix}{a}" for a in axes]
    return "sqrt(" + " + ".join(f"{c}*{c}" for c in cols) + ")"


def _jerk(axes) -> str:
    parts = [f"coalesce(coalesce({a} - prev_{a}, 0) / nullif(delta_t, 0), 0)" for a in axes]
    return "sqrt(" + " + ".join(f"pow({p}, 2)" for p in parts) + ")"


def _lagged(source: str) -> str:
    lags = ", ".join(f"lag({c}) OVER {W} AS prev_{c}" for c in ["second", *READINGS])
    return f"lagged AS (SELECT *, row_number() OVER {W} AS rn, {lags} FROM {source})"


def _sign(c: str) -> str:
    return f"CASE WHEN {c} > 0.5::DOUBLE THEN 1 WHEN {c} < -0.5::DOUBLE THEN -1 ELSE 0 END"


# Training profile -----------------------------------------------------------
_STEP1 = f"""
step1 AS (
  SELECT *, {_mag(S.ACCEL_AXES, True)} AS accel_mag, {_mag(S.GYRO_AXES, True)} AS gyro_mag,
    CASE WHEN rn = 1 THEN 0.0::DOUBLE ELSE (second - prev_second)::DOUBLE END AS delta_t,
    coalesce(speed - prev_speed, 0.0::DOUBLE) AS delta_speed
  FROM lagged
)"""
_STEP2 = f"""
step2 AS (
  SELECT *,
    CASE WHEN delta_t > 0 AND delta_t <= 10 THEN delta_speed / delta_t ELSE 0.0::DOUBLE END AS speed_rate,
    {_jerk(S.ACCEL_AXES)} AS jerk_linear, {_jerk(S.GYRO_AXES)} AS gyro_jerk_mag,
    {_sign("gyro_y")} AS gyro_y_sign,
    accel_mag < 2.0::DOUBLE AND gyro_mag < 0.5::DOUBLE AS is_smooth
  FROM step1
)"""
_STEP3 = f"""
step3 AS (
  SELECT *,
    coalesce(speed > 22.2::DOUBLE, false) AS is_speed_over_80,
    coalesce(speed BETWEEN 8.33::DOUBLE AND 16.67::DOUBLE, false) AS is_cruising,
    accel_mag > 12.0::DOUBLE AS is_high_accel, gyro_mag > 1.0::DOUBLE AS is_hard_turn,
    speed_rate < -5.0::DOUBLE AS is_hard_brake, speed_rate > 5.0::DOUBLE AS is_hard_accel,
    coalesce(lag(gyro_y_sign) OVER {W}, 0) AS prev_sign,
    coalesce(lag(is_smooth) OVER {W}, false) AS prev_smooth
  FROM step2
)"""
_STEP4 = f"""
step4 AS (
  SELECT *,
    gyro_y_sign <> 0 AND prev_sign <> 0 AND gyro_y_sign * prev_sign = -1 AND delta_t <= 5 AS is_zigzag,
    is_smooth AND NOT prev_smooth AS smooth_start
  FROM step3
)"""
_KIN = f"""
kin AS (
  SELECT *, CAST(sum(smooth_start::INT) OVER {W[:-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
    AS smooth_block
  FROM step4
)"""
KIN = ",".join([SENSOR, FILTERED, CLEAN, _lagged("clean"), _STEP1, _STEP2, _STEP3, _STEP4, _KIN])

_LONGEST = """
block_time AS (
  SELECT "bookingID", smooth_block, sum(delta_t) AS held FROM kin WHERE smooth_block > 0 GROUP BY 1, 2
),
longest AS (SELECT "bookingID", max(held) AS held FROM block_time GROUP BY 1)"""

_FEATURES = """
agg AS (
  SELECT "bookingID",
    max(second) - min(second) AS trip_duration_sec, count(second) AS n_points,
    max(speed) AS speed_max, avg(speed) AS speed_mean, stddev_samp(speed) AS speed_std,
    avg(is_speed_over_80::INT) AS pct_time_speed_over_80, avg(is_cruising::INT) AS pct_time_cruising,
    max(accel_mag) AS accel_mag_max, avg(accel_mag) AS accel_mag_mean, stddev_samp(accel_mag) AS accel_mag_std,
    avg(jerk_linear) AS jerk_linear_mean,
    CAST(sum(is_hard_accel::INT) AS BIGINT) AS n_hard_accels, CAST(sum(is_hard_brake::INT) AS BIGINT) AS n_hard_brakes,
    avg(is_high_accel::INT) AS pct_time_high_accel,
    max(gyro_mag) AS gyro_mag_max, avg(gyro_mag) AS gyro_mag_mean, stddev_samp(gyro_mag) AS gyro_mag_std,
    avg(gyro_jerk_mag) AS gyro_jerk_mag_mean,
    CAST(sum(is_hard_turn::INT) AS BIGINT) AS n_hard_turns, avg(is_hard_turn::INT) AS pct_time_high_gyro,
    CAST(sum(is_zigzag::INT) AS BIGINT) AS n_zigzag_events, avg(is_smooth::INT) AS pct_time_smooth
  FROM kin GROUP BY 1
),
features AS (
  SELECT agg.*, gyro_mag_max / (speed_mean + 0.001::DOUBLE) AS turn_sharpness_index,
    coalesce(held, 0.0::DOUBLE) AS longest_smooth_segment_sec
  FROM agg LEFT JOIN longest USING ("bookingID")
)"""
FEATURES = ",".join([KIN, _LONGEST, _FEATURES])

# Serving profile ------------------------------------------------------------
_SERVING_KIN = f"""
skin0 AS (
  SELECT *, {_mag(S.ACCEL_AXES, False)} AS accel_mag, {_mag(S.GYRO_AXES, False)} AS gyro_mag,
    CASE WHEN rn = 1 THEN 1.0::DOUBLE ELSE (second - prev_second)::DOUBLE END AS delta_t
  FROM lagged
),
skin AS (
  SELECT *, coalesce(coalesce(speed - prev_speed, 0) / nullif(delta_t, 0), 0.0::DOUBLE) AS speed_rate,
    {_jerk(S.ACCEL_AXES)} AS jerk_linear, {_jerk(S.GYRO_AXES)} AS gyro_jerk_mag,
    coalesce(speed > 22.2::DOUBLE, false) AS is_speed_over_80,
    coalesce(accel_mag > 12.0::DOUBLE, false) AS is_high_accel
  FROM skin0
)"""
SERVING_KIN = ",".join([SENSOR, FILTERED, CLEAN, FILLED, _lagged("filled"), _SERVING_KIN])
SERVING_FEATURES = ",".join([SERVING_KIN, """
sagg AS (
  SELECT "bookingID", max(second) - min(second) AS trip_duration_sec, avg(speed) AS speed_mean,
    count(second) AS n_points, stddev_samp(gyro_mag) AS gyro_mag_std, max(speed) AS speed_max,
    avg(jerk_linear) AS jerk_linear_mean, avg(is_speed_over_80::INT) AS pct_time_speed_over_80,
    avg(gyro_jerk_mag) AS gyro_jerk_mag_mean, avg(is_high_accel::INT) AS pct_time_high_accel
  FROM skin GROUP BY 1
),
sfeatures AS (
  SELECT *, gyro_mag_std / (speed_mean + 0.001::DOUBLE) AS turn_sharpness_index FROM sagg
)"""])

# Labels and drivers -----------------------------------------------------------
LABEL = """
safety_label AS (
  SELECT c_custkey AS "bookingID", c_custkey + 7 AS driver_id,
    CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS label FROM customer
)"""
DRIVER = """
driver AS (
  SELECT c_custkey AS id, c_name AS name,
    CAST(DATE '1960-01-01' + CAST((c_custkey*37) % 14000 AS INTEGER) AS DATE) AS date_of_birth,
    CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, c_mktsegment AS car_brand,
    CAST(2000 + c_custkey % 24 AS INTEGER) AS car_model_year,
    1.0::DOUBLE + (c_custkey % 41) / 10.0::DOUBLE AS rating,
    CAST(c_custkey % 65 AS INTEGER) AS no_of_years_driving_exp
  FROM customer
)"""
DRIVER_CLEAN = """
driver_clean AS (
  SELECT *, CAST(floor((DATE '2024-02-01' - date_of_birth) / 365.0::DOUBLE) AS INTEGER) AS age,
    CASE WHEN rating > 1.0::DOUBLE AND rating <= 2.5::DOUBLE THEN 'Very Low'
         WHEN rating > 2.5::DOUBLE AND rating <= 3.5::DOUBLE THEN 'Low'
         WHEN rating > 3.5::DOUBLE AND rating <= 4.5::DOUBLE THEN 'Medium'
         WHEN rating > 4.5::DOUBLE AND rating <= 5.1::DOUBLE THEN 'High' END AS rating_bin,
    CASE WHEN no_of_years_driving_exp > -1 AND no_of_years_driving_exp <= 3 THEN '<3'
         WHEN no_of_years_driving_exp > 3 AND no_of_years_driving_exp <= 5 THEN '3-5'
         WHEN no_of_years_driving_exp > 5 AND no_of_years_driving_exp <= 10 THEN '5-10'
         WHEN no_of_years_driving_exp > 10 AND no_of_years_driving_exp <= 20 THEN '10-20'
         WHEN no_of_years_driving_exp > 20 AND no_of_years_driving_exp <= 60 THEN '20+' END AS exp_bin
  FROM driver
)"""

WIDE = """
wide AS (
  SELECT l_quantity, l_extendedprice, l_discount, l_tax,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem
)"""
SCORED = """
scored AS (
  SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_linestatus, l_shipdate, l_quantity,
    l_extendedprice, l_discount, l_tax,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
    ((l_orderkey * 31 + l_linenumber * 17) % 1000) / 1000.0::DOUBLE AS p,
    ((l_orderkey * 13 + l_linenumber * 29) % 1000) / 1000.0::DOUBLE AS p_other
  FROM lineitem
)"""
TRIP_TABLE = FEATURES + """,
trip_table AS (
  SELECT *, CASE WHEN speed_mean + (("bookingID" * 17) % 10) / 5.0::DOUBLE > 11.6::DOUBLE THEN 1 ELSE 0 END AS label
  FROM features
)"""


def r(expression: str, places: int = 6, name: str | None = None) -> str:
    """Rounded so that summation order does not show; ``+ 0`` turns -0.0 into 0.0."""
    return f"round({expression}, {places}) + 0.0::DOUBLE AS {name or expression}"


def rounded(columns, places: int = 6) -> str:
    return ", ".join(r(c, places) for c in columns)


def row_hash(value, seed):
    """``prepare.row_hash`` in SQL, each step of which names the one before."""
    mask, (first, second) = prepare.HASH_SPAN - 1, prepare.MIXERS
    return f"""(SELECT xor(c, c >> 15) FROM (SELECT (xor(b, b >> 13) * {second}) & {mask} AS c FROM (
      SELECT (xor(a, a >> 16) * {first}) & {mask} AS b FROM (SELECT xor(k & {mask},
        (((k >> 31) & {mask}) * {prepare.UPPER_MIXER} + {seed * prepare.SEED_MIXER}) & {mask}) AS a
      FROM (SELECT ({value})::BIGINT AS k)))))"""
