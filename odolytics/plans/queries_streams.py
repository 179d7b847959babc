"""The streaming jobs, run over the events as a stream of several files until it is used up.

Files overlap in time, as many are read per trigger as arrived with one piece (one, for a small table), and results are
compared with the whole table's. So the number of triggers does not grow with the number of tasks that wrote a piece.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from odolytics import schema as S
from odolytics.functions.columns import utc_instant
from odolytics.operators import cleaning, trips
from odolytics.plans import oracle_parts as P
from odolytics.plans.models_used import SCORED_TRIPS, linear_model
from odolytics.plans.queries_ingest import AS_OF, FEATURE_ROWS, LIST
from odolytics.plans.queries_models import DECIDED
from odolytics.plans.registry import MORE_PLACES, query, rounded
from odolytics.session import state_parts, work_path
from odolytics.sources import fixtures as X
from odolytics.streaming import jobs, trip_state

DELAY = "1 day"     # longer than the time by which files overlap


def _stream(spark, folder):
    path = work_path(spark, "events")
    at_once = X.event_files(spark, folder, path)
    events = jobs.read_files(spark, path, X.table(spark, folder, "events").schema, files_per_trigger=at_once)
    return X.sensor_from_events(events).withColumn(jobs.EVENT_TIME, utc_instant(F.col("ts"))).drop("ts")


def _clean(spark, folder):
    return jobs.clean(_stream(spark, folder))


@query("stream_clean", f"WITH {P.SENSOR}, {P.FILTERED}, {P.CLEAN} SELECT {LIST} FROM clean")
def stream_clean(spark, folder):
    return jobs.run_to_table(jobs.without_end(_clean(spark, folder).drop(jobs.EVENT_TIME)), "stream-clean")


@query("stream_dedup", f'WITH {P.SENSOR}, {P.FILTERED} SELECT DISTINCT "bookingID", second FROM filtered')
def stream_dedup(spark, folder):
    once = jobs.deduplicate(_clean(spark, folder), DELAY)
    return jobs.run_to_table(jobs.without_end(once.select("bookingID", "second")), "stream-dedup")


WINDOWED = f"""WITH {P.SENSOR}, {P.FILTERED}, {P.CLEAN}, m AS (SELECT *,
    {P._mag(S.ACCEL_AXES, True)} AS accel_mag, {P._mag(S.GYRO_AXES, True)} AS gyro_mag,
    time_bucket(INTERVAL 10 HOUR, ts, TIMESTAMP '1970-01-01') AS started FROM clean)
  SELECT "bookingID", CAST(epoch(started) AS BIGINT) AS window_start, count(*) AS n_points,
    {", ".join(P.r(f"{f}({c})", MORE_PLACES.get(f"{c}_{n}", 6), f"{c}_{n}")
      for c in ("speed", "accel_mag", "gyro_mag") for f, n in (("avg", "mean"), ("max", "max")))},
    {P.r("avg(coalesce(speed > 22.2::DOUBLE, false)::INT)", name="pct_time_speed_over_80")},
    {P.r("avg((accel_mag > 12.0::DOUBLE)::INT)", name="pct_time_high_accel")},
    {P.r("avg((gyro_mag > 1.0::DOUBLE)::INT)", name="pct_time_high_gyro")}
  FROM m GROUP BY "bookingID", started"""


@query("stream_window_features", WINDOWED)
def stream_window_features(spark, folder):
    """The table's time unit is the hour."""
    windows = jobs.window_features(_clean(spark, folder), "10 hours", delay=DELAY)
    table = jobs.without_end(jobs.run_to_table(windows, "stream-windows"))
    return rounded(table.withColumn("window_start", F.unix_seconds("window_start")).drop("window_end"))


SESSIONS = f"""WITH {P.SENSOR}, {P.FILTERED}, {P.CLEAN},
  g AS (SELECT "bookingID", ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= 43200000000 THEN 0 ELSE 1 END AS fresh
    FROM clean WINDOW w AS (PARTITION BY "bookingID" ORDER BY ts)),
  n AS (SELECT *, sum(fresh) OVER (PARTITION BY "bookingID" ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM g)
  SELECT "bookingID", count(*) AS n_points, epoch_us(max(ts)) - epoch_us(min(ts)) AS duration_micros
  FROM n GROUP BY "bookingID", session"""


@query("stream_trip_sessions", SESSIONS)
def stream_trip_sessions(spark, folder):
    sessions = jobs.trip_sessions(_clean(spark, folder), "12 hours", DELAY)
    return jobs.without_end(jobs.run_to_table(sessions, "stream-sessions")).select("bookingID", "n_points", "duration_micros")


def _stream_features(spark, folder):
    features = trip_state.trip_features_stream(_clean(spark, folder), "event_id", DELAY, idle_ms=86_400_000)
    return jobs.without_end(features)


@query("stream_trip_features", FEATURE_ROWS)
def stream_trip_features(spark, folder):
    """The last version of every trip equals the batch features."""
    versions = jobs.run_to_table(_stream_features(spark, folder), "stream-features", parts=state_parts(spark))
    return rounded(trip_state.latest(versions))


@query("stream_score", f"{SCORED_TRIPS} SELECT {DECIDED} FROM decided")
def stream_score(spark, folder):
    """Scores of every emitted version; the one of the most rows is shown for each trip."""
    batch = trips.trip_features(X.sensor(spark, folder), tiebreak=X.TIEBREAK)
    versions = _stream_features(spark, folder).select("bookingID", *S.SERVING_FEATURES, "n_late", "closed")
    version = ["n_points", "n_late", "closed"]
    table = jobs.run_to_table(jobs.score(versions, linear_model(batch), keep=version), "stream-scores", parts=state_parts(spark))
    shown = [c for c in table.columns if c not in ("bookingID", *version)]
    last = F.max_by(F.struct(*shown), F.struct(*version))
    return rounded(table.groupBy("bookingID").agg(last.alias("s")).select("bookingID", "s.*"))


@query(
    "stream_enrich",
    f"""WITH {P.SENSOR}, {P.FILTERED}, {P.CLEAN}, {P.LABEL}, {P.DRIVER}, {P.DRIVER_CLEAN}
    SELECT c."bookingID", c.event_id, second, l.driver_id, l.label, d.id, d.gender, d.age, d.rating_bin
    FROM clean c LEFT JOIN safety_label l USING ("bookingID") LEFT JOIN driver_clean d ON l.driver_id = d.id""",
)
def stream_enrich(spark, folder):
    joined = jobs.enrich(
        _clean(spark, folder), X.safety_label(spark, folder), cleaning.clean_drivers(X.driver(spark, folder), AS_OF)
    )
    wanted = joined.select("bookingID", "event_id", "second", "driver_id", "label", "id", "gender", "age", "rating_bin")
    return jobs.run_to_table(jobs.without_end(wanted), "stream-enriched")


@query("stream_incremental_sink", FEATURE_ROWS)
def stream_incremental_sink(spark, folder):
    """The stream is read twice; the second reading changes nothing. Trips are kept in stretches of a week (the table's
    time unit is the hour)."""
    path = work_path(spark, "stream-sink")
    for _ in range(2):
        stream = jobs.without_end(_stream(spark, folder)).drop(jobs.EVENT_TIME)
        jobs.run_each_batch(stream, "stream-sink", jobs.upsert_trips(f"{path}/rows", f"{path}/features", X.TIEBREAK, slot=168))
    return rounded(jobs.latest_trips(spark, f"{path}/features"))
