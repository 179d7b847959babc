"""Structured Streaming jobs over sensor rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from odolytics import schema as S
from odolytics.functions.columns import flag, magnitude, share
from odolytics.operators import cleaning, fragments, keys, scoring
from odolytics.session import cut_lineage, state_on_disk, work_path

EVENT_TIME = "event_time"
END_KEY = -(1 << 63)        # key of the row that ends an input


def read_files(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 64) -> DataFrame:
    """Files as a stream; the trigger limit bounds what one micro-batch holds."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def start(
    stream: DataFrame, target: str, progress: str, every: str | None = None, output: str = "append", parts: int | None = None,
) -> StreamingQuery:
    """Write a stream to a parquet table. ``progress`` is the stream's checkpoint folder and must stay the
    same across restarts; without ``every`` the query stops when the input is used up. ``parts``: see ``state_on_disk``."""
    writer = stream.writeStream.format("parquet").outputMode(output).option("checkpointLocation", progress)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    with state_on_disk(stream.sparkSession, parts):
        return writer.start(target)


def run_to_table(
    stream: DataFrame, name: str, path: str | None = None, progress: str | None = None, parts: int | None = None,
) -> DataFrame:
    """Process what is available, append it to a table, and read that table. Without paths a fresh table in
    the shared folder is made."""
    spark = stream.sparkSession
    target = path or work_path(spark, name)
    start(stream, target, progress or work_path(spark, f"{name}-progress"), parts=parts).awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def clean(stream: DataFrame) -> DataFrame:
    """Cleaning needs no state: the batch transform is the stream transform."""
    return cleaning.clean_sensor(stream)


def deduplicate(
    stream: DataFrame, delay: str = "10 minutes", on: Sequence[str] = (S.KEY, S.TIME), salts: int = 16
) -> DataFrame:
    """One row per key; state older than the watermark is let go.

    One key may arrive in a great many copies: copies are first dropped within ``salts`` groups of input
    partitions, so that at most ``salts`` copies of a key meet in one task. ``salts=1`` saves that step.
    """
    timed = stream.withWatermark(EVENT_TIME, delay)
    if salts > 1:
        salted = timed.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        timed = salted.dropDuplicatesWithinWatermark([*on, "__salt"]).drop("__salt")
    return timed.dropDuplicatesWithinWatermark(list(on))


def window_features(
    stream: DataFrame, width: str = "10 seconds", slide: str | None = None, delay: str = "1 minute",
    t: S.Thresholds = S.Thresholds(),
) -> DataFrame:
    """Short windows of speed, motion size and flags per trip, instead of whole-trip sums."""
    rows = stream.withColumns(
        {
            "accel_mag": magnitude([F.coalesce(c, F.lit(0.0)) for c in map(F.col, S.ACCEL_AXES)]),
            "gyro_mag": magnitude([F.coalesce(c, F.lit(0.0)) for c in map(F.col, S.GYRO_AXES)]),
        }
    ).withWatermark(EVENT_TIME, delay)
    span = F.window(EVENT_TIME, width, slide) if slide else F.window(EVENT_TIME, width)
    return (
        rows.groupBy(span.alias("span"), S.KEY)
        .agg(
            F.count(F.lit(1)).alias("n_points"),
            F.avg("speed").alias("speed_mean"), F.max("speed").alias("speed_max"),
            F.avg("accel_mag").alias("accel_mag_mean"), F.max("accel_mag").alias("accel_mag_max"),
            F.avg("gyro_mag").alias("gyro_mag_mean"), F.max("gyro_mag").alias("gyro_mag_max"),
            share(flag(F.col("speed") > F.lit(t.speed_over_80))).alias("pct_time_speed_over_80"),
            share(F.col("accel_mag") > F.lit(t.accel_high)).alias("pct_time_high_accel"),
            share(F.col("gyro_mag") > F.lit(t.gyro_high)).alias("pct_time_high_gyro"),
        )
        .select(S.KEY, F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"),
                *[c for c in ["n_points", "speed_mean", "speed_max", "accel_mag_mean", "accel_mag_max", "gyro_mag_mean",
                              "gyro_mag_max", "pct_time_speed_over_80", "pct_time_high_accel", "pct_time_high_gyro"]])
    )


def trip_sessions(stream: DataFrame, gap: str = "5 minutes", delay: str = "1 minute") -> DataFrame:
    """A trip ends when nothing arrives for ``gap``."""
    return (
        stream.withWatermark(EVENT_TIME, delay)
        .groupBy(F.session_window(EVENT_TIME, gap).alias("session"), S.KEY)
        .agg(F.count(F.lit(1)).alias("n_points"), F.min(EVENT_TIME).alias("first_time"), F.max(EVENT_TIME).alias("last_time"))
        .select(S.KEY, "n_points", "first_time", "last_time",
                (F.unix_micros("last_time") - F.unix_micros("first_time")).alias("duration_micros"))
    )


def enrich(stream: DataFrame, labels: DataFrame, drivers: DataFrame) -> DataFrame:
    """Left joins of the stream with label and driver tables read afresh by every micro-batch."""
    return stream.join(labels, S.KEY, "left").transform(keys.with_drivers, drivers)


def end_of_input(rows: DataFrame, key: str, time: str, ahead: str = "300 days") -> DataFrame:
    """The row that ends a finished input: the newest row again, under ``END_KEY`` and far ahead in time.

    Windows and sessions come out when the watermark passes them, so those still open when the data stop would
    never be seen. Appended as the last file, this row takes the watermark past all of them.
    """
    newest = rows.agg(F.max_by(F.struct(*rows.columns), time).alias("r")).where("r IS NOT NULL").select("r.*")
    return newest.withColumn(key, F.lit(END_KEY).cast("long")).withColumn(time, F.col(time) + F.expr(f"INTERVAL {ahead}"))


def without_end(df: DataFrame, key: str = S.KEY) -> DataFrame:
    return df.where(F.col(key) != F.lit(END_KEY))


def upsert_trips(
    rows_path: str, features_path: str, tiebreak: Sequence[str] = (), slot: int = 3600, fragments_path: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body that keeps the features of every trip complete, however its rows are spread.

    A trip is kept as fragments, one per ``slot`` time units (see ``fragments``). New rows behind the last one of their
    slot are folded and combined with the stored fragment; no row that came before is read. Rows that arrive out of order
    have the rows of their own slot read again, and no others: the table of all rows is partitioned by slot. Features of
    the touched trips are then combined from fragments alone and written as this batch's version. A batch that is repeated
    overwrites its own folders and reads older ones only, so a retry changes nothing. ``latest_trips`` reads the newest
    version of each trip.
    """
    fragments_path = fragments_path or f"{features_path}-fragments"

    def stored(spark: SparkSession, schema: T.StructType, number: int, touched: DataFrame, by: list[str]) -> DataFrame:
        """The newest fragment of each touched trip and slot from before this batch."""
        older = spark.read.schema(schema.add("batch", "long")).parquet(fragments_path).where(F.col("batch") < number)
        columns = [f.name for f in schema if f.name != "batch"]
        wanted = older.join(touched, by, "left_semi")
        newest = F.max_by(F.struct(*columns), "batch").alias("f")
        return wanted.groupBy(S.KEY, F.col(fragments.SLOT).alias("__slot")).agg(newest).select("f.*")

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        place = fragments.slot_of(slot)
        kept = batch.where(F.col(S.KEY).isNotNull()).withColumn(fragments.SLOT, place)
        kept.write.mode("overwrite").partitionBy(fragments.SLOT).parquet(f"{rows_path}/batch={number}")
        # This batch's folder alone: older ones are listed only if rows are late.
        fresh = spark.read.schema(T.StructType(list(kept.schema))).parquet(f"{rows_path}/batch={number}")
        new = fragments.fold(fresh.select(*batch.columns), place, tiebreak)
        new = new.select(S.KEY, fragments.SLOT, *[c for c in new.columns if c not in (S.KEY, fragments.SLOT)])
        new = cut_lineage(new)
        by = [S.KEY, fragments.SLOT]
        spark.createDataFrame([], new.schema).write.mode("ignore").parquet(f"{fragments_path}/batch=-1")
        schema = T.StructType(list(new.schema))

        # Equal order counts as late: the rows are read again and ordered as one.
        slots = new.select(S.KEY, F.col(fragments.SLOT), F.col("first").alias("begins"))
        same = [S.KEY, "__slot"]
        old = cut_lineage(stored(spark, T.StructType(list(schema)), number, slots.select(S.KEY).distinct(), [S.KEY]))
        ends = old.select(S.KEY, F.coalesce(fragments.SLOT, F.lit(NO_SLOT)).alias("__slot"), F.col("last").alias("ended"))
        begins = slots.select(S.KEY, F.coalesce(fragments.SLOT, F.lit(NO_SLOT)).alias("__slot"), "begins")
        met = begins.join(ends, same).withColumn("is_late", F.col("begins") <= F.col("ended"))
        late = met.where("is_late").select(*same)
        found = met.agg(F.coalesce(F.max("is_late"), F.lit(False)).alias("late"), F.coalesce(F.min("is_late"), F.lit(True)).alias("all_late")).first()
        any_late, any_before = found["late"], not found["all_late"]

        def keyed(df: DataFrame) -> DataFrame:
            return df.withColumn("__slot", F.coalesce(fragments.SLOT, F.lit(NO_SLOT)))

        current = keyed(new).join(late, same, "left_anti").select(*new.columns) if any_late else new
        if any_before:
            before = keyed(old).join(keyed(current).select(*same), same, "left_semi").select(*new.columns)
            current = fragments.combine(before.unionByName(current), by).select(*new.columns)
        if any_late:
            # Few slots are named in the scan's partition filter; more of them are left to the join.
            rows = spark.read.schema(T.StructType(list(kept.schema)).add("batch", "long")).parquet(rows_path).where(F.col("batch") <= number)
            named = [r["__slot"] for r in late.select("__slot").distinct().limit(MOST_NAMED_SLOTS + 1).collect()]
            if len(named) <= MOST_NAMED_SLOTS and NO_SLOT not in named:
                rows = rows.where(F.col(fragments.SLOT).isin(named))
            again = keyed(rows).join(late, same, "left_semi")
            current = current.unionByName(fragments.fold(again.select(*batch.columns), place, tiebreak).select(*new.columns))
        current.write.mode("overwrite").parquet(f"{fragments_path}/batch={number}")

        written = spark.read.schema(schema).parquet(f"{fragments_path}/batch={number}")
        others = keyed(old).join(keyed(written).select(*same), same, "left_anti").select(*new.columns)
        whole = fragments.combine(written.unionByName(others), [S.KEY])
        fragments.features(whole).write.mode("overwrite").parquet(f"{features_path}/batch={number}")

    return write


NO_SLOT = -(1 << 62)                # stands for the slot of rows without a time
MOST_NAMED_SLOTS = 1000


def latest_trips(spark: SparkSession, features_path: str) -> DataFrame:
    """The newest version of each trip's features."""
    versions = spark.read.parquet(features_path)
    columns = [c for c in versions.columns if c not in (S.KEY, "batch")]
    newest = F.max_by(F.struct(*columns), "batch")
    return versions.groupBy(S.KEY).agg(newest.alias("f")).select(S.KEY, "f.*")


def run_each_batch(
    stream: DataFrame, name: str, body: Callable[[DataFrame, int], None], progress: str | None = None
) -> None:
    writer = (
        stream.writeStream.foreachBatch(body)
        .option("checkpointLocation", progress or work_path(stream.sparkSession, f"{name}-progress"))
        .trigger(availableNow=True)
    )
    with state_on_disk(stream.sparkSession):
        query = writer.start()
    query.awaitTermination()


def score(features: DataFrame, model: scoring.LinearModel, keep: Sequence[str] = ()) -> DataFrame:
    """Scores of a stream of trip features."""
    return scoring.score_batch(features, model, keep=keep)
