"""The test tables seen as sensor, label, driver, wide-feature and scored tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odolytics.operators import cleaning, trips
from odolytics.streaming.jobs import end_of_input

TIEBREAK = ["event_id"]
WIDE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sensor_from_events(events: DataFrame) -> DataFrame:
    """One sensor row per event; works on a table or a stream of events."""
    e, k = F.col("event_id"), F.col("k")

    def axis(factor: int, span: int, middle: int):
        return (((e * factor) % span - middle) / F.lit(100.0) / k)

    hour = F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ'2024-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))")
    return (
        events.withColumn("k", F.when(F.col("event_type").isin("view", "click"), F.lit(20.0)).otherwise(F.lit(1.0)))
        .select(
            F.col("user_id").alias("bookingID"),
            "event_id",
            (hour + F.when(e % 97 == 0, F.lit(30000)).otherwise(F.lit(0))).cast("long").alias("second"),
            F.when(e % 41 == 0, F.lit(None).cast("double"))
            .when(e % 37 == 0, F.lit(60.0)).otherwise((e % 45).cast("double")).alias("accuracy"),
            F.when(e % 53 == 0, F.lit(-1.0)).otherwise(F.col("value") / F.lit(5.0)).alias("speed"),
            axis(37, 2001, 1000).alias("acceleration_x"),
            axis(53, 6001, 3000).alias("acceleration_y"),
            axis(71, 2701, 1350).alias("acceleration_z"),
            axis(29, 311, 155).alias("gyro_x"),
            axis(43, 531, 265).alias("gyro_y"),
            axis(61, 381, 190).alias("gyro_z"),
            *([F.col("ts")] if events.isStreaming else []),
        )
    )


def event_files(spark: SparkSession, folder: str, path: str, pieces: int = 4, overlap: str = "12 hours") -> int:
    """The events as files that arrive one after another: pieces of equal time, oldest first.

    Of the rows at the end of a piece every other one comes with the next piece, so files overlap in time and
    trips run on from file to file. The last file holds the row that ends the input. A piece of a large table is written
    by many tasks, as a file each: the most files that came with one piece are returned.
    """
    events = table(spark, folder, "events")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    if low is None:
        events.write.parquet(path)
        return 1
    step = (high - low) / pieces
    arrival = F.when(F.col("event_id") % 2 == 0, F.col("ts") + F.expr(f"INTERVAL {overlap}")).otherwise(F.col("ts"))
    cuts = [F.lit(low + n * step).cast("timestamp_ntz") for n in range(1, pieces)]
    piece = sum(((arrival >= cut).cast("int") for cut in cuts), F.lit(0))
    counted = [0]
    for n in range(pieces):
        events.where(piece == n).write.mode("append").parquet(path)
        counted.append(len(spark.read.schema(events.schema).parquet(path).inputFiles()))
    # Event 1 passes the row filters.
    end_of_input(events, "user_id", "ts").withColumn("event_id", F.lit(1).cast("long")).write.mode("append").parquet(path)
    return max(after - before for before, after in zip(counted, counted[1:]))


def sensor(spark: SparkSession, folder: str) -> DataFrame:
    return sensor_from_events(table(spark, folder, "events"))


def safety_label(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("bookingID"),
        (key + 7).alias("driver_id"),
        F.when(key % 4 == 0, F.lit(1)).otherwise(F.lit(0)).alias("label"),
    )


def driver(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("id"),
        F.col("c_name").alias("name"),
        F.date_add(F.lit("1960-01-01").cast("date"), ((key * 37) % 14000).cast("int")).alias("date_of_birth"),
        F.when(key % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.col("c_mktsegment").alias("car_brand"),
        (F.lit(2000) + key % 24).cast("int").alias("car_model_year"),
        (F.lit(1.0) + (key % 41) / F.lit(10.0)).alias("rating"),
        (key % 65).cast("int").alias("no_of_years_driving_exp"),
    )


def driver_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Drivers as in a raw file: dates and numbers as text, some of them unreadable."""
    d = driver(spark, folder)
    return d.select(
        F.col("id").alias("driver_id"),
        F.col("name").alias("driver_name"),
        F.when(F.col("id") % 13 == 0, F.lit("unknown"))
        .otherwise(F.date_format("date_of_birth", "MM/dd/yyyy")).alias("data_of_birth"),
        "gender", "car_brand", "car_model_year",
        F.when(F.col("id") % 11 == 0, F.lit("n/a")).otherwise(F.col("rating").cast("string")).alias("driver_rating"),
        F.when(F.col("id") % 17 == 0, F.lit("")).otherwise(
            F.col("no_of_years_driving_exp").cast("string")
        ).alias("No_of_Years_driving_exp"),
    )


def processed_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Trips an earlier run has already turned into features: customers in credit."""
    return table(spark, folder, "customer").where(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("bookingID"))


def wide(spark: SparkSession, folder: str) -> DataFrame:
    """A wide numeric table with a binary class."""
    return table(spark, folder, "lineitem").select(
        *WIDE, F.when(F.col("l_returnflag") == "R", F.lit(1)).otherwise(F.lit(0)).alias("label")
    )


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with a true class and two probabilities, one per scoring run."""
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    return table(spark, folder, "lineitem").select(
        order.alias("order_key"),
        line.alias("line_number"),
        "l_linestatus", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.when(F.col("l_returnflag") == "R", F.lit(1)).otherwise(F.lit(0)).alias("label"),
        (((order * 31 + line * 17) % 1000) / F.lit(1000.0)).alias("p"),
        (((order * 13 + line * 29) % 1000) / F.lit(1000.0)).alias("p_other"),
    )


def trip_table(spark: SparkSession, folder: str) -> DataFrame:
    """Trip features with a label that depends on them, for training."""
    features = trips.trip_features(sensor(spark, folder), tiebreak=TIEBREAK)
    signal = F.col("speed_mean") + ((F.col("bookingID") * 17) % 10) / F.lit(5.0)
    return features.withColumn("label", F.when(signal > F.lit(11.6), F.lit(1)).otherwise(F.lit(0)))


def features_ready(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.select_existing(
        trips.trip_features_serving(sensor(spark, folder), TIEBREAK), ["bookingID", *trips.S.SERVING_FEATURES]
    )
