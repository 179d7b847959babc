"""Reading sensor, label and driver input, and checking its shape."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odolytics import schema as S

RAW_SENSOR, FEATURES_READY, UNKNOWN = "RAW_SENSOR", "FEATURES_READY", "UNKNOWN"

# Lower-case names and the columns they stand for (fixed values).
ALIASES = {
    "bookingid": "bookingID",
    "booking_id": "bookingID",
    "second": "second",
    "speed": "speed",
    "accuracy": "accuracy",
    "bearing": "bearing",
    "acceleration_x": "acceleration_x",
    "acceleration_y": "acceleration_y",
    "acceleration_z": "acceleration_z",
    "gyro_x": "gyro_x",
    "gyro_y": "gyro_y",
    "gyro_z": "gyro_z",
}


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file, from its first line only."""
    return spark.read.option("header", True).csv(path).columns


SEPARATORS = [",", ";", "\t", "|"]


def _cells(line: str, separator: str) -> tuple[str, ...]:
    return tuple(c.strip().strip('"').lstrip("\ufeff") for c in line.split(separator))


def file_headers(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = S.SENSOR_SCHEMA
) -> dict[tuple[str, tuple[str, ...]], list[str]]:
    """Files by separator and header, from one distributed pass over the text; no file with a line is left out.

    The header of a file is its line that names at least two of the schema's columns (or is the first line of a
    table with one column); where no line does, its first line. One row per file reaches the driver. Give ``read_csv``
    the header to save this pass.
    """
    known = {f.name.lower() for f in schema.fields}
    known |= {name for name, column in ALIASES.items() if column.lower() in known}
    wanted = F.array(*[F.lit(k) for k in sorted(known)])
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("line")
    ).where(F.col("at") == 0)

    def named(separator: str) -> Column:
        cells = F.transform(F.split("value", f"[{separator}]"), lambda c: F.lower(F.trim(F.translate(c, '"\ufeff', ""))))
        return F.size(F.array_intersect(cells, wanted))

    # The lines of a file's first block lie in one task, in order.
    recognised = F.greatest(*[named(s) for s in SEPARATORS]) >= min(2, len(known))
    found = lines.groupBy("file").agg(F.min(F.when(recognised, F.col("value"))).alias("header"), F.min_by("value", "line").alias("first"))
    groups: dict[tuple[str, tuple[str, ...]], list[str]] = defaultdict(list)
    for row in found.orderBy("file").collect():
        header = row["header"] if row["header"] is not None else row["first"]
        separator = max(SEPARATORS, key=lambda s: (len(known & {c.lower() for c in _cells(header, s)}), header.count(s), -SEPARATORS.index(s)))
        groups[separator, _told_apart(_cells(header, separator))].append(row["file"])
    return groups


def _told_apart(names: Sequence[str]) -> tuple[str, ...]:
    """Names that are missing or repeat get their place added."""
    lower = [n.lower() for n in names]
    return tuple(n if n and lower.index(n.lower()) == i else f"{n or 'column'}_{i}" for i, n in enumerate(names))


def _whole(column: Column) -> Column:
    """A whole number, also where it is written with a fraction of zero (``12.0``); else NULL."""
    number = column.try_cast("double")
    exact = column.try_cast("long")
    return F.coalesce(exact, F.when((number == F.floor(number)) & (F.abs(number) < F.lit(2.0**53)), number.try_cast("long")))


def _parsed(text: Column, kind: T.DataType) -> Column:
    return _whole(text).try_cast(kind) if isinstance(kind, (T.LongType, T.IntegerType)) else text.try_cast(kind)


def typed(df: DataFrame, schema: T.StructType = S.SENSOR_SCHEMA, text_key: bool = False) -> DataFrame:
    """Text columns brought to the schema's types; what does not parse becomes NULL. ``text_key`` keeps ids as text."""
    kinds = {f.name: f.dataType for f in schema.fields}

    def one(name: str) -> Column:
        column, kind = F.col(f"`{name}`"), kinds.get(name)
        if kind is None or (text_key and name == S.KEY):
            return column
        if df.schema[name].dataType == T.StringType():
            return _parsed(F.trim(column), kind).alias(name)
        return column.try_cast(kind).alias(name)

    return df.select(*[one(c) for c in df.columns])


def _read_text(spark: SparkSession, names: Sequence[str], files: str | Sequence[str], separator: str = ",") -> DataFrame:
    """One group of files with the same header, all columns as text."""
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    # Names that were told apart differ from the header line; the other headers are checked against it.
    checked = not any(n.endswith(f"_{i}") for i, n in enumerate(names))
    reader = spark.read.option("header", True).option("enforceSchema", not checked).option("sep", separator)
    return standardize_columns(reader.schema(text).csv(files))


def read_text(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = S.SENSOR_SCHEMA, header: Sequence[str] | None = None
) -> DataFrame:
    """CSV files with a header line each as one table of text: columns go by name, absent ones are NULL.

    A file whose header names no known column is read by its first line, so its rows come with columns of their own.
    """
    groups = {(",", tuple(header)): paths} if header else file_headers(spark, paths, schema)
    if not groups:
        raise ValueError("no file with a line")
    frames = [_read_text(spark, names, files, separator) for (separator, names), files in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = S.SENSOR_SCHEMA, header: Sequence[str] | None = None,
    text_key: bool = False,
) -> DataFrame:
    """CSV with a header line per file; types come from the schema, never from a pass over the data.

    Everything is read as text and converted, so that whole numbers written as ``12.0`` are not lost. Rows in which
    something does not parse are kept with a NULL there; ``rejects`` lists them.
    """
    return typed(read_text(spark, paths, schema, header), schema, text_key)


def rejects(text: DataFrame, schema: T.StructType = S.SENSOR_SCHEMA) -> DataFrame:
    """Rows of a table of text in which a value is there but does not parse, with the columns' names."""
    kinds = {f.name: f.dataType for f in schema.fields}
    marks = [
        F.when(F.col(f"`{c}`").isNotNull() & (F.trim(f"`{c}`") != "") & _parsed(F.trim(F.col(f"`{c}`")), kinds[c]).isNull(), F.lit(c))
        for c in text.columns if c in kinds
    ]
    return text.withColumn("unparsed", F.filter(F.array(*marks), lambda m: m.isNotNull())).where(F.size("unparsed") > 0)


def read_csv_union(spark: SparkSession, paths: Sequence[str], schema: T.StructType = S.SENSOR_SCHEMA) -> DataFrame:
    """Several CSV inputs as one table, whatever columns each file has."""
    return read_csv(spark, list(paths), schema)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_jdbc(
    spark: SparkSession, url: str, table: str, partition_column: str | None = None, bounds: tuple[int, int] | None = None,
    partitions: int = 32, options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table, read in parallel ranges of a numeric column; credentials come in ``options``."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {}))
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(partitions)
        )
    return reader.load()


def standardize_columns(df: DataFrame) -> DataFrame:
    """Trim names and map known spellings to the sensor columns."""
    return df.toDF(*[ALIASES.get(c.strip().lower(), c.strip()) for c in df.columns])


def drop_index_columns(df: DataFrame) -> DataFrame:
    return df.select(*[f"`{c}`" for c in df.columns if not c.startswith("Unnamed")])


def detect_stage(columns: Sequence[str], model_features: Sequence[str] = tuple(S.SERVING_FEATURES)) -> str:
    """What a table holds, judged by its standardised column names."""
    found = {ALIASES.get(c.strip().lower(), c.strip()).lower() for c in columns}
    if {c.lower() for c in S.REQUIRED_COLUMNS} <= found:
        return RAW_SENSOR
    if S.KEY.lower() in found and {c.lower() for c in model_features} <= found:
        return FEATURES_READY
    return UNKNOWN


def missing_columns(df: DataFrame, required: Sequence[str] = tuple(S.REQUIRED_COLUMNS)) -> list[str]:
    have = set(standardize_columns(df).columns)
    return [c for c in required if c not in have]


def validate_input(df: DataFrame, required: Sequence[str] = tuple(S.REQUIRED_COLUMNS)) -> tuple[bool, str]:
    """(usable, message naming the missing columns). No size limit: a large input is more partitions."""
    missing = missing_columns(df, required)
    return (not missing, f"Missing required columns: {', '.join(missing)}" if missing else "")


def validation_table(df: DataFrame, required: Sequence[str] = tuple(S.REQUIRED_COLUMNS)) -> DataFrame:
    """The same per column, with the rows that hold a value, from one scan."""
    data = standardize_columns(df)
    have = set(data.columns)
    wide = data.agg(*[(F.count(c) if c in have else F.lit(0)).cast("long").alias(c) for c in required])
    structs = [
        F.struct(F.lit(c).alias("column_name"), F.lit(c in have).alias("present"), F.col(c).alias("n_values")) for c in required
    ]
    return wide.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def cast_sensor(df: DataFrame, text_key: bool = False) -> DataFrame:
    """Text columns to sensor types; what does not parse becomes NULL."""
    return typed(df, S.SENSOR_SCHEMA, text_key)


