"""Writing features, reports and predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odolytics import schema as S
from odolytics.operators.scoring import PREDICTION_COLUMNS


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A table written earlier, or None when there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_new(df: DataFrame, path: str, key: str = S.KEY) -> None:
    """Append the rows whose key the table does not hold yet; running it twice adds nothing."""
    have = stored(df.sparkSession, path)
    fresh = df if have is None else df.join(have.select(key), key, "left_anti")
    fresh.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_bucketed(
    df: DataFrame, table: str, buckets: int, key: str = S.KEY, order: Sequence[str] = (S.TIME,), path: str | None = None
) -> None:
    """A catalog table bucketed by trip and sorted by time, as the source keeps it by its primary key.
    Feature jobs and joins on the trip then read it without an exchange."""
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *order).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def export_predictions(results: DataFrame, path: str, run_id: str) -> None:
    """The six result columns as CSV, one folder per run; a rerun of the same run replaces its folder."""
    rows = results.select(*PREDICTION_COLUMNS, F.lit(run_id).alias("run_id"))
    rows.write.mode("overwrite").option("header", True).option("partitionOverwriteMode", "dynamic").partitionBy("run_id").csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    """Append to or replace a database table; credentials come in the options."""
    df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table).options(**options).save()
