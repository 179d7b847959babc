"""Size of the Arrow batches in which texts go to Python workers."""

from __future__ import annotations

from pyspark.sql import DataFrame

MOST_BYTES = 8 << 20
SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(df: DataFrame) -> DataFrame:
    """The same table, after lowering its session's limit on bytes per batch to 8 MB if it is higher.

    A batch stands in the executor's memory several times at once (on its way to the worker, in it, and as
    arrays made from it), for every task; long texts reach the limit on bytes well before that on rows.
    """
    conf = df.sparkSession.conf
    now = str(conf.get(SETTING, "64m")).lower().rstrip("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(now[-1:], 1)
    size = int(now.rstrip("kmg") or 0) * scale
    if size > MOST_BYTES:
        conf.set(SETTING, str(MOST_BYTES))
    return df
