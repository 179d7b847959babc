"""Counts of bins per class for many columns in one scan."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def bin_counts(binned: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """``label, feature, bin, n`` of a table whose columns hold bin numbers from 0 (NULL: in no bin).

    Every task counts all columns of its rows with arrays and hands on one row per (class, feature, bin) it met, so
    no row is repeated per feature and the shuffle holds tasks x classes x features x bins rows at most.
    """
    names = list(columns)
    schema = T.StructType([
        T.StructField("label", binned.schema[label].dataType), T.StructField("feature", T.StringType()),
        T.StructField("bin", T.IntegerType()), T.StructField("n", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            classes = batch.column(0).dictionary_encode()
            values = [*classes.dictionary.to_pylist(), None]
            code = classes.indices.fill_null(len(values) - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            for name, column in zip(names, batch.columns[1:]):
                bins = column.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                held = bins >= 0
                wide = int(bins.max(initial=0)) + 1
                found = np.bincount(code[held] * wide + bins[held], minlength=len(values) * wide)
                for cell in np.flatnonzero(found):
                    total[values[cell // wide], name, int(cell % wide)] += int(found[cell])
        keys = list(total)
        columns_out = [[k[i] for k in keys] for i in range(3)] + [[total[k] for k in keys]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(columns_out, kinds)], names=["label", "feature", "bin", "n"])

    kinds = [to_arrow_type(f.dataType) for f in schema.fields]
    ints = binned.select(F.col(label), *[F.col(f"`{c}`").cast("int").alias(c) for c in names])
    return ints.mapInArrow(run, schema).groupBy("label", "feature", "bin").agg(F.sum("n").alias("n"))
