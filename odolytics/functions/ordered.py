"""Ordered per-group work (previous row, running sum, forward fill) that survives a hot group.

A group of ordinary size is one window partition: one exchange on its key. A group holding more than
``hot_rows`` rows - one trip may hold a third of the table, or be one row copied over and over - is cut
into ranges of the sort order instead. Each range is its own window partition, and the few values that
must cross a cut (last row, running total, last known reading) are worked out on one edge row per range
and handed to the next one. No row is dropped and both ways give the same result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odolytics.session import cut_lineage

HOT_ROWS = 1_000_000        # rows one task may hold for one group
MAX_LITERAL_KEYS = 1_000    # hot keys listed in the plan itself; more than that are joined
CHUNK = "__chunk"
COPY = "__copy"
TIE = "__tie"


@dataclass(frozen=True)
class Ordered:
    """Rows with a sort order inside each group; ``chunked`` rows also carry a range number."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    chunked: bool = False

    def with_df(self, df: DataFrame) -> Ordered:
        return replace(self, df=df)

    @property
    def window(self):
        cut = [CHUNK] if self.chunked else []
        return Window.partitionBy(*cut, *self.keys).orderBy(*self.order)

    def _carry(self, edge: dict[str, Column], carried: dict[str, Callable[[str, object], Column]]) -> DataFrame:
        """Values each range receives from the ranges before it, one row per (range, group)."""
        edges = self.df.groupBy(CHUNK, *self.keys).agg(*[c.alias(n) for n, c in edge.items()])
        across = Window.partitionBy(*self.keys).orderBy(CHUNK)
        columns = [make(name, across).alias(f"__in_{name}") for name, make in carried.items()]
        return edges.select(CHUNK, *self.keys, *columns)

    def _take(self, carry: DataFrame) -> DataFrame:
        return self.df.join(carry, [CHUNK, *self.keys], "left")

    def previous(self, columns: Sequence[str], prefix: str = "prev_") -> Ordered:
        """Each listed column's value on the row before, as ``prev_<column>``."""
        lags = {prefix + c: F.lag(c).over(self.window) for c in columns}
        if not self.chunked:
            return self.with_df(self.df.withColumns(lags))
        last_row = F.max_by(F.struct(*columns), F.struct(*self.order))
        carry = self._carry({"row": last_row}, {"row": lambda n, w: F.lag(n).over(w)})
        first = F.row_number().over(self.window) == 1
        filled = {
            prefix + c: F.when(first, F.col("__in_row")[c]).otherwise(lags[prefix + c]) for c in columns
        }
        return self.with_df(self._take(carry).withColumns(filled).drop("__in_row"))

    def running(self, sums: dict[str, Column] | None = None, last: dict[str, Column] | None = None) -> Ordered:
        """Running totals, and last values that are not NULL, up to and including the row."""
        sums, last = sums or {}, last or {}
        upto = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = {n: F.sum(c).over(upto) for n, c in sums.items()}
        local |= {n: F.last(c, ignorenulls=True).over(upto) for n, c in last.items()}
        if not self.chunked:
            return self.with_df(self.df.withColumns(local))
        position = F.struct(*self.order)
        edge = {n: F.sum(c) for n, c in sums.items()}
        edge |= {n: F.max_by(c, F.when(c.isNotNull(), position)) for n, c in last.items()}

        def total_before(name, across):
            return F.sum(name).over(across.rowsBetween(Window.unboundedPreceding, -1))

        def last_before(name, across):
            return F.last(name, ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1))

        carry = self._carry(edge, {n: total_before for n in sums} | {n: last_before for n in last})
        full = {n: local[n] + F.coalesce(F.col(f"__in_{n}"), F.lit(0)) for n in sums}
        full |= {n: F.coalesce(local[n], F.col(f"__in_{n}")) for n in last}
        return self.with_df(self._take(carry).withColumns(full).drop(*[f"__in_{n}" for n in local]))

    def rows(self) -> DataFrame:
        return self.df.drop(CHUNK, COPY, TIE)


def by_time(df: DataFrame, time: str, tiebreak: Sequence[str], readings: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Rows and their sort order. Rows of the same time need a second key for a repeatable result: the
    given columns, or else a hash of the readings, under which only identical rows are equal."""
    if tiebreak:
        return df, [time, *tiebreak]
    return df.withColumn(TIE, F.xxhash64(*readings)), [time, TIE]


def cut_ranges(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], pieces: int, written: bool = False
) -> Ordered:
    """Range-partition by (keys, order) and give each row the number of its range.

    The rows are written first: numbering copies of one row, and sampling the ranges, must see the same
    rows in the same order again when a task is repeated. The numbered rows are written too, since
    several parts of the plan read them and must agree on the ranges.
    """
    numbered = (df if written else cut_lineage(df)).withColumn(COPY, F.monotonically_increasing_id())
    sort = [*keys, *order, COPY]
    ranged = numbered.repartitionByRange(max(2, pieces), *sort).withColumn(CHUNK, F.spark_partition_id())
    return Ordered(cut_lineage(ranged), tuple(keys), (*order, COPY), chunked=True)


def split_by_size(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int | None = HOT_ROWS
) -> list[Ordered]:
    """Ordinary groups as they are, and hot groups (if any) cut into ranges.

    Finding hot groups is one count per group over the key column alone, combined before the shuffle.
    ``hot_rows=None`` leaves the check out for data known to have no such group.
    """
    plain = Ordered(df, tuple(keys), tuple(order))
    if hot_rows is None:
        return [plain]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    found = counts.orderBy(F.desc("n")).limit(MAX_LITERAL_KEYS + 1).collect()
    if not found:
        return [plain]
    if len(found) <= MAX_LITERAL_KEYS:
        rows = sum(r["n"] for r in found)
        is_hot = reduce(
            lambda a, b: a | b,
            [reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(r[k])) for k in keys]) for r in found],
        ) if len(keys) > 1 else F.col(keys[0]).isin([r[keys[0]] for r in found])
        hot, calm = df.where(is_hot), df.where(~is_hot)
    else:
        rows = counts.agg(F.sum("n")).first()[0]
        ids = counts.select(*keys)
        hot, calm = df.join(ids, list(keys), "left_semi"), df.join(ids, list(keys), "left_anti")
    pieces = math.ceil(rows / hot_rows) * 2
    return [Ordered(calm, tuple(keys), tuple(order)), cut_ranges(hot, keys, order, pieces)]


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def whole_order(
    df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), rows_per_task: int = HOT_ROWS
) -> Ordered:
    """A sort order over a whole table (or over a few large groups such as the two classes).

    The rows are written once, so that counting them does not work them out twice. A table small enough
    for one task is one window; a larger one is cut into ranges.
    """
    written = cut_lineage(df)
    rows = written.count()
    if rows <= rows_per_task:
        return Ordered(written, tuple(keys), tuple(order))
    return cut_ranges(written, keys, order, math.ceil(rows / rows_per_task) * 2, written=True)
