"""Small Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nan_to_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def utc_instant(naive: Column) -> Column:
    """The instant of a time without zone that is meant as UTC, whatever the session's zone."""
    return F.from_utc_timestamp(naive.cast("timestamp"), F.current_timezone())


def flag(condition: Column) -> Column:
    """A condition that is false, not missing, when its input is missing."""
    return F.coalesce(condition, F.lit(False))


def share(condition: Column) -> Column:
    return F.avg(condition.cast("int"))


def count_true(condition: Column) -> Column:
    return F.sum(condition.cast("long"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL, never an error, for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def magnitude(columns: Iterable[Column]) -> Column:
    total = None
    for c in columns:
        total = c * c if total is None else total + c * c
    return F.sqrt(total)


def right_closed_bins(column: Column, bins: Sequence[tuple]) -> Column:
    """Name of the bin (low, high] holding the value; NULL outside every bin."""
    result = None
    for low, high, name in bins:
        inside = (column > F.lit(low)) & (column <= F.lit(high))
        result = F.when(inside, F.lit(name)) if result is None else result.when(inside, F.lit(name))
    return result


def long_form(df: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One (feature, value) row per listed column, next to the kept columns."""
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keep), list(columns), "feature", "value"
    )


def rows_from_structs(one_row: DataFrame, fields: dict[str, dict[str, Column]], name: str = "feature") -> DataFrame:
    """Turn one wide aggregate row into one row per feature.

    ``fields`` maps feature name -> {output column: expression over the wide row}.
    """
    structs = [
        F.struct(F.lit(feature).alias(name), *[expr.alias(out) for out, expr in outs.items()])
        for feature, outs in fields.items()
    ]
    return one_row.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


SMALL_ROWS = 100_000


def broadcast_if_small(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """A broadcast hint for a table counted to be small; a larger one is left to a shuffled join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


BROADCAST_BYTES = 64 << 20


def broadcast_under(df: DataFrame, row_bytes: Column, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint for a table whose rows add up to few bytes, whatever their arrays hold; a larger one is
    left to a shuffled join. ``df`` is read twice: pass a written table."""
    total = df.agg(F.sum(row_bytes.cast("long"))).first()[0] or 0
    return F.broadcast(df) if total <= most_bytes else df
