"""Exact quantiles (linear interpolation) that never gather a whole column in one task.

Columns with few enough distinct values are counted by value in one scan. For the others every wanted
position is first bracketed between two approximate quantiles, and the rows below and inside the bracket
are counted: two scans with map-side combine. Brackets narrow until few enough values are left, then one
last scan ranks just the rows inside them. A bracket that samples no longer narrow is halved between
neighbouring numbers instead, so no bracket is ever ranked with more values than the limit.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALUES_PER_TASK = 500_000     # distinct values one task may rank
ACCURACY = 10_000


@dataclass
class Target:
    column: str
    probability: float
    position: float          # wanted 0-based position among the column's values
    low: float
    high: float
    below: int               # values smaller than ``low``
    inside: int              # values in [low, high]
    distinct: int            # about how many different values that is at most
    slack: float = 2.0 / ACCURACY
    pair: bool = False       # lies between the largest value of the lower half and the smallest of the upper

    def holds(self) -> Column:
        return F.col(self.column).between(F.lit(self.low), F.lit(self.high))

    def bracket(self) -> Column:
        return F.when(self.holds(), F.col(self.column))

    def local(self) -> float:
        """The wanted position as a fraction of the bracket."""
        return 0.0 if self.inside <= 1 else min(1.0, max(0.0, (self.position - self.below) / (self.inside - 1)))

    def halves(self) -> list[tuple[float, float]]:
        """The bracket cut in two between neighbouring numbers, for when samples no longer narrow it."""
        low, high = _rank(self.low), _rank(self.high)
        middle = (low + high) // 2
        return [(self.low, _number(middle)), (_number(middle + 1), self.high)]

    def around(self) -> list[float]:
        return [max(0.0, self.local() - self.slack), min(1.0, self.local() + self.slack)]


def _rank(x: float) -> int:
    """Place of a number among all doubles in order."""
    bits = struct.unpack("<q", struct.pack("<d", x + 0.0))[0]
    return bits if bits >= 0 else -(bits & 0x7FFFFFFFFFFFFFFF)


def _number(rank: int) -> float:
    return struct.unpack("<d", struct.pack("<q", rank))[0] if rank >= 0 else -_number(-rank)


def _halve(df: DataFrame, targets: list[Target]) -> None:
    """Take the half that holds the position: at most 64 rounds lead to a single number."""
    counts = []
    for i, t in enumerate(targets):
        (low, middle), (after, high) = t.halves()
        c = F.col(t.column)
        counts += [
            F.count_if(c.between(F.lit(low), F.lit(middle))).alias(f"l{i}"), F.count_if(c.between(F.lit(after), F.lit(high))).alias(f"r{i}"),
            F.approx_count_distinct(F.when(c.between(F.lit(low), F.lit(middle)), c)).alias(f"dl{i}"),
            F.approx_count_distinct(F.when(c.between(F.lit(after), F.lit(high)), c)).alias(f"dr{i}"),
        ]
    found = df.agg(*counts).first()
    for i, t in enumerate(targets):
        (low, middle), (after, high) = t.halves()
        left = found[f"l{i}"]
        if math.ceil(t.position) < t.below + left:
            t.low, t.high, t.inside, t.distinct = low, middle, left, found[f"dl{i}"]
        elif math.floor(t.position) >= t.below + left:
            t.low, t.high, t.below, t.inside, t.distinct = after, high, t.below + left, found[f"r{i}"], found[f"dr{i}"]
        else:
            t.pair = True       # the two values it lies between are the ends of the halves
        if t.low == t.high:
            t.distinct = 1


def _narrow(df: DataFrame, targets: list[Target], again: bool) -> None:
    """One round: propose a tighter bracket for each target, and take it if it holds the position."""
    shared: dict[tuple, list[Target]] = {}
    for t in targets:
        shared.setdefault((t.column, t.low, t.high), []).append(t)
    cuts = df.agg(
        *[
            F.percentile_approx(group[0].bracket(), [f for t in group for f in t.around()], ACCURACY).alias(f"g{i}")
            for i, group in enumerate(shared.values())
        ]
    ).first()
    proposals = []
    for i, group in enumerate(shared.values()):
        proposals += [(t, cuts[f"g{i}"][2 * j], cuts[f"g{i}"][2 * j + 1]) for j, t in enumerate(group)]
    counts = []
    for i, (t, low, high) in enumerate(proposals):
        c = F.col(t.column)
        inside = c.between(F.lit(low), F.lit(high))
        counts += [F.count_if(c < F.lit(low)).alias(f"b{i}"), F.count_if(inside).alias(f"i{i}")]
        if again:
            counts.append(F.approx_count_distinct(F.when(inside, c)).alias(f"d{i}"))
    found = df.agg(*counts).first()
    for i, (t, low, high) in enumerate(proposals):
        below, inside = found[f"b{i}"], found[f"i{i}"]
        covers = below <= math.floor(t.position) and math.ceil(t.position) < below + inside
        if covers and inside < t.inside:
            t.low, t.high, t.below, t.inside = low, high, below, inside
        else:
            t.slack *= 4
        if again and covers:
            t.distinct = min(t.distinct, found[f"d{i}"]) if inside == t.inside else t.distinct
        t.distinct = 1 if t.low == t.high else min(t.distinct, t.inside)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    values_per_task: int = VALUES_PER_TASK,
) -> DataFrame:
    """Rows (feature, probability, value); columns without any value give NULL."""
    data = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    stats = data.agg(
        *[
            F.struct(
                F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high"),
                F.approx_count_distinct(c).alias("distinct"),
            ).alias(c)
            for c in columns
        ]
    ).first()
    budget = max(1, values_per_task // max(1, len(columns)))
    whole = [c for c in columns if stats[c]["distinct"] <= budget]
    targets = [
        Target(c, p, p * (stats[c]["n"] - 1), stats[c]["low"], stats[c]["high"], 0, stats[c]["n"], stats[c]["n"])
        for c in columns if c not in whole
        for p in probabilities
    ]
    share, still_open, again = max(1, values_per_task // max(1, len(targets) + len(whole))), targets, False
    while still_open:
        sampled = [t for t in still_open if t.slack < 1.0]
        halved = [t for t in still_open if t.slack >= 1.0]
        if sampled:
            _narrow(data, sampled, again)
        if halved:
            _halve(data, halved)
        still_open = [t for t in still_open if t.distinct > share and not t.pair]
        again = True
    between = [t for t in targets if t.pair]
    targets = [t for t in targets if not t.pair]
    wanted = [float(p) for p in probabilities]
    parts = []
    if whole:
        wide = data.agg(*[F.percentile(c, F.array(*map(F.lit, wanted))).alias(c) for c in whole])
        parts.append(_tall(wide, [(c, p, F.col(c)[i]) for c in whole for i, p in enumerate(wanted)]))
    if targets:
        near = data.where(reduce(lambda a, b: a | b, [t.holds() for t in targets]))
        wide = near.agg(*[F.percentile(t.bracket(), F.lit(t.local())).alias(f"t{i}") for i, t in enumerate(targets)])
        parts.append(_tall(wide, [(t.column, t.probability, F.col(f"t{i}")) for i, t in enumerate(targets)]))
    if between:
        ends = []
        for i, t in enumerate(between):
            (low, middle), (after, high) = t.halves()
            c = F.col(t.column)
            ends += [
                F.max(F.when(c.between(F.lit(low), F.lit(middle)), c)).alias(f"a{i}"),
                F.min(F.when(c.between(F.lit(after), F.lit(high)), c)).alias(f"b{i}"),
            ]
        share_of = [t.position - math.floor(t.position) for t in between]
        parts.append(_tall(data.agg(*ends), [
            (t.column, t.probability, F.col(f"a{i}") + (F.col(f"b{i}") - F.col(f"a{i}")) * F.lit(w))
            for i, (t, w) in enumerate(zip(between, share_of))
        ]))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _tall(wide: DataFrame, values: Sequence[tuple[str, float, Column]]) -> DataFrame:
    structs = [
        F.struct(F.lit(c).alias("feature"), F.lit(float(p)).alias("probability"), v.alias("value")) for c, p, v in values
    ]
    return wide.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def quantile_values(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], **kw) -> dict:
    """The same, as {(feature, probability): value}: one number per feature and probability."""
    return {(r["feature"], r["probability"]): r["value"] for r in exact_quantiles(df, columns, probabilities, **kw).collect()}
