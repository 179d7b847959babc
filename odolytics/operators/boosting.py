"""Boosted trees by second derivatives, grown best leaf first.

Rows are binned once and written: one byte per feature. A pass over them is one aggregate of gradient and curvature
sums per (node, feature, bin), added up inside every task before the shuffle; its result is bounded by nodes x features x
bins and goes to the driver, which keeps the queue of leaves. Splitting one leaf does not change the gain of another, so a
pass serves every leaf that the queue would split next: a tree takes about as many passes as it is deep.

Margins are not rewritten after every tree: tasks add the trees that came since the last written table, and after
``refresh`` trees the table is written anew.

A table of up to ``HELD_BYTES`` is held by one task, which grows all trees the same way from the same sums: a pass over it takes
less time than a job takes to start. What a task holds does not grow beyond that; larger tables are passed over by all tasks.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odolytics.operators.scoring import decide
from odolytics.session import work_path

BINS = 256
SEED = 42
PASS_BYTES = 64 << 20       # sums that a task holds; more nodes than that take several passes
SUM_ROWS = 4_000_000        # sums of tasks that one task of the shuffle adds up
HELD_BYTES = 64 << 20       # of a table that one task holds: some million rows
ROW_BYTES = 64              # of a held row beside its bins
_TABLE = "row long, label double, weight double, margin double, bins binary"


@dataclass
class Tree:
    """Nodes in order of their making; a leaf has no feature."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])         # bins up to this one go left
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    rows: list[float] = field(default_factory=lambda: [0.0])
    depth: list[int] = field(default_factory=lambda: [0])

    def add(self, depth: int) -> int:
        for name, value in (("feature", -1), ("cut", 0), ("left", 0), ("right", 0), ("value", 0.0), ("gain", 0.0), ("rows", 0.0), ("depth", depth)):
            getattr(self, name).append(value)
        return len(self.feature) - 1

    def node_of(self, bins: np.ndarray) -> np.ndarray:
        feature, cut, left, right = (np.array(x) for x in (self.feature, self.cut, self.left, self.right))
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            inner = feature[node] >= 0
            if not inner.any():
                return node
            goes_left = bins[rows, np.maximum(feature[node], 0)] <= cut[node]
            node = np.where(inner, np.where(goes_left, left[node], right[node]), node)


@dataclass
class Settings:
    rounds: int = 200
    depth: int | None = 10
    leaves: int | None = None           # None: as many as the depth allows
    rate: float = 0.05
    rows: float = 0.8                   # share of rows and of columns that a tree sees
    columns: float = 0.8
    l2: float = 1.0
    l1: float = 0.0
    least_weight: float = 1.0           # sum of curvature on either side of a split
    least_rows: int = 1
    least_gain: float = 0.0
    positive_scale: float = 1.0
    from_average: bool = False          # start at the log-odds of the table instead of even odds
    bins: int = BINS
    refresh: int = 10
    seed: int = SEED


@dataclass
class BoostedModel:
    """Trees with their thresholds; scores with NumPy over Arrow batches, or as a SQL expression."""

    features: list[str]
    trees: list[Tree]
    cuts: list[np.ndarray]
    start: float
    threshold: float = 0.5

    def _margin(self) -> Column:
        trees, cuts, start = self.trees, self.cuts, self.start

        @F.pandas_udf("double")
        def margin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                bins = _binned(batch.to_numpy(dtype=float), cuts)
                total = np.full(len(bins), start)
                for tree in trees:
                    total += np.array(tree.value)[tree.node_of(bins)]
                yield pd.Series(total)

        return margin(F.struct(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in self.features]))

    def probability(self, df: DataFrame) -> DataFrame:
        """Add ``probability_dangerous``."""
        margin = self._margin()
        return df.withColumn("__margin", margin).withColumn("probability_dangerous", 1.0 / (1.0 + F.exp(-F.col("__margin")))).drop("__margin")

    def score(self, df: DataFrame, threshold: float | None = None) -> DataFrame:
        return decide(self.probability(df), self.threshold if threshold is None else threshold)

    def sql(self) -> str:
        """The margin as nested CASE expressions over the feature columns."""

        def node(tree: Tree, at: int) -> str:
            if tree.feature[at] < 0:
                return f"CAST({tree.value[at]!r} AS DOUBLE)"
            name = self.features[tree.feature[at]]
            edge = float(self.cuts[tree.feature[at]][tree.cut[at]])
            return f"CASE WHEN coalesce(CAST({name} AS DOUBLE), 0) <= CAST({edge!r} AS DOUBLE) THEN {node(tree, tree.left[at])} ELSE {node(tree, tree.right[at])} END"

        return " + ".join([f"CAST({self.start!r} AS DOUBLE)", *[node(t, 0) for t in self.trees]])

    def splits(self, spark: SparkSession) -> DataFrame:
        """One row per node: ``tree, node, feature, threshold, left, right, value, gain, rows, depth``; leaves have no feature."""
        rows = []
        for t, tree in enumerate(self.trees):
            for n, f in enumerate(tree.feature):
                inner = f >= 0
                rows.append((
                    t, n, self.features[f] if inner else None, float(self.cuts[f][tree.cut[n]]) if inner else None,
                    tree.left[n] if inner else None, tree.right[n] if inner else None, float(tree.value[n]), float(tree.gain[n]), float(tree.rows[n]), tree.depth[n],
                ))
        return spark.createDataFrame(
            rows, "tree int, node int, feature string, threshold double, `left` int, `right` int, value double, gain double, `rows` double, depth int"
        )

    def importance(self) -> dict[str, float]:
        """Share of all gain per feature."""
        total = dict.fromkeys(self.features, 0.0)
        for tree in self.trees:
            for f, gain in zip(tree.feature, tree.gain):
                if f >= 0:
                    total[self.features[f]] += gain
        whole = sum(total.values()) or 1.0
        return {f: g / whole for f, g in total.items()}


def _binned(values: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    bins = np.empty(values.shape, np.uint8)
    for j, edges in enumerate(cuts):
        bins[:, j] = np.searchsorted(edges, values[:, j], "left")
    return bins


def _edges(table: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Values of each feature at even ranks, to a quarter of a bin, in one scan; at most one fewer than bins. A value
    equal to an edge lies left of it. A column of fewer rows than bins keeps all its values apart."""
    shares = [i / bins for i in range(1, bins)]
    return [np.unique(np.array(found, dtype=float)) for found in table.approxQuantile(list(features), shares, 0.25 / bins)]


def _sampled(rows: np.ndarray, share: float, seed: int) -> np.ndarray:
    """Whether a row is in a tree's sample, by a hash of its number."""
    if share >= 1.0:
        return np.ones(len(rows), dtype=bool)
    x = rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xD1342543DE82EF95 % (1 << 64))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53) < share


class _Pass:
    """What a task needs: trees since the table was written, the tree being grown, and the nodes wanted."""

    def __init__(self, recent: list[Tree], tree: Tree, nodes: list[int], n_features: int, settings: Settings, number: int):
        self.recent, self.tree, self.nodes = recent, tree, nodes
        self.n_features, self.settings, self.number = n_features, settings, number

    def rows(self, batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        row, label, weight, margin = (batch.column(c).to_numpy() for c in ("row", "label", "weight", "margin"))
        bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(len(row), self.n_features)
        for tree in self.recent:
            margin = margin + np.array(tree.value)[tree.node_of(bins)]
        return row, label, weight, margin, bins

    def histograms(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = self.settings.bins
        size = len(self.nodes) * self.n_features * wide
        sums = np.zeros((3, size))
        slot_of = np.full(len(self.tree.feature), -1)
        slot_of[self.nodes] = np.arange(len(self.nodes))
        for batch in batches:
            row, label, weight, margin, bins = self.rows(batch)
            slot = slot_of[self.tree.node_of(bins)]
            used = (slot >= 0) & _sampled(row, self.settings.rows, self.settings.seed + self.number)
            slot, bins, label, weight, margin = slot[used], bins[used], label[used], weight[used], margin[used]
            p = 1.0 / (1.0 + np.exp(-margin))
            for j in range(self.n_features):
                cell = (slot * self.n_features + j) * wide + bins[:, j]
                for k, value in enumerate((weight * (p - label), weight * p * (1.0 - p), np.ones(len(p)))):
                    sums[k] += np.bincount(cell, value, size)
        cells = np.flatnonzero(sums[2])
        yield pa.RecordBatch.from_arrays([pa.array(cells), *[pa.array(s[cells]) for s in sums]], names=["cell", "g", "h", "n"])

    def refreshed(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = self.rows(batch)[3]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("row", "label", "weight")], pa.array(margin), batch.column("bins")], names=["row", "label", "weight", "margin", "bins"])


def _shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def _best_split(sums: np.ndarray, usable: np.ndarray, s: Settings) -> tuple[float, int, int, np.ndarray]:
    """Gain, feature and cut of the best split of one node; then its sums of gradient, curvature and rows."""
    total = sums[:, 0].sum(axis=1)
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    right = total[:, None, None] - left

    def worth(part: np.ndarray) -> np.ndarray:
        return _shrunk(part[0], s.l1) ** 2 / np.maximum(part[1] + s.l2, 1e-300)

    gain = 0.5 * (worth(left) + worth(right) - worth(total[:, None, None]))
    allowed = usable[:, None] & (left[2] >= max(1, s.least_rows)) & (right[2] >= max(1, s.least_rows))
    allowed &= (left[1] >= s.least_weight) & (right[1] >= s.least_weight)
    gain = np.where(allowed, gain, -math.inf)
    best = int(gain.argmax())
    feature, cut = np.unravel_index(best, gain.shape)
    return float(gain[feature, cut]), int(feature), int(cut), total


def _added_up(table: DataFrame, work: _Pass) -> DataFrame:
    """Sums per cell. Every task has a cell once, so they are shuffled as they are, into as many parts as their number asks for:
    a pass over few nodes is over a few thousand numbers, for which the session's partitions are far too many."""
    spark, cells = table.sparkSession, len(work.nodes) * work.n_features * work.settings.bins
    parts = -(-cells * spark.sparkContext.defaultParallelism // SUM_ROWS)
    parts = max(1, min(parts, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    sums = table.mapInArrow(work.histograms, "cell long, g double, h double, n double").repartition(parts, "cell")
    return sums.groupBy("cell").agg(F.sum("g"), F.sum("h"), F.sum("n"))


def _sums(table: DataFrame, work: _Pass) -> Iterator[np.ndarray]:
    """Gradient, curvature and rows per feature and bin of each node of a pass."""
    found = _added_up(table, work).toArrow()
    shape = (3, len(work.nodes), work.n_features, work.settings.bins)
    sums = np.zeros((3, math.prod(shape[1:])))
    for k in range(3):
        sums[k, found.column(0).to_numpy()] = found.column(k + 1).to_numpy()
    yield from sums.reshape(shape).transpose(1, 0, 2, 3)


class _Held:
    """All rows in one task. A tree's rows keep the node they have come to, and a pass moves those on whose node was split."""

    def __init__(self, batches: Iterator[pa.RecordBatch], n_features: int, settings: Settings):
        table, self.n_features, self.settings = pa.Table.from_batches(batches), n_features, settings
        order = np.argsort(table.column("row").to_numpy())
        self.row, self.label, self.weight, self.margin = (table.column(c).to_numpy()[order] for c in ("row", "label", "weight", "margin"))
        self.bins = np.frombuffer(b"".join(table.column("bins").to_pylist()), np.uint8).reshape(len(order), n_features)[order]

    def begin(self, number: int) -> None:
        used = _sampled(self.row, self.settings.rows, self.settings.seed + number)
        p = 1.0 / (1.0 + np.exp(-self.margin[used]))
        self.g, self.h = self.weight[used] * (p - self.label[used]), self.weight[used] * p * (1.0 - p)
        self.columns, self.node = np.ascontiguousarray(self.bins[used].T), np.zeros(len(p), np.int64)

    def sums(self, tree: Tree, nodes: list[int]) -> Iterator[np.ndarray]:
        """As ``_sums``."""
        feature, cut, left, right = (np.array(x) for x in (tree.feature, tree.cut, tree.left, tree.right))
        moving = np.flatnonzero(feature[self.node] >= 0)
        while len(moving):
            at = self.node[moving]
            at = np.where(self.columns[feature[at], moving] <= cut[at], left[at], right[at])
            self.node[moving] = at
            moving = moving[feature[at] >= 0]
        slot_of = np.full(len(feature), -1)
        slot_of[nodes] = np.arange(len(nodes))
        slot = slot_of[self.node]
        used = np.flatnonzero(slot >= 0)
        wide = self.settings.bins
        cell, g, h = slot[used] * wide, self.g[used], self.h[used]
        sums = np.zeros((len(nodes), 3, self.n_features, wide))
        for j in range(self.n_features):
            mine = cell + self.columns[j, used]
            for k, value in enumerate((g, h, None)):
                sums[:, k, j] = np.bincount(mine, value, len(nodes) * wide).reshape(-1, wide)
        yield from sums

    def end(self, tree: Tree) -> None:
        self.margin = self.margin + np.array(tree.value)[tree.node_of(self.bins)]


def _grow(sums_of: Callable[[Tree, list[int]], Iterator[np.ndarray]], n_features: int, s: Settings, number: int) -> Tree:
    chooser = np.random.default_rng([s.seed, number])
    usable = np.zeros(n_features, dtype=bool)
    usable[chooser.permutation(n_features)[: max(1, int(round(s.columns * n_features)))]] = True
    tree, most = Tree(), s.leaves or math.inf
    known: dict[int, tuple] = {}
    wanted, at_once = [0], max(1, PASS_BYTES // (n_features * s.bins * 24))
    while wanted:
        for at in range(0, len(wanted), at_once):
            some = wanted[at : at + at_once]
            for node, sums in zip(some, sums_of(tree, some)):
                known[node] = _best_split(sums, usable, s)
                g, h, n = known[node][3]
                tree.value[node], tree.rows[node] = -s.rate * float(_shrunk(g, s.l1) / max(h + s.l2, 1e-300)), float(n)
        wanted = _split_next(tree, known, most, s)
    return _trimmed(tree, known, most, s)


def _worth_splitting(tree: Tree, node: int, known: dict, s: Settings) -> bool:
    return known[node][0] > max(s.least_gain, 1e-12) and (s.depth is None or tree.depth[node] < s.depth)


def _split_next(tree: Tree, known: dict, most: float, s: Settings) -> list[int]:
    """Splits every leaf that the queue, best gain first, would reach with what is known; the new nodes are wanted."""
    order, budget, out = [(-known[0][0], 0)], most - 1, []
    while order and budget > 0:
        _, node = heapq.heappop(order)
        if not _worth_splitting(tree, node, known, s):
            continue
        budget -= 1
        if tree.feature[node] < 0:
            _, tree.feature[node], tree.cut[node], _ = known[node]
            tree.gain[node] = known[node][0]
            tree.left[node], tree.right[node] = tree.add(tree.depth[node] + 1), tree.add(tree.depth[node] + 1)
            out += [tree.left[node], tree.right[node]]
        elif tree.left[node] in known:
            for child in (tree.left[node], tree.right[node]):
                heapq.heappush(order, (-known[child][0], child))
    return out


def _trimmed(tree: Tree, known: dict, most: float, s: Settings) -> Tree:
    """The tree of the splits that the queue really makes; those looked at ahead of their turn and not reached go."""
    out, order, leaves = Tree(), [(-known[0][0], 0, 0)], 1
    out.value[0], out.rows[0] = tree.value[0], tree.rows[0]
    while order and leaves < most:
        _, node, at = heapq.heappop(order)
        if tree.feature[node] < 0 or not _worth_splitting(tree, node, known, s):
            continue
        out.feature[at], out.cut[at], out.gain[at] = tree.feature[node], tree.cut[node], tree.gain[node]
        leaves += 1
        for side, child in (("left", tree.left[node]), ("right", tree.right[node])):
            new = out.add(out.depth[at] + 1)
            getattr(out, side)[at] = new
            out.value[new], out.rows[new] = tree.value[child], tree.rows[child]
            heapq.heappush(order, (-known[child][0], child, new))
    return out


def train_boosted(
    train: DataFrame, features: Sequence[str], label: str = "label", weight: str | None = None, settings: Settings | None = None, **given,
) -> BoostedModel:
    """Boosted trees for a 0/1 label; missing values read as 0. ``given`` overrides single settings.

    Depth first libraries are ``leaves=None`` with a depth; leaf first ones a number of leaves. Rows without a label are
    left out. A table of one class, or none, gives a model of its start alone.
    """
    spark, features = train.sparkSession, list(features)
    s = Settings(**{**(vars(settings) if settings else {}), **given})
    if not 2 <= s.bins <= 256:
        raise ValueError("bins: 2 to 256")
    filled = train.where(F.col(label).isNotNull()).select(
        F.col(label).cast("double").alias("__label"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("__weight"),
        *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features],
    ).withColumn("__weight", F.when(F.col("__label") > 0, F.col("__weight") * s.positive_scale).otherwise(F.col("__weight")))
    cuts = _edges(filled, features, s.bins)
    sums = filled.agg(F.sum(F.col("__weight") * F.col("__label")), F.sum("__weight")).first()
    share = (sums[0] or 0.0) / sums[1] if sums[1] else 0.5
    start = math.log(share / (1 - share)) if s.from_average and 0 < share < 1 else 0.0

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.column_stack([batch.column(f).to_numpy() for f in features])
            bins = _binned(values, cuts)
            n = len(bins)
            yield pa.RecordBatch.from_arrays(
                [batch.column("__row"), batch.column("__label"), batch.column("__weight"), pa.array(np.full(n, start)), pa.array([b.tobytes() for b in bins], pa.binary())],
                names=["row", "label", "weight", "margin", "bins"],
            )

    def write(df: DataFrame) -> DataFrame:
        path = work_path(spark, "boosting")
        df.write.parquet(path)
        return spark.read.schema(_TABLE).parquet(path)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Held(batches, len(features), s)
        for number in range(s.rounds):
            rows.begin(number)
            tree = _grow(rows.sums, len(features), s, number)
            rows.end(tree)
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([pickle.dumps(tree)], pa.binary())], names=["number", "tree"])

    table = write(filled.withColumn("__row", F.monotonically_increasing_id()).mapInArrow(packed, _TABLE))
    trees: list[Tree] = []
    recent: list[Tree] = []
    if 0 < share < 1 and 0 < table.count() * (len(features) + ROW_BYTES) <= HELD_BYTES:
        found = table.coalesce(1).mapInArrow(held, "number int, tree binary").toArrow()
        trees = [pickle.loads(tree) for tree in found.sort_by("number").column("tree").to_pylist()]
    elif 0 < share < 1:
        for number in range(s.rounds):
            tree = _grow(lambda tree, nodes: _sums(table, _Pass(recent, tree, nodes, len(features), s, number)), len(features), s, number)
            trees.append(tree)
            recent.append(tree)
            if len(recent) == s.refresh and number + 1 < s.rounds:
                table = write(table.mapInArrow(_Pass(recent, Tree(), [], len(features), s, number).refreshed, _TABLE))
                recent = []
    return BoostedModel(features, trees, cuts, start)
