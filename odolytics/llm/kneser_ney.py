"""Perplexity under an interpolated modified Kneser-Ney bigram model, counted in Spark.

1. *Words.* Tasks count word hashes of a few megabytes of text at a time; the counts are dealt out by hash
   range, and each range is written as a sorted hash array with its counts. A word's number is its place.
2. *Pairs.* Tasks count pairs of neighbouring word numbers the same way. Pairs are dealt out by their first
   word (pairs of a very frequent first word by the whole pair), and each shard is written as a sorted array
   of pairs with counts. Sums per first word (total, how many followers were seen once, twice, more often)
   and per second word (how many different words stand before it) come with it and are added up by range.
3. *Scores.* Workers memory-map the arrays and look up the words and pairs of the texts they read.

With c the count of a pair, n the total of its first word and D the three discounts of Chen and Goodman:
``p(w|v) = max(c - D(c), 0) / n + (D1*n1 + D2*n2 + D3*n3) / n * p(w)``, and ``p(w)`` is the same over the
numbers of different words before w, mixed with ``1 / (V + 1)``; the one more stands for all unknown words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odolytics.llm.batches import bounded
from odolytics.llm import store, tokens
from odolytics.llm.language import fold
from odolytics.session import work_path

GROUP_BYTES = 8 << 20       # text whose words and pairs are counted together
SHARD_BYTES = 32 << 20      # text per shard of pairs or range of words
MOST_RANGE_BITS = 16
MOST_OPEN = 1024            # arrays a worker keeps mapped
HOT_SHARE = 4               # a first word with more than 1/4 of an even shard is split
ADDED = 0.1                 # added to counts in the base score
FOLDS = 10

_U = np.uint64
_END = tokens.mix(np.array([1], dtype=_U))[0]     # the token after the last word of a text


@dataclass
class Plan:
    """Where the arrays are and how words and pairs are dealt out."""

    folder: str
    bits: int
    shards: int
    offsets: np.ndarray | None = None   # number of the first word of each range
    total: int = 0                      # training tokens

    @property
    def words(self) -> int:
        return int(self.offsets[-1])

    @property
    def begin(self) -> int:
        """Number of the place before the first word of a text; unknown words have the next one."""
        return self.words


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, token hashes (words, then an end per row) and first token of each row."""
    raw, offsets = tokens.text_bytes(batch.column("text"))
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + GROUP_BYTES, "right")) - 1)
        words, first = tokens.words(raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        rows = np.arange(to - at)
        out = np.empty(len(words) + len(rows), dtype=_U)
        end = first[1:] + rows
        inside = np.ones(len(out), dtype=bool)
        inside[end] = False
        out[inside], out[end] = words, _END
        yield at, to, out, np.append(first + np.arange(len(rows) + 1), len(out))[: len(rows) + 1]
        at = to


def _packed(part: list[int], columns: dict[str, list[bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32())] + [pa.array(v, pa.binary()) for v in columns.values()], names=["part", *columns]
    )


def _split(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(part, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
        if len(rows):
            yield int(part[rows[0]]), rows


def _unpacked(table: pa.Table, name: str, dtype) -> np.ndarray:
    return np.concatenate([np.frombuffer(v.as_buffer(), dtype) for v in table.column(name)])


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    head = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[head], np.add.reduceat(counts[order], head)


def _range_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> _U(64 - bits)).astype(np.int64)


def _count_words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, hashes, _ in _groups(batch):
                unique, counts = np.unique(hashes, return_counts=True)
                cuts = np.searchsorted(unique, np.arange(1 << bits, dtype=_U) << _U(64 - bits))
                ends = np.append(cuts[1:], len(unique))
                parts = [i for i in range(1 << bits) if ends[i] > cuts[i]]
                yield _packed(parts, {
                    "keys": [unique[cuts[i] : ends[i]].tobytes() for i in parts],
                    "counts": [counts[cuts[i] : ends[i]].astype(np.int64).tobytes() for i in parts],
                })

    return run


def _write_words(folder: str):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        keys, counts = _summed(_unpacked(table, "keys", _U), _unpacked(table, "counts", np.int64))
        store.write_array(folder, f"words-{part}", keys)
        store.write_array(folder, f"counts-{part}", counts)
        return pa.table({"part": pa.array([part], pa.int32()), "words": [len(keys)], "tokens": [int(counts.sum())]})

    return run


class Words:
    """Word numbers and what is known per word, from memory-mapped ranges opened when first needed."""

    def __init__(self, plan: Plan) -> None:
        self.plan, self.open = plan, {}

    def _range(self, name: str, part: int, dtype) -> np.ndarray:
        if (name, part) not in self.open:
            if len(self.open) >= MOST_OPEN:
                self.open.clear()
            self.open[name, part] = store.map_array(self.plan.folder, f"{name}-{part}", dtype)
        return self.open[name, part]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of sorted word hashes; unknown words get ``begin + 1``."""
        out = np.full(len(hashes), self.plan.begin + 1, dtype=np.int64)
        for part, rows in _split(_range_of(hashes, self.plan.bits)):
            if self.plan.offsets[part + 1] == self.plan.offsets[part]:
                continue
            known = self._range("words", part, _U)
            place = np.minimum(np.searchsorted(known, hashes[rows]), len(known) - 1)
            hit = known[place] == hashes[rows]
            out[rows[hit]] = self.plan.offsets[part] + place[hit]
        return out

    def values(self, name: str, numbers: np.ndarray, width: int = 1) -> np.ndarray:
        """Per-word values by word number, zero for unknown words; ``begin`` has a range of its own."""
        out = np.zeros((len(numbers), width), dtype=np.int64)
        part_of = np.searchsorted(self.plan.offsets, numbers, "right") - 1
        for part, rows in _split(part_of):
            if part < len(self.plan.offsets) - 1:
                out[rows] = self._range(name, part, np.int64).reshape(-1, width)[numbers[rows] - self.plan.offsets[part]]
            elif name == "after":
                at_begin = rows[numbers[rows] == self.plan.begin]
                if len(at_begin):
                    out[at_begin] = self._range(name, part, np.int64).reshape(-1, width)[0]
        return out[:, 0] if width == 1 else out


def _pairs(plan: Plan, words: Words, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Unique words with their counts, and per token the pair with the token before it."""
    unique, place = np.unique(hashes, return_inverse=True)
    number = words.numbers(unique)
    token = number[place]
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[first[:-1]] = plan.begin
    return unique, number, place, (before.astype(_U) << _U(32)) | token.astype(_U)


def _shard_of(plan: Plan, pairs: np.ndarray, count_of_first: np.ndarray) -> np.ndarray:
    first = pairs >> _U(32)
    hot = (first == _U(plan.begin)) | (count_of_first * plan.shards * HOT_SHARE > plan.total)
    return (tokens.mix(np.where(hot, pairs, first)) % _U(plan.shards)).astype(np.int64)


def _first_counts(plan: Plan, words: Words, pairs: np.ndarray) -> np.ndarray:
    """Count of the first word of sorted pairs."""
    first = (pairs >> _U(32)).astype(np.int64)
    unique, place = np.unique(first, return_inverse=True)
    return words.values("counts", unique)[place]


def _count_pairs(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(plan)
        for batch in batches:
            for _, _, hashes, first in _groups(batch):
                unique, counts = np.unique(_pairs(plan, words, hashes, first)[3], return_counts=True)
                shard = _shard_of(plan, unique, _first_counts(plan, words, unique))
                parts, keys, often = [], [], []
                for part, rows in _split(shard):
                    parts.append(part)
                    keys.append(unique[rows].tobytes())
                    often.append(counts[rows].astype(np.uint32).tobytes())
                yield _packed(parts, {"keys": keys, "counts": often})

    return run


PAIR_SCHEMA = "kind string, part int, numbers binary, data binary"


def _write_pairs(plan: Plan):
    """Writes one shard; gives counts of counts and sums per first and per second word."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        pairs, counts = _summed(_unpacked(table, "keys", _U), _unpacked(table, "counts", np.uint32).astype(np.int64))
        large = np.flatnonzero(counts > 254)
        store.write_array(plan.folder, f"pairs-{shard}", pairs)
        store.write_array(plan.folder, f"often-{shard}", np.minimum(counts, 255).astype(np.uint8))
        store.write_array(plan.folder, f"large-{shard}", np.stack((pairs[large].view(np.int64), counts[large]), axis=1))
        kind, part, numbers, data = ["spectrum"], [0], [b""], [np.array([(counts == k).sum() for k in (1, 2, 3, 4)], dtype=np.int64).tobytes()]

        def add(name: str, number: np.ndarray, values: np.ndarray) -> None:
            for p, rows in _split(np.searchsorted(plan.offsets, number, "right") - 1):
                kind.append(name)
                part.append(p)
                numbers.append(number[rows].astype(np.uint32).tobytes())
                data.append(values[rows].astype(np.int64).tobytes())

        first = (pairs >> _U(32)).astype(np.int64)
        head = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
        sums = np.stack([np.add.reduceat(v, head) for v in (counts, (counts == 1) * 1, (counts == 2) * 1, (counts > 2) * 1)], axis=1)
        add("after", first[head], sums)
        add("before", *np.unique((pairs & _U(0xFFFFFFFF)).astype(np.int64), return_counts=True))
        return pa.table({"kind": kind, "part": pa.array(part, pa.int32()), "numbers": pa.array(numbers, pa.binary()), "data": pa.array(data, pa.binary())})

    return run


def _write_sums(plan: Plan):
    """Adds up one range of per-word sums; gives how many words have one, two, three and four different words before them."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        kind, part = key[0].as_py(), key[1].as_py()
        beyond = part >= len(plan.offsets) - 1
        size, low = (1, plan.begin) if beyond else (int(plan.offsets[part + 1] - plan.offsets[part]), int(plan.offsets[part]))
        width = 4 if kind == "after" else 1
        sums = np.zeros((size, width), dtype=np.int64)
        for number, values in zip(table.column("numbers"), table.column("data")):
            at = np.frombuffer(number.as_buffer(), np.uint32).astype(np.int64) - low
            sums[at] += np.frombuffer(values.as_buffer(), np.int64).reshape(-1, width)
        store.write_array(plan.folder, f"{kind}-{part}", sums)
        spectrum = [int((sums[:, 0] == k).sum()) if kind == "before" else 0 for k in (1, 2, 3, 4)]
        return pa.table({"kind": [kind], "total": [int(sums[:, 0].sum())], "spectrum": pa.array([spectrum], pa.list_(pa.int64()))})

    return run


def discounts(spectrum: list[int]) -> np.ndarray:
    """Discounts of counts one, two and three or more, from how often counts one to four occur (Chen and Goodman).

    Where a small corpus has no such counts, a discount is half of the count it would lower.
    """
    n1, n2, n3, n4 = (float(x) for x in spectrum)
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0] + [min(max(d, 0.05 * k), 0.95 * k) for k, d in zip((1, 2, 3), raw)])


@dataclass
class Model:
    plan: Plan
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    before_total: int           # different pairs
    rest: float                 # weight of the uniform part of p(w)


def train(texts: DataFrame) -> Model:
    """Count a table of texts (NULL: empty) and write the model's arrays to the shared folder."""
    spark = bounded(texts).sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    pieces = max(1, math.ceil(size / SHARD_BYTES))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = Plan(work_path(spark, "kneser-ney"), min(MOST_RANGE_BITS, max(3, math.ceil(math.log2(pieces)))), max(pieces, partitions))
    store.make_folder(plan.folder)
    ranges = texts.mapInArrow(_count_words(plan.bits), "part int, keys binary, counts binary").groupBy("part").applyInArrow(
        _write_words(plan.folder), "part int, words long, tokens long"
    ).collect()     # one row per range of hashes
    words = np.zeros((1 << plan.bits) + 1, dtype=np.int64)
    for r in ranges:
        words[r["part"] + 1] = r["words"]
    plan.offsets, plan.total = np.cumsum(words), sum(r["tokens"] for r in ranges)
    if plan.words >= 2**32 - 2:
        raise ValueError("more different words than 32-bit numbers")
    path = work_path(spark, "pair-sums")
    texts.mapInArrow(_count_pairs(plan), "part int, keys binary, counts binary").groupBy("part").applyInArrow(
        _write_pairs(plan), PAIR_SCHEMA
    ).write.option("compression", "zstd").parquet(path)
    sums = spark.read.schema(PAIR_SCHEMA).parquet(path)
    spectrum = np.zeros(4, dtype=np.int64)
    for row in sums.where("kind = 'spectrum'").select("data").collect():       # 32 bytes per shard
        spectrum += np.frombuffer(row["data"], np.int64)
    done = sums.where("kind != 'spectrum'").groupBy("kind", "part").applyInArrow(
        _write_sums(plan), "kind string, total long, spectrum array<long>"
    ).collect()     # one row per range and kind
    before = [r for r in done if r["kind"] == "before"]
    of_words = [sum(r["spectrum"][k] for r in before) for k in range(4)]
    d, total = discounts(of_words), sum(r["total"] for r in before)
    kept = plan.words - of_words[0] - of_words[1]
    rest = (d[1] * of_words[0] + d[2] * of_words[1] + d[3] * kept) / total if total else 1.0
    return Model(plan, discounts(list(spectrum)), d, total, rest)


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.words, self.open = model, Words(model.plan), {}

    def _pair_counts(self, pairs: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Counts of sorted pairs; pairs with an unknown word have none."""
        plan, out = self.model.plan, np.zeros(len(pairs), dtype=np.int64)
        known = np.flatnonzero(known)
        pairs = pairs[known]
        shard = _shard_of(plan, pairs, _first_counts(plan, self.words, pairs))
        for part, rows in _split(shard):
            if part not in self.open:
                if len(self.open) >= MOST_OPEN:
                    self.open.clear()
                self.open[part] = [
                    store.map_array(plan.folder, f"{n}-{part}", t) for n, t in (("pairs", _U), ("often", np.uint8), ("large", np.int64))
                ]
            keys, often, large = self.open[part]
            if not len(keys):
                continue
            place = np.minimum(np.searchsorted(keys, pairs[rows]), len(keys) - 1)
            hit = keys[place] == pairs[rows]
            count = np.where(hit, often[place], 0).astype(np.int64)
            for i in np.flatnonzero(count == 255):
                table = large.reshape(-1, 2)
                count[i] = table[np.searchsorted(table[:, 0].view(_U), pairs[rows[i]]), 1]
            out[known[rows]] = count
        return out

    def group(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row: known tokens, base score and model score, both log10."""
        model, plan = self.model, self.model.plan
        _, number, place, pair = _pairs(plan, self.words, hashes, first)
        count = self.words.values("counts", number)
        base = np.log10((count + ADDED) / (plan.total + ADDED * (plan.words + 1)))
        before = self.words.values("before", number)
        p_word = np.full(len(number), model.rest / (plan.words + 1))
        if model.before_total:
            p_word += np.maximum(before - model.word_discounts[np.minimum(before, 3)], 0) / model.before_total
        unique, back = np.unique(pair, return_inverse=True)
        left, right = (unique >> _U(32)).astype(np.int64), (unique & _U(0xFFFFFFFF)).astype(np.int64)
        seen = self._pair_counts(unique, (left <= plan.begin) & (right < plan.begin)) if plan.total else np.zeros(len(unique), np.int64)
        firsts, again = np.unique(left, return_inverse=True)
        after = self.words.values("after", firsts, 4) if plan.total else np.zeros((len(firsts), 4), np.int64)
        total = np.maximum(after[:, 0], 1)
        rest = np.where(after[:, 0] > 0, (after[:, 1:] @ model.pair_discounts[1:]) / total, 1.0)
        own = np.maximum(seen - model.pair_discounts[np.minimum(seen, 3)], 0) / total[again]
        score = np.log10(own[back] + rest[again][back] * p_word[place])
        starts = first[:-1]
        return np.add.reduceat((count > 0)[place].astype(np.int64), starts), np.add.reduceat(base[place], starts), np.add.reduceat(score, starts)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for at, to, hashes, first in _groups(batch):
                known, base, score = scorer.group(hashes, first)
                rows = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("held_out"), pa.array(np.diff(first), pa.int64()), pa.array(known, pa.int64()),
                     pa.array(np.full(to - at, scorer.model.plan.total), pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Scores of rows (doc_id, held_out, text)."""
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        _score(docs.sparkSession.sparkContext.broadcast(model)),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def held_out_scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    Learned from the rows whose crc32(doc_id) modulo 10 is not 0; a row without an id teaches nothing and is not
    held out. NULL text is empty and has one token, its end. Repeated rows are counted and scored as often as
    they stand there. With nothing to learn from, every token has probability one. No rows, no result; other
    columns are not read.
    """
    rest = fold(F.col("doc_id"), FOLDS)
    model = train(docs.where(rest != 0).select("text"))
    return score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "text"), model)
