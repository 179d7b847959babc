"""Chat transcripts: roles recovered line by line with a hidden Markov model, then rendered canonically.

A state is a role with "starts a turn" or "goes on". A line is seen through its speaker marker, its ending, its
length and whether it opens the transcript; the probabilities are counted from transcripts with known roles.
The most likely state sequence (Viterbi) gives the roles and the turns.

A transcript may be far longer than one task should hold, so it is cut into blocks of turns. The best score
from every state before a block to every state at its end is a small matrix; matrices of neighbouring blocks are
joined level by level until one is left, and the best states at the cuts are handed down the same way. Then
each block is decoded between known states. The result is the same as over the whole transcript.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odolytics.llm.language import fold
from odolytics.llm.ranking import ranked, written
from odolytics.session import cut_lineage

BLOCK_TURNS = 1024          # turns per block
BRANCH = 1024               # blocks joined at each level
SMOOTH = 0.5
UNMARKED = 4                # one turn in so many is written without a marker

# Speaker markers by role.
MARKERS = {"user": ("User", "Human", "Q"), "assistant": ("Assistant", "AI", "A"), "system": ("System",), "tool": ("Tool",)}
KNOWN_MARKERS = {m.lower() for names in MARKERS.values() for m in names}
FEATURES = ("marker", "ending", "length", "opens")


def features(line: str, opens: bool) -> tuple[str, str, str, str]:
    head, colon, _ = line.partition(":")
    marker = "none"
    if colon and len(head) <= 24 and head.strip() and len(head.split()) <= 2:
        marker = head.strip().lower() if head.strip().lower() in KNOWN_MARKERS else "other"
    ending = line.rstrip()[-1:] or "empty"
    ending = ending if ending in ".?!:,;" or ending == "empty" else "letter"
    return marker, ending, str(min(12, len(line).bit_length())), "yes" if opens else "no"


def without_marker(line: str, marker: str) -> str:
    return line if marker == "none" else line.partition(":")[2].strip()


def as_transcript(conversations: DataFrame) -> DataFrame:
    """Turns written the way a chat log has them: a speaker marker in one of several spellings, or none on one
    turn in four. Gives (conv_id, turn, tie, role, text); ``tie`` orders rows of one turn."""
    dice = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(1 << 20))
    spelling = F.lit(None).cast("string")
    for role, names in MARKERS.items():
        spelling = F.when(F.col("role") == role, F.element_at(F.array(*map(F.lit, names)), (dice % len(names)).cast("int") + 1)).otherwise(spelling)
    spelling = F.coalesce(spelling, F.initcap("role"))
    marked = (F.floor(dice / 16) % UNMARKED != 0) & spelling.isNotNull()
    body = F.coalesce("text", F.lit(""))
    return conversations.select(
        "conv_id", "turn", F.xxhash64("role", "text").alias("tie"), "role",
        F.when(marked, F.concat(spelling, F.lit(": "), body)).otherwise(body).alias("text"),
    )


@dataclass
class Model:
    roles: list[str]
    start: np.ndarray                       # log probability of the first state
    step: np.ndarray                        # states x states
    emit: list[dict[str, np.ndarray]]       # per feature: value -> log probability by state
    unseen: list[np.ndarray]

    def scores(self, rows: list[tuple[str, str, str, str]]) -> np.ndarray:
        out = np.zeros((len(rows), 2 * len(self.roles)))
        for f in range(len(FEATURES)):
            out += np.stack([self.emit[f].get(r[f], self.unseen[f]) for r in rows]) if rows else 0
        return out


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (feature, value) by role and part of the turn, summed per batch."""
    for batch in batches:
        seen: dict[tuple[str, bool, int, str], int] = {}
        for role, text, opens in zip(*(batch.column(n).to_pylist() for n in ("role", "text", "opens"))):
            for k, line in enumerate(text.split("\n")):
                for f, value in enumerate(features(line, opens and k == 0)):
                    seen[role, k == 0, f, value] = seen.get((role, k == 0, f, value), 0) + 1
        columns = list(zip(*[(*k, n) for k, n in seen.items()])) or [[]] * 5
        kinds = (pa.string(), pa.bool_(), pa.int32(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["role", "starts", "feature", "value", "n"])


def _opening(turns: DataFrame) -> Column:
    return F.col("turn").isNull() | (F.col("turn") == 0)


def fit(transcript: DataFrame) -> Model:
    """Counts from turns with known roles (rows without a role teach nothing)."""
    rows = transcript.where("role IS NOT NULL").withColumn("opens", _opening(transcript))
    counts = rows.select("role", "text", "opens").mapInArrow(
        _observed, "role string, starts boolean, feature int, value string, n long"
    ).groupBy("role", "starts", "feature", "value").agg(F.sum("n").alias("n")).collect()    # roles x a few values
    roles = sorted({r["role"] for r in counts})
    # Neighbouring turns meet by number; no conversation is gathered in one place.
    ends = rows.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("from"))
    follow = ends.join(rows.select("conv_id", "turn", F.col("role").alias("to")), ["conv_id", "turn"]).groupBy("from", "to").count().collect()
    states = 2 * len(roles)
    emit, unseen, lines = [], [], np.zeros(states)
    for f in range(len(FEATURES)):
        of = [r for r in counts if r["feature"] == f]
        values = {r["value"] for r in of}
        table = {v: np.full(states, SMOOTH) for v in values}
        for r in of:
            table[r["value"]][2 * roles.index(r["role"]) + (not r["starts"])] += r["n"]
        total = sum(table.values(), np.zeros(states)) + SMOOTH
        lines = total
        emit.append({v: np.log(c / total) for v, c in table.items()})
        unseen.append(np.log(SMOOTH / total))
    step = np.full((states, states), -np.inf)
    turn_after = {(r["from"], r["to"]): r["count"] for r in follow}
    for i, a in enumerate(roles):
        n_start, n_inside = lines[2 * i], lines[2 * i + 1]
        go_on = n_inside / (n_inside + n_start)         # share of lines of this role that go on
        out = np.array([turn_after.get((a, b), 0) + SMOOTH for b in roles], dtype=float)
        for part in (2 * i, 2 * i + 1):
            step[part, 2 * i + 1] = math.log(go_on)
            step[part, 0::2] = math.log(1 - go_on) + np.log(out / out.sum())
    # The feature "opens" tells first lines apart, so every role may start with the share it has there.
    first = np.full(states, -np.inf)
    if roles:
        first[0::2] = -math.log(len(roles))
    return Model(roles, first, step, emit, unseen)


def _lines(table: pa.Table) -> tuple[list[tuple], np.ndarray, list[int]]:
    """Lines of a block in order: features, the row of each line, and the order of rows."""
    turns, ties = table.column("turn").to_pylist(), table.column("tie").to_pylist()
    order = sorted(range(len(turns)), key=lambda i: (turns[i] is not None, turns[i] or 0, ties[i]))
    texts = table.column("text").to_pylist()
    seen, row = [], []
    for i in order:
        opens = turns[i] is None or turns[i] == 0
        for k, line in enumerate(texts[i].split("\n")):
            seen.append(features(line, opens and k == 0))
            row.append(i)
    return seen, np.array(row, dtype=np.int64), order


def _best_paths(model: Model, scores: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Best score to each last state, for each row of scores ``before`` the first line (already stepped in)."""
    reach = before + scores[0]
    for line in scores[1:]:
        reach = (reach[:, :, None] + model.step[None]).max(axis=1) + line
    return reach


def _block_matrix(model: Model):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        scores = model.scores(_lines(table)[0])
        before = np.vstack((model.step, model.start))       # the last row: nothing comes before
        return pa.table({"key": [key[0].as_py()], "block": [key[1].as_py()], "matrix": pa.array([_best_paths(model, scores, before).tobytes()], pa.binary())})

    return run


def _decode(model: Model):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        seen, row, order = _lines(table)
        scores, states = model.scores(seen), 2 * len(model.roles)
        entry, leave = table.column("entry")[0].as_py(), table.column("leave")[0].as_py()
        reach = (model.start if entry == states else model.step[entry]) + scores[0]
        came = np.zeros((len(seen), states), dtype=np.int32)
        for i in range(1, len(seen)):
            ways = reach[:, None] + model.step
            came[i] = ways.argmax(axis=0)
            reach = ways.max(axis=0) + scores[i]
        path = np.empty(len(seen), dtype=np.int64)
        path[-1] = leave
        for i in range(len(seen) - 1, 0, -1):
            path[i - 1] = came[i, path[i]]
        texts = table.column("text").to_pylist()
        role, starts, size, rendered, at = {}, {}, {}, {}, 0
        for i in order:
            lines, out = texts[i].split("\n"), []
            for line in lines:
                state = path[at]
                found = model.roles[state // 2]
                if state % 2 == 0:
                    out.append(f"<|{found}|>\n{without_marker(line, seen[at][0])}")
                else:
                    out.append(line)
                at += 1
            first = path[at - len(lines)]
            role[i], starts[i], size[i], rendered[i] = model.roles[first // 2], bool(first % 2 == 0), len(lines), "\n".join(out)
        n = range(len(texts))
        return pa.table({
            "conv_id": table.column("conv_id"), "turn": table.column("turn"), "role": table.column("role"),
            "role_found": pa.array([role[i] for i in n], pa.string()), "starts": pa.array([starts[i] for i in n], pa.bool_()),
            "n_lines": pa.array([size[i] for i in n], pa.int64()), "rendered": pa.array([rendered[i] for i in n], pa.string()),
        })

    return run


def _matrices(table: pa.Table, states: int) -> tuple[list[int], list[np.ndarray]]:
    blocks = table.column("block").to_pylist()
    order = sorted(range(len(blocks)), key=blocks.__getitem__)
    data = table.column("matrix").to_pylist()
    return [blocks[i] for i in order], [np.frombuffer(data[i]).reshape(states + 1, states) for i in order]


def _join_level(states: int):
    """The matrix of several neighbouring blocks together."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, matrices = _matrices(table, states)
        whole = matrices[0]
        for m in matrices[1:]:
            whole = (whole[:, :, None] + m[None, :states, :]).max(axis=1)
        return pa.table({"key": [key[0].as_py()], "block": [key[1].as_py()], "matrix": pa.array([whole.tobytes()], pa.binary())})

    return run


def _hand_down(states: int):
    """Best states at the cuts between blocks, given the states around all of them."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        blocks, matrices = _matrices(table, states)
        entry, leave = table.column("entry")[0].as_py(), table.column("leave")[0].as_py()
        reach, came = matrices[0][entry], []
        for m in matrices[1:]:
            ways = reach[:, None] + m[:states]
            came.append(ways.argmax(axis=0))
            reach = ways.max(axis=0)
        last = [int(reach.argmax()) if leave < 0 else leave]
        for back in reversed(came):
            last.append(int(back[last[-1]]))
        last.reverse()
        return pa.table({
            "key": [key[0].as_py()] * len(blocks), "block": blocks,
            "entry": pa.array([entry, *last[:-1]], pa.int32()), "leave": pa.array(last, pa.int32()),
        })

    return run


def recover_roles(transcript: DataFrame, model: Model) -> DataFrame:
    """``conv_id, turn, role, role_found, starts, n_lines, rendered`` for every row of a transcript table.

    ``role_found`` is the role of the row's first line and ``starts`` says whether a turn begins there.
    ``rendered`` is the row's part of the canonical transcript: ``<|role|>`` lines before turns, markers taken
    off. Rows are ordered by turn (NULL first) and then by a hash of role and text; rows without a conversation
    id form one conversation. Empty text is one empty line. Without any known role nothing can be found: the
    roles come back NULL and the texts as they are.
    """
    schema = "conv_id long, turn long, role string, role_found string, starts boolean, n_lines long, rendered string"
    if not model.roles:
        return transcript.select(
            "conv_id", "turn", "role", F.lit(None).cast("string").alias("role_found"), F.lit(False).alias("starts"),
            F.size(F.split("text", "\n")).cast("long").alias("n_lines"), F.col("text").alias("rendered"),
        )
    states = 2 * len(model.roles)
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("none"))
    # Blocks hold so many rows each, whatever their turn numbers: rows without a conversation or turn are cut as well.
    placed = ranked(transcript.select("conv_id", "turn", "tie", "role", "text").withColumn("key", key), "key", ["turn", "tie"], "transcript-rows")
    rows = written(placed.withColumn("block", F.floor(F.col("at") / BLOCK_TURNS).cast("long")).drop("at"), "transcript-blocks")
    level = "key string, block long, matrix binary"
    above = F.floor(F.col("block") / BRANCH).cast("long")
    levels = [cut_lineage(rows.groupBy("key", "block").applyInArrow(_block_matrix(model), level))]
    while levels[-1].groupBy("key").count().where("count > 1").limit(1).count():
        parts = levels[-1].withColumn("above", above)
        levels.append(cut_lineage(parts.groupBy("key", "above").applyInArrow(_join_level(states), level)))
    # From one block for each conversation down to the blocks of turns: the states around every block.
    known = levels[-1].select("key", F.col("block").alias("above"), F.lit(states).alias("entry"), F.lit(-1).alias("leave"))
    for depth in reversed(range(len(levels))):
        parts = levels[depth].withColumn("above", F.col("block") if depth == len(levels) - 1 else above)
        known = cut_lineage(
            parts.join(known, ["key", "above"]).groupBy("key", "above")
            .applyInArrow(_hand_down(states), "key string, block long, entry int, leave int")
        )
        if depth:
            known = known.withColumnRenamed("block", "above")
    return rows.join(known, ["key", "block"]).groupBy("key", "block").applyInArrow(_decode(model), schema)


def held_out_roles(conversations: DataFrame) -> DataFrame:
    """The conversations as transcripts, parsed with a model of those whose crc32(conv_id) modulo 3 is not 1."""
    transcript = as_transcript(conversations)
    model = fit(transcript.where(fold(F.col("conv_id"), 3) != 1))
    return recover_roles(transcript, model)
