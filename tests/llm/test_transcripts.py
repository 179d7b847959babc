"""Roles recovered from transcripts."""

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from odolytics.llm import transcripts


@pytest.fixture(scope="module")
def transcript(spark, folder):
    return transcripts.as_transcript(spark.read.parquet(f"{folder}/conversations.parquet")).cache()


def viterbi(model, rows):
    """Best states of one whole transcript, by the textbook recursion."""
    lines = [(k, i) for i, r in enumerate(rows) for k in range(len(r["text"].split("\n")))]
    seen = [transcripts.features(rows[i]["text"].split("\n")[k], k == 0 and rows[i]["turn"] == 0) for k, i in lines]
    score = model.scores(seen)
    reach, back = model.start + score[0], []
    for s in score[1:]:
        ways = reach[:, None] + model.step
        back.append(ways.argmax(axis=0))
        reach = ways.max(axis=0) + s
    path = [int(reach.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    path.reverse()
    return {rows[i]["turn"]: path[n] for n, (k, i) in enumerate(lines) if k == 0}


@pytest.mark.parametrize(("block", "branch"), [(1024, 1024), (2, 2), (1, 3)])
def test_blocks_give_the_same_as_whole_transcripts(transcript, monkeypatch, block, branch):
    model = transcripts.fit(transcript)
    monkeypatch.setattr(transcripts, "BLOCK_TURNS", block)
    monkeypatch.setattr(transcripts, "BRANCH", branch)
    found = {(r["conv_id"], r["turn"]): (r["role_found"], r["starts"]) for r in transcripts.recover_roles(transcript, model).collect()}
    conversations = {}
    for r in transcript.orderBy("conv_id", "turn", "tie").collect():
        conversations.setdefault(r["conv_id"], []).append(r)
    for conv, rows in conversations.items():
        for turn, state in viterbi(model, rows).items():
            assert found[conv, turn] == (model.roles[state // 2], state % 2 == 0)


def test_roles_of_conversations_not_learned_from(spark, folder):
    found = transcripts.held_out_roles(spark.read.parquet(f"{folder}/conversations.parquet")).collect()
    assert sum(r["role"] == r["role_found"] for r in found) > 0.85 * len(found)
    for r in found:
        if r["starts"]:
            assert r["rendered"].startswith(f"<|{r['role_found']}|>\n")


def test_odd_turns(spark):
    rows = [
        (1, 0, "user", "Hello?"), (1, 0, "user", "Hello?"), (1, 1, "assistant", None), (1, None, "user", ""), (1, 5, None, "more\n\nlines"),
        (None, 0, "user", "x"), (None, None, None, None), (2, 0, "system", "y " * 50_000), (3, -4, "tool", "z"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = transcripts.held_out_roles(table).collect()
    assert sorted(str((r["conv_id"], r["turn"])) for r in found) == sorted(str(r[:2]) for r in rows)
    assert transcripts.held_out_roles(table.where("false")).count() == 0
    untaught = transcripts.held_out_roles(table.withColumn("role", transcripts.F.lit(None).cast("string")))
    assert untaught.count() == len(rows) and all(r["role_found"] is None for r in untaught.collect())


def test_rows_without_conversation_or_turn_are_cut_into_blocks(spark, monkeypatch):
    """One key, one repeated turn: blocks go by place, and cuts change no result."""
    dice = random.Random(6)
    rows = [(None, None if i % 2 else 3, dice.choice(["user", "assistant"]), dice.choice(["Yes?", "User: what now?", "Well.\nthat is it", ""]) + str(dice.randrange(9))) for i in range(400)]
    rows += [(7, 1, "user", f"again {i % 3}") for i in range(200)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    transcript = transcripts.as_transcript(table)
    model = transcripts.fit(transcript)

    def found():
        return sorted(str(tuple(r)) for r in transcripts.recover_roles(transcript, model).collect())

    whole = found()
    monkeypatch.setattr(transcripts, "BLOCK_TURNS", 32)
    assert found() == whole
    placed = transcripts.ranked(transcript.withColumn("key", F.lit("k")), "key", ["turn", "tie"]).groupBy(F.floor(F.col("at") / 32)).count()
    assert max(r["count"] for r in placed.collect()) == 32


def test_markers():
    assert transcripts.features("User: hi there?", True) == ("user", "?", "4", "yes")
    assert transcripts.features("Dear all: hi", False)[0] == "other"
    assert transcripts.features("a much longer heading than that: hi", False)[0] == "none"
    assert transcripts.without_marker("AI:  fine", "ai") == "fine"


def test_log_of_probabilities(transcript):
    model = transcripts.fit(transcript)
    assert np.allclose(np.exp(model.step).sum(axis=1), 1.0)
    assert random.Random(0).choice(model.roles) in ("assistant", "system", "user")
