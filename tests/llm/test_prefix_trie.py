"""The prefix trie against rebuilt conversations, on odd rows and on long or copied conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from odolytics.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """{(smallest member, depth): (parent, members, children, leaves, saved, ends digest, ends)}"""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            order = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, order, (role, text)))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in own.items()}
    members, length = defaultdict(list), {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        turns = own.get(base, [])[:h] + own[c][h:]
        length[c] = len(turns)
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, below = defaultdict(int), defaultdict(lambda: [0, 0])
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, convs in members.items():
        saved = (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            below[path[:d]][0] += saved
            below[path[:d]][1] += path not in children
    found = {}
    for path, convs in members.items():
        ends = sorted(c for c in convs if length[c] == len(path))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[path[:-1]]) if path else None
        found[min(convs), len(path)] = (parent, len(convs), children[path] if path in children else 0, below[path][1], below[path][0], digest, len(ends))
    return found


def of(spark, rows, schema=SCHEMA):
    out = prefix_trie.prefix_trie(spark.createDataFrame(rows, schema)).collect()
    named = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"], r["n_ends"]) for r in out}
    assert len(named) == len(out)
    return named


def made(n, seed, words=3, most=14):
    dice = random.Random(seed)
    return [
        (c, t, dice.choice(["user", "assistant", None]), dice.choice(["é", "", None, *[f"w{i}" for i in range(words)]]))
        for c in range(n) if dice.random() < 0.8 for t in range(dice.randrange(1, most))
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_rebuilt_conversations(spark, seed):
    rows = made(120, seed, words=1 + seed)
    random.Random(seed).shuffle(rows)
    assert of(spark, rows) == plain(rows)


def test_missing_tied_and_repeated_turns(spark):
    rows = made(20, 5) + [(3, None, "user", "first"), (3, None, None, None), (4, 1, "b", "x"), (4, 1, "a", "x"), (4, 1, "a", "x"), (None, 1, "user", "nobody"), (-7, 1, "user", "x"), (-5, 0, "user", "y"), (10**15 + 3, 0, None, "far")]
    assert of(spark, rows) == plain(rows)


def test_conversations_that_lose_all_turns_end_at_the_root(spark):
    short = [c for c in range(1, 300) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2][:40]
    rows = [(c, t, "user", "x") for c in short for t in range(2)]       # no base is there, and the own turns are replaced
    found = of(spark, rows)
    assert found == plain(rows) and found[min(short), 0][-1] == len(short)


def test_copies_of_one_conversation_and_a_long_one(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    monkeypatch.setattr(prefix_trie, "CHUNK_BYTES", 20)
    rows = [(c, t, "user", f"t{t}") for c in range(0, 600, 5) for t in range(3)] + [(7, t, "user", f"t{t % 3}") for t in range(700)] + [(5000, t, "user", f"t{t}") for t in range(90)]
    assert of(spark, rows) == plain(rows)


def test_a_collision_starts_again_with_other_bases(spark, monkeypatch):
    rows, real = made(60, 9), prefix_trie.bases
    monkeypatch.setattr(prefix_trie, "bases", lambda attempt: [1] * prefix_trie.LANES if attempt == 0 else real(attempt))
    assert of(spark, rows) == plain(rows)


def test_stored_turns_are_the_last_turns(spark):
    rows = made(60, 4)
    own = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: r[:2]):
        own[c].append((role or "", text or ""))
    for r in prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect():
        if r["depth"]:
            c, h = r["conv_id"], zlib.crc32(str(r["conv_id"]).encode()) % 9
            turns = own.get(c - c % 5, [])[:h] + own[c][h:]
            assert own[r["turn_conv"]][r["turn_place"] - 1] == turns[r["depth"] - 1]


def test_further_columns_and_no_rows(spark):
    clash = "conv_id long, turn long, role string, text string, conv int, place string, block int, t0 int, s0 int, f1 int, bytes int, first string"
    rows = [(*r, 1, "p", 2, 3, 4, 5, 6, "f") for r in made(15, 8)]
    assert of(spark, rows, clash) == plain([r[:4] for r in rows])
    assert of(spark, [], SCHEMA) == {}
    assert of(spark, [(None, 1, "user", "x")], SCHEMA) == {}
