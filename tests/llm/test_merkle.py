"""The Merkle manifest against a tree built row by row, and on odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from odolytics.llm import merkle, ranking
from tests.llm.conftest import odd_rows

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return H(*map(field, row))


def plain(rows):
    """{(row, place among its copies): (leaf, subroot, root, proof, folded root)} as a counter of results per row."""
    trees = defaultdict(list)
    for row in rows:
        trees[row[1]].append(row)
    for source in trees:
        trees[source].sort(key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, leaf(r)))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
        return out

    def steps(tower, at):
        for nodes in tower[:-1]:
            run = at - at % 3
            yield nodes[run:at], nodes[at + 1 : run + 3]
            at //= 3

    towers = {s: levels([leaf(r) for r in rs]) for s, rs in trees.items()}
    order = sorted(towers, key=lambda s: (s is not None, (s or "").encode()))
    top = levels([towers[s][-1][0] for s in order])
    found = Counter()
    for s, rs in trees.items():
        for at, row in enumerate(rs):
            way = [*steps(towers[s], at), *steps(top, order.index(s))]
            cut = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None
            folded = leaf((*row[:4], row[4].replace("\n", "")) if cut else row)
            for left, right in way:
                folded = H(*left, folded, *right)
            proof = H(*[h for left, right in way for h in (*left, *right)])
            found[(row[0], leaf(row), towers[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0], len(way))] += 1
    return found


def of(spark, rows, schema=SCHEMA):
    return Counter(tuple(r) for r in merkle.manifest(spark.createDataFrame(rows, schema)).collect())


def made(sizes, seed=3):
    dice = random.Random(seed)
    rows, at = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            text = dice.choice([None, "", "a\nb", "épsilon\n", "x" * dice.randrange(50)])
            rows.append((at, source, dice.choice([None, "en", ""]), dice.choice([None, at]), text))
            at += dice.randrange(1, 4)
    dice.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {None: 1, "": 1}, {"a": 2, "b": 3, "c": 4}, {None: 28, "": 1, "Z": 27, "a": 9, "é": 10, "😀": 2, "10": 1, "￿": 1},
    {f"s{i}": 1 + i % 3 for i in range(30)},
])
def test_manifest_equals_plain_trees(spark, sizes):
    rows = made(sizes)
    assert of(spark, rows) == plain(rows)


def test_copies_and_missing_ids_have_places_of_their_own(spark):
    rows = [(1, "a", "en", 3, "x\ny")] * 40 + [(None, "a", None, None, None)] * 30 + [(None, "a", None, 1, "z\n")] * 3 + [(1, None, "en", 3, "w")]
    assert of(spark, rows) == plain(rows)


def test_tampering_is_seen_exactly_where_it_changed_something(spark):
    rows = made({"a": 40, "b": 7})
    for r in merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect():
        text = next(row[4] for row in rows if row[0] == r["doc_id"])
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and "\n" in (text or "")
        assert r["verified"] == (not changed)
        source = next(row[1] for row in rows if row[0] == r["doc_id"])
        assert r["n_levels"] == {"a": 4, "b": 2}[source] + 1       # one level above the two sources


def test_odd_rows_and_none(spark, odd, nothing):
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = [tuple(r) for r in odd.select(*names).collect()]
    assert Counter(tuple(r) for r in merkle.manifest(odd).collect()) == plain(rows)
    assert sum(plain(rows).values()) == len(odd_rows())
    assert merkle.manifest(nothing).count() == 0


def test_ranks_of_a_hot_group_are_dealt_over_many_ranges(spark):
    dice = random.Random(1)
    rows = [("hot", dice.randrange(50)) for _ in range(5000)] + [(f"g{i % 7}", i) for i in range(500)] + [("copies", 1)] * 3000
    found = ranking.ranked(spark.createDataFrame(rows, "g string, v int"), "g", ["v"]).collect()
    by_group = defaultdict(list)
    for r in found:
        by_group[r["g"]].append((r["at"], r["v"]))
    assert Counter((r["g"], r["v"]) for r in found) == Counter(rows)
    for places in by_group.values():
        places.sort()
        assert [a for a, _ in places] == list(range(len(places)))
        assert [v for _, v in places] == sorted(v for _, v in places)


def test_levels_are_joined_without_a_cross_join(spark):
    found = merkle.manifest(spark.createDataFrame(made({"a": 30, "b": 5}), SCHEMA))
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
