"""The secret ledger against plain Python, over several loads, and on odd rows."""

import hashlib
import random
import re
from collections import Counter
from dataclasses import replace

import pytest

from odolytics.llm import secret_scan
from tests.llm.conftest import odd_rows


def plain(text, rules=secret_scan.RULES):
    """Spans of a text by a left-to-right search per rule."""
    spans = []
    for place, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m.group(rule.group)) >= rule.least:
                spans.append((m.start(), place, m.end(), rule.id))
    return [(a, b, r) for a, _, b, r in sorted(spans)]


def texts():
    dice = random.Random(11)
    parts = [
        "password: hunter22", "PassWD='abcdef'", "token=ab", "token=token: abcdefg", "api_key=\"A/b+c.d-e_f=\"", "APIKEY = 123456", "secret:\n123456",
        "AKIA" + "Z9" * 8, "AKIA" + "Z" * 15, "AKIAAKIA" + "Q" * 16, "0123456789abcdef" * 2, "deadbeef" * 2, "deadbeef" * 3, "é", "😀", "\n", " ", "=", "'",
        "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1B2" * 9, "xoxb-1234567890-abc", "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl", "ftp://user:pa55@host/x",
    ]
    return ["".join(dice.choice(parts) + dice.choice(["", " ", "\n", "x"]) for _ in range(dice.randrange(12))) for _ in range(300)] + ["", None]


@pytest.fixture()
def ledger(tmp_path):
    return str(tmp_path / "ledger")


def spans_of(found, key="doc_id"):
    return {r[key]: [tuple(f) for f in r["findings"]] for r in found.collect()}


def test_spans_equal_a_plain_search(spark, ledger):
    rows = list(enumerate(texts()))
    found = secret_scan.scan_versions(spark.createDataFrame(rows, "doc_id long, text string"), ledger)
    assert spans_of(found) == {d: plain(t) for d, t in rows}


def test_digest_columns(spark):
    rows = list(enumerate(texts()))
    kinds = ["assign", "access", "hex"]
    for r in secret_scan.secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        spans = [f"{rule.split('@')[0]}:{a}:{b}" for a, b, rule in plain(rows[r["doc_id"]][1])]
        base = [s for s in spans if s.split(":")[0] in kinds]
        assert r["spans"] == ",".join(spans)
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s.startswith(k) for s in base) for k in kinds]


def test_a_load_scans_only_what_the_ledger_lacks(spark, ledger):
    old = [("a", 1, "token=abcdef"), ("b", 1, "token=abcdef"), ("c", 1, "nothing")]
    new = [*old, ("a", 2, "AKIA" + "B" * 16), ("d", 1, "nothing")]
    schema, keys = "path string, version int, text string", ("path", "version")
    secret_scan.scan_versions(spark.createDataFrame(old, schema), ledger, keys).count()
    first = spark.read.parquet(ledger)
    assert first.count() == 2                       # two blobs behind three paths
    found = secret_scan.scan_versions(spark.createDataFrame(new, schema), ledger, keys)
    assert {(r["path"], r["version"]): [tuple(f) for f in r["findings"]] for r in found.collect()} == {(p, v): plain(t) for p, v, t in new}
    assert spark.read.parquet(ledger).count() == 3  # one further blob
    secret_scan.scan_versions(spark.createDataFrame(new, schema), ledger, keys).count()
    assert spark.read.parquet(ledger).count() == 3  # nothing to do


def test_a_raised_rule_version_runs_alone_over_all_blobs(spark, ledger):
    rows = [(1, "token=abcdef " + "ab" * 12), (2, "token=abcd"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    secret_scan.scan_versions(docs, ledger).count()
    raised = [replace(r, version=2, least=4) if r.kind == "assign" else r for r in secret_scan.RULES]
    found = spans_of(secret_scan.scan_versions(docs, ledger, rules=raised))
    assert found == {d: plain(t, raised) for d, t in rows}
    scanned = Counter(tuple(r["scanned"]) for r in spark.read.parquet(ledger).collect())
    assert scanned == {tuple(r.id for r in secret_scan.RULES): 3, ("assign@2",): 3}
    assert spans_of(secret_scan.scan_versions(docs, ledger)) == {d: plain(t) for d, t in rows}     # the old version is still there


def test_rows_that_died_part_way_are_scanned_again(spark, ledger):
    rows = [(i, f"token=abcdef{i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    half = ledger + "-half"
    secret_scan.scan_versions(docs, ledger).count()
    spark.read.parquet(ledger).where("substr(blob, 1, 1) < '8'").write.parquet(half)
    assert spans_of(secret_scan.scan_versions(docs, half)) == {d: plain(t) for d, t in rows}
    assert spark.read.parquet(half).groupBy("blob").count().where("count > 1").isEmpty()


def test_many_matches_in_one_text(spark, ledger):
    text = " ".join("0123456789abcdef" * 2 for _ in range(20_000))
    found = spans_of(secret_scan.scan_versions(spark.createDataFrame([(1, text)], "doc_id long, text string"), ledger))
    assert found == {1: plain(text)}


def test_odd_rows_and_none(odd, nothing):
    found = secret_scan.secrets(odd)
    assert Counter(r["doc_id"] for r in found.collect()) == Counter(r[0] for r in odd_rows())
    assert secret_scan.secrets(nothing).count() == 0


def test_copies_share_one_scan_and_no_python_runs(spark, ledger):
    docs = spark.createDataFrame([(None if i % 2 else i, "secret=abcdef") for i in range(3000)], "doc_id long, text string")
    found = secret_scan.scan_versions(docs, ledger)
    assert found.where("size(findings) = 1").count() == 3000
    assert spark.read.parquet(ledger).count() == 1
    assert "Python" not in found._jdf.queryExecution().toString() and "Arrow" not in found._jdf.queryExecution().toString()
