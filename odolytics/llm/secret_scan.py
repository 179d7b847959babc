"""Secret scans over versioned texts, kept in an incremental ledger of blobs; DataFrame functions only.

Every version of every path is content-addressed by the SHA-256 of its text. The ledger has one row per blob and
load: the rules (kind and version) run on it then, and what they found. A load scans only the (blob, rule version)
pairs the ledger lacks, each blob once however many paths hold it, and findings are joined back to all paths.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odolytics.session import work_path


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches are leftmost and do not overlap; ``group`` must have ``least`` characters."""

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1
    holds: str | None = None        # a text without this string has no match

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The kinds in the order in which spans of one start are listed.
BASE = (
    Rule(
        "assign",
        "(" + _either_case("password") + "|" + _either_case("passwd") + "|" + _either_case("secret") + "|" + _either_case("token")
        + "|" + _either_case("api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2, least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}", holds="AKIA"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", holds="PRIVATE KEY-----"),
    Rule("forge_token", r"gh[oprsu]_[A-Za-z0-9]{36,}", holds="gh"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", holds="xox"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", holds="eyJ"),
    Rule("url_login", r"://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{1,64}@", holds="://"),
)
RULES = BASE + ADDED

LEDGER = "blob string, scanned array<string>, findings array<struct<start:bigint,`end`:bigint,rule:string>>"
_HITS = "array<struct<rule:string,least:int,gap:int,size:int,value:int>>"


def _once(value: Column, use) -> Column:
    """Use a value several times but work it out once, as the variable of a one-element transform."""
    return F.transform(F.array(value), use)[0]


def _hits(text: Column, wanted: Column, rule: Rule) -> Column:
    """Matches of one rule in order: characters since the match before, length, and length of the value."""
    if rule.holds:
        wanted = wanted & text.contains(rule.holds)

    def of(pieces: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
        value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
        zipped = F.arrays_zip(pieces, found, value).cast("array<struct<piece:string,found:string,value:string>>")
        matched = F.filter(zipped, lambda z: z["found"].isNotNull())        # the last piece is what follows all matches
        return F.transform(
            matched,
            lambda z: F.struct(
                F.lit(rule.id).alias("rule"), F.lit(rule.least).alias("least"), F.length(z["piece"]).alias("gap"),
                F.length(z["found"]).alias("size"), F.length(z["value"]).alias("value"),
            ),
        )

    pieces = F.when(wanted, F.split(text, rule.pattern, -1))
    return _once(pieces, lambda p: F.when(F.size(p) > 1, of(p)).otherwise(F.array().cast(_HITS)))


def _scanned(todo: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Ledger rows of ``blob, text, missing``, where ``missing`` lists the rules to run.

    Offsets are running sums over the matches of one rule in one blob. Rows stay where their blob is: the window
    and the group add no exchange to the one that made blobs distinct.
    """
    hits = F.flatten(F.array(*[_hits(F.col("text"), F.array_contains("missing", r.id), r) for r in rules]))
    rows = todo.select("blob", "missing", hits.alias("hits")).select("blob", "missing", F.posexplode_outer("hits").alias("place", "hit"))
    along = Window.partitionBy("blob", "hit.rule").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("hit.gap").cast("long") + F.col("hit.size")).over(along)
    rows = rows.select("blob", "missing", "hit", end.alias("stop"))
    finding = F.struct((F.col("stop") - F.col("hit.size")).alias("start"), F.col("stop").alias("end"), F.col("hit.rule").alias("rule"))
    return rows.groupBy("blob").agg(
        F.first("missing").alias("scanned"),
        F.array_sort(F.collect_list(F.when(F.col("hit.value") >= F.col("hit.least"), finding))).alias("findings"),
    )


def unseen(blobs: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``blob, missing`` of the blobs on which some current rule version has not been run yet."""
    known = ledger.groupBy("blob").agg(F.flatten(F.collect_list("scanned")).alias("known"))
    missing = F.array_except(F.array(*[F.lit(r.id) for r in rules]), F.coalesce("known", F.array().cast("array<string>")))
    return blobs.select("blob").distinct().join(known, "blob", "left").select("blob", missing.alias("missing")).where(F.size("missing") > 0)


def scan_versions(versions: DataFrame, ledger: str, keys: Sequence[str] = ("doc_id",), rules: Sequence[Rule] = RULES) -> DataFrame:
    """``keys, blob, findings`` for every row of ``versions``, after bringing the ledger at path ``ledger`` up to date.

    ``findings`` holds (start, end, rule) in code points, end exclusive, by start and then by the order of ``rules``.
    NULL text is the empty text, which has none. Repeated rows and paths each come back; rows without a key too.
    Other columns are not read; no rows, no result. A load that dies part-way leaves whole ledger rows behind and
    the next one scans the rest. Offsets of a rule version that is no longer listed stay in the ledger, unread.
    """
    spark = versions.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    read = versions.select(F.struct(*[F.col(f"`{k}`") for k in keys]).alias("path"), text.alias("text")).withColumn("blob", F.sha2("text", 256))
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(ledger)
    seen = spark.read.schema(LEDGER).parquet(ledger)
    if seen.isEmpty():
        texts = read.withColumn("missing", F.array(*[F.lit(r.id) for r in rules]))
    else:
        texts = read.join(unseen(read, seen, rules), "blob")        # digests first: texts of known blobs are not shuffled again
    todo = texts.select("blob", "text", "missing").dropDuplicates(["blob"])
    _scanned(todo, rules).write.mode("append").parquet(ledger)
    listed = F.array(*[F.lit(r.id) for r in rules])
    current = (
        spark.read.schema(LEDGER).parquet(ledger).where(F.size("findings") > 0)
        .groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("findings"))
    )
    placed = F.transform(
        F.filter("findings", lambda f: F.array_contains(listed, f["rule"])),
        lambda f: F.struct(f["start"], F.array_position(listed, f["rule"]).alias("place"), f["end"], f["rule"]),
    )
    ordered = F.transform(F.array_sort(placed), lambda f: F.struct(f["start"].alias("start"), f["end"].alias("end"), f["rule"].alias("rule")))
    none = F.array().cast("array<struct<start:bigint,`end`:bigint,rule:string>>")
    found = read.select("path", "blob").join(current.select("blob", ordered.alias("findings")), "blob", "left")
    return found.select("path.*", "blob", F.coalesce("findings", none).alias("findings"))


def secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, blob`` for every row of ``docs``, from a ledger of its own.

    ``spans`` lists all findings as kind:start:end, ``base_sha256`` digests the list of the three base kinds.
    """
    found = scan_versions(docs, work_path(docs.sparkSession, "secrets"))

    def kind(finding: Column) -> Column:
        return F.substring_index(finding["rule"], "@", 1)

    base = F.filter("findings", lambda f: kind(f).isin([r.kind for r in BASE]))

    def joined(findings: Column) -> Column:
        return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", kind(f), f["start"].cast("string"), f["end"].cast("string"))), ",")

    def count(name: str) -> Column:
        return F.size(F.filter("findings", lambda f: kind(f) == name)).cast("long").alias(f"n_{name}")

    return found.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"), "blob")


def _sql_rule(place: int, rule: Rule) -> str:
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    return f"""SELECT doc_id, '{rule.kind}' AS kind, {place} AS place, {rule.least} AS least,
    unnest(list_zip(string_split_regex(text, {pattern})[:-2], regexp_extract_all(text, {pattern}), regexp_extract_all(text, {pattern}, {rule.group}))) AS m,
    unnest(generate_series(1, len(regexp_extract_all(text, {pattern})))) AS k
  FROM t"""


ORACLE = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(_sql_rule(i, r) for i, r in enumerate(RULES))}),
p AS (
  SELECT doc_id, kind, place, length(m[3]) >= least AS valid, length(m[2]) AS size,
    sum(length(m[1]) + length(m[2])) OVER (PARTITION BY doc_id, kind ORDER BY k) AS stop
  FROM m),
s AS (SELECT doc_id, place, stop - size AS start, kind, kind || ':' || (stop - size) || ':' || stop AS span FROM p WHERE valid),
g AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex,
    string_agg(span, ',' ORDER BY start, place) FILTER (WHERE place < {len(BASE)}) AS base, string_agg(span, ',' ORDER BY start, place) AS spans
  FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(text) AS blob
FROM t LEFT JOIN g USING (doc_id)
"""
