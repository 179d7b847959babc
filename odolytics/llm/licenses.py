"""License scans: license templates with optional and replaceable regions, compiled into token automata.

A template is plain wording with ``[[ ... ]]`` around regions that may be missing and ``{{n}}`` for a region
of up to n words of any kind (names, years). Everything else is mandatory and must stand there word for word.
The automaton of a template runs from each place where its first word stands, and only in texts that hold
all its mandatory words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odolytics.llm.batches import bounded
from odolytics.llm import tokens

# Phrases with their labels, and the usual notices of public licenses.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = {
    "mit-notice": "[[this {{3}} is]] [[licensed]] [[released]] [[distributed]] [[available]] under [[the terms of]] the mit license",
    "mit-permission": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"
    ),
    "apache-2.0": "[[licensed]] [[released]] [[distributed]] under [[the terms of]] the apache license [[version]] 2 0 [[the license]]",
    "gpl-2.0": "under [[the terms of]] the gnu general public license [[as published by the free software foundation either]] version 2",
    "gpl-3.0": "under [[the terms of]] the gnu general public license [[as published by the free software foundation either]] version 3",
    "lgpl": "under [[the terms of]] the gnu lesser general public license",
    "agpl-3.0": "under [[the terms of]] the gnu affero general public license [[as published by the free software foundation either]] version 3",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "mpl-2.0": "subject to the terms of the mozilla public license [[v]] [[version]] 2 0",
    "cc-by-4.0": "[[licensed]] under [[a]] [[the]] [[creative commons]] cc by 4 0",
    "cc-by-sa-4.0": "[[licensed]] under [[a]] [[the]] [[creative commons]] cc by sa 4 0",
    "cc-by-nc-4.0": "[[licensed]] under [[a]] [[the]] [[creative commons]] cc by nc 4 0",
    "all-rights-reserved": "[[copyright {{8}}]] all rights reserved",
}

TOKEN = re.compile(r"\[\[|\]\]|\{\{\d+\}\}|[0-9a-z\u0080-\U0010ffff]+")

_U = np.uint64
GAPS = np.ones(256, dtype=bool)
GAPS[0x30:0x3A] = GAPS[0x41:0x5B] = GAPS[0x61:0x7B] = GAPS[0x80:] = False


@dataclass
class Automaton:
    """States with word steps, any-word steps and free steps; the last state accepts."""

    words: list[tuple[int, str, int]] = field(default_factory=list)
    anything: list[tuple[int, int]] = field(default_factory=list)
    free: list[tuple[int, int]] = field(default_factory=list)
    mandatory: set[str] = field(default_factory=set)
    states: int = 1


def compile_template(template: str) -> Automaton:
    made, here, opened = Automaton(), 0, []
    for token in TOKEN.findall(template):
        if token == "[[":
            opened.append(here)
        elif token == "]]":
            made.free.append((opened.pop(), here))
        elif token.startswith("{{"):
            start = here
            for _ in range(int(token[2:-2])):
                made.anything.append((here, made.states))
                here, made.states = made.states, made.states + 1
                made.free.append((start, here))
        else:
            made.words.append((here, token, made.states))
            here, made.states = made.states, made.states + 1
            if not opened:
                made.mandatory.add(token)
    if opened:
        raise ValueError("a region is not closed: " + template)
    # The accepting state is the last one made or reached by a free step at the end.
    end = made.states
    made.states += 1
    made.free.append((here, end))
    return made


class Runner:
    """An automaton over word numbers, with steps collected over free moves."""

    def __init__(self, automaton: Automaton, number: dict[str, int]) -> None:
        after = {s: {s} for s in range(automaton.states)}
        changed = True
        while changed:
            changed = False
            for a, b in automaton.free:
                for reach in after.values():
                    if a in reach and b not in reach:
                        reach.add(b)
                        changed = True
        self.final = automaton.states - 1
        self.start = frozenset(after[0])
        self.mandatory = np.array(sorted(number[w] for w in automaton.mandatory))
        self.by_word: dict[tuple[int, int], set[int]] = {}
        for s, word, to in automaton.words:
            self.by_word.setdefault((s, number[word]), set()).update(after[to])
        self.any: dict[int, set[int]] = {}
        for s, to in automaton.anything:
            self.any.setdefault(s, set()).update(after[to])
        self.first = np.array(sorted({w for (s, w) in self.by_word if s in self.start}))
        self.cache: dict[tuple[frozenset, int], frozenset] = {}

    def step(self, states: frozenset, word: int) -> frozenset:
        known = self.cache.get((states, word))
        if known is None:
            out: set[int] = set()
            for s in states:
                out |= self.by_word.get((s, word), set()) | self.any.get(s, set())
            known = self.cache[(states, word)] = frozenset(out)
        return known

    def accepts_at(self, numbers: np.ndarray, at: int) -> bool:
        states = self.start
        for word in numbers[at:]:
            states = self.step(states, int(word))
            if self.final in states:
                return True
            if not states:
                return False
        return False

    def found_in(self, numbers: np.ndarray, present: np.ndarray) -> bool:
        if not present[self.mandatory].all():
            return False
        return any(self.accepts_at(numbers, int(i)) for i in np.flatnonzero(np.isin(numbers, self.first)))


def _scan(templates: dict[str, str], phrases: dict[str, str]):
    automata = {label: compile_template(t) for label, t in templates.items()}
    vocabulary = sorted({w for a in automata.values() for _, w, _ in a.words} | {w for p in phrases for w in p.split()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Word numbers follow the order of their hashes; zero stands for every other word.
        hashes = {w: tokens.word_hash(w) for w in vocabulary}
        ranked = sorted(vocabulary, key=hashes.get)
        known = np.array([hashes[w] for w in ranked], dtype=_U)
        number = {w: i + 1 for i, w in enumerate(ranked)}
        runners = {label: Runner(a, number) for label, a in automata.items()}
        sequences = {p: np.array([number[w] for w in p.split()]) for p in phrases}
        for batch in batches:
            n_words, n_base, first, last, base, labels, score = [], [], [], [], [], [], []
            for row in tokens.word_rows(batch.column("text"), GAPS):
                place = np.minimum(np.searchsorted(known, row), len(known) - 1)
                numbers = np.where(known[place] == row, place + 1, 0)
                present = np.bincount(numbers, minlength=len(known) + 1) > 0
                starts, own = [], set()
                for phrase, sequence in sequences.items():
                    if len(row) < len(sequence) or not present[sequence].all():
                        continue
                    hit = numbers[: len(row) - len(sequence) + 1] == sequence[0]
                    for k in range(1, len(sequence)):
                        hit &= numbers[k : len(row) - len(sequence) + 1 + k] == sequence[k]
                    at = np.flatnonzero(hit)
                    if len(at):
                        starts.append(at)
                        own.add(phrases[phrase])
                matched = {label for label, r in runners.items() if r.found_in(numbers, present)}
                at = np.concatenate(starts) if starts else np.zeros(0, np.int64)
                n_words.append(len(row))
                n_base.append(len(at))
                first.append(int(at.min()) if len(at) else None)
                last.append(int(at.max()) if len(at) else None)
                base.append(",".join(sorted(own)))
                labels.append(",".join(sorted(own | matched)))
                score.append(1.0 if matched else 0.5 if own else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_base, pa.int64()), pa.array(first, pa.int64()),
                 pa.array(last, pa.int64()), pa.array(base, pa.string()), pa.array(labels, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return run


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for every row.

    Words are runs of letters and digits of ASCII (A-Z lowered) and of all other characters. ``n_base`` counts
    the places of the plain phrases; ``labels`` adds the templates that the text holds. The score is 1 if a
    template is held, 0.5 for a plain phrase alone, else 0. NULL and empty texts have no words and no labels.
    Repeated rows give the same result each; other columns are not read. No rows, no result.
    """
    run = _scan(TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases)
    return bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    )


def _as_pattern(template: str) -> str:
    """A template as a regular expression over words that each end in a space."""
    parts = {"[[": "(?:", "]]": ")?"}
    return "".join(
        f"(?:[^ ]+ ){{0,{int(t[2:-2])}}}" if t.startswith("{{") else parts.get(t, t + " ") for t in TOKEN.findall(template)
    )


def _place_count(phrase: str) -> str:
    words = phrase.split()
    same = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(words))
    return f"list_filter(generate_series(1, len(w) - {len(words) - 1}), lambda i: {same})"


ORACLE = (
    r"""WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
j AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS line, """
    + ", ".join(f"{_place_count(p)} AS {label}" for p, label in PHRASES.items())
    + " FROM t), m AS (SELECT *, list_concat(list_concat("
    + ", ".join(list(PHRASES.values())[:2]) + f"), {list(PHRASES.values())[2]}) AS places, list_filter(["
    + ", ".join(f"CASE WHEN len({label}) > 0 THEN '{label}' END" for label in PHRASES.values())
    + "], lambda x: x IS NOT NULL) AS base, list_filter(["
    + ", ".join(f"CASE WHEN regexp_matches(line, ' {_as_pattern(t)}') THEN '{label}' END" for label, t in TEMPLATES.items())
    + """], lambda x: x IS NOT NULL) AS own FROM j)
SELECT doc_id, len(w)::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT - 1 AS first_word,
  list_max(places)::BIGINT - 1 AS last_word, array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, own))), ',') AS labels,
  CASE WHEN len(own) > 0 THEN 1.0 WHEN len(base) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score FROM m"""
)
