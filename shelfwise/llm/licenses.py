"""Licence scans by Aho-Corasick over words and a shunting-yard parser of expressions.

Phrases are sequences of words, so one automaton over words finds all of them,
overlapping ones too, whatever stands between the words. It is walked only where
words of its vocabulary stand next to each other; anything else leads to the
root. A phrase is a notice, which names a licence, or a tag, which is followed by
an expression up to the end of its line: identifiers, parentheses, `with`, `and`,
`or`, from strong to weak. The parser takes the longest well-formed beginning of
that line, and evaluates it to how much it restricts: of an `or` the user takes
the freer side, of an `and` the stricter one holds, an exception (`with`) loosens.

Defined results: A-Z are lowered, nothing else; a word is a maximal run of a-z,
0-9 and characters beyond ASCII; a null text is empty; a text without words has
no finds and the score 0; an identifier of no known family is `unknown`; an
expression without an operand gives no find; a notice inside a longer one keeps
its label but does not count for the score. Rows that repeat a doc_id, also a
null one, are scanned one by one. Extra columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.tokens import Words, ascii_lower, row_of, slices, split_words, text_buffers

# fixed values: the phrases whose places are counted, and their labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# notices beside them
NOTICES = {
    "affero general public license": "agpl",
    "apache license": "apache",
    "boost software license": "bsl",
    "bsd license": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "dedicated to the public domain": "public-domain",
    "eclipse public license": "epl",
    "isc license": "isc",
    "lesser general public license": "lgpl",
    "mit license": "mit",
    "mozilla public license": "mpl",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "released into the public domain": "public-domain",
    "reproduction without permission is prohibited": "reserved",
}
TAGS = ("spdx license identifier", "license expression")
# how much a licence of a family restricts use
FAMILIES = {
    "public-domain": 0.05, "cc0": 0.05, "unlicense": 0.05, "mit": 0.1, "isc": 0.1, "bsd": 0.1, "bsl": 0.1,
    "zlib": 0.1, "apache": 0.15, "cc-by": 0.2, "mpl": 0.4, "epl": 0.4, "lgpl": 0.5, "cc-by-sa": 0.5,
    "unknown": 0.6, "gpl": 0.7, "agpl": 0.8, "cc-by-nc": 0.85, "cc-by-nd": 0.9, "reserved": 1.0,
}
LOOSER = 0.75  # what an exception leaves of a licence's value
_STRENGTH = {"or": 1, "and": 2, "with": 3}
_LEAD = re.compile(rb"[ \t]*[:=]?[ \t]*[\"']?")
_TOKEN = re.compile(rb"[ \t]*([a-z0-9][a-z0-9.+_-]*|[()])")
_WORD = np.array([chr(i).isalnum() if i < 128 else True for i in range(256)])


class Automaton:
    """Goto, failure and output tables of phrases (tuples of symbols)."""

    def __init__(self, phrases: list[tuple]):
        self.goto: list[dict] = [{}]
        self.out: list[list[int]] = [[]]
        for i, phrase in enumerate(phrases):
            state = 0
            for symbol in phrase:
                if symbol not in self.goto[state]:
                    self.goto[state][symbol] = len(self.goto)
                    self.goto.append({})
                    self.out.append([])
                state = self.goto[state][symbol]
            self.out[state].append(i)
        self.fail = [0] * len(self.goto)
        waiting = deque(self.goto[0].values())
        while waiting:
            state = waiting.popleft()
            for symbol, to in self.goto[state].items():
                self.fail[to] = self.step(self.fail[state], symbol)
                self.out[to] += self.out[self.fail[to]]
                waiting.append(to)

    def step(self, state: int, symbol) -> int:
        while state and symbol not in self.goto[state]:
            state = self.fail[state]
        return self.goto[state].get(symbol, 0)


class Phrase(NamedTuple):
    words: tuple
    label: str | None  # None: a tag
    base: bool


def phrases() -> list[Phrase]:
    return ([Phrase(tuple(p.split()), label, True) for p, label in BASE.items()]
            + [Phrase(tuple(p.split()), label, False) for p, label in NOTICES.items()]
            + [Phrase(tuple(p.split()), None, False) for p in TAGS])


class Scanner:
    """The automaton over numbers of vocabulary words, known by their hashes."""

    def __init__(self):
        self.phrases = phrases()
        vocabulary = sorted({w for p in self.phrases for w in p.words})
        hashes = split_words(pa.array(vocabulary, pa.large_string()), _WORD.__getitem__).hash
        self.keys = np.sort(hashes)
        number = {w: int(np.searchsorted(self.keys, h)) for w, h in zip(vocabulary, hashes)}
        self.automaton = Automaton([tuple(number[w] for w in p.words) for p in self.phrases])
        self.alone = np.unique([number[p.words[0]] for p in self.phrases if len(p.words) == 1])

    def matches(self, words: Words) -> Iterator[tuple[int, int]]:
        """(word after the match, phrase) of all places, by end."""
        row = row_of(words.first)
        spot = np.minimum(np.searchsorted(self.keys, words.hash), len(self.keys) - 1)
        known = self.keys[spot] == words.hash
        beside = known[1:] & known[:-1] & (row[1:] == row[:-1])
        worth = known & np.isin(spot, self.alone)
        worth[1:] |= beside
        worth[:-1] |= beside
        at = np.flatnonzero(worth)
        joined = np.append(False, (np.diff(at) == 1) & (row[at[1:]] == row[at[:-1]])) if len(at) else at
        step, out, state = self.automaton.step, self.automaton.out, 0
        for place, symbol, goes_on in zip(at.tolist(), spot[at].tolist(), joined.tolist()):
            state = step(state if goes_on else 0, symbol)
            for i in out[state]:
                yield place + 1, i


def family(identifier: str) -> str:
    """The family whose name begins the identifier, the longest one."""
    parts = re.split(r"[-+]", identifier)
    for n in range(len(parts), 0, -1):
        name = "-".join(parts[:n])
        for told in (name, name.rstrip("0123456789.")):
            if told in FAMILIES:
                return told
    return "unknown"


def tokens(data: bytes, start: int, end: int) -> Iterator[str]:
    """Identifiers, operators and parentheses from `start` on, while there are any in the line."""
    at = _LEAD.match(data, start, end).end()
    while found := _TOKEN.match(data, at, end):
        yield found[1].decode()
        at = found.end()


def evaluate(found: Iterator[str]) -> tuple[float, list[str]] | None:
    """(value, labels) of the longest well-formed beginning, by shunting-yard; None if it has no operand."""
    values: list[float] = []
    operators: list[str] = []
    labels: list[str] = []
    wanted = True  # an operand comes next

    def apply() -> None:
        right, name = values.pop(), operators.pop()
        left = values.pop()
        values.append(min(left, right) if name == "or" else max(left, right) if name == "and" else left * LOOSER)

    for token in found:
        if wanted and token == "(" and (not operators or operators[-1] != "with"):
            operators.append(token)
        elif wanted and token not in "()" and token not in _STRENGTH:
            if not operators or operators[-1] != "with":
                labels.append(family(token))
            values.append(FAMILIES[labels[-1]])
            wanted = False
        elif not wanted and token in _STRENGTH:
            while operators and operators[-1] != "(" and _STRENGTH[operators[-1]] >= _STRENGTH[token]:
                apply()
            operators.append(token)
            wanted = True
        elif not wanted and token == ")" and "(" in operators:
            while operators[-1] != "(":
                apply()
            operators.pop()
        else:
            break
    while wanted and operators:  # what has no operand after it
        wanted = operators.pop() == "("
    while operators:
        if operators[-1] == "(":
            operators.pop()
        else:
            apply()
    return (values[0], sorted(set(labels))) if values else None


class Find(NamedTuple):
    """A label at the words `start` to `end` (exclusive) of a row, and how much it restricts."""

    row: int
    start: int
    end: int
    label: str
    base: bool
    value: float


def scan(texts: pa.Array, scanner: Scanner) -> tuple[list[Find], np.ndarray]:
    """All finds of lowered texts, row by row, and the number of words of each text."""
    words = split_words(texts, _WORD.__getitem__)
    data, row, finds = None, row_of(words.first), []
    reached = (-1, 0)  # row and end of the longest notice that began before
    hits = [(int(row[end - 1]), end - len(scanner.phrases[i].words), end, i) for end, i in scanner.matches(words)]
    for r, start, end, i in sorted(hits, key=lambda h: (h[1], -h[2], h[3])):
        phrase, shift = scanner.phrases[i], int(words.first[r])
        place = start - shift, end - shift
        if phrase.label is None:
            if data is None:
                data, offsets = words.data.tobytes(), text_buffers(texts)[1]
            after, last = int(words.end[end - 1]), int(offsets[r + 1])
            line = data.find(b"\n", after, last)
            told = evaluate(tokens(data, after, last if line < 0 else line))
            finds += [Find(r, *place, label, False, told[0]) for label in (told[1] if told else ())]
            continue
        inside = reached[0] == r and end <= reached[1]
        finds.append(Find(r, *place, phrase.label, phrase.base, 0.0 if inside else FAMILIES[phrase.label]))
        if not inside:
            reached = r, end
    return finds, np.diff(words.first)


def find_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, finds) of each row; `finds` in text order: label, base, start, end, value."""
    struct = "struct<start: long, end: long, label: string, base: boolean, value: double>"

    def batches(found):
        scanner = Scanner()
        for batch in found:
            for part in slices(batch, "text"):
                finds, n_words = scan(ascii_lower(part.column("text")), scanner)
                many = np.bincount([f.row for f in finds], minlength=part.num_rows) if finds else np.zeros(
                    part.num_rows, np.int64)
                columns = zip(*(f[1:] for f in finds)) if finds else [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.float64()]
                fields = [pa.array(list(c), kind) for c, kind in zip(columns, kinds)]
                rows = pa.StructArray.from_arrays(fields, ["start", "end", "label", "base", "value"])
                offsets = pa.array(np.append(0, np.cumsum(many)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n_words.astype(np.int64)), pa.ListArray.from_arrays(offsets, rows)],
                    ["doc_id", "n_words", "finds"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(batches, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, finds array<{struct}>")


def license_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of each row."""
    base = F.filter("finds", lambda f: f["base"])
    starts = F.transform(base, lambda f: f["start"])

    def joined(finds):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(finds, lambda f: f["label"]))), ",")

    return find_licenses(docs).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("finds")).alias("labels"),
        F.coalesce(F.array_max(F.transform("finds", lambda f: f["value"])), F.lit(0.0)).alias("score"))
