"""Licence scans: one pass of an Aho-Corasick automaton, and licence expressions.

The automaton finds notice phrases, word by word, and identifier tags.  What follows a tag is
a licence expression: a shunting-yard parser turns it into postfix order (``with`` binds
tightest, then ``and``, then ``or``) and evaluates it.  A licence is worth its openness; ``or``
gives the best of both, since the reader may choose, ``and`` the worst, since both hold, and
an exception after ``with`` lifts a licence halfway to the most open one.  A document is worth
its least open statement.

Defined results: a null or empty text has no words, no labels and score 0; an expression
that cannot be parsed as a whole counts up to where it can; a tag without a licence counts for
nothing; equal statements count once in the labels and each time in the base counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docspark.llm import words as wd

# The base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notice phrases and their labels.
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license": "apache-2",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "boost software license": "bsl",
    "isc license": "isc",
    "the unlicense": "unlicense",
    "creative commons attribution": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noderivatives": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by": "cc-by",
    "cc0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
# Notices that are the beginning of longer ones, which count alone where they stand.
LONGER = {
    short: tuple(f" {long} " for long in {**BASE, **NOTICES} if long.startswith(f"{short} "))
    for short in ("cc by", "creative commons attribution", "gnu general public license")
}
TAG = "spdx license identifier"
# Labels of identifiers that name the same licence as a phrase.
IDENTIFIERS = {
    "mit": "mit",
    "apache-2.0": "apache-2",
    "cc-by-nc-4.0": "cc-by-nc",
    "gpl-2.0": "gpl-2",
    "gpl-2.0-only": "gpl-2",
    "gpl-2.0-or-later": "gpl-2",
    "gpl-3.0": "gpl-3",
    "gpl-3.0-only": "gpl-3",
    "gpl-3.0-or-later": "gpl-3",
    "cc0-1.0": "cc0",
    "isc": "isc",
    "bsl-1.0": "bsl",
    "unlicense": "unlicense",
}
# How open a licence is, by the beginning of its label; the longest beginning counts.
OPENNESS = {
    "": 0.5,
    "mit": 1.0,
    "apache": 1.0,
    "bsd": 1.0,
    "bsl": 1.0,
    "isc": 1.0,
    "unlicense": 1.0,
    "cc0": 1.0,
    "public-domain": 1.0,
    "cc-by": 0.9,
    "cc-by-sa": 0.6,
    "cc-by-nd": 0.2,
    "cc-by-nc": 0.1,
    "mpl": 0.7,
    "epl": 0.7,
    "lgpl": 0.6,
    "gpl": 0.3,
    "agpl": 0.2,
    "all-rights-reserved": 0.0,
}
BINDS = {"or": 1, "and": 2, "with": 3}

_WORD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_TAGGED = re.compile(rb"spdx[^0-9a-z\x80-\xff]+license[^0-9a-z\x80-\xff]+identifier[ \t]*:?[ \t]*")
_LINE_END = re.compile(rb"[\r\n]")
_TOKEN = re.compile(r"\s*([()]|[a-z0-9][a-z0-9.+-]*)")


def openness(label: str) -> float:
    return OPENNESS[max((start for start in OPENNESS if label.startswith(start)), key=len)]


def postfix(expression: str) -> list[str]:
    """The longest valid beginning of a lower-case licence expression, in postfix order."""
    best: list[str] = []
    done: list[str] = []
    waiting: list[str] = []
    wants_licence = True
    at = 0
    while found := _TOKEN.match(expression, at):
        token = found[1]
        at = found.end()
        if wants_licence:
            if token == "(":
                waiting.append(token)
                continue
            if token == ")" or token in BINDS:
                break
            done.append(token)
            wants_licence = False
        elif token in BINDS:
            while waiting and waiting[-1] != "(" and BINDS[waiting[-1]] >= BINDS[token]:
                done.append(waiting.pop())
            waiting.append(token)
            wants_licence = True
        elif token == ")" and "(" in waiting:
            while waiting[-1] != "(":
                done.append(waiting.pop())
            waiting.pop()
        else:
            break
        if not wants_licence:
            best = done + [x for x in reversed(waiting) if x != "("]
    return best


def evaluate(steps: list[str]) -> tuple[set[str], float]:
    """Labels and openness of an expression in postfix order."""
    stack: list[tuple[set[str], float]] = []
    for step in steps:
        if step not in BINDS:
            label = IDENTIFIERS.get(step, step)
            stack.append(({label}, openness(label)))
            continue
        right, left = stack.pop(), stack.pop()
        if step == "with":  # the right side names an exception
            stack.append((left[0], (left[1] + 1) / 2))
        else:
            stack.append((left[0] | right[0], (max if step == "or" else min)(left[1], right[1])))
    return stack.pop()


def automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES, TAG}:
        made.add_word(f" {phrase} ", phrase)
    made.make_automaton()
    return made


def tagged_expressions(text: bytes) -> Iterator[bytes]:
    """What follows each tag of a lower-case text, up to the next tag or the end of the line."""
    tags = list(_TAGGED.finditer(text))
    for tag, after in zip(tags, [*tags[1:], None]):
        line = _LINE_END.search(text, tag.end())
        ends = [line.start() if line else len(text), after.start() if after else len(text)]
        yield text[tag.end() : min(ends)]


def scan_text(text: bytes, phrases: ahocorasick.Automaton) -> tuple:
    """Counts, places, labels and score of one text."""
    words = text.translate(_WORD).split()
    spaced = " " + b" ".join(words).decode("latin-1") + " "
    n_base, first, last = 0, None, None
    base: set[str] = set()
    more: set[str] = set()
    worth: list[float] = []
    tagged, counted, at = False, -1, 0
    for end, phrase in phrases.iter(spaced):
        label = BASE.get(phrase)
        if label:
            begin = end - len(phrase) - 1
            counted += spaced.count(" ", at, begin + 1)
            at = begin + 1
            n_base += 1
            first = counted if first is None else min(first, counted)
            last = counted if last is None else max(last, counted)
            base.add(label)
        elif phrase == TAG:
            tagged = True
            continue
        if phrase not in LONGER or not spaced.startswith(LONGER[phrase], end - len(phrase) - 1):
            more.add(label or NOTICES[phrase])
    worth += map(openness, more)
    if tagged:
        for rest in tagged_expressions(text.lower()):
            steps = postfix(rest.decode("utf-8", "replace"))
            if steps:
                labels, value = evaluate(steps)
                more |= labels
                worth.append(value)
    return (
        len(words),
        n_base,
        first,
        last,
        ",".join(sorted(base)),
        ",".join(sorted(base | more)),
        min(worth, default=0.0),
    )


def scan(docs: DataFrame) -> DataFrame:
    """Labels and base counts of every document (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = automaton()
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        for batch in batches:
            texts = wd.texts_of(batch.column("text"))
            rows = [scan_text(text.as_py(), phrases) for text in texts]
            columns = list(zip(*rows)) or [[]] * 7
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *names])

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double"
    )
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
