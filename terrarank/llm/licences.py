"""Licence scans: Aho-Corasick for tags and notice phrases, shunting-yard for licence expressions.

A text is reduced to its words (ASCII lower-cased; runs of digits, letters
and anything beyond ASCII). One automaton over all phrases finds every place
where a phrase's words stand consecutively. Where it meets an identifier tag,
the expression behind the tag is read from the original text and evaluated:
``and`` takes the stricter side, ``or`` the freer, ``with`` eases a licence by
an exception. The score of a document is the openness of everything it
states, taken together (0 all rights reserved, 1 unrestricted); 0.5 where it
states nothing.

The expression is the longest run of tokens from the tag on that is complete:
it ends before the first token that can't follow (a comment closer, the words
behind it) and with a name's final full stop.

Cases: a null or empty text has no words, no labels and null places; an
expression with no complete start gives the label ``unparsed`` and the openness
of an unknown licence; very long texts are scanned whole; repeated rows are
scanned alike; an empty table gives no rows; columns other than id and text
are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from terrarank.llm.common import byte_batches, texts_of

# Fixed values of the task: phrases that count as base, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Further notice phrases and their labels.
NOTICES = {
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "creative commons": "creative-commons",
    "public domain": "public-domain",
    "proprietary and confidential": "proprietary",
    "copyright": "copyright",
}

#: Words of the identifier tag; the expression follows it in the original text.
TAG = "spdx license identifier"
TAG_EXPRESSION = re.compile(r"spdx-license-identifier:[ \t]*([A-Za-z0-9.+() \t-]*)", re.IGNORECASE)

#: Openness by the start of a label; the longest matching start counts.
OPENNESS = {
    "cc0": 1.0, "public-domain": 1.0, "unlicense": 1.0, "mit": 0.95, "bsd": 0.95, "isc": 0.95, "apache": 0.9,
    "cc-by": 0.85, "mpl": 0.7, "lgpl": 0.6, "cc-by-sa": 0.6, "gpl": 0.4, "agpl": 0.3, "cc-by-nc": 0.25,
    "cc-by-nd": 0.25, "creative-commons": 0.5, "copyright": 0.3, "proprietary": 0.0, "reserved": 0.0,
}
UNKNOWN = 0.5
EASED = 0.2  # share of the way to 1 that an exception eases a licence

_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_WORD_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEEP else 0x20 for c in range(256))


def openness(label: str) -> float:
    starts = [s for s in OPENNESS if label.startswith(s)]
    return OPENNESS[max(starts, key=len)] if starts else UNKNOWN


PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def parse(expression: str) -> list[str]:
    """Postfix order of a licence expression (shunting-yard); ValueError if it is malformed."""
    out: list[str] = []
    held: list[str] = []
    operand_next = True
    for token in re.findall(r"[()]|[^\s()]+", expression.lower()):
        if token == "(":
            if not operand_next:
                raise ValueError("operator expected")
            held.append(token)
        elif token == ")":
            if operand_next:
                raise ValueError("licence expected")
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                raise ValueError("unbalanced )")
            held.pop()
        elif token in PRECEDENCE:
            if operand_next:
                raise ValueError("licence expected")
            while held and held[-1] != "(" and PRECEDENCE[held[-1]] >= PRECEDENCE[token]:
                out.append(held.pop())
            held.append(token)
            operand_next = True
        else:
            if not operand_next:
                raise ValueError("operator expected")
            out.append(token)
            operand_next = False
    if operand_next or "(" in held:
        raise ValueError("incomplete expression")
    return out + held[::-1]


def leading_expression(text: str) -> str:
    """The longest complete licence expression that ``text`` starts with; empty if there is none."""
    taken: list[str] = []
    whole, depth, operand_next, ended = 0, 0, True, False
    for token in re.findall(r"[()]|[^\s()]+", text.lower()):
        if token == "(":
            if not operand_next:
                break
            depth += 1
        elif token == ")":
            if operand_next or not depth:
                break
            depth -= 1
        elif ended:
            break
        elif token in PRECEDENCE:
            if operand_next:
                break
            operand_next = True
        else:
            name = token.rstrip(".-")  # a full stop or a comment closer right behind the name
            if not operand_next or not name.strip("+"):
                break
            operand_next, ended, token = False, name != token, name
        taken.append(token)
        if not operand_next and not depth:
            whole = len(taken)
    return " ".join(taken[:whole])


def evaluate(expression: str) -> tuple[float, set[str]]:
    """(openness, licences named) of an expression."""
    stack: list[tuple[float, set[str]]] = []
    for token in parse(expression):
        if token not in PRECEDENCE:
            stack.append((openness(token), {token}))
            continue
        (b, right), (a, left) = stack.pop(), stack.pop()
        if token == "with":
            stack.append((a + EASED * (1 - a), left))
        else:
            stack.append(((max if token == "or" else min)(a, b), left | right))
    (found,) = stack
    return found


def _automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for phrase in {**BASE, **NOTICES, TAG: None}:
        machine.add_word(f" {phrase} ", phrase)
    machine.make_automaton()
    return machine


def scan(text: str | None, machine: ahocorasick.Automaton) -> dict:
    """Words, places of base phrases, labels and score of one text."""
    words = (text or "").encode().translate(_WORD_TABLE).split()
    line = " " + b" ".join(words).decode("latin-1") + " "
    places, base, labels, scores, tagged = [], set(), set(), [], False
    at = before = 0  # words before a place of the line, counted on from the last match
    for last, phrase in machine.iter(line):
        if phrase in BASE:
            start = last - len(phrase) - 1
            before += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
            at = start
            places.append(before)
            base.add(BASE[phrase])
        elif phrase == TAG:
            tagged = True
        else:
            labels.add(NOTICES[phrase])
    labels |= base
    # a more specific notice stands for the general one it contains
    stated = {x for x in labels if not any(y != x and y.startswith(x + "-") for y in labels)}
    scores = [openness(x) for x in stated]
    if tagged:
        for expression in TAG_EXPRESSION.findall(text):
            try:
                score, named = evaluate(leading_expression(expression))
            except ValueError:
                score, named = UNKNOWN, {"unparsed"}
            scores.append(score)
            labels |= named
    return {"n_words": len(words), "n_base": len(places), "first_word": min(places, default=None),
            "last_word": max(places, default=None), "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(labels)), "score": min(scores, default=UNKNOWN)}


FIELDS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
          ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, words, base places and labels, all labels, openness score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton()
        for batch in byte_batches(batches, text_col, 8 << 20):
            rows = [scan(t, machine) for t in texts_of(batch, text_col)]
            cols = [pa.array([r[name] for r in rows], kind) for name, kind in FIELDS]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=[id_col, *(n for n, _ in FIELDS)])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, "
             "base_labels string, labels string, score double")
