"""License scan: Aho-Corasick over the words of a text finds identifier tags
and notice phrases in one pass; a shunting-yard parser evaluates the
identifier tags' and/or/with expressions.

Every label has a permissiveness.  In an expression ``or`` is the more
permissive side, ``and`` the less permissive one, and ``with`` lifts a licence
half way to the next level, since exceptions grant more.  A document's score
is the least over all its notices and expressions, 1 without any.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

#: Phrase words and label, fixed by the contract.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Further notice phrases of this scan, as words of the text.
NOTICES = {
    "apache license": "apache", "mit license": "mit", "bsd license": "bsd",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl", "eclipse public license": "epl",
    "lesser general public license": "lgpl", "affero general public license": "agpl",
    "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc0": "cc0",
    "creative commons attribution": "cc-by", "creative commons zero": "cc0",
    "public domain": "public-domain", "unlicense": "unlicense", "proprietary and confidential": "proprietary",
}
TAG = "spdx license identifier"
#: Permissiveness of a label; other identifiers have UNKNOWN.
LEVELS = {
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "mit": 0.9, "bsd": 0.9, "apache": 0.9, "isc": 0.9, "zlib": 0.9,
    "cc-by": 0.8, "mpl": 0.6, "epl": 0.6, "lgpl": 0.5, "cc-by-sa": 0.5, "gpl": 0.3, "agpl": 0.2,
    "cc-by-nd": 0.2, "cc-by-nc": 0.2, "proprietary": 0.0, "reserved": 0.0,
}
UNKNOWN = 0.4

#: A-Z to lower case; every other ASCII character that is no digit or letter to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_TAG = re.compile(r"(?i)spdx[^0-9A-Za-z\x80-\U0010ffff]+license[^0-9A-Za-z\x80-\U0010ffff]+identifier[\x20\t]*:?[\x20\t]*")
_LINE_END = re.compile(r"[\r\n]|\Z")
_PIECE = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_RANK = {"or": 1, "and": 2, "with": 3}


def family(identifier: str) -> str:
    """The label that an identifier such as GPL-2.0-or-later belongs to."""
    name = identifier.lower()
    return max((k for k in LEVELS if name == k or name.startswith(k + "-")), key=len, default=name)


def evaluate(expression: str) -> tuple[list[str], float | None]:
    """Labels and permissiveness of a licence expression.

    Operators bind as with, and, or; equal ones from the left.  The expression
    ends at the first piece that doesn't fit, as tags often stand in running
    text.  No licence at all: no labels and None.
    """
    values: list[float] = []
    operators: list[str] = []
    labels: list[str] = []

    def apply() -> None:
        op, right = operators.pop(), values.pop()
        left = values.pop()
        values.append(max(left, right) if op == "or" else min(left, right) if op == "and" else left + (1 - left) / 2)

    operand_next = True
    for m in _PIECE.finditer(expression):
        piece = m[0].lower()
        if operand_next:
            if piece == "(":
                operators.append(piece)
                continue
            if piece == ")" or piece in _RANK:
                break
            is_exception = bool(operators) and operators[-1] == "with"
            label = family(piece)
            values.append(1.0 if is_exception else LEVELS.get(label, UNKNOWN))
            if not is_exception:
                labels.append(label)
            operand_next = False
        elif piece == ")":
            while operators and operators[-1] != "(":
                apply()
            if not operators:
                break
            operators.pop()
        elif piece in _RANK:
            while operators and operators[-1] != "(" and _RANK[operators[-1]] >= _RANK[piece]:
                apply()
            operators.append(piece)
            operand_next = True
        else:
            break
    if operand_next and operators and operators[-1] in _RANK:
        operators.pop()  # an operator without a right side
    while operators:
        if operators[-1] == "(":
            operators.pop()
        elif len(values) < 2:
            operators.pop()
        else:
            apply()
    return labels, values[-1] if values else None


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in {**NOTICES, **BASE}.items():
        found.add_word(f" {phrase} ", (phrase.count(" ") + 1, label, phrase in BASE))
    found.add_word(f" {TAG} ", (TAG.count(" ") + 1, None, False))
    found.make_automaton()
    return found


def scan(text: bytes, automaton: ahocorasick.Automaton) -> dict:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of a text in UTF-8."""
    words = text.translate(_FOLD).split()
    line = " " + b" ".join(words).decode("utf-8", "replace") + " "
    starts, base, labels, score, tagged = [], set(), set(), 1.0, False
    at = word = 0
    for end, (n, label, is_base) in automaton.iter(line):
        # spaces up to the match's last character: one before each word so far, and this one
        word += line.count(" ", at, end + 1)
        at = end + 1
        if label is None:
            tagged = True
            continue
        if is_base:
            starts.append(word - 1 - n)
            base.add(label)
        labels.add(label)
        score = min(score, LEVELS[label])
    if tagged:
        plain = text.decode("utf-8", "replace")
        tags = list(_TAG.finditer(plain))
        for m, following in zip(tags, [*[x.start() for x in tags[1:]], len(plain)], strict=True):
            # an expression ends with its line, or where the next tag begins
            own, value = evaluate(plain[m.end():_LINE_END.search(plain, m.end(), following).start()])
            labels.update(own)
            score = score if value is None else min(score, value)
    return {"n_words": len(words), "n_base": len(starts), "first_word": min(starts, default=None),
            "last_word": max(starts, default=None), "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(labels)), "score": score}


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
          "base_labels string, labels string, score double")
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row.  Null texts count as empty: no words, no labels
    (empty strings), null positions, score 1.  Overlapping phrases each
    count.  Ids pass through, null or repeated; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for batch in batches:
            rows = [{"doc_id": i} | scan(t or b"", automaton)
                    for i, t in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return docs.selectExpr(f"CAST(`{id_col}` AS long) AS id", f"CAST(`{text_col}` AS binary) AS text").mapInArrow(run, SCHEMA)
