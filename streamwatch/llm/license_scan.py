"""Licence notices and identifier tags in texts.

One Aho-Corasick automaton runs over the lower-case words of a text and finds all phrases,
those of licence notices and the words of an identifier tag alike. The expression behind a tag
(``MIT OR (Apache-2.0 WITH LLVM-exception)``) is parsed by a shunting yard with the order
WITH, AND, OR, and evaluated: is the text allowed under the ``allowed`` licences? AND needs
both sides, OR one of them; an exception only adds rights, so WITH is as its licence.

Each task scans its own texts; nothing is shuffled and no state grows.

Rules: a null text is empty. Rows are scanned each for itself, repeated ones too. Overlapping phrases all count.
Expressions that cannot be parsed are listed as such and give no label. Other columns are not used.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Phrase and label. The base ones are fixed values.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICE_PHRASES = {
    "permission is hereby granted free of charge": "mit",
    "licensed under the mit": "mit",
    "licensed under the apache": "apache",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "creative commons": "cc",
    "licensed under cc by": "cc",
    "all rights reserved": "reserved",
}
TAG_WORDS = "spdx license identifier"
TAG = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
ALLOWED = frozenset({"mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "zlib", "unlicense", "cc0-1.0", "0bsd"})

#: Bytes of a word stay (letters in lower case, all of non-ASCII characters); others separate words.
_WORD_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_PARTS = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
_ORDER = {"OR": 1, "AND": 2, "WITH": 3}

RESULT = """doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,
    score double, expressions array<string>, allowed boolean"""


def postfix(expression: str) -> list[str]:
    """The parts of an expression, operators behind their operands. ValueError if it is none."""
    out, waiting, operand_next = [], [], True
    if "".join(_PARTS.findall(expression)) != re.sub(r"\s", "", expression):
        raise ValueError(f"no licence expression: {expression}")
    for part in _PARTS.findall(expression):
        operator = part.upper() if part.upper() in _ORDER else None
        if (part == "(" or (part != ")" and not operator)) != operand_next:
            raise ValueError(f"no licence expression: {expression}")
        if part == "(":
            waiting.append(part)
        elif part == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                raise ValueError(f"no licence expression: {expression}")
            waiting.pop()
        elif operator:
            while waiting and waiting[-1] != "(" and _ORDER[waiting[-1]] >= _ORDER[operator]:
                out.append(waiting.pop())
            waiting.append(operator)
            operand_next = True
        else:
            out.append(part)
            operand_next = False
    if operand_next or "(" in waiting:
        raise ValueError(f"no licence expression: {expression}")
    return out + waiting[::-1]


def evaluate(expression: str, allowed: frozenset[str] = ALLOWED) -> tuple[bool, list[str]]:
    """Whether the expression can be met by allowed licences, and its licences in lower case."""
    stack: list[tuple[bool, list[str]]] = []
    for part in postfix(expression):
        if part not in _ORDER:
            stack.append((part.lower() in allowed, [part.lower()]))
            continue
        (right, right_names), (left, left_names) = stack.pop(), stack.pop()
        if part == "WITH":
            stack.append((left, left_names))
        else:
            stack.append((left and right if part == "AND" else left or right, left_names + right_names))
    return stack[0]


class NoticeScanner:
    def __init__(self, base: dict[str, str], notices: dict[str, str], allowed: frozenset[str]):
        import ahocorasick

        self.base, self.notices, self.allowed = base, notices, allowed
        self.automaton = ahocorasick.Automaton()
        for phrase in {*base, *notices, TAG_WORDS}:
            self.automaton.add_word(f" {phrase} ", phrase)
        self.automaton.make_automaton()

    def scan(self, text: str) -> tuple:
        words = text.encode().translate(_WORD_BYTES).split()
        stream = (b" " + b" ".join(words) + b" ").decode()
        places, base_labels, labels, phrases, tagged = [], set(), set(), set(), False
        at, word = 0, 0
        for end, phrase in self.automaton.iter(stream):
            if phrase == TAG_WORDS:
                tagged = True
                continue
            phrases.add(phrase)
            if phrase in self.base:
                start = end - len(phrase) - 1
                # words before the phrase: hits come by their ends, so count on from the last place
                word += stream.count(" ", at, start) if start >= at else -stream.count(" ", start, at)
                at = start
                places.append(word)
                base_labels.add(self.base[phrase])
            labels.add(self.base.get(phrase) or self.notices[phrase])
        expressions, verdicts = [], []
        for expression in TAG.findall(text) if tagged else ():
            expression = re.sub(r"\s*(\*/|-->|\*\)|\"|')\s*$", "", expression).strip()
            expressions.append(expression)
            try:
                verdict, names = evaluate(expression, self.allowed)
            except ValueError:
                continue
            verdicts.append(verdict)
            labels.update(names)
        # every different notice halves the doubt; a valid tag leaves none
        score = 1.0 if verdicts else 1.0 - 0.5 ** len(phrases)
        return (
            len(words),
            len(places),
            min(places, default=None),
            max(places, default=None),
            ",".join(sorted(base_labels)),
            ",".join(sorted(base_labels | labels)),
            score,
            expressions,
            all(verdicts) if verdicts else None,
        )


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] = BASE_PHRASES, notices: dict[str, str] = NOTICE_PHRASES, allowed: Iterable[str] = ALLOWED) -> DataFrame:
    """doc_id, n_words, n_base (places of base phrases), first_word and last_word (least and largest of them, in
    words from 0), base_labels, labels, score, expressions (behind tags), allowed (null without a valid tag)."""
    allowed = frozenset(allowed)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = NoticeScanner(base, notices, allowed)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string()), pa.bool_()]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions", "allowed"]
        for batch in batches:
            found = [scanner.scan(text.as_py() or "") for text in batch.column(1)]
            columns = [pa.array([row[k] for row in found], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(scan, RESULT)
