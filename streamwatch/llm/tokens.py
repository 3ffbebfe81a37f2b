"""Token ids of whole texts by a tokenizer file, with each distinct unit encoded once.

The public tokenizers cut a text by a pattern before they merge: runs of letters, of
numbers and of other signs, a space going with the run behind it. So a text can be cut
beforehand wherever the pattern is sure to cut, whatever stands around:

* before white space that follows a visible character,
* between an ASCII letter, digit or sign and an ASCII character of another of these kinds,
  unless the first is an apostrophe (``'s`` is one piece),
* before and behind a special token of the file, such as ``<|endoftext|>``, which is one unit: the
  library looks for these first, and gives each its own id.

The units between are few and often repeated; the library encodes each distinct one once
and a dictionary of bounded size keeps the ids. ``tests/llm/test_tokens.py`` compares with
the library's encoding of whole texts.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import as_texts, groups_of, text_bytes

#: Bytes of text that are cut at once, and distinct units kept in memory by a worker.
BLOCK_BYTES = 4 << 20
KEPT_UNITS = 300_000

_SPACE, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _SPACE
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _LETTER
_KIND[0x61:0x7B] = _LETTER


def special_spans(data: np.ndarray, pattern: re.Pattern[bytes] | None, borders: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Begin and end of the special tokens in ``data``, leftmost and without overlap; none reaches over a border."""
    found: list[tuple[int, int]] = []
    if pattern is None:
        return found
    text, at = data.tobytes(), 0
    while match := pattern.search(text, at):
        begin, end = match.span()
        inside = borders is not None and np.searchsorted(borders, begin, side="right") < np.searchsorted(borders, end, side="left")
        if inside:
            at = begin + 1
        else:
            found.append((begin, end))
            at = end
    return found


def unit_starts(data: np.ndarray, borders: np.ndarray | None = None, specials: list[tuple[int, int]] = []) -> np.ndarray:
    """Where units begin in ``data``: at its first byte, at ``borders``, on both sides of ``specials`` but
    not inside them, and wherever the pattern is sure to cut."""
    start = np.zeros(len(data), bool)
    if len(data) == 0:
        return np.zeros(0, np.int64)
    kind = _KIND[data]
    before, here = kind[:-1], kind[1:]
    ascii_before = (before >= _LETTER) & (before <= _SIGN)
    visible = ascii_before.copy()
    # a character of two bytes from U+00C0, or of three with a first byte E4 to ED, is never white space
    visible[1:] |= (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF) & (data[1:-1] >= 0x80)
    visible[2:] |= (data[:-3] >= 0xE4) & (data[:-3] <= 0xED) & (data[2:-1] >= 0x80)
    start[1:] = (here == _SPACE) & visible
    start[1:] |= ascii_before & (here >= _LETTER) & (here <= _SIGN) & (here != before) & (data[:-1] != 0x27)
    start[0] = True
    if borders is not None:
        start[borders[borders < len(data)]] = True
    for begin, end in specials:
        start[begin : end + 1] = False
        start[begin] = True
        start[end : end + 1] = True
    return np.flatnonzero(start)


def _visible_bytes() -> dict[int, str]:
    """Byte-level tokenizers write a byte as a printable character: itself, or the next free
    one from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [byte for byte in range(256) if byte not in plain]
    return {byte: chr(byte) for byte in plain} | {byte: chr(0x100 + k) for k, byte in enumerate(rest)}


class TextEncoder:
    """Ids of texts by the tokenizer file at ``path``, none added. Special tokens that a text spells out get
    their own ids, as the library's default call gives them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        if any(token.normalized or token.lstrip or token.rstrip or token.single_word for token in added):
            raise ValueError("special tokens that depend on the text around them are not supported")
        names = sorted((re.escape(token.content.encode()) for token in added), key=len, reverse=True)
        self.specials = re.compile(b"|".join(names)) if names else None
        self.normalizer, self.model = self.tokenizer.normalizer, self.tokenizer.model
        self.visible = _visible_bytes()
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.ends, self.ids = array("q", [0]), array("I")

    def _unit(self, unit: str) -> list[int]:
        """A word with at most one space before it is one piece of the pattern; all else takes the
        library's whole path."""
        word = unit[1:] if unit[:1] == " " else unit
        if not word.isalpha():
            return self.tokenizer.encode(unit, add_special_tokens=False).ids
        if self.normalizer is not None:
            word = word.lower() if word.isascii() else self.normalizer.normalize_str(word)
            if not word.isalpha():
                return self.tokenizer.encode(unit, add_special_tokens=False).ids
            unit = word
        return [token.id for token in self.model.tokenize(unit.encode().decode("latin-1").translate(self.visible))]

    def _slots_of(self, units: list[str]) -> np.ndarray:
        if len(self.slots) + len(units) > KEPT_UNITS + BLOCK_BYTES // 8:
            self._forget()
        found = list(map(self.slots.get, units))
        new = [unit for unit, slot in zip(units, found) if slot is None]
        for unit in new:
            self.slots[unit] = len(self.slots)
            self.ids.extend(self._unit(unit))
            self.ends.append(len(self.ids))
        if new:
            found = list(map(self.slots.get, units))
        return np.array(found, np.int64)

    def _block(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units from ``starts`` on, and how many each unit has."""
        coded = as_texts(data, np.append(starts, len(data))).dictionary_encode()
        slots = self._slots_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        # views, not copies; they are gone before the arrays grow again
        unit_ends = np.frombuffer(self.ends, np.int64)
        count = np.diff(unit_ends)[slots]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        place = np.repeat(unit_ends[slots] - (ends - count), count) + np.arange(total)
        known = np.frombuffer(self.ids, np.uint32) if len(self.ids) else np.zeros(0, np.uint32)
        return known[place], count

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, as 32-bit unsigned numbers. Null and empty texts have none.
        A text longer than a block is cut into several at the start of units."""
        data, offsets = text_bytes(column)
        for begin, end in groups_of(offsets, BLOCK_BYTES):
            part = data[offsets[begin] : offsets[end]]
            if len(part) > 2 * BLOCK_BYTES:
                yield self._long(part)
                continue
            borders = offsets[begin : end + 1] - offsets[begin]
            starts = unit_starts(part, borders, special_spans(part, self.specials, borders))
            ids, count = self._block(part, starts)
            ends = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(starts, borders)]
            for a, b in zip(ends[:-1], ends[1:]):
                yield ids[a:b]

    def _long(self, data: np.ndarray) -> np.ndarray:
        found, at, starts = [], 0, unit_starts(data, specials=special_spans(data, self.specials))
        while at < len(data):
            # whole units, one at least
            first, last = np.searchsorted(starts, [at, at + BLOCK_BYTES])
            end = len(data) if at + BLOCK_BYTES >= len(data) else int(starts[max(last - 1, first + 1)]) if max(last - 1, first + 1) < len(starts) else len(data)
            found.append(self._block(data[at:end], starts[(starts >= at) & (starts < end)] - at)[0])
            at = end
        return np.concatenate(found)


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One for each file and worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]
