"""Test items in documents, found by edit distance.

A test item of m characters may differ from a passage by up to k of them. Cut the item into k + 1
pieces: at least one is in the passage unchanged. So an Aho-Corasick automaton finds the pieces in a
document, and around each hit Myers' bit-parallel algorithm computes the least distance
of the whole item to any substring. Nothing within the budget is missed.

Items are a stated query set: they go to the tasks in blocks of bounded size, and each block is compared with
all documents, so a test set of any size needs bounded memory. Documents are scanned where they are, without a shuffle.

Rules: letters are compared in lower case, a run of white space is one space. The budget is ``rate`` of an
item's length, but never so large that a piece has fewer than ``piece`` characters. Items shorter than ``least``
characters are found exactly, and only as whole words: an edit would make other words of them. Empty and null items are found nowhere. Equal items are
searched once and reported each; an item without id is searched too, and reported with a null id. A null text is empty. Rows are judged each for itself, repeated ones too; columns of other names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

RATE, PIECE, LEAST = 0.05, 20, 32
#: Characters of test items that are searched in one pass over the documents.
BLOCK_CHARS = 4_000_000
#: Rows that a worker hands on at once, with their texts.
SLICE_ROWS = 512
RESULT = "doc_id long, item_id long, distance int, start long, end long"


def normalized(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def least_distance(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the substring of ``text`` nearest to ``pattern``, the first such, if its distance is at most
    ``most``. Myers' algorithm: a bit per row of the table, Python's whole numbers hold any length."""
    m = len(pattern)
    places: dict[str, int] = {}
    for k, c in enumerate(pattern):
        places[c] = places.get(c, 0) | 1 << k
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, (min(m, most + 1), 0)
    for k, c in enumerate(text):
        equal = places.get(c, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        plus = down | ~(horizontal | up) & full
        minus = up & horizontal
        if plus & last:
            score += 1
        elif minus & last:
            score -= 1
        # the first row is 0 everywhere: a match may begin anywhere
        plus = plus << 1 & full
        minus = minus << 1 & full
        up = minus | ~(vertical | plus) & full
        down = plus & vertical
        if score < best[0]:
            best = (score, k + 1)
    return best if best[0] <= most else None


class ItemSearch:
    """Finds items of one block in texts."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float, piece: int, least: int = LEAST):
        import ahocorasick

        self.least = least
        ids: dict[str, list[int | None]] = {}
        for item, text in items:
            ids.setdefault(text, []).append(item)
        self.items = [(text, own, 0 if len(text) < least else max(0, min(int(rate * len(text)), len(text) // piece - 1))) for text, own in ids.items()]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for number, (text, _, budget) in enumerate(self.items):
            borders = [len(text) * k // (budget + 1) for k in range(budget + 2)]
            for a, b in zip(borders, borders[1:]):
                pieces.setdefault(text[a:b], []).append((number, a))
        self.automaton = ahocorasick.Automaton()
        for text, own in pieces.items():
            self.automaton.add_word(text, (len(text), own))
        if pieces:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int | None, int, int, int]]:
        """(item id, distance, start, end) of each item within its budget, at its nearest place."""
        if not self.items:
            return []
        best: dict[int, tuple[int, int, int]] = {}
        tried: set[tuple[int, int]] = set()
        text = normalized(text)
        for end, (length, own) in self.automaton.iter(text):
            for number, offset in own:
                at = end + 1 - length - offset
                if (number, at) in tried or best.get(number, (1,))[0] == 0:
                    continue
                tried.add((number, at))
                item, _, budget = self.items[number]
                if len(item) < self.least:
                    borders = text[max(at - 1, 0) : at] + text[at + len(item) : at + len(item) + 1]
                    if not any(c.isalnum() for c in borders):
                        best[number] = (0, at, at + len(item))
                    continue
                if text.startswith(item, max(at, 0)) and at >= 0:
                    best[number] = (0, at, at + len(item))
                    continue
                begin = max(0, at - budget)
                window = text[begin : at + len(item) + budget]
                found = least_distance(item, window, budget)
                if found and found[0] < best.get(number, (budget + 1,))[0]:
                    distance, stop = found
                    back = least_distance(item[::-1], window[:stop][::-1], distance)
                    best[number] = (distance, begin + stop - (back[1] if back else stop), begin + stop)
        return [(item, *found) for number, found in sorted(best.items()) for item in self.items[number][1]]


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int | None, str]]]:
    """The normalised items in blocks, in the order of their ids; the driver holds one block at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(text_col).alias("text")).orderBy("id", "text").toLocalIterator():
        text = normalized(row.text)
        if not text:
            continue
        block.append((row.id, text))
        size += len(text)
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_items(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", rate: float = RATE, piece: int = PIECE, least: int = LEAST, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, distance, start, end for each document and item within its budget; places count characters of
    the normalised text."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def search(block: list[tuple[int | None, str]]) -> DataFrame:
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searcher = ItemSearch(block, rate, piece, least)
            for batch in batches:
                found = [(doc.as_py(), *hit) for doc, text in zip(*batch.columns) for hit in searcher.find(text.as_py())]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([row[k] for row in found], kind) for k, kind in enumerate(kinds)], ["doc_id", "item_id", "distance", "start", "end"])

        return texts.mapInArrow(rows, RESULT)

    result = docs.sparkSession.createDataFrame([], RESULT)
    for block in item_blocks(benchmark, item_col, item_text_col, block_chars):
        # a block's finds are stored, so that no task holds the automata of several
        result = result.unionByName(stored(search(block), "items-found"))
    return result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", rate: float = RATE, piece: int = PIECE, least: int = LEAST, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` in which no item is found."""
    at = docs.columns.index(text_col)

    def without(block: list[tuple[int | None, str]], rows: DataFrame) -> DataFrame:
        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searcher = ItemSearch(block, rate, piece, least)
            for batch in batches:
                for start in range(0, batch.num_rows, SLICE_ROWS):
                    part = batch.slice(start, SLICE_ROWS)
                    yield part.filter(pa.array([not searcher.find(text.as_py()) for text in part.column(at)], pa.bool_()))

        return rows.mapInArrow(clean, docs.schema)

    blocks = item_blocks(benchmark, item_col, item_text_col, block_chars)
    for k, block in enumerate(blocks):
        # what the block before left is stored, so that no task holds the automata of several
        docs = without(block, stored(docs, "without-items") if k else docs)
    return docs
