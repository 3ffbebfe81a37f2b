"""Documents packed into as few sequences of bounded length as possible.

Piece lengths are whole numbers up to the capacity, so however many documents there are, the
packing problem is a histogram of at most ``capacity`` counts. The driver solves it there:

1. Martello and Toth's dominance reduction fixes sets that no other choice can beat. With a
   piece s, and t the longest other piece that fits beside it: {s} if nothing fits, {s, t} if
   both fill the sequence exactly, or if at most one more piece fits, or if no two pieces
   that fit are together longer than t. Each is applied to all pieces of these lengths at once
   and repeated until nothing changes.
2. The rest goes, longest first, into the fullest open sequence that has room, again with all
   sequences of one remaining room handled together.

The plan is a table of at most a few entries per length. Spark numbers the pieces of each
length, those of a frequent length in several tasks, and
finds each one's sequence by a join with the plan.

Rules: a null text is empty and gives one piece, its end id. Rows with the same document id
are packed each for itself. Other columns are not used. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_few_parts, stored
from .tokens import encoder

#: Pieces of one length that a task numbers; the number does not follow the session or the size of the table.
PER_TASK = 50_000
#: Bytes of ids that a worker collects before it hands them on; ids may take more than the texts they come from.
BATCH_BYTES = 4 << 20
PIECES = "doc_id long, piece int, start long, length int, ids binary"
PLAN = "length int, first long, last long, per_sequence long, sequence long, place int"


def _piece_batch(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    docs, numbers, starts, ids = zip(*rows) if rows else ((),) * 4
    lengths = [len(x) // 4 for x in ids]
    columns = [pa.array(docs, pa.int64()), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int32()), pa.array(ids, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids"])


def token_pieces(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids (32-bit little-endian). A document longer than
    ``capacity`` is cut every ``capacity`` ids; others are one piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc, own in zip(batch.column(0).to_pylist(), encoder(tokenizer).encode(batch.column(1))):
                own = np.append(own, np.uint32(end_id)).astype("<u4")
                for start in range(0, len(own), capacity):
                    rows.append((doc, start // capacity, start, own[start : start + capacity].tobytes()))
                    held += len(rows[-1][-1])
                    if held >= BATCH_BYTES:
                        yield _piece_batch(rows)
                        rows, held = [], 0
            yield _piece_batch(rows)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECES)


class _Counts:
    """How many pieces there are of each length."""

    def __init__(self, counts: dict[int, int]):
        self.count = {length: n for length, n in counts.items() if n}
        self.lengths = sorted(self.count)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            del self.lengths[bisect_left(self.lengths, length)]

    def longest_within(self, room: int, without: int) -> int | None:
        """The longest piece of at most ``room``, one piece of the length ``without`` aside."""
        k = bisect_left(self.lengths, room + 1) - 1
        while k >= 0 and self.lengths[k] == without and self.count[without] == 1:
            k -= 1
        return self.lengths[k] if k >= 0 else None


def _no_pair_beats(left: _Counts, room: int, s: int, t: int) -> bool:
    """No two other pieces fit into ``room`` and are together longer than ``t``, nor do three fit."""
    own = {length: n - (length == s) for length, n in left.count.items()}
    lengths = [x for x in left.lengths if own[x] and x <= room]
    small = [x for x in lengths[:3] for _ in range(min(3, own[x]))][:3]
    if len(small) < 2 or small[0] + small[1] > room:
        return True
    if len(small) == 3 and sum(small) <= room:
        return False
    low, high, best = 0, len(lengths) - 1, 0
    while low <= high:
        if low == high and own[lengths[low]] < 2:
            break
        both = lengths[low] + lengths[high]
        if both > room:
            high -= 1
        else:
            best, low = max(best, both), low + 1
    return best <= t


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Sets of lengths that an optimal packing may contain, each with its number, and the counts that are left."""
    left, fixed, changed = _Counts(counts), [], True
    while changed:
        changed = False
        for s in sorted(left.lengths, reverse=True):
            while s in left.count:
                room = capacity - s
                t = left.longest_within(room, s)
                if t is None:
                    n, found = left.count[s], (s,)
                elif s + t == capacity or _no_pair_beats(left, room, s, t):
                    n, found = (left.count[s] // 2 if s == t else min(left.count[s], left.count[t])), (s, t)
                    if s + t < capacity and t != s:
                        n = min(n, left.count[t])
                else:
                    break
                for length in found:
                    left.take(length, n)
                fixed.append((found, n))
                changed = True
    return fixed, left.count


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit of the longest pieces first. A set of lengths is written as runs (length, number, ...)."""
    rooms: list[int] = []
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(room: int, runs: tuple[int, ...], n: int) -> None:
        if n:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append((runs, n))

    for s in sorted(counts, reverse=True):
        n = counts[s]
        while n:
            k = bisect_left(rooms, s)
            if k == len(rooms):
                each = capacity // s
                put(capacity - each * s, (s, each), n // each)
                put(capacity - n % each * s, (s, n % each), 1 if n % each else 0)
                break
            room = rooms[k]
            runs, there = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[k]
            each = room // s
            full = min(there, n // each)
            put(room - each * s, (*runs, s, each), full)
            n -= full * each
            there -= full
            if there and n:  # n < each: the last ones share a sequence
                put(room - n * s, (*runs, s, n), 1)
                there, n = there - 1, 0
            put(room, runs, there)
    return [found for room in rooms for found in open_[room]]


def packing_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first, last, per_sequence, sequence, place): the pieces of this length from number
    ``first`` to before ``last`` go, ``per_sequence`` to each, into sequences from ``sequence`` on, at
    ``place`` and after."""
    fixed, left = reduce_by_dominance(counts, capacity)
    sets = [(tuple(x for length in found for x in (length, 1)), n) for found, n in fixed] + best_fit(left, capacity)
    rows, used, sequence = [], dict.fromkeys(counts, 0), 0
    for runs, n in sets:
        place = 0
        for length, each in zip(runs[::2], runs[1::2]):
            rows.append((length, used[length], used[length] + n * each, each, sequence, place))
            used[length] += n * each
            place += length * each
        sequence += n
    return rows


def pack_pieces(pieces: DataFrame, capacity: int, per_task: int = PER_TASK) -> DataFrame:
    """``pieces`` (doc_id, piece, length and more) with sequence_id and offset. They are read
    three times, so they should be a stored table."""
    spark = pieces.sparkSession
    counts = {row.length: row.n for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    plan = spark.createDataFrame(packing_plan(counts, capacity), PLAN)
    # lengths that many pieces have are dealt out; there are at most ``capacity`` of them
    many = [(length, -(-n // per_task)) for length, n in sorted(counts.items()) if n > per_task]
    salts = F.lit(1)
    if many:
        salts = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in many for x in pair)), F.col("length").cast("int")), F.lit(1))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), salts).cast("int"))
    # a row for each length, and one more for each ``per_task`` pieces
    sizes = stored(salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")), "piece-counts", len(counts) + sum(n for _, n in many))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start")
    numbered = salted.withColumn("_own", F.row_number().over(own) - 1).join(bases, ["length", "_salt"])
    number = F.col("_base") + F.col("_own")
    numbered = numbered.select(*pieces.columns, number.alias("_number"))
    # the plan has at most a few rows per length, whatever the number of documents
    plan = F.broadcast(plan.withColumnRenamed("length", "_length"))
    at = (F.col("length") == F.col("_length")) & (F.col("_number") >= F.col("first")) & (F.col("_number") < F.col("last"))
    within = F.col("_number") - F.col("first")
    packed = numbered.join(plan, at).select(
        *pieces.columns,
        (F.col("sequence") + F.floor(within / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("place") + within % F.col("per_sequence") * F.col("length")).cast("long").alias("offset"),
    )
    return in_few_parts(packed, sum(counts.values()))


def pack_documents(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset. Each text is encoded once; the
    ids themselves are in the table of pieces that :func:`token_pieces` gives."""
    pieces = token_pieces(docs, tokenizer, capacity=capacity, end_id=end_id, id_col=id_col, text_col=text_col)
    pieces = pieces.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"))
    return pack_pieces(stored(pieces, "pieces"), capacity)
