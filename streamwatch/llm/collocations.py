"""Phrase collocations, mined with stripes.

A *stripe* belongs to a prefix, the first word of a phrase: an associative counter of what follows it, up to ``longest - 1`` words on. Its entry
for no further word is the prefix's total. Stripes of one prefix are merged elementwise. One merged structure then gives

* extensions: the entry ``b c`` in the stripe of ``a`` counts the phrase ``a b c``,
* prefix totals: the entry ``b`` counts the phrase ``a b``, the first part of ``a b c``; the entry for nothing counts ``a``,
* subsumption maxima: the largest entry among the extensions of a phrase on either side.

A task counts a block of words at a time, in arrays, and sends its partial stripes in rows, one for each language and bucket; the bucket of a stripe
follows from its prefix. The rows of a bucket are merged one after another as they come, so a task holds the distinct entries of one bucket, not what all tasks
sent for it. With the words of the corpus buckets grow in number, not in size.
Words that hold more than 1/4096 of all may have long stripes. These are split into parts by their entries' hash, in proportion
to the word's share, and the parts go to several buckets. The list of such words has fewer than 4,096 rows; it decides only how work is dealt out, not the
result.

Rules: words are runs of other than space and tab, with A-Z in lower case, in pieces between ``.,;:!?`` and line breaks. Overlapping
occurrences all count; a phrase does not cross a piece. Everything is per language; a null language is ``und``, and so are texts that say
so themselves. Null and empty texts have no words. Repeated rows count as often as they are there. A very long text is counted in
blocks that end between pieces; a piece is never cut. Other columns are not used. An
empty table gives an empty result. Counts are exact up to 10 ** 13, and so are the scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT_SHARE, as_texts, attached, stored, text_bytes

#: Bytes of text that a task counts at once.
BLOCK_BYTES = 3 << 20
#: Entries that a task merges at once.
MERGE_ENTRIES = 1 << 18
#: Buckets that stripes are dealt into: so many, or one for each so many words of a corpus that is larger. A block sends a row for each of them at
#: most, and never more than it has stripes.
LEAST_BUCKETS = 16_384
BUCKET_WORDS = 500_000
#: Shares of a language that are ranked by themselves, step by step.
SHARES = (4096, 64, 1)
UNKNOWN = "und"
SCALE = 1_000_000

_BREAK, _BLANK, _WORD = range(3)
_KIND = np.full(256, _WORD, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _blocks(data: np.ndarray, offsets: np.ndarray, languages: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts, the places of their ends, and their languages, in blocks. A text that is longer than a block is cut behind pieces."""
    begin, ends, owner = 0, [], []

    def block() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return data[begin : begin + ends[-1]], np.array(ends, np.int64), np.array(owner, np.int64)

    for k, language in enumerate(languages):
        end = int(offsets[k + 1])
        if ends and end - begin > BLOCK_BYTES:
            yield block()
            begin, ends, owner = int(offsets[k]), [], []
        while end - begin > BLOCK_BYTES:
            breaks = np.flatnonzero(_KIND[data[begin : begin + BLOCK_BYTES]] == _BREAK)
            if not len(breaks):
                breaks = BLOCK_BYTES + np.flatnonzero(_KIND[data[begin + BLOCK_BYTES : end]] == _BREAK)[:1]
            if not len(breaks):
                break
            ends, owner = [int(breaks[-1]) + 1], [language]
            yield block()
            begin, ends, owner = begin + ends[0], [], []
        ends.append(end - begin)
        owner.append(language)
    if ends:
        yield block()


class _Words:
    """The words of a block: codes into ``vocabulary``, languages, and whether the next word is in the same piece."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, owner: np.ndarray):
        kind = _KIND[data]
        word = kind == _WORD
        starts = word.copy()
        starts[1:] &= ~word[:-1]
        stops = word.copy()
        stops[:-1] &= ~word[1:]
        borders = ends[:-1][(ends[:-1] > 0) & (ends[:-1] < len(data))]
        starts[borders], stops[borders - 1] = word[borders], word[borders - 1]
        first = np.flatnonzero(starts)
        lengths = np.flatnonzero(stops) + 1 - first
        breaks = np.flatnonzero(kind == _BREAK)
        del kind, starts, stops
        coded = as_texts(_LOWER[data[word]], np.concatenate([[0], np.cumsum(lengths)])).dictionary_encode()
        self.vocabulary = coded.dictionary
        self.code = coded.indices.to_numpy().astype(np.int64)
        text = np.searchsorted(ends, first, side="right")
        piece = np.searchsorted(breaks, first)
        self.language = owner[text]
        self.same = np.zeros(len(first), bool)
        self.same[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])


def _stripes(words: _Words, longest: int) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Entries of the stripes of a block: language, code of the prefix, what follows (words, space-joined), count, and a hash of what
    follows that is the same in every block."""
    import xxhash

    size = max(len(words.vocabulary), 1)
    known = np.array([xxhash.xxh32_intdigest(word) for word in words.vocabulary.to_pylist()], np.uint32)
    heads, rank, count = np.unique(words.language * size + words.code, return_inverse=True, return_counts=True)
    owner, tails, counts, hashes = [heads], [pa.array([""] * len(heads), pa.string())], [count], [np.zeros(len(heads), np.uint32)]
    at = np.arange(len(words.code))
    for step in range(1, longest):
        # occurrences that go on for one word more
        further = words.same[at + step - 1]
        at, rank = at[further], rank[further]
        found, rank, count = np.unique(rank * size + words.code[at + step], return_inverse=True, return_counts=True)
        before, last = found // size, found % size
        text = words.vocabulary.take(pa.array(last))
        tails.append(text if step == 1 else pc.binary_join_element_wise(tails[-1].take(pa.array(before)), text, " "))
        owner.append(owner[-1][before])
        counts.append(count)
        hashes.append(hashes[-1][before] * np.uint32(0x9E3779B1) + known[last])
    owners = np.concatenate(owner)
    return owners // size, owners % size, pa.concat_arrays(tails), np.concatenate(counts), np.concatenate(hashes)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return ((mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35)) >> np.uint32(4)


def _parts(hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Part of each entry of a stripe with ``of`` parts; an entry has the same part in every task."""
    return (_mixed(hashes).astype(np.int64) % of).astype(np.uint32)


def _languages(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    coded = pc.fill_null(column, UNKNOWN).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def frequent_words(rows: DataFrame) -> tuple[dict[str, dict[str, int]], DataFrame, int]:
    """Of each language the words that hold more than ``HOT_SHARE`` of all, with the parts of their stripes; then the number of words of
    each language (lang, n), and of all. Of a block the words above half that share of its own are told, so fewer than 8,192."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, names = _languages(batch.column(0))
            data, offsets = text_bytes(batch.column(1))
            for block in _blocks(data, offsets, codes):
                words = _Words(*block)
                size = max(len(words.vocabulary), 1)
                group, count = np.unique(words.language * size + words.code, return_counts=True)
                often = count > len(words.code) * HOT_SHARE / 2
                group, count = group[often], count[often]
                totals = np.bincount(words.language, minlength=len(names))
                langs = [names[k] for k in group // size] + names
                known = words.vocabulary.take(pa.array(group % size)).to_pylist() + [""] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(known, pa.string()), pa.array(np.concatenate([count, totals]), pa.int64())], ["lang", "word", "n"])

    counted = stored(rows.mapInArrow(tell, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "frequent-words")
    total = counted.filter("word = ''").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often: dict[str, dict[str, int]] = {}
    # fewer rows than the inverse of the share
    for row in counted.filter((F.col("word") != "") & (F.col("n") > total * HOT_SHARE)).collect():
        often.setdefault(row.lang, {})[row.word] = int(2 + row.n / (total * HOT_SHARE))
    return often, counted.filter("word = ''").select("lang", "n"), total


def _partial(rows: DataFrame, longest: int, often: dict[str, dict[str, int]], buckets: int) -> DataFrame:
    """lang, bucket, and the stripes of a block that belong there: prefixes, the number of entries of each, the entries and their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            codes, names = _languages(batch.column(0))
            data, offsets = text_bytes(batch.column(1))
            of_lang = np.array([xxhash.xxh32_intdigest(name) for name in names], np.uint32)
            for block in _blocks(data, offsets, codes):
                words = _Words(*block)
                if not len(words.code):
                    continue
                lang, prefix, tails, counts, hashes = _stripes(words, longest)
                known = words.vocabulary.to_pylist()
                place = {word: k for k, word in enumerate(known)} if often else {}
                parts_of = np.ones((len(names), len(known)), np.int32)
                for k, name in enumerate(names):
                    for word, n in often.get(name, {}).items():
                        if word in place:
                            parts_of[k, place[word]] = n
                own = np.array([xxhash.xxh32_intdigest(word) for word in known], np.uint32)
                piece = _parts(hashes, parts_of[lang, prefix])
                bucket = _mixed((of_lang[lang] * np.uint32(31) + own[prefix]) * np.uint32(0x9E3779B1) + piece).astype(np.int64) % buckets
                order = np.lexsort((prefix, bucket, lang))
                lang, bucket, prefix = lang[order], bucket[order], prefix[order]
                row = np.concatenate([[True], (lang[1:] != lang[:-1]) | (bucket[1:] != bucket[:-1])])
                stripes = np.flatnonzero(row | np.concatenate([[True], prefix[1:] != prefix[:-1]]))
                first = np.flatnonzero(row)
                by_stripe = pa.array(np.append(np.searchsorted(stripes, first), len(stripes)), pa.int32())
                by_entry = pa.array(np.append(first, len(order)), pa.int32())
                columns = [
                    pa.array(names, pa.string()).take(pa.array(lang[first])),
                    pa.array(bucket[first], pa.int32()),
                    pc.binary_join(pa.ListArray.from_arrays(by_stripe, words.vocabulary.take(pa.array(prefix[stripes]))), "\n"),
                    pa.ListArray.from_arrays(by_stripe, pa.array(np.diff(np.append(stripes, len(order))), pa.int32())),
                    pc.binary_join(pa.ListArray.from_arrays(by_entry, tails.take(pa.array(order))), "\n"),
                    pa.ListArray.from_arrays(by_entry, pa.array(counts[order], pa.int32())),
                ]
                del tails, order
                found = pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "prefixes", "sizes", "tails", "counts"])
                for at in range(0, found.num_rows, 1000):
                    yield found.slice(at, 1000)
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(count, "lang string, bucket int, prefixes string, sizes array<int>, tails string, counts array<int>")


def _entries(batch: pa.RecordBatch) -> pa.Table:
    """lang, bucket, prefix, tail and n of all entries of the stripes in ``batch``."""
    sizes, counts = batch.column(3), batch.column(5)
    prefixes = pc.list_flatten(pc.split_pattern(batch.column(2), "\n"))
    each = pa.array(np.repeat(np.arange(len(prefixes)), pc.list_flatten(sizes).to_numpy()))
    of = pc.list_parent_indices(counts)
    tails = pc.list_flatten(pc.split_pattern(batch.column(4), "\n"))
    columns = [batch.column(0).take(of), batch.column(1).take(of), prefixes.take(each), tails, pc.list_flatten(counts).cast(pa.int64())]
    return pa.table(columns, names=["lang", "bucket", "prefix", "tail", "n"])


def _buckets(rows: pa.Table) -> np.ndarray:
    """Number of the bucket of each row; those of one bucket follow each other."""
    change = np.ones(rows.num_rows, bool)
    if rows.num_rows > 1:
        same = [pc.equal(rows.column(name).slice(1), rows.column(name).slice(0, rows.num_rows - 1)).to_numpy() for name in ("lang", "bucket")]
        change[1:] = ~(same[0] & same[1])
    return np.cumsum(change) - 1


def _merged(rows: pa.Table) -> pa.Table:
    """Entries of one bucket, prefix and tail added up; buckets keep their order."""
    rows = rows.combine_chunks()
    key = _buckets(rows)
    for name in ("prefix", "tail"):
        coded = rows.column(name).chunk(0).dictionary_encode()
        key = key * len(coded.dictionary) + coded.indices.to_numpy()
    _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    n = np.zeros(len(first), np.int64)
    np.add.at(n, inverse, rows.column("n").to_numpy())
    return rows.take(pa.array(first)).set_column(rows.schema.get_field_index("n"), "n", pa.array(n))


def merged_stripes(partial: DataFrame, least: int) -> DataFrame:
    """lang, prefix, tail, n: entries of the merged stripes that count ``least`` or more."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        size = 0

        def told(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            rows = rows.filter(pc.greater_equal(rows.column("n"), least)).select(["lang", "prefix", "tail", "n"])
            yield from rows.to_batches()

        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                waiting.append(_entries(batch.slice(at, 100)))
                size += waiting[-1].num_rows
                if size >= MERGE_ENTRIES:
                    rows = _merged(pa.concat_tables(waiting))
                    # more of the last bucket may come
                    number = _buckets(rows)
                    last = int(np.searchsorted(number, number[-1]))
                    yield from told(rows.slice(0, last))
                    # entries that are already merged do not count towards the next merge
                    waiting, size = [rows.slice(last)], 0
        if waiting:
            yield from told(_merged(pa.concat_tables(waiting)))
        pa.default_memory_pool().release_unused()

    dealt = partial.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket")
    return dealt.mapInArrow(merge, "lang string, prefix string, tail string, n long")


def _phrase(words: Column, first: Column | int, last: Column | int) -> Column:
    """Words ``first`` to ``last`` of a phrase, counted from 1."""
    size = (F.lit(last) if isinstance(last, int) else last) - (F.lit(first) if isinstance(first, int) else first) + 1
    return F.array_join(F.slice(words, first, size), " ")


def mine_phrases(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", longest: int = 3, least: int = 10, percent: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: phrases of 2 to ``longest`` words that occur ``least`` times or more, by their weakest cut into
    two parts that occur ``l`` and ``r`` times, ``a * a / (l * r)`` in millionths. A phrase inside a longer one with at least ``percent`` of
    its occurrences is left out. The ``top`` of each language."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    often, sizes, total = frequent_words(rows)
    found = merged_stripes(_partial(rows, longest, often, max(LEAST_BUCKETS, total // BUCKET_WORDS)), least)
    phrase = F.when(F.col("tail") == "", F.col("prefix")).otherwise(F.concat_ws(" ", "prefix", "tail"))
    found = stored(found.select("lang", phrase.alias("phrase"), F.col("n").alias("f")), "phrases")

    words = F.split("phrase", " ", -1)
    candidates = found.withColumn("words", words).filter(F.size("words") > 1)
    # subsumption maxima: what the longer phrases say of those inside them; a longer one is added up before it is sent
    size = F.size("words")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda k: _phrase(F.col("words"), k, k + m - 1))))
    longer = candidates.filter(size > 2).select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "f")
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    left = candidates.join(longer, ["lang", "phrase"], "left").filter(F.col("most").isNull() | (100 * F.col("most") < percent * F.col("f"))).drop("most")

    cuts = left.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _phrase(F.col("words"), 1, F.col("k")).alias("head"), _phrase(F.col("words"), F.col("k") + 1, F.size("words")).alias("rest"))
    # a part that holds more than this share of all words is hot; of each length there are fewer than its inverse
    hot = F.col("f") > int(total * HOT_SHARE)
    for side, name in (("head", "l"), ("rest", "r")):
        known = found.select("lang", F.col("phrase").alias(side), "f").withColumn(name, F.col("f"))
        cuts = attached(cuts, known, ["lang", side], hot, ["phrase"]).drop("f")
    count = "CAST({} AS DECIMAL(13,0))".format
    score = F.expr(f"CAST({SCALE} AS DECIMAL(7,0)) * {count('a')} * {count('a')} div ({count('l')} * {count('r')})")
    weakest = F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(weakest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each share of a language first, in fixed numbers of shares, so that no task orders more than the best of 64 others
    for shares in SHARES:
        share = F.pmod(F.xxhash64("phrase"), F.lit(shares))
        rank = F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)).cast("long")
        scored = scored.withColumn("share", share).withColumn("rank", rank).filter(F.col("rank") <= top)
    return scored.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
