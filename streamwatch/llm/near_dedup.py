"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures.

1. A document is the set of its distinct shingles (words in a row, in 64-bit hashes). Documents
   with equal sets are one *text* from here on, named after the smallest of their ids.
2. A signature has ``5 * chunks`` values of ``BITS`` bits, the least hashes of the set under as many
   permutations. Two texts of Jaccard similarity s differ in a value with probability 1 - s.
3. The signature is split into chunks of five values. Texts whose signatures differ in fewer than
   ``2 * chunks`` values have, by the pigeonhole principle, a chunk with at most one error. The allowed errors
   are enumerated: every chunk is indexed five times, each time without one of its values. So all
   pairs under that distance meet under some key, and ``chunks`` is chosen so that a pair of exactly the asked similarity
   stays under it but for a probability of ``MISSED``.
4. Texts that meet are compared by their whole sets, and links make components. Within a key not all pairs are
   compared, only what components need: first each text with one pivot of its key. Then keys that still hold several components are searched for pairs under the distance between
   different ones; components that meet so make a region, and in a region every text outside the largest component is
   compared with all others. No link between components is left out, a group of n copies costs about n comparisons, and
   a task tells no more than the links that unite components.

What a key or component has beyond a block goes to several tasks. Every step ends in a stored table, with as many files as its rows need.

Rules: words are compared with A-Z in lower case. A text with fewer words than a shingle is one shingle; one without
words has none and is linked with nothing. Rows with the same document id count as one document. A row without id is
linked with nothing. Columns of other names do not matter. Two different shingles of one text share a hash with a probability below 1e-12.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT_SHARE, as_texts, attached, free_name, groups_of, rows_by_id, stored, text_bytes

BITS = 16
CHUNK = 5
MISSED = 1e-5
#: Texts of a key or component that one task compares with as many others.
BLOCK = 1024
#: Bytes of text that a worker describes at once; what it holds meanwhile is many times as much.
BLOCK_BYTES = 1 << 20
EDGES_PER_TASK = 500_000

_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def chunks_for(similarity: float) -> int:
    """The least number of chunks at which a pair of this similarity is missed with at most ``MISSED``."""
    for chunks in range(2, 200):
        n, most = CHUNK * chunks, 2 * chunks - 1
        if 1 - sum(comb(n, k) * (1 - similarity) ** k * similarity ** (n - k) for k in range(most + 1)) <= MISSED:
            return chunks
    raise ValueError("the similarity is too small for chunks of five values")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that leaves no pattern."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _numbers(seed: int, n: int) -> np.ndarray:
    """Odd multipliers from a seed."""
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For blocks of texts: sorted distinct shingle hashes of all of them, and the places where each text's begin and end."""
    import xxhash

    data, offsets = text_bytes(column)
    for begin, end in groups_of(offsets, BLOCK_BYTES):
        part, borders = _LOWER[data[offsets[begin] : offsets[end]]], offsets[begin : end + 1] - offsets[begin]
        inside = ~_SPACE[part]
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        first = borders[:-1][borders[:-1] < len(part)]
        start[first] = inside[first]
        places = np.flatnonzero(start)
        packed = np.zeros(len(part) + 1, np.int64)
        np.cumsum(inside, out=packed[1:])
        n = len(places)
        if n:
            coded = as_texts(part[inside], np.append(packed[places], packed[-1])).dictionary_encode()
            known = np.array([xxhash.xxh64_intdigest(word) for word in coded.dictionary.to_numpy(zero_copy_only=False)], np.uint64)
            word_hash = known[coded.indices.to_numpy()]
        else:
            word_hash = np.zeros(0, np.uint64)
        word_borders = np.searchsorted(places, borders)
        factors = _numbers(words, words)
        grams = np.zeros(max(0, n - words + 1), np.uint64)
        for k in range(words):
            grams += word_hash[k : k + len(grams)] * factors[k]
        grams = _mixed(grams)
        sets = []
        for a, b in zip(word_borders[:-1], word_borders[1:]):
            if b - a >= words:
                own = np.sort(grams[a : b - words + 1])
                sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
            elif b > a:
                short = np.sum(word_hash[a:b] * factors[: b - a], dtype=np.uint64) + np.uint64(b - a)
                sets.append(_mixed(np.array([short ^ np.uint64(0xA5A5A5A5A5A5A5A5)])))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)


def signatures(hashes: np.ndarray, borders: np.ndarray, size: int) -> np.ndarray:
    """A row of ``size`` values for each set; rows of empty sets are 0."""
    found = np.zeros((len(borders) - 1, size), np.uint16)
    full = np.flatnonzero(np.diff(borders))
    if len(full):
        x = (hashes >> np.uint64(32)).astype(np.uint32)
        factors = _numbers(77, 2 * size).astype(np.uint32)
        for k in range(size):
            least = np.minimum.reduceat(x * (factors[k] | np.uint32(1)) + factors[size + k], borders[:-1][full])
            found[full, k] = least & np.uint32((1 << BITS) - 1)
    return found


def index_keys(rows: np.ndarray) -> np.ndarray:
    """For each signature its keys: every chunk, five times without one value."""
    n, size = rows.shape
    terms = rows.astype(np.uint64) * _numbers(5, size) + _numbers(9, size)
    terms = _mixed(terms).reshape(n, size // CHUNK, CHUNK)
    without = terms.sum(axis=2, dtype=np.uint64)[:, :, None] - terms
    return _mixed(without.reshape(n, size) ^ _numbers(13, size)).astype(np.int64)


def _described(docs: DataFrame, words: int, size: int) -> DataFrame:
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for hashes, borders in shingle_sets(batch.column(1), words):
                n = len(borders) - 1
                digests = np.array([np.frombuffer(hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest(), np.int64) for a, b in zip(borders[:-1], borders[1:])]).reshape(n, 2)
                rows = signatures(hashes, borders, size)
                columns = [batch.column(0).slice(at, n), pa.array(np.diff(borders)), pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array([row.tobytes() for row in rows], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_a", "set_b", "signature"])
                at += n

    return docs.mapInArrow(describe, "doc_id long, n_shingles long, set_a long, set_b long, signature binary")


def _keyed(texts: DataFrame) -> DataFrame:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = np.array([np.frombuffer(x.as_py(), np.uint16) for x in batch.column(1)])
                found = index_keys(rows)
                ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), found.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(found.reshape(-1)), pa.array(ids, pa.int64())], ["key", "text_id"])

    return texts.select("text_id", "signature").mapInArrow(keys, "key long, text_id long")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for hashes, borders in shingle_sets(batch.column(1), words):
                n = len(borders) - 1
                shingles = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(hashes.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), shingles], ["text_id", "shingles"])
                at += n

    return docs.mapInArrow(sets, "text_id long, shingles array<long>")


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """node, component (the smallest node reachable), for all nodes of ``links`` (a, b), which are read once. Alternates the two star
    operations: neighbours above a node are hung on its least neighbour, then those below; every node's edges
    are summed up before they are joined, so a hub is no list in one task. ``rows``: how many links there are at most, if known."""
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges", rows)
    before = None
    while True:
        print_ = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if print_ == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = print_
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # neither step adds edges, so that few tasks hold them all; and every task writes files
        tasks = 1 + before["n"] // EDGES_PER_TASK
        large = stored(large.coalesce(tasks), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct().coalesce(tasks), "edges")


class _Search:
    """The texts, their keys and sets, and what is known of their components."""

    def __init__(self, texts: DataFrame, buckets: DataFrame, sets: DataFrame, similarity: float, most: int, rows: int):
        self.texts, self.buckets, self.sets, self.most = texts, buckets, sets, most
        self.percent = round(similarity * 100)
        self.labels = None
        #: How many texts there are at most.
        self.rows = rows

    def add(self, links: DataFrame, rows: int) -> None:
        """``rows``: how many links there are at most."""
        stars = links if self.labels is None else links.unionByName(self.labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
        self.labels = components(stars, rows if self.labels is None else rows + self.rows)

    def labelled(self, rows: DataFrame, column: str, label: str) -> DataFrame:
        """``rows`` with the component of the text in ``column``."""
        known = self.labels.select(F.col("node").alias(column), F.col("component").alias("_component"))
        return rows.join(known, column, "left").withColumn(label, F.coalesce("_component", column)).drop("_component")

    def open_buckets(self) -> DataFrame:
        """Rows of keys that hold more than one component."""
        rows = self.labelled(self.buckets, "text_id", "component")
        mixed = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("key")
        return rows.join(mixed, "key")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) under the signature distance whose whole sets are similar enough."""
        signature = self.texts.select("text_id", "signature")
        for side in "ab":
            pairs = pairs.join(signature.select(F.col("text_id").alias(side), F.col("signature").alias(f"signature_{side}")), side)
        most = self.most

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    a, b = (np.array([np.frombuffer(x.as_py(), np.uint16) for x in batch.column(k)]) for k in (2, 3))
                    close = pa.array((a != b).sum(axis=1) <= most)
                    yield pa.RecordBatch.from_arrays([batch.column(0).filter(close), batch.column(1).filter(close)], ["a", "b"])

        pairs = pairs.select("a", "b", "signature_a", "signature_b").mapInArrow(near, "a long, b long")
        for side in "ab":
            pairs = pairs.join(self.sets.select(F.col("text_id").alias(side), F.col("shingles").alias(f"set_{side}")), side)
        shared = F.size(F.array_intersect("set_a", "set_b"))
        rows = pairs.select("a", "b", shared.alias("shared"), (F.size("set_a") + F.size("set_b")).alias("both"))
        return rows.filter(100 * F.col("shared") >= self.percent * (F.col("both") - F.col("shared"))).select("a", "b")

    def pivots(self) -> None:
        """Each text with the pivot of each of its keys."""
        first = self.buckets.select(F.col("lo").alias("a"), F.col("text_id").alias("b")).filter("a <> b").distinct()
        self.add(self.confirmed(first), self.buckets.count())

    def rest(self) -> None:
        """What the pivots left. Components with texts under the signature distance make regions; within a region
        all texts outside the largest component of a task are compared with all others."""
        # of two texts the pivot is one
        rows = self.open_buckets().filter("n > 2")
        rows = rows.join(self.texts.select("text_id", "signature"), "text_id")
        most = self.most

        def near(group: pa.Table) -> pa.Table:
            component = group.column("component").to_numpy()
            rows = np.array([np.frombuffer(x.as_py(), np.uint16) for x in group.column("signature")])
            joined, a, b = _Union(component), [], []
            for k in range(len(rows)):
                if joined.groups == 1:
                    break
                other = np.flatnonzero(joined.roots() != joined.find(component[k]))
                for c in np.unique(component[other[(rows[other] != rows[k]).sum(axis=1) <= most]]):
                    if joined.join(component[k], c):
                        a.append(int(component[k]))
                        b.append(int(c))
            return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        blocks = _in_block_pairs(rows, ["key"], F.col("n"))
        # a task tells fewer pairs than it has rows
        most_met = _rows_in_block_pairs(self.buckets, F.lit(1))
        met = components(blocks.groupBy("key", "i", "j").applyInArrow(near, "a long, b long"), most_met)
        regions = met.unionByName(met.select(F.col("component").alias("node"), "component").distinct())
        regions = regions.select(F.col("node").alias("component"), F.col("component").alias("region"))
        members = self.labelled(self.texts.select("text_id"), "text_id", "component").join(regions, "component")
        members = stored(members, "regions", self.rows)
        sizes = members.groupBy("region").agg(F.count("*").alias("n"))
        blocks = _in_block_pairs(members.join(sizes, "region").join(self.sets, "text_id"), ["region"], F.col("n"))
        percent = self.percent

        def compare(group: pa.Table) -> pa.Table:
            component, text = group.column("component").to_numpy(), group.column("text_id").to_numpy()
            shingles = group.column("shingles").combine_chunks()
            size = shingles.value_lengths().to_numpy()
            at = np.concatenate([[0], np.cumsum(size)[:-1]])
            known, codes = np.unique(shingles.flatten().to_numpy(), return_inverse=True)
            names, number = np.unique(component, return_counts=True)
            joined, marked, a, b = _Union(component), np.zeros(len(known), np.int32), [], []
            for k in np.flatnonzero(component != names[np.argmax(number)]):
                if joined.groups == 1:
                    break
                own = codes[at[k] : at[k] + size[k]]
                marked[own] = 1
                shared = np.add.reduceat(marked[codes], at)
                marked[own] = 0
                linked = (100 * shared >= percent * (size + size[k] - shared)) & (joined.roots() != joined.find(component[k]))
                for other in np.flatnonzero(linked):
                    if joined.join(component[k], component[other]):
                        a.append(int(text[k]))
                        b.append(int(text[other]))
            return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        self.add(blocks.groupBy("region", "i", "j").applyInArrow(compare, "a long, b long"), _rows_in_block_pairs(sizes, F.col("n")))


class _Union:
    """Components that links unite, for the rows of one task."""

    def __init__(self, component: np.ndarray):
        self.names, self.place = np.unique(component, return_inverse=True)
        self.root = np.arange(len(self.names))
        self.groups = len(self.names)

    def find(self, name: int) -> int:
        return int(self.root[np.searchsorted(self.names, name)])

    def roots(self) -> np.ndarray:
        """Of each row."""
        return self.root[self.place]

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.root[self.root == b] = a
            self.groups -= 1
        return a != b


def _in_block_pairs(rows: DataFrame, group: list[str], size: Column) -> DataFrame:
    """Rows of large groups in blocks by their text's hash: block i meets block j in the task (i, j), i <= j, so that
    any two rows of a group meet and no task holds a whole one."""
    blocks = F.ceil(size / BLOCK).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("text_id"), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("block", "other")


def _rows_in_block_pairs(groups: DataFrame, weight: Column) -> int:
    """How many rows :func:`_in_block_pairs` makes. ``groups``: ``n``, the size of a row's group, for ``weight`` rows of it each."""
    return groups.agg(F.coalesce(F.sum(weight * F.ceil(F.col("n") / BLOCK)), F.lit(0))).first()[0]


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest document id reachable over links of at least ``similarity``, its own
    included), kept (it is that document)."""
    return _classes(docs, id_col, text_col, words, similarity)[0]


def _classes(docs: DataFrame, id_col: str, text_col: str, words: int, similarity: float) -> tuple[DataFrame, int]:
    """What :func:`near_duplicates` returns, and how many rows ``docs`` has."""
    chunks = chunks_for(similarity)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    described = stored(_described(rows, words, CHUNK * chunks), "signatures")
    n = described.count()
    named = described.filter("doc_id is not null and n_shingles > 0")
    texts = stored(named.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("text_id"), F.count("*").alias("copies")), "named-texts", n)
    total = texts.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    # a large group of exact copies is not joined with its name in one task
    members = attached(named.select("doc_id", "set_a", "set_b"), texts, ["set_a", "set_b"], F.col("copies") > int(total * HOT_SHARE), ["doc_id"])
    members = stored(members.select("doc_id", "text_id").distinct(), "members", n)
    whole = named.select(F.col("doc_id").alias("text_id"), "signature").join(members.select("text_id").distinct(), "text_id")
    whole = stored(whole, "texts", n)
    keyed = _keyed(whole).repartition("key")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("text_id").alias("lo")).filter("n > 1")
    buckets = stored(keyed.join(shared, "key"), "buckets", n * CHUNK * chunks)
    candidates = stored(buckets.select("text_id").distinct(), "candidates", n)
    own = rows_by_id(rows, "doc_id", candidates, among=True)
    search = _Search(whole, buckets, stored(_sets(own, words), "sets"), similarity, 2 * chunks - 1, n)
    search.pivots()
    search.rest()
    label = search.labelled(members, "text_id", "component")
    final = label.select("doc_id", F.col("component").alias("component_id"))
    if not members.groupBy("doc_id").count().filter("count > 1").isEmpty():
        # a document with several texts links them
        links = label.select(F.col("doc_id").alias("a"), F.col("component").alias("b")).unionByName(search.labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
        final = components(links).select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))
    found = described.select("doc_id", "n_shingles").join(final, "doc_id", "left")
    found = found.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept")), n


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one document of each group: that with the smallest id. Of rows with one id, that with the
    smallest hash of its text stays; rows without id all stay."""
    found, n = _classes(docs, id_col, text_col, words, similarity)
    found = stored(found.filter("doc_id is not null"), "classes", n)
    left = rows_by_id(docs, id_col, found.filter(~F.col("kept")).select("doc_id"), among=False)
    if found.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return left
    number = free_name(docs, "number")
    order = Window.partitionBy(id_col).orderBy(F.xxhash64(text_col), text_col)
    return left.withColumn(number, F.row_number().over(order)).filter((F.col(number) == 1) | F.col(id_col).isNull()).drop(number)
