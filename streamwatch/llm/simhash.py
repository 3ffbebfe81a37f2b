"""Near duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint has a bit for each of 64 places: 1 if it is set in over half of the text's shingle hashes. Fingerprints link
if at most two bits differ. Hashes of shingles are XXH64 with a seed of 42 over the UTF-8 bytes of the words, space-joined.

The index: a fingerprint is two segments of 32 bits, and there is a table for each. It holds a fingerprint under
every point of the Hamming ball of radius 1 around that segment's value, with the other segment's value beside it: 33 keys for each.
Both tables have the same kind of key, a point of 64 bits, so a match may be one of a table with itself or
with the other one:

* both differing bits in one segment: its ball has the point between the two values, and the other segments are equal;
* one in each segment: the point made of the one's first and the other's second segment is in the ball of the one's
  second segment and of the other's first.

So all pairs within two bits meet. A key of a segment alone would do as well, but everything that shares 32 bits
would meet there; with the other segment in the key at most 65 fingerprints can (the points around it), whatever the corpus. Matches are
verified by their complete distance, linked to the least of their key, and the links make components.

Copies share a fingerprint and are one node from the start. Fingerprints that hold more than 1/4096 of the documents are few
and are broadcast when classes go back to documents; all others are joined by a shuffle.

Rules: words are runs of other than white space, A-Z in lower case. A text of one or two words is one shingle. One without
words, or null, has the fingerprint zero and is linked like any other. Each row is judged for itself, repeated ids too; a row
without id links others but names no component, and its own is null if no linked row has an id. A very long text is hashed in
blocks. Other columns are not used. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, attached, stored, text_bytes
from .near_dedup import components

SEED = 42
RADIUS = 2
SEGMENT_BITS = 32
#: Shingles whose bits are counted at once.
BLOCK_SHINGLES = 1 << 17

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _joined_words(text: np.ndarray) -> tuple[bytes, list[int], list[int]]:
    """The words of a text in lower case with one space between them, and where each begins and ends."""
    inside = ~_SPACE[text]
    begins = inside & ~np.concatenate([[False], inside[:-1]])
    n = int(begins.sum())
    # each word but the first takes the white space before it along, as one space
    kept = inside.copy()
    first = np.flatnonzero(begins)
    kept[first[1:] - 1] = True
    joined = _LOWER[text[kept]]
    places = np.concatenate([[0], np.cumsum(kept)])
    starts = places[first]
    joined[starts[1:] - 1] = 0x20
    ends = np.append(starts[1:] - 1, len(joined)) if n else np.zeros(0, np.int64)
    return joined.tobytes(), starts.tolist(), ends.tolist()


def shingle_hashes(text: np.ndarray, words: int) -> np.ndarray:
    """Unsigned hashes of all shingles of a text, repeats included."""
    import xxhash

    joined, starts, ends = _joined_words(text)
    if not starts:
        return np.zeros(0, np.uint64)
    if len(starts) < words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    return np.array([digest(view[a:b], SEED) for a, b in zip(starts, ends[words - 1 :])], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as a signed number."""
    count = np.zeros(64, np.int64)
    for begin in range(0, len(hashes), BLOCK_SHINGLES):
        some = hashes[begin : begin + BLOCK_SHINGLES].astype("<u8")
        count += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """doc_id and fingerprint, a signed 64-bit number, of each row."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            found = [fingerprint(shingle_hashes(data[a:b], words)) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(describe, "doc_id long, fingerprint long")


def segment_balls(value: Column) -> Column:
    """The keys of a fingerprint in the tables of both segments: each segment's ball of radius 1, the other segment unchanged."""
    centre = F.array(value)
    balls = [F.transform(F.sequence(F.lit(low), F.lit(low + SEGMENT_BITS - 1)), lambda bit: value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))) for low in (0, SEGMENT_BITS)]
    return F.concat(centre, *balls)


def fingerprint_links(values: DataFrame) -> DataFrame:
    """a, b: pairs of the distinct ``fingerprint`` values that connect all that lie within two bits of each other."""
    keyed = values.select("fingerprint", F.explode(segment_balls(F.col("fingerprint"))).alias("key")).repartition("key")
    # most keys have one fingerprint; the others, 65 at most, are linked to the least
    shared = keyed.groupBy("key").agg(F.min("fingerprint").alias("a"), F.max("fingerprint").alias("most")).filter("a < most").drop("most")
    pairs = keyed.join(shared.hint("shuffle_hash"), "key").select("a", F.col("fingerprint").alias("b")).filter("a < b")
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS).distinct()


def simhash_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """doc_id, fingerprint (signed), component_id: the smallest document id reachable over links, its own included."""
    described = stored(fingerprints(docs, id_col=id_col, text_col=text_col, words=words), "fingerprints")
    values = described.groupBy("fingerprint").agg(F.count("*").alias("n"), F.min("doc_id").alias("least_id"))
    values = stored(values, "distinct-fingerprints")
    classes = components(stored(fingerprint_links(values), "links")).withColumnsRenamed({"node": "fingerprint", "component": "class"})
    values = values.join(classes, "fingerprint", "left").withColumn("class", F.coalesce("class", "fingerprint"))
    values = stored(values, "classes")
    # components of one fingerprint name themselves; the others are few against the documents
    linked = values.join(classes.select(F.col("class")).distinct(), "class", "left_semi")
    names = linked.groupBy("class").agg(F.min("least_id").alias("name"), F.count("*").alias("members"))
    total = values.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sizes = values.agg(F.count("*")).first()[0]
    named = attached(values, names.withColumn("big", F.col("members") > int(sizes * HOT_SHARE)), ["class"], F.col("big"), ["fingerprint"])
    named = named.select("fingerprint", "n", F.coalesce("name", "least_id").alias("component_id"))
    found = attached(described, named, ["fingerprint"], F.col("n") > int(total * HOT_SHARE), ["doc_id"])
    return found.select("doc_id", "fingerprint", "component_id")
