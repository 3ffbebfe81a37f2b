"""Token ids of documents in a binary file format with random access to short documents.

Every document's ids are one zstandard frame of its own, compressed with a dictionary that
all documents share: short documents have little to learn from by themselves. Frames lie
one after the other in segments of bounded size; a segment keeps the hash of the dictionary
it needs and an index with offset and length of each frame. So one document is read
without decompressing another.

A store is a folder of tables, as executors reach shared storage through Spark's writers only:

* ``dictionary``: hash (SHA-256), bytes. One row.
* ``segments``: part, segment, dictionary_hash, first_id, last_id, n_tokens, index, payload.
  Parts ascend by document id, so do segments in a part and documents in a segment.
* ``parts``: part, start. Ids of all documents of earlier parts.

Rules: a null text is empty; a document always has its end id. Rows with the same document
id are kept, ordered by their texts' hash; a null document id comes first. Other columns are
not stored. An empty table gives a store without segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import hash_sample, shuffle_partitions, table
from .tokens import encoder

SEGMENTS = """part int, segment int, dictionary_hash string, first_id long, last_id long, n_tokens long,
    index array<struct<doc_id: long, offset: long, length: long, start: long, n_tokens: long>>, payload binary"""

_INDEX = pa.list_(pa.struct([(name, pa.int64()) for name in ("doc_id", "offset", "length", "start", "n_tokens")]))


def _serialized(ids: np.ndarray, width: int) -> bytes:
    return ids.astype(f"<u{width}").tobytes()


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


def train_dictionary(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, width: int = 4, size: int = 1 << 16, samples: int = 1000, sample_chars: int = 1 << 14) -> bytes:
    """A zstandard dictionary from the serialized ids of ``samples`` documents, those with the
    smallest hash of their id among the texts of up to ``sample_chars`` characters. Any
    dictionary gives right results, a fitting one gives smaller frames. Empty when there are too few
    documents to learn from."""
    short = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.length("text") <= sample_chars)
    chosen = F.broadcast(hash_sample(short.select("id"), "id", samples))  # at most ``samples`` ids
    drawn = short.join(chosen.distinct(), "id").select("text")

    def serialize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_serialized(np.append(ids, end_id), width) for ids in encoder(tokenizer).encode(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["ids"])

    found = [bytes(row.ids) for row in drawn.mapInArrow(serialize, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(size, found, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples
        return b""


def write_tokens(docs: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, width: int = 4, segment_bytes: int = 1 << 20, partitions: int | None = None, level: int = 3, dictionary: bytes | None = None) -> None:
    """Encode all texts and write them as a store at ``path``, in ascending order of document ids.

    ``width`` is the bytes of an id, 2 or 4. One range shuffle by id; a task holds one
    segment. Give ``dictionary`` to use one again.
    """
    spark = docs.sparkSession
    content = train_dictionary(docs, tokenizer, id_col=id_col, text_col=text_col, end_id=end_id, width=width) if dictionary is None else dictionary
    digest = hashlib.sha256(content).hexdigest()
    spark.createDataFrame([(digest, bytearray(content))], "hash string, bytes binary").coalesce(1).write.parquet(f"{path}/dictionary.parquet")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        compressor = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(content))
        frames, index, size, start, number = [], [], 0, 0, 0

        def segment() -> pa.RecordBatch:
            known = [row["doc_id"] for row in index if row["doc_id"] is not None] or [None]
            row = [part, number, digest, known[0], known[-1], sum(row["n_tokens"] for row in index), index, b"".join(frames)]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), _INDEX, pa.binary()]
            names = ["part", "segment", "dictionary_hash", "first_id", "last_id", "n_tokens", "index", "payload"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), encoder(tokenizer).encode(batch.column(1))):
                ids = np.append(ids, np.uint32(end_id))
                frame = compressor.compress(_serialized(ids, width))
                index.append({"doc_id": doc, "offset": size, "length": len(frame), "start": start, "n_tokens": len(ids)})
                frames.append(frame)
                size, start = size + len(frame), start + len(ids)
                if size >= segment_bytes:
                    yield segment()
                    frames, index, size, number = [], [], 0, number + 1
        if frames:
            yield segment()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(partitions or shuffle_partitions(spark), "id", tie).sortWithinPartitions("id", tie)
    ordered.mapInArrow(segments, SEGMENTS).write.parquet(f"{path}/segments.parquet")
    # one row per part, at most ``partitions``
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = table(spark, path, "segments").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    sums.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start")).write.parquet(f"{path}/parts.parquet")


def _decoded(spark: SparkSession, path: str, segments: DataFrame, wanted: set[int] | None) -> DataFrame:
    digest, content = table(spark, path, "dictionary").first()
    content = bytes(content)
    if hashlib.sha256(content).hexdigest() != digest:
        raise ValueError("the dictionary was changed")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor(dict_data=_dictionary(content))
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary_hash"] != digest:
                    raise ValueError("a segment was written with another dictionary")
                own = [doc for doc in row["index"] if wanted is None or doc["doc_id"] in wanted]
                payload = memoryview(row["payload"])
                found = []
                for doc in own:
                    raw = reader.decompress(payload[doc["offset"] : doc["offset"] + doc["length"]])
                    ids = np.frombuffer(raw, f"<u{len(raw) // doc['n_tokens']}")
                    found.append(ids.astype("<u4").tobytes())
                columns = [pa.array([row["part"]] * len(own), pa.int32())]
                columns += [pa.array([doc[name] for doc in own], pa.int64()) for name in ("doc_id", "start", "n_tokens")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.binary())], ["part", "doc_id", "own_start", "n_tokens", "ids"])

    documents = segments.mapInArrow(decode, "part int, doc_id long, own_start long, n_tokens long, ids binary")
    # a row for each part, not for each document
    joined = documents.join(F.broadcast(table(spark, path, "parts")), "part")
    return joined.select("doc_id", (F.col("start") + F.col("own_start")).alias("start"), "n_tokens", "ids")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (32-bit little-endian) of all documents."""
    return _decoded(spark, path, table(spark, path, "segments"), None)


def lookup_tokens(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The same for some documents: only segments that may hold them are read, and only their frames
    decompressed."""
    may = F.lit(False)
    for doc in doc_ids:
        may = may | F.lit(doc).between(F.col("first_id"), F.col("last_id"))
    return _decoded(spark, path, table(spark, path, "segments").filter(may), set(doc_ids))
