import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from streamwatch.llm import queries
from streamwatch.llm.quality_model import Settings, fit_quality_model, score_quality, word_vectors
from tests.conftest import TESTDATA

from .conftest import ODD

SMALL = Settings(buckets=512, dimensions=16, epochs=30)


def _texts(n=300):
    draw = random.Random(9)
    good, bad = [f"g{k}" for k in range(80)], [f"b{k}!!" for k in range(80)]
    both = [f"c{k}" for k in range(40)]
    return [(k, " ".join(draw.choices((good if k % 3 else bad) + both, k=draw.randint(5, 60)))) for k in range(n)]


def test_held_out_accuracy(spark, documents):
    texts = _texts()
    docs = documents(texts)
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k, _ in texts if k < 200] + [(0, 1), (1, None)], "doc_id long, quality int")
    model = fit_quality_model(docs, labels, settings=SMALL)
    rows = score_quality(docs, model).collect()
    assert len(rows) == len(texts)
    right = [row.predicted == int(row.doc_id % 3 > 0) for row in rows if row.doc_id >= 200]
    assert sum(right) / len(right) > 0.93
    assert all(0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5) for row in rows)


def test_vectors_do_not_hang_on_partitions(documents):
    docs = documents(_texts(50))
    one, many = word_vectors(docs.coalesce(1), SMALL), word_vectors(docs.repartition(11), SMALL)
    assert np.array_equal(one, many) and one[:, 0].sum() == sum(len(text.split()) for _, text in _texts(50))


def test_vectors_against_a_plain_loop(documents):
    texts = [(1, "a b c a"), (2, "d a")]
    found = word_vectors(documents(texts), SMALL)
    import xxhash

    signs, expected = SMALL.index_vectors(), np.zeros_like(found)
    for _, text in texts:
        rows = [xxhash.xxh32_intdigest(word) % SMALL.buckets for word in text.split()]
        for i, row in enumerate(rows):
            expected[row, 0] += 1
            for j in range(max(0, i - 2), min(len(rows), i + 3)):
                if j != i:
                    expected[row, 1:] += signs[rows[j]]
    assert np.allclose(found, expected)


def test_odd_and_no_documents(spark, odd, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = fit_quality_model(odd.withColumn("label", F.lit(1)).withColumn("score", F.lit("x")), none, settings=SMALL)
    rows = score_quality(odd, model).collect()
    assert len(rows) == len(ODD) and all(row.score == 0.5 for row in rows)
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 8)], "doc_id long, quality int")
    trained = fit_quality_model(odd, labels, settings=SMALL)
    assert all(0 <= row.score <= 1 for row in score_quality(odd, trained).collect())
    assert score_quality(no_docs, fit_quality_model(no_docs, labels, settings=SMALL)).count() == 0


def test_query_learns_from_its_folds_only(spark, tmp_path):
    """Labels of the held-out fold, the language and the source change no score; columns are as stated."""
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    labels = spark.read.parquet(f"{TESTDATA}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    found = []
    for name, changed in (("a", False), ("b", True)):
        folder = str(tmp_path / name)
        (docs.withColumns({"lang": F.lit("x"), "source": F.lit(None).cast("string")}) if changed else docs).write.parquet(folder + "/documents.parquet")
        quality = F.when(held_out, 1 - F.col("quality")).otherwise(F.col("quality")) if changed else F.col("quality")
        labels.withColumn("quality", quality).write.parquet(folder + "/labels.parquet")
        result = queries.op3_quality_classifier(spark, folder)
        assert dict(result.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
        found.append({row.doc_id: row for row in result.collect()})
    assert len(found[0]) == docs.count() and found[0].keys() == found[1].keys()
    for doc, row in found[0].items():
        assert row.held_out == (zlib.crc32(str(doc).encode()) % 3 == 1) and row.predicted == int(row.score >= 0.5) and 0 <= row.score <= 1
        assert abs(row.score - found[1][doc].score) < 1e-9
    known = [(found[0][row.doc_id].score, row.quality) for row in labels.filter(held_out & F.col("quality").isNotNull()).collect()]
    good, bad = ([score for score, label in known if label == own] for own in (1, 0))
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) >= 0.8 * len(good) * len(bad)
