import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from streamwatch import session
from streamwatch.llm import common, packing
from streamwatch.llm import near_dedup as near

from .conftest import ODD


def _set(text, words):
    own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(own) < words:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[k : k + words]) for k in range(len(own) - words + 1))


def plain_classes(texts, words, percent):
    """{id: (set size, component)} by comparing all pairs."""
    sets = {doc: _set(text, words) for doc, text in texts}
    parent = {doc: doc for doc in sets}

    def find(doc):
        while parent[doc] != doc:
            doc = parent[doc]
        return doc

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            shared = len(sets[a] & sets[b])
            if sets[a] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {doc: (len(sets[doc]), find(doc)) for doc in sets}


def _copies(draw, base, n, most):
    """Copies with some words exchanged, so that many pairs lie around the threshold."""
    found = []
    for _ in range(n):
        own = list(base)
        for _ in range(draw.randint(0, most)):
            own[draw.randrange(len(own))] = f"x{draw.randrange(10**6)}"
        found.append(" ".join(own))
    return found


def _corpus():
    draw = random.Random(8)
    words = [f"w{k}" for k in range(500)]
    texts = [" ".join(draw.choices(words, k=draw.randint(1, 60))) for _ in range(60)]
    base = draw.choices(words, k=90)
    texts += _copies(draw, base, 60, 9) + [" ".join(base)] * 10
    texts += _copies(draw, draw.choices(words, k=60), 12, 2) + ["Two Words", "two\twords", "", None, " "]
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [1024, 7])
def test_classes_against_all_pairs(documents, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    texts = _corpus()
    rows = near.near_duplicates(documents(texts), words=3, similarity=0.85).collect()
    expected = plain_classes(texts, 3, 85)
    assert len(rows) == len(texts)
    assert {row.doc_id: (row.n_shingles, row.component_id) for row in rows} == expected
    assert all(row.kept == (row.component_id == row.doc_id) for row in rows)
    assert len({component for _, component in expected.values()}) < len(texts) - 20


def test_odd_and_no_documents(odd, no_docs):
    clashing = odd.withColumn("n_shingles", F.lit(1)).withColumn("number", F.lit("x")).withColumn("key", F.lit(0))
    rows = near.near_duplicates(clashing).collect()
    assert sorted((row.doc_id if row.doc_id is not None else -1, row.component_id) for row in rows if row.doc_id in (None, 1, 5)) == [(-1, None), (1, 1), (5, 1), (5, 1)]
    assert len(rows) == len(ODD) and all(row.kept for row in rows if row.doc_id != 5)
    left = near.drop_near_duplicates(clashing)
    assert left.columns == clashing.columns
    assert sorted(row.doc_id or 0 for row in left.collect()) == [0, 1, 2, 3, 4, 6, 7]
    assert near.near_duplicates(no_docs).count() == 0 and near.drop_near_duplicates(no_docs).count() == 0


def test_repeated_rows_leave_one(spark, documents):
    docs = documents([(1, "a b c d e f g"), (1, "a b c d e f g"), (1, "h i j k l m n"), (2, "h i j k l m n")])
    assert [row.doc_id for row in near.drop_near_duplicates(docs).collect()] == [1]


def test_components_of_a_chain_and_a_hub(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 150)] + [(7, 7)]
    found = dict(near.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(found[k] == 0 for k in range(1, 41)) and all(found[k] == 100 for k in range(101, 150))


def test_chunks_keep_nearly_all_pairs():
    assert near.chunks_for(0.85) < near.chunks_for(0.8) < 25
    with pytest.raises(ValueError):
        near.chunks_for(0.3)


def _files(folders):
    return {folder: len(list(Path(folder.removeprefix("file:")).glob("part-*"))) for folder in folders}


def test_tables_have_as_many_files_as_their_rows_need(spark, documents, setting):
    setting("spark.sql.shuffle.partitions", "64")
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    texts, cores, mark = _corpus(), spark.sparkContext.defaultParallelism, session.scratch_mark()
    left = near.drop_near_duplicates(documents(texts), words=3, similarity=0.85)
    expected = plain_classes(texts, 3, 85)
    assert sorted(row.doc_id for row in left.collect()) == [doc for doc, (_, component) in sorted(expected.items()) if doc == component]
    files = _files(session._SCRATCH[mark:])
    assert len(files) > 10 and max(files.values()) <= cores < 64, files


def test_packed_pieces_have_as_many_files_as_their_rows_need(spark, setting, tmp_path):
    setting("spark.sql.shuffle.partitions", "64")
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    pieces = spark.range(600).selectExpr("id as doc_id", "0 as piece", "0L as start", "id % 60 + 1 as length").repartition(3).cache()
    cores, mark = spark.sparkContext.defaultParallelism, session.scratch_mark()
    packing.pack_pieces(pieces, 64, per_task=4).write.parquet(f"{tmp_path}/packed")
    files = _files([*session._SCRATCH[mark:], f"{tmp_path}/packed"])
    assert len(files) == 2 and max(files.values()) <= cores < 64, files
    assert spark.read.parquet(f"{tmp_path}/packed").count() == 600


def test_more_rows_have_more_files(spark, monkeypatch):
    monkeypatch.setattr(common, "ROWS_PER_FILE", 10)
    rows = spark.range(0, 1000, numPartitions=64)
    assert common.in_few_parts(rows, 300).rdd.getNumPartitions() == 30
    assert common.in_few_parts(rows, 1000).rdd.getNumPartitions() == 64
    assert common.in_few_parts(rows, 0).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("n", [0, 1, 1024, 3000])
def test_number_of_rows_in_block_pairs(spark, monkeypatch, n):
    monkeypatch.setattr(near, "BLOCK", 100)
    rows = spark.range(n).selectExpr("id as text_id", "1 as key", f"{n}L as n")
    made = near._in_block_pairs(rows, ["key"], F.col("n")).count()
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"))
    assert made == near._rows_in_block_pairs(rows, F.lit(1)) == near._rows_in_block_pairs(sizes, F.col("n"))
