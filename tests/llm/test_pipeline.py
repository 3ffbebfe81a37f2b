"""The whole pipeline against plain Python on a small corpus."""

import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from streamwatch.llm import quality_rules as rules
from streamwatch.llm.decontamination import normalized
from streamwatch.llm.tokens import encoder

from .conftest import ODD, SCHEMA
from .test_near_dedup import plain_classes
from .test_rules_and_secrets import plain_rules, plain_spans, plain_weights


def _corpus():
    draw = random.Random(12)
    words = [f"w{k}" for k in range(60)]
    line = lambda n: " ".join(draw.choices(words, k=n))
    items = [(k, line(14)) for k in range(3)]
    texts = [line(draw.randint(5, 80)) for _ in range(30)]
    texts += [texts[3], texts[3] + " w1", texts[7]]
    texts += [line(20) + " " + items[1][1] + " " + line(20), line(30) + " token: 0123456789abcdef0123 " + line(10)]
    texts += [" | ".join(f"junk{draw.randrange(10**6)}" for _ in range(40)), "again and again we go " * 30, None, "", " \n "]
    return list(enumerate(texts)), items


def _redacted(text):
    parts, at = [], 0
    for start, _, end in plain_spans(text):
        if start >= at:
            parts += [text[at:start], "[secret]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def test_all_stages_against_plain_python(spark, tmp_path):
    texts, items = _corpus()
    trusted = {k for k, _ in texts[:30] if k % 2 == 0}
    folder = str(tmp_path)
    spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in texts], SCHEMA).write.parquet(folder + "/documents.parquet")
    spark.createDataFrame([(k, int(k in trusted)) for k, _ in texts], "doc_id long, quality int").write.parquet(folder + "/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(folder + "/benchmark.parquet")

    weights = plain_weights(texts, trusted, rules.BUCKETS, rules.PRIOR)
    left = [(k, t) for k, t in texts if plain_rules(t, weights, rules.THRESHOLD)[7]]
    classes = plain_classes(left, 5, 80)
    left = [(k, t) for k, t in left if classes[k][1] == k]
    left = [(k, t) for k, t in left if not any(normalized(item) in normalized(t) for _, item in items)]
    left = {k: _redacted(t) for k, t in left}
    assert 10 < len(left) < len(texts) - 5

    rows = corpus_pipeline.run(spark, folder).collect()
    encode = encoder(public_tokenizers.path("word_bpe_49k.json")).tokenizer.encode
    expected = {}
    for k, text in left.items():
        ids = [*encode(text, add_special_tokens=False).ids, 0]
        for start in range(0, len(ids), 2048):
            piece = ids[start : start + 2048]
            expected[k, start // 2048] = (start, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected and len(rows) == len(expected)
    used = {}
    for row in rows:
        used.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages_on_odd_documents_and_extra_columns(spark, tmp_path):
    folder = str(tmp_path)
    odd = spark.createDataFrame(ODD, SCHEMA).withColumn("row", F.lit(1)).withColumn("score", F.lit("x"))
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(folder + "/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(folder + "/benchmark.parquet")
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder)
            assert docs.columns == odd.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()
