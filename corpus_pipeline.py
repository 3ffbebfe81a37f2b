"""A corpus of documents made ready for training, stage by stage.

Every stage works on all that the one before kept; its rows are written as a table and read
again, so a lost executor costs a stage's own tasks and no more. Secrets are replaced in the texts, not
their documents dropped; the other stages before the last drop documents. The last stage gives
a row for each piece of a document and its place in a training sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streamwatch.llm.common import table
from streamwatch.llm.decontamination import drop_contaminated
from streamwatch.llm.near_dedup import drop_near_duplicates
from streamwatch.llm.packing import pack_documents
from streamwatch.llm.quality_rules import apply_quality_rules, fit_target_ratio
from streamwatch.llm.queries import tokenizer_path, trusted_documents
from streamwatch.llm.secret_scan import redact_secrets
from streamwatch.session import fresh_folder, remove_scratch, scratch_mark


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, measured against the documents labelled as good."""
    return apply_quality_rules(docs, fit_target_ratio(docs, trusted_documents(spark, sf_dir)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity of 0.8 or more."""
    return drop_near_duplicates(docs, words=5, similarity=0.8)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in them replaced by a mark."""
    return redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, in as few training sequences as possible."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), capacity=2048, end_id=0)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secrets", secrets), ("pack", pack)]

#: Tokenizers, hashed models and the numbering of sequences are not SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, mark = table(spark, sf_dir, "documents"), scratch_mark()
    for name, stage in STAGES:
        rows, path = stage(spark, docs, sf_dir), fresh_folder(spark, f"stage-{name}")
        rows.write.parquet(path)
        docs = spark.read.schema(rows.schema).parquet(path)
        # what the stage and those before it had stored is not needed any more
        remove_scratch(spark, mark, [path])
    return docs
