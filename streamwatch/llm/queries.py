"""One query per operator, with production parameters, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamwatch.session import fresh_folder

from .archives import mark_revisits, read_arc, read_warc, write_arc, write_warc
from .chat import fold_events, format_conversations, read_turns
from .collocations import mine_phrases
from .common import stored, table
from .decontamination import find_items
from .license_scan import scan_licenses
from .merkle import build_manifest, proofs
from .near_dedup import near_duplicates
from .packing import pack_documents
from .quality_model import fit_quality_model, score_quality
from .quality_rules import fit_target_ratio, quality_rules
from .secret_scan import listed, scan_secrets
from .simhash import simhash_duplicates
from .token_store import read_tokens, write_tokens


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file; they are installed apart from this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written as a token store, and read back."""
    path = fresh_folder(spark, "token-store")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"), end_id=2, width=2)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learnt from two thirds of the labelled documents; the rest is held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = fit_quality_model(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return score_quality(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def trusted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled as good: the target of the quality rules."""
    return table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules(docs, fit_target_ratio(docs, trusted_documents(spark, sf_dir)))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, similarity=0.85)


def op7_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as a legacy archive, converted, written and read back."""
    records = read_arc(write_arc(table(spark, sf_dir, "pages"), version=1))
    page = F.nullif(F.regexp_extract(F.col("http_head").cast("string"), r"X-Source-Id: ([0-9-]*)", 1), F.lit("")).cast("long")
    archives = stored(write_warc(mark_revisits(records, page, least_bytes=0)), "warc")
    return read_warc(archives, payloads=False).select(
        F.col("source_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to_id").cast("long").alias("refers_to"),
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    of_kind = lambda kind: F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        of_kind(0).alias("n_assign"),
        of_kind(1).alias("n_access"),
        of_kind(2).alias("n_hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )


def conversation_events(conversations: DataFrame) -> DataFrame:
    """The log of a chat service that would have led to these turns: the first half of a message is streamed,
    thrown away and generated again, then the rest is streamed."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # the log is partitioned by conversation once; all that follows stays there
    rows = rows.repartition("conv_id")
    # repeated rows are turns of their own
    turns = rows.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list(F.struct("role", "text"))).alias("said"))
    turns = turns.select("conv_id", "turn", F.posexplode("said").alias("copy", "said"))
    half = F.floor(F.length("said.text") / 2).cast("int")
    first = F.substring(F.col("said.text"), F.lit(1), half)
    rest = F.substring(F.col("said.text"), half + 1, F.length("said.text"))
    events = [("delta", first), ("regenerate", first), ("delta", rest)]
    log = F.array(*(F.struct(F.lit(k).alias("sequence"), F.lit(kind).alias("operation"), text.alias("text")) for k, (kind, text) in enumerate(events)))
    return turns.select("conv_id", F.struct("turn", "copy").alias("message"), F.col("said.role").alias("role"), F.inline(log))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    events = conversation_events(table(spark, sf_dir, "conversations").select(more.columns).union(more))
    output = read_turns(stored(format_conversations(fold_events(events)), "conversations"))
    written = F.array_join(F.transform("turns", lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n"))), "")
    return output.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(written, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), capacity=2048, end_id=0)


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(table(spark, sf_dir, "documents"), longest=3, least=10, percent=50, top=2000)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof in the manifest of all, checked against altered texts."""
    return proofs(build_manifest(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_duplicates(table(spark, sf_dir, "documents"), words=3)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_store": op1_token_store,
    "op2_license_scan": op2_license_scan,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_quality_rules": op4_quality_rules,
    "op5_decontamination": op5_decontamination,
    "op6_near_dedup": op6_near_dedup,
    "op7_arc_to_warc": op7_arc_to_warc,
    "op8_secret_scan": op8_secret_scan,
    "op9_chat_format": op9_chat_format,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_simhash": op13_simhash,
}
