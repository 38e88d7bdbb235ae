"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm.chat import rotate
from eventlens.llm.common import table
from eventlens.llm.conversation_repair import damage, repair_conversations
from eventlens.llm.decontaminate import hits
from eventlens.llm.exact_dedup import exact_groups
from eventlens.llm.html_text import extract
from eventlens.llm.language_id import fit, held_out, identify
from eventlens.llm.line_dedup import drop_common_lines
from eventlens.llm.near_dedup import near_groups
from eventlens.llm.packing import packed_documents
from eventlens.llm.secrets import KINDS, find_secrets, rendered
from eventlens.llm.token_blocks import token_round_trip
from eventlens.llm.warc import archive_round_trip
from eventlens.llm.whitening import whiten


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packed_documents(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    number = pages.schema["page_id"].dataType
    return archive_round_trip(pages, least_bytes=0).select(
        F.col("record_id").cast(number).alias("page_id"),
        "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(number).alias("refers_to"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_common_lines(table(spark, sf_dir, "documents"), threshold=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), percent=75).select("doc_id", "n_shingles", "component_id", "kept")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    own = F.filter("spans", lambda s: ~s["example"])
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(rendered("spans", KINDS[:3]), 256).alias("base_sha256"),
        rendered("spans", KINDS).alias("spans"),
        F.size(own).cast("long").alias("n_owned"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair_conversations(damage(conversations), conversations.select("conv_id"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whiten(table(spark, sf_dir, "embeddings"), components=8)
    rows = white.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error", F.inline("parts"))
    return rows.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op13_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_round_trip(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_warc": op2_warc,
    "op3_line_dedup": op3_line_dedup,
    "op4_near_dedup": op4_near_dedup,
    "op5_language_id": op5_language_id,
    "op6_chat_format": op6_chat_format,
    "op7_html_text": op7_html_text,
    "op8_decontaminate": op8_decontaminate,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_token_blocks": op13_token_blocks,
}
