"""Registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievery.llm import (
    ann, extract, linededup, neardup, packing, pieces, quality, secretscan, sharding, shards,
    spelling, vectorcodes, warc,
)
from sievery.llm.common import read_table
from sievery.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.annotate(read_table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "lines.n_lines", "lines.n_dropped",
                      F.sha2("text", 256).alias("kept_sha256"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract.extract(read_table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(read_table(spark, sf_dir, "pages"))
    return warc.read(spark, archives).select("page_id", "payload_bytes", "payload_digest",
                                             "record_type", "refers_to")


def op7_multiprobe_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.find(read_table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards.read(shards.write(read_table(spark, sf_dir, "documents")))
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.encode(read_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.array_max("ends"), F.lit(0)).cast("long").alias("span_bytes"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", sharding.text_size("text").alias("size"),
                      sharding.checksum("text").alias("text_crc32"), F.lit(sharding.LAW).alias("law"),
                      "place.shard", "place.slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compress(read_table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_line_dedup": op2_line_dedup,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_packing": op4_packing,
    "op5_html_extraction": op5_html_extraction,
    "op6_warc": op6_warc,
    "op7_multiprobe_ann": op7_multiprobe_ann,
    "op8_secret_scans": op8_secret_scans,
    "op9_token_shards": op9_token_shards,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_sharding": op11_sharding,
    "op12_vector_codes": op12_vector_codes,
    "op13_spelling_variants": op13_spelling_variants,
}
