"""The registered queries of this package, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakloom.llm import (bestfit, bpe, chaining, hnsw, mixing, quality, sharding, simhash, skiplist, substrings,
                          tokens, warc, whitening)
from peakloom.llm.common import table
from peakloom.llm.sql import ORACLE  # noqa: F401


def op1_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return quality.apply_policy(led, "web-2").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_exclaim", "failed")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign(docs).select("doc_id", "n_bytes", "hash", "shard", "depth", "shard_bytes", "oversize")


def op5_collinear_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.with_classes(chaining.repeated_passages(table(spark, sf_dir, "documents")))


def op6_fair_queue_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op7_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_hnsw_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hnsw.vectors(table(spark, sf_dir, "embeddings"))
    return hnsw.search(hnsw.index(rows), rows.where("vec_id % 50 = 0"))


def op9_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.read_warc(warc.convert(warc.write_arc(table(spark, sf_dir, "pages"))))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_cholesky_jacobi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op12_skip_list_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = skiplist.restore(skiplist.transform(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op13_exact_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {f.__name__: f for f in (
    op1_token_frames, op2_quality_rules, op3_suffix_array_dedup, op4_extendible_sharding, op5_collinear_chaining,
    op6_fair_queue_mixing,
    op7_forced_boundary_bpe, op8_hnsw_shards, op9_arc_to_warc, op10_simhash_tiles,
    op11_cholesky_jacobi, op12_skip_list_fim, op13_exact_complement_packing)}
