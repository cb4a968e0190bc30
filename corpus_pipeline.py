"""From raw documents to token ids: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written and read again as the next
stage's documents. All but the last return the columns of `documents`. An empty table gives an empty table at
every stage; other columns stay whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakloom.llm import bpe, mixing, quality, simhash, substrings
from peakloom.session import materialise

POLICY = "web-2"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule of the policy rejects go. A null text counts as empty and goes; equal rows are judged
    alike."""
    return quality.keep(docs, POLICY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays. Rows that share that id count as one
    document; rows without an id all stay."""
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes and more that an earlier document holds are cut out of the texts; the rows stay. A null
    text becomes an empty one; rows without an id come after all others and own no passage."""
    cut = substrings.strip(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else cut


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice. Texts without words are not
    taken; a null source is a source of its own; equal rows are taken alike."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the digest of the text they decode to; one row per row, null and empty texts without ids."""
    rows = bpe.encode(docs)
    return rows.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates),
          ("substring dedup", substring_dedup), ("source mix", mix_sources), ("bpe", encode)]

#: Fingerprints, suffix arrays and merges cannot be told in SQL; tests/llm holds the stages in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, name.replace(" ", "-"))
    return docs
