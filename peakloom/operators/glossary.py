"""Dimension tables: hashed id to original values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peakloom.functions.keys import id_texts, long_id
from peakloom.schema import GLOSSARIES
from peakloom.session import materialise

KINDS = ("analyte", "fragment", "rep")


def glossary(df: DataFrame, kind: str) -> DataFrame:
    """Distinct id and original columns of one kind; duplicates collapse before the shuffle."""
    return df.select(*GLOSSARIES[kind]).distinct()


def merge_glossary(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append the rows of a new chunk and drop duplicates over the whole."""
    return old.unionByName(new).distinct()


def _ids(df: DataFrame, value: Callable[[str], Column]) -> DataFrame:
    """(kind, id, value) of every id, in one pass over the rows."""
    parts = [F.struct(F.lit(kind).alias("kind"), F.col(GLOSSARIES[kind][0]).alias("id"), value(kind).alias("value")) for kind in KINDS]
    return df.select(F.explode(F.array(*parts)).alias("o")).select("o.*").distinct()


def check_ids(df: DataFrame) -> None:
    """Raise if an analyte, fragment or replicate id stands for several originals: their rows would be
    refined as one. Use `split_ids`, or give `add_ids` a greater width then."""
    rows = _ids(df, lambda kind: F.to_json(F.struct(*GLOSSARIES[kind][1:])))
    key = F.concat_ws(" ", "kind", "id").alias("key")
    clash = sorted(row["key"] for row in id_collisions(rows.select(key, "value"), "key").limit(20).collect())
    for kind in KINDS:
        ids = [key.split(" ", 1)[1] for key in clash if key.startswith(f"{kind} ")]
        if ids:
            raise ValueError(f"{kind} ids that stand for several originals: {', '.join(ids)}")


def split_ids(df: DataFrame) -> DataFrame:
    """The rows with an id for every original: 32 bits are shared by some from 100,000 originals on. Of the originals
    of an id the first by its text keeps it, the others get the `long_id`; all other ids stay as they are."""
    texts = id_texts(df)
    several = Window.partitionBy("kind", "id").orderBy("value")
    later = materialise(_ids(df, lambda kind: texts[GLOSSARIES[kind][0]]).withColumn(
        "nth", F.row_number().over(several)).filter("nth > 1").select(
        "kind", "id", "value", long_id("id", F.col("value")).alias("_long")), "later")
    columns = df.columns
    for kind in [row["kind"] for row in later.select("kind").distinct().collect()]:
        key = GLOSSARIES[kind][0]
        these = later.filter(F.col("kind") == kind).select(F.col("id").alias(key), F.col("value").alias("_text"), "_long")
        df = df.withColumn("_text", texts[key]).join(these, [key, "_text"], "left").withColumn(
            key, F.coalesce("_long", key)).select(*columns)
    return df


def id_collisions(table: DataFrame, key: str) -> DataFrame:
    """Ids that stand for more than one original; empty when the hash width suffices."""
    return table.distinct().groupBy(key).agg(F.count("*").alias("originals")).filter("originals > 1")
