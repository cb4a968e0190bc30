"""Helpers shared by the operators: reading tables, exact running totals, files in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peakloom.session import materialise, shared_folder

#: What separates words: space and the control characters 9 to 13.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: str) -> F.Column:
    """Words of a text as a long, null: 0."""
    return F.coalesce(F.size(F.array_remove(F.split(text, BLANKS), "")), F.lit(0)).cast("bigint")


def masked(docs: DataFrame, *needed: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`docs` with every column but the needed ones renamed out of the way, and how to turn a frame derived
    from it back into the columns of `docs`."""
    names = {c: c if c in needed else f"_kept{k}_" for k, c in enumerate(docs.columns)}
    aside = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return aside, lambda df: df.select(*[F.col(n).alias(c) for c, n in names.items()])


def set_aside(docs: DataFrame, needed: list[str], replaced: list[str]) -> tuple[DataFrame, list[Column]]:
    """`docs` without the columns named like a replaced one, every column that is not needed renamed out of the
    way; and the columns that give these their names back."""
    names = {c: c if c in needed else f"_kept{k}_" for k, c in enumerate(docs.columns) if c.lower() not in replaced}
    return (docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]),
            [F.col(f"`{n}`").alias(c) for c, n in names.items()])


def parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running_total(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """Exact running total of `value` in a global order, written as a table.

    The rows are range-sorted, so a frequent leading key is cut by the keys after it. Each range is
    summed on its own; the totals of the ranges before it (one small row each) are added.
    """
    ranged = materialise(
        df.repartitionByRange(parts(df), *order).withColumn("_part", F.spark_partition_id()), "ranged")
    ends = ranged.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (ranged.join(starts, "_part")
            .withColumn(out, F.col("_before") + F.sum(value).over(within))
            .drop("_part", "_before"))


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared store, as a URI that executors can open."""
    root = shared_folder(spark).rstrip("/")
    return f"{root if '://' in root or root.startswith('file:') else f'file://{root}'}/{name}-{uuid.uuid4().hex}"


def write_file(folder: str, name: str, chunks) -> str:
    """Write a file under a name no other attempt uses; the caller reports it once it is whole, and
    only reported files count. Returns its URI."""
    store, path = fs.FileSystem.from_uri(_uri(folder))
    store.create_dir(path, recursive=True)
    file = f"{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(f"{path}/{file}") as out:
        for chunk in chunks:
            out.write(chunk)
    return f"{folder}/{file}"


def open_file(uri: str):
    store, path = fs.FileSystem.from_uri(_uri(uri))
    return store.open_input_file(path)


def _uri(path: str) -> str:
    """Hadoop writes file:/x, Arrow wants file:///x."""
    return f"file://{path[5:]}" if path.startswith("file:/") and not path.startswith("file://") else path
