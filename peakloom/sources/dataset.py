"""The indexed dataset: partitioned writes, pruned reads, per-key CSV export."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakloom.schema import ANALYTE, CELL, GROUP
from peakloom.session import few_listing_tasks
from peakloom.sources.export import QUOTED
from peakloom.sources.folders import many_tasks, mounted, write_folders


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan a Parquet table; row groups are the splits."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_indexed(df: DataFrame, path: str, by: Sequence[str] = (GROUP,), mode: str = "overwrite",
                  files: int | None = None) -> None:
    """Write the dataset with one directory level per column of `by`. The partitions that occur in `df`
    are replaced, others stay, so a rerun changes nothing.

    Rows are range-partitioned on the directory columns and then on the cell, so an analyte (or a
    group) with very many rows is cut into several tasks and files, while the rows of one run stay
    together; each file is sorted, which lets a reader skip row groups by analyte. A directory per analyte
    makes so many files that tasks write them themselves where they can (`folders`).
    """
    order = list(dict.fromkeys([*by, *[name for name in CELL if name in df.columns]]))
    many = ANALYTE in by
    files = files or (many_tasks(df.sparkSession) if many else None)
    placed = (df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order))
    placed = placed.sortWithinPartitions(*order)
    if many and mode == "overwrite" and (plain := mounted(df, path, by)):
        return write_folders(placed, plain, by)
    (placed.write.mode(mode).partitionBy(*by)
     .option("partitionOverwriteMode", "dynamic").option("compression", "snappy").parquet(path))


def _gathered(df: DataFrame) -> DataFrame:
    """Many small files in few tasks: Spark counts every file as megabytes and opens a handful of them a task."""
    return df.coalesce(many_tasks(df.sparkSession))


def read_partition(spark: SparkSession, path: str, schema: T.StructType,
                   columns: Sequence[str] | None = None, **keys: object) -> DataFrame:
    """Rows whose directory columns equal `keys`. The schema is given, so ids such as `01234567`
    or `1e234567` in directory names stay text."""
    with few_listing_tasks(spark):
        df = spark.read.schema(schema).parquet(path)
    for name, value in keys.items():
        df = df.filter(F.col(name) == F.lit(value))
    return _gathered(df.select(*columns) if columns else df)


def export_partition_csv(df: DataFrame, path: str, key: str, value: object) -> None:
    """The rows of one key as CSV with header, in a folder named by the key."""
    (df.filter(F.col(key) == F.lit(value)).write.option("header", True).options(**QUOTED)
     .csv(f"{path}/data_analyte_{value}"))


def export_all_csv(df: DataFrame, path: str, key: str = ANALYTE,
                   glossary: DataFrame | None = None) -> None:
    """Every key in its own CSV directory by one distributed write, limited to the keys of the
    glossary if one is given. Range partitioning keeps a key's rows in few files and still cuts a
    very frequent key into several."""
    if glossary is not None:
        df = df.join(glossary.select(key).distinct(), key, "left_semi")
    order = list(dict.fromkeys([key, *[name for name in CELL if name in df.columns]]))
    plain = mounted(df, path, [key]) if key == ANALYTE else None
    if plain is None:
        return (df.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy(key)
                .option("header", True).options(**QUOTED).csv(path))
    os.makedirs(plain)
    placed = df.repartitionByRange(many_tasks(df.sparkSession), *order).sortWithinPartitions(*order)
    names = [name for name in df.columns if name != key]
    header = df.sparkSession.range(1).select(F.to_csv(F.struct(*[F.lit(name).alias(name) for name in names]), QUOTED))
    write_folders(placed.select(key, F.to_csv(F.struct(*names), QUOTED).alias("line")), plain, [key], header.first()[0])


def read_exported_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back what `export_all_csv` wrote."""
    with few_listing_tasks(spark):
        df = spark.read.schema(schema).option("header", True).options(**QUOTED).csv(path)
    return _gathered(df)
