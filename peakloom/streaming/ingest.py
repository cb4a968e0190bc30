"""Each arriving export file gets its ids once and is appended; glossaries stay free of duplicates.

`ingest_files` is the careful form. It streams over the names of the arriving files and handles each batch as
one step: files with a foreign header and rows that do not parse go to a table of rejects, the others arrive;
two originals with one hash, now or with any earlier batch, get two ids (`known_ids`); an id that still stands for two
originals stops the stream before a row is written.
Everything a batch writes lies in folders of its number, replaced when it is played again, and counts from the
moment the ledger lists the batch.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from peakloom.functions.keys import add_ids, id_texts, long_id
from peakloom.operators.glossary import KINDS, id_collisions
from peakloom.schema import EXPORT, EXPORT_HEADER, GLOSSARIES, GROUP
from peakloom.session import materialise, run_folder
from peakloom.sources.export import QUOTED, coerce_types, normalise_names, text_schema

# Distinct glossary rows are kept on disk, not on the heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_export(spark: SparkSession, src: str, n_groups: int = 6, files_per_trigger: int = 64,
                  header: Sequence[str] = EXPORT_HEADER, schema: T.StructType = EXPORT) -> DataFrame:
    """Streaming rows of the export files that arrive in the folder `src`, typed and with ids. A file
    with other columns, or the same in another order, fails the stream."""
    raw = (spark.readStream.schema(text_schema(header)).option("header", True)
           .option("enforceSchema", False).options(**QUOTED)
           .option("maxFilesPerTrigger", files_per_trigger).csv(src))
    return add_ids(coerce_types(normalise_names(raw), schema), n_groups)


def stream_ingest(rows: DataFrame, dst: str, checkpoint: str,
                  by: Sequence[str] = (GROUP,)) -> StreamingQuery:
    """Append the stream to the partitioned dataset; the checkpoint makes a restart write each file
    exactly once. Processes what has arrived, then stops."""
    return (rows.writeStream.format("parquet").partitionBy(*by).outputMode("append")
            .option("path", dst).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_glossary(rows: DataFrame, kind: str, dst: str, checkpoint: str,
                    columns: Sequence[str] | None = None) -> StreamingQuery:
    """Append only the glossary rows not seen before; the state holds the distinct rows, which grow
    with the dimension and not with the traces."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    unique = rows.select(*(columns or GLOSSARIES[kind])).dropDuplicates()
    return (unique.writeStream.format("parquet").outputMode("append").option("path", dst)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


# Tables of an ingest beside its rows, each with a folder per batch.
REJECTS = "batch string, file string, reason string, line string"
ORIGINALS = "batch string, kind string, id string, original string"
LEDGER = "batch string, files bigint, rejected_files bigint"
_BAD = "_bad"


def _table(spark: SparkSession, dst: str, name: str, schema: str) -> DataFrame:
    """What all batches wrote to a table so far; empty before the first."""
    try:
        return spark.read.schema(schema).parquet(f"{dst}/{name}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _committed(spark: SparkSession, dst: str, name: str, schema: str) -> DataFrame:
    """The same without batches the ledger does not list."""
    ledger = _table(spark, dst, "ledger", LEDGER).select("batch").distinct()
    return _table(spark, dst, name, schema).join(ledger, "batch", "left_semi")


def read_ingested(spark: SparkSession, dst: str, schema: T.StructType) -> DataFrame:
    """The rows of all committed batches."""
    with_batch = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
    return _committed(spark, dst, "rows", with_batch).select(*schema.names)


def read_rejects(spark: SparkSession, dst: str) -> DataFrame:
    """Files and lines that did not arrive, and why."""
    return _committed(spark, dst, "rejects", REJECTS)


def read_files(spark: SparkSession, files: Sequence[str], header: Sequence[str], schema: T.StructType,
               n_groups: int) -> tuple[DataFrame, DataFrame]:
    """(typed rows with ids, rejected lines as (file, line)) of export files with this header; the files are
    parsed once."""
    texts = T.StructType([*text_schema(header).fields, T.StructField(_BAD, T.StringType())])
    # a line with too many or too few fields, or an open quote, is kept whole beside the parsed columns
    raw = (spark.read.schema(texts).option("header", True).options(**QUOTED).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", _BAD).csv(list(files)))
    raw = materialise(raw.select("*", F.col("_metadata.file_path").alias("_file")), "parsed")
    rows = raw.filter(F.col(_BAD).isNull()).drop(_BAD, "_file")
    bad = raw.filter(F.col(_BAD).isNotNull()).select(F.col("_file").alias("file"), F.col(_BAD).alias("line"))
    return add_ids(coerce_types(normalise_names(rows), schema), n_groups), bad


def _original(kind: str) -> Column:
    return F.to_json(F.struct(*GLOSSARIES[kind][1:]))


def originals(rows: DataFrame) -> DataFrame:
    """(kind, id, original) of every id of the rows."""
    parts = [F.struct(F.lit(kind).alias("kind"), F.col(GLOSSARIES[kind][0]).alias("id"), _original(kind).alias("original"))
             for kind in KINDS]
    return rows.select(F.explode(F.array(*parts)).alias("o")).select("o.*").distinct()


def known_ids(rows: DataFrame, old: DataFrame) -> DataFrame:
    """The rows with an id for every original: those of earlier batches (`old`) keep theirs. Of several new ones with
    one hash the first gets it if it is free, the others get the `long_id`."""
    for kind in KINDS:
        key = GLOSSARIES[kind][0]
        text = id_texts(rows)[key]
        new = rows.select(F.col(key).alias("id"), _original(kind).alias("original"), long_id(key, text).alias("long")).distinct()
        taken = old.filter(F.col("kind") == kind).select("id", F.col("original").alias("holder"))
        same = F.col("holder") == F.col("original")
        first = Window.partitionBy("id").orderBy("original")
        later = materialise(
            new.join(taken, "id", "left").groupBy("id", "original", "long").agg(
                F.count("holder").alias("holders"), F.count_if(same).alias("own"))
            .withColumn("nth", F.row_number().over(first))
            .filter((F.col("own") == 0) & ((F.col("nth") > 1) | (F.col("holders") > 0)) & (F.col("long") != F.col("id"))), "later")
        if not later.isEmpty():
            columns = rows.columns
            rows = rows.withColumn("_original", _original(kind)).join(
                later.select(F.col("id").alias(key), F.col("original").alias("_original"), "long"), [key, "_original"],
                "left").withColumn(key, F.coalesce("long", key)).select(*columns)
    return rows


def ingest_batch(spark: SparkSession, files: Sequence[str], batch: str, dst: str, n_groups: int = 6,
                 by: Sequence[str] = (GROUP,), header: Sequence[str] = EXPORT_HEADER,
                 schema: T.StructType = EXPORT) -> None:
    """One batch of files, at most as many as a trigger takes. Played again under its name, it changes nothing."""
    if not _table(spark, dst, "ledger", LEDGER).filter(F.col("batch") == batch).isEmpty():
        return

    def write(df: DataFrame, name: str, by: Sequence[str] = ()) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(
            f"{dst}/{name}/batch={batch}")

    def first_line(file: str) -> str:
        head = spark.read.text(file).first()
        return "" if head is None else head[0].removeprefix("\ufeff").rstrip("\r")
    expected = {",".join(header), ",".join(f'"{name}"' for name in header)}
    heads = {file: first_line(file) for file in files}
    good = [file for file, head in heads.items() if head in expected]
    foreign = [(file, "foreign header" if head else "empty file", head) for file, head in heads.items() if head not in expected]
    rejects = spark.createDataFrame(foreign, "file string, reason string, line string")
    with run_folder(spark, "batch"):
        if good:
            rows, bad = read_files(spark, good, header, schema, n_groups)
            old = _committed(spark, dst, "originals", ORIGINALS).select("kind", "id", "original")
            rows = known_ids(rows, old)
            new = materialise(originals(rows), "originals")
            both = new.unionByName(old.join(new.select("kind", "id").distinct(), ["kind", "id"], "left_semi"))
            key = F.concat_ws(" ", "kind", "id").alias("key")
            clash = id_collisions(both.select(key, "original"), "key").limit(20).collect()
            if clash:
                raise ValueError(f"ids that stand for several originals: {', '.join(sorted(r['key'] for r in clash))}")
            write(rows, "rows", by)
            write(new.join(old, ["kind", "id", "original"], "left_anti"), "originals")
            rejects = rejects.unionByName(bad.select("file", F.lit("line does not parse").alias("reason"), "line"))
        write(rejects, "rejects")
    write(spark.createDataFrame([(len(files), len(foreign))], "files bigint, rejected_files bigint").coalesce(1), "ledger")


def ingest_files(spark: SparkSession, src: str, dst: str, checkpoint: str, n_groups: int = 6,
                 files_per_trigger: int = 64, by: Sequence[str] = (GROUP,), glob: str = "*.csv") -> StreamingQuery:
    """Takes the export files that have arrived in `src`, batch by batch, then stops. Only the files' names are
    streamed; their contents are read by the batch."""
    binary = "path string, modificationTime timestamp, length bigint, content binary"
    names = (spark.readStream.format("binaryFile").schema(binary).option("pathGlobFilter", glob)
             .option("maxFilesPerTrigger", files_per_trigger).load(src).select("path"))

    started, ids = threading.Event(), []

    def step(arrived: DataFrame, batch: int) -> None:
        files = sorted(r["path"] for r in arrived.collect())
        started.wait()
        if files:
            ingest_batch(arrived.sparkSession, files, f"{ids[0]}-{batch}", dst, n_groups, by)
    query = (names.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    # the id lives in the checkpoint: a restart keeps it, a new checkpoint numbers its batches anew
    ids.append(query.id)
    started.set()
    return query
