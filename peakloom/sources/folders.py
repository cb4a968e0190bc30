"""A directory per key, for keys by the hundred thousand, on a file system that is mounted on every executor.

Spark's writer spends tens of milliseconds on every file there (Hadoop starts three processes a file to set rights
where its native library is missing) and moves them one by one. Here a task writes the files of its keys itself, into
a folder of its attempt; only the folders of finished attempts are taken, so a task that is tried again leaves nothing.
Names and contents are those of Spark's writer. Other stores keep Spark's writer.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_KEYS = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# The folder of a task, and the directories of its first and last key.
_DONE = "folder string, first string, last string"


def mounted(df: DataFrame, path: str, by: Sequence[str]) -> str | None:
    """The plain path if `path` lies on a mounted file system and `df` can be written there by this module: its keys
    are texts or whole numbers, and there are columns besides."""
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    plain = all(isinstance(df.schema[name].dataType, _KEYS) for name in by) and len(df.columns) > len(by)
    return store.makeQualified(place).toUri().getPath() if plain and store.getUri().getScheme() == "file" else None


def many_tasks(spark: SparkSession) -> int:
    """For work that goes by files and not by bytes, which adaptive execution would merge into few tasks."""
    return max(8 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _files(root: str, mark: str, by: Sequence[str], header: str | None):
    """A `mapInArrow` function over rows that come key by key: it writes a file for each key and gives the name of the
    folder they are in and the directories of its first and last key. With a header the only other column holds lines of text, else the files are Parquet. Nothing
    of this package is referenced inside, so executors need only pyarrow."""
    def run(batches):
        import os
        import re
        import uuid

        import pyarrow as pa
        import pyarrow.parquet as pq

        own, now, out, file = uuid.uuid4().hex, None, None, None
        ends = []

        def part(name, value):
            if value is None or value == "":
                return f"{name}=__HIVE_DEFAULT_PARTITION__"
            escaped = re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda x: f"%{ord(x[0]):02X}", str(value))
            return f"{name}={escaped}"

        def opened(key, schema):
            leaf = "/".join(map(part, by, key))
            ends[min(len(ends), 1):] = [leaf]
            folder = f"{root}/{own}/{leaf}"
            os.makedirs(folder, exist_ok=True)
            if header is None:
                file = open(f"{folder}/{mark}{own}.snappy.parquet", "wb")
                return file, pq.ParquetWriter(file, schema, compression="snappy")
            file = open(f"{folder}/{mark}{own}.csv", "w", encoding="utf-8", newline="")
            file.write(header + "\n")
            return file, file

        def closed(file, out):
            out.close()
            file.close()
        for batch in batches:
            keys = list(zip(*[batch.column(name).to_pylist() for name in by]))
            rest = batch.select([name for name in batch.schema.names if name not in by])
            start = 0
            for stop in range(1, len(keys) + 1):
                if stop < len(keys) and keys[stop] == keys[start]:
                    continue
                if out is None or keys[start] != now:
                    if out is not None:
                        closed(file, out)
                    now = keys[start]
                    file, out = opened(now, rest.schema)
                some = rest.slice(start, stop - start)
                if header is None:
                    out.write_batch(some)
                else:
                    out.writelines(line + "\n" for line in some.column(0).to_pylist())
                start = stop
        if out is not None:
            closed(file, out)
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (own, ends[0], ends[-1])], names=["folder", "first", "last"])

    return run


def _moves(root: str, path: str, mark: str, depth: int, ends: bool):
    """A `mapInArrow` function over (folder, first, last): it moves what those folders hold to its place below `path`,
    `ends` alone or all that is left, and removes what that replaces. Nothing of this package is referenced inside."""
    def run(batches):
        import os
        import shutil
        import uuid

        def leaves(top, depth):
            with os.scandir(top) as entries:
                for entry in entries:
                    if depth == 1:
                        yield entry.name
                    else:
                        yield from (f"{entry.name}/{leaf}" for leaf in leaves(entry.path, depth - 1))

        def put(src, dst, aside):
            try:
                return os.rename(src, dst)
            except FileNotFoundError:
                if not os.path.isdir(src):  # moved by an earlier attempt
                    return None
                os.makedirs(os.path.dirname(dst), exist_ok=True)
                return put(src, dst, aside)
            except OSError:  # there is one: it is replaced, or joined if this write made it
                if not any(name.startswith(mark) for name in os.listdir(dst)):
                    os.rename(dst, f"{aside}/{uuid.uuid4().hex}")
                    return os.rename(src, dst)
            for name in os.listdir(src):
                os.rename(f"{src}/{name}", f"{dst}/{name}")
        for batch in batches:
            for row in batch.to_pylist():
                own = f"{root}/{row['folder']}"
                aside = f"{own}-replaced"
                os.makedirs(aside, exist_ok=True)
                for leaf in {row["first"], row["last"]} if ends else leaves(own, depth):
                    put(f"{own}/{leaf}", f"{path}/{leaf}", aside)
                shutil.rmtree(aside, ignore_errors=True)
        yield from ()

    return run


def write_folders(df: DataFrame, path: str, by: Sequence[str], header: str | None = None) -> None:
    """The rows of `df`, range-partitioned and sorted by the keys `by`, into a directory per key below the plain path
    `path`. The directories of the keys that occur are replaced when all files are written, others stay. A key that is
    cut over partitions has a file of each."""
    spark, write = df.sparkSession, uuid.uuid4().hex
    staging, mark = f"{path}/.staging-{write}", f"part-{write}-"
    os.makedirs(staging)
    try:
        done = df.mapInArrow(_files(staging, mark, tuple(by), header), _DONE).collect()
        if done:
            # only a first or last key can be in several partitions: those are moved one by one, the others side by side
            for ends, n in ((True, 1), (False, len(done))):
                spark.createDataFrame(done, _DONE).repartition(n).mapInArrow(
                    _moves(staging, path, mark, len(by), ends), _DONE).collect()
    finally:
        shutil.rmtree(staging, ignore_errors=True)
