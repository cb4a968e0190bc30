"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
# The open run folders, innermost last, and the clustered tables of the innermost.
_run_folders: ContextVar[tuple[str, ...]] = ContextVar("run_folders", default=())
_run_tables: ContextVar[list[str]] = ContextVar("run_tables", default=[])


def build_session(app: str = "peakloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans are written for.

    Skewed joins are split even where that costs another shuffle, and joins on (analyte, x) hash all
    their keys, so a very frequent analyte spreads over the tasks. Ids found in directory names stay
    text.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's checkpoint directory.

    Only a local master may fall back to a folder on this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="peakloom-")
        spark.sparkContext.setCheckpointDir(_local_folders[app])
    return _local_folders[app]


def new_path(spark: SparkSession, name: str, kept: bool = False) -> str:
    """A fresh path in the shared folder; never reused, so a rerun cannot mix with old files. Within a
    `run_folder` it lies there, unless it is to be kept."""
    scopes = _run_folders.get()
    root = scopes[-1] if scopes and not kept else shared_folder(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession, name: str = "run") -> Iterator[str]:
    """Intermediate tables written within are removed at the end, also after a failure; what is read later must
    be written as `kept`. Folders nest. Everything written is in the shared folder, so lost executors lose none."""
    path = new_path(spark, name)
    mark = _run_folders.set((*_run_folders.get(), path))
    tables: list[str] = []
    held = _run_tables.set(tables)
    try:
        yield path
    finally:
        _run_folders.reset(mark)
        _run_tables.reset(held)
        for table in tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours, whatever store it is in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialise(df: DataFrame, name: str, kept: bool = False) -> DataFrame:
    """Cut the lineage by writing a columnar table: it survives lost executors, and later readers
    load only the columns and row groups they need."""
    path = new_path(df.sparkSession, name, kept)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clustered(df: DataFrame, name: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """A written table bucketed by `keys`: one shuffle now, and none for later windows, aggregates and joins on
    these keys. `buckets` defaults to the shuffle partitions; give it by the size of the data."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    (df.repartition(n, *keys).write.bucketBy(n, *keys).option("path", path).saveAsTable(table))
    _run_tables.get().append(table)
    return spark.table(table)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Within, a tree of directories is listed by eight tasks a core, not by a task a directory."""
    with _setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism",
                  str(8 * spark.sparkContext.defaultParallelism)):
        yield


@contextmanager
def co_partitioned(spark: SparkSession) -> Iterator[None]:
    """Within, a join may use a partitioning on some of its keys, so that a clustered table stays in place. Plans
    must be run within; elsewhere joins hash all their keys, which spreads frequent ones."""
    with _setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        yield
