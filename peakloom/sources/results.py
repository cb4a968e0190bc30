"""Result files of the refinement and the report files, committed by a manifest.

Every write goes to a fresh folder. A commit then appends one row per name to the manifest: the name, its new
folder and a version; all names of a commit appear together, as the manifest is one small table written in one
job. Readers take the newest version of each name and look at nothing else, so a write that fails or is made
twice changes no result. Folders without a manifest, from elsewhere, are read by name pattern.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peakloom.schema import RESULTS

MANIFEST = "_manifest"
_ENTRY = "name string, folder string, version bigint"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(name, folder, version) of what is committed under `path`: the newest entry of each name."""
    try:
        rows = spark.read.schema(_ENTRY).parquet(f"{path}/{MANIFEST}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _ENTRY)
    newest = Window.partitionBy("name").orderBy(F.col("version").desc(), F.col("folder").desc())
    return rows.withColumn("_at", F.row_number().over(newest)).filter("_at = 1").drop("_at")


def _folders(spark: SparkSession, path: str) -> dict[str, str]:
    return {r["name"]: f"{path}/{r['folder']}" for r in manifest(spark, path).collect()}


def commit(spark: SparkSession, path: str, folders: dict[str, str]) -> None:
    """Make `folders` (name -> folder below `path`) the current ones, all at once."""
    last = manifest(spark, path).agg(F.max("version")).first()[0] or 0
    rows = [(name, folder, last + 1) for name, folder in folders.items()]
    spark.createDataFrame(rows, _ENTRY).coalesce(1).write.mode("append").parquet(f"{path}/{MANIFEST}")


def stage_results(df: DataFrame, path: str, kind: str, name_tag: str = "T") -> dict[str, str]:
    """Write one result kind as `;`-separated text without header or quotes; it counts once committed."""
    name = f"Report_GR_{kind}_{name_tag}"
    folder = f"{name}/run-{uuid.uuid4().hex}"
    (df.select(*RESULTS[kind].names).write.option("sep", ";").option("header", False).option("quote", "")
     .option("emptyValue", "").option("nullValue", "NA").csv(f"{path}/{folder}"))
    return {name: folder}


def write_results(df: DataFrame, path: str, kind: str, name_tag: str = "T") -> None:
    """Write and commit one result kind; what was there under this kind and tag is replaced."""
    commit(df.sparkSession, path, stage_results(df, path, kind, name_tag))


def read_results(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Union of the committed results of one kind, over all tags; without a manifest, of all files or folders
    whose name carries the kind."""
    text = (spark.read.schema(RESULTS[kind]).option("sep", ";").option("header", False)
            .option("quote", "").option("nullValue", "NA").option("recursiveFileLookup", True))
    committed = _folders(spark, path)
    if not committed:
        return text.csv(f"{path}/*Report_GR_{kind}_*")
    found = [folder for name, folder in committed.items() if name.startswith(f"Report_GR_{kind}_")]
    return text.csv(found) if found else spark.createDataFrame([], RESULTS[kind])


def write_report(df: DataFrame, path: str, name: str, glossary: DataFrame | None = None) -> None:
    """A report as CSV with header, committed under its name together with the analyte glossary, if given, as
    the run's completion table."""
    folders = {}
    for part, table in ((name, df), ("completed_analytes", glossary)):
        if table is not None:
            folders[part] = f"{part}/run-{uuid.uuid4().hex}"
            (table.write.option("header", True).option("quote", "").option("emptyValue", "")
             .csv(f"{path}/{folders[part]}"))
    commit(df.sparkSession, path, folders)


def read_report(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The text columns of the committed report of this name."""
    return spark.read.option("header", True).csv(_folders(spark, path)[name])
