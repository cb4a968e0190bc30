"""Refinement that continues where it left off: analytes whose rows did not change are not refined again."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakloom.config import RefineParams
from peakloom.plans.refine import TRACE_COLUMNS, refine_global
from peakloom.schema import ANALYTE, RESULTS
from peakloom.session import materialise, run_folder
from peakloom.sources import results

COMPLETED = "completed"
_PRINT = f"{ANALYTE} string, n bigint, total decimal(38,0), parity bigint, second bigint, params string"


def fingerprints(traces: DataFrame, params: RefineParams) -> DataFrame:
    """Per analyte: how many rows, and sum and exclusive-or of two row hashes. The order of the rows does not
    matter, repeated rows do, and everything is combined map-side: a frequent analyte is one row per task.
    `params` tells under which parameters it was refined."""
    columns = [F.col(c) for c in traces.columns if c != ANALYTE]
    how = hashlib.sha256(repr(params).encode()).hexdigest()[:16]
    rows = traces.select(ANALYTE, F.xxhash64(*columns).alias("_a"), F.xxhash64(F.lit(1), *reversed(columns)).alias("_b"))
    return rows.groupBy(ANALYTE).agg(
        F.count("*").alias("n"), F.sum(F.col("_a").cast("decimal(38,0)")).cast("decimal(38,0)").alias("total"),
        F.bit_xor("_a").alias("parity"), F.bit_xor("_b").alias("second")).withColumn("params", F.lit(how))


def completed(spark: SparkSession, path: str) -> DataFrame:
    """The fingerprints of the analytes that are done under `path`."""
    found = {r["name"]: r["folder"] for r in results.manifest(spark, path).collect()}
    if COMPLETED not in found:
        return spark.createDataFrame([], _PRINT)
    return spark.read.schema(_PRINT).parquet(f"{path}/{found[COMPLETED]}")


def changes(traces: DataFrame, params: RefineParams, path: str) -> tuple[DataFrame, DataFrame]:
    """(all fingerprints, the analytes to refine): those that are new or differ from the completed ones."""
    prints = materialise(fingerprints(traces, params), "fingerprints")
    done = completed(traces.sparkSession, path)
    same = prints.join(done, prints.columns, "left_semi")
    return prints, prints.join(same, ANALYTE, "left_anti").select(ANALYTE)


def refine_resumable(traces: DataFrame, params: RefineParams, path: str, columns: list[str] | None = None) -> int:
    """Refine what changed since the last run under `path` and commit all four result kinds and the completion
    table together; returns how many analytes were refined. Rows of analytes that are gone go too. A run that
    fails before its commit leaves the results of the last one."""
    spark = traces.sparkSession
    rows = traces.select(*(columns or TRACE_COLUMNS), *([c for c in traces.columns if c not in TRACE_COLUMNS]
                                                         if params.apply_prefilter and not columns else []))
    with run_folder(spark, "resume"):
        prints, todo = changes(rows, params, path)
        todo = materialise(todo, "todo")
        n = todo.count()
        unchanged = materialise(prints.join(todo, ANALYTE, "left_anti").select(ANALYTE), "unchanged")
        before = results.manifest(spark, path).count()
        folders: dict[str, str] = {}
        refined = refine_global(materialise(rows.join(todo, ANALYTE, "left_semi"), "changed"), params) if n else None
        for kind in RESULTS:
            old = results.read_results(spark, path, kind).join(unchanged, ANALYTE, "left_semi").select(
                *RESULTS[kind].names) if before else None
            new = {"PeakBoundaries": lambda: refined.boundaries, "Transitions": lambda: refined.transitions,
                   "Replicate": lambda: refined.replicates, "ReScore": lambda: refined.rescore}[kind]() if refined else None
            parts = [part.select(*RESULTS[kind].names) for part in (old, new) if part is not None]
            if parts:
                both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
                folders |= results.stage_results(both, path, kind, params.name_tag)
        folder = f"{COMPLETED}/run-{uuid.uuid4().hex}"
        prints.write.parquet(f"{path}/{folder}")
        results.commit(spark, path, {**folders, COMPLETED: folder})
    return n
