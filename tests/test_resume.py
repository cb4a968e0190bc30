"""Resumed runs, and what a run leaves behind."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fixtures import random_traces
from peakloom.config import RefineParams
from peakloom.plans import refine as rf
from peakloom.plans import resume
from peakloom.schema import ANALYTE, REP, RESULTS, RUN
from peakloom.session import clustered, materialise, run_folder, shared_folder
from peakloom.sources import results

PARAMS = RefineParams()


@pytest.fixture(scope="module")
def traces(spark):
    return materialise(random_traces(spark, {"a": 4, "b": 5, "c": 2}), "traces")


def rows_of(df):
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())


def test_a_fingerprint_ignores_order_and_tells_changes(spark, traces):
    prints = lambda df, params=PARAMS: {r[ANALYTE]: tuple(r) for r in resume.fingerprints(df, params).collect()}
    base = prints(traces)
    assert prints(traces.repartition(7).orderBy(F.desc(REP))) == base
    other = prints(traces.withColumn("Area", F.when(F.col(ANALYTE) == "b", F.col("Area") + 1e-9).otherwise(F.col("Area"))))
    assert other["a"] == base["a"] and other["b"] != base["b"]
    assert prints(traces.unionByName(traces.filter(f"{ANALYTE} = 'a'")))["a"] != base["a"]
    assert prints(traces, RefineParams(edge_fraction=0.1))["a"] != base["a"]


def test_only_changed_analytes_are_refined_again(spark, traces, tmp_path):
    path = str(tmp_path / "out")
    assert resume.refine_resumable(traces.filter(f"{ANALYTE} <> 'c'"), PARAMS, path) == 2
    changed = traces.withColumn("Area", F.when(F.col(ANALYTE) == "b", F.col("Area") * 2).otherwise(F.col("Area")))
    assert resume.refine_resumable(changed, PARAMS, path) == 2  # b changed, c is new
    assert resume.refine_resumable(changed, PARAMS, path) == 0
    full = rf.refine_global(changed, PARAMS)
    tables = {"PeakBoundaries": full.boundaries, "Transitions": full.transitions, "Replicate": full.replicates,
              "ReScore": full.rescore}
    for kind, table in tables.items():
        assert rows_of(results.read_results(spark, path, kind)) == rows_of(table.select(*RESULTS[kind].names))
    # an analyte that is gone leaves no results
    assert resume.refine_resumable(changed.filter(f"{ANALYTE} <> 'a'"), PARAMS, path) == 0
    assert {r[ANALYTE] for r in results.read_results(spark, path, "ReScore").collect()} == {"b", "c"}


def test_a_run_leaves_only_its_results(spark, traces):
    root = Path(shared_folder(spark).removeprefix("file://").removeprefix("file:"))
    before = {p.name for p in root.iterdir()}
    tables = {t.name for t in spark.catalog.listTables()}
    done = rf.refine_global(traces, PARAMS)
    left = sorted(p.name.rsplit("-", 1)[0] for p in root.iterdir() if p.name not in before)
    assert left == ["account", "boundaries", "rescored", "rows", "rows", "rows-a", "transitions"]
    assert {t.name for t in spark.catalog.listTables()} == tables
    assert done.rescore.count() and done.replicates.count() and done.account.count() == traces.select(*RUN).distinct().count()


def test_a_failed_run_leaves_nothing(spark, traces):
    with pytest.raises(ZeroDivisionError):
        with run_folder(spark) as folder:
            table = clustered(traces, "some", RUN)
            assert table.count() == traces.count() and Path(folder.removeprefix("file:")).exists()
            1 / 0
    assert not Path(folder.removeprefix("file:")).exists()
