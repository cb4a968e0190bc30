import random

import pytest
from pyspark.sql import functions as F

from fixtures import quantile
from peakloom.config import RefineParams
from peakloom.operators import boundaries as bd
from peakloom.operators import prefilter as pf
from peakloom.operators import reports, selection
from peakloom.operators.quantiles import grouped_quantiles, order_statistics
from peakloom.schema import ANALYTE, FRAGMENT, LABEL, REP


@pytest.mark.parametrize("hot_rows", [10_000_000, 500, 5])
def test_grouped_quantiles_hot_and_small(spark, hot_rows):
    rng = random.Random(3)
    rows = [("hot", rng.choice([rng.random(), 0.5, 0.25])) for _ in range(4000)]
    rows += [(f"k{i % 40}", rng.random()) for i in range(400)] + [("k1", None), ("k1", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.q1, r.q2, r.q3) for r in grouped_quantiles(
        df, ["k"], {"q1": ("v", 0.25), "q2": ("v", 0.5), "q3": ("v", 0.99)}, hot_rows).collect()}
    assert got.pop("none") == (None, None, None)
    groups: dict = {}
    for key, value in rows:
        if value is not None and value == value:
            groups.setdefault(key, []).append(value)
    assert set(got) == set(groups)
    for key, values in groups.items():
        assert got[key] == pytest.approx([quantile(values, q) for q in (0.25, 0.5, 0.99)], abs=1e-12)


def test_order_statistics_of_all_kinds_of_doubles(spark):
    values = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 1e308, -1e308, float("inf"), float("-inf"), 0.1, 0.1 + 1e-17, 2.5, 2.5]
    rows = spark.createDataFrame([("k", v) for v in values] + [("one", 7.0)], "k string, v double")
    ranks = spark.createDataFrame([("k", r) for r in range(len(values))] + [("one", 0)], "k string, r bigint")
    got = {(r.k, r.r): r.v for r in order_statistics(rows, ["k"], "v", ranks, "r").collect()}
    assert got == {**{("k", r): v for r, v in enumerate(sorted(values))}, ("one", 0): 7.0}


def test_peak_island_brute_force(spark):
    rng = random.Random(5)
    rows = [(k, t, float(rng.randint(0, 20)), 3 <= t <= 12) for k in range(30) for t in range(16)]
    df = spark.createDataFrame(rows, "k int, t int, v double, z boolean")
    got = {r.k: (r.left, r.right, r.apex_time, r.apex) for r in bd.peak_island(df, ["k"], "t", "v", "z", 0.4).collect()}
    for k in range(30):
        v = {t: value for key, t, value, _ in rows if key == k}
        apex_t = max((t for t in range(3, 13)), key=lambda t: (v[t], -t))
        limit, left, right = v[apex_t] * 0.4, apex_t, apex_t
        while left - 1 in v and v[left - 1] >= limit:
            left -= 1
        while right + 1 in v and v[right + 1] >= limit:
            right += 1
        assert got[k] == (left, right, apex_t, v[apex_t])


def export_rows(spark, rows):
    return spark.createDataFrame(rows, f"""ProteinName string, PeptideModifiedSequence string, PrecursorCharge bigint,
        IsDecoy boolean, {LABEL} string, FragmentIon string, ProductCharge bigint, ProductMz double, MinStartTime double,
        {ANALYTE} string, {FRAGMENT} string, {REP} string""")


def test_prefilters(spark):
    row = lambda ion, label, mz, start=1.0, protein="P": (
        protein, "PEP", 2, False, label, ion, 1, mz, start, "a", ion, "r")
    rows = [row("y5", "light", 1.0), row("y5", "heavy", 2.0), row("y6", "light", 3.0), row("y6", "heavy", 4.0),
            row("b4", "light", 5.0), row("b4", "heavy", 5.0), row("y7", "light", 6.0), row("y2", "light", 7.0),
            row("precursor [M+1]", "light", 8.0), row("y8 -18", "light", 9.0, None), row("y31", "heavy", 10.0)]
    df = export_rows(spark, rows)
    ions = lambda out: sorted({r.FragmentIon for r in out.collect()})
    assert ions(pf.drop_unintegrated(df)) == ["b4", "precursor [M+1]", "y2", "y31", "y5", "y6", "y7"]
    assert ions(pf.drop_low_ordinal(df, 3)) == ["b4", "y31", "y5", "y6", "y7", "y8 -18"]
    assert ions(pf.require_all_labels(df)) == ["b4", "y5", "y6"]
    assert "b4" not in ions(pf.drop_shared_signals(df))
    # fragments are counted before shared signals go, so three still count although two are left
    assert ions(pf.prefilter(df, RefineParams())) == ["y5", "y6"]
    assert ions(pf.prefilter(df, RefineParams(min_initial_fragments=4))) == []
    assert ions(pf.prefilter(df, RefineParams(remove_shared_signals=False))) == ["b4", "y5", "y6"]


def test_prefilter_matches_missing_keys(spark):
    rows = [(None, "PEP", None, None, "light", f"y{i}", 1, float(i), 1.0, "a", f"y{i}", "r") for i in range(4, 8)]
    assert pf.prefilter(export_rows(spark, rows), RefineParams()).count() == 4


def test_number_to_remove(spark):
    counts = spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 8, 20)], "n bigint")
    got = [r.k for r in counts.select(selection.number_to_remove(F.col("n"), RefineParams()).alias("k")).collect()]
    assert got == [0, 0, 0, 1, 2, 5]


def test_reports_keep_rows_without_partner(spark):
    locators = spark.createDataFrame([("t1", "f1", "a"), ("t2", "f2", "a")], f"TransitionLocator string, {FRAGMENT} string, {ANALYTE} string")
    kept = spark.createDataFrame([("f1", "a"), ("f9", "a")], f"{FRAGMENT} string, {ANALYTE} string")
    out = {(r.ElementLocator, r.Quantitative) for r in reports.report_transitions(kept, locators).collect()}
    assert out == {("t1", True), ("t2", False), (None, True)}

    scores = spark.createDataFrame([("a", "light", "r", 0.9, 0.98, 0.95, 1.0, 1.0, "f.GlobalRefinement")],
                                   f"{ANALYTE} string, {LABEL} string, {REP} string, SimilarityScore double, MPRAScore double, "
                                   "Librarydotp double, IntensityScore double, ScoreMassError double, Comment string")
    analytes = spark.createDataFrame([("a", "P", "PEP", None, False)], f"{ANALYTE} string, ProteinName string, "
                                     "PeptideModifiedSequence string, PrecursorCharge bigint, IsDecoy boolean")
    reps = spark.createDataFrame([("r", "x.raw")], f"{REP} string, FileName string")
    precursors = spark.createDataFrame(
        [("p1", "P", "PEP", "light", None, False, "x.raw"), ("p2", "P", "PEP", "heavy", None, False, "x.raw")],
        f"PrecursorResultLocator string, ProteinName string, PeptideModifiedSequence string, {LABEL} string, "
        "PrecursorCharge bigint, IsDecoy boolean, FileName string")
    table = reports.report_annotations(scores, analytes, reps, precursors, tag="X_")
    got = {r.ElementLocator: r.annotation_X_Score for r in table.collect()}
    assert got["p2"] == "#N/A" and float(got["p1"]) == pytest.approx(0.28885, abs=1e-5)
    limits = spark.createDataFrame([(None, 12.5, "r", "a")], f"MinStartTime double, MaxEndTime double, {REP} string, {ANALYTE} string")
    row = reports.report_boundaries(limits, analytes, reps).first()
    assert (row.FileName, row.MinStartTime, row.MaxEndTime, row.PrecursorIsDecoy) == ("x.raw", "#N/A", "12.5", False)
