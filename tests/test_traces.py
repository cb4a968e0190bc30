import pytest
from pyspark.sql import functions as F

from fixtures import golden
from peakloom.config import RefineParams
from peakloom.functions import scores as sc
from peakloom.functions import traces as tr
from peakloom.operators import cells as ce
from peakloom.schema import ANALYTE, FRAGMENT, LABEL, REP


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def doubles(*values):
    return F.array(*[F.lit(v).cast("double") for v in values])


def test_parse(spark):
    assert one(spark, tr.parse_trace(F.lit("1, 2.5,#N/A, 1e3"))) == [1.0, 2.5, None, 1000.0]


@pytest.mark.parametrize("flags, want", [([0, 1, 0], [1, 1, 0]), ([1, 0, 0], [1, 1, 0]), ([0, 1, 1, 0], [0, 1, 1, 0]),
                                         ([0, 0], [0, 0]), ([1], [1])])
def test_widen_single_point(spark, flags, want):
    assert one(spark, tr.widen_single_point(F.array(*[F.lit(f) for f in flags]))) == want


def test_zone_is_inclusive_at_five_decimals(spark):
    zone = tr.integration_zone(doubles(0.999994, 0.999996, 1.5, 2.000004, 2.000006), F.lit(1.0), F.lit(2.0))
    assert one(spark, zone) == [0, 1, 1, 1, 0]


def test_all_zero_trace_is_null(spark):
    assert one(spark, tr.normalise_trace(doubles(0, 0))) == [None, None]


def test_weighted_mean_null_rules(spark):
    mean = lambda e, w: one(spark, tr.weighted_abs_mean(e, w))
    assert mean(doubles(-1, 3), doubles(1, 1)) == 2.0
    assert mean(doubles(-1, None), doubles(1, 5)) == 1.0
    assert mean(doubles(-1, 3), doubles(1, None)) is None
    assert mean(doubles(1), doubles(0)) is None


def test_mass_error_score(spark):
    score = lambda m: one(spark, sc.mass_error_score(F.lit(m).cast("double"), 5.0, 10.0))
    assert [score(m) for m in (2.0, 5.0, 10.0, 11.0, None)] == [1.0, 1.0, 0.0, 0.0, None]
    assert score(7.111111) == pytest.approx(0.577778, abs=1e-6)


def test_composite(spark):
    value = one(spark, sc.composite_score(F.lit(0.9), F.lit(0.95), F.lit(1.0), F.lit(0.98)))
    assert value == pytest.approx(0.28885, abs=1e-5)
    assert one(spark, sc.composite_score(F.lit(0.9), F.lit(-0.1), F.lit(1.0), F.lit(0.98))) is None


def test_na_text(spark):
    text = lambda v: one(spark, sc.na_text(F.lit(v).cast("double")))
    assert [text(v) for v in (12.5, 100.0, None, float("nan"))] == ["12.5", "100", "#N/A", "#N/A"]
    for value in (3.2e-7, 0.1234567891, 12345678.5, 1e33, -1e-300, 2 / 3, 1e7):
        assert float(text(value)) == value


def test_golden_cells(spark):
    cells = {r[FRAGMENT]: r for r in ce.build_cells(golden(spark), RefineParams()).collect()}
    assert cells["y5"].x == [40.0, 100.0, 50.0] and cells["y6"].x == [40.0, 100.0, 50.0]
    assert cells["b3"].x == pytest.approx([100.0, 33.333333, 16.666667], abs=1e-5)
    assert [cells[f].mean_err for f in ("y5", "y6", "b3")] == pytest.approx([2.052632, 1.0, 14.111111], abs=1e-6)
    assert [cells[f].err_score for f in ("y5", "y6", "b3")] == [1.0, 1.0, 0.0]
    assert [cells[f].code for f in ("b3", "y5", "y6")] == [0, 1, 2]
    ratio = ce.total_to_max(golden(spark)).first()["total_to_max"]
    assert ratio == pytest.approx(1.66)
    dot = lambda a, b: tr.dot(doubles(*a), doubles(*b))
    area, lib = (500, 240, 90), (8, 4, 1)
    assert one(spark, sc.cosine(dot(area, lib), dot(area, area), dot(lib, lib))) == pytest.approx(0.998646, abs=1e-6)


def test_duplicates_conflicts_and_quarantine(spark):
    base = golden(spark)
    cells = ce.build_cells(base.unionByName(base), RefineParams())
    assert cells.count() == 3 and ce.quarantine(cells).count() == 0
    other = base.withColumn("Area", F.col("Area") + 1)
    clash = ce.build_cells(base.unionByName(other), RefineParams())
    assert [r.reason for r in ce.quarantine(clash).collect()] == ["conflicting duplicate rows"]
    assert ce.usable_cells(clash).count() == 0
    unlimited = base.withColumn("MinStartTime", F.lit(None).cast("double")).withColumn(REP, F.lit("r2"))
    ragged = base.withColumn("intens", F.when(F.col(FRAGMENT) == "y5", F.slice("intens", 1, 4))
                             .otherwise(F.col("intens"))).withColumn(REP, F.lit("r3"))
    outside = base.withColumns({"MinStartTime": F.lit(20.0), "MaxEndTime": F.lit(21.0)}).withColumn(REP, F.lit("r4"))
    mixed = ce.build_cells(base.unionByName(unlimited).unionByName(ragged).unionByName(outside), RefineParams())
    assert {r[REP]: r.reason for r in ce.quarantine(mixed).collect()} == {
        "r2": "no integration limits", "r3": "unequal trace lengths", "r4": "empty integration zone"}
    assert {r[REP] for r in ce.usable_cells(mixed).collect()} == {"r"}


def test_library_rank_ties_and_first_run(spark):
    rows = [("a", "r1", "light", "f1", 5.0), ("a", "r1", "light", "f2", 9.0), ("a", "r1", "light", "f3", 9.0),
            ("a", "r1", "light", "f4", None), ("a", "r0", "light", "f2", 1.0), ("a", "r1", "heavy", "f1", 7.0)]
    df = spark.createDataFrame(rows, f"{ANALYTE} string, {REP} string, {LABEL} string, {FRAGMENT} string, LibraryIntensity double")
    got = {r[FRAGMENT]: (r.lib, r.Rank) for r in ce.library_rank(df).collect()}
    # the first row by fragment, replicate and label is (f1, r1, heavy)
    assert got == {"f1": (7.0, 1)}
    light = {r[FRAGMENT]: r.Rank for r in ce.library_rank(df.filter(f"{LABEL} = 'light'")).collect()}
    assert light == {"f2": 1, "f3": 1, "f1": 3, "f4": 4}
