"""What the plans must not do."""

import pytest
from pyspark.sql import functions as F

from fixtures import random_traces
from peakloom.config import RefineParams
from peakloom.operators import boundaries as bd
from peakloom.operators import cells as ce
from peakloom.operators.prefilter import prefilter
from peakloom.plans import refine as rf
from peakloom.schema import ANALYTE, FRAGMENT, REP, RUN
from peakloom.session import clustered, co_partitioned

PARAMS = RefineParams()


def plan_of(df) -> str:
    """The physical plan before adaptive execution."""
    return df._jdf.queryExecution().sparkPlan().toString() + "\n" + df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def runs(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield clustered(random_traces(spark, {"a": 4, "b": 5}).select(*rf.TRACE_COLUMNS), "traces", RUN)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_zones_and_cells_need_no_shuffle_of_clustered_traces(runs):
    for rows in (ce.run_zones(ce.zoned_rows(runs)), ce.cut_cells(runs, PARAMS)):
        plan = plan_of(rows)
        assert "Exchange" not in plan and "SortAggregate" not in plan and plan.count("FileScan") <= 2


def test_rescoring_moves_the_limits_to_the_traces(spark, runs):
    kept = runs.select(ANALYTE, FRAGMENT).distinct()
    zones = ce.run_zones(ce.cut_cells(runs, PARAMS))
    limits = runs.select(ANALYTE, REP, "MinStartTime", "MaxEndTime").distinct()
    members = bd.run_members(zones, kept).join(limits, [ANALYTE, REP], "left")
    with co_partitioned(spark):
        cut = ce.cut_cells(runs.drop("MinStartTime", "MaxEndTime").join(members, [*RUN, FRAGMENT]), PARAMS)
        plan = cut._jdf.queryExecution().executedPlan().toString()
    # wide rows are scanned, sorted and joined in place: no exchange carries an array of the trace
    lines = [x for x in plan.splitlines() if "Exchange" in x]
    assert lines and not any("intens" in x for x in lines)
    above = plan[:plan.index("intens")]
    assert "Exchange" not in above


def test_prefilter_reads_its_rows_twice(runs):
    rows = runs.withColumns({
        "FragmentIon": F.concat(F.lit("y1"), F.substring(FRAGMENT, 2, 2)), "ProductCharge": F.lit(1),
        "ProductMz": F.hash(FRAGMENT).cast("double"), "ProteinName": F.lit("p"), "PeptideModifiedSequence": F.col(ANALYTE),
        "PrecursorCharge": F.lit(2), "IsDecoy": F.lit(False)})
    plan = prefilter(rows, PARAMS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange") <= 4
