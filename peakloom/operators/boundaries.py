"""New peak boundaries from the summed trace of the kept fragments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakloom.functions import traces as tr
from peakloom.operators.cells import OK
from peakloom.schema import ANALYTE, CELL, FRAGMENT, LABEL, REP, RUN
from peakloom.session import co_partitioned, materialise


def peak_island(points: DataFrame, keys: Sequence[str], time: str, value: str, zone: str,
                edge_fraction: float) -> DataFrame:
    """(keys, left, right, apex_time, apex): the run of points around the apex that stay at or above
    `edge_fraction` of it. The apex is the largest value inside the zone, the earliest of ties.

    Only grouped minima and maxima, all combined map-side, and joins with one row per key: no task
    ever orders or holds the points of a key, however many there are.
    """
    keys = list(keys)
    points = points.select(*keys, F.col(time).alias("_t"), F.col(value).alias("_v"),
                           F.col(zone).alias("_z")).filter(F.col("_v").isNotNull())
    top = (points.filter("_z").groupBy(*keys).agg(F.max("_v").alias("apex")))
    apex = (points.join(top, keys).filter(F.col("_z") & (F.col("_v") == F.col("apex")))
            .groupBy(*keys, "apex").agg(F.min("_t").alias("apex_time")))
    below = F.col("_v") < F.col("apex") * F.lit(edge_fraction)
    cuts = points.join(apex, keys).groupBy(*keys, "apex", "apex_time").agg(
        F.max(F.when(below & (F.col("_t") < F.col("apex_time")), F.col("_t"))).alias("_lo"),
        F.min(F.when(below & (F.col("_t") > F.col("apex_time")), F.col("_t"))).alias("_hi"))
    after = F.col("_lo").isNull() | (F.col("_t") > F.col("_lo"))
    before = F.col("_hi").isNull() | (F.col("_t") < F.col("_hi"))
    return (points.join(cuts, keys).filter(after & before).groupBy(*keys, "apex", "apex_time")
            .agg(F.min("_t").alias("left"), F.max("_t").alias("right"))
            .select(*keys, "left", "right", "apex_time", "apex"))


def replicate_traces(traces: DataFrame, kept: DataFrame, zones: DataFrame) -> DataFrame:
    """Clean intensities of the kept fragments summed over fragments and labels: (analyte, replicate, points),
    an array of (t, v, z) in the order of the trace. The times and the zone are those of the first label of the
    replicate with a usable run; `zones` are those of `run_zones`.

    A run's traces are added point by point where they lie; what moves is one array per run, of which a
    replicate has one per label.
    """
    clean = tr.clamp_nonneg(tr.nan_to_zero(F.col("intens")))
    with co_partitioned(traces.sparkSession):
        rows = (traces.select(*CELL, "intens").join(run_members(zones, kept), CELL).distinct()
                .select(*RUN, F.posexplode(clean).alias("pos", "v")))
        added = rows.groupBy(*RUN, "pos").agg(F.sum("v").alias("v"))
        at = F.struct("pos", "v")
        sums = materialise(added.groupBy(*RUN).agg(F.map_from_entries(F.collect_list(at)).alias("sums")), "run-sums")
    usable = F.when(F.col("reason") == OK, F.struct(LABEL, "times", "zone"))
    both = (zones.join(sums, RUN, "left").groupBy(ANALYTE, REP)
            .agg(F.min(usable).alias("g"), F.collect_list("sums").alias("sums")))
    value = lambda pos: F.aggregate(
        F.transform("sums", lambda m: F.try_element_at(m, pos)), F.lit(None).cast("double"),
        lambda acc, v: F.when(acc.isNull(), v).when(v.isNull(), acc).otherwise(acc + v))
    points = F.transform(F.arrays_zip("g.times", "g.zone"), lambda p, pos: F.struct(
        p["times"].alias("t"), value(pos).alias("v"), (p["zone"] == 1).alias("z")))
    return both.filter(F.col("g").isNotNull()).select(ANALYTE, REP, F.filter(points, lambda p: p["v"].isNotNull()).alias("points"))


def run_members(zones: DataFrame, kept: DataFrame) -> DataFrame:
    """The cells of the kept fragments, every run with every kept fragment of its analyte."""
    return zones.select(*RUN).join(kept.select(ANALYTE, FRAGMENT), ANALYTE).select(*CELL)


def refine_boundaries(traces: DataFrame, edge_fraction: float) -> DataFrame:
    """(MinStartTime, MaxEndTime, replicate, analyte) from `replicate_traces`: the island of `peak_island`, found
    with array functions in one pass; null limits without signal."""
    top = F.array_max(F.transform(F.filter("points", lambda p: p["z"]), lambda p: p["v"]))
    apexes = F.filter("points", lambda p: p["z"] & (p["v"] == F.col("apex")))
    low = lambda p: p["v"] < F.col("apex") * F.lit(edge_fraction)
    times = lambda points: F.transform(points, lambda p: p["t"])
    rows = traces.withColumn("apex", top).filter(F.col("apex").isNotNull())
    rows = rows.withColumn("apex_time", F.array_min(times(apexes)))
    rows = rows.withColumns({
        "lo": F.array_max(times(F.filter("points", lambda p: low(p) & (p["t"] < F.col("apex_time"))))),
        "hi": F.array_min(times(F.filter("points", lambda p: low(p) & (p["t"] > F.col("apex_time")))))})
    rows = rows.withColumn("home", times(F.filter("points", lambda p: (
        (F.col("lo").isNull() | (p["t"] > F.col("lo"))) & (F.col("hi").isNull() | (p["t"] < F.col("hi")))))))
    limit = lambda value: F.when(F.col("apex") > 0, value)
    return rows.select(limit(F.array_min("home")).alias("MinStartTime"), limit(F.array_max("home")).alias("MaxEndTime"),
                       REP, ANALYTE)
