"""From raw traces to one compact row per cell (analyte, replicate, label, fragment)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peakloom.config import RefineParams
from peakloom.functions import traces as tr
from peakloom.functions.scores import mass_error_score
from peakloom.schema import ANALYTE, CELL, FRAGMENT, LABEL, REP, RUN
from peakloom.session import materialise

OK = "ok"


def zoned_rows(traces: DataFrame) -> DataFrame:
    """Every row with its run's `zone` and `times`, those of the limits and times of the run's first fragment,
    `reason` (`ok` or why the run is unusable) and `lead`, true in the rows of the first fragment.

    This is one window over the run, so the wide rows are shuffled once, and not at all where they are
    `clustered` by run.
    """
    sizes = [F.size(name) for name in ("times", "intens", "mass_err")]
    run = Window.partitionBy(*RUN)
    ordered = run.orderBy(F.col(FRAGMENT).asc_nulls_last(), "MinStartTime", "MaxEndTime", "times")
    first = F.first(F.struct(FRAGMENT, "MinStartTime", "MaxEndTime", "times")).over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = traces.withColumns({"_first": first, "_short": F.min(F.least(*sizes)).over(run),
                               "_long": F.max(F.greatest(*sizes)).over(run)})
    low, high = F.col("_first.MinStartTime"), F.col("_first.MaxEndTime")
    flags = tr.widen_single_point(tr.integration_zone(F.col("_first.times"), low, high))
    reason = (F.when(low.isNull() | high.isNull(), "no integration limits")
              .when(F.col("_short") != F.col("_long"), "unequal trace lengths")
              .when(~F.array_contains("zone", 1), "empty integration zone").otherwise(OK))
    lead = F.col(FRAGMENT).eqNullSafe(F.col(f"_first.{FRAGMENT}"))
    return (rows.withColumns({"zone": flags, "lead": lead, "times": F.col("_first.times")})
            .withColumn("reason", reason).drop("_first", "_short", "_long"))


def cut_cells(traces: DataFrame, params: RefineParams) -> DataFrame:
    """Every trace cut to its run's zone and reduced to what scoring needs: the cell, `reason`, `x` (normalised
    in-zone intensities), `mean_err`, `err_score`, `Area`, `LibraryIntensity`; the rows marked `lead` also carry
    `zone` and `times`. Duplicate rows are dropped after the cut, on the partitioning by run, when they are small.
    """
    rows = zoned_rows(traces.select(*CELL, "times", "intens", "mass_err", "MinStartTime", "MaxEndTime", "Area",
                                    "LibraryIntensity"))
    clean = tr.clamp_nonneg(tr.nan_to_zero(F.col("intens")))
    usable = F.col("reason") == OK
    cut = rows.select(
        *CELL, "reason",
        F.when(usable, tr.normalise_trace(tr.cut_to_zone(clean, F.col("zone")))).alias("x"),
        F.when(usable, tr.cut_to_zone(tr.nan_to_zero(F.col("mass_err")), F.col("zone"))).alias("e"),
        "Area", "LibraryIntensity", "lead", F.when(F.col("lead"), F.col("zone")).alias("zone"),
        F.when(F.col("lead"), F.col("times")).alias("times"))
    scored = cut.withColumn("mean_err", tr.weighted_abs_mean(F.col("e"), F.col("x"))).drop("e")
    return scored.withColumn(
        "err_score", mass_error_score(F.col("mean_err"), params.mass_error_tolerance,
                                      params.mass_error_cutoff)).distinct()


def run_zones(rows: DataFrame) -> DataFrame:
    """Per run: its zone and times, and whether it is usable, from `zoned_rows` or `cut_cells`."""
    return rows.filter("lead").select(*RUN, "zone", "reason", "times").distinct()


def analyte_fragments(cut: DataFrame, params: RefineParams) -> DataFrame:
    """Per analyte: number of distinct fragments, and the sorted list of them while list and matrices of all
    its runs stay small (null beyond, so no long list is ever collected)."""
    n, fragment = F.col("n_frag").cast("bigint"), F.col(FRAGMENT)
    pairs = cut.groupBy(ANALYTE, FRAGMENT).agg(F.count("*").alias("_rows"))
    runs = cut.filter("lead").select(*RUN).distinct().groupBy(ANALYTE).agg(F.count("*").alias("n_runs"))
    counts = pairs.groupBy(ANALYTE).agg(F.count("*").cast("int").alias("n_frag")).join(runs, ANALYTE)
    small = counts.filter((n <= params.list_limit) & (F.col("n_runs") * n * n <= params.local_limit))
    short = pairs.join(small, ANALYTE).groupBy(ANALYTE).agg(F.sort_array(F.collect_list(fragment)).alias("frags"))
    return counts.drop("n_runs").join(short, ANALYTE, "left")


def coded_cells(cut: DataFrame, fragments: DataFrame) -> DataFrame:
    """The cells with `n_frag`, the number of fragments of their analyte, and `code`, the position in its list
    (null where there is none). `fragments` are the `analyte_fragments`."""
    return (cut.drop("lead", "zone", "times").join(fragments, ANALYTE)
            .withColumn("code", (F.array_position("frags", F.col(FRAGMENT)) - 1).cast("int")).drop("frags"))


def build_cells(traces: DataFrame, params: RefineParams) -> DataFrame:
    cut = materialise(cut_cells(traces, params), "cut")
    return coded_cells(cut, analyte_fragments(cut, params))


def conflicting_runs(cells: DataFrame) -> DataFrame:
    """Runs in which one fragment has several different rows."""
    return (cells.groupBy(*CELL).agg(F.count("*").alias("n")).filter("n > 1")
            .select(*RUN).distinct())


def usable_cells(cells: DataFrame) -> DataFrame:
    """The cells of usable runs. `cells` must be a written table: conflicts are looked for at once,
    and without any (the usual case) the result is just a pushed-down filter."""
    usable = cells.filter(F.col("reason") == OK)
    clash = materialise(conflicting_runs(usable), "conflicts")
    return usable if clash.isEmpty() else materialise(usable.join(clash, RUN, "left_anti"), "usable")


def quarantine(cells: DataFrame) -> DataFrame:
    """The runs left out, with the reason; together with the usable runs they are all runs."""
    bad = cells.filter(F.col("reason") != OK).select(*RUN, "reason").distinct()
    clash = conflicting_runs(cells).withColumn("reason", F.lit("conflicting duplicate rows"))
    return bad.unionByName(clash.join(bad, RUN, "left_anti"))


def library_rank(cells: DataFrame) -> DataFrame:
    """Library intensity and its rank (ties share the smallest rank) per analyte and fragment, taken
    from the first replicate and label: those of the first row by fragment, replicate and label."""
    first = (cells.groupBy(ANALYTE).agg(F.min(F.struct(FRAGMENT, REP, LABEL)).alias("first"))
             .select(ANALYTE, F.col(f"first.{REP}").alias(REP), F.col(f"first.{LABEL}").alias(LABEL)))
    library = (cells.join(first, RUN, "left_semi")
               .groupBy(ANALYTE, FRAGMENT).agg(F.max("LibraryIntensity").alias("lib")))
    by_library = Window.partitionBy(ANALYTE).orderBy(F.col("lib").desc_nulls_last())
    return library.withColumn("Rank", F.rank().over(by_library))


def mean_area_profile(cells: DataFrame) -> DataFrame:
    """Mean area per analyte, label and fragment over the replicates, nulls left out."""
    return cells.groupBy(ANALYTE, LABEL, FRAGMENT).agg(F.avg("Area").alias("mean_area"))


def reference_values(cells: DataFrame, library: DataFrame) -> DataFrame:
    """Mean-area profile and library intensity side by side, per analyte, label and fragment."""
    return mean_area_profile(cells).join(library.select(ANALYTE, FRAGMENT, "lib"),
                                         [ANALYTE, FRAGMENT], "left")


def total_to_max(cells: DataFrame, keys: list[str] = RUN, area: str = "Area") -> DataFrame:
    """Sum, maximum and their ratio over the fragments of each group."""
    return (cells.groupBy(*keys).agg(F.sum(area).alias("sum_area"), F.max(area).alias("max_area"))
            .withColumn("total_to_max", F.try_divide("sum_area", "max_area")))


def pivot_area(cells: DataFrame, fragments: list[str], keys: list[str] = RUN) -> DataFrame:
    """Wide area matrix for the given fragments; for output edges only."""
    return cells.groupBy(*keys).pivot(FRAGMENT, fragments).agg(F.max("Area"))


def unpivot_scores(wide: DataFrame, keys: list[str], columns: list[str], name: str,
                   value: str) -> DataFrame:
    """Wide to long."""
    return wide.unpivot(keys, columns, name, value)
