"""The refinement: choose fragments, adjust boundaries, rescore.

Raw traces are shuffled once, into a table clustered by run, and read once per zone and once for the
boundaries; everything in between works on compact written tables. Analytes are independent, so one plan over all of them replaces one process per analyte; a single analyte is
the same plan on filtered input.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peakloom import config as cfg
from peakloom.config import RefineParams
from peakloom.operators import boundaries as bd
from peakloom.operators import cells as ce
from peakloom.operators import flip_search, scoring, search, selection
from peakloom.operators.prefilter import prefilter
from peakloom.operators.similarity import gram_table, subset_rows, subset_rows_long
from peakloom.schema import ANALYTE, CELL, FRAGMENT, LABEL, NO_LABEL, REP, RUN
from peakloom.session import clustered, co_partitioned, materialise, run_folder


RESCORED = "rescored"
TRACE_COLUMNS = [*CELL, "times", "intens", "mass_err", "MinStartTime", "MaxEndTime", "Area",
                 "LibraryIntensity"]


@dataclass(frozen=True)
class Prepared:
    """Written tables every later step reads, and the zones, taken from one when asked for."""

    zones: DataFrame
    all_cells: DataFrame
    cells: DataFrame
    fragments: DataFrame
    library: DataFrame
    refs: DataFrame
    grams: DataFrame
    has_large: bool

    @property
    def large(self) -> DataFrame:
        return self.cells.filter(F.col("code").isNull())


@dataclass(frozen=True)
class Selection:
    """Outcome of the transition refinement."""

    transitions: DataFrame
    rows: DataFrame
    params: RefineParams

    @property
    def replicates(self) -> DataFrame:
        """Replicate scores of every stage, computed when asked for."""
        return scoring.score_replicates(self.rows, self.params.hot_group_rows)

    @property
    def transition_scores(self) -> DataFrame:
        return scoring.score_transitions(self.rows.filter(
            F.col("Comment").isin(cfg.STAGE_SEARCH_2, cfg.STAGE_SMALL)))


@dataclass(frozen=True)
class Refined:
    """Outcome of the whole refinement."""

    selection: Selection
    boundaries: DataFrame
    rescore: DataFrame
    account: DataFrame

    @property
    def transitions(self) -> DataFrame:
        return self.selection.transitions

    @property
    def replicates(self) -> DataFrame:
        return self.selection.replicates

    @property
    def quarantine(self) -> DataFrame:
        """The runs that were not rescored, and why."""
        return self.account.filter(F.col("reason") != RESCORED)


def prepare(traces: DataFrame, params: RefineParams) -> Prepared:
    """Everything derived from the traces and the integration limits in their rows."""
    return prepare_cut(materialise(ce.cut_cells(traces, params), "cut"), params)


def prepare_cut(cut: DataFrame, params: RefineParams) -> Prepared:
    """The same from the written table of `cut_cells`."""
    fragments = materialise(ce.analyte_fragments(cut, params), "fragments")
    all_cells = materialise(ce.coded_cells(cut, fragments), "cells")
    cells = ce.usable_cells(all_cells)
    library = materialise(ce.library_rank(cells), "library")
    refs = materialise(ce.reference_values(cells, library), "refs")
    grams = materialise(gram_table(cells, refs), "grams")
    has_large = not cells.filter(F.col("code").isNull()).isEmpty()
    listed = fragments.filter(F.col("frags").isNotNull())
    return Prepared(ce.run_zones(cut), all_cells, cells, listed, library, refs, grams, has_large)


def _stage(comment: str, base: Column, mask: Column) -> Column:
    return F.struct(F.lit(comment).alias("Comment"), base.alias("base"), mask.alias("mask"))


def _all_mask() -> Column:
    return F.array_repeat(F.lit(True), F.col("n_frag"))


def _members(kept: DataFrame, chosen: DataFrame, comment: str) -> DataFrame:
    """(analyte, fragment, Comment, in_set) with `kept` as base and `chosen` as subset."""
    marked = chosen.select(ANALYTE, FRAGMENT).withColumn("_in", F.lit(True))
    return kept.join(marked, [ANALYTE, FRAGMENT], "left").select(
        ANALYTE, FRAGMENT, F.lit(comment).alias("Comment"),
        F.coalesce("_in", F.lit(False)).alias("in_set"))


def full_set_rows(prep: Prepared, comment: Column) -> DataFrame:
    """Subset rows for the full fragment set of every analyte; `comment` may use `n_frag`."""
    stages = prep.fragments.select(ANALYTE, F.array(F.struct(
        comment.alias("Comment"), _all_mask().alias("base"), _all_mask().alias("mask"))).alias("stages"))
    if not prep.has_large:
        return subset_rows(prep.grams, stages)
    members = prep.large.select(ANALYTE, FRAGMENT, "n_frag").distinct().select(
        ANALYTE, FRAGMENT, comment.alias("Comment"), F.lit(True).alias("in_set"))
    return subset_rows(prep.grams, stages).unionByName(
        subset_rows_long(prep.large, prep.refs, members))


def refine_transitions(prep: Prepared, params: RefineParams) -> Selection:
    """Two passes of removal and search; every stage is scored."""
    small_n = F.col("n_frag") < params.min_fragments
    rows_a = full_set_rows(prep, F.when(small_n, cfg.STAGE_SMALL).otherwise(cfg.STAGE_INITIAL))
    if not params.keep_small_analytes:
        rows_a = rows_a.filter(F.col("Comment") != cfg.STAGE_SMALL)
    rows_a = materialise(rows_a, "rows-a", kept=True)
    enough = rows_a.filter(F.col("Comment") == cfg.STAGE_INITIAL)

    def searched(kept: DataFrame, previous: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
        """Flags of the search, and the chosen fragments of large analytes if there are any."""
        proposed = search.proposals(kept, prep.fragments, previous)
        found = materialise(search.search_subsets(prep.grams, proposed, params, params.exhaustive_limit), "found")
        if not prep.has_large:
            return found, None
        large_kept = kept.join(prep.fragments, ANALYTE, "left_anti")
        n = F.count("*").over(Window.partitionBy(ANALYTE))
        large_kept = materialise(large_kept.withColumn("listed", n <= params.exhaustive_limit), "large-kept")
        few, many = large_kept.filter("listed"), large_kept.filter("not listed")
        cells_of = lambda part: prep.large.join(part.select(ANALYTE).distinct(), ANALYTE, "left_semi")
        chosen = []
        if not few.isEmpty():
            chosen.append(flip_search.best_subsets(cells_of(few), prep.refs, flip_search.subsets(few, params.min_fragments)))
        if not many.isEmpty() or not chosen:
            starts = flip_search.starts(many, previous, params.min_fragments)
            chosen.append(flip_search.flip_search(cells_of(many), prep.refs, starts, params))
        return found, materialise(reduce(DataFrame.unionByName, chosen), "flip-found")

    def stage_rows(found: DataFrame, kept: DataFrame, chosen: DataFrame | None, filtered: str,
                   optimised: str) -> DataFrame:
        stages = found.select(ANALYTE, F.array(
            _stage(filtered, F.col("kept"), F.col("kept")),
            _stage(optimised, F.col("kept"), F.col("solution"))).alias("stages"))
        rows = subset_rows(prep.grams, stages)
        if chosen is not None:
            large_kept = kept.join(prep.fragments, ANALYTE, "left_anti")
            members = _members(large_kept, large_kept, filtered).unionByName(
                _members(large_kept, chosen, optimised))
            rows = rows.unionByName(subset_rows_long(prep.large, prep.refs, members))
        return materialise(rows, "rows", kept=True)

    def solution(found: DataFrame, chosen: DataFrame | None) -> DataFrame:
        kept = search.mask_fragments(found, prep.fragments, "solution")
        return kept if chosen is None else kept.unionByName(chosen)

    hot = params.hot_group_rows
    kept_1 = materialise(selection.surviving(selection.classify(enough, prep.library, hot), params,
                                             error_cut=True), "kept")
    found_1, large_1 = searched(kept_1, None)
    rows_bc = stage_rows(found_1, kept_1, large_1, cfg.STAGE_FILTER_1, cfg.STAGE_SEARCH_1)

    again = rows_bc.filter(F.col("Comment") == cfg.STAGE_SEARCH_1)
    kept_2 = materialise(selection.surviving(selection.classify(again, prep.library, hot), params,
                                             error_cut=False), "kept")
    found_2, large_2 = searched(kept_2, solution(found_1, large_1))
    rows_de = stage_rows(found_2, kept_2, large_2, cfg.STAGE_FILTER_2, cfg.STAGE_SEARCH_2)

    rows = reduce(DataFrame.unionByName, [rows_a, rows_bc, rows_de])
    untouched = rows_a.filter(F.col("Comment") == cfg.STAGE_SMALL).select(ANALYTE, FRAGMENT).distinct()
    transitions = materialise(solution(found_2, large_2).unionByName(untouched), "transitions", kept=True)
    return Selection(transitions, rows, params)


def rescore(traces: DataFrame, transitions: DataFrame, boundaries: DataFrame, zones: DataFrame,
            params: RefineParams) -> tuple[DataFrame, Prepared]:
    """Score the kept fragments again inside the new boundaries; also what the scores were taken from. Kept
    fragments and limits go to the run's traces, not the traces to them."""
    limits = boundaries.select(ANALYTE, REP, "MinStartTime", "MaxEndTime")
    members = bd.run_members(zones, transitions).join(limits, [ANALYTE, REP], "left")
    with co_partitioned(traces.sparkSession):
        kept = traces.select(*TRACE_COLUMNS).drop("MinStartTime", "MaxEndTime").join(members, CELL)
        cut = materialise(ce.cut_cells(kept, params), "cut")
    prep = prepare_cut(cut, params)
    rows = materialise(full_set_rows(prep, F.lit(cfg.STAGE_RESCORE)), "rows-f")
    return materialise(scoring.score_replicates(rows, params.hot_group_rows), "rescored", kept=True), prep


def lost_analytes(prep: Prepared, transitions: DataFrame) -> DataFrame:
    """Analytes with usable runs of which no fragment is left."""
    seen = prep.cells.select(ANALYTE).distinct()
    return seen.join(transitions.select(ANALYTE).distinct(), ANALYTE, "left_anti")


def refine_global(traces: DataFrame, params: RefineParams = RefineParams()) -> Refined:
    """Transitions, boundaries, rescored values, and an account of every run of the input: `rescored`, or
    the reason why not. A missing label counts as a label of its own. Only the results stay written; all other
    tables of the run are removed at its end."""
    with run_folder(traces.sparkSession, "refine"):
        return _refined(traces.withColumn(LABEL, F.coalesce(LABEL, F.lit(NO_LABEL))), params)


def _refined(traces: DataFrame, params: RefineParams) -> Refined:
    runs = None
    if params.apply_prefilter:
        runs = materialise(traces.select(*RUN).distinct(), "runs")
        traces = prefilter(traces, params)
    traces = clustered(traces.select(*TRACE_COLUMNS), "traces", RUN, params.run_buckets)
    prep = prepare(traces, params)
    prep = replace(prep, zones=materialise(prep.zones, "zones"))
    selected = refine_transitions(prep, params)
    summed = bd.replicate_traces(traces, selected.transitions, prep.zones)
    boundaries = materialise(bd.refine_boundaries(summed, params.edge_fraction), "boundaries", kept=True)
    scores, again = rescore(traces, selected.transitions, boundaries, prep.zones, params)
    return Refined(selected, boundaries, scores, account(prep, again, selected.transitions, scores, params,
                                                          runs))


def account(prep: Prepared, again: Prepared, transitions: DataFrame, scores: DataFrame,
            params: RefineParams, runs: DataFrame | None = None) -> DataFrame:
    """(run, reason) with one row per run of the input: `rescored`, or the first reason that holds. `runs` are
    those before the prefilter, if there was one; without rows after it a run is `prefiltered`."""
    def marked(runs: DataFrame, keys: list[str], name: str, reason: Column) -> DataFrame:
        return runs.select(*keys, reason.alias(name)).distinct()

    before = marked(ce.quarantine(prep.all_cells), RUN, "_before", F.col("reason"))
    few = F.when(F.col("n_frag") < params.min_fragments, "too few fragments").otherwise("no fragment left")
    sizes = prep.cells.select(ANALYTE, "n_frag").distinct()
    lost = marked(lost_analytes(prep, transitions).join(sizes, ANALYTE), [ANALYTE], "_lost", few)
    after = marked(ce.quarantine(again.all_cells), RUN, "_after",
                   F.concat("reason", F.lit(" after the refinement")))
    done = marked(scores, RUN, "_done", F.lit(RESCORED))
    zones = prep.zones.select(*RUN)
    every = zones.withColumn("_gone", F.lit(None).cast("string"))
    if runs is not None:
        every = every.unionByName(marked(runs.join(zones, RUN, "left_anti"), RUN, "_gone", F.lit("prefiltered")))
    rows = (every.join(done, RUN, "left").join(before, RUN, "left")
            .join(lost, ANALYTE, "left").join(after, RUN, "left"))
    return materialise(rows.select(*RUN, F.coalesce(
        "_gone", "_done", "_before", "_lost", "_after", F.lit("no kept fragment in the run")).alias("reason")),
        "account", kept=True)
