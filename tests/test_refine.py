import itertools
import math
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from check_oracle import duck
from fixtures import mean_fitness, random_traces
from lanes import sql
from lanes import tables as tb
from peakloom import config as cfg
from peakloom.config import RefineParams
from peakloom.operators import flip_search, search, selection
from peakloom.plans import refine as rf
from peakloom.schema import ANALYTE, FRAGMENT, LABEL, REP, RUN, SCORE_COLUMNS

PARAMS = RefineParams()


def tables(prep):
    """Cells, library and profile as plain dictionaries per analyte."""
    cells: dict = {}
    for r in prep.cells.collect():
        cells.setdefault(r[ANALYTE], {}).setdefault((r[REP], r[LABEL]), {})[r[FRAGMENT]] = r.asDict()
    library, profile = {}, {}
    for r in prep.refs.collect():
        library.setdefault(r[ANALYTE], {})[r[FRAGMENT]] = r.lib
        profile.setdefault(r[ANALYTE], {})[r[LABEL], r[FRAGMENT]] = r.mean_area
    return cells, library, profile


@pytest.fixture(scope="module")
def traces(spark):
    return random_traces(spark, {"a": 5, "b": 6, "c": 2, "d": 7}).cache()


def climb(fitness, places, minimum, previous=()):
    """The search rule in plain Python: (score at nine decimals, subset)."""
    fragments = sorted(places)
    least = min(minimum, len(fragments))
    known = {}

    def key(subset):
        if subset not in known:
            known[subset] = math.floor(fitness(sorted(subset)) * 1e9 + 0.5)
        return known[subset], len(subset), [f in subset for f in fragments]
    best_first = sorted(fragments, key=places.get)
    starts = {frozenset(fragments), frozenset(previous)}
    starts |= {frozenset(best_first[:k]) for k in range(1, len(fragments))}
    starts |= {frozenset(fragments) - {f} for f in fragments}
    ends = []
    for subset in (s for s in starts if len(s) >= least):
        while True:
            near = max((subset ^ {f} for f in fragments if len(subset ^ {f}) >= least), key=key, default=subset)
            if key(near)[0] <= key(subset)[0]:
                break
            subset = near
        ends.append(subset)
    best = max(ends, key=key)
    return known.get(best, key(best)[0]), best


def found_by(prep, places, params, previous=None):
    """(analyte -> chosen fragments, analyte -> fitness) of either form of the search."""
    if prep.has_large:
        starts = flip_search.starts(places, previous, params.min_fragments)
        rows, score = flip_search.flip_search(prep.large, prep.refs, starts, params), {}
    else:
        found = search.search_subsets(prep.grams, search.proposals(places, prep.fragments, previous), params).cache()
        score = {r[ANALYTE]: r.fitness for r in found.collect()}
        rows = search.mask_fragments(found, prep.fragments, "solution")
    names: dict = {}
    for r in rows.collect():
        names.setdefault(r[ANALYTE], set()).add(r[FRAGMENT])
    return names, score


@pytest.mark.parametrize("params", [PARAMS, RefineParams(local_limit=0)], ids=["matrices", "long rows"])
def test_both_forms_of_the_search_follow_one_rule(spark, params):
    sizes = {"a": 5, "b": 6, "c": 2, "d": 4, "wide": 14} if params == PARAMS else {"a": 5, "c": 2, "wide": 8}
    traces = random_traces(spark, sizes, seed=11)
    prep = rf.prepare(traces, params)
    assert prep.has_large == (params != PARAMS)
    cells, library, profile = tables(prep)
    rng = random.Random(3)
    rows, places, was = [], {}, {}
    for analyte in cells:
        fragments = [f for f in library[analyte] if (analyte, f) != ("a", "f02")]  # one is not kept
        order = rng.sample(fragments, len(fragments))
        places[analyte] = {f: k + 1 for k, f in enumerate(order)}
        was[analyte] = rng.sample(order, min(4, len(order)))
        rows += [(analyte, f, k) for f, k in places[analyte].items()]
    kept = spark.createDataFrame(rows, f"{ANALYTE} string, {FRAGMENT} string, place int")
    previous = spark.createDataFrame([(a, f) for a in was for f in was[a]], f"{ANALYTE} string, {FRAGMENT} string")
    names, score = found_by(prep, kept, params, previous)
    for analyte in cells:
        fit = lambda s: mean_fitness(cells[analyte], s, library[analyte], profile[analyte])
        want, subset = climb(fit, places[analyte], params.min_fragments, was[analyte])
        assert names[analyte] == subset
        assert not score or score[analyte] == pytest.approx(want / 1e9, abs=2e-9)


def test_the_climb_is_seldom_below_the_best_subset(spark, traces):
    """Against all subsets of up to seven fragments."""
    prep = rf.prepare(traces, PARAMS)
    cells, library, profile = tables(prep)
    rows = rf.full_set_rows(prep, F.lit("x"))
    names, score = found_by(prep, selection.placed(selection.classify(rows, prep.library)), PARAMS)
    shares = []
    for analyte in cells:
        fragments = sorted(library[analyte])
        best = max(mean_fitness(cells[analyte], s, library[analyte], profile[analyte])
                   for k in range(min(3, len(fragments)), len(fragments) + 1) for s in itertools.combinations(fragments, k))
        shares.append(score[analyte] / best)
    assert all(s <= 1 + 1e-6 for s in shares) and sum(s > 1 - 1e-6 for s in shares) >= 3


def test_both_scoring_ways_agree(spark, traces):
    """The same data through the matrix path and, with a lower limit, through the long path."""
    score = lambda params: {tuple(r[k] for k in RUN): r for r in rf.scoring.score_replicates(
        rf.full_set_rows(rf.prepare(traces, params), F.lit("x"))).collect()}
    short, long = score(PARAMS), score(RefineParams(list_limit=1))
    assert short.keys() == long.keys() and len(short) == 16
    for key, row in short.items():
        assert [row[c] for c in SCORE_COLUMNS[3:8]] == pytest.approx([long[key][c] for c in SCORE_COLUMNS[3:8]], abs=1e-8)


def test_refine_global_invariants(spark, traces):
    wide = random_traces(spark, {"w": 14}, seed=2)
    everything = traces.unionByName(wide)
    params = PARAMS
    out = rf.refine_global(everything, params)
    kept = {tuple(r) for r in out.transitions.select(ANALYTE, FRAGMENT).collect()}
    seen = {tuple(r) for r in everything.select(ANALYTE, FRAGMENT).distinct().collect()}
    assert kept and kept <= seen and len(kept) == out.transitions.count()
    lost = {r[ANALYTE] for r in out.quarantine.collect()}
    runs = [tuple(r[k] for k in RUN) for r in out.account.collect()]
    assert sorted(runs) == sorted({tuple(r[k] for k in RUN) for r in everything.select(*RUN).distinct().collect()})
    assert {a for a, _ in kept} | lost == {"a", "b", "c", "d", "w"}
    # analytes with too few fragments keep all of them
    assert {f for a, f in kept if a == "c"} == {"f00", "f01"}
    for r in out.boundaries.collect():
        assert 10.0 <= r.MinStartTime <= r.MaxEndTime <= 10.8
    rescored = out.rescore.collect()
    assert {r.Comment for r in rescored} == {cfg.STAGE_RESCORE}
    for r in rescored + out.replicates.collect():
        assert all(r[c] is None or 0 <= r[c] <= 1 for c in SCORE_COLUMNS[3:8])
    stages = {r.Comment for r in out.replicates.select("Comment").distinct().collect()}
    assert stages == {cfg.STAGE_SMALL, cfg.STAGE_INITIAL, cfg.STAGE_FILTER_1, cfg.STAGE_SEARCH_1,
                      cfg.STAGE_FILTER_2, cfg.STAGE_SEARCH_2}
    # duplicates and another partitioning change nothing, nor does the long form
    same = lambda x: sorted(map(str, x.collect()))
    again = rf.refine_transitions(rf.prepare(everything.unionByName(everything).repartition(3), params), params)
    assert same(again.transitions) == same(out.transitions)
    other = RefineParams(list_limit=6)
    long = rf.refine_transitions(rf.prepare(traces.filter(f"{ANALYTE} in ('c', 'd')"), other), other).transitions
    assert same(long) == same(out.transitions.filter(f"{ANALYTE} in ('c', 'd')"))


def test_small_analytes_can_be_left_out(spark, traces):
    prep = rf.prepare(traces.filter(f"{ANALYTE} in ('a', 'c')"), PARAMS)
    chosen = rf.refine_transitions(prep, RefineParams(keep_small_analytes=False)).transitions
    assert "c" not in {r[ANALYTE] for r in chosen.collect()}


def test_prefiltered_runs_are_in_the_account(spark):
    rows = random_traces(spark, {"a": 5, "b": 6})
    rows = (rows.withColumn("MinStartTime", F.when((F.col(ANALYTE) != "a") | (F.col(REP) != "r2"), F.col("MinStartTime")))
            .withColumns({"FragmentIon": F.concat(F.lit("y1"), F.substring(FRAGMENT, 2, 2)), "ProductCharge": F.lit(1),
                          "ProductMz": F.hash(FRAGMENT, LABEL).cast("double"), "ProteinName": F.lit("p"),
                          "PeptideModifiedSequence": F.col(ANALYTE), "PrecursorCharge": F.lit(2), "IsDecoy": F.lit(False)}))
    out = rf.refine_global(rows, RefineParams(apply_prefilter=True))
    told = [(tuple(r[k] for k in RUN), r.reason) for r in out.account.collect()]
    assert sorted(run for run, _ in told) == sorted(
        (a, r, label) for a in "ab" for r in ("r1", "r2") for label in ("heavy", "light"))
    assert {run for run, reason in told if reason == "prefiltered"} == {("a", "r2", "heavy"), ("a", "r2", "light")}


SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")
@pytest.mark.parametrize("params", [PARAMS, RefineParams(local_limit=0)], ids=["matrices", "long rows"])
def test_the_refinement_takes_the_best_of_all_subsets(spark, params):
    """F1 to F9: analytes whose climb ends below the best subset, against SQL that scores all of them."""
    con, listed = duck(SF_DIR), "SELECT ID_Analyte, ID_FragmentIon_charge FROM trans"
    best, climbed = (set(con.execute(f"{passes} {listed}").fetchall()) for passes in (sql.PASS_2, sql.CLIMBED))
    some = sorted({a for a, _ in best ^ climbed})
    assert len(some) >= 5
    traces = tb.export(spark, SF_DIR).filter(F.col(ANALYTE).isin(some)).cache()
    prep = rf.prepare(traces, params)
    assert prep.has_large == (params != PARAMS)
    found = {tuple(r) for r in rf.refine_transitions(prep, params).transitions.collect()}
    assert found == {r for r in best if r[0] in some}
    if params == PARAMS:
        climbing = rf.refine_transitions(prep, RefineParams(exhaustive_limit=0)).transitions
        assert {tuple(r) for r in climbing.collect()} == {r for r in climbed if r[0] in some}
