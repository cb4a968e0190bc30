"""The subset search for analytes with very many fragments or runs, in long form.

The mean similarity of a subset S in one run is (sum of unit traces) . (sum of traces) / (|S| |sum|),
so a run keeps two summed traces, and trying a flip costs one pass over the flipped fragment's own
points. No traces are paired or collected. The rule is that of `search`, and so are the results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peakloom.config import RefineParams
from peakloom.functions import traces as tr
from peakloom.functions.scores import at_most_one, composite_score, cosine
from peakloom.schema import ANALYTE, FRAGMENT, LABEL, RUN
from peakloom.session import materialise

_SUMS = ("n", "e", "aa", "al", "ll", "ap", "pp")


def _fitness(us: Column, ss: Column, sums: dict[str, Column]) -> Column:
    score = composite_score(
        at_most_one(F.try_divide(us, sums["n"] * F.sqrt(F.greatest(ss, F.lit(0.0))))),
        cosine(sums["al"], sums["aa"], sums["ll"]), F.try_divide(sums["e"], sums["n"]),
        cosine(sums["ap"], sums["aa"], sums["pp"]))
    return F.coalesce(score, F.lit(0.0))


def _terms(rows: DataFrame) -> DataFrame:
    """The additive terms of one cell and its trace points."""
    zero = lambda col: F.coalesce(col, F.lit(0.0))
    a, lib, p = F.col("Area"), F.col("lib"), F.col("mean_area")
    return rows.select(
        *RUN, FRAGMENT, "x", F.sqrt(tr.dot(F.col("x"), F.col("x"))).alias("norm"),
        F.lit(1.0).alias("n"), zero(F.col("err_score")).alias("e"), zero(a * a).alias("aa"),
        zero(a * lib).alias("al"), zero(lib * lib).alias("ll"), zero(a * p).alias("ap"),
        zero(p * p).alias("pp"))


def starts(kept: DataFrame, previous: DataFrame | None, minimum: int) -> DataFrame:
    """(analyte, start, fragment, in_set) for every start of the search: the full set, prefixes by place,
    leave-one-outs and the previous solution. `kept` has analyte, fragment and place."""
    rows = kept.select(ANALYTE, FRAGMENT, "place")
    if previous is None:
        rows = rows.withColumn("was", F.lit(False))
    else:
        marked = previous.select(ANALYTE, FRAGMENT).withColumn("_was", F.lit(True))
        rows = rows.join(marked, [ANALYTE, FRAGMENT], "left").select(
            ANALYTE, FRAGMENT, "place", F.coalesce("_was", F.lit(False)).alias("was"))
    n, least = F.col("n"), F.least(F.lit(minimum).cast("bigint"), F.col("n"))
    start = lambda kind, j: F.struct(F.lit(kind).alias("kind"), j.alias("j"))
    none = F.array().cast("array<struct<kind:string,j:bigint>>")
    listed = F.flatten(F.array(
        F.array(start("full", F.lit(0).cast("bigint"))),
        F.when(n > least, F.transform(F.sequence(least, n - 1), lambda j: start("prefix", j))).otherwise(none),
        F.when(n > least, F.transform(F.sequence(F.lit(1).cast("bigint"), n), lambda j: start("without", j))).otherwise(none),
        F.when(F.col("n_was") >= least, F.array(start("previous", F.lit(0).cast("bigint")))).otherwise(none)))
    sizes = rows.groupBy(ANALYTE).agg(F.count("*").alias("n"), F.count_if("was").alias("n_was"))
    each = sizes.select(ANALYTE, F.explode(listed).alias("s"))
    kind, j = F.col("s.kind"), F.col("s.j")
    inside = (F.when(kind == "prefix", F.col("place") <= j).when(kind == "without", F.col("place") != j)
              .when(kind == "previous", F.col("was")).otherwise(F.lit(True)))
    return rows.join(each, ANALYTE).select(ANALYTE, F.concat_ws("-", kind, j).alias("start"), FRAGMENT,
                                           inside.alias("in_set"))


def subsets(kept: DataFrame, minimum: int) -> DataFrame:
    """(analyte, start, fragment, in_set) for every subset of the search. `kept` has analyte, fragment and place; as
    many fragments as bits of a whole number at most, and few of them if this is to end."""
    n, least = F.col("n"), F.least(F.lit(minimum).cast("bigint"), F.col("n"))
    one = F.lit(1).cast("bigint")
    power = lambda by: F.call_function("shiftleft", one, by.cast("int"))
    each = (kept.groupBy(ANALYTE).agg(F.count("*").alias("n"))
            .select(ANALYTE, least.alias("least"), F.explode(F.sequence(one, power(n) - 1)).alias("mask"))
            .filter(F.bit_count("mask") >= F.col("least")))
    return kept.select(ANALYTE, FRAGMENT, "place").join(each, ANALYTE).select(
        ANALYTE, F.concat(F.lit("all-"), F.col("mask")).alias("start"), FRAGMENT,
        (F.getbit(F.col("mask"), F.col("place") - 1) == 1).alias("in_set"))


def _current(cells: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rows, points, summed traces, scores) of every run and start."""
    keys = [*RUN, "start"]
    run_sums = [F.sum(F.when(F.col("in_set"), F.col(name)).otherwise(0.0)).alias(f"s_{name}")
                for name in _SUMS]
    rows = cells.join(state, [ANALYTE, FRAGMENT])
    scalars = rows.groupBy(*keys).agg(*run_sums)
    x = F.coalesce("value", F.lit(0.0))
    points = rows.select(*keys, FRAGMENT, "in_set", "norm", F.posexplode("x").alias("pos", "value"))
    points = points.select(*keys, FRAGMENT, "in_set", "pos", x.alias("x"),
                           F.coalesce(F.try_divide(x, F.col("norm")), F.lit(0.0)).alias("u"))
    chosen = F.col("in_set")
    totals = points.groupBy(*keys, "pos").agg(
        F.sum(F.when(chosen, F.col("x")).otherwise(0.0)).alias("sum_x"),
        F.sum(F.when(chosen, F.col("u")).otherwise(0.0)).alias("sum_u"))
    current = (totals.groupBy(*keys).agg(F.sum(F.col("sum_x") * F.col("sum_u")).alias("us"),
                                         F.sum(F.col("sum_x") * F.col("sum_x")).alias("ss"))
               .join(scalars, keys)
               .withColumn("now", _fitness(F.col("us"), F.col("ss"),
                                           {name: F.col(f"s_{name}") for name in _SUMS})))
    return rows, points, totals, current


def _at_nine(total: Column) -> Column:
    return F.floor(total / F.col("runs") * 1e9 + 0.5)


def _scored(current: DataFrame, runs: DataFrame, state: DataFrame) -> DataFrame:
    """(analyte, start, size, n, runs, total, score): the score at nine decimals."""
    sizes = state.groupBy(ANALYTE, "start").agg(F.count_if("in_set").alias("size"), F.count("*").alias("n"))
    return (sizes.join(runs, ANALYTE)
            .join(current.groupBy(ANALYTE, "start").agg(F.sum("now").alias("total")), [ANALYTE, "start"], "left")
            .withColumn("total", F.coalesce("total", F.lit(0.0))).withColumn("score", _at_nine(F.col("total"))))


def _moves(cells: DataFrame, runs: DataFrame, state: DataFrame, minimum: int) -> DataFrame:
    """Per analyte and start: its score, its size, and the fragment of the best move if that scores higher.
    `runs` has the number of runs per analyte."""
    keys, chosen = [*RUN, "start"], F.col("in_set")
    rows, points, totals, current = _current(cells, state)
    sign = F.when(chosen, -1.0).otherwise(1.0)
    s_new, u_new = F.col("sum_x") + sign * F.col("x"), F.col("sum_u") + sign * F.col("u")
    # the points of the other fragments stay in the sums: only rows of the run's own grid matter
    tried = points.join(totals, [*keys, "pos"]).groupBy(*keys, FRAGMENT).agg(
        F.sum(s_new * u_new).alias("us_new"), F.sum(s_new * s_new).alias("ss_new"))
    flips = (rows.drop("x", "norm").join(tried, [*keys, FRAGMENT]).join(current, keys)
             .withColumn("then", _fitness(F.col("us_new"), F.col("ss_new"),
                                          {name: F.col(f"s_{name}") + sign * F.col(name)
                                           for name in _SUMS})))
    gains = flips.groupBy(ANALYTE, "start", FRAGMENT, "in_set").agg(
        F.sum(F.col("then") - F.col("now")).alias("gain"))
    scored = _scored(current, runs, state)
    allowed = ~chosen | (F.col("size") > F.least(F.lit(minimum), F.col("n")))
    better = (gains.join(scored, [ANALYTE, "start"]).filter(allowed)
              .withColumn("then", _at_nine(F.col("total") + F.col("gain"))).filter(F.col("then") > F.col("score")))
    # the larger subset first, then the one that holds the first fragment in which they differ
    first = Window.partitionBy(ANALYTE, "start").orderBy(
        F.col("then").desc(), "in_set", F.when(~chosen, F.col(FRAGMENT)), F.when(chosen, F.col(FRAGMENT)).desc())
    best = (better.withColumn("at", F.row_number().over(first)).filter("at = 1")
            .select(ANALYTE, "start", F.col(FRAGMENT).alias("move")))
    return scored.join(best, [ANALYTE, "start"], "left").select(ANALYTE, "start", "score", "size", "move")


def _held() -> Column:
    """The subset as text, in the order of the fragments."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(FRAGMENT, "in_set"))),
                                    lambda x: F.when(x["in_set"], "1").otherwise("0")), "")


def _best(found: DataFrame) -> DataFrame:
    return found.groupBy(ANALYTE).agg(F.max_by("start", F.struct("score", "size", "mask", "start")).alias("start"))


def _written(cells: DataFrame, refs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The number of runs per analyte, and the terms of the cells."""
    runs = materialise(cells.select(*RUN).distinct().groupBy(ANALYTE).agg(F.count("*").alias("runs")), "flip-runs")
    return runs, materialise(_terms(cells.join(refs, [ANALYTE, LABEL, FRAGMENT], "left")), "flip-cells")


def best_subsets(cells: DataFrame, refs: DataFrame, state: DataFrame) -> DataFrame:
    """(analyte, fragment) of the best of all `subsets`, each scored once."""
    runs, cells = _written(cells, refs)
    state = materialise(state, "flip-state")
    scored = _scored(_current(cells, state)[-1], runs, state)
    masks = state.groupBy(ANALYTE, "start").agg(_held().alias("mask"))
    best = materialise(_best(scored.join(masks, [ANALYTE, "start"])), "flip-best")
    return state.filter("in_set").join(best, [ANALYTE, "start"], "left_semi").select(ANALYTE, FRAGMENT)


def flip_search(cells: DataFrame, refs: DataFrame, state: DataFrame, params: RefineParams) -> DataFrame:
    """The search rule of `search` for analytes of any size: (analyte, fragment) of the best end. `state` has
    the `starts`. Each move raises the score by 1e-9 at least, so the rounds end. All starts of all analytes
    move together; those that have ended are read no more. Every round is written, so plans do not grow."""
    runs, cells = _written(cells, refs)
    state, ends = materialise(state, "flip-state"), []
    while True:
        moves = materialise(_moves(cells, runs, state, params.min_fragments), "flip-moves")
        rows = state.join(moves, [ANALYTE, "start"])
        ended = rows.filter(F.col("move").isNull())
        ends.append((materialise(ended.groupBy(ANALYTE, "start", "score", "size").agg(
            _held().alias("mask")), "flip-ends"), ended))
        moved = F.col("in_set") != (F.col(FRAGMENT) == F.col("move"))
        state = materialise(rows.filter(F.col("move").isNotNull())
                            .select(ANALYTE, "start", FRAGMENT, moved.alias("in_set")), "flip-state")
        if state.isEmpty():
            break
    found = reduce(DataFrame.unionByName, [end for end, _ in ends])
    every = reduce(DataFrame.unionByName, [rows.filter("in_set").select(ANALYTE, "start", FRAGMENT) for _, rows in ends])
    return every.join(materialise(_best(found), "flip-best"), [ANALYTE, "start"], "left_semi").select(ANALYTE, FRAGMENT)
