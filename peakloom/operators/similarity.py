"""Shape similarity: cosine of each trace with the summed trace of a fragment subset.

Two ways to the same numbers. `similarity` works on points in long form and has no bound on the
number of fragments or points of a run. `gram_table` reads the points once into a small matrix of
inner products per run, for analytes with few fragments; any subset is then scored from the matrix:
cos(f, sum S) = sum_g G[f,g] / sqrt(G[f,f] * sum_gh G[g,h]).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakloom.functions import traces as tr
from peakloom.functions.scores import cosine
from peakloom.schema import ANALYTE, FRAGMENT, LABEL, REP, RUN


def similarity(points: DataFrame, run: Sequence[str], fragment: str, pos: str, value: str) -> DataFrame:
    """(run, fragment, similarity) from one row per run, fragment and point.

    Points are summed map-side before every shuffle, and the summed trace is joined on (run, point),
    so a run with very many points spreads over all tasks.
    """
    run = list(run)
    total = points.groupBy(*run, pos).agg(F.sum(value).alias("_total"))
    norm = total.groupBy(*run).agg(F.sum(F.col("_total") * F.col("_total")).alias("_tt"))
    dots = points.join(total, [*run, pos]).groupBy(*run, fragment).agg(
        F.sum(F.col(value) * F.col("_total")).alias("_xt"),
        F.sum(F.col(value) * F.col(value)).alias("_xx"))
    return (dots.join(norm, run)
            .select(*run, fragment, cosine(F.col("_xt"), F.col("_xx"), F.col("_tt")).alias("similarity")))


def cell_similarity(cells: DataFrame, run: Sequence[str] = RUN) -> DataFrame:
    """`similarity` for rows that carry their trace as the array `x`."""
    points = cells.select(*run, FRAGMENT, F.posexplode("x").alias("pos", "value"))
    return similarity(points.filter(F.col("value").isNotNull()), run, FRAGMENT, "pos", "value")


def _slot(code: Column) -> Column:
    return F.get(F.filter("cells", lambda cell: cell["code"] == code), 0)


def gram_table(cells: DataFrame, refs: DataFrame) -> DataFrame:
    """One row per run of the analytes with a short fragment list.

    `slots`: one entry per fragment code (null where the run lacks it) with fragment, area, library
    intensity, mean-area profile, mass-error mean and score; `gram`: inner products of the normalised
    traces. Rows are ordered by analyte over a range partitioning: the runs of an analyte lie
    together, so later per-analyte sums collapse before their shuffle, and a frequent analyte is
    still cut into several tasks. The rows are placed before the matrices are computed, because
    range partitioning reads its input twice. At most `list_limit` fragments are gathered per run; runs with conflicting rows were left out before.
    """
    short = cells.filter(F.col("code").isNotNull()).join(refs, [ANALYTE, LABEL, FRAGMENT], "left")
    cell = F.struct("code", F.col(FRAGMENT).alias("fragment"), "x", F.col("Area").alias("area"),
                    "lib", "mean_area", "mean_err", "err_score")
    runs = (short.groupBy(*RUN, "n_frag").agg(F.collect_list(cell).alias("cells"))
            .repartitionByRange(ANALYTE, REP, LABEL).sortWithinPartitions(ANALYTE, REP, LABEL))
    codes = F.sequence(F.lit(0), F.col("n_frag") - 1)
    slots = F.transform(codes, _slot)
    inner = lambda a, b: F.coalesce(tr.dot(a["x"], b["x"]), F.lit(0.0))
    gram = F.transform("slots", lambda a: F.transform("slots", lambda b: inner(a, b)))
    bare = F.transform("slots", lambda s: F.when(s.isNotNull(), F.struct(
        s["fragment"].alias("fragment"), s["area"].alias("area"), s["lib"].alias("lib"),
        s["mean_area"].alias("mean_area"), s["mean_err"].alias("mean_err"),
        s["err_score"].alias("err_score"))))
    return (runs.withColumn("slots", slots).withColumn("gram", gram)
            .select(*RUN, "n_frag", bare.alias("slots"), "gram"))


def subset_rows(grams: DataFrame, stages: DataFrame) -> DataFrame:
    """Long rows (run, Comment, fragment, similarity, ...) for every stage of every analyte.

    `stages`: one row per analyte with `stages`, an array of (Comment, base, mask) where base and mask
    are arrays of flags over the analyte's fragment codes. Rows come for the fragments in `base`; their
    similarity is taken to the summed trace of `mask`, and `in_set` tells membership in `mask`.
    """
    rows = grams.join(stages, ANALYTE).withColumn("stage", F.explode("stages"))
    mask = F.col("stage.mask")
    total = lambda terms: F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    masked = lambda values: F.transform(
        values, lambda v, c: F.when(F.get(mask, c), v).otherwise(F.lit(0.0)))
    rows = (rows.withColumn("dots", F.transform("gram", lambda row: total(masked(row))))
            .withColumn("norm", total(masked(F.col("dots"))))
            .select(*RUN, "stage", "gram", "dots", "norm", F.posexplode("slots").alias("code", "slot")))
    code = F.col("code")
    own = F.get(F.get("gram", code), code)
    score = cosine(F.get("dots", code), own, F.col("norm"))
    return (rows.filter(F.col("slot").isNotNull() & F.get("stage.base", code))
            .select(*RUN, F.col("stage.Comment").alias("Comment"), F.col("slot.fragment").alias(FRAGMENT),
                    "code", score.alias("similarity"), F.col("slot.area").alias("Area"), "slot.lib",
                    "slot.mean_area", "slot.mean_err", "slot.err_score",
                    F.get(mask, code).alias("in_set")))


def subset_rows_long(cells: DataFrame, refs: DataFrame, members: DataFrame) -> DataFrame:
    """The same rows for analytes of any size. `members`: (analyte, fragment, Comment, in_set), one
    row per fragment of the stage's base."""
    rows = (cells.join(members, [ANALYTE, FRAGMENT])
            .join(refs, [ANALYTE, LABEL, FRAGMENT], "left")
            .select(*RUN, "Comment", FRAGMENT, "code", "x", "Area", "lib", "mean_area", "mean_err",
                    "err_score", "in_set"))
    keys = [*RUN, "Comment"]
    points = (rows.select(*keys, FRAGMENT, "in_set", F.posexplode("x").alias("pos", "value"))
              .filter(F.col("value").isNotNull()))
    total = (points.filter("in_set").groupBy(*keys, "pos").agg(F.sum("value").alias("total")))
    norm = total.groupBy(*keys).agg(F.sum(F.col("total") * F.col("total")).alias("tt"))
    dots = points.join(total, [*keys, "pos"], "left").groupBy(*keys, FRAGMENT).agg(
        F.sum(F.col("value") * F.coalesce("total", F.lit(0.0))).alias("xt"),
        F.sum(F.col("value") * F.col("value")).alias("xx"))
    scored = dots.join(norm, keys).select(
        *keys, FRAGMENT, cosine(F.col("xt"), F.col("xx"), F.col("tt")).alias("similarity"))
    return rows.drop("x").join(scored, [*keys, FRAGMENT], "left")
