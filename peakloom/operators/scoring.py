"""Replicate and transition score tables from the long subset rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakloom.functions.scores import cosine
from peakloom.operators.quantiles import grouped_quantiles
from peakloom.schema import ANALYTE, FRAGMENT, LABEL, RUN, SCORE_COLUMNS
from peakloom.session import materialise

# Scores are compared with quantiles of themselves at this many decimals, so that the order of a
# floating-point sum cannot decide a tie.
DECIMALS = 9

STAGE_RUN = [*RUN, "Comment"]


def run_scores(rows: DataFrame) -> DataFrame:
    """Per run and stage: mean similarity (null if any is null), mean mass-error score, library
    cosine, and the share of the base area that lies in the subset."""
    inside = F.col("in_set")
    pick = lambda name: F.when(inside, F.col(name))
    area, lib = F.coalesce(pick("Area"), F.lit(0.0)), F.coalesce(pick("lib"), F.lit(0.0))
    sums = rows.groupBy(*STAGE_RUN).agg(
        F.count_if(inside).alias("n"), F.count(pick("similarity")).alias("n_sim"),
        F.avg(pick("similarity")).alias("avg_sim"), F.avg(pick("err_score")).alias("avg_err"),
        F.sum(area * area).alias("aa"), F.sum(area * lib).alias("al"), F.sum(lib * lib).alias("ll"),
        F.sum(area).alias("a_in"), F.sum("Area").alias("a_base"))
    return sums.select(
        *STAGE_RUN,
        F.round(F.when(F.col("n") == F.col("n_sim"), F.col("avg_sim")), DECIMALS).alias("SimilarityScore"),
        F.round("avg_err", DECIMALS).alias("ScoreMassError"),
        cosine(F.col("al"), F.col("aa"), F.col("ll")).alias("Librarydotp"),
        F.try_divide("a_in", "a_base").alias("IntensityScore"))


def best_runs(scores: DataFrame, hot_rows: int) -> DataFrame:
    """Runs in the best quarter of their analyte by similarity or by mass error."""
    limits = grouped_quantiles(scores, [ANALYTE, "Comment"],
                               {"q_sim": ("SimilarityScore", 0.75), "q_err": ("ScoreMassError", 0.75)},
                               hot_rows)
    reached = lambda score, limit: F.coalesce(
        F.col(score) >= F.round(limit, DECIMALS), F.lit(False))
    return (scores.select(*STAGE_RUN, "SimilarityScore", "ScoreMassError")
            .join(limits, [ANALYTE, "Comment"])
            .select(*STAGE_RUN, (reached("SimilarityScore", "q_sim")
                                 | reached("ScoreMassError", "q_err")).alias("best")))


def profile_scores(rows: DataFrame, best: DataFrame) -> DataFrame:
    """Cosine of each run's areas with the mean-area profile of the best runs of its label; a
    fragment no best run has takes its mean over all runs."""
    chosen = rows.filter("in_set").select(*STAGE_RUN, FRAGMENT, "Area")
    keys = [ANALYTE, LABEL, "Comment", FRAGMENT]
    profile = chosen.join(best, STAGE_RUN).groupBy(*keys).agg(
        F.coalesce(F.avg(F.when(F.col("best"), F.col("Area"))), F.avg("Area")).alias("p"))
    a, p = F.coalesce("Area", F.lit(0.0)), F.coalesce("p", F.lit(0.0))
    sums = chosen.join(profile, keys).groupBy(*STAGE_RUN).agg(
        F.sum(a * p).alias("ap"), F.sum(a * a).alias("aa"), F.sum(p * p).alias("pp"))
    return sums.select(*STAGE_RUN, cosine(F.col("ap"), F.col("aa"), F.col("pp")).alias("MPRAScore"))


def score_replicates(rows: DataFrame, hot_rows: int = 1_000_000) -> DataFrame:
    """The replicate score table of every stage in `rows`. `rows` is read several times, so pass a
    written table when it is costly to compute. The run scores are written before their quantiles
    are taken."""
    scores = materialise(run_scores(rows), "scores")
    profile = profile_scores(rows, best_runs(scores, hot_rows))
    return scores.join(profile, STAGE_RUN, "left").select(*SCORE_COLUMNS)


def score_transitions(rows: DataFrame) -> DataFrame:
    """Similarity per fragment and run of the subset."""
    return rows.filter("in_set").select(FRAGMENT, "similarity", *RUN)
