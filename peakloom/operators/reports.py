"""The five report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakloom.functions.scores import composite_score, na_text
from peakloom.operators.prefilter import null_safe_join
from peakloom.schema import ANALYTE, FRAGMENT, LABEL, REP

_SCORES = {"SimilarityScore": "Similarity_Score", "MPRAScore": "MPRA_Score",
           "Librarydotp": "SpectralLibSim_Score", "ScoreMassError": "MassError_Score",
           "Skor": "Score"}


def annotate(df: DataFrame, analytes: DataFrame, reps: DataFrame) -> DataFrame:
    """Attach the original analyte and replicate columns. The glossaries grow with the data, so the
    planner decides by their size whether to broadcast them."""
    return null_safe_join(null_safe_join(df, analytes, [ANALYTE], "left"), reps, [REP], "left")


def report_boundaries(boundaries: DataFrame, analytes: DataFrame, reps: DataFrame,
                      as_text: bool = True) -> DataFrame:
    """Boundaries per file and peptide; missing times read `#N/A` in the text form."""
    limit = (lambda name: na_text(F.col(name)).alias(name)) if as_text else F.col
    return annotate(boundaries, analytes, reps).select(
        "FileName", "PeptideModifiedSequence", limit("MinStartTime"), limit("MaxEndTime"),
        "PrecursorCharge", F.col("IsDecoy").alias("PrecursorIsDecoy")).distinct()


def report_transitions(kept: DataFrame, locators: DataFrame) -> DataFrame:
    """Every locator with TRUE if its transition was kept; a kept transition without locator shows
    up with a null locator."""
    marked = kept.select(FRAGMENT, ANALYTE).withColumn("_kept", F.lit(True))
    joined = locators.join(marked, [FRAGMENT, ANALYTE], "full")
    return joined.select(F.col("TransitionLocator").alias("ElementLocator"),
                         F.coalesce("_kept", F.lit(False)).alias("Quantitative"))


def with_composite(scores: DataFrame) -> DataFrame:
    return scores.withColumn("Skor", composite_score(
        F.col("SimilarityScore"), F.col("Librarydotp"), F.col("ScoreMassError"), F.col("MPRAScore")))


def report_scores(scores: DataFrame, analytes: DataFrame, reps: DataFrame) -> DataFrame:
    """Replicate scores of any stage with the composite score and the original columns."""
    return with_composite(annotate(scores, analytes, reps))


report_replicates = report_scores
report_rescore = report_scores


def report_annotations(rescored: DataFrame, analytes: DataFrame, reps: DataFrame,
                       precursors: DataFrame, tag: str = "", as_text: bool = True) -> DataFrame:
    """One row per precursor result with its five scores. `tag` goes into the column names
    (`annotation_<tag>Score`) for tools that expect one."""
    keys = [LABEL, "ProteinName", "PeptideModifiedSequence", "PrecursorCharge", "IsDecoy", "FileName"]
    scores = report_scores(rescored, analytes, reps).select(*keys, *_SCORES)
    joined = null_safe_join(precursors, scores, keys, "left")
    value = (lambda name: na_text(F.col(name))) if as_text else F.col
    return joined.select(F.col("PrecursorResultLocator").alias("ElementLocator"),
                         *[value(name).alias(f"annotation_{tag}{suffix}")
                           for name, suffix in _SCORES.items()])
