"""Rank the fragments of an analyte and remove the worst ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peakloom.config import RefineParams
from peakloom.operators.quantiles import grouped_quantiles
from peakloom.schema import ANALYTE, FRAGMENT


def fragment_quartiles(rows: DataFrame, hot_rows: int = 1_000_000) -> DataFrame:
    """First quartile of similarity and of area, and the median mean mass error, per fragment over
    all runs of its analyte."""
    rounded = rows.select(ANALYTE, FRAGMENT, F.round("similarity", 9).alias("similarity"), "Area",
                          "mean_err")
    return grouped_quantiles(rounded, [ANALYTE, FRAGMENT],
                             {"q25_similarity": ("similarity", 0.25), "q25_area": ("Area", 0.25),
                              "median_error": ("mean_err", 0.5)}, hot_rows)


def classify(rows: DataFrame, library: DataFrame, hot_rows: int = 1_000_000) -> DataFrame:
    """Quartiles with their ranks (1 is best) and the library rank, per analyte and fragment."""
    table = fragment_quartiles(rows, hot_rows).join(
        library.select(ANALYTE, FRAGMENT, "Rank"), [ANALYTE, FRAGMENT], "left")
    best_first = lambda name: Window.partitionBy(ANALYTE).orderBy(
        F.round(name, 9).desc_nulls_last())
    return table.withColumns({"rank_similarity": F.rank().over(best_first("q25_similarity")),
                              "rank_area": F.rank().over(best_first("q25_area"))})


def number_to_remove(n: Column, params: RefineParams) -> Column:
    """How many of `n` fragments to drop: a fixed share, but never below the minimum to keep."""
    return F.greatest(F.lit(0), F.least(F.floor(n * F.lit(params.drop_fraction)),
                                        n - F.lit(params.min_fragments))).cast("int")


def mark_worst(classified: DataFrame, params: RefineParams) -> DataFrame:
    """Add `n` and the flag `worst`: the first rows, worst similarity rank first, then worst library
    rank, then fragment, up to the number to remove."""
    group = Window.partitionBy(ANALYTE)
    worst_first = group.orderBy(F.col("rank_similarity").desc(), F.col("Rank").desc_nulls_last(),
                                F.col(FRAGMENT))
    return (classified.withColumn("n", F.count("*").over(group))
            .withColumn("worst", F.row_number().over(worst_first)
                        <= number_to_remove(F.col("n"), params)))


def worst_n(classified: DataFrame, params: RefineParams) -> DataFrame:
    return mark_worst(classified, params).filter("worst").select(ANALYTE, FRAGMENT)


def high_error(classified: DataFrame, cutoff: float) -> DataFrame:
    """Fragments whose median mean mass error reaches the cutoff."""
    return classified.filter(F.col("median_error") >= cutoff).select(ANALYTE, FRAGMENT)


def surviving(classified: DataFrame, params: RefineParams, error_cut: bool) -> DataFrame:
    """(analyte, fragment, place) left after the worst ones and, if asked, those with a high median error
    are removed; `place` counts from the best rank. An analyte may lose all its fragments here; it then has
    no row."""
    marked = mark_worst(classified, params)
    drop = F.col("worst")
    if error_cut:
        drop = drop | F.coalesce(F.col("median_error") >= params.mass_error_cutoff, F.lit(False))
    return placed(marked.filter(~drop)).select(ANALYTE, FRAGMENT, "place")


def placed(classified: DataFrame) -> DataFrame:
    """Adds `place`: 1 for the best similarity rank, then the best library rank, then the first fragment."""
    best_first = Window.partitionBy(ANALYTE).orderBy("rank_similarity", F.col("Rank").asc_nulls_last(), FRAGMENT)
    return classified.withColumn("place", F.row_number().over(best_first))
