"""Optional row filters applied before the refinement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peakloom.config import RefineParams
from peakloom.functions.scores import ion_token
from peakloom.schema import ANALYTE, FRAGMENT, LABEL

PRECURSOR = ["ProteinName", "PeptideModifiedSequence", "PrecursorCharge", "IsDecoy"]
SIGNAL = [ANALYTE, FRAGMENT, LABEL, *PRECURSOR, "ProductMz", "ProductCharge", "FragmentIon"]


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join in which two missing keys match each other; the right key columns are dropped."""
    renamed = right.withColumnsRenamed({key: f"_r_{key}" for key in keys})
    condition = None
    for key in keys:
        equal = F.col(key).eqNullSafe(F.col(f"_r_{key}"))
        condition = equal if condition is None else condition & equal
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{k}" for k in keys])


def drop_unintegrated(df: DataFrame) -> DataFrame:
    """Drop rows without a start time."""
    return df.filter(F.col("MinStartTime").isNotNull())


def drop_low_ordinal(df: DataFrame, highest: int) -> DataFrame:
    """Drop precursor rows and the y and b ions with ordinal 0..`highest`."""
    ordinals = "|".join(str(k) for k in range(highest + 1))
    pattern = rf"precursor|^[yb](?:{ordinals})$"
    return df.filter(~F.coalesce(ion_token(F.col("FragmentIon")), F.lit("NA")).rlike(pattern))


def _with_count(signals: DataFrame, name: str, group: Sequence[str], *values: str) -> DataFrame:
    """Adds how many different `values` a group has; missing ones count as a value."""
    ranked = F.dense_rank().over(Window.partitionBy(*group).orderBy(*values))
    return (signals.withColumn("_rank", ranked)
            .withColumn(name, F.max("_rank").over(Window.partitionBy(*group))).drop("_rank"))


def _complete(signals: DataFrame) -> DataFrame:
    rows = _with_count(signals, "_all", [ANALYTE], LABEL)
    return _with_count(rows, "_own", [ANALYTE, FRAGMENT], LABEL).filter("_own = _all").drop("_own", "_all")


def _unshared(signals: DataFrame) -> DataFrame:
    group = [c for c in (ANALYTE, *PRECURSOR, "ProductMz") if c in signals.columns]
    return _with_count(signals, "_n", group, "ProductCharge", "FragmentIon", LABEL).filter("_n = 1").drop("_n")


def _rich(signals: DataFrame, minimum: int) -> DataFrame:
    group = [c for c in (ANALYTE, *PRECURSOR, LABEL) if c in signals.columns]
    return _with_count(signals, "_n", group, "FragmentIon", "ProductCharge").filter(F.col("_n") >= minimum).drop("_n")


def _kept(df: DataFrame, signals: DataFrame) -> DataFrame:
    return null_safe_join(df, signals, signals.columns, "left_semi")


def require_all_labels(df: DataFrame) -> DataFrame:
    """Drop the fragments that do not occur in every label of their analyte."""
    return _kept(df, _complete(df.select(ANALYTE, FRAGMENT, LABEL).distinct()))


def drop_shared_signals(df: DataFrame) -> DataFrame:
    """Drop the product m/z values that several fragments or labels of one precursor have in common."""
    return _kept(df, _unshared(df.select(*PRECURSOR, "ProductMz", "ProductCharge", "FragmentIon", LABEL).distinct()))


def require_min_fragments(df: DataFrame, minimum: int) -> DataFrame:
    """Keep the precursors, per label, with at least `minimum` distinct fragments."""
    return _kept(df, _rich(df.select(*PRECURSOR, LABEL, "FragmentIon", "ProductCharge").distinct(), minimum))


def prefilter(df: DataFrame, params: RefineParams) -> DataFrame:
    """All filters in order. Fragments are counted before shared signals are dropped.

    The rows are read twice: once for the distinct signals (what the filters look at; replicates collapse
    map-side), once for the result. An analyte's id follows from its precursor, so all filters run on the
    signals of an analyte where they lie, after one shuffle.
    """
    rows = drop_low_ordinal(drop_unintegrated(df), params.remove_below_ordinal)
    complete = _complete(rows.select(*SIGNAL).distinct())
    group, label = [ANALYTE, *PRECURSOR], [ANALYTE, *PRECURSOR, LABEL]
    counted = _with_count(complete, "_fragments", label, "FragmentIon", "ProductCharge")
    counted = _with_count(counted, "_sharing", [*group, "ProductMz"], "ProductCharge", "FragmentIon", LABEL)
    kept = F.col("_fragments") >= params.min_initial_fragments
    if params.remove_shared_signals:
        kept = kept & (F.col("_sharing") == 1)
    return _kept(rows, counted.filter(kept).select(*SIGNAL))
