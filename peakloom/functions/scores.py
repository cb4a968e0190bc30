"""Scalar scores and text forms of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from peakloom.config import SCORE_EXPONENTS


def mass_error_score(error: Column, tolerance: float, cutoff: float) -> Column:
    """1 up to the tolerance, falling in a straight line to 0 at the cutoff."""
    span = cutoff - tolerance
    return (F.when(error <= tolerance, F.lit(1.0))
            .when(error <= cutoff, F.lit(cutoff / span) - error / F.lit(span))
            .when(error.isNotNull(), F.lit(0.0)))


def composite_score(similarity: Column, library: Column, mass_error: Column, profile: Column,
                    exponents: tuple[float, float, float, float] = SCORE_EXPONENTS) -> Column:
    """Product of the four scores raised to their exponents; null instead of NaN."""
    product = F.lit(1.0)
    for score, exponent in zip((similarity, library, mass_error, profile), exponents):
        product = product * F.pow(score, F.lit(exponent))
    return F.when(~F.isnan(product), product)


def at_most_one(value: Column) -> Column:
    """Undo rounding errors above 1; null stays null."""
    return F.when(value > 1, F.lit(1.0)).otherwise(value)


def cosine(dot_xy: Column, dot_xx: Column, dot_yy: Column) -> Column:
    """Cosine from inner products, null for an empty vector; rounding never lifts it above 1."""
    return at_most_one(F.try_divide(dot_xy, F.sqrt(dot_xx * dot_yy)))


def na_text(col: Column, numeric: bool = True) -> Column:
    """Text with `#N/A` for missing; a number keeps all its digits and reads back as itself."""
    if not numeric:
        return F.coalesce(col.cast("string"), F.lit("#N/A"))
    text = F.when(~F.isnan(col), col).cast("string")
    return F.coalesce(F.regexp_replace(text, r"\.0(?=E|$)", ""), F.lit("#N/A"))


def ion_token(col: Column) -> Column:
    """The fragment ion up to its first blank."""
    return F.substring_index(col, " ", 1)

