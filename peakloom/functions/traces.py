"""Array functions on one trace: parse, clean, cut to the integration zone, normalise."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often the body uses it. Without this, an
    expression used inside a lambda is computed again for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def parse_trace(col: Column) -> Column:
    """Comma-joined numbers to `array<double>`; what is no number becomes null."""
    return F.transform(F.split(F.translate(col, " ", ""), ","), lambda x: x.try_cast("double"))


def nan_to_zero(values: Column) -> Column:
    return F.transform(values, lambda y: F.when(F.isnan(y), F.lit(0.0)).otherwise(y))


def clamp_nonneg(values: Column) -> Column:
    return F.transform(values, lambda y: F.when(y < 0, F.lit(0.0)).otherwise(y))


def integration_zone(times: Column, low: Column, high: Column) -> Column:
    """0/1 per point: inside the inclusive limits, compared at five decimals."""
    limits = F.struct(F.round(low, 5).alias("low"), F.round(high, 5).alias("high"))
    return bind(limits, lambda z: F.transform(
        times, lambda t: F.when(F.round(t, 5).between(z["low"], z["high"]), 1).otherwise(0)))


def widen_single_point(flags: Column) -> Column:
    """If exactly one point is flagged, flag the one before it too (after it if it is the first)."""
    def neighbour(f: Column) -> Column:
        at = F.array_position(f, 1)
        single = F.aggregate(f, F.lit(0), lambda acc, z: acc + z) == 1
        return F.when(single, F.when(at == 1, F.lit(2)).otherwise(at - 1)).otherwise(F.lit(0))

    return bind(flags, lambda f: bind(neighbour(f), lambda extra: F.transform(
        f, lambda z, i: F.when(i + 1 == extra, 1).otherwise(z))))


def cut_to_zone(values: Column, flags: Column) -> Column:
    """Keep the points whose flag is 1."""
    return F.filter(values, lambda _, i: F.get(flags, i) == 1)


def normalise_trace(values: Column) -> Column:
    """Scale to a maximum of 100; an all-zero trace becomes null throughout."""
    return bind(values, lambda v: bind(F.array_max(v), lambda top: F.transform(
        v, lambda y: F.try_divide(y, top) * 100)))


def dot(xs: Column, ys: Column) -> Column:
    """Inner product; points missing on either side count as zero."""
    products = F.zip_with(xs, ys, lambda x, y: F.coalesce(x * y, F.lit(0.0)))
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def weighted_abs_mean(errors: Column, weights: Column) -> Column:
    """Mean of |error| with the given weights. Null errors are left out; a null weight on a present
    error makes the result null, as does a zero weight sum."""
    zero = F.lit(0.0)
    tops = F.zip_with(errors, weights, lambda e, w: F.when(e.isNull(), zero).otherwise(F.abs(e) * w))
    bottoms = F.zip_with(errors, weights, lambda e, w: F.when(e.isNull(), zero).otherwise(w))
    total = lambda terms: F.aggregate(terms, zero, lambda acc, t: acc + t)
    return F.try_divide(total(tops), total(bottoms))
