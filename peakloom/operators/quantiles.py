"""Exact grouped quantiles that stay safe when one group holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakloom.session import materialise

#: Bits of a value's position that one round of the narrowing settles.
DIGIT = 11


def grouped_quantiles(df: DataFrame, keys: Sequence[str], specs: dict[str, tuple[str, float]],
                      hot_rows: int = 1_000_000) -> DataFrame:
    """One row per key with the quantiles in `specs` (alias -> (column, fraction)), by linear
    interpolation, nulls and NaN left out.

    Ordinary groups use the built-in exact percentile. Its buffer holds a whole group, so keys with
    more than `hot_rows` rows are taken out and their order statistics found by `order_statistics`. The hot
    keys are looked for at once, in one count; without any, the plan is a single aggregate.
    """
    keys = list(keys)
    inputs = {column: f"_v{i}" for i, column in enumerate(dict.fromkeys(c for c, _ in specs.values()))}
    rows = df.select(*keys, *[F.when(~F.isnan(column), F.col(column)).cast("double").alias(name)
                              for column, name in inputs.items()])
    exact = [F.percentile(inputs[column], F.lit(q)).alias(alias) for alias, (column, q) in specs.items()]
    hot = materialise(rows.groupBy(*keys).agg(F.count("*").alias("_n"))
                      .filter(F.col("_n") > hot_rows).select(*keys), "hot-keys")
    if hot.isEmpty():
        return rows.groupBy(*keys).agg(*exact)
    small = rows.join(hot, keys, "left_anti").groupBy(*keys).agg(*exact)
    # one long table of all wanted columns: all hot groups, columns and fractions narrow together
    named = F.explode(F.array(*[F.struct(F.lit(name).alias("_c"), F.col(name).alias("_v")) for name in inputs.values()]))
    long = materialise(rows.join(hot, keys, "left_semi").select(*keys, named.alias("_s"))
                       .select(*keys, "_s._c", "_s._v").filter(F.col("_v").isNotNull()), "hot-values")
    totals = long.groupBy(*keys, "_c").agg(F.count("*").alias("_n"))
    wants = [F.struct(F.lit(alias).alias("a"), F.lit(inputs[column]).alias("c"), F.lit(q).alias("q"))
             for alias, (column, q) in specs.items()]
    at = F.col("_w.q") * (F.col("_n") - 1)
    wanted = (totals.select(*keys, "_c", "_n", F.explode(F.array(*wants)).alias("_w")).filter("_w.c = _c")
              .select(*keys, "_c", F.col("_w.a").alias("_a"), at.alias("_at")))
    ranks = wanted.select(*keys, "_c", F.explode(F.array(F.floor("_at"), F.ceil("_at"))).alias("_rank")).distinct()
    found = materialise(order_statistics(long, [*keys, "_c"], "_v", ranks, "_rank"), "order-statistics")
    value = lambda rank, name: found.select(*keys, "_c", F.col("_rank").alias(rank), F.col("_v").alias(name))
    both = (wanted.withColumns({"_lo": F.floor("_at"), "_hi": F.ceil("_at")})
            .join(value("_lo", "_low"), [*keys, "_c", "_lo"]).join(value("_hi", "_high"), [*keys, "_c", "_hi"]))
    values = both.select(*keys, "_a", (F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("_at") - F.col("_lo"))).alias("_q"))
    pick = [F.max(F.when(F.col("_a") == alias, F.col("_q"))).alias(alias) for alias in specs]
    return small.unionByName(hot.join(values, keys, "left").groupBy(*keys).agg(*pick))


def places(values: pd.Series) -> pd.Series:
    """A double's place in the order of all doubles, as a long: its bits, those of negative values turned over
    below the sign; both zeros share a place."""
    bits = (values.to_numpy(np.float64) + 0.0).view(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits))


def order_statistics(rows: DataFrame, keys: list[str], value: str, ranks: DataFrame, rank: str) -> DataFrame:
    """(keys, rank, value): the values at zero-based ranks within their group, exact. No nulls or NaN.

    Distributed selection: every round counts the values still in question by the next bits of their place,
    map-side, and keeps those that share the bits of a wanted value. After 64 bits one place is left. What is
    shuffled are counts, at most 2^DIGIT per group and rank; no group is gathered, and each round reads only
    what the one before left.
    """
    place = F.pandas_udf(places, T.LongType())
    live = materialise(rows.select(*keys, place(F.col(value)).alias("_p"), F.col(value).alias("_x")), "places")
    zero = F.lit(0).cast("bigint")
    state, before, shift = ranks.select(*keys, F.col(rank).alias("_k"), F.col(rank).alias("_rest"), zero.alias("_pre")), zero, 64
    while shift:
        shift = max(0, shift - DIGIT)
        part = F.shiftright("_p", shift)
        counts = live.groupBy(*keys, before.alias("_pre"), part.alias("_part")).agg(
            F.count("*").alias("_n"), F.min("_x").alias("_x"))
        upto = F.sum("_n").over(Window.partitionBy(*keys, "_k").orderBy("_part"))
        at = state.select(*keys, "_k", "_rest", "_pre").join(counts, [*keys, "_pre"]).withColumn("_upto", upto)
        hit = at.filter((F.col("_upto") > F.col("_rest")) & (F.col("_upto") - F.col("_n") <= F.col("_rest")))
        state = materialise(hit.select(*keys, "_k", (F.col("_rest") - F.col("_upto") + F.col("_n")).alias("_rest"),
                                       F.col("_part").alias("_pre"), "_x"), "brackets")
        wanted = state.select(*keys, F.col("_pre").alias("_part")).distinct()
        if shift:
            live = materialise(live.withColumn("_part", part).join(wanted, [*keys, "_part"], "left_semi")
                               .drop("_part"), "places")
        before = part
    return state.select(*keys, F.col("_k").alias(rank), F.col("_x").alias(value))
