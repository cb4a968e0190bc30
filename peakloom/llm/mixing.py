"""Weighted fair queueing of sources.

Every document, in a shuffled order within its source, gets a virtual finish time: the source's tokens up
to and with it, divided by the source's target. All sources together are then range-sorted by finish time
and cut where the total reaches the budget. A source whose target exceeds its size is passed through
again, up to `passes` times, its clock running on.

Defined cases: a null text has size 0 and is never taken; a null source is a source of its own, sorted
last; documents that share a doc_id are ordered by their text, equal rows tie and are taken alike; an
empty table gives an empty result; other columns stay whatever their names, those named like a result column are
replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakloom.llm.common import masked, running_total, set_aside, word_count
from peakloom.session import materialise

WEIGHTS = (3, 1, 2)
SHARE = 1.5
PASSES = 2
OUT = ["size", "source_size", "target", "taken"]


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            passes: int = PASSES) -> DataFrame:
    """From (source, source_size): adds `target`, the fair share of the budget.

    Sources whose share exceeds `passes` times their size stop there; the rest is shared again by weight
    until no source is above. Each round is one aggregate over the sources; only two numbers return.
    """
    ranked = running_total(
        sizes.withColumns({"_null": F.col("source").isNull(), "_one": F.lit(1)}),
        ["_null", "source"], "_one", "_rank")
    place = (F.col("_rank") - 1) % len(weights)
    ranked = materialise(ranked.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int"))).drop(
        "_null", "_one", "_rank"), "sources")
    most = F.col("source_size") * passes
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = -1.0
    while True:
        full = most <= F.lit(level) * F.col("weight")
        capped, rest = ranked.agg(F.sum(F.when(full, most).otherwise(0)),
                                  F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        now = (share * total - (capped or 0)) / rest if rest else float(level)
        if now <= level:
            break
        level = now
    target = F.when(most <= F.lit(level) * F.col("weight"), most.cast("double")).otherwise(
        F.lit(level) * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
        passes: int = PASSES, seed: str = "mix") -> DataFrame:
    """All rows and columns of `docs` with size, source_size, target, and taken: words the mix takes."""
    aside, kept = set_aside(docs, ["doc_id", "text", "source"], OUT)
    keyed = aside.withColumns({
        "_null": F.col("source").isNull(), "_tie": F.md5(F.coalesce(F.col("text"), F.lit(""))),
        "_key": F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))})
    small = materialise(keyed.select("_null", "source", "_key", "_tie", word_count("text").alias("size")), "sizes")
    goal = materialise(targets(small.groupBy("source").agg(F.sum("size").alias("source_size")),
                               weights, share, passes), "targets")
    begin = running_total(goal.withColumn("_null", F.col("source").isNull()), ["_null", "source"],
                          "source_size", "_upto").select(
        F.col("source").alias("_source"), "source_size", "target",
        (F.col("_upto") - F.col("source_size")).alias("_before"))
    summed = running_total(small, ["_null", "source", "_key", "_tie"], "size", "_sum")
    clock = materialise(
        summed.join(begin, summed["source"].eqNullSafe(begin["_source"]))
        .withColumn("_cum", F.col("_sum") - F.col("_before")).drop("_sum", "_before", "_source"), "clock")
    finish = (F.col("_pass") * F.col("source_size") + F.col("_cum")) / F.col("target")
    order = ["finish", "_null", "source", "_pass", "_key", "_tie"]
    visits = clock.where("size > 0").withColumn(
        "_pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1)))).select(
        finish.alias("finish"), *order[1:], "size")
    served = running_total(visits, order, "size", "_served")
    total, = goal.agg(F.sum("source_size")).first()
    cut = served.where(F.col("_served") > share * (total or 0)).agg(
        F.min(F.struct(*[F.coalesce("source", F.lit("")).alias("source") if c == "source" else F.col(c)
                         for c in order])).alias("cut")).first()["cut"]
    taken = F.lit(0)
    for k in range(passes):
        here = F.struct(((F.lit(k) * F.col("source_size") + F.col("_cum")) / F.col("target")).alias("finish"),
                        F.col("_null"), F.coalesce("source", F.lit("")), F.lit(k), F.col("_key"), F.col("_tie"))
        before = F.lit(True) if cut is None else here < F.struct(*map(F.lit, cut))
        taken = taken + F.when((F.col("size") > 0) & before, F.col("size")).otherwise(0)
    once = clock.dropDuplicates(["source", "_key", "_tie"]).withColumn("taken", taken.cast("bigint"))
    at = once.select(F.col("source").alias("_s"), F.col("_key").alias("_k"), F.col("_tie").alias("_t"), *OUT)
    return keyed.join(at, keyed["source"].eqNullSafe(at["_s"]) & (keyed["_key"] == at["_k"])
                      & (keyed["_tie"] == at["_t"])).select(*kept, *OUT)


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with their own columns only."""
    aside, back = masked(docs, "doc_id", "text", "source")
    rows = mix(aside, **how).where("taken > 0")
    times = F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int"))
    return back(rows.withColumn("_times", F.explode(times)))
