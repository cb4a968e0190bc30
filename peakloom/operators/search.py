"""Search for the fragment subset with the best mean composite score over an analyte's runs.

Analytes of at most `every` kept fragments (the refinement: `RefineParams.exhaustive_limit`) have all their
subsets scored, and the best one wins. The others, whose subsets are too many to list, climb: the starts are the
full set, the prefixes by rank, the full set without each one fragment, and the previous solution; from every
start the subset moves to its best neighbour (one fragment more or less) while that scores higher, and the best
end wins. Scores are compared at nine
decimals; ties go to the larger subset, then to the one that holds the first fragment in which they differ.
Subsets have at least the minimum number of fragments, or all of them if fewer are left. Runs without any
fragment of a subset count as zero.

`search_subsets` goes analyte by analyte over run matrices, where these are small (`RefineParams.list_limit`
and `local_limit`); `flip_search` takes the same steps for the others without gathering anything.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peakloom.config import SCORE_EXPONENTS, RefineParams
from peakloom.functions.traces import bind
from peakloom.schema import ANALYTE, FRAGMENT, LABEL, REP

TERMS = 7
BEST = f"{ANALYTE} string, kept array<boolean>, solution array<boolean>, fitness double"


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def proposals(kept: DataFrame, fragments: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Per analyte, arrays over its fragment codes: `place` (rank among the kept fragments, best first; null
    where not kept) and `was`, the previous solution. `kept` has analyte, fragment and place; `fragments` the
    sorted list `frags`; `previous` analyte and fragment."""
    rows = kept.select(ANALYTE, FRAGMENT, "place")
    if previous is None:
        rows = rows.withColumn("was", F.lit(False))
    else:
        marked = previous.select(ANALYTE, FRAGMENT).withColumn("_was", F.lit(True))
        rows = rows.join(marked, [ANALYTE, FRAGMENT], "left").select(
            ANALYTE, FRAGMENT, "place", F.coalesce("_was", F.lit(False)).alias("was"))
    coded = rows.join(fragments, ANALYTE).select(
        ANALYTE, "n_frag", F.struct((F.array_position("frags", F.col(FRAGMENT)) - 1).cast("int"),
                                    F.struct(F.col("place").cast("int").alias("place"), "was")).alias("entry"))
    at = lambda name: F.transform(F.sequence(F.lit(0), F.col("n_frag") - 1),
                                  lambda c: F.try_element_at("entries", c)[name])
    return (coded.groupBy(ANALYTE, "n_frag").agg(F.map_from_entries(F.collect_list("entry")).alias("entries"))
            .select(ANALYTE, "n_frag", at("place").alias("place"), at("was").alias("was")))


def climber(minimum: int, exponents: tuple[float, float, float, float] = SCORE_EXPONENTS, every: int = 0):
    """A `mapInArrow` function over rows (analyte, place, was, g, t, nth), the runs of an analyte numbered from 1
    and following one another; one analyte is held at a time. g and t are the inner products and additive terms of its kept fragments in one run.
    Up to `every` kept fragments all subsets are scored.

    Subsets are whole numbers, the first fragment in the highest bit, of any width. Nothing of this package is
    referenced inside, so executors need only numpy and pyarrow.
    """
    terms, analyte_column = TERMS, ANALYTE

    def totals(g, t, bits):
        """Composite score of each subset, summed over the runs."""
        norms = np.sqrt(np.einsum("bii->bi", g))
        inverse = np.divide(1.0, norms, out=np.zeros_like(norms), where=norms > 0)
        out = np.empty(len(bits))
        step = max(1, 4_000_000 // g[:, 0].size)
        for some in (slice(i, i + step) for i in range(0, len(bits), step)):
            part = bits[some]
            inside = part @ g
            q = np.einsum("bmi,mi->bm", inside, part)
            r = np.einsum("bmi,bi,mi->bm", inside, inverse, part)
            n, e, aa, al, ll, ap, pp = np.moveaxis(part @ t, 2, 0)
            with np.errstate(all="ignore"):
                product = 1.0
                for share, exponent in zip((r / (n * np.sqrt(q)), al / np.sqrt(aa * ll), e / n,
                                            ap / np.sqrt(aa * pp)), exponents):
                    product = product * np.minimum(share, 1.0) ** exponent
            out[some] = np.nan_to_num(product, nan=0.0, posinf=0.0).sum(axis=0)
        return out

    listed: dict[int, tuple] = {}

    def best_of_all(g, t):
        k = g.shape[1]
        if k not in listed:
            masks = np.arange(1, 1 << k)
            size = np.bitwise_count(masks)
            masks, size = masks[size >= min(minimum, k)], size[size >= min(minimum, k)]
            # the order of ties: the larger subset last, then the one that holds the first fragment
            masks = masks[np.lexsort((masks, size))]
            listed[k] = masks, (masks[:, None] >> np.arange(k - 1, -1, -1) & 1).astype(float)
        masks, bits = listed[k]
        score = np.floor(totals(g, t, bits) / len(g) * 1e9 + 0.5).astype(np.int64)
        at = int(np.flatnonzero(score == score.max())[-1])
        return (bits[at] > 0).tolist(), int(score[at]) / 1e9

    def climb(g, t, places, was):
        k = len(places)
        least, wide = min(minimum, k), (k + 7) // 8
        one = [1 << (k - 1 - c) for c in range(k)]
        known: dict[int, int] = {}

        def score(masks):
            new = sorted({m for m in masks if m not in known})
            if new:
                raw = np.frombuffer(b"".join(m.to_bytes(wide, "big") for m in new), np.uint8).reshape(-1, wide)
                bits = np.unpackbits(raw, axis=1)[:, 8 * wide - k:].astype(float)
                known.update(zip(new, np.floor(totals(g, t, bits) / len(g) * 1e9 + 0.5).astype(np.int64).tolist()))

        def key(mask):
            return known[mask], mask.bit_count(), mask

        full, prefix = (1 << k) - 1, 0
        starts = {full, sum(bit for bit, held in zip(one, was) if held)}
        for c in np.argsort(places).tolist():
            prefix |= one[c]
            starts |= {prefix, full ^ one[c]}
        moving, seen, ends = {m for m in starts if m.bit_count() >= least}, set(), set()
        while moving:
            around = {m: [m ^ bit for bit in one if (m ^ bit).bit_count() >= least] for m in moving}
            score([*moving, *(x for near in around.values() for x in near)])
            seen |= moving
            best = {m: max(near, key=key, default=m) for m, near in around.items()}
            ends |= {m for m in moving if known[best[m]] <= known[m]}
            moving = {best[m] for m in moving - ends} - seen
        chosen = max(ends, key=key)
        return [bool(chosen & bit) for bit in one], known[chosen] / 1e9

    def run(batches):
        def finish(analyte, place, was, rows):
            codes = [c for c, p in enumerate(place) if p is not None]
            k = len(codes)
            flat = np.concatenate([x for x, _ in rows]).reshape(-1, k, k)
            side = np.concatenate([y for _, y in rows]).reshape(-1, k, terms)
            held, fitness = best_of_all(flat, side) if k <= every else climb(
                flat, side, [place[c] for c in codes], [was[c] for c in codes])
            solution = [False] * len(place)
            for c, inside in zip(codes, held):
                solution[c] = inside
            return analyte, [p is not None for p in place], solution, fitness

        def batch_of(done):
            flags = pa.list_(pa.bool_())
            return pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(zip(*done), (pa.string(), flags, flags, pa.float64()))],
                names=[analyte_column, "kept", "solution", "fitness"])
        now, rows, done = None, [], []
        for batch in batches:
            g, t = batch.column(3), batch.column(4)
            for k, nth in enumerate(batch.column(5).to_pylist()):
                if nth == 1:
                    if now:
                        done.append(finish(*now, rows))
                    now, rows = (batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), batch.column(2)[k].as_py()), []
                    if len(done) >= 4096:
                        yield batch_of(done)
                        done = []
                rows.append((g[k].values.to_numpy(), t[k].values.to_numpy()))
        if now:
            done.append(finish(*now, rows))
        if done:
            yield batch_of(done)

    return run


def search_subsets(grams: DataFrame, proposed: DataFrame, params: RefineParams, every: int = 0) -> DataFrame:
    """(analyte, kept, solution, fitness), flags over the fragment codes, from `gram_table` and `proposals`. Up to
    `every` kept fragments all subsets are scored.

    The rows are cut to the kept fragments before the only shuffle, on the analyte; `grams` holds analytes of
    bounded size alone.
    """
    rows = grams.join(proposed.select(ANALYTE, "place", "was"), ANALYTE)
    codes = F.filter(F.sequence(F.lit(0), F.col("n_frag") - 1), lambda c: F.get("place", c).isNotNull())
    rows = rows.withColumn("codes", codes)

    def terms(code: Column) -> Column:
        return bind(F.get("slots", code), lambda s: F.when(
            s.isNull(), F.array_repeat(F.lit(0.0), TERMS)).otherwise(F.array(
                F.lit(1.0), _zero(s["err_score"]), _zero(s["area"] * s["area"]),
                _zero(s["area"] * s["lib"]), _zero(s["lib"] * s["lib"]),
                _zero(s["area"] * s["mean_area"]), _zero(s["mean_area"] * s["mean_area"]))))

    matrix = F.transform("codes", lambda a: bind(F.get("gram", a), lambda row: F.transform(
        "codes", lambda b: F.get(row, b))))
    cut = rows.select(ANALYTE, "place", "was", F.flatten(matrix).alias("g"),
                      F.flatten(F.transform("codes", terms)).alias("t"), REP, LABEL)
    # the window brings the runs of an analyte together, in order; a plain repartition may be optimised away
    numbered = cut.withColumn("nth", F.row_number().over(Window.partitionBy(ANALYTE).orderBy(REP, LABEL)))
    return numbered.drop(REP, LABEL).mapInArrow(climber(params.min_fragments, every=every), BEST)


def mask_fragments(masks: DataFrame, fragments: DataFrame, mask: str) -> DataFrame:
    """(analyte, fragment) rows of a column of flags."""
    listed = F.explode(F.filter("frags", lambda _, i: F.get(mask, i)))
    return (masks.select(ANALYTE, mask).join(fragments.select(ANALYTE, "frags"), ANALYTE)
            .select(ANALYTE, listed.alias(FRAGMENT)))
