"""SimHash near-duplicates by tiled exact comparison.

`fingerprints` hashes the 4-word shingles of whole texts. `links` range-sorts the distinct fingerprints by
population count and cuts them into tiles; two tiles meet only if their counts can differ by no more than
the radius, and are compared whole with exclusive-or and bit counts. A pair of tiles returns a spanning
forest of its links, so a large group of near copies costs as many edges as it has fingerprints.

The number of tile pairs grows with the square of the distinct fingerprints: this is the exact method, not
an index. Copies meet as one fingerprint.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; a text of fewer
than four words is one shingle; rows without doc_id are labelled like the rest but never name a component
(null if none of it has an id); an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakloom.llm.common import masked, parts
from peakloom.llm.components import components
from peakloom.session import materialise

SHINGLE = 4
SEED = 42
RADIUS = 4
TILE = 8192


def simhash(text: str | None) -> int:
    """The fingerprint of one text as a signed 64-bit integer."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, size = memoryview(b" ".join(words)), min(SHINGLE, len(words))
    ends = list(accumulate(map(len, words), lambda end, n: end + 1 + n))
    starts = [0, *(end + 1 for end in ends)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1:])), np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        octets = hashes[k:k + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row."""
    def run(batches):
        for batch in batches:
            fps = pa.array([simhash(t.as_py()) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["doc_id", "fp"])
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, fp bigint")


def _tiles(fps: DataFrame, tile: int) -> DataFrame:
    """(tile, low, high, fps): runs of sorted fingerprints as bytes, with their population counts."""
    def run(batches):
        held = np.empty(0, np.int64)
        for batch in batches:
            held = np.concatenate([held, batch.column("fp").to_numpy()])
            while len(held) >= tile:
                yield _row(held[:tile])
                held = held[tile:]
        if len(held):
            yield _row(held)

    def _row(values):
        bits = np.bitwise_count(values.view(np.uint64))
        return pa.RecordBatch.from_arrays(
            [pa.array([int(values[0])]), pa.array([int(bits[0])]), pa.array([int(bits[-1])]),
             pa.array([values.tobytes()], pa.binary())], ["tile", "low", "high", "fps"])
    counted = fps.select("fp", F.bit_count("fp").alias("_bits"))
    return counted.repartitionByRange(parts(fps), "_bits", "fp").sortWithinPartitions("_bits", "fp").mapInArrow(
        run, "tile bigint, low bigint, high bigint, fps binary")


def _forest(one: np.ndarray, two: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the links between two tiles (sorted by bit count) connect."""
    count, both = np.bitwise_count(two).astype(np.int16), np.concatenate([one, two])
    bits = np.bitwise_count(one).astype(np.int16)
    root = np.arange(len(both))
    for k in range(0, len(one), 32):
        rows = one[k:k + 32]
        lo = np.searchsorted(count, bits[k] - radius, "left")
        hi = np.searchsorted(count, bits[k + len(rows) - 1] + radius, "right")
        i, j = np.nonzero(np.bitwise_count(rows[:, None] ^ two[None, lo:hi]) <= radius)
        i, j = i + k, j + lo + len(one)
        while len(i):
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(root, up := root[root]):
                root = up
    moved = np.flatnonzero(both != both[root])
    return both[moved].view(np.int64), both[root[moved]].view(np.int64)


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """From distinct (fp): edges (a, b) whose components are those of all links within the radius."""
    tiles = materialise(_tiles(fps, tile), "tiles")
    near = tiles.select("tile", F.explode(F.sequence(F.col("low") - radius, F.col("high") + radius)).alias("_bits"))
    other = tiles.select(F.col("tile").alias("other"), F.explode(F.sequence("low", "high")).alias("_bits"))
    pairs = near.join(other, "_bits").where("tile <= other").select("tile", "other").distinct()
    dealt = pairs.join(tiles.select("tile", "fps"), "tile").join(
        tiles.select(F.col("tile").alias("other"), F.col("fps").alias("more")), "other").select(
        "fps", "more").repartition(max(parts(fps), 2))

    def run(batches):
        for batch in batches:
            for one, two in zip(*(batch.column(k) for k in (0, 1))):
                a, b = _forest(*(np.frombuffer(x.as_buffer(), np.uint64) for x in (one, two)), radius)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
    return dealt.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(doc_id, fp, component_id): one row per document."""
    rows = materialise(fingerprints(docs), "fingerprints")
    first = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    group = materialise(components(links(first.select("fp"), radius, tile)), "groups")
    labelled = first.join(group, first["fp"] == group["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    smallest = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    named = labelled.join(smallest, "component").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def _hashable(field: T.StructField) -> Column:
    """A column whose hash Spark can take: maps have none, so what holds one is hashed as JSON."""
    value = F.col(f"`{field.name}`")
    return F.to_json(F.struct(value)) if "map<" in field.dataType.simpleString() else value


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All columns of one row per component: the row of its smallest doc_id. Rows that share an id count as
    one document, the one with the smallest hash of its values stays; rows without an id all stay. Other columns
    stay whatever their names and types.

    Hashes are grouped, not rows: a whole row meets its id's smallest hash once, and only rows equal in all
    values are grouped."""
    aside, back = masked(docs, "doc_id", "text")
    named = near_duplicates(aside, radius)
    keep = named.where("doc_id = component_id").select("doc_id").distinct()
    hashed = aside.withColumn("_hash", F.xxhash64(*map(_hashable, aside.schema.fields)))
    least = hashed.groupBy("doc_id", "_hash").agg(F.count("*").alias("_n")).groupBy("doc_id").agg(
        F.min(F.struct("_hash", "_n")).alias("_least"))
    chosen = materialise(least.join(keep, "doc_id", "left_semi").select("doc_id", "_least.*"), "chosen")
    kept = hashed.join(chosen.where("_n = 1"), ["doc_id", "_hash"])
    ties = chosen.where("_n > 1")
    if not ties.isEmpty():
        kept = kept.unionByName(hashed.join(ties, ["doc_id", "_hash"]).dropDuplicates(["doc_id"]))
    return back(kept.drop("_hash", "_n").unionByName(aside.where("doc_id is null")))
