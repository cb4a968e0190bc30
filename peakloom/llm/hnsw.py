"""Approximate nearest neighbours by cosine: one hierarchical navigable small-world graph per shard.

Rows are dealt by a hash of their id to shards of about `shard_rows`. A shard's distinct vectors get random
levels; on each level a vector is linked to its nearest ones, thinned so that links point in different
directions, and to those that chose it. The index is one file of flat arrays per shard in the shared folder, and a
table that lists them. A search walks down the levels of every shard with many queries at once, scores what it
found in double precision on the original vectors, and the shards' best are merged. Queries lie in files too: what
is dealt are names of files, by shard, so a task reads a shard's graph once for all its blocks of queries.

Every row is indexed. Equal vectors of a shard share a node that lists all their ids in order, and how many rows
each id has; `k + 1` of them suffice for any query, as ties go to the smaller id. Links are chosen among all vectors
of the shard and level, a bounded number. Recall at 5, measured against brute force: see README.

Defined cases: vectors that are null, zero, or hold a null, NaN or infinite component take no part, neither do
rows without vec_id; vectors of different length are never compared; rows that share a vec_id are all
candidates, and none of them for their own id (such rows lie in several shards, equal ones are counted); fewer
than k candidates give fewer rows; vectors of doubles keep their precision, and very large or small ones
are scaled by powers of two; equal queries are asked once, queries that share a vec_id but not the vector share
the k places; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peakloom.llm.common import new_folder, open_file, parts, write_file
from peakloom.session import materialise

SHARD_ROWS = 8192
LINKS = 16
BREADTH = 96
BLOCK = 512

#: Tasks that may share a shard's questions.
SPREAD = 8

INDEX = "shard bigint, dim int, n_nodes bigint, file string"
#: The arrays of an index file, in order.
KINDS = {"ids": np.int64, "times": np.int64, "starts": np.int32, "vectors": np.float64, "levels": np.int32,
         "links": np.int32}


def vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & good
                      & F.exists("v", lambda x: x != 0))


def _thin(unit: np.ndarray, node: int, near: np.ndarray, count: int) -> list[int]:
    """Nearest first, leaving out those closer to one already taken than to the node; filled up again."""
    to_node, among = unit[near] @ unit[node], unit[near] @ unit[near].T
    taken: list[int] = []
    for k in range(len(near)):
        if not taken or among[k, taken].max() < to_node[k]:
            taken.append(k)
            if len(taken) == count:
                break
    rest = [k for k in range(len(near)) if k not in set(taken)]
    return near[(taken + rest)[:count]].tolist()


def _level(unit: np.ndarray, nodes: np.ndarray, count: int) -> np.ndarray:
    """Links of one level: rows of `2 * count` places, -1 where free."""
    inner, width = unit[nodes], min(3 * count, len(nodes) - 1)
    out = np.full((len(nodes), 2 * count), -1, np.int32)
    if width < 1:
        return out
    chosen: list[list[int]] = []
    for a in range(0, len(nodes), 1024):
        near = inner[a:a + 1024] @ inner.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
        top = np.argpartition(-near, width - 1, axis=1)[:, :width]
        order = np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable")
        for k, row in enumerate(np.take_along_axis(top, order, 1)):
            chosen.append(_thin(inner, a + k, row, count))
    back: list[list[int]] = [[] for _ in nodes]
    for k, row in enumerate(chosen):
        for other in row:
            back[other].append(k)
    for k, row in enumerate(chosen):
        both = list(dict.fromkeys(row + back[k]))
        if len(both) > 2 * count:
            extra = np.array(sorted(set(both) - set(row)))
            extra = extra[np.argsort(-(inner[extra] @ inner[k]), kind="stable")]
            both = row + _thin(inner, k, extra, 2 * count - len(row))
        out[k, :len(both)] = nodes[both]
    return out


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two, so that their largest component is between 0.5 and 1; angles stay."""
    _, power = np.frexp(np.abs(vectors).max(axis=1, keepdims=True, initial=0))
    return np.ldexp(vectors, -power)


def build(ids: np.ndarray, times: np.ndarray, original: np.ndarray, links: int = LINKS):
    """(ids, times, starts, vectors, levels, links) of one shard: node k has ids[starts[k]:starts[k + 1]], as many
    rows of each as `times` says; levels holds, per level from the base, the number of its nodes, then the
    nodes; links their rows."""
    order = np.argsort(ids, kind="stable")
    ids, times, original = ids[order], times[order], original[order]
    distinct, which = np.unique(original, axis=0, return_inverse=True)
    which = which.ravel()
    by_node = np.argsort(which, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(distinct)))])
    unit = scaled(distinct)
    unit = (unit / np.linalg.norm(unit, axis=1, keepdims=True)).astype(np.float32)
    rng = np.random.default_rng(len(distinct))
    height = np.floor(-np.log(1 - rng.random(len(distinct))) / np.log(links)).astype(int)
    levels, rows = [], []
    for level in range(height.max() + 1):
        nodes = np.flatnonzero(height >= level)
        levels += [len(nodes), *nodes.tolist()]
        rows.append(_level(unit, nodes, links).ravel())
    return ids[by_node], times[by_node], starts, distinct.ravel(), levels, np.concatenate(rows)


def written(folder: str, name: str, arrays, kinds) -> str:
    """A file of arrays: their lengths, then each one."""
    values = [np.asarray(a, kind) for a, kind in zip(arrays, kinds)]
    return write_file(folder, name, [struct.pack(f"<{len(values)}q", *map(len, values)), *(v.tobytes() for v in values)])


def loaded(file: str, kinds) -> list[np.ndarray]:
    with open_file(file) as stream:
        value = stream.read_buffer()
    sizes, at, out = struct.unpack_from(f"<{len(kinds)}q", value), 8 * len(kinds), []
    for size, kind in zip(sizes, map(np.dtype, kinds)):
        out.append(np.frombuffer(value, kind, size, at))
        at += size * kind.itemsize
    return out


class Graph:
    """A shard's index, ready for searches."""

    def __init__(self, dim, ids, times, starts, flat, levels, links):
        self.ids, self.times, self.starts, self.vectors = ids, times, starts, scaled(flat.reshape(-1, dim))
        self.norms = np.linalg.norm(self.vectors, axis=1)
        self.unit = (self.vectors / self.norms[:, None]).astype(np.float32)
        self.layers, at, row = [], 0, 0
        count = len(self.vectors)
        width = len(links) // max(1, sum(self._sizes(levels)))
        for size in self._sizes(levels):
            nodes = levels[at + 1:at + 1 + size]
            table = np.full((count, width), -1, np.int32)
            table[nodes] = links[row:row + size * width].reshape(size, width)
            self.layers.append((nodes, table))
            at, row = at + 1 + size, row + size * width

    @staticmethod
    def _sizes(levels) -> list[int]:
        sizes, at = [], 0
        while at < len(levels):
            sizes.append(int(levels[at]))
            at += 1 + sizes[-1]
        return sizes

    def nearest(self, queries: np.ndarray, breadth: int) -> np.ndarray:
        """Per query (unit rows) the nodes found on the base level, -1 where fewer."""
        entry = np.full((len(queries), 1), self.layers[-1][0][0], np.int64)
        for k in range(len(self.layers) - 1, -1, -1):
            entry = self._walk(queries, self.layers[k][1], entry, breadth if k == 0 else 4)
        return entry

    def _walk(self, queries, table, entry, breadth):
        count, lines = len(queries), np.arange(len(queries))[:, None]
        breadth = max(breadth, entry.shape[1])
        found = np.full((count, breadth), -1, np.int64)
        score = np.full((count, breadth), -np.inf, np.float32)
        found[:, :entry.shape[1]] = entry
        score[:, :entry.shape[1]] = np.where(
            entry >= 0, np.einsum("qkd,qd->qk", self.unit[entry], queries), -np.inf)
        seen = np.zeros((count, len(self.unit) + 1), bool)  # the last place stands for no node
        seen[:, -1] = True
        seen[lines, entry] = True
        done = found < 0
        while True:
            open_ = np.where(done, -np.inf, score)
            pick = np.argpartition(-open_, min(3, breadth - 1), axis=1)[:, :min(4, breadth)]
            some = np.take_along_axis(open_, pick, 1) > -np.inf
            live = np.flatnonzero(some.any(axis=1))
            if not len(live):
                return found
            pick, some = pick[live], some[live]
            part = done[live]
            part[np.arange(len(live))[:, None], pick] |= some
            done[live] = part
            nodes = np.where(some, found[live[:, None], pick], -1)
            near = np.where(nodes[..., None] >= 0, table[nodes], -1).reshape(len(live), -1)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[live[:, None], near]] = -1
            seen[live[:, None], near] = True
            value = np.einsum("qkd,qd->qk", self.unit[near], queries[live])
            value[near < 0] = -np.inf
            both = np.concatenate([score[live], value], axis=1)
            keep = np.argpartition(-both, breadth - 1, axis=1)[:, :breadth]
            names = np.concatenate([found[live], near.astype(np.int64)], axis=1)
            closed = np.concatenate([done[live], near < 0], axis=1)
            found[live], score[live] = np.take_along_axis(names, keep, 1), np.take_along_axis(both, keep, 1)
            done[live] = np.take_along_axis(closed, keep, 1)

    def search(self, query_ids, queries, k: int, breadth: int):
        """(query_id, vec_id, score): up to k rows a query, exact scores."""
        double = scaled(queries)
        norms = np.linalg.norm(double, axis=1)
        found = self.nearest((double / norms[:, None]).astype(np.float32), breadth)
        out = ([], [], [])
        for q, nodes in enumerate(found):
            nodes = nodes[nodes >= 0]
            values = self.vectors[nodes] @ double[q] / (self.norms[nodes] * norms[q])
            best = nodes[np.argsort(-values, kind="stable")]
            values = np.sort(values)[::-1]
            rows = self._rows(best, values, int(query_ids[q]), k)
            out[0].extend([int(query_ids[q])] * len(rows))
            out[1].extend(i for _, i in rows)
            out[2].extend(-v for v, _ in rows)
        return out

    def _rows(self, best, values, own: int, k: int) -> list[tuple[float, int]]:
        rows: list[tuple[float, int]] = []
        for n, v in zip(best.tolist(), values.tolist()):
            if len(rows) >= k and -v > rows[k - 1][0]:
                break
            span = slice(self.starts[n], self.starts[n + 1])
            other = np.flatnonzero(self.ids[span] != own)[:k]
            members = np.repeat(self.ids[span][other], np.minimum(self.times[span][other], k))[:k]
            rows = sorted(rows + [(-v, i) for i in members.tolist()])
        return rows[:k]


def index(rows: DataFrame, shard_rows: int = SHARD_ROWS, links: int = LINKS) -> DataFrame:
    """The index of (vec_id, v): a written table with one row per shard and the file of its arrays."""
    folder = new_folder(rows.sparkSession, "index")
    # equal rows are counted first, so neither a frequent id nor a frequent row fills a shard
    rows = materialise(rows.groupBy("vec_id", "v").agg(F.count("*").alias("times")), "vectors")
    shards = -(-rows.count() // shard_rows) or 1
    dealt = rows.select((F.size("v").cast("bigint") * shards + F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)))
                        .alias("shard"), "vec_id", "times", "v")

    def run(table: pa.Table) -> pa.Table:
        ids, times = (table.column(c).to_numpy() for c in ("vec_id", "times"))
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        arrays = build(ids, times, flat, links)
        return pa.table({
            "shard": table.column("shard")[:1], "dim": pa.array([flat.shape[1]], pa.int32()),
            "n_nodes": pa.array([len(arrays[2]) - 1], pa.int64()),
            "file": pa.array([written(folder, "graph", arrays, KINDS.values())])})
    return materialise(dealt.groupBy("shard").applyInArrow(run, INDEX), "graphs")


def questions(queries: DataFrame, block: int = BLOCK) -> DataFrame:
    """(dim, asked): queries (vec_id, v) in files of up to `block` ids and vectors of one length, equal ones once."""
    folder = new_folder(queries.sparkSession, "questions")

    def run(batches):
        for batch in batches:
            dims = np.diff(batch.column(1).offsets.to_numpy())
            for dim in sorted(set(dims.tolist())):
                rows = batch.filter(pa.array(dims == dim))
                for a in range(0, len(rows), block):
                    part = rows.slice(a, block)
                    file = written(folder, "block", (part.column(0).to_numpy(), part.column(1).flatten().to_numpy(
                        zero_copy_only=False)), (np.int64, np.float64))
                    yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([file])], ["dim", "asked"])
    return materialise(queries.select("vec_id", "v").dropDuplicates(["vec_id", "v"]).mapInArrow(run, "dim int, asked string"), "questions")


def search(built: DataFrame, queries: DataFrame, k: int = 5, breadth: int = BREADTH, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of queries (vec_id, v), which go in blocks to every shard."""
    def run(batches):
        held, graph = None, None
        for batch in batches:
            for dim, file, asked in zip(*(batch.column(c).to_pylist() for c in ("dim", "file", "asked"))):
                if held != file:
                    held, graph = file, Graph(dim, *loaded(file, KINDS.values()))
                ids, flat = loaded(asked, (np.int64, np.float64))
                found = graph.search(ids, flat.reshape(-1, dim), k, breadth)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())],
                    ["query_id", "vec_id", "score"])
    # a block asks every shard of its length; what moves are two names of files. Most vectors have one length, so
    # the blocks are salted and the short list of shards repeated per salt
    n = parts(queries)
    blocks = questions(queries, block).withColumn("_salt", F.pmod(F.xxhash64("asked"), F.lit(n)))
    shards = built.select("dim", "file", F.explode(F.expr(f"sequence(0L, {n - 1}L)")).alias("_salt"))
    pairs = blocks.join(shards, ["dim", "_salt"]).repartition(
        n, "file", F.pmod(F.xxhash64("asked"), F.lit(SPREAD))).sortWithinPartitions("file")
    best = pairs.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
