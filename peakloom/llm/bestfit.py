"""Best-fit packing by exact-complement hashing.

How documents share sequences depends on the lengths of their pieces alone, and of these there are no more
than a sequence has tokens. So the pieces are counted per length, the counts are packed, and the pieces are
then dealt to the slots of their length by rank.

A sequence begins with the longest piece left. Sums of one, two and three of the lengths left are hashed by
their value; if a combination fills the gap exactly and the counts allow it, it is taken, the one with the
longest piece first. Short pieces are worth most at the end, so a pair is taken only if the longest piece that
fits leaves a quarter of the gap open, three only if it leaves half. Else the longest piece that fits goes in
(best fit) and the smaller gap is tried again. A finished pattern is used as often as the counts allow. Each
pattern at least halves the count of one of its lengths, so there are at most `capacity` times log2(pieces)
patterns, whatever the number of documents.

Defined cases: a null text counts as the empty one and has the end id alone; only documents longer than a
sequence are cut, into whole sequences and the rest; null and repeated ids are kept row by row; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from peakloom.llm.common import running_total
from peakloom.llm.pieces import Store, distinct, lay_out, slices, texts_of
from peakloom.session import materialise

VOCABULARY = "word_bpe_49k.json"
CAPACITY, END = 2048, 0
#: The longest piece that fits must leave this much of the gap open before a pair, or three, may fill it.
PAIR_AT, TRIPLE_AT = 0.75, 0.5
#: Words a worker remembers at most, and bytes of text encoded at a time.
STORE, SLICE = 1_000_000, 4 << 20
#: Words encoded at a time.
JOINED = 4096
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


class Encoder:
    """Whole texts to ids: the tokenizer drops white space and no token spans it, so words are encoded on
    their own, and recurring ones once. New words go to the tokenizer joined by a special token, which parts
    them as white space does and can be found again; words beside one that holds its string go alone."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.mark, token = min(self.tokenizer.get_added_tokens_decoder().items())
        self.token = token.content
        self.store = Store(STORE)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, ids of each word)."""
        flat, length = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
        for k in range(0, len(words), JOINED):
            some = words[k:k + JOINED]
            if any(self.token in word for word in some):
                found = [self._ids(word) for word in some]
                flat += found
                length.append(np.fromiter(map(len, found), np.int64))
                continue
            ids = self._ids(self.token.join(some))
            marks = np.flatnonzero(ids == self.mark)
            flat.append(np.delete(ids, marks))
            length.append(np.diff(marks, prepend=-1, append=len(ids)) - 1)
        return np.concatenate(flat), np.concatenate(length)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, n + 1 offsets) of texts given as bytes and offsets."""
        visible = ~_BLANK[data]
        begins, ends = visible.copy(), visible.copy()
        begins[1:] &= ~visible[:-1]
        ends[:-1] &= ~visible[1:]
        edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
        begins[edges] = visible[edges]
        ends[edges - 1] = visible[edges - 1]
        starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        if not len(starts):
            return np.empty(0, "<u4"), np.zeros(len(offsets), np.int64)
        one, which, codes, checks = distinct(data, starts, stops)
        known, at = self.store.find(codes, checks)
        raw, new = data.tobytes(), np.flatnonzero(~known)
        words = [raw[a:b].decode() for a, b in zip(starts[one[new]].tolist(), stops[one[new]].tolist())]
        flat, length = self._words(words)
        first, lengths = np.empty(len(one), np.int64), np.empty(len(one), np.int64)
        first[known], lengths[known] = self.store.begin[at[known]], self.store.length[at[known]]
        first[new], lengths[new] = np.cumsum(length) - length + len(self.store.flat), length
        ids, places = lay_out(np.concatenate([self.store.flat, flat]), first, lengths, which)
        order = np.argsort(codes[new], kind="stable")
        moved, _ = lay_out(flat, np.cumsum(length) - length, length, order)
        self.store.add(codes[new][order], checks[new][order], moved, length[order])
        return ids, places[np.searchsorted(starts, offsets)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids): each document's ids with the end id, little-endian unsigned 32-bit,
    cut where it is longer than a sequence."""
    where, tail = path or public_tokenizers.path(VOCABULARY), np.array([end], "<u4").tobytes()

    def run(batches):
        own = encoder(where)
        for batch in batches:
            for k, n in slices(batch.column(1), SLICE):
                part = batch.slice(k, n)
                ids, places = own.encode(*texts_of(part.column(1)))
                sizes = np.diff(places) + 1
                count = -(-sizes // capacity)
                row = np.repeat(np.arange(n), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                length = np.minimum(sizes[row] - piece * capacity, capacity)
                raw = [ids[a:b].tobytes() + tail for a, b in zip(places[:-1].tolist(), places[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)),
                     pa.array(piece * capacity), pa.array(length),
                     pa.array([raw[r][4 * p * capacity:4 * (p + 1) * capacity]
                               for r, p in zip(row.tolist(), piece.tolist())], pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids"])
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids binary")


class Complements:
    """The lengths left with their counts, and how many sums of one, two and three of them reach each value."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.size = capacity
        here = (self.left > 0).astype(np.int64)
        self.pairs, self.triples = (np.zeros(capacity + 1, np.int64) for _ in range(2))
        self.singles = np.zeros(capacity + 1, np.int64)
        for length in np.flatnonzero(here).tolist():
            self._enter(length, 1)

    def _enter(self, length: int, sign: int) -> None:
        """A length comes (1) or goes (-1). The sums count ordered ways: those that hold this length once, twice
        and three times beside the other lengths come or go with it."""
        if sign < 0:
            self.singles[length] = 0
            self.pairs -= self._with(length)
        triples = np.zeros_like(self.triples)
        triples[length:] = 3 * self.pairs[:self.size + 1 - length]
        if 2 * length <= self.size:
            triples[2 * length:] += 3 * self.singles[:self.size + 1 - 2 * length]
        triples[3 * length:3 * length + 1] += 1
        self.triples += sign * triples
        if sign > 0:
            self.pairs += self._with(length)
            self.singles[length] = 1

    def _with(self, length: int) -> np.ndarray:
        """Ordered pairs of this length with the others and itself."""
        pairs = np.zeros_like(self.pairs)
        pairs[length:] = 2 * self.singles[:self.size + 1 - length]
        pairs[2 * length:2 * length + 1] += 1
        return pairs

    def take(self, pattern: Counter) -> int:
        """Uses a pattern as often as the counts allow; returns how often."""
        times = min(int(self.left[length]) // n for length, n in pattern.items())
        for length, n in pattern.items():
            self.left[length] -= times * n
            if not self.left[length]:
                self._enter(length, -1)
        return times

    def fill(self, gap: int, used: Counter) -> tuple[int, ...]:
        """One, two or three lengths that sum to the gap and are left besides those used; else the longest that
        fits; () if none does."""
        longest = self.longest(gap, used)
        if longest in (0, gap):
            return (longest,) if longest else ()
        if self.pairs[gap] and longest <= gap * PAIR_AT:
            for a in self._partners(gap, self.singles):
                if a >= gap - a and self._free(used, a, gap - a):
                    return a, gap - a
        if self.triples[gap] and longest <= gap * TRIPLE_AT:
            for a in self._partners(gap, self.pairs):
                if 3 * a < gap:
                    break
                for b in self._partners(gap - a, self.singles):
                    if a >= b >= gap - a - b and self._free(used, a, b, gap - a - b):
                        return a, b, gap - a - b
        return (longest,)

    def _partners(self, gap: int, reached: np.ndarray) -> list[int]:
        """The lengths left, longest first, whose difference to the gap is reached."""
        found = np.flatnonzero(self.singles[1:gap] & (reached[gap - 1:0:-1] > 0)) + 1
        return found[::-1].tolist()

    def _free(self, used: Counter, *lengths: int) -> bool:
        return all(self.left[a] >= used[a] + lengths.count(a) for a in lengths)

    def longest(self, gap: int, used: Counter) -> int:
        """The longest length up to the gap that is left besides those used, or 0."""
        for a in np.flatnonzero(self.left[:gap + 1])[::-1].tolist():
            if self.left[a] > used[a]:
                return a
        return 0


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Counter, int]]:
    """(pieces per length, sequences) until all counts are used."""
    left, out = Complements(counts, capacity), []
    while left.left.any():
        used, gap = Counter(), capacity
        while gap:
            found = left.fill(gap, used)
            if not found:
                break
            used.update(found)
            gap -= sum(found)
        out.append((used, left.take(used)))
    return out


def slots(plan: list[tuple[Counter, int]], capacity: int) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces per sequence, first offset), by length and rank."""
    rows, ranks, sequence = [], np.zeros(capacity + 1, np.int64), 0
    for used, times in plan:
        offset = 0
        for length, n in sorted(used.items(), reverse=True):
            rows.append((length, int(ranks[length]), sequence, n, offset))
            ranks[length] += n * times
            offset += n * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def deal(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`cut`, a written table with `length`, with `sequence_id` and `offset`. The plan is read by every task;
    its size follows from the capacity."""
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = slots(patterns(counts, capacity), capacity)
    before = np.zeros(capacity + 2, np.int64)
    for length, n in counts.items():
        before[length + 1] = n
    before = np.cumsum(before)
    firsts = before[table[:, 0]] + table[:, 1]

    def run(batches):
        for batch in batches:
            rank = batch.column("_rank").to_numpy() - 1
            length, _, sequence, n, offset = table[np.searchsorted(firsts, rank, "right") - 1].T
            at = rank - firsts[np.searchsorted(firsts, rank, "right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence + at // n), pa.array(offset + at % n * length)],
                [*batch.schema.names[:-1], "sequence_id", "offset"])
    ranked = running_total(cut.withColumn("_one", F.lit(1).cast("bigint")), ["length", "doc_id", "piece", "_row"],
                           "_one", "_rank").drop("_one")
    rest = [c for c in ranked.columns if c != "_rank"]
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.select(*rest, "_rank").mapInArrow(run, f"{kind}, sequence_id bigint, offset bigint")


def _written(docs: DataFrame, capacity: int, path: str | None) -> DataFrame:
    return materialise(pieces(docs, capacity, path).withColumns({
        "ids_crc32": F.crc32("ids"), "_row": F.monotonically_increasing_id()}), "pieces")


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    return deal(_written(docs, capacity, path).drop("ids"), capacity).drop("_row")


def sequences(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed sequences themselves; a group is one sequence, at most `capacity`
    tokens."""
    cut = _written(docs, capacity, path)
    placed = deal(cut.drop("ids"), capacity).select("_row", "sequence_id", "offset", "length")
    one = F.struct("offset", "ids")
    return placed.join(cut.select("_row", "ids"), "_row").groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.unhex(F.array_join(F.transform(F.sort_array(F.collect_list(one)), lambda x: F.hex(x["ids"])), "")).alias("ids"))
