"""Fill-in-the-middle documents, cut at ranks found in an indexable skip list.

The units of a text are its lines. Every link of a lane carries how many units and how many code points it
spans; an express lane joins the links between the nodes that reach it. Descending by accumulated units
arrives at a cut rank exactly, with its place in code points. Heights come from a hash of the node's number, so
reruns agree.

A document is cut at two ranks drawn from a hash of its id, and written plain, as prefix-suffix-middle or as
suffix-prefix-middle, marked by sentinels. `restore` rebuilds the text from output and form alone.

Defined cases: a null text counts as the empty one, which is plain with no units; a text that holds a sentinel
is plain; a null id is drawn as the word null; rows that share an id draw alike; an empty table gives an empty
result; other columns stay, those named like a result column are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakloom.llm.pieces import mix

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Percent of documents that are transformed, and of these in suffix-prefix-middle form.
RATE, SPM_RATE, SEED = 100, 50, "7"
OUT = {"n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(),
       "output": T.StringType()}


def line_widths(text: str) -> np.ndarray:
    """Code points of each line, its line feed included."""
    widths = np.fromiter(map(len, text.split("\n")), np.int64)
    widths[:-1] += 1
    return widths if widths[-1] else widths[:-1]


class SkipList:
    """Lanes from the bottom up: `units` and `chars` spanned by each link, and `ends`, the link of the lane
    below at which each link ends (None at the bottom). A node reaches the next lane in one of four cases."""

    def __init__(self, chars: np.ndarray):
        units, nodes = np.ones(len(chars), np.int64), np.arange(1, len(chars) + 1)
        self.lanes = [(units, chars, None)]
        draw = mix(nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        while len(nodes) > 4:
            reach = np.flatnonzero((draw & np.uint64(3)) == 0)
            if not len(reach):
                break
            first = np.concatenate([[0], reach[:-1] + 1])
            stop = int(reach[-1]) + 1
            units, chars = np.add.reduceat(units[:stop], first), np.add.reduceat(chars[:stop], first)
            nodes, draw = nodes[reach], draw[reach] >> np.uint64(2)
            self.lanes.append((units, chars, reach))

    def place(self, rank: int) -> int:
        """The code points before the unit of this rank."""
        link = seen = place = 0
        for units, chars, ends in reversed(self.lanes):
            while link < len(units) and seen + units[link] <= rank:
                seen += int(units[link])
                place += int(chars[link])
                link += 1
            if ends is not None:
                link = int(ends[link - 1]) + 1 if link else 0
        if seen != rank:
            raise IndexError(rank)
        return place


def divide(text: str, doc_id: int | None, rate: int, spm_rate: int, seed: str) -> tuple:
    """(units, form, code points of the prefix, of the middle, output) of one document."""
    widths = line_widths(text)
    n = len(widths)
    hexed = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    one, two, three, four = (int(hexed[k:k + 8], 16) for k in range(0, 32, 8))
    if not n or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or three % 100 >= rate:
        return n, PLAIN, None, None, text
    units = SkipList(widths)
    a, b = (units.place(rank) for rank in sorted((one % (n + 1), two % (n + 1))))
    head, middle, tail = text[:a], text[a:b], text[b:]
    if four % 100 < spm_rate:
        return n, SPM, a, b - a, f"{SUFFIX}{tail}{PREFIX}{head}{MIDDLE}{middle}"
    return n, PSM, a, b - a, f"{PREFIX}{head}{SUFFIX}{tail}{MIDDLE}{middle}"


def transform(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, seed: str = SEED) -> DataFrame:
    """All rows and columns of `docs` with n, form, prefix_chars, middle_chars and output."""
    rest = [c for c in docs.columns if c.lower() not in OUT]
    names = [f"_c{k}" for k in range(len(rest))]
    rows = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(rest, names)],
                       F.col("doc_id").cast("bigint").alias("_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    kind = T.StructType([*rows.schema.fields[:-2], *[T.StructField(c, t) for c, t in OUT.items()]])
    arrow = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    named = [*names, *OUT]

    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.slice(start, 512)
                found = [divide(text, doc_id, rate, spm_rate, seed) for doc_id, text in
                         zip(part.column("_id").to_pylist(), part.column("_text").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-2], *[pa.array(values, t) for values, t in zip(zip(*found), arrow)]], named)
    return rows.mapInArrow(run, kind).select(*[F.col(a).alias(c) for c, a in zip(rest, names)], *OUT)


def restore(rows: DataFrame, out: str = "restored") -> DataFrame:
    """Adds the exact text, from `output` and `form`. A sentinel cannot arise where two parts meet, as it
    begins with its only opening bracket, so the first of each kind is the mark."""
    def at(mark):
        return F.instr("output", mark)

    def between(first, last=None):
        begin = at(first) + len(first)
        return F.substring(F.col("output"), begin, at(last) - begin if last else F.length("output"))
    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE), between(SUFFIX, PREFIX))
    return rows.withColumn(out, F.when(F.col("form") == PSM, psm).when(F.col("form") == SPM, spm)
                           .otherwise(F.col("output")))
