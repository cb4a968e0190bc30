"""Blocks of documents: about `size` bytes of text with all columns, as one compressed Arrow value per row.

Operators that compare passages number the places of a block, send only short codes through the shuffle and
get short answers back by block, so texts are moved in compressed form and rarely.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakloom.llm.common import parts
from peakloom.session import materialise

SIZE = 2 << 20
NO_ID = (1 << 63) - 1


def pack(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(block, rows): rows hold `_id` (a null doc_id becomes the largest number), `_text` (null: empty) and
    the other columns by position, `c0`, `c1` and so on."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]

    def run(batches):
        held, total = [], 0
        for batch in batches:
            sizes = np.diff(np.frombuffer(batch.column(1).buffers()[1], np.int32,
                                          len(batch) + 1, batch.column(1).offset * 4)) if len(batch) else []
            start = 0
            for k, n in enumerate(sizes):
                total += int(n) + 1
                if total >= size:
                    held.append(batch.slice(start, k + 1 - start))
                    yield _block(held)
                    held, total, start = [], 0, k + 1
            if start < len(batch):
                held.append(batch.slice(start))
        if held:
            yield _block(held)
    chosen = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("_id"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"),
                         *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(rest)])
    return materialise(chosen.mapInArrow(run, "block bigint, rows binary"), "blocks")


def _block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(rows)
    name = uuid.uuid4().int & NO_ID
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                      ["block", "rows"])


def unpack(rows: pa.Scalar) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]:
    """(all columns, ids, text bytes one after another, n + 1 offsets)."""
    batch = pa.ipc.open_stream(rows.as_buffer()).read_all().combine_chunks().to_batches()[0]
    text = batch.column(1)
    offsets = np.frombuffer(text.buffers()[1], np.int32)[:len(batch) + 1].astype(np.int64)
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return batch, batch.column(0).to_numpy(), data, offsets - offsets[0]


def scatter(block: int, codes: np.ndarray, flags: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row per bucket of 48-bit codes: six bytes a code, and its flag as a bit."""
    place = (codes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    cuts = np.searchsorted(place[order], np.arange(buckets + 1))
    codes, flags = codes[order], flags[order]
    short = np.ascontiguousarray(codes.view(np.uint8).reshape(-1, 8)[:, :6])
    some = np.flatnonzero(np.diff(cuts))
    return pa.RecordBatch.from_arrays(
        [pa.array(some), pa.array(np.full(len(some), block, np.int64)),
         pa.array([short[cuts[k]:cuts[k + 1]].tobytes() for k in some], pa.binary()),
         pa.array([np.packbits(flags[cuts[k]:cuts[k + 1]]).tobytes() for k in some], pa.binary())],
        ["bucket", "block", "codes", "flags"])


SCATTERED = "bucket bigint, block bigint, codes binary, flags binary"


def shared_codes(scattered: DataFrame) -> DataFrame:
    """(block, codes): per bucket of a block, its number and a bit per code sent: whether another block has
    the code too, or the block flagged it itself. `shared_of` turns the bits back into codes.

    A block sends a code once, so a very frequent code costs one entry per block that has it.
    """
    def run(batches):
        blocks, buckets, codes, flags = [], [], [], []
        for batch in batches:
            for bucket, block, code, flag in zip(*(batch.column(k) for k in range(4))):
                short = np.frombuffer(code.as_buffer(), np.uint8).reshape(-1, 6)
                wide = np.zeros((len(short), 8), np.uint8)
                wide[:, :6] = short
                blocks.append(block.as_py())
                buckets.append(bucket.as_py())
                codes.append(wide.view(np.uint64).ravel())
                flags.append(np.unpackbits(np.frombuffer(flag.as_buffer(), np.uint8), count=len(short)).astype(bool))
        if not blocks:
            return
        code = np.concatenate(codes)
        order = np.argsort(code)
        ordered = code[order]
        first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        several = np.diff(np.append(np.flatnonzero(first), len(ordered))) > 1
        hit = np.empty(len(code), bool)
        hit[order] = several[np.cumsum(first) - 1]
        hit |= np.concatenate(flags)
        cuts = np.cumsum([0, *map(len, codes)])
        for k, block in enumerate(blocks):
            bits = hit[cuts[k]:cuts[k + 1]]
            if bits.any():
                value = struct.pack("<I", buckets[k]) + np.packbits(bits).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([value], pa.binary())],
                                                 ["block", "codes"])
    n = parts(scattered)
    return scattered.repartition(n, "bucket").mapInArrow(run, "block bigint, codes binary")


def shared_of(distinct: np.ndarray, answers, buckets: int) -> np.ndarray:
    """Those of a block's sorted distinct codes that the answers mark."""
    place = (distinct % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    cuts = np.searchsorted(place[order], np.arange(buckets + 1))
    hit = np.zeros(len(distinct), bool)
    for answer in answers:
        value = answer.as_buffer().to_pybytes()
        a, b = cuts[k := struct.unpack_from("<I", value)[0]], cuts[k + 1]
        hit[a:b] = np.unpackbits(np.frombuffer(value, np.uint8, offset=4), count=b - a)
    return np.sort(distinct[order[hit]])


def gather(answers: DataFrame, value: str) -> DataFrame:
    """One row per block with the list of its answers, bounded by the block's own size."""
    return answers.groupBy("block").agg(F.collect_list(value).alias(value))
