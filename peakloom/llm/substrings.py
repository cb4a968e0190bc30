"""Suffix-array deduplication of substrings of at least 50 bytes across documents.

A byte is removed if a 50-byte string over it also starts in a document with a smaller doc_id.

1. Every 50-byte window is given the smallest hash of the 16-byte strings in it (its anchor). Equal windows
   have equal anchors, and neighbouring windows mostly share one. Each block sends its anchors, once each,
   and learns which of them another document has too.
2. For each such anchor the block sends the passage its windows span, equal passages once with the smallest
   doc_id. Where the passages of an anchor meet, a Burrows-Wheeler transform of them is expanded to 50 bytes
   (see `bwt`), which gives every window the smallest doc_id that holds it.
3. The windows' smallest doc_ids return to the block, which marks and counts the bytes.

A passage in very many documents is sent once per block, not once per document.

Defined cases: a null text is empty; rows without doc_id come after all others and never take bytes from
each other; rows that share a doc_id do not either; texts shorter than 50 bytes stay whole; an empty table
gives an empty result. Removing bytes may cut characters in half: `strip` drops such halves from its texts,
the counts and digests are those of the bytes.
"""

from __future__ import annotations

import hashlib
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from peakloom.llm import blocks as bl
from peakloom.llm.bwt import smallest_owner
from peakloom.llm.common import masked, parts
from peakloom.session import materialise

LENGTH = 50
GRAM = 16
#: Bytes of passages that one transform holds at a time, unless one anchor alone has more.
BATCH = 1 << 17

_RUN = np.dtype([("entry", "<u4"), ("start", "<u4"), ("end", "<u4"), ("doc", "<i8")])


def _smallest(octets: np.ndarray) -> np.ndarray:
    """Anchor of every window, from the 8-byte numbers that begin at each place of the text."""
    codes = octets[:-8] * np.uint64(0x9E3779B97F4A7C15)
    codes += octets[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
    codes ^= codes >> np.uint64(32)
    codes *= np.uint64(0xD6E8FEB86659FD93)
    codes ^= codes >> np.uint64(29)
    codes >>= np.uint64(16)
    width, done, low = LENGTH - GRAM + 1, 1, codes
    while done < width:
        step = min(done, width - done)
        low = np.minimum(low[:-step], low[step:])
        done += step
    return low


def _anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: (first window, end of windows, 48-bit anchor)."""
    n = len(data) - LENGTH + 1
    if n < 1:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),)
    octets = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), 0, (1,))
    low, chunk = np.empty(n, np.uint64), 1 << 14  # small arrays stay in the processor's cache
    for k in range(0, n, chunk):
        low[k:k + chunk] = _smallest(octets[k:k + chunk + LENGTH - 8])
    valid = np.zeros(n + 1, bool)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= LENGTH:
            valid[a:b - LENGTH + 1] = True
    change = np.ones(n + 1, bool)
    np.not_equal(low[1:], low[:-1], out=change[1:-1])
    begin = change[:-1] & valid[:-1]
    begin[1:] |= valid[1:-1] & ~valid[:-2]
    stop = change[1:] & valid[:-1]
    stop |= valid[:-1] & ~valid[1:]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(stop) + 1, low[starts]


def _send_anchors(packed: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for block, rows in zip(batch.column(0), batch.column(1)):
                _, ids, data, offsets = bl.unpack(rows)
                starts, _, codes = _anchors(data, offsets)
                if not len(codes):
                    continue
                doc = np.searchsorted(offsets, starts, "right") - 1
                order = np.argsort(codes, kind="stable")
                ordered, doc = codes[order], doc[order]
                first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
                several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
                yield bl.scatter(block.as_py(), ordered[first], several, buckets)
    return packed.mapInArrow(run, bl.SCATTERED)


def _passages(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, answers, buckets: int):
    """The block's distinct passages (anchor, bytes), and where they occur: (passage, place, doc_id)."""
    starts, ends, codes = _anchors(data, offsets)
    hit = np.isin(codes, bl.shared_of(np.unique(codes), answers, buckets))
    starts, ends, codes = starts[hit], ends[hit], codes[hit]
    doc = ids[np.searchsorted(offsets, starts, "right") - 1] if len(starts) else np.empty(0, np.int64)
    raw, found, which = data.tobytes(), {}, np.empty(len(starts), np.int64)
    for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        which[k] = found.setdefault(raw[a:b + LENGTH - 1], len(found))
    anchor = np.zeros(len(found), np.uint64)
    anchor[which] = codes
    return list(found), anchor, which, starts, doc


def _send_passages(asked: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for block, rows, codes in zip(*(batch.column(c) for c in ("block", "rows", "codes"))):
                _, ids, data, offsets = bl.unpack(rows)
                texts, anchor, which, _, doc = _passages(ids, data, offsets, codes.values, buckets)
                if not texts:
                    continue
                least, most = np.full(len(texts), bl.NO_ID), np.full(len(texts), -bl.NO_ID - 1)
                np.minimum.at(least, which, doc)
                np.maximum.at(most, which, doc)
                place = (anchor % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(place, kind="stable")
                cuts = np.searchsorted(place[order], np.arange(buckets + 1))
                some = np.flatnonzero(np.diff(cuts))
                groups = [order[cuts[k]:cuts[k + 1]] for k in some]
                column = lambda values: pa.array([values[g].tobytes() for g in groups], pa.binary())
                sizes = np.fromiter(map(len, texts), np.int64, len(texts))
                packer = zstandard.ZstdCompressor(level=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), pa.array(np.full(len(some), block.as_py(), np.int64)),
                     column(np.arange(len(texts), dtype=np.uint32)), column(anchor), column(least), column(most),
                     column(sizes), pa.array([packer.compress(b"".join(texts[i] for i in g)) for g in groups],
                                            pa.binary())],
                    ["bucket", "block", "entry", "anchor", "least", "most", "size", "bytes"])
    return asked.mapInArrow(
        run, "bucket bigint, block bigint, entry binary, anchor binary, least binary, most binary, size binary, "
             "bytes binary")


def _runs(values: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of equal values within each text: (text, start, end, value, first run of each text)."""
    change = np.zeros(len(values), bool)
    change[begins[:-1]] = True
    change[1:] |= values[1:] != values[:-1]
    at = np.flatnonzero(change)
    text = np.searchsorted(begins, at, "right") - 1
    end = np.append(at[1:], len(values))
    first = np.searchsorted(text, np.arange(len(begins)))
    return text, at - begins[text], end - begins[text], values[at], first


def _meeting(order: np.ndarray, anchor: np.ndarray, size: np.ndarray, texts):
    """Passages in the order of their anchors, some whole anchors at a time: (their places, the distinct one each is,
    the distinct ones). Only these are ever held as texts of their own."""
    lengths = np.cumsum(size[order] + 1)
    # cut between anchors, so equal windows stay together
    ends = np.flatnonzero(np.append(anchor[order[1:]] != anchor[order[:-1]], True)) + 1
    a = 0
    while a < len(order):
        found: dict[bytes, int] = {}
        which, total, b = [], 0, a
        while b < len(order) and total < BATCH:
            reach = np.searchsorted(lengths, (lengths[b - 1] if b else 0) + max(BATCH - total, BATCH >> 3), "right")
            c = int(ends[min(np.searchsorted(ends, max(int(reach), b + 1)), len(ends) - 1)])
            known = len(found)
            which += [found.setdefault(x, len(found)) for x in texts(order[b:c])]
            total += sum(len(x) + 1 for x in islice(found, known, None))
            b = c
        yield order[a:b], np.array(which), list(found)
        a = b


def _owners(sent: DataFrame) -> DataFrame:
    """Answers per block: runs of windows of a passage with the smallest doc_id that holds them."""
    def run(batches):
        blocks, raw, parts_ = [], [], []
        for batch in batches:
            for row in zip(*(batch.column(k) for k in range(1, 8))):
                parts_.append([np.frombuffer(x.as_buffer(), kind).copy() for x, kind in
                               zip(row[1:6], (np.uint32, np.uint64, np.int64, np.int64, np.int64))])
                blocks.append(row[0].as_py())
                raw.append(zstandard.decompress(row[6].as_py()))
            del batch, row
        if not blocks:
            return
        sizes = [len(x[0]) for x in parts_]
        ends = np.concatenate([np.cumsum(x[4]) for x in parts_])
        entry, anchor, least, most, size = (np.concatenate(x) for x in zip(*parts_))
        del parts_
        block_of = np.repeat(np.arange(len(blocks), dtype=np.int32), sizes)

        def texts(some: np.ndarray) -> list[bytes]:
            places = zip(block_of[some].tolist(), (ends[some] - size[some]).tolist(), ends[some].tolist())
            return [raw[block][a:b] for block, a, b in places]

        kept = []
        for group, which, distinct in _meeting(np.argsort(anchor, kind="stable"), anchor, size, texts):
            owner = np.full(len(distinct), bl.NO_ID)
            np.minimum.at(owner, which, least[group])
            values, begins = smallest_owner(distinct, owner, LENGTH)
            _, start, end, value, first = _runs(values, begins)
            # back to every passage of every block; a run helps if some document there comes later
            times = np.diff(first)[which]
            rep = np.repeat(np.arange(len(which)), times)
            run_ = np.arange(len(rep)) - np.repeat(np.cumsum(times) - times, times) + first[:-1][which][rep]
            useful = value[run_] < most[group][rep]
            rep, run_ = group[rep[useful]], run_[useful]
            out = np.empty(len(rep), _RUN)
            out["entry"], out["start"], out["end"], out["doc"] = entry[rep], start[run_], end[run_], value[run_]
            kept.append((block_of[rep], out))
        block_of, out = (np.concatenate(x) for x in zip(*kept))
        del kept, raw
        order = np.lexsort((out["start"], out["entry"], block_of))  # in order they take less room
        cuts = np.searchsorted(block_of[order], np.arange(len(blocks) + 1))
        for k in np.flatnonzero(np.diff(cuts)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([blocks[k]]), pa.array([out[order[cuts[k]:cuts[k + 1]]].tobytes()], pa.binary())],
                ["block", "runs"])
    return sent.repartition(parts(sent), "bucket").mapInArrow(run, "block bigint, runs binary")


def _removed(ids, data, offsets, codes, runs, buckets: int) -> np.ndarray:
    """The block's bytes to remove."""
    edge = np.zeros(len(data) + 1, np.int32)
    if codes is not None and runs is not None:
        run = np.concatenate([np.frombuffer(x.as_buffer(), _RUN) for x in runs])
        _, _, which, place, doc = _passages(ids, data, offsets, codes, buckets)
        order = np.argsort(which, kind="stable")
        ordered = which[order]
        first, last = np.searchsorted(ordered, run["entry"], "left"), np.searchsorted(ordered, run["entry"], "right")
        times = last - first
        k = np.repeat(np.arange(len(run)), times)
        at = order[np.arange(len(k)) - np.repeat(np.cumsum(times) - times, times) + first[k]]
        later = doc[at] > run["doc"][k]
        k, at = k[later], at[later]
        np.add.at(edge, place[at] + run["start"][k], 1)
        np.add.at(edge, place[at] + run["end"][k] + LENGTH - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def deduplicate(docs: DataFrame, texts: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with `texts` instead the columns of `docs`
    with what remains of each text."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    packed = bl.pack(docs if texts else docs.select("doc_id", "text"))
    buckets = parts(docs)
    codes = materialise(bl.gather(bl.shared_codes(_send_anchors(packed, buckets)), "codes"), "codes")
    runs = materialise(bl.gather(_owners(_send_passages(packed.join(codes, "block"), buckets)), "runs"), "runs")
    fields = [StructField("doc_id", LongType())]
    if texts:
        fields += [StructField("text", StringType()), *(docs.schema[c] for c in rest)]
    else:
        fields += [StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
        fields += [StructField("kept_sha256", StringType())]
    names = [f.name for f in fields]

    def run(batches):
        for batch in batches:
            for rows, code, found in zip(*(batch.column(c) for c in ("rows", "codes", "runs"))):
                table, ids, data, offsets = bl.unpack(rows)
                gone = _removed(ids, data, offsets, code.values, found.values, buckets)
                edge = gone & ~np.concatenate([[False], gone[:-1]])
                starts = offsets[:-1][offsets[:-1] < offsets[1:]]
                edge[starts] = gone[starts]
                removed = np.concatenate([[0], np.cumsum(gone)])
                spans = np.concatenate([[0], np.cumsum(edge)])
                kept = [data[a:b][~gone[a:b]].tobytes() if removed[b] > removed[a] else data[a:b].tobytes()
                        for a, b in zip(offsets[:-1], offsets[1:])]
                columns = [pa.array(ids, mask=ids == bl.NO_ID)]
                if texts:
                    columns += [pa.array([x.decode("utf-8", "ignore") for x in kept]), *table.columns[2:]]
                else:
                    columns += [pa.array(np.diff(x)) for x in (offsets, removed[offsets], spans[offsets])]
                    columns += [pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)
    whole = packed.join(codes, "block", "left").join(runs, "block", "left").select("rows", "codes", "runs")
    return whole.mapInArrow(run, StructType(fields))


def strip(docs: DataFrame) -> DataFrame:
    """The columns of `docs`, their texts without the removed bytes and without characters cut in half."""
    aside, back = masked(docs, "doc_id", "text")
    return back(deduplicate(aside, texts=True))
