"""Token ids in seekable binary files: independent Zstandard frames with a trailing seek table.

File format, little-endian:
* data frames, each a Zstandard frame of whole documents' ids as unsigned 32-bit integers;
* a skippable frame (magic 0x184D2A50) with the document table, itself a Zstandard frame of `_DOC` rows:
  doc_id, whether it is given, first id within the file, number of ids;
* a skippable frame (magic 0x184D2A5E) in the public seekable format: per data frame its compressed size, its
  plain size and a checksum (low 32 bits of the XXH64 of the plain bytes), then the number of frames, a
  descriptor (128: with checksums) and the magic number 0x8F92EAB1.

A reader fetches the tables from the end of the file and decompresses only the frames it needs.

Documents are range-sorted by doc_id; each task writes files of its own under fresh names and reports them, so
a lost task leaves nothing that counts. File order and the running total of ids give every document its place.

Defined cases: a null text is encoded as the empty one and has only the end id; rows without doc_id come
first; rows that share a doc_id follow one another, ordered by their text; an empty table writes no file.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from peakloom.llm.common import new_folder, open_file, parts, write_file
from peakloom.llm.pieces import Store, distinct, lay_out, slices, texts_of
from peakloom.session import materialise

VOCABULARY = "byte_bpe_50k.json"
END = 0
#: Plain bytes of a frame at least; a document is never split.
FRAME = 1 << 18
#: Pieces a worker remembers at most.
STORE = 1_000_000
#: Bytes of text encoded at a time.
SLICE = 4 << 20
_DOC = np.dtype([("doc_id", "<i8"), ("given", "<i8"), ("start", "<i8"), ("count", "<i8")])
_SEEK = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])
_TABLE, _END, _MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
#: White space other than the space itself and the line feed, in ASCII.
_ODD = np.zeros(256, bool)
_ODD[[9, 11, 12, 13, 28, 29, 30, 31]] = True
_LETTER, _STOP = np.zeros((2, 256), bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP[list(b".,;:!?")] = True


def _odd_space(data: np.ndarray) -> np.ndarray:
    """Places of white space other than space and line feed, in UTF-8."""
    found = [np.flatnonzero(_ODD[data])]
    lead = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    if len(lead):
        padded = np.concatenate([data, np.zeros(2, np.uint8)])
        a, b, c = padded[lead], padded[lead + 1], padded[lead + 2]
        hit = ((a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80)
               | (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
               | (a == 0xE2) & (b == 0x81) & (c == 0x9F) | (a == 0xE3) & (b == 0x80) & (c == 0x80))
        found.append(lead[hit])
    return np.concatenate(found)


class Encoder:
    """Whole texts to ids. A space or line feed between two visible characters begins a piece of the
    tokenizer, so does a stop after a letter: the text may be cut there and recurring pieces are encoded once,
    in a batch and, as long as the store holds them, after it. Texts with other white space stay whole. Many pieces go to the tokenizer as lines of one text: a line feed is a piece too."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.feed, = self._ids("\n")
        self.store = Store(STORE)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _lines(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, ids of each) of pieces without line feeds."""
        ids = self._ids(b"\n".join(words).decode())
        feeds = np.flatnonzero(ids == self.feed)
        ends = np.append(feeds, len(ids))
        return np.delete(ids, feeds), np.diff(ends, prepend=-1) - 1

    def _pieces(self, words: list[bytes], alone: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """The same of any pieces; those with inner white space or line feeds go alone."""
        found, line = [], []
        for word, apart in zip(words, alone):
            if apart or len(line) == 4096:
                found += [self._lines(line)] if line else []
                line = []
            if apart:
                ids = self._ids(word.decode())
                found.append((ids, np.array([len(ids)])))
            else:
                line.append(word)
        found += [self._lines(line)] if line else []
        if not found:
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])

    @staticmethod
    def cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pieces begin, in ascending order, the begin of every non-empty text among them; and whether
        each is to be encoded alone."""
        space, feed = data == 32, data == 10
        blank = space | feed
        near = np.append(blank[:-1] & blank[1:], False)
        last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        odd = np.concatenate([np.flatnonzero(near), last[blank[last]], _odd_space(data)])
        whole = np.zeros(len(offsets), bool)
        whole[np.searchsorted(offsets, odd, "right") - 1] = True
        cut = blank.copy()
        cut[1:] |= feed[:-1] | _LETTER[data[:-1]] & _STOP[data[1:]]
        for k in np.flatnonzero(whole).tolist():
            cut[offsets[k]:offsets[k + 1]] = False
        cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        starts = np.flatnonzero(cut)
        return starts, whole[np.searchsorted(offsets, starts, "right") - 1] | (data[starts] == 10)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, n + 1 offsets) of texts given as bytes and offsets."""
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts, alone = self.cuts(data, offsets)
        ends = np.append(starts[1:], len(data))
        one, which, codes, checks = distinct(data, starts, ends)
        known, at = self.store.find(codes, checks)
        raw, new = data.tobytes(), np.flatnonzero(~known)
        flat, length = self._pieces([raw[a:b] for a, b in zip(starts[one[new]].tolist(), ends[one[new]].tolist())],
                                    alone[one[new]].tolist())
        begins, lengths = np.empty(len(one), np.int64), np.empty(len(one), np.int64)
        begins[known], lengths[known] = self.store.begin[at[known]], self.store.length[at[known]]
        begins[new], lengths[new] = np.cumsum(length) - length + len(self.store.flat), length
        ids, places = lay_out(np.concatenate([self.store.flat, flat]), begins, lengths, which)
        order = np.argsort(codes[new], kind="stable")
        moved, _ = lay_out(flat, np.cumsum(length) - length, length, order)
        self.store.add(codes[new][order], checks[new][order], moved, length[order])
        return ids, places[np.searchsorted(starts, offsets)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


def file_chunks(documents, frame: int = FRAME):
    """The file's bytes, chunk by chunk, from (doc_id or None, id bytes)."""
    packer = zstandard.ZstdCompressor(level=3, write_checksum=True)
    seek, table, held, size, start = [], [], [], 0, 0

    def flush():
        plain = b"".join(held)
        packed = packer.compress(plain)
        seek.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        return packed
    for doc_id, ids in documents:
        table.append((doc_id or 0, doc_id is not None, start, len(ids) // 4))
        start += len(ids) // 4
        held.append(ids)
        size += len(ids)
        if size >= frame:
            yield flush()
            held, size = [], 0
    if size:
        yield flush()
    yield _skippable(_TABLE, packer.compress(np.array(table, _DOC).tobytes()))
    yield _skippable(_END, np.array(seek, _SEEK).tobytes() + struct.pack("<IBI", len(seek), 128, _MAGIC))


class Reader:
    """Random access to one file; `frames_read` counts the frames it had to decompress."""

    def __init__(self, uri: str):
        self.file, self.frames_read = open_file(uri), 0
        size = self.file.size()
        frames, descriptor, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != _MAGIC or descriptor != 128:
            raise ValueError(f"{uri} has no seek table")
        self.seek = np.frombuffer(self._at(size - 9 - 12 * frames, 12 * frames), _SEEK)
        self.packed = np.concatenate([[0], np.cumsum(self.seek["packed"], dtype=np.int64)])
        self.plain = np.concatenate([[0], np.cumsum(self.seek["plain"], dtype=np.int64)])
        magic, length = struct.unpack("<II", self._at(int(self.packed[-1]), 8))
        if magic != _TABLE:
            raise ValueError(f"{uri} has no document table")
        body = zstandard.ZstdDecompressor().decompressobj().decompress(self._at(int(self.packed[-1]) + 8, length))
        self.documents = np.frombuffer(body, _DOC)
        self._held: tuple[int, bytes] = (-1, b"")

    def _at(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def _frame(self, k: int) -> bytes:
        if self._held[0] != k:
            packed = self._at(int(self.packed[k]), int(self.seek["packed"][k]))
            plain = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(self.seek["plain"][k]))
            if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.seek["check"][k]:
                raise ValueError("frame does not match its checksum")
            self.frames_read += 1
            self._held = (k, plain)
        return self._held[1]

    def ids(self, row: int) -> np.ndarray:
        """Ids of the document in one row of the document table."""
        start, count = 4 * int(self.documents["start"][row]), 4 * int(self.documents["count"][row])
        if not count:
            return np.empty(0, np.uint32)
        k = int(np.searchsorted(self.plain, start, "right")) - 1
        a = start - int(self.plain[k])
        return np.frombuffer(self._frame(k)[a:a + count], "<u4")


def write_tokens(docs: DataFrame, folder: str | None = None, path: str | None = None, frame: int = FRAME,
                 end: int = END) -> DataFrame:
    """Writes the files and returns their list, itself a written table: (part, file, n_docs, n_ids); `part`
    numbers the files in ascending doc_id order."""
    where, target = path or public_tokenizers.path(VOCABULARY), folder or new_folder(docs.sparkSession, "tokens")
    tail = struct.pack("<I", end)

    def run(batches):
        own = encoder(where)
        count = {"docs": 0, "ids": 0, "part": 0}

        def documents():
            for batch in batches:
                count["part"] = batch.column("_part")[0].as_py() if len(batch) else 0
                for k, n in slices(batch.column("_text"), SLICE):
                    part = batch.slice(k, n)
                    ids, ends = own.encode(*texts_of(part.column("_text")))
                    for doc_id, a, b in zip(part.column("_id").to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                        count["docs"] += 1
                        count["ids"] += b - a + 1
                        yield doc_id, ids[a:b].tobytes() + tail
        rows = documents()
        head = next(rows, None)
        if head is None:
            return

        def again():
            yield head
            yield from rows
        file = write_file(target, "tokens", file_chunks(again(), frame))
        yield pa.RecordBatch.from_arrays(
            [pa.array([count["part"]], pa.int64()), pa.array([file]), pa.array([count["docs"]], pa.int64()),
             pa.array([count["ids"]], pa.int64())], ["part", "file", "n_docs", "n_ids"])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    # a frequent id, null above all, is cut into several files by the hash of its texts
    order = ["_id", F.xxhash64("_text"), "_text"]
    ranged = rows.repartitionByRange(parts(docs), *order[:2]).sortWithinPartitions(*order).withColumn(
        "_part", F.spark_partition_id().cast("bigint"))
    return materialise(ranged.mapInArrow(run, "part bigint, file string, n_docs bigint, n_ids bigint"), "manifest")


def read_tokens(manifest: DataFrame, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, ids as bytes) from the files; with `doc_ids` only these, and only their frames."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))
    wanted = None if doc_ids is None else np.array(sorted(doc_ids), np.int64)

    def run(batches):
        for batch in batches:
            for file, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = Reader(file)
                table = reader.documents
                rows = np.arange(len(table)) if wanted is None else np.flatnonzero(
                    np.isin(table["doc_id"], wanted) & (table["given"] == 1))
                for k in range(0, len(rows), 512):
                    some = rows[k:k + 512]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(table["doc_id"][some], mask=table["given"][some] == 0),
                         pa.array(table["start"][some] + before),
                         pa.array([reader.ids(int(r)).tobytes() for r in some], pa.binary())],
                        ["doc_id", "start", "ids"])
    return placed.repartition(parts(manifest), "file").mapInArrow(run, "doc_id bigint, start bigint, ids binary")


def digests(docs: DataFrame) -> DataFrame:
    """Writes all documents, reads the files back: (doc_id, start, n_tokens, ids_crc32)."""
    back = read_tokens(write_tokens(docs))
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))
