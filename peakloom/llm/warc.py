"""Legacy web archives (ARC, versions 1 and 2) and their conversion to WARC.

The converter reads the version line of an archive, then each record's header line with that version's fields
and exactly the declared length, and synthesises what WARC asks for: a record id derived from the record, the
date, the type, the block and payload digests. A record whose payload of at least `min_bytes` was already
captured becomes a revisit of the record with the smallest page id.

Tasks write whole files under fresh names in the shared folder and report them; only reported files count.
Archives are gzip members, one a record. Payloads are never shuffled: the list of revisits goes to each file.

Defined cases: a null html is an empty payload; a null url is written as `about:blank`; white space in a url
is percent-encoded; rows without page_id have none in the archive either, and come after all others when a
response is chosen; rows that share id and payload keep one response, the first in the archives; an empty
table writes no file; other columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakloom.llm.common import new_folder, open_file, parts, write_file
from peakloom.session import materialise

#: The fields of a record's header line by archive version, as the format defines them.
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"],
}
MIN_BYTES = 100
PAGE = "X-Page-Id"
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Plain:
    """Bytes of a file of gzip members, one after another."""

    def __init__(self, uri: str):
        self.file, self.held, self.inner = open_file(uri), b"", zlib.decompressobj(31)

    def _more(self) -> bool:
        data = self.inner.unused_data if self.inner.eof else b""
        if self.inner.eof:
            self.inner = zlib.decompressobj(31)
        data = data or self.file.read(1 << 18)
        self.held += self.inner.decompress(data)
        return bool(data)

    def line(self) -> bytes | None:
        """The next line without its end, None at the end of the file."""
        while (at := self.held.find(b"\n")) < 0:
            if not self._more():
                line, self.held = self.held, b""
                return line or None
        line, self.held = self.held[:at], self.held[at + 1:]
        return line.rstrip(b"\r")

    def take(self, size: int) -> bytes:
        parts_, have = [self.held], len(self.held)
        while have < size:
            self.held = b""
            if not self._more():
                raise ValueError("archive ends within a record")
            parts_.append(self.held)
            have += len(self.held)
        whole = b"".join(parts_)
        self.held = whole[size:]
        return whole[:size]


# --- ARC ---------------------------------------------------------------------------------------------

def arc_chunks(pages, version: int, name: str, date: str) -> Iterator[bytes]:
    """An archive of (page_id, url, html bytes), one gzip member a record."""
    fields = " ".join(FIELDS[version])
    head = f"{version} 0 peakloom\n{fields}\n\n".encode()
    filler = {"Result-code": "200", "Checksum": "-", "Location": "-", "Offset": "0", "Filename": name}

    def line(url, kind, size):
        values = {"URL": url, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": kind,
                  "Archive-length": str(size), **filler}
        return " ".join(values[f] for f in FIELDS[version]).encode() + b"\n"
    yield _member(line(f"filedesc://{name}", "text/plain", len(head)) + head)
    for page_id, url, html in pages:
        mark = "" if page_id is None else f"{PAGE}: {page_id}\r\n"
        block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{mark}"
                 f"Content-Length: {len(html)}\r\n\r\n").encode() + html
        clean = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "about:blank")
        yield _member(line(clean, "text/html", len(block)) + block + b"\n")


def arc_records(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record after the first, which names the version and its fields."""
    plain = _Plain(uri)
    first = plain.line()
    if first is None:
        return
    body = plain.take(int(first.rsplit(b" ", 1)[1])).decode("utf-8", "replace").split("\n")
    version = int(body[0].split(" ")[0])
    if version not in FIELDS:
        raise ValueError(f"{uri}: unknown archive version {version}")
    fields = body[1].split(" ") if len(body) > 1 and body[1].strip() else FIELDS[version]
    while (line := plain.line()) is not None:
        if not line:
            continue
        # a url may hold spaces, the other fields do not
        values = line.decode("utf-8", "replace").rsplit(" ", len(fields) - 1)
        header = dict(zip(fields, values))
        yield header, plain.take(int(header["Archive-length"]))


# --- WARC --------------------------------------------------------------------------------------------

def _split(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head with its empty line, and payload; no head if the block does not begin with one."""
    if block.startswith(b"HTTP/"):
        at = block.find(b"\r\n\r\n")
        if at >= 0:
            return block[:at + 4], block[at + 4:]
    return b"", block


def _page_of(head: bytes) -> int | None:
    found = re.search(rb"(?im)^" + PAGE.encode() + rb":\s*(-?\d+)\s*$", head)
    return int(found[1]) if found else None


def _place(file: str, number: int) -> str:
    return f"{file.rsplit('/', 1)[-1]} {number}"


def describe(header: dict[str, str], block: bytes, place: str = "") -> dict:
    """What a WARC record needs besides the block; equal records at different places have different ids."""
    head, payload = _split(block)
    date = re.sub(r"\D", "", header["Archive-date"]).ljust(14, "0")[:14]
    url = header["URL"]
    sha1 = base64.b32encode(hashlib.sha1(block).digest()).decode()
    return {"url": url, "head": head, "payload": payload, "page_id": _page_of(head),
            "date": f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:]}Z",
            "type": "response" if head else "resource", "mime": header["Content-type"], "block_digest": f"sha1:{sha1}",
            "ip": header["IP-address"], "digest": hashlib.sha256(payload).hexdigest(),
            "record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {sha1} {place}')}>"}


def warc_record(found: dict, refers_to: tuple[int | None, str] | None = None) -> bytes:
    """The bytes of a record; with `refers_to` (page id, record id) a revisit that holds only the head."""
    block = found["head"] if refers_to else found["head"] + found["payload"]
    kind = "application/http; msgtype=response" if found["head"] else found["mime"]
    lines = [("WARC-Type", "revisit" if refers_to else found["type"]), ("WARC-Record-ID", found["record_id"]),
             ("WARC-Date", found["date"]), ("WARC-Target-URI", found["url"]), ("WARC-IP-Address", found["ip"]),
             ("WARC-Payload-Digest", f"sha256:{found['digest']}")]
    if refers_to:
        lines += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", refers_to[1])]
        lines += [] if refers_to[0] is None else [("X-Refers-To-Page", refers_to[0])]
        lines += [("X-Payload-Length", len(found["payload"]))]
    else:
        lines += [("WARC-Block-Digest", found["block_digest"])]
    lines += [("Content-Type", kind), ("Content-Length", len(block))]
    text = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


def warc_records(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record."""
    plain = _Plain(uri)
    while (line := plain.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{uri}: no WARC record")
        header = {}
        while line := plain.line():
            name, _, value = line.decode().partition(": ")
            header[name] = value
        yield header, plain.take(int(header["Content-Length"]))


# --- as Spark jobs -----------------------------------------------------------------------------------

def write_arc(pages: DataFrame, folder: str | None = None, date: str = "20010203040506") -> DataFrame:
    """Legacy archives of (page_id, url, html), alternating between the versions; returns their list (file)."""
    target = folder or new_folder(pages.sparkSession, "arc")

    def run(batches):
        rows = ((i, u, (h or "").encode()) for batch in batches
                for part in (batch.slice(k, 64) for k in range(0, len(batch), 64))
                for i, u, h in zip(*(c.to_pylist() for c in part.columns)))
        first = next(rows, None)
        if first is None:
            return

        def again():
            yield first
            yield from rows
        version = 1 + (first[0] or 0) % 2
        file = write_file(target, "pages.arc.gz", arc_chunks(again(), version, "pages.arc", date))
        yield pa.RecordBatch.from_arrays([pa.array([file])], ["file"])
    chosen = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return materialise(chosen.mapInArrow(run, "file string"), "arcs")


def arc_index(arcs: DataFrame) -> DataFrame:
    """(file, place, page_id, record_id, digest, n_bytes): one small row per record."""
    def run(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows = []
                for place, (header, block) in enumerate(arc_records(file)):
                    found = describe(header, block, _place(file, place))
                    rows.append((file, place, found["page_id"], found["record_id"], found["digest"], len(found["payload"])))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.string(),
                                                                     pa.string(), pa.int64()))],
                        ["file", "place", "page_id", "record_id", "digest", "n_bytes"])
    return materialise(arcs.repartition(parts(arcs)).mapInArrow(
        run, "file string, place bigint, page_id bigint, record_id string, digest string, n_bytes bigint"), "index")


def revisits(index: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(file, list of place, page id and record id of the response) of the records that revisit another."""
    rows = index.where(F.col("n_bytes") >= min_bytes)
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "place", "record_id")
    first = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min(order).alias("to")).where("n > 1")
    other = (rows["file"] != F.col("to.file")) | (rows["place"] != F.col("to.place"))
    return rows.join(first, "digest").where(other).groupBy(rows["file"]).agg(F.collect_list(F.struct(
        "place", F.col("to.page_id").alias("page_id"), F.col("to.record_id").alias("record_id"))).alias("found"))


def convert(arcs: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Writes a WARC file per archive; returns their list (file)."""
    target = folder or new_folder(arcs.sparkSession, "warc")

    def run(batches):
        for batch in batches:
            for file, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                to = {x["place"]: (x["page_id"], x["record_id"]) for x in found or ()}
                chunks = (_member(warc_record(describe(header, block, _place(file, place)), to.get(place)))
                          for place, (header, block) in enumerate(arc_records(file)))
                name = write_file(target, "pages.warc.gz", chunks)
                yield pa.RecordBatch.from_arrays([pa.array([name])], ["file"])
    listed = arcs.join(revisits(arc_index(arcs), min_bytes), "file", "left").select("file", "found")
    return materialise(listed.repartition(parts(arcs)).mapInArrow(run, "file string"), "warcs")


def read_warc(warcs: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, url, date), the digest of a
    response computed anew from its payload."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "url", "date"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())

    def run(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows = []
                for header, block in warc_records(file):
                    head, payload = _split(block)
                    again = header["WARC-Type"] == "revisit"
                    page = header.get("X-Refers-To-Page")
                    rows.append((
                        _page_of(head), int(header["X-Payload-Length"]) if again else len(payload),
                        header["WARC-Payload-Digest"].split(":")[1] if again else hashlib.sha256(payload).hexdigest(),
                        header["WARC-Type"], None if page is None else int(page), header["WARC-Record-ID"],
                        header["WARC-Target-URI"], header["WARC-Date"]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)
    return warcs.repartition(parts(warcs)).mapInArrow(
        run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
             "record_id string, url string, date string")
