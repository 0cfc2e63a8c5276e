"""WARC archives with an index written first and coalesced byte-range reads (operator 10).

``write_archives`` writes each partition's records to ``.warc.gz`` files (every record its own
gzip member, so a byte range of the file is a record) and returns an index row per record:
file, offset, length, URL, digest. The index is stored as a table at once; it is the commit:
files that a lost or repeated task leaves behind are in no index. ``read_records`` sorts the
index rows it is given by file and offset, joins neighbouring ranges into reads of bounded
size, and parses the records.

Files go through ``pyarrow.fs`` (file, hdfs, s3, gs and abfs addresses), in the shared folder
of the cluster. Payloads are streamed record by record; nothing is gathered.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F

from tabforge.llm._store import fresh_dir, salted_join, stored

#: The date of every record: one value, so that the same pages give the same archives.
DATE = "2000-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
#: A page_id of more rows than this is dealt over several tasks.
HOT_ROWS = 10_000
HOT_SALTS = 256
#: A payload of at least this many bytes can be stood for by a revisit record.
REVISIT_BYTES = 1000
FILE_BYTES = 256 << 20
READ_BYTES = 8 << 20
#: Ranges closer than this are read as one.
GAP_BYTES = 64 << 10
INDEX = "page_id long, file string, offset long, length long, url string, payload_digest string, payload_bytes long, record_type string"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    local = re.match(r"(?:file:/*|/)", uri)
    if local:
        return pafs.LocalFileSystem(), "/" + uri[local.end():]
    return pafs.FileSystem.from_uri(uri)


def _record(head: list[tuple[str, str]], block: bytes) -> bytes:
    head = [*head, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def file_record(name: str) -> bytes:
    """The warcinfo record that every archive begins with. It is in no index."""
    block = b"software: tabforge\r\nformat: WARC File Format 1.1\r\n"
    return _record([("WARC-Type", "warcinfo"), ("WARC-Date", DATE), ("WARC-Record-ID", f"<urn:archive:{name}>"), ("WARC-Filename", name),
                    ("Content-Type", "application/warc-fields")], block)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a response's block is an HTTP message with the payload. A revisit has no
    payload: its block is empty and it names the response's id, the payload's digest and its size."""
    revisit = refers_to is not None
    clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            ("WARC-Date", DATE), ("WARC-Target-URI", clean), ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Payload-Length", str(len(payload)))]
    if revisit:
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return _record([*head, ("Content-Type", "application/http; msgtype=response")], b"" if revisit else _HTTP % len(payload) + payload)


def parse_record(raw: bytes) -> dict:
    cut = raw.index(b"\r\n\r\n")
    head = dict(line.split(": ", 1) for line in raw[:cut].decode().split("\r\n")[1:])
    block = raw[cut + 4:cut + 4 + int(head["Content-Length"])]
    number = lambda s: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", s)) else None
    revisit = head["WARC-Type"] == "revisit"
    block = block if revisit else block[block.index(b"\r\n\r\n") + 4:]
    if not revisit and (len(block) != int(head["WARC-Payload-Length"]) or "sha1:" + hashlib.sha1(block).hexdigest() != head["WARC-Payload-Digest"]):
        raise ValueError(f"record {head['WARC-Record-ID']}: payload does not match its digest")
    return {"page_id": number(head["WARC-Record-ID"]), "url": head["WARC-Target-URI"] or None,
            "payload_bytes": int(head["WARC-Payload-Length"]), "payload_digest": head["WARC-Payload-Digest"][5:],
            "record_type": head["WARC-Type"], "refers_to": number(head["WARC-Refers-To"]) if revisit else None,
            "payload": None if revisit else block}


def _writer(folder: str):
    def run(batches):
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        out, name, at = None, None, 0
        try:
            for batch in batches:
                index = []
                for page_id, url, html, digest, refers in zip(*(batch.column(c) for c in ("page_id", "url", "html", "digest", "refers_to"))):
                    page_id, url, digest, refers = page_id.as_py(), url.as_py(), digest.as_py(), refers.as_py()
                    payload = (html.as_py() or "").encode()
                    packed = gzip.compress(record_bytes(page_id, url, payload, digest, refers), 4, mtime=0)
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                        first = gzip.compress(file_record(name), 4, mtime=0)
                        out.write(first)
                        at = len(first)
                    out.write(packed)
                    index.append((page_id, name, at, len(packed), url, digest, len(payload), "response" if refers is None else "revisit"))
                    at += len(packed)
                types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*index), types)] if index else [pa.array([], t) for t in types],
                                                 names=[c.split()[0] for c in INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()
    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) and return the stored index.

    Of records with equal payloads of at least REVISIT_BYTES, the one with the largest page_id
    is a response and the others are revisits that refer to it. Groups meet only as (digest,
    largest page_id), partially aggregated, and the html moves by page_id, so a payload that
    a third of all pages share lands nowhere in one piece. Rows without page_id do not move, and
    those of a page_id with more than HOT_ROWS rows are dealt over several tasks.

    Defined cases: a null html is an empty payload; a null page_id is always a response;
    a repeated page_id is written as often as it occurs, the largest one as a response each
    time; a null url is empty in the archive and null when read."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    body = F.coalesce("html", F.lit("")).cast("binary")
    base = base.withColumn("digest", F.sha1(body))
    digests = stored(base.select("page_id", "digest", F.octet_length(body).alias("size"))
                     .where((F.col("size") >= REVISIT_BYTES) & F.col("page_id").isNotNull()), "digests")
    leaders = (digests.groupBy("digest", "size").agg(F.max("page_id").alias("leader"), F.count("*").alias("n"))
               .where("n > 1").drop("n"))
    revisits = (digests.join(leaders, ["digest", "size"]).where("page_id != leader")
                .groupBy("page_id").agg(F.map_from_entries(F.collect_set(F.struct("digest", "leader"))).alias("refer")))
    known, none = base.where("page_id is not null"), base.where("page_id is null").withColumn("refer", F.lit(None).cast("map<string,long>"))
    hot = stored(known.groupBy("page_id").count().where(F.col("count") > HOT_ROWS).select("page_id"), "hot")     # at most rows / HOT_ROWS
    if hot.isEmpty():
        met = known.join(revisits, "page_id", "left")
    else:
        row = F.monotonically_increasing_id()
        often = salted_join(known, hot, "page_id", row, "left_semi")
        met = salted_join(known, hot, "page_id", row, "left_anti").join(revisits, "page_id", "left")
        met = met.unionByName(salted_join(often, revisits.join(hot, "page_id", "left_semi"), "page_id", row, "left", HOT_SALTS))
    rows = met.unionByName(none).select("page_id", "url", "html", "digest", F.col("refer")[F.col("digest")].alias("refers_to"))
    return stored(rows.mapInArrow(_writer(folder), INDEX), "index")


def _ranges(rows: list[tuple[int, int]]) -> list[tuple[int, int, list[int]]]:
    """(start, end, row numbers) of the reads for (offset, length) rows sorted by offset."""
    out: list[tuple[int, int, list[int]]] = []
    for k, (a, n) in enumerate(rows):
        if out and a - out[-1][1] <= GAP_BYTES and a + n - out[-1][0] <= READ_BYTES:
            out[-1] = (out[-1][0], max(out[-1][1], a + n), [*out[-1][2], k])
        else:
            out.append((a, a + n, [k]))
    return out


def _fetcher(folder: str, payload: bool):
    names = [c.split()[0] for c in RECORD.split(", ")][:None if payload else -1]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][:len(names)]

    def run(batches):
        store, base = open_store(folder)
        for batch in batches:
            files, offs, lens = (batch.column(c).to_pylist() for c in ("file", "offset", "length"))
            a = 0
            while a < len(files):
                b = a
                while b < len(files) and files[b] == files[a]:
                    b += 1
                with store.open_input_file(f"{base}/{files[a]}") as f:
                    for lo, hi, rows in _ranges(list(zip(offs[a:b], lens[a:b]))):
                        raw = memoryview(f.read_at(hi - lo, lo))
                        got = [parse_record(zlib.decompress(raw[offs[a + k] - lo:offs[a + k] - lo + lens[a + k]], 31)) for k in rows]
                        yield pa.RecordBatch.from_arrays([pa.array([g[n] for g in got], t) for n, t in zip(names, types)], names=names)
                a = b
    return run


def read_records(index: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records of the given index rows: ranges sorted by file and offset are joined and read
    in pieces of at most READ_BYTES (one longer record is one read); a file's stretches of
    16 reads are separate units of work, so one large archive is read by many tasks."""
    stretch = F.floor(F.col("offset") / (16 * READ_BYTES)).alias("stretch")
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(1, -(-total // (8 * READ_BYTES)))            # by the archives' bytes, not the index's
    units = (index.select("file", "offset", "length", stretch).repartition(int(tasks), "file", "stretch")
             .sortWithinPartitions("file", "offset"))
    return units.mapInArrow(_fetcher(folder, payload), RECORD if payload else RECORD.rsplit(", ", 1)[0])


def archive_roundtrip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in a new shared folder, then read every record back."""
    folder = fresh_dir(pages.sparkSession, "warc")
    index = write_archives(pages, folder)
    return read_records(index, folder, payload=False)
