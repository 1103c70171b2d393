"""Web archives (WARC 1.1) of pages, with a two-level capture index, written and read by Spark tasks.

* **Writing.** Pages whose payload (the html in UTF-8) occurred in a page of smaller page_id become revisit records that refer to it, the
  others response records. Each task appends its records to archive files of its own, each record a gzip member, and returns a
  capture for each: key, file, offset and length. A file has a name that no other attempt uses, and only files named by captures of
  finished tasks count, so a lost task or executor leaves at most a file that nothing refers to.
* **Index.** Captures are sorted by key: the URL with its host reversed (``com,example)/path``), then page_id. Each range of keys is an
  index file of compressed blocks of ``BLOCK`` captures; its sparse directory, a file beside it, holds the first key, offset and
  length of each block. Over all of them stands the list of first keys by file, which has as many entries as shuffle partitions.
* **Look-up.** Wanted keys are dealt to the index file they are in. A task searches the directory by bisection, reads the bytes of one
  block, and searches in it; captures found are then dealt by archive file and stretch, and neighbouring records are read
  by one range read.

Archives and index lie in ``folder``, which all executors must reach (``pyarrow.fs``: a mounted path, hdfs:// or s3://).

A null html is an empty payload; a null URL has an empty key and no target in its record. Of pages equal in payload the smallest page_id
(null is larger than any) is the response; rows that share it are all responses, and all others refer to it; if all are without id,
all are responses. Payloads under ``min_bytes`` are always responses. Rows that are equal are separate captures. Of any length a payload
is archived whole. Control characters and spaces in URLs are percent-encoded. An empty table gives an empty index. Columns
besides page_id, url and html are not looked at.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.tables import stored
from themeloom.session import shared_folder

#: Captures of an index block.
BLOCK = 1000
#: An archive file is closed when it has so many bytes.
ARCHIVE_BYTES = 1 << 30
#: Records of an archive are read by stretches of so many bytes, in ranges of at most READ bytes with gaps of at most GAP.
STRETCH_BYTES, READ, GAP = 64 << 20, 4 << 20, 64 << 10
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LOWEST, _HIGHEST = -(1 << 64), 1 << 64


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder as Spark names it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    path = re.sub(r"^s3[an]://", "s3://", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels in reverse order, port, ``)``, path and query; without scheme, user and fragment."""
    url = url or ""
    found = re.match(r"(?is)[a-z][a-z0-9+.-]*://([^/?#]*)([^#]*)", url)
    if not found:
        return url
    host, _, port = found[1].rpartition("@")[2].lower().partition(":")
    if not re.fullmatch(r"[0-9.]+", host):
        host = ",".join(reversed(host.rstrip(".").split(".")))
    return f"{host}{':' + port if port else ''}){found[2] or '/'}"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _headers(first: str, pairs: list[tuple[str, object]]) -> bytes:
    return "".join([first, "\r\n", *[f"{k}: {v}\r\n" for k, v in pairs if v is not None], "\r\n"]).encode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """A response record with the payload, or a revisit record without it."""
    target = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    http = _headers("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))])
    block = http if revisit else http + payload
    return _headers("WARC/1.1", [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", date), ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"), ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", _urn(refers_to) if revisit else None), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block)),
    ]) + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of one record. ``payload_bytes`` is that of the full payload, ``payload`` null for revisits."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    pairs = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(pairs["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\ncontent-length: (\d+)", http)[1])
    revisit = pairs["WARC-Type"] == "revisit"

    def page(urn: str | None) -> int | None:
        number = (urn or "<urn:page:>")[10:-1]
        return int(number) if number else None

    if not revisit and (len(payload) != size or f"sha1:{sha1_base32(payload)}" != pairs["WARC-Payload-Digest"]):
        raise ValueError(f"damaged record {pairs['WARC-Record-ID']}")
    return {
        "page_id": page(pairs["WARC-Record-ID"]), "url": pairs.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": pairs["WARC-Payload-Digest"][5:],
        "record_type": pairs["WARC-Type"], "refers_to": page(pairs.get("WARC-Refers-To")), "payload": None if revisit else payload,
    }


CAPTURE = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("start", pa.int64()), ("size", pa.int64())])
CAPTURES = "key string, page_id bigint, file string, start bigint, size bigint"


def _archived(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = store_of(folder)
        out, at, name = None, 0, ""
        try:
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    if out is None:
                        name = f"archive-{uuid4().hex}.warc.gz"
                        out = store.open_output_stream(f"{path}/{name}", compression=None)
                        info = b"format: WARC File Format 1.1\r\n"
                        head = _headers("WARC/1.1", [
                            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid4()}>"), ("WARC-Date", DATE), ("WARC-Filename", name),
                            ("Content-Type", "application/warc-fields"), ("Content-Length", len(info)),
                        ])
                        member = gzip.compress(head + info + b"\r\n\r\n", 6, mtime=0)
                        out.write(member)
                        at = len(member)
                    payload = (r["html"] or "").encode()
                    member = gzip.compress(record(r["page_id"], r["url"], payload, r["refers_to"], r["revisit"]), 6, mtime=0)
                    out.write(member)
                    rows.append({"key": url_key(r["url"]), "page_id": r["page_id"], "file": name, "start": at, "size": len(member)})
                    at += len(member)
                    if at >= ARCHIVE_BYTES:
                        out.close()
                        out = None
                yield pa.RecordBatch.from_pylist(rows, CAPTURE)
        finally:
            if out is not None:
                out.close()

    return run


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Archive every page; returns the captures ``key, page_id, file, start, size``, one a row of ``pages``.

    Digests of payloads meet in one aggregation; pages then find out by one join on the digest whether theirs is shared.
    """
    store, path = store_of(folder)
    store.create_dir(path, recursive=True)
    text = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint"), "url", "html", F.sha2(text, 256).alias("_hash"), F.octet_length(text).alias("_bytes"))
    shared = rows.filter(F.col("_bytes") >= min_bytes).groupBy("_hash").agg(F.count("*").alias("_n"), F.min("page_id").alias("_first"))
    shared = stored(shared.filter("_n > 1 AND _first IS NOT NULL").select("_hash", "_first"))
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("_first")) & F.col("_first").isNotNull(), F.lit(False))
    told = rows.join(shared, "_hash", "left").select("page_id", "url", "html", F.when(revisit, F.col("_first")).alias("refers_to"), revisit.alias("revisit"))
    return stored(told.mapInArrow(_archived(folder), CAPTURES))


PART = pa.schema([("file", pa.string()), ("key", pa.string()), ("page_id", pa.int64()), ("captures", pa.int64())])


def _line(r: dict) -> str:
    return json.dumps([r["key"], r["page_id"], r["file"], r["start"], r["size"]], ensure_ascii=False)


def _order(key: str, page_id: int | None) -> tuple[str, int]:
    return key, _LOWEST + 1 if page_id is None else page_id


def _bounds(key: str, page_id: int | None, exact: bool) -> tuple[tuple[str, int], tuple[str, int]]:
    return (_order(key, page_id),) * 2 if exact else ((key, _LOWEST), (key, _HIGHEST))


def _indexed(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = store_of(folder)
        lines, first, out, at, name, total = [], None, None, 0, "", 0
        directory = []

        def flush():
            nonlocal at, lines
            if lines:
                block = gzip.compress("\n".join(lines).encode(), 6, mtime=0)
                out.write(block)
                directory.append(json.dumps([*json.loads(lines[0])[:2], at, len(block)], ensure_ascii=False))
                at, lines = at + len(block), []

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    name, first = f"index-{uuid4().hex}", r
                    out = store.open_output_stream(f"{path}/{name}.blocks.gz", compression=None)
                lines.append(_line(r))
                total += 1
                if len(lines) == BLOCK:
                    flush()
        if out is not None:
            flush()
            out.close()
            with store.open_output_stream(f"{path}/{name}.directory", compression=None) as f:
                f.write("\n".join(directory).encode())
            yield pa.RecordBatch.from_pylist([{"file": name, "key": first["key"], "page_id": first["page_id"], "captures": total}], PART)

    return run


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Index files over ``captures``; returns a row for each, ``file, key, page_id, captures`` (first key)."""
    order = ["key", "page_id", "file", "start"]
    ranges = captures.select(*CAPTURE.names).repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranges.mapInArrow(_indexed(folder), "file string, key string, page_id bigint, captures bigint"))


def _routed(firsts: list[tuple[str, int]]):
    """Index files that a wanted key can be in. Without ``exact`` all page_ids of the key are wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                key = url_key(r["url"])
                lo, hi = _bounds(key, r["page_id"], r["exact"])
                for part in range(max(bisect.bisect_left(firsts, lo) - 1, 0), bisect.bisect_right(firsts, hi)):
                    rows.append({"key": key, "page_id": r["page_id"], "exact": r["exact"], "part": part})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("exact", pa.bool_()), ("part", pa.int32())]))

    return run


def _searched(folder: str, files: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = store_of(folder)
        part, source, directory, starts, block, keys, lines = None, None, [], [], None, [], []
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["part"] != part:
                    part, block = r["part"], None
                    if source is not None:
                        source.close()
                    with store.open_input_stream(f"{path}/{files[part]}.directory", compression=None) as f:
                        directory = [json.loads(x) for x in f.read().decode().split("\n")]
                    starts = [_order(*d[:2]) for d in directory]
                    source = store.open_input_file(f"{path}/{files[part]}.blocks.gz")
                lo, hi = _bounds(r["key"], r["page_id"], r["exact"])
                for b in range(max(bisect.bisect_left(starts, lo) - 1, 0), bisect.bisect_right(starts, hi)):
                    if b != block:
                        source.seek(directory[b][2])
                        lines = [json.loads(x) for x in gzip.decompress(source.read(directory[b][3])).decode().split("\n")]
                        keys, block = [_order(*x[:2]) for x in lines], b
                    for x in lines[bisect.bisect_left(keys, lo) : bisect.bisect_right(keys, hi)]:
                        rows.append(dict(zip(CAPTURE.names, x, strict=True)))
            yield pa.RecordBatch.from_pylist(rows, CAPTURE)
        if source is not None:
            source.close()

    return run


def look_up(wanted: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """Captures of the wanted ``url, page_id, exact`` (``exact`` false: all captures of the URL's key, whatever their page_id)."""
    parts = index.select("file", "key", "page_id").collect()  # an entry for each index file, at most as many as shuffle partitions
    if not parts:
        return wanted.sparkSession.createDataFrame([], CAPTURES)
    parts.sort(key=lambda p: (_order(p.key, p.page_id), p.file))
    firsts, files = [_order(p.key, p.page_id) for p in parts], [p.file for p in parts]
    wanted = wanted.select("url", F.when(F.col("exact"), F.col("page_id")).cast("bigint").alias("page_id"), "exact")
    routed = wanted.mapInArrow(_routed(firsts), "key string, page_id bigint, exact boolean, part int")
    dealt = routed.distinct().repartition("part").sortWithinPartitions("part", "key", "page_id")
    return dealt.mapInArrow(_searched(folder, files), CAPTURES)


RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
_RECORD = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def _read(folder: str, payloads: bool):
    def ranges(rows: list[dict]) -> Iterator[list[dict]]:
        """Records that are read at once."""
        group: list[dict] = []
        for r in rows:
            if group:
                end = group[-1]["start"] + group[-1]["size"]
                if r["file"] != group[0]["file"] or r["start"] > end + GAP or r["start"] + r["size"] - group[0]["start"] > READ:
                    yield group
                    group = []
            group.append(r)
        if group:
            yield group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = store_of(folder)
        name, source = None, None
        for batch in batches:
            for group in ranges(batch.to_pylist()):
                if group[0]["file"] != name:
                    if source is not None:
                        source.close()
                    name = group[0]["file"]
                    source = store.open_input_file(f"{path}/{name}")
                begin = group[0]["start"]
                source.seek(begin)
                raw = source.read(group[-1]["start"] + group[-1]["size"] - begin)
                records = [parse(gzip.decompress(raw[r["start"] - begin : r["start"] - begin + r["size"]])) for r in group]
                if not payloads:
                    records = [x | {"payload": None} for x in records]
                yield pa.RecordBatch.from_pylist(records, _RECORD)
        if source is not None:
            source.close()

    return run


def read_records(captures: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Records of ``captures``, with the payloads of responses if wanted. Payloads of responses are checked against their digest."""
    order = ["file", "start"]
    dealt = captures.repartition("file", F.floor(F.col("start") / STRETCH_BYTES)).sortWithinPartitions(*order)
    return dealt.mapInArrow(_read(folder, payloads), RECORD)


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/warc-{uuid4().hex}"


def archive(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> tuple[str, DataFrame]:
    """Write archives and index of ``pages`` to ``folder``; returns it and the list of index files."""
    folder = folder or new_folder(pages.sparkSession)
    return folder, write_index(write_archives(pages, folder, min_bytes), folder)


def digests(pages: DataFrame) -> DataFrame:
    """Archive every page, then look every page up in the index and read its record back."""
    folder, index = archive(pages)
    wanted = pages.select("url", "page_id", F.lit(True).alias("exact"))
    found = read_records(look_up(wanted, index, folder), folder, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
