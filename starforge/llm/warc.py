"""WARC archives with a two-level capture index.

Writing: each page is one record, gzipped by itself, in archives of bounded size under the shared folder. Of records
with equal payloads the one with the smallest page_id is a response, the others are revisits that refer to it.

Index: one line for each capture, keyed by the URL with its host reversed (``com,example,www)/path``) and the page_id.
Lines are range-partitioned by key; each task packs its run into compressed blocks of BLOCK_LINES lines in one file. The
directory keeps one row for each block: its first and last key, file, offset and length. It is sparse (a few bytes for
BLOCK_LINES captures), so a task that looks keys up holds it whole.

Reading: keys are binary-searched in the directory, grouped by block, the block is read by range and
searched again, and the records are read by range from their archives.

Files are written under names no other attempt uses, and only those that a finished task reports are ever
read, so a lost executor or a repeated task leaves no half file in the archive. Paths go through
``pyarrow.fs``, which opens the schemes of Spark's shared folders (file, hdfs, s3, gs).

Defined results: a null html is an empty payload, a null URL an empty one. A null page_id counts as larger than any.
Rows that agree in page_id and payload are captures of one page and of one type. An empty table gives no file.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import join_groups, keep_named, ready, stored
from starforge.session import work_path

#: An archive is closed and the next begun when it holds so many bytes.
ARCHIVE_BYTES = 256 << 20
#: Capture lines in one block of the index.
BLOCK_LINES = 2_000
#: Records whose ranges lie at most so far apart are read together, up to READ_BYTES.
READ_GAP, READ_BYTES = 64 << 10, 8 << 20
GZIP_LEVEL = 4
#: Fixed: records carry one date, so that writing the same pages again gives the same bytes.
WARC_DATE = "2000-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "key string, page_id long, url string, archive string, offset long, length long"
DIRECTORY = "block int, first string, last string, file string, offset long, length long, lines int"


def surt(url: str) -> str:
    """URL with its host reversed: ``http://www.example.com:80/a?b#c`` is ``com,example,www)/a?b``."""
    text = url.strip()
    try:
        parts = urlsplit(text if "://" in text else "//" + text)
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:  # no valid host or port: the text itself is the key
        return ")" + text.lower()
    if port and (parts.scheme, port) not in {("http", 80), ("https", 443)}:
        host_key = ",".join(reversed(host.split("."))) + f":{port}"
    else:
        host_key = ",".join(reversed(host.split(".")))
    return f"{host_key}){(parts.path or '/').lower()}" + (f"?{parts.query.lower()}" if parts.query else "")


def capture_key(url: str | None, page_id: int | None) -> str:
    """Sort key of a capture. Blanks and line ends can't be in a URL, so they are escaped; ids sort as numbers."""
    key = surt(url or "").replace("%", "%25").replace(" ", "%20").replace("\n", "%0A").replace("\r", "%0D").replace("\t", "%09")
    return f"{key} {'null' if page_id is None else format(page_id + (1 << 63), '020d')}"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def open_folder(uri: str):
    """File system and path of a folder."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _page_urn(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id, url: str, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """One gzipped WARC record. Its block is the HTTP response, of which a revisit keeps the head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_page_urn(page_id)}",
             f"WARC-Date: {WARC_DATE}", "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"),
             f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        lines[2:2] = [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_page_urn(refers_to)}"]
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse(data: bytes) -> dict:
    """Fields and payload of one gzipped record. The payload's digest is computed, and must be the one recorded."""
    raw = zlib.decompress(data, 31)
    head, rest = raw.split(b"\r\n\r\n", 1)
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    length = next(int(x[15:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or digest32(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    of = lambda urn: None if urn in (None, "<urn:page:null>") else int(urn[10:-1])
    return {"page_id": of(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload_bytes": length,
            "payload_digest": digest, "record_type": kind, "refers_to": of(fields.get("WARC-Refers-To")), "payload": payload if kind == "response" else None}


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(r_page, r_digest, refers_to) of the pages whose payload, of at least ``least_bytes``, a smaller page_id has too.
    Only ids and digests move; equal payloads are found by digest and length."""
    body = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = stored(pages.select("page_id", F.sha1(body).alias("digest"), F.octet_length(body).alias("size")), "warc-digests")
    groups = rows.where(F.col("size") >= least_bytes).groupBy("digest", "size").agg(
        F.min("page_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    groups = stored(groups, "warc-equal")
    joined = join_groups(rows, groups, ["digest", "size"], "n")
    later = joined.where(~F.col("page_id").eqNullSafe(F.col("least")))
    return stored(later.select(F.col("page_id").alias("r_page"), F.col("digest").alias("r_digest"), F.col("least").alias("refers_to")).distinct(), "warc-revisits")


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write every page (page_id, url, html) to archives under ``folder``; returns the capture lines."""
    ready(pages.sparkSession)
    rows = keep_named(pages, {"page_id": "long", "url": "string", "html": "string"})
    known = revisits(rows, least_bytes)
    digest = F.sha1(F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")))
    marked = rows.withColumn("digest", digest)
    same = F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("digest") == F.col("r_digest"))
    marked = marked.join(known, same, "left").select("page_id", "url", "html", F.col("r_digest").isNotNull().alias("revisit"), "refers_to")

    def write(batches):
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        out = name = None
        offset = 0
        try:
            for batch in batches:
                lines = []
                columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "revisit", "refers_to")]
                for page_id, url, html, revisit, refers_to in zip(*columns):
                    if out is None or offset > ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{root}/{name}", compression=None)
                    payload = (html or "").encode("utf-8", "surrogatepass")
                    data = record(page_id, url or "", payload, digest32(payload), refers_to, revisit)
                    out.write(data)
                    lines.append((capture_key(url, page_id), page_id, url, name, offset, len(data)))
                    offset += len(data)
                if lines:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*lines), types)], names)
        finally:
            if out is not None:
                out.close()

    import pyarrow as pa
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    names = ["key", "page_id", "url", "archive", "offset", "length"]
    return stored(marked.mapInArrow(write, CAPTURE), "warc-captures")


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the capture lines, sorted by key, as compressed blocks under ``folder``; returns the block directory, in key order."""
    spark = captures.sparkSession
    ready(spark)
    ordered = captures.select("key", "archive", "offset", "length").repartitionByRange("key", "archive", "offset").sortWithinPartitions("key", "archive", "offset")

    def pack(batches):
        files, root = open_folder(folder)
        out, name, at, held = None, f"{uuid.uuid4().hex}.cdx.gz", 0, []

        def block():
            nonlocal out, at
            if out is None:
                files.create_dir(root, recursive=True)
                out = files.open_output_stream(f"{root}/{name}", compression=None)
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            data = packer.compress("\n".join(f"{k} {a} {o} {n}" for k, a, o, n in held).encode("utf-8", "surrogatepass")) + packer.flush()
            out.write(data)
            row = {"block": 0, "first": held[0][0], "last": held[-1][0], "file": name, "offset": at, "length": len(data), "lines": len(held)}
            at += len(data)
            held.clear()
            return row

        try:
            for pdf in batches:
                rows = []
                for line in zip(pdf["key"], pdf["archive"], pdf["offset"], pdf["length"]):
                    held.append(line)
                    if len(held) == block_lines:
                        rows.append(block())
                if rows:
                    yield pd.DataFrame(rows)
            if held:
                yield pd.DataFrame([block()])
        finally:
            if out is not None:
                out.close()

    return stored(ordered.mapInPandas(pack, DIRECTORY), "warc-directory")


def load_directory(directory: DataFrame) -> pd.DataFrame:
    """The sparse directory, sorted: one row for each BLOCK_LINES captures, the only part of the index a searcher holds whole."""
    rows = directory.toPandas().sort_values(["first", "last", "file", "offset"], kind="stable", ignore_index=True)
    return rows


def look_up(keys: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """Capture lines (key, archive, offset, length) of the distinct capture keys in column ``key``."""
    spark = keys.sparkSession
    ready(spark)
    rows = load_directory(directory)
    held = spark.sparkContext.broadcast((rows["first"].tolist(), rows["last"].tolist(), rows["file"].tolist(), rows["offset"].tolist(), rows["length"].tolist()))

    def locate(batches):
        first, last, *_ = held.value
        for pdf in batches:
            found = [(k, b) for k in pdf["key"] for b in blocks_of(first, last, k)]
            yield pd.DataFrame(found, columns=["key", "block"]).astype({"block": "int32", "key": object})

    def search(group, pdf):
        _, _, name, offset, length = held.value
        b = group[0]
        files, root = open_folder(folder)
        with files.open_input_file(f"{root}/{name[b]}") as f:
            lines = zlib.decompress(f.read_at(length[b], offset[b]), 31).decode("utf-8", "surrogatepass").split("\n")
        split = [x.rsplit(" ", 3) for x in lines]
        sorted_keys = [x[0] for x in split]
        out = []
        for k in pdf["key"]:
            i = bisect.bisect_left(sorted_keys, k)
            while i < len(split) and sorted_keys[i] == k:
                out.append((k, split[i][1], int(split[i][2]), int(split[i][3])))
                i += 1
        return pd.DataFrame(out, columns=["key", "archive", "offset", "length"])

    # a block answers at most BLOCK_LINES distinct keys, so its group is bounded
    located = keys.select("key").distinct().mapInPandas(locate, "key string, block int")
    return located.groupBy("block").applyInPandas(search, "key string, archive string, offset long, length long")


def blocks_of(first: list[str], last: list[str], key: str) -> range:
    """Blocks that may hold ``key``: runs of equal keys may reach over several."""
    return range(bisect.bisect_left(last, key), bisect.bisect_right(first, key))


def find_prefix(prefix: str, directory: pd.DataFrame, folder: str) -> list[tuple]:
    """Captures (key, archive, offset, length) whose URL key begins with ``prefix`` (a host: ``com,example``), for
    interactive use: reads only the blocks in range."""
    first, last = directory["first"].tolist(), directory["last"].tolist()
    out = []
    files, root = open_folder(folder)
    for b in range(bisect.bisect_left(last, prefix), bisect.bisect_left(first, prefix + "\U0010ffff")):
        row = directory.iloc[b]
        with files.open_input_file(f"{root}/{row['file']}") as f:
            text = zlib.decompress(f.read_at(int(row["length"]), int(row["offset"])), 31).decode("utf-8", "surrogatepass")
        out += [(k, a, int(o), int(n)) for k, a, o, n in (x.rsplit(" ", 3) for x in text.split("\n")) if k.startswith(prefix)]
    return out


def read_records(lines: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records of capture lines, read by range: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to and, unless ``payload`` is false, the payload (null for a revisit)."""
    spark = lines.sparkSession
    ready(spark)
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payload
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payload

    def read(batches):
        files, root = open_folder(folder)
        name = f = None
        try:
            for pdf in batches:
                wanted = list(zip(pdf["archive"], pdf["offset"].tolist(), pdf["length"].tolist()))
                at = 0
                while at < len(wanted):  # neighbours in one archive are read together
                    archive, begin, n = wanted[at]
                    stop, k = begin + n, at + 1
                    while k < len(wanted) and wanted[k][0] == archive and 0 <= wanted[k][1] - stop <= READ_GAP and wanted[k][1] + wanted[k][2] - begin <= READ_BYTES:
                        stop, k = wanted[k][1] + wanted[k][2], k + 1
                    if archive != name:
                        if f is not None:
                            f.close()
                        name, f = archive, files.open_input_file(f"{root}/{archive}")
                    data = f.read_at(stop - begin, begin)
                    found = [parse(data[o - begin:o - begin + n]) for _, o, n in wanted[at:k]]
                    yield pd.DataFrame({c: pd.Series([x[c] for x in found], dtype="Int64" if c in ("page_id", "payload_bytes", "refers_to") else object) for c in names})
                    at = k
        finally:
            if f is not None:
                f.close()

    # range partitions keep neighbours of an archive together and split a large archive over tasks
    # (a given count, since adaptive execution would merge these small lines into a few tasks that read large records)
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = lines.repartitionByRange(count, "archive", "offset").sortWithinPartitions("archive", "offset")
    return near.mapInPandas(read, schema)


def archive(pages: DataFrame, least_bytes: int = 0) -> tuple[str, DataFrame, DataFrame]:
    """Write archives and index of ``pages`` to a new shared folder: (folder, captures, directory)."""
    folder = work_path(pages.sparkSession, "llm", f"warc-{uuid.uuid4().hex}")
    captures = write_archives(pages, folder, least_bytes)
    return folder, captures, build_index(captures, folder)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages``, then fetch every page by its key through directory and blocks and read it from the archives."""
    folder, captures, directory = archive(pages, least_bytes)
    found = stored(look_up(captures, directory, folder), "warc-found")
    return read_records(found, folder, payload=False).drop("url")
