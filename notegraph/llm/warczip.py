"""WARC records in ZIP-packaged archives: a writer, and a reader that reads ranges without extraction.

An archive is a ZIP file of stored members: ``archive/data.warc.gz`` (one gzip member per record),
``indexes/index.cdxj`` (one JSON line per record with its place) and ``datapackage.json``. The reader fetches the
end of the file, follows the ZIP64 locator where there is one, parses the central directory, finds each member's
data through its local header, reads the index and then fetches each record by its own byte range.

Files lie in a folder that all executors share and are opened through its file system, never through a local copy.
A task writes files under names of its own attempt and hands out the names it has finished, so a lost or repeated
task leaves only unused files behind.

Defined cases: a null html is the empty payload; the payload is the UTF-8 text; pages with equal payloads (equal
SHA-1) of at least ``min_bytes`` are grouped: the largest page id is the response and the others revisit it, rows
that repeat that id are responses too; a null page id is a response; very long pages are one record each, held by one
task; an empty table gives no archives and no rows; extra columns, whatever their names, are never read.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notegraph.llm.common import materialize, shared_dir, sieve, table

#: An archive is closed once its records take so many bytes.
ARCHIVE_BYTES = 64 << 20
#: Records that lie together are fetched in one range of at most so many bytes.
RANGE_BYTES = 4 << 20
#: Records of an archive that are read together; the writer hands out where in the index each such piece begins.
PIECE = 2000
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def file_system(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


# --- WARC records


def record(kind: str, uri: str, payload: bytes, page_id: int | None, refers_to: int | None = None) -> bytes:
    """One WARC/1.1 record. A revisit leaves out the payload and keeps its digest and length."""
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if kind == "response" else b"")
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {uri}')}>",
        "WARC-Target-URI": "".join(c for c in uri if c not in "\r\n"),
        "WARC-Date": "2024-01-01T00:00:00Z",
        "WARC-Page-ID": "" if page_id is None else str(page_id),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "WARC-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
    }
    if kind == "revisit":
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To-Page": str(refers_to)}
    head["Content-Length"] = str(len(body))
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    return lines.encode("utf-8", "replace") + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, and the payload behind the HTTP headers."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record begins here")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


# --- ZIP directories


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header_at: int


def directory(f, size: int) -> list[Member]:
    """The members of a ZIP file, by its central directory; ``f`` needs ``read_at`` semantics through seek and read."""

    def at(start: int, n: int) -> bytes:
        f.seek(start)
        return f.read(n)

    tail_at = max(0, size - 65_557)
    tail = at(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of a central directory")
    n, length, start = struct.unpack("<HII", tail[end + 10 : end + 20])
    if n == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = end - 20
        if locator < 0 or tail[locator : locator + 4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        (end64,) = struct.unpack("<Q", tail[locator + 8 : locator + 16])
        head = at(end64, 56)
        if head[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of directory")
        n, length, start = struct.unpack("<QQQ", head[32:56])
    raw, out, p = at(start, length), [], 0
    for _ in range(n):
        if raw[p : p + 4] != b"PK\x01\x02":
            raise ValueError("a broken central directory")
        method = struct.unpack("<H", raw[p + 10 : p + 12])[0]
        stored, full = struct.unpack("<II", raw[p + 20 : p + 28])
        name_n, extra_n, note_n = struct.unpack("<HHH", raw[p + 28 : p + 34])
        (header_at,) = struct.unpack("<I", raw[p + 42 : p + 46])
        name, extra = raw[p + 46 : p + 46 + name_n], raw[p + 46 + name_n : p + 46 + name_n + extra_n]
        q = 0
        while q + 4 <= len(extra):
            tag, k = struct.unpack("<HH", extra[q : q + 4])
            if tag == 1:  # ZIP64: only the fields that overflowed, in this order
                wide = iter(struct.unpack(f"<{k // 8}Q", extra[q + 4 : q + 4 + k // 8 * 8]))
                full = next(wide) if full == 0xFFFFFFFF else full
                stored = next(wide) if stored == 0xFFFFFFFF else stored
                header_at = next(wide) if header_at == 0xFFFFFFFF else header_at
            q += 4 + k
        out.append(Member(name.decode("utf-8", "replace"), method, stored, header_at))
        p += 46 + name_n + extra_n + note_n
    return out


def data_start(f, m: Member) -> int:
    """Where a stored member's bytes begin."""
    if m.method:
        raise ValueError(f"{m.name} is compressed; only stored members are read in ranges")
    f.seek(m.header_at)
    head = f.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no local header")
    name_n, extra_n = struct.unpack("<HH", head[26:30])
    return m.header_at + 30 + name_n + extra_n


def read_records(path: str, start: int = 0, end: int | None = None) -> Iterator[bytes]:
    """The raw records of an archive whose index lines lie in the bytes ``start`` to ``end`` of the index (none: all), in
    the order of the index, each from its own range."""
    system, inner = file_system(path)
    size = system.get_file_info(inner).size
    with system.open_input_file(inner) as f:
        members = {m.name: m for m in directory(f, size)}
        base = data_start(f, members[DATA])
        f.seek(data_start(f, members[INDEX]) + start)
        lines = f.read((members[INDEX].size if end is None else end) - start).decode().splitlines()
        places = [(int(x["offset"]), int(x["length"])) for x in (json.loads(line.split(" ", 2)[2]) for line in lines)]
        i = 0
        while i < len(places):
            stop = places[i][0] + RANGE_BYTES
            j = max(i + 1, bisect.bisect_right(places, stop, lo=i, key=lambda p: p[0] + p[1]))
            f.seek(base + places[i][0])
            block = f.read(places[j - 1][0] + places[j - 1][1] - places[i][0])
            for offset, length in places[i:j]:
                a = offset - places[i][0]
                yield zlib.decompress(block[a : a + length], 31)
            i = j


class ArchiveWriter:
    """Writes records into one archive through a file system that may only append."""

    def __init__(self, path: str, piece: int = PIECE):
        self.path, self.piece = path, piece
        system, inner = file_system(path)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.raw = io.BufferedWriter(system.open_output_stream(inner), 1 << 20)
        self.zip = zipfile.ZipFile(self.raw, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(DATA, "w", force_zip64=True)
        self.index: list[str] = []
        self.at, self.index_bytes, self.marks = 0, 0, []

    def add(self, uri: str, raw: bytes) -> None:
        packed = gzip.compress(raw, 3, mtime=0)
        self.member.write(packed)
        place = json.dumps({"url": uri, "offset": str(self.at), "length": str(len(packed)), "filename": "data.warc.gz"})
        if len(self.index) % self.piece == 0:
            self.marks.append(self.index_bytes)
        self.index.append(f"{len(self.index):012d} 20240101000000 {place}\n")
        self.index_bytes += len(self.index[-1].encode())
        self.at += len(packed)

    def close(self) -> tuple[str, int, list[int]]:
        """The path, the number of records, and where the pieces of the index begin, its end last."""
        self.member.close()
        self.zip.writestr(INDEX, "".join(self.index))
        self.zip.writestr("datapackage.json", json.dumps({"profile": "data-package", "resources": [{"path": DATA}, {"path": INDEX}]}))
        self.zip.close()
        self.raw.close()
        return self.path, len(self.index), [*self.marks, self.index_bytes]


# --- over tables


def with_revisits(df: DataFrame, id_col: str, payload_col: str, url_col: str, min_bytes: int = 0) -> DataFrame:
    """``(page_id, url, payload, refers_to)``; refers_to is null for responses."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    large = F.octet_length("payload") >= min_bytes
    groups = rows.where(large).groupBy("sha").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    groups = materialize(groups.where((F.col("n") > 1) & F.col("last").isNotNull()).drop("n"), "warc-groups")
    # only pages that may have a copy are shuffled
    rows = sieve(rows, F.xxhash64("sha"), groups.select(F.xxhash64("sha")))
    alone = rows.where("not __ng_maybe").select("page_id", "url", "payload", F.lit(None).cast("long").alias("refers_to"))
    joined = rows.where("__ng_maybe").join(groups, "sha", "left")
    refers = F.when(large & (F.col("page_id") != F.col("last")), F.col("last"))
    return alone.unionByName(joined.select("page_id", "url", "payload", refers.alias("refers_to")))


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, piece: int = PIECE) -> DataFrame:
    """Write ``(page_id, url, payload, refers_to)``; returns the finished archives ``(path, records, marks)``, in a written
    table. The marks tell where in the index each piece of so many records begins."""

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        writer, done = None, []
        for pdf in batches:
            for page_id, url, payload, refers in zip(pdf["page_id"].tolist(), pdf["url"].tolist(), pdf["payload"].tolist(), pdf["refers_to"].tolist(), strict=True):
                if writer is None:
                    writer = ArchiveWriter(f"{name}-{len(done)}.wacz", piece)
                page_id, refers = (None if pd.isna(x) else int(x) for x in (page_id, refers))
                url = url if isinstance(url, str) else ""
                kind = "response" if refers is None else "revisit"
                writer.add(url, record(kind, url, bytes(payload), page_id, refers))
                if writer.at >= archive_bytes:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        yield pd.DataFrame(done, columns=["path", "records", "marks"])

    exact = rows.select("page_id", "url", "payload", "refers_to")
    # ids as texts: pandas would turn a column of longs with nulls into doubles
    exact = exact.withColumns({"page_id": F.col("page_id").cast("string"), "refers_to": F.col("refers_to").cast("string")})
    return materialize(exact.mapInPandas(run, "path string, records long, marks array<long>"), "warc-archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    Archives are read in the pieces of their marks, dealt evenly over the tasks; of the index each task reads its piece.
    """
    ends = F.arrays_zip(F.slice("marks", F.lit(1), F.size("marks") - 1).alias("first"), F.slice("marks", F.lit(2), F.size("marks") - 1).alias("end"))
    pieces = archives.where(F.col("records") > 0).select("path", F.explode(ends).alias("p")).select("path", "p.first", "p.end")
    # a number keeps adaptive execution from gathering the few small rows, each of which stands for much work, in one task
    pieces = pieces.repartition(int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path", "first")

    def run(batches):
        for pdf in batches:
            for path, first, end in zip(pdf["path"].tolist(), pdf["first"].tolist(), pdf["end"].tolist(), strict=True):
                out = []
                for raw in read_records(path, first, end):
                    h, payload = parse_record(raw)
                    response = h["WARC-Type"] == "response"
                    n = len(payload) if response else int(h["WARC-Payload-Length"])
                    sha = digest(payload) if response else h["WARC-Payload-Digest"].removeprefix("sha1:")
                    out.append((h["WARC-Page-ID"] or None, h["WARC-Target-URI"], n, sha, h["WARC-Type"], h.get("WARC-Refers-To-Page"), payload))
                    if len(out) == 500:
                        yield _rows(out)
                        out = []
                if out:
                    yield _rows(out)

    read = pieces.mapInPandas(run, "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary")
    return read.withColumns({"page_id": F.col("page_id").cast("long"), "refers_to": F.col("refers_to").cast("long")})


def _rows(out: list) -> pd.DataFrame:
    return pd.DataFrame(out, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_revisits(table(spark, sf_dir, "pages"), "page_id", "html", "url")
    archives = write_archives(rows, f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}")
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
