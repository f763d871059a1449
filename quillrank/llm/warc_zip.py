"""WARC records in ZIP packages: a distributed writer and a range-reading reader.

A package holds stored (uncompressed) members, as web-archive packages do:
``archive/data.warc.gz`` with one gzip member per record, and
``indexes/index.cdxj`` with the place of every record in it. The reader parses
the end-of-central-directory record, its ZIP64 form and the central
directory, finds where the stored members' bytes begin, and fetches single
records by range; a package is never extracted or read whole.

Writing: pages of equal payload are found by a two-phase aggregate over the
payload's SHA-1; each task writes its rows to packages of about
``PACKAGE_BYTES`` in the shared folder, under a name no other attempt has, and
only packages in the written manifest are ever read. Reading: index entries
are dealt out by stretches of ``STRETCH`` bytes (more where there would be over
``READ_TASKS`` of them), one task for each, so a package of any size is read by
many tasks and many packages by as many.

Packages of other writers are read too: indexes as CDXJ or as CDX with a header
line, plain, gzipped or deflated in the package, and records of every type, with
any record id, plain or gzipped, chunked payloads included. What is not
understood (an index of another form, a package without one, archive members
that are compressed as a whole) raises ``ValueError``; nothing is passed over.

Executors open packages through ``pyarrow.fs``, so the shared folder must be in
a file system it knows (local or NFS, S3, GCS, Azure, HDFS with libhdfs).
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm.common import Scratch

PACKAGE_BYTES, STRETCH, READ_TASKS = 32 << 20, 8 << 20, 20_000
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
RECORD_ID = "urn:quillrank:page:"
DATE = "2026-01-01T00:00:00Z"
#: Fixed values of the ZIP format.
EOCD, EOCD64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path of a URI as Hadoop writes it (``file:/x`` included) or of a local path."""
    m = re.match(r"file:/+(.*)", path)
    return (pafs.LocalFileSystem(), f"/{m[1]}") if m else pafs.FileSystem.from_uri(path)


# ------------------------------------------------------------------ ZIP
@dataclass
class Member:
    name: str
    method: int
    size: int
    header: int


class Package:
    """Directory of one ZIP package; ``read(offset, length)`` is its only access to the bytes."""

    def __init__(self, read, size: int):
        self.read = read
        at, count, length, start = self._end(size)
        directory = read(start, length)
        self.members: dict[str, Member] = {}
        p = 0
        for _ in range(count):
            if directory[p : p + 4] != CENTRAL:
                raise ValueError("central directory entry expected")
            flags, method = struct.unpack_from("<HH", directory, p + 8)
            packed, plain, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", directory, p + 20)
            (header,) = struct.unpack_from("<I", directory, p + 42)
            name = directory[p + 46 : p + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = directory[p + 46 + n_name : p + 46 + n_name + n_extra]
            packed, plain, header = self._wide(extra, packed, plain, header)
            self.members[name] = Member(name, method, packed, header)
            p += 46 + n_name + n_extra + n_note

    def _end(self, size: int) -> tuple[int, int, int, int]:
        """Place of the end record; entries, length and start of the directory."""
        tail_at = max(0, size - 22 - FULL16)
        tail = self.read(tail_at, size - tail_at)
        at = tail.rfind(EOCD)
        while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(EOCD, 0, at)  # its four bytes may stand in the comment
        if at < 0:
            raise ValueError("no end of central directory")
        count, length, start = struct.unpack_from("<HII", tail, at + 10)
        place = tail_at + at
        if FULL16 == count or FULL32 in (length, start):
            if place >= 20 and (locator := self.read(place - 20, 20))[:4] == LOCATOR64:
                (at64,) = struct.unpack_from("<Q", locator, 8)
                record = self.read(at64, 56)
                if record[:4] != EOCD64:
                    raise ValueError("ZIP64 end record expected")
                count, length, start = struct.unpack_from("<QQQ", record, 32)
        return place, count, length, start

    @staticmethod
    def _wide(extra: bytes, packed: int, plain: int, header: int) -> tuple[int, int, int]:
        """Sizes and offset from the ZIP64 extra field where the 32-bit ones are full."""
        p = 0
        while p + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, p)
            if kind == 1:
                q, values = p + 4, []
                for v in (plain, packed, header):
                    if v == FULL32:
                        (v,) = struct.unpack_from("<Q", extra, q)
                        q += 8
                    values.append(v)
                plain, packed, header = values
            p += 4 + n
        return packed, plain, header

    def start(self, member: Member) -> int:
        """Where a stored member's bytes begin."""
        if member.method != 0:
            raise ValueError(f"{member.name} is not stored")
        return self.place(member)

    def place(self, member: Member) -> int:
        """Where a member's bytes begin (its local header has lengths of its own)."""
        head = self.read(member.header, 30)
        if head[:4] != LOCAL:
            raise ValueError("local header expected")
        n_name, n_extra = struct.unpack_from("<HH", head, 26)
        return member.header + 30 + n_name + n_extra


def open_package(path: str) -> tuple[Package, pa.NativeFile]:
    fs, inner = open_fs(path)
    f = fs.open_input_file(inner)
    return Package(lambda offset, length: bytes(f.read_at(length, offset)), f.size()), f


def _index_lines(package: Package, member: Member) -> list[bytes]:
    """An index's lines; it may be gzipped, in one or more gzip members, and deflated in the package."""
    raw = package.read(package.place(member), member.size)
    if member.method == 8:
        raw = zlib.decompress(raw, -15)
    elif member.method:
        raise ValueError(f"{member.name} is compressed by method {member.method}")
    if raw[:2] == b"\x1f\x8b":
        out = []
        while raw:
            z = zlib.decompressobj(31)
            out.append(z.decompress(raw) + z.flush())
            raw = z.unused_data
        raw = b"".join(out)
    return raw.splitlines()


def _places(name: str, lines: list[bytes]) -> list[tuple[str, int, int]]:
    """``(archive file, offset, length)`` of the records that an index lists."""
    out, fields = [], None
    for line in lines:
        if not line.strip() or line.startswith(b"!"):
            continue
        if line.startswith(b" CDX "):
            fields = {letter: i for i, letter in enumerate(line.split()[1:])}
            continue
        parts = line.split(b" ", 2)
        if len(parts) == 3 and parts[2].lstrip().startswith(b"{"):
            entry = json.loads(parts[2])
            out.append((entry["filename"], int(entry["offset"]), int(entry["length"])))
        elif fields and {b"g", b"V", b"S"} <= fields.keys():
            parts = line.split(b" ")
            out.append((parts[fields[b"g"]].decode(), int(parts[fields[b"V"]]), int(parts[fields[b"S"]])))
        else:
            raise ValueError(f"{name} is no index of a known form")
    return out


def index_entries(package: Package) -> list[tuple[int, int]]:
    """Absolute ``(start, length)`` of every record that the package's indexes list, each once.

    A ``.idx`` file only says where the blocks of a gzipped index begin; the index itself is read.
    """
    out, seen = {}, False
    for name, member in package.members.items():
        if not name.startswith("indexes/") or name.endswith(("/", ".idx")):
            continue
        if not re.search(r"\.cdxj?(\.gz)?$", name):
            raise ValueError(f"{name} is no index of a known form")
        seen = True
        for file, offset, length in _places(name, _index_lines(package, member)):
            warc = package.members.get(file if file.startswith("archive/") else f"archive/{file}")
            if warc is None:
                raise ValueError(f"{name} lists {file}, which is not in the package")
            out[package.start(warc) + offset, length] = None
    if not seen and any(n.startswith("archive/") and not n.endswith("/") for n in package.members):
        raise ValueError("a package without an index")
    return list(out)


# ------------------------------------------------------------------ WARC
def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record, gzipped: a response, or a revisit of ``refers_to`` where that is not None."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{RECORD_ID}{'' if page_id is None else page_id}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    if url:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~.-_')}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{RECORD_ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n") + z.compress(body) + z.compress(b"\r\n\r\n") + z.flush()


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


@dataclass
class Record:
    """What a WARC record says; payload length and digest are None where it has neither payload nor header."""

    id: str
    type: str
    url: str | None
    payload_bytes: int | None
    digest: str | None
    refers_to: str | None


def _dechunked(body: bytes) -> bytes:
    """An HTTP body of chunks put together; a body that is cut short ends where it does."""
    out, p = [], 0
    while (end := body.find(b"\r\n", p)) >= 0:
        try:
            n = int(body[p:end].split(b";")[0], 16)
        except ValueError:
            return body  # as some crawlers write it: decoded already, with the header left
        if not n:
            break
        out.append(body[end + 2 : end + 2 + n])
        p = end + 2 + n + 2
    return b"".join(out)


def read_record(raw: bytes) -> Record:
    """One record, gzipped or plain.

    The payload of a response is its HTTP body (chunks put together, content
    encodings left as they are), of any other record its whole block; its length
    and SHA-1 are taken from the bytes, and a digest in the header must agree.
    A revisit has them in its headers only.
    """
    data = zlib.decompress(raw, 31) if raw[:2] == b"\x1f\x8b" else raw
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    warc = _headers(head)
    block, kind = rest[: int(warc["content-length"])], warc["warc-type"]
    ident, url, said = warc.get("warc-record-id", "").strip("<>"), warc.get("warc-target-uri"), warc.get("warc-payload-digest")
    of = warc.get("warc-refers-to")
    said = said.removeprefix("sha1:") if said else None
    http, _, body = block.partition(b"\r\n\r\n")
    over_http = block.startswith(b"HTTP/")
    length = _headers(http).get("content-length") if over_http else None
    if kind == "revisit":
        return Record(ident, kind, url, int(length) if length and length.isdigit() else None, said, of.strip("<>") if of else None)
    payload = body if kind == "response" and over_http else block
    if kind == "response" and over_http and _headers(http).get("transfer-encoding", "").lower() == "chunked":
        payload, length = _dechunked(body), None
    digest = base32_sha1(payload)
    # a payload that the crawler cut short is shorter than the header says, which its own field tells
    if said and ":" not in said and (said.upper() != digest or kind == "response" and length is not None and "warc-truncated" not in warc and int(length) != len(payload)):
        raise ValueError(f"payload of {ident} differs from its digest")
    return Record(ident, kind, url, len(payload), digest, of.strip("<>") if of else None)


def _page(ident: str | None) -> int | None:
    """The page of a record id that this writer gave."""
    return int(ident.removeprefix(RECORD_ID)) if ident and ident.startswith(RECORD_ID) and ident != RECORD_ID else None


def parse_record(raw: bytes) -> tuple:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of one record of :func:`write_packages`."""
    r = read_record(raw)
    return _page(r.id), r.payload_bytes, r.digest, r.type, _page(r.refers_to)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ------------------------------------------------------------------ Spark
def _write(root: str):
    def run(batches):
        fs, inner = open_fs(root)
        fs.create_dir(inner, recursive=True)
        task = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}"
        made, open_zip = 0, None

        def close():
            stream, z, warc, name, index, _ = open_zip
            warc.close()
            z.writestr(INDEX_MEMBER, "".join(index))
            z.close()
            stream.close()
            return pa.RecordBatch.from_pydict({"path": [f"{root}/{name}"], "records": [len(index)]}, pa.schema([("path", pa.string()), ("records", pa.int64())]))

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(i) for i in range(4))):
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                page_id, url, refers_to = page_id.as_py(), url.as_py(), refers_to.as_py()
                digest = base32_sha1(payload)
                raw = record(page_id, url, payload, digest, refers_to)
                if open_zip is None:
                    name = f"{task}-{made:04d}.wacz"
                    made += 1
                    stream = fs.open_output_stream(f"{inner}/{name}")
                    z = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED)
                    open_zip = [stream, z, z.open(zipfile.ZipInfo(WARC_MEMBER), "w", force_zip64=True), name, [], 0]
                entry = {"url": url or "", "digest": f"sha1:{digest}", "filename": WARC_MEMBER.rpartition("/")[2], "offset": open_zip[5], "length": len(raw)}
                open_zip[2].write(raw)
                open_zip[4].append(f"{page_id} {DATE} {json.dumps(entry)}\n")
                open_zip[5] += len(raw)
                if open_zip[5] >= PACKAGE_BYTES:
                    yield close()
                    open_zip = None
        if open_zip:
            yield close()

    return run


def write_packages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as packages; returns the manifest ``(path, records)``.

    A null html is an empty payload. Among pages of equal payloads of at least
    ``least_bytes`` bytes, the one of the largest page_id is a response and the
    others revisit it; a row without an id is always a response, as are rows
    that repeat the largest id. A null url leaves the target out. Other columns
    are ignored; an empty table gives no package.
    """
    scratch = Scratch(pages.sparkSession, "warc-zip")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    pages = pages.withColumn("sha", F.unhex(F.sha1("html")))
    same = pages.where(F.octet_length("html") >= least_bytes).groupBy("sha").agg(F.max("page_id").alias("best"), F.count("*").alias("n")).where("n > 1").select("sha", "best")
    refers = F.when((F.octet_length("html") >= least_bytes) & (F.col("page_id") < F.col("best")), F.col("best"))
    rows = pages.join(same, "sha", "left").select("page_id", "url", "html", refers.alias("refers_to"))
    return scratch.save(rows.mapInArrow(_write(f"{scratch.root}/packages"), "path string, records long"), "manifest")


def _entries(batches):
    for batch in batches:
        for path in batch.column(0).to_pylist():
            package, f = open_package(path)
            with f:
                entries = index_entries(package)
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(entries), pa.string()), pa.array([s for s, _ in entries], pa.int64()), pa.array([n for _, n in entries], pa.int64())],
                                             ["path", "start", "length"])


RECORDS = "path string, start long, record_id string, record_type string, target_uri string, payload_bytes long, payload_digest string, refers_to string"
_RECORDS = pa.schema([(x.split()[0], pa.int64() if x.endswith("long") else pa.string()) for x in RECORDS.split(", ")])


def _read(batches):
    path, f = None, None
    for batch in batches:
        rows = []
        for p, start, length in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("path", "start", "length"))):
            if p != path:
                if f:
                    f.close()
                fs, inner = open_fs(p)
                path, f = p, fs.open_input_file(inner)
            r = read_record(bytes(f.read_at(length, start)))
            rows.append((p, start, r.id, r.type, r.url, r.payload_bytes, r.digest, r.refers_to))
        cols = list(zip(*rows)) if rows else [[]] * len(_RECORDS)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, _RECORDS.types)], _RECORDS.names)
    if f:
        f.close()


def read_records(manifest: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Every record that the indexes of the packages at ``path`` list, of any type and writer: ``RECORDS``.

    Null paths are none, and a path that is there twice is read once. An empty manifest gives no rows.
    """
    scratch = Scratch(manifest.sparkSession, "warc-read")
    paths = manifest.select("path").where("path IS NOT NULL").distinct()
    entries = scratch.save(paths.mapInArrow(_entries, "path string, start long, length long"), "entries")
    total = entries.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    stretch = max(stretch, -(-total // READ_TASKS))
    of = F.call_function("div", F.col("start"), F.lit(stretch))
    tasks = entries.select("path", of.alias("stretch")).distinct().count()
    # a partition number that is given is not coalesced, however small the entries are
    dealt = entries.withColumn("stretch", of).repartitionByRange(max(1, tasks), "path", "stretch").sortWithinPartitions("path", "start")
    return dealt.mapInArrow(_read, RECORDS)


def read_packages(manifest: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """The pages that :func:`write_packages` wrote: ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``."""
    def page(c: str):
        return F.expr(f"try_cast(substr({c}, {len(RECORD_ID) + 1}) AS long)")

    own = read_records(manifest, stretch).where(F.col("record_id").startswith(RECORD_ID))
    return own.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))
