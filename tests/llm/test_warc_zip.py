"""Packages written and read back, and ZIP directories written by hand."""

import base64
import hashlib
import io
import json
import struct
import zipfile

import pytest

from quillrank.llm import warc_zip as z

SF = "/root/testdata/sf0.01"


def package(raw: bytes) -> z.Package:
    return z.Package(lambda offset, length: raw[offset : offset + length], len(raw))


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def brute(rows, least=0):
    best = {}
    for i, _, t in rows:
        if i is not None and len((t or "").encode()) >= least:
            best[t or ""] = max(i, best.get(t or "", i))
    out = []
    for i, _, t in rows:
        b = best.get(t or "")
        revisit = i is not None and b is not None and i < b
        out.append((i, len((t or "").encode()), digest(t), "revisit" if revisit else "response", b if revisit else None))
    return sorted(out, key=str)


ODD = [(1, "http://a/ü x\r\nWARC-Type: evil", "same"), (2, None, "same"), (2, "u", "same"), (None, "u", "same"), (3, "u", None), (4, "u", ""), (5, "u", "é" * 5),
       (6, "u", "x" * 300_000), (7, "u", "WARC/1.1\r\n\r\nfoo"), (9, "u", "PK\5\6"), (8, "u", "x" * 300_000)]


@pytest.mark.parametrize("least", [0, 5])
def test_odd_pages(spark, least, monkeypatch):
    pages = spark.createDataFrame([(*r, "x", 1) for r in ODD], "page_id long, url string, html string, sha string, best long")
    got = sorted(map(tuple, z.read_packages(z.write_packages(pages, least)).collect()), key=str)
    assert got == brute(ODD, least)
    none = z.write_packages(pages.where("false"))
    assert none.count() == 0 and z.read_packages(none).count() == 0


def test_table_round_trip_and_several_packages(spark, monkeypatch):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    manifest = z.write_packages(pages)
    got = sorted(map(tuple, z.read_packages(manifest).collect()), key=str)
    assert got == brute([(r.page_id, r.url, r.html) for r in pages.collect()])
    assert sum(r.records for r in manifest.collect()) == len(got)
    # a public reader sees stored members, and each index entry is one gzip member
    path = manifest.first()["path"]
    fs, inner = z.open_fs(path)
    raw = fs.open_input_file(inner).readall()
    with zipfile.ZipFile(io.BytesIO(raw)) as f:
        assert {i.filename for i in f.infolist()} == {z.WARC_MEMBER, z.INDEX_MEMBER} and all(i.compress_type == 0 for i in f.infolist()) and f.testzip() is None
        warc, index = f.read(z.WARC_MEMBER), f.read(z.INDEX_MEMBER).decode().splitlines()
    import gzip

    for line in index[:20]:
        e = json.loads(line.split(" ", 2)[2])
        assert gzip.decompress(warc[e["offset"] : e["offset"] + e["length"]]).startswith(b"WARC/1.1\r\n")


def test_reads_ranges_only():
    buf, asked = io.BytesIO(), []
    with zipfile.ZipFile(buf, "w") as f:
        f.writestr(z.WARC_MEMBER, b"x" * 3_000_000)
        f.writestr(z.INDEX_MEMBER, b'1 d {"filename": "data.warc.gz", "offset": 5, "length": 7}\n')
    raw = buf.getvalue()

    def read(offset, length):
        asked.append(length)
        return raw[offset : offset + length]

    p = z.Package(read, len(raw))
    (start, length), = z.index_entries(p)
    assert raw[start - 5 : start + length] == b"x" * 12 and start - 5 == p.start(p.members[z.WARC_MEMBER])
    assert sum(asked) < 70_000


def zip64(members: dict[str, bytes], comment: bytes = b"", filler: bytes = b"") -> bytes:
    """A package whose every size and offset is in its ZIP64 fields."""
    out, central = bytearray(filler), b""
    for name, data in members.items():
        at, n = len(out), name.encode()
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data))
        out += z.LOCAL + struct.pack("<HHHHHIIIHH", 45, 0x800, 0, 0, 0, 0, z.FULL32, z.FULL32, len(n), len(extra)) + n + extra + data
        extra = struct.pack("<HHI", 0x9999, 4, 7) + struct.pack("<HHQQQ", 1, 24, len(data), len(data), at)
        central += z.CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0x800, 0, 0, 0, 0, z.FULL32, z.FULL32, len(n), len(extra), 0, 0, 0, 0, z.FULL32) + n + extra
    start = len(out)
    out += central
    end = len(out)
    out += z.EOCD64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, len(members), len(members), len(central), start)
    out += z.LOCATOR64 + struct.pack("<IQI", 0, end, 1)
    out += z.EOCD + struct.pack("<HHHHIIH", 0, 0, z.FULL16, z.FULL16, z.FULL32, z.FULL32, len(comment)) + comment
    return bytes(out)


@pytest.mark.parametrize("comment", [b"", b"a comment with PK\5\6 inside" + b"." * 40])
def test_zip64_directories(comment):
    raw = z.record(5, "http://x", b"payload", z.base32_sha1(b"payload"), None)
    entry = json.dumps({"filename": "data.warc.gz", "offset": 3, "length": len(raw)})
    p = package(zip64({z.WARC_MEMBER: b"abc" + raw, z.INDEX_MEMBER: f"5 d {entry}\n".encode()}, comment, b"leading bytes"))
    (start, length), = z.index_entries(p)
    assert z.parse_record(p.read(start, length)) == (5, 7, z.base32_sha1(b"payload"), "response", None)


def test_broken_packages_are_refused():
    with pytest.raises(ValueError):
        package(b"not a zip at all")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as f:
        f.writestr(z.WARC_MEMBER, b"x" * 100)
    p = package(buf.getvalue())
    with pytest.raises(ValueError, match="not stored"):
        p.start(p.members[z.WARC_MEMBER])
    with pytest.raises(ValueError, match="differs"):
        z.parse_record(z.record(1, "u", b"abc", "WRONG", None))


# ------------------------------------------------------------------ packages of other writers
def warc(kind, ident, block, more=(), zipped=True):
    import gzip

    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{ident}>", *more, f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw) if zipped else raw


CHUNKED = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5;x=1\r\nhello\r\n6\r\n world\r\n0\r\n\r\n"
FOREIGN = [
    ("warcinfo", "urn:uuid:1", b"software: other/1.0\r\n", ()),
    ("request", "urn:uuid:2", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", ("WARC-Target-URI: http://a/",)),
    ("response", "urn:uuid:3", CHUNKED, ("WARC-Target-URI: http://a/", f"WARC-Payload-Digest: sha1:{digest('hello world')}")),
    ("response", "urn:uuid:4", b"HTTP/1.0 200 OK\r\n\r\nno length", ()),
    ("resource", "urn:uuid:5", b"a file", ("WARC-Payload-Digest: sha256:abc",)),
    ("revisit", "urn:uuid:6", b"HTTP/1.1 304 Not Modified\r\n\r\n", ("WARC-Refers-To: <urn:uuid:3>", f"WARC-Payload-Digest: sha1:{digest('hello world')}")),
    ("response", "urn:uuid:7", b"HTTP/1.1 200 OK\r\nContent-Length: 99\r\n\r\ncut", ("WARC-Truncated: length", f"WARC-Payload-Digest: sha1:{digest('cut')}")),
    ("response", "urn:uuid:8", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\ndecoded already\r\n", ()),
]
READ = [("urn:uuid:1", "warcinfo", 21, digest("software: other/1.0\r\n"), None), ("urn:uuid:2", "request", 27, digest("GET / HTTP/1.1\r\nHost: a\r\n\r\n"), None),
        ("urn:uuid:3", "response", 11, digest("hello world"), None), ("urn:uuid:4", "response", 9, digest("no length"), None), ("urn:uuid:5", "resource", 6, digest("a file"), None),
        ("urn:uuid:6", "revisit", None, digest("hello world"), "urn:uuid:3"), ("urn:uuid:7", "response", 3, digest("cut"), None), ("urn:uuid:8", "response", 17, digest("decoded already\r\n"), None)]


def foreign(path, index, zipped=True, deflated=False):
    """A package of another writer; ``index``: name and how its entries are written."""
    import gzip

    body, places = b"", []
    for kind, ident, block, more in FOREIGN:
        raw = warc(kind, ident, block, more, zipped)
        places.append((len(body), len(raw)))
        body += raw
    name = "data.warc.gz" if zipped else "data.warc"
    if "cdxj" in index or index.endswith("cdx.gz"):
        lines = [f'com,a)/ 2020 {json.dumps({"filename": name, "offset": str(o), "length": str(n)})}\n' for o, n in places]
    else:
        lines = [" CDX N b S V g\n", *[f"com,a)/ 2020 {n} {o} {name}\n" for o, n in places]]
    data = "".join(lines).encode()
    if index.endswith(".gz"):  # blocks that are gzip members of their own
        half = len("".join(lines[:3]))
        data = gzip.compress(data[:half]) + gzip.compress(data[half:])
    with zipfile.ZipFile(path, "w") as f:
        f.writestr("datapackage.json", "{}", zipfile.ZIP_DEFLATED)
        f.writestr(f"archive/{name}", body)
        f.writestr(f"indexes/{index}", data, zipfile.ZIP_DEFLATED if deflated else zipfile.ZIP_STORED)
        if index.endswith(".gz"):
            f.writestr("indexes/index.idx", "com,a)/ 2020\tindex.cdx.gz\t0\t10\t1\n")
    return f"file://{path}"


@pytest.mark.parametrize("index,zipped,deflated", [("index.cdx.gz", True, False), ("index.cdxj", False, True), ("index.cdx", True, False), ("index.cdxj.gz", True, False)])
def test_packages_of_other_writers(spark, tmp_path, index, zipped, deflated):
    path = foreign(tmp_path / "a.wacz", index, zipped, deflated)
    manifest = spark.createDataFrame([(path,), (path,), (None,)], "path string")
    got = sorted((r.record_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to) for r in z.read_records(manifest).collect())
    assert got == READ
    assert z.read_packages(manifest).count() == 0  # none of these is a page of this writer


def test_what_is_not_understood_is_refused(tmp_path):
    def package_of(members):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as f:
            for name, data in members.items():
                f.writestr(name, data)
        return package(buf.getvalue())

    for members, why in (({"archive/data.warc.gz": b"x"}, "without an index"), ({"indexes/index.db": b"x"}, "known form"), ({"indexes/index.cdx": b"a b c\n"}, "known form"),
                         ({"indexes/index.cdxj": b'a b {"filename": "gone.warc.gz", "offset": 0, "length": 1}\n'}, "not in the package")):
        with pytest.raises(ValueError, match=why):
            z.index_entries(package_of(members))
    assert z.index_entries(package_of({})) == []
    with pytest.raises(ValueError, match="not a WARC"):
        z.read_record(b"GET /")
    with pytest.raises(ValueError, match="differs"):
        z.read_record(warc("response", "urn:uuid:9", CHUNKED, (f"WARC-Payload-Digest: sha1:{digest('other')}",)))


def test_as_many_read_tasks_as_stretches(spark, monkeypatch, tmp_path):
    """Small index entries of many packages are not put into a few tasks."""
    monkeypatch.setattr(z, "PACKAGE_BYTES", 4000)
    pages = spark.range(400).selectExpr("id AS page_id", "'u' AS url", "concat(sha2(cast(id AS string), 512), repeat(sha2(cast(-id AS string), 512), 3)) AS html").repartition(4)
    manifest = z.write_packages(pages)
    stretch = 2000
    rows = z.read_records(manifest, stretch)
    seen = rows.selectExpr("spark_partition_id() AS p", "path", f"start div {stretch} AS s").distinct().collect()
    stretches = {(r.path, r.s) for r in seen}
    assert len(stretches) > 30 and rows.count() == 400
    tasks = {}
    for r in seen:
        tasks.setdefault(r.p, set()).add((r.path, r.s))
    assert len(tasks) > 0.9 * len(stretches) and sum(map(len, tasks.values())) == len(stretches)  # none is cut in two
    monkeypatch.setattr(z, "READ_TASKS", 3)
    assert z.read_packages(manifest, stretch).count() == 400
