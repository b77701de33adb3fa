"""Web archives packaged in ZIP files: stored members, an index of records, and range reads.

A package holds ``archive/data.warc.gz`` (one gzip member per record) and ``indexes/index.cdxj``
(one line per record: url, offset, length), both *stored*, so a record's bytes lie at a known place of
the package. The reader finds the central directory from the end of the file, through the ZIP64
records where there are any, locates the two members, and reads runs of records by range. Nothing is
extracted.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalith.llm.common import hot_among, new_folder, settled, ship_package
from stratalith.operators.joins import spread_join

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# Payloads below this are never replaced by a revisit.
LEAST_BYTES = 1000
# Bytes of records that one task reads at a time, and of index lines.
RUN_BYTES = 4 << 20

# Fixed values of the ZIP format: signatures and record layouts.
END, END64_AT, END64, ENTRY, LOCAL = b"PK\5\6", b"PK\6\7", b"PK\6\6", b"PK\1\2", b"PK\3\4"
_END = struct.Struct("<4s4H2LH")
_END64_AT = struct.Struct("<4sLQL")
_END64 = struct.Struct("<4sQ2H2L4Q")
_ENTRY = struct.Struct("<4s6H3L5H2L")
_LOCAL = struct.Struct("<4s5H3L2H")


class Member(NamedTuple):
    name: str
    method: int
    header_at: int
    packed: int
    size: int


def directory(read, size: int) -> list[Member]:
    """The central directory of a ZIP file of ``size`` bytes; ``read(length, offset)`` reads a range."""
    tail_at = max(0, size - (1 << 16) - _END.size)
    tail = read(size - tail_at, tail_at)
    at = tail.rfind(END)
    # A comment may hold the signature; the record that reaches the end is the right one.
    while at >= 0 and (at + _END.size > len(tail) or at + _END.size + _END.unpack_from(tail, at)[7] != len(tail)):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP file")
    _, _, _, _, count, length, start, _ = _END.unpack_from(tail, at)
    end_at = tail_at + at
    if end_at >= _END64_AT.size:
        signature, _, end64_at, _ = _END64_AT.unpack(read(_END64_AT.size, end_at - _END64_AT.size))
        if signature == END64_AT:
            signature, _, _, _, _, _, _, count, length, start = _END64.unpack(read(_END64.size, end64_at))
            if signature != END64:
                raise ValueError("the ZIP64 end record is not where it should be")
    entries, members, at = read(length, start), [], 0
    for _ in range(count):
        signature, _, _, _, method, _, _, _, packed, plain, n, n_extra, n_comment, _, _, _, header_at = _ENTRY.unpack_from(entries, at)
        if signature != ENTRY:
            raise ValueError("the central directory is damaged")
        at += _ENTRY.size
        name, extra = entries[at : at + n].decode(), entries[at + n : at + n + n_extra]
        at += n + n_extra + n_comment
        while len(extra) >= 4:
            kind, length = struct.unpack_from("<2H", extra)
            if kind == 1:
                # Only the fields that do not fit above are here, in this order.
                wide = list(struct.unpack_from(f"<{length // 8}Q", extra, 4))
                plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                header_at = wide.pop(0) if header_at == 0xFFFFFFFF else header_at
            extra = extra[4 + length :]
        members.append(Member(name, method, header_at, packed, plain))
    return members


def place_of(read, member: Member) -> int:
    """Where the bytes of a stored member begin; its local header may be longer than its entry tells."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed; only stored members can be read by range")
    signature, *_, n, n_extra = _LOCAL.unpack(read(_LOCAL.size, member.header_at))
    if signature != LOCAL:
        raise ValueError(f"{member.name} has no local header")
    return member.header_at + _LOCAL.size + n + n_extra


class Package:
    """A ZIP package that is opened by range reads."""

    def __init__(self, uri: str):
        files, path = pa.fs.FileSystem.from_uri(uri)
        self.file = files.open_input_file(path)
        self.read = self.file.read_at
        self.members = {m.name: m for m in directory(self.read, self.file.size())}

    def index(self, name: str = INDEX) -> Iterator[dict]:
        """The lines of the index, RUN_BYTES at a time."""
        member = self.members[name]
        start, left, rest = place_of(self.read, member), member.size, b""
        while left:
            block = self.read(min(left, RUN_BYTES), start)
            start, left = start + len(block), left - len(block)
            *lines, rest = (rest + block).split(b"\n")
            for line in lines:
                yield json.loads(line[line.index(b"{") :])


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """The named fields (lower case) and the block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return fields, rest[: int(fields["content-length"])]


def record_at(data: memoryview, at: int, length: int) -> bytes:
    """The gzip member of ``length`` bytes at a place of a run of records."""
    unpack = zlib.decompressobj(31)
    record = unpack.decompress(data[at : at + length]) + unpack.flush()
    if not unpack.eof or unpack.unused_data:
        raise ValueError("the index does not fit the records")
    return record


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    return int(number) if (number := urn.removeprefix("<urn:page:").removesuffix(">")) else None


def page_record(page_id: int | None, url: str | None, html: str, refers_to: int | None) -> bytes:
    """A response, or a revisit of the response of page ``refers_to``; both tell length and digest of the whole payload."""
    payload = html.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        # A header is one line: what would end it is percent-coded.
        ("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _urn(refers_to))]
    return record_bytes(headers, block)


class PackageWriter:
    """Writes under a name of its own and renames at the end, so a repeated task leaves one whole package."""

    def __init__(self, folder: str, name: str):
        self.files, base = pa.fs.FileSystem.from_uri(folder)
        self.part, self.path = f"{base}/.{name}-{uuid.uuid4().hex}", f"{base}/{name}"
        self.out = self.files.open_output_stream(self.part)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.lines: list[bytes] = []
        self.at = 0

    def add(self, url: str | None, record: bytes) -> None:
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        data = pack.compress(record) + pack.flush()
        self.member.write(data)
        self.lines.append(json.dumps({"url": url, "offset": self.at, "length": len(data)}).encode())
        self.at += len(data)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), b"".join(b"page " + x + b"\n" for x in self.lines))
        self.zip.close()
        self.out.close()
        self.files.move(self.part, self.path)


def write_packages(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> tuple[str, list[str]]:
    """One record per page into packages of ``folder``, one package per partition; gives folder and names.

    Among pages with equal payloads of at least LEAST_BYTES, the one with the largest id is the response
    and the others revisit it (rows that repeat that id are responses too); all others are responses.
    Null payloads are empty, null urls too. Pages without an id never are the response that others
    refer to; where no page of a group has an id, all are responses. A payload is held whole by its task, however
    long; a frequent one is spread over the packages. Other columns are ignored; an empty table gives no packages.
    """
    spark = pages.sparkSession
    ship_package(spark)
    folder = folder or new_folder(spark, "warc-packages")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    payload = F.encode("html", "utf-8")
    is_long = F.octet_length("html") >= LEAST_BYTES
    long = rows.where(is_long).withColumn("digest", F.sha1(payload))
    # Only ids and digests are shuffled to find the groups, with partial aggregation; short pages are not joined at all.
    chief = settled(long.groupBy("digest").agg(F.max("page_id").alias("chief"), F.count(F.lit(1)).alias("n")).where("n > 1"), "chiefs")
    # Pages of a frequent payload are dealt to all tasks by id and address, so none of them gets them all.
    placed = long.withColumn("__row", F.xxhash64("page_id", "url"))
    told = spread_join(placed, chief.select("digest", "chief"), "digest", "left", row_id="__row", hot=hot_among(chief, "digest")).drop("digest", "__row")
    told = told.union(rows.where(~is_long).withColumn("chief", F.lit(None).cast("long")))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("chief")), F.col("chief"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, name = None, f"part-{TaskContext.get().partitionId():06d}.wacz"
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(k) for k in range(4))):
                writer = writer or PackageWriter(folder, name)
                writer.add(url.as_py(), page_record(page_id.as_py(), url.as_py(), html.as_py(), refers_to.as_py()))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"name": [name]})

    names = told.select("page_id", "url", "html", refers.alias("refers_to")).mapInArrow(write, "name string").collect()
    return folder, sorted(r[0] for r in names)


def read_packages(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` of every record.

    First the indexes are read and cut to runs of about RUN_BYTES, so a large package is read by many
    tasks; then each run is one range read, in which the lengths of the index tell where each record lies. A record whose
    bytes do not fit its digest, length or place fails the job. No packages give no rows.
    """
    ship_package(spark)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                package = Package(f"{folder}/{name}")
                base = place_of(package.read, package.members[DATA])
                first = last = 0
                lengths: list[int] = []
                for line in package.index():
                    if lengths and (line["offset"] != last or last - first >= RUN_BYTES):
                        yield _run(name, base + first, lengths)
                        lengths = []
                    first = first if lengths else line["offset"]
                    lengths.append(line["length"])
                    last = line["offset"] + line["length"]
                if lengths:
                    yield _run(name, base + first, lengths)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, offset, lengths in zip(*(batch.column(k).to_pylist() for k in range(3))):
                files, path = pa.fs.FileSystem.from_uri(f"{folder}/{name}")
                with files.open_input_file(path) as file:
                    data = memoryview(file.read_at(sum(lengths), offset))
                out, at = [], 0
                for length in lengths:
                    out.append(_described(record_at(data, at, length), name))
                    at += length
                types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    packages = spark.createDataFrame([(n,) for n in names], "name string").repartition(max(1, len(names)), "name")
    found = packages.mapInArrow(runs, "name string, offset long, lengths array<long>")
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), len(names))
    return found.repartition(width, "name", "offset").mapInArrow(
        read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def _run(name: str, offset: int, lengths: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([offset], pa.int64()), pa.array([lengths], pa.list_(pa.int64()))], ["name", "offset", "lengths"])


def _described(record: bytes, name: str) -> tuple:
    """A row of :func:`read_packages` from a record, whose payload is tested."""
    fields, block = parse_record(record)
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    size = next(int(x[15:]) for x in head.decode().split("\r\n") if x.lower().startswith("content-length:"))
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['warc-record-id']} of {name} is damaged")
    refers = fields.get("warc-refers-to")
    return _page(fields["warc-record-id"]), fields["warc-target-uri"], size, digest, kind, refers and _page(refers)


def archived(pages: DataFrame, **columns: str) -> DataFrame:
    """Write ``pages`` to packages and read all records back: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``.

    A row for every row of ``pages``, repeated ones too; what is a response and what a revisit tells :func:`write_packages`. Null payloads
    are empty ones, null urls come back empty. Other columns are ignored; an empty table gives no rows.
    """
    folder, names = write_packages(pages, **columns)
    return read_packages(pages.sparkSession, folder, names)
