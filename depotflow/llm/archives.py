"""Legacy web archives: ARC files written and read by their declared lengths, and converted to WARC.

An ARC file begins with a version block that says which fields its header lines have: version 1 has URL, IP address,
date, content type and length, version 2 also result code, checksum, location, offset and file name. The converter
parses lines by the version of their file and gives each record what WARC asks for and ARC lacks: an identifier, an ISO
timestamp, a type, digests. Records with equal payloads keep one response; the others become revisits of it.

Files are plain text compressed as a whole, written and read by Spark in the folder that ``spark.checkpoint.dir`` names.
Nothing but its declared length says where a record ends, so payloads may hold anything, header lines included.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from depotflow.session import frozen, shared_folder

#: Payloads below this many bytes are always responses.
LEAST = 100
#: Bytes of records after which the next file of a task begins.
FILE = 32 << 20
#: Legacy records are from one crawl, whose time is a parameter of the archive and not of the page.
CRAWLED = "20010203040506"
ADDRESS = "192.0.2.1"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
VERSIONS = {1: "1 0", 2: "2 0"}


def _shown(page: object) -> str | None:
    """A page id as a header value: ids of any type, signs that would end the line as their bytes."""
    return None if page is None else re.sub(r"[%\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", str(page))


def _read(page: str | None) -> str | None:
    return None if page is None else re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), page)


def _place(url: str | None) -> str:
    """A URL that fits a header line: white space and control characters are written by their bytes."""
    held = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    return held or "about:blank"


def arc_block(page: object, html: str | None) -> bytes:
    """An HTTP answer as ARC stores it: status, headers, empty line, payload in UTF-8."""
    body = (html or "").encode()
    known = f"X-Page: {_shown(page)}\r\n" if page is not None else ""
    return f"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n{known}Content-Length: {len(body)}\r\n\r\n".encode() + body


def arc_version(version: int, name: str) -> bytes:
    """The version block, the first record of a file, without the line feed that ends it."""
    body = f"{VERSIONS[version]} archive\n{FIELDS[version]}\n".encode()
    head = f"filedesc://{name}.arc 0.0.0.0 {CRAWLED} "
    head += f"text/plain 200 - - 0 {name}.arc " if version == 2 else "text/plain "
    return f"{head}{len(body)}\n".encode() + body


def arc_record(version: int, name: str, url: str | None, block: bytes) -> bytes:
    head = f"{_place(url)} {ADDRESS} {CRAWLED} "
    if version == 2:
        head += f"text/html 200 {hashlib.md5(block).hexdigest()} - 0 {name}.arc "
    else:
        head += "text/html "
    return f"{head}{len(block)}\n".encode() + block


def read_arc(data: bytes) -> Iterator[dict[str, str | bytes]]:
    """The records of a file, without its version block; field names are those of the version block."""
    at, names = 0, None
    while at < len(data):
        stop = data.index(b"\n", at)
        values = data[at:stop].decode().split(" ")
        begin, length = stop + 1, int(values[-1])
        block = data[begin:begin + length]
        if len(block) != length:
            raise ValueError(f"record at {at} ends before its declared length")
        if names is None:
            if not values[0].startswith("filedesc://"):
                raise ValueError("no version block")
            names = block.split(b"\n")[1].decode().split(" ")
        else:
            if len(values) != len(names):
                raise ValueError(f"header line at {at} has {len(values)} fields, its version {len(names)}")
            yield dict(zip(names, values, strict=True)) | {"block": block}
        at = begin + length + 1


def is_http(block: bytes) -> bool:
    return block.startswith(b"HTTP/")


def split_http(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields by lower-case name, the head as it is, and the payload."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, head + b"\r\n\r\n", payload


def warc_id(page: str | None, url: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page} {url} {digest}')}>"


def _stamp(date: str) -> str:
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC record without the two line ends that close it."""
    lines = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))])
    return f"WARC/1.0\r\n{lines}\r\n".encode() + block


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode().split("\r\n")
        if lines[0] != "WARC/1.0":
            raise ValueError(f"no WARC record at {at}")
        fields = {k: v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        begin = stop + 4
        length = int(fields["Content-Length"])
        if begin + length > len(data):
            raise ValueError(f"record at {at} ends before its declared length")
        yield fields, data[begin:begin + length]
        at = begin + length + 4


def _files(df: DataFrame, path: str, ends: str) -> None:
    """Write ``(file, seq, record)``: each file's records in order, each closed by ``ends``; packed fast, not small."""
    ordered = df.sortWithinPartitions("file", "seq").select("file", F.col("record").cast("string").alias("value"))
    ordered.write.partitionBy("file").option("lineSep", ends).option("compression", "gzip").option(
        "zlib.compress.level", "BEST_SPEED").text(path)


def _contents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option(
        "recursiveFileLookup", "true").load(path).select("content")


def write_arc(pages: DataFrame, path: str) -> None:
    """Write ``pages`` (page_id, url, html) as ARC files, of either version in turn.

    A null html is an empty payload, a null URL ``about:blank``; a null id is left out of the record. Repeated rows are
    repeated records. Every task begins a new file after some 32 MB, so that files stay readable in one piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, size, seq = "", FILE, 0
        for batch in batches:
            rows: list[tuple[str, int, bytes]] = []
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= FILE:
                    name, size, seq = uuid.uuid4().hex, 0, 0
                    version = 1 + int(name, 16) % 2
                    rows.append((name, 0, arc_version(version, name)))
                block = arc_block(page, html)
                seq, size = seq + 1, size + len(block)
                rows.append((name, seq, arc_record(version, name, url, block)))
                if len(rows) >= 500:
                    yield _rows(rows)
                    rows = []
            yield _rows(rows)

    _files(pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, "file string, seq long, record binary"), path, "\n")


def _rows(rows: list[tuple[str, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "file": pa.array([r[0] for r in rows], pa.string()), "seq": pa.array([r[1] for r in rows], pa.int64()),
        "record": pa.array([r[2] for r in rows], pa.binary())})


KINDS = {"page_id": pa.string(), "url": pa.string(), "date": pa.string(), "type": pa.string(), "address": pa.string(),
         "result": pa.string(), "source": pa.string(), "digest": pa.string(), "bytes": pa.int64(), "http": pa.bool_(),
         "block": pa.binary()}
RECORD = ("page_id string, url string, date string, type string, address string, result string, source string, "
          "digest string, bytes long, http boolean, block binary")


def _parse_arc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column(0):
            rows: list[tuple] = []
            for record in read_arc(zlib.decompress(packed.as_py(), wbits=31)):
                block, url, page = record["block"], record["URL"], None
                payload = block
                if is_http(block):
                    fields, _, payload = split_http(block)
                    page = _read(fields.get("x-page"))
                checksum = record.get("Checksum", "-")
                if checksum != "-" and hashlib.md5(block).hexdigest() != checksum:
                    raise ValueError(f"record of {url} does not match its checksum")
                rows.append((page, url, record["Archive-date"], record["Content-type"], record["IP-address"],
                             record.get("Result-code"), record.get("Filename"),
                             hashlib.sha256(payload).hexdigest(), len(payload), is_http(block), block))
                if len(rows) >= 500:
                    yield _records(rows)
                    rows = []
            yield _records(rows)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        name: pa.array([r[n] for r in rows], kind) for n, (name, kind) in enumerate(KINDS.items())})


def read_arcs(spark: SparkSession, path: str) -> DataFrame:
    """Records of ARC files: what their headers say, the payload's digest and length, and the block.

    A checksum that a version-2 header states must fit its block. Only HTTP answers have a head before the payload; of
    others, as of ``dns:`` records, the block is the payload.
    """
    return _contents(spark, path).mapInArrow(_parse_arc, RECORD)


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, size, seq = "", FILE, 0
    for batch in batches:
        rows: list[tuple[str, int, bytes]] = []
        for page, url, date, kind, address, result, source, digest, _, http, block, first, first_url in zip(
                *(c.to_pylist() for c in batch.columns), strict=True):
            fields = [("WARC-Record-ID", warc_id(page, url, digest)), ("WARC-Target-URI", url),
                      ("WARC-Date", _stamp(date)), ("WARC-IP-Address", address),
                      ("WARC-Payload-Digest", f"sha256:{digest}")]
            # What ARC has and WARC has no field for.
            fields += [(name, value) for name, value in (("X-ARC-Result-Code", result), ("X-ARC-File", source)) if value]
            if not http:
                fields = [("WARC-Type", "resource"), *fields, ("Content-Type", kind)]
            elif first is not None and first != page:
                block = split_http(block)[1]
                fields = [("WARC-Type", "revisit"), *fields, ("WARC-Refers-To", warc_id(first, first_url, digest)),
                          ("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")]
            else:
                fields = [("WARC-Type", "response"), *fields]
            if http:
                fields += [("Content-Type", "application/http; msgtype=response"), ("WARC-Identified-Payload-Type", kind)]
            fields += [("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}")]
            if size >= FILE:
                name, size, seq = uuid.uuid4().hex, 0, 0
                info = f"software: archive conversion\r\nconformsTo: WARC 1.0\r\nfilename: {name}.warc\r\n".encode()
                rows.append((name, 0, warc_record([
                    ("WARC-Type", "warcinfo"), ("WARC-Record-ID", warc_id(None, name, "")), ("WARC-Date", _stamp(date)),
                    ("Content-Type", "application/warc-fields")], info)))
            seq, size = seq + 1, size + len(block)
            rows.append((name, seq, warc_record(fields, block)))
            if len(rows) >= 500:
                yield _rows(rows)
                rows = []
        yield _rows(rows)


def convert(spark: SparkSession, arcs: str, warcs: str, least: int = LEAST) -> None:
    """Write the ARC files of one folder as WARC files in another.

    Of the records with equal payloads of ``least`` bytes or more, that with the smallest page id is the response and
    the others revisit it; rows that share that id with equal payloads are all responses, and so are records without id
    where no other has one. First pages are found among digests alone, one row per digest and task before the shuffle;
    payloads are shuffled once. Archives are parsed once, into a table. Only HTTP answers revisit each other.
    Page ids compare as numbers where they are numbers, and as texts otherwise; numbers come first.
    """
    records = frozen(read_arcs(spark, arcs))
    firsts = records.where((F.col("bytes") >= least) & F.col("http")).groupBy("digest").agg(
        F.min(F.when(F.col("page_id").isNotNull(), F.struct(
            F.expr("try_cast(page_id AS long) IS NULL").alias("text"), F.expr("try_cast(page_id AS long)").alias("number"),
            "page_id", "url"))).alias("first"),
        F.count(F.lit(1)).alias("n")).where("n > 1")
    # Written, so that the join has exchanges of its own, and a digest that very many records share can be split.
    firsts = frozen(firsts.select("digest", F.col("first.page_id").alias("first"), F.col("first.url").alias("first_url")))
    joined = records.join(firsts, "digest", "left").select(
        *KINDS, F.when((F.col("bytes") >= least) & F.col("http"), F.col("first")).alias("first"), "first_url")
    _files(joined.mapInArrow(_convert, "file string, seq long, record binary"), warcs, "\r\n\r\n")


def _parse_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"record_id": pa.string(), "page_id": pa.string(), "record_type": pa.string(), "payload_digest": pa.string(),
             "payload_bytes": pa.int64(), "refers_to_id": pa.string(), "url": pa.string(), "date": pa.string()}
    for batch in batches:
        for packed in batch.column(0):
            rows = []
            for fields, block in read_warc(zlib.decompress(packed.as_py(), wbits=31)):
                if fields["WARC-Type"] == "warcinfo":
                    continue
                http, payload = {}, block
                if fields["WARC-Type"] != "resource":
                    http, _, payload = split_http(block)
                digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                length = int(http.get("content-length", len(payload)))
                if fields["WARC-Type"] != "revisit" and (
                        len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
                    raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
                rows.append((fields["WARC-Record-ID"], _read(http.get("x-page")), fields["WARC-Type"],
                             digest, length, fields.get("WARC-Refers-To"), fields["WARC-Target-URI"],
                             fields["WARC-Date"]))
            yield pa.RecordBatch.from_pydict({
                name: pa.array([r[n] for r in rows], kind) for n, (name, kind) in enumerate(kinds.items())})


def read_warcs(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files, one row each; payloads are checked against their digests and lengths."""
    return _contents(spark, path).mapInArrow(
        _parse_warc, "record_id string, page_id string, record_type string, payload_digest string, payload_bytes long, "
        "refers_to_id string, url string, date string")


def round_trip(pages: DataFrame) -> DataFrame:
    """``pages`` written as ARC files, converted, and read back from the WARC files: one row per row of ``pages``.

    An identifier in ``WARC-Refers-To`` is turned into the page it belongs to by a join on identifiers. An empty table
    gives no rows; extra columns are left aside.
    """
    spark = pages.sparkSession
    arcs, warcs = shared_folder(spark, "arc"), shared_folder(spark, "warc")
    write_arc(pages, arcs)
    convert(spark, arcs, warcs)
    # What the headers say, without blocks; the archives are read once.
    records = frozen(read_warcs(spark, warcs))
    known = records.where("record_type = 'response' AND page_id IS NOT NULL").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")).distinct()
    revisits = records.where("record_type = 'revisit'").join(known, "refers_to_id", "left")
    others = records.where("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("string"))
    kind = pages.schema["page_id"].dataType
    return revisits.unionByName(others).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "url")
