"""Legacy archive converter: ARC files (versions 1 and 2) to WARC 1.1 files.

An ARC file starts with a ``filedesc://`` record whose body tells the version
and names the fields of the header lines that follow; each record is such a
line, whose last field is the length of the content after it.  A record becomes
a WARC record with a UUID made from its place, an ISO date, a type, and SHA-256
digests of block and payload.  Of records with equal payloads of at least
``min_bytes``, the one with the smallest id (nulls last, then by place) is the
response and the others are revisits that refer to it and carry no payload.

Files are read whole by one task each (as Spark's ``binaryFile``: up to 2 GB;
archives are usually held to 1 GB), once, and unpacked as a stream, record by record, into a
table.  Revisits are found and written from its narrow columns.  Payloads do not move: a bitmap of
a fixed size tells which records can't be revisits, and these are written where they lie.  Only a
record that the bitmap takes for a revisit by mistake meets an exact join.
They are written with Spark's text writer, one record a row and the WARC
record end as line separator, compressed as one gzip stream per file.

Defined cases: null texts are empty payloads; a null URL is written as ``-``;
spaces and control characters of a URL are percent-encoded; a null id is left out and
read as null; equal rows are separate records; a date that can't be read gives
1970-01-01; a line that is no header is skipped up to the next that is; content
shorter than declared is kept and marked ``WARC-Truncated``; an empty table
gives archives without records and an empty result.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import bitmap, marked, stored
from kestrel.session import scratch_path

MIN_REVISIT_BYTES = 100
BITS = 23
ID_HEADER = "X-Page-Id"
WARC_END = "\r\n\r\n"
_OUT_BYTES = 4 << 20
_ARC_FIELDS = {  # header fields by version, as the format defines them
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---------------------------------------------------------------- ARC files

def _quoted_url(url: str | None) -> str:
    if not url:
        return "-"
    return re.sub(r"[\x00-\x20\x7F]", lambda m: f"%{ord(m[0]):02X}", url)


def arc_record(version: int, url: str | None, date: str, mime: str, content: bytes, code: int = 200,
               ip: str = "0.0.0.0") -> bytes:
    """One ARC record without the newline that ends it."""
    middle = [] if version == 1 else [str(code), "-", "-", "0", "-"]
    head = " ".join([_quoted_url(url), ip, date, mime, *middle, str(len(content))])
    return head.encode() + b"\n" + content


def _filedesc(version: int, name: str) -> bytes:
    body = f"{version} 0 kestrel\n{_ARC_FIELDS[version]}\n".encode()
    return arc_record(version, f"filedesc://{name}", "20240101000000", "text/plain", body)


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> None:
    """Legacy archives of a table of pages: an HTTP response per row, one file
    per partition, versions 1 and 2 in turn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version = 1 + part % 2
        yield pa.RecordBatch.from_arrays([pa.array([_filedesc(version, f"{part:05d}.arc")])], names=["record"])
        for batch in batches:
            out, size = [], 0
            for key, url, html in zip(*(batch.column(c) for c in ("id", "url", "html"))):
                payload = (html.as_py() or "").encode()
                key = key.as_py()
                mark = "" if key is None else f"{ID_HEADER}: {key}\r\n"
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{mark}" \
                       f"Content-Length: {len(payload)}\r\n\r\n"
                out.append(arc_record(version, url.as_py(), "20240101000000", "text/html", head.encode() + payload))
                size += len(out[-1])
                if size > _OUT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    rows.mapInArrow(run, "record binary").select(F.col("record").cast("string")) \
        .write.option("lineSep", "\n").option("compression", "gzip").text(path)


def _opened(content: bytes):
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else raw


def arc_records(content: bytes) -> Iterator[dict]:
    """Records of an ARC file, in order: its header fields by name, ``version``,
    ``offset`` (in the unpacked file), ``content``, ``short`` (bytes missing),
    ``head`` (whether it is the file's own ``filedesc://`` record, which only the first can be)."""
    file, offset, first = _opened(content), 0, True
    version, names = 1, _ARC_FIELDS[1].split()
    while line := file.readline():
        at, offset = offset, offset + len(line)
        text = line.rstrip(b"\r\n").decode("utf-8", "replace")
        if not text.strip():
            continue
        head = first and text.startswith("filedesc://")
        fields = text.split(" ") if head else text.rsplit(" ", len(names) - 1)
        if len(fields) < 2 or not fields[-1].isdigit() or (not head and len(fields) != len(names)):
            continue
        size, first = int(fields[-1]), False
        body = file.read(size)
        offset += len(body)
        if head:
            lines = body.decode("utf-8", "replace").split("\n")
            if lines[0][:1].isdigit():
                version = int(lines[0].split(" ")[0])
            if len(lines) > 1 and lines[1].strip():
                names = lines[1].split()
            elif version in _ARC_FIELDS:
                names = _ARC_FIELDS[version].split()
            yield {"URL": fields[0], "Archive-date": "", "Content-type": "text/plain", "version": version,
                   "offset": at, "content": body, "short": size - len(body), "head": True}
            continue
        yield dict(zip(names, fields)) | {"version": version, "offset": at, "content": body,
                                          "short": size - len(body), "head": False}


def _payload_at(content: bytes) -> int:
    """Where the payload starts: after the HTTP head, if there is one."""
    if not content.startswith(b"HTTP/"):
        return 0
    at = content.find(b"\r\n\r\n")
    return at + 4 if at >= 0 else len(content)


def _http_header(head: bytes, name: str) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def _number(text: str | None) -> int | None:
    """The 64-bit number that ``text`` reads as, else None."""
    if text is None or not re.fullmatch(r"-?0*[0-9]{1,19}", text):
        return None
    number = int(re.sub(r"^(-?)0+(?=[0-9])", r"\1", text))
    return number if -1 << 63 <= number < 1 << 63 else None


# --------------------------------------------------------------- WARC files

def warc_date(date: str) -> str:
    """ISO date of an ARC date of 14 (or, in old files, fewer) digits."""
    try:
        return datetime.strptime(date.ljust(14, "0") if len(date) >= 8 else date, "%Y%m%d%H%M%S") \
            .replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def record_id(path: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}#{offset}')}>"


def warc_record(rec: dict, path: str, revisit_of: tuple[str, str] | None = None) -> bytes:
    """The WARC record of an ARC record, without the four bytes that end it.

    ``revisit_of``: id and URL of the response that a revisit refers to.  The payload's digest is
    made from ``content`` unless ``rec`` has it; then the content of a revisit may end before the payload.
    """
    content = rec["content"]
    start = _payload_at(content)
    http = content.startswith(b"HTTP/")
    kind = "warcinfo" if rec["head"] else \
        "revisit" if revisit_of else "response" if http else "resource"
    block = content[:start] if kind == "revisit" else content
    if kind == "warcinfo":
        block = f"software: kestrel\r\nformat: WARC File Format 1.1\r\nisPartOf: {rec['URL'][11:]}\r\n".encode()
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id(path, rec["offset"])),
            ("WARC-Date", warc_date(rec.get("Archive-date", "")))]
    if kind != "warcinfo":
        head += [("WARC-Target-URI", rec["URL"]), ("WARC-IP-Address", rec.get("IP-address", "0.0.0.0")),
                 ("WARC-Payload-Digest", "sha256:" + (rec.get("digest") or hashlib.sha256(content[start:]).hexdigest()))]
    head.append(("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()))
    if revisit_of:
        head += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", revisit_of[0]),
                 ("WARC-Refers-To-Target-URI", revisit_of[1])]
    if rec["short"]:
        head.append(("WARC-Truncated", "length"))
    mime = "application/warc-fields" if kind == "warcinfo" else \
        "application/http;msgtype=response" if http else rec.get("Content-type", "application/octet-stream")
    head += [("Content-Type", mime), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a WARC file."""
    file = _opened(content)
    while line := file.readline():
        if not line.startswith(b"WARC/"):
            continue
        head = {}
        while (line := file.readline().rstrip(b"\r\n")):
            key, _, value = line.decode("utf-8", "replace").partition(":")
            head[key.strip()] = value.strip()
        yield head, file.read(int(head.get("Content-Length", 0)))


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            yield path.as_py(), content.as_py()


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _rows(rows: Iterator[tuple], schema: pa.Schema, at: int | None = None, every: int = 4096):
    """Record batches of rows; ``at``: the column whose bytes bound a batch."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[at]) if at is not None else 0
        if len(held) >= every or size > _OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


#: Columns of :func:`arc_table`.
_ARC_TABLE = pa.schema([
    ("path", pa.string()), ("offset", pa.int64()), ("id", pa.int64()), ("url", pa.string()), ("digest", pa.string()),
    ("size", pa.int64()), ("date", pa.string()), ("ip", pa.string()), ("mime", pa.string()), ("short", pa.int64()),
    ("head", pa.binary()), ("record", pa.binary())])


def arc_table(spark: SparkSession, path: str, id_header: str = ID_HEADER) -> DataFrame:
    """A row per ARC record, stored: path, offset, id, url, digest and size of its payload, date, ip, mime,
    short, head (the HTTP head), record (the WARC record that it becomes unless it is a revisit).
    The files' own records have no digest."""
    def run(batches):
        def rows():
            for file, content in _contents(batches):
                for rec in arc_records(content):
                    block, record = rec["content"], warc_record(rec, file)
                    if rec["head"]:
                        yield (file, rec["offset"], *[None] * 9, record)
                        continue
                    start = _payload_at(block)
                    yield (file, rec["offset"], _number(_http_header(block[:start], id_header)), rec["URL"],
                           hashlib.sha256(block[start:]).hexdigest(), len(block) - start, rec.get("Archive-date"),
                           rec.get("IP-address"), rec.get("Content-type"), rec["short"], block[:start], record)
        yield from _rows(rows(), _ARC_TABLE, len(_ARC_TABLE) - 1)

    return stored(_archives(spark, path).mapInArrow(
        run, "path string, offset long, id long, url string, digest string, size long, date string, ip string, "
             "mime string, short long, head binary, record binary"), "arc-table")


def revisits(table: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """The records that repeat an earlier payload, without ``record``, with place and URL of that
    payload's response (o_path, o_offset, o_url); stored."""
    index = table.drop("record").filter((F.col("size") >= min_bytes) & F.col("digest").isNotNull())
    place = F.struct(F.col("id").isNull().alias("n"), "id", "path", "offset", "url")
    repeated = stored(index.groupBy("digest").agg(F.min(place).alias("o"), F.count("*").alias("copies"))
                      .filter("copies > 1").select("digest", "o"), "repeated")
    return stored(index.join(repeated, "digest")
                  .filter((F.col("path") != F.col("o.path")) | (F.col("offset") != F.col("o.offset")))
                  .select(*index.columns, F.col("o.path").alias("o_path"), F.col("o.offset").alias("o_offset"),
                          F.col("o.url").alias("o_url")), "revisits")


def _revisit_records(again: DataFrame) -> DataFrame:
    schema = pa.schema([("record", pa.binary())])

    def run(batches):
        def rows():
            for batch in batches:
                for r in batch.to_pylist():
                    rec = {"content": r["head"], "head": False, "offset": r["offset"], "URL": r["url"], "short": r["short"],
                           "digest": r["digest"]}
                    rec |= {k: r[c] for k, c in (("Archive-date", "date"), ("IP-address", "ip"), ("Content-type", "mime"))
                            if r[c] is not None}
                    yield (warc_record(rec, r["path"], (record_id(r["o_path"], r["o_offset"]), r["o_url"])),)
        yield from _rows(rows(), schema, 0)

    return again.mapInArrow(run, "record binary")


def _others(table: DataFrame, again: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """``record`` of the rows of ``table`` that are not in ``again``: those that the bitmap of ``again``
    lets pass, which stay where they are, and those that it takes for revisits by mistake."""
    key, place = F.xxhash64("path", "offset"), ["path", "offset"]
    held = bitmap(again.select(key.alias("__hash")), "__hash", bits)
    # found from the narrow columns, so that payloads move only if they are among (or look like) them
    taken = marked(table.select(*place), key, held, bits).filter("__marked").select(*place)
    wrong = stored(taken.join(again.select(*place), place, "left_anti"), "unlike")
    wrong_held = bitmap(wrong.select(key.alias("__hash")), "__hash", bits)
    rows = marked(table.select(*place, "record"), key, held, bits)
    few = marked(rows.filter("__marked").drop("__marked"), key, wrong_held, bits).filter("__marked")
    return rows.filter("not __marked").select("record"), few.join(wrong, place, "left_semi").select("record")


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = MIN_REVISIT_BYTES,
            id_header: str = ID_HEADER, bits: int = BITS) -> None:
    """Writes the WARC files of the ARC files under ``arc_path``.  ``bits``: size of the bitmap of
    revisits; a fuller one moves more payloads, nothing else."""
    table = arc_table(spark, arc_path, id_header)
    again = revisits(table, min_bytes)
    passing, mistaken = _others(table, again, bits)
    passing.unionByName(mistaken).unionByName(_revisit_records(again)).select(F.col("record").cast("string")) \
        .write.option("lineSep", WARC_END).option("compression", "gzip").text(warc_path)


def read_warc(spark: SparkSession, path: str, id_header: str = ID_HEADER) -> DataFrame:
    """(record_id, record_type, id, url, payload_bytes, payload_digest, refers_to_id)
    of every captured record, stored.  A revisit's payload is known by its
    headers; a response's digest is made from what the file holds."""
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("id", pa.int64()),
                        ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("refers_to_id", pa.string())])

    def run(batches):
        def rows():
            for _, content in _contents(batches):
                for head, block in warc_records(content):
                    kind = head["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    start = _payload_at(block)
                    size, digest = len(block) - start, hashlib.sha256(block[start:]).hexdigest()
                    if kind == "revisit":
                        size = _number(_http_header(block, "Content-Length"))
                        digest = head["WARC-Payload-Digest"].partition(":")[2]
                    yield (head["WARC-Record-ID"], kind, _number(_http_header(block[:start], id_header)),
                           head.get("WARC-Target-URI"), size, digest, head.get("WARC-Refers-To"))
        yield from _rows(rows(), schema)

    return stored(_archives(spark, path).mapInArrow(
        run, "record_id string, record_type string, id long, url string, payload_bytes long, "
             "payload_digest string, refers_to_id string"), "warc-index")


def resolve(records: DataFrame) -> DataFrame:
    """``records`` of :func:`read_warc` with ``refers_to``: the id of the response
    that a revisit's record id names."""
    again = records.filter("record_type = 'revisit'")
    named = stored(records.filter("record_type = 'response'")
                   .select(F.col("record_id").alias("refers_to_id"), F.col("id").alias("refers_to"))
                   .join(again.select("refers_to_id").distinct(), "refers_to_id", "left_semi"), "referred")
    plain = records.filter("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    return plain.unionByName(again.join(named, "refers_to_id", "left").select(*plain.columns))


def convert_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages -> ARC files -> WARC files -> one row per record read back."""
    spark = pages.sparkSession
    arc, out = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, id_col, url_col, html_col)
    convert(spark, arc, out, min_bytes)
    return resolve(read_warc(spark, out))
