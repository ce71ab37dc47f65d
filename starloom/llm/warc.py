"""WARC archives: write captures, read them back, assemble transactions.

A capture is a request, a response (or a revisit of an equal payload) and a metadata record;
the request and the metadata name the response in WARC-Concurrent-To. Archives are written by
Spark's text writer with the record terminator as line separator, so they go through any file
system Spark knows; they are read as whole files and cut by Content-Length.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.llm.maps import mark
from starloom.sinks.scratch import pin

#: Fixed values of the format.
VERSION = "WARC/1.1"
BREAK = "\r\n"
END = BREAK + BREAK
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads below this many bytes are always stored.
SMALL = 100


def _line(name: str, value: Column) -> Column:
    """A header line; nothing for NULL. Line breaks inside a value become blanks."""
    clean = F.regexp_replace(value.cast("string"), "[\\r\\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(BREAK)), F.lit(""))


def _record(kind: Column, headers: Column, block: Column) -> Column:
    """The bytes of a record without its terminator."""
    head = F.concat(
        F.lit(VERSION + BREAK),
        _line("WARC-Type", kind),
        headers,
        _line("Content-Length", F.octet_length(block)),
        F.lit(BREAK),
    )
    return F.concat(F.encode(head, "UTF-8"), block)


def write_captures(
    pages: DataFrame,
    path: str,
    date: str = "2024-01-01T00:00:00Z",
    compression: str = "none",
    captures_per_file: int = 2000,
) -> None:
    """Write three records per row of ``pages`` (page_id, url, html) below ``path``, at most
    ``captures_per_file`` rows to a file, which bounds what a reading task holds.
    ``compression="gzip"`` writes each file as one gzip member.

    Payloads are the html in UTF-8, null as empty. Of rows with equal payloads of at least
    ``SMALL`` bytes those with the smallest page_id are responses, the others revisits; rows
    without page_id count as largest. Record ids are random, so repeated rows stay apart.
    An empty table writes archives without records. Other columns are not written.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    rows = rows.withColumn("_key", F.when(F.octet_length("payload") >= SMALL, F.col("digest")))
    # Copies are brought together by digest alone; a hot digest is one row per map task.
    first = (
        rows.filter("_key IS NOT NULL")
        .groupBy(F.col("_key").alias("_digest"))
        .agg(
            F.min("page_id").alias("_first"),
            F.min_by("url", F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("_url"),
            F.count("*").alias("_rows"),
        )
        .filter("_rows > 1")
        .drop("_rows")
    )
    # Payloads without a copy stay where they are; only the others are joined.
    marked = mark(rows, "_key", first.select("_digest"), "_again")
    single = marked.filter("NOT _again").withColumns(
        {
            "_digest": F.lit(None).cast("string"),
            "_first": F.lit(None).cast(rows.schema["page_id"].dataType),
            "_url": F.lit(None).cast(rows.schema["url"].dataType),
        }
    )
    known = single.union(
        marked.filter("_again").join(first, F.col("_key") == F.col("_digest"), "left")
    )
    stored = F.coalesce(F.col("page_id") == F.col("_first"), F.col("_first").isNull())
    known = known.withColumns(
        {"_stored": stored, "_id": F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))}
    )
    at = F.concat(_line("WARC-Target-URI", F.col("url")), _line("WARC-Date", F.lit(date)))
    own = _line("WARC-Record-ID", F.col("_id"))
    other = _line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))
    concurrent = _line("WARC-Concurrent-To", F.col("_id"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}"),
        F.lit("Content-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(END),
    )
    digest = _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    page = _line("WARC-Page-ID", F.col("page_id"))
    kind = F.when(F.col("_stored"), "response").otherwise("revisit")
    answer = _record(
        kind,
        F.concat(
            own,
            at,
            digest,
            page,
            F.when(F.col("_stored"), F.lit("")).otherwise(
                F.concat(
                    _line("WARC-Profile", F.lit(PROFILE)),
                    _line("WARC-Refers-To-Target-URI", F.col("_url")),
                    _line("WARC-Refers-To-Date", F.lit(date)),
                    _line("WARC-Refers-To-Page", F.col("_first")),
                )
            ),
            F.lit(f"Content-Type: application/http; msgtype=response{BREAK}"),
        ),
        F.concat(
            F.encode(http, "UTF-8"), F.when(F.col("_stored"), F.col("payload")).otherwise(F.lit(b""))
        ),
    )
    url = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "[\\r\\n ]+", "%20")
    host = F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    target = F.regexp_replace(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", "")
    place = F.regexp_replace(target, "^/", "")
    asked = F.concat(F.lit("GET /"), place, F.lit(f" HTTP/1.1{BREAK}Host: "), host, F.lit(END))
    request = _record(
        F.lit("request"),
        F.concat(other, at, concurrent, F.lit(f"Content-Type: application/http; msgtype=request{BREAK}")),
        F.encode(asked, "UTF-8"),
    )
    notes = F.concat(_line("via", F.lit("starloom")), _line("charset", F.lit("utf-8")))
    metadata = _record(
        F.lit("metadata"),
        F.concat(other, at, concurrent, F.lit(f"Content-Type: application/warc-fields{BREAK}")),
        F.encode(notes, "UTF-8"),
    )
    records = known.select(F.explode(F.array(request, answer, metadata)).alias("record"))
    # Bytes, taken as they are; the separator completes each record.
    writer = records.select(F.col("record").cast("string")).write.option("lineSep", END)
    writer.option("maxRecordsPerFile", 3 * captures_per_file).text(path, compression=compression)


FIELDS = pa.schema(
    [
        ("file", pa.string()),
        ("offset", pa.int64()),
        ("type", pa.string()),
        ("record_id", pa.string()),
        ("concurrent_to", pa.list_(pa.string())),
        ("headers", pa.map_(pa.string(), pa.string())),
        ("http", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
    ]
)
SCHEMA = (
    "file string, offset long, type string, record_id string, concurrent_to array<string>, "
    "headers map<string,string>, http string, payload binary, payload_bytes long, payload_digest string"
)


def _headers(head: bytes) -> list[tuple[str, str]]:
    """Names and values of a header block, continued lines joined."""
    found: list[tuple[str, str]] = []
    for line in head.split(b"\r\n"):
        if line[:1] in (b" ", b"\t") and found:
            name, value = found[-1]
            found[-1] = (name, f"{value} {line.strip().decode('utf-8', 'replace')}")
        elif b":" in line:
            name, _, value = line.partition(b":")
            found.append((name.decode("utf-8", "replace").strip(), value.decode("utf-8", "replace").strip()))
    return found


def parse(data: bytes, file: str = "") -> Iterator[dict]:
    """The records of an archive. The length in the header decides where a record ends, so
    payloads may hold anything. Bytes after a broken record are an error."""
    mark, at = VERSION[:5].encode(), 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        head = data.find(b"\r\n\r\n", at)
        if data[at : at + 5] != mark or head < 0:
            raise ValueError(f"no record at byte {at} of {file}")
        pairs = _headers(data[data.index(b"\r\n", at) + 2 : head])
        names = {name.lower(): value for name, value in pairs}
        size = int(names["content-length"])
        block = data[head + 4 : head + 4 + size]
        if len(block) < size:
            raise ValueError(f"record at byte {at} of {file} is cut off")
        http, payload = "", block
        if names.get("content-type", "").startswith("application/http"):
            first, _, payload = block.partition(b"\r\n\r\n")
            http = first.decode("utf-8", "replace")
        yield {
            "file": file,
            "offset": at,
            "type": names.get("warc-type"),
            "record_id": names.get("warc-record-id"),
            "concurrent_to": [v for n, v in pairs if n.lower() == "warc-concurrent-to"],
            "headers": list(names.items()),
            "http": http,
            "payload": payload,
            "payload_bytes": len(payload),
            "payload_digest": hashlib.sha256(payload).hexdigest(),
        }
        at = head + 4 + size


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives below ``path``; ``payloads=False`` leaves their bytes out
    (their length and digest stay). Files may be gzip, of one member or a member a record. A file
    is one task's work and must be below 2 GB."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows, held = [], 0
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                for row in parse(data, name.as_py()):
                    held += row["payload_bytes"]
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    if len(rows) >= 2000 or held > 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, FIELDS)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, FIELDS)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.filter("length > 0").select("path", "content").mapInArrow(cut, SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``record_id`` of its response or revisit, and the structs
    ``answer``, ``request`` and ``metadata``.

    Requests and metadata are joined to the response by the identifiers they are concurrent
    to. One that names no known response gives no capture; a response without a request or
    metadata has NULL there. Of several with the same response the one lying first is taken.
    """
    parts = [c for c in records.columns if c not in ("record_id", "concurrent_to")]
    whole = F.struct("record_id", *parts)
    answers = records.filter(F.col("type").isin("response", "revisit")).select(
        "record_id", whole.alias("answer")
    )
    # Each identifier names a record of its own, so these groups hold a record or two.
    beside = (
        records.filter(F.col("type").isin("request", "metadata"))
        .select(F.explode("concurrent_to").alias("_to"), "type", "file", "offset", whole.alias("_beside"))
        .groupBy("_to")
        .agg(
            *[
                F.min_by(
                    F.when(F.col("type") == t, F.col("_beside")),
                    F.when(F.col("type") == t, F.struct("file", "offset")),
                ).alias(t)
                for t in ("request", "metadata")
            ]
        )
    )
    return answers.join(beside, F.col("record_id") == F.col("_to"), "left").drop("_to")


def resolve(captures: DataFrame) -> DataFrame:
    """One row per capture: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Length and digest are taken from the payloads in the nested rows (where they were left out,
    from what the parser saw): a revisit gets them from the response it refers to, found by
    page and digest. The captures are read once; what is learnt of them is stored.
    """
    names = F.col("answer.headers")
    rows = captures.select(
        names["warc-page-id"].cast("bigint").alias("page_id"),
        F.coalesce(F.octet_length("answer.payload").cast("bigint"), "answer.payload_bytes").alias("own_bytes"),
        F.coalesce(F.sha2("answer.payload", 256), "answer.payload_digest").alias("own_digest"),
        F.col("answer.type").alias("record_type"),
        names["warc-refers-to-page"].cast("bigint").alias("refers_to"),
        F.substring_index(names["warc-payload-digest"], ":", -1).alias("named"),
        F.col("request").isNotNull().alias("has_request"),
        F.col("metadata").isNotNull().alias("has_metadata"),
    )
    rows = pin(rows, "captures")
    # Repeated rows are responses of the same page and payload.
    kept = (
        rows.filter("record_type = 'response' AND page_id IS NOT NULL")
        .groupBy(F.col("page_id").alias("_page"), F.col("own_digest").alias("_digest"))
        .agg(F.first("own_bytes").alias("_bytes"))
    )
    joined = rows.join(
        kept, (F.col("refers_to") == F.col("_page")) & (F.col("named") == F.col("_digest")), "left"
    )
    again = F.col("record_type") == "revisit"
    return joined.select(
        "page_id",
        F.when(again, F.col("_bytes")).otherwise(F.col("own_bytes")).alias("payload_bytes"),
        F.when(again, F.col("_digest")).otherwise(F.col("own_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
        "has_request",
        "has_metadata",
    )
