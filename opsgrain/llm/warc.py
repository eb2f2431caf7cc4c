"""Operator 3, WARC archives: written with Spark's text writer, read back with
a streaming parser, and assembled into one nested row per capture.

``write_archives`` writes three records per page: request, response (or
revisit) and metadata.  Request and metadata name the response in
``WARC-Concurrent-To``.  ``read_records`` parses archives by Content-Length.
``assemble`` joins the three kinds through those identifiers.

Defined results: null html is an empty payload, a null url has no target URI, a
null page_id has no page-id field and is never the kept original unless its
group has no id at all.  Repeated rows are separate captures; rows tied for the
largest page_id of their payload are all responses.  Line breaks in a URL are
written as %0D and %0A.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsgrain.llm.common import broadcast_if_small, new_path, stored

EOL = "\r\n"
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT = 1000

RECORD = (
    "warc_type string, record_id string, concurrent_to string, target_uri string, payload_digest string, "
    "refers_to_uri string, page_id bigint, head string, payload binary"
)


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(EOL)), F.lit(""))


def _record(kind: Column | str, rid: Column, headers: list[Column], content_type: str, block: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat(
        F.lit("WARC/1.1" + EOL), _header("WARC-Type", kind), _header("WARC-Record-ID", rid), _header("WARC-Date", F.lit(DATE)),
        *headers, F.lit(f"Content-Type: {content_type}{EOL}"), _header("Content-Length", F.octet_length(block).cast("string")), F.lit(EOL), block,
    )


def _urn(seed: Column) -> Column:
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.md5(seed), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def write_archives(pages: DataFrame, path: str, captures_per_file: int = 2000) -> None:
    """Write ``pages(page_id, url, html)`` as gzipped WARC files under ``path``.

    Among equal payloads of at least ``MIN_REVISIT`` bytes the largest page_id
    is the response; the others become revisit records without payload."""
    p = pages.select("page_id", F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("bytes", F.octet_length("html"))
    repeated = stored(
        p.where(F.col("bytes") >= MIN_REVISIT).groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("original"), F.max_by("url", "page_id").alias("original_url")).where("n > 1"),
        "warc-repeated",
    )
    p = p.join(broadcast_if_small(repeated), "digest", "left")
    revisit = F.col("original").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("original")))
    p = p.withColumn("revisit", revisit).withColumn("key", F.concat_ws("|", "page_id", "digest", F.monotonically_increasing_id()))
    rid = {k: _urn(F.concat(F.col("key"), F.lit(k))) for k in ("request", "response", "metadata")}
    uri = _header("WARC-Target-URI", F.col("url"))
    to_response = _header("WARC-Concurrent-To", rid["response"])
    digest = _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.col("bytes").cast("string"), F.lit(END))
    request = _record("request", rid["request"], [uri, to_response], "application/http; msgtype=request",
                      F.concat(F.lit("GET "), F.coalesce("url", F.lit("")), F.lit(" HTTP/1.1" + END)))
    response = _record(
        F.when(F.col("revisit"), "revisit").otherwise("response"), rid["response"],
        [uri, digest, F.when(F.col("revisit"), F.concat(_header("WARC-Profile", F.lit(PROFILE)), _header("WARC-Refers-To-Target-URI", F.col("original_url")))).otherwise("")],
        "application/http; msgtype=response", F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("html"))))
    metadata = _record("metadata", rid["metadata"], [uri, to_response], "application/warc-fields",
                       _header("page-id", F.col("page_id").cast("string")))
    out = p.select(F.explode(F.array(request, response, metadata)).alias("value"))
    # the end of a record is the line separator of the text writer
    out.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", 3 * captures_per_file).text(path)


def _inflated(gz: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """Decompressed pieces of a file of one or more gzip members."""
    data = memoryview(gz)
    while len(data):
        d = zlib.decompressobj(31)
        at = 0
        while not d.eof and at < len(data):
            yield d.decompress(data[at:at + step])
            at += step
        yield d.flush()
        rest = d.unused_data
        data = memoryview(rest + bytes(data[at:])) if rest else data[at:]


def parse_warc(gz: bytes) -> Iterator[tuple]:
    """Records of one archive, in order, as tuples of ``RECORD``."""
    buf = bytearray()
    pieces = _inflated(gz)

    def more() -> bool:
        for piece in pieces:
            if piece:
                buf.extend(piece)
                return True
        return False

    while True:
        while (end := buf.find(b"\r\n\r\n")) < 0:
            if not more():
                if buf.strip():
                    raise ValueError("the archive ends inside a record header")
                return
        lines = bytes(buf[:end]).decode("utf-8").split(EOL)
        if lines[0] != "WARC/1.1":
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        size = int(head["Content-Length"])
        while len(buf) < end + 4 + size + 4:
            if not more():
                raise ValueError("the archive ends inside a record")
        block = bytes(buf[end + 4:end + 4 + size])
        if buf[end + 4 + size:end + 8 + size] != b"\r\n\r\n":
            raise ValueError("a record is longer than its Content-Length")
        del buf[:end + 8 + size]
        kind, page, http, payload = head["WARC-Type"], None, None, None
        if kind == "metadata":
            fields = dict(x.split(": ", 1) for x in block.decode("utf-8").split(EOL) if x)
            page = int(fields["page-id"]) if "page-id" in fields else None
        else:
            cut = block.index(b"\r\n\r\n") + 4
            http, payload = block[:cut].decode("utf-8"), block[cut:] if kind == "response" else None
        yield (kind, head["WARC-Record-ID"], head.get("WARC-Concurrent-To"), head.get("WARC-Target-URI"),
               head.get("WARC-Payload-Digest"), head.get("WARC-Refers-To-Target-URI"), page, http, payload)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under ``path``.  A file is one row of the
    scan; its size is bounded by the writer's ``captures_per_file``."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    types = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(x.split()[0], types[x.split()[1]]) for x in RECORD.split(", ")])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gz in batch.column(0):
                rows, size = [], 0
                for rec in parse_warc(gz.as_py()):
                    rows.append(dict(zip(names, rec, strict=True)))
                    size += len(rec[-1] or b"")
                    if size > 4 << 20 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(parse, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response (or revisit) with the request
    and the metadata that are concurrent to it (null where none is)."""
    main = records.where("warc_type in ('response', 'revisit')")
    asked = records.where("warc_type = 'request'").select(
        F.col("concurrent_to").alias("record_id"), F.struct("record_id", "target_uri", "head").alias("request"))
    meta = records.where("warc_type = 'metadata'").select(
        F.col("concurrent_to").alias("record_id"), F.struct("record_id", "page_id").alias("metadata"))
    response = F.struct("record_id", "warc_type", "target_uri", "payload_digest", "refers_to_uri", "head", "payload").alias("response")
    return main.select("record_id", response).join(asked, "record_id", "left").join(meta, "record_id", "left").select("request", "response", "metadata")


def captures(pages: DataFrame) -> DataFrame:
    """Write archives to the shared folder, read them back, and assemble."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path)
    return assemble(read_records(spark, path))


def resolve_revisits(caps: DataFrame) -> DataFrame:
    """Narrow row per capture with its full payload's size and digest; a
    revisit takes them from the response whose payload has its digest."""
    r = F.col("response")
    narrow = stored(caps.select(
        F.col("metadata.page_id").alias("page_id"), r["warc_type"].alias("record_type"),
        F.octet_length(r["payload"]).cast("bigint").alias("bytes"),
        F.coalesce(F.sha1(r["payload"]), F.substring_index(r["payload_digest"], ":", -1)).alias("payload_digest"),
    ), "warc-captures")
    originals = narrow.where(f"record_type = 'response' and bytes >= {MIN_REVISIT}").groupBy("payload_digest").agg(
        F.max("page_id").alias("original"), F.max("bytes").alias("original_bytes"))
    revisits = narrow.where("record_type = 'revisit'").join(originals, "payload_digest", "left").select(
        "page_id", F.col("original_bytes").alias("payload_bytes"), "payload_digest", "record_type", F.col("original").alias("refers_to"))
    whole = narrow.where("record_type = 'response'").select(
        "page_id", F.col("bytes").alias("payload_bytes"), "payload_digest", "record_type", F.lit(None).cast("bigint").alias("refers_to"))
    return whole.unionByName(revisits)
