"""WARC archives: write, normalise monolithic gzip to one member per record with a sidecar index, read back.

1. ``write_monolithic``: Spark's text sink with gzip compression writes one gzip stream per task. A row holds a record
   without its last CRLF and the line separator supplies it, so the file is a plain WARC stream.
2. ``normalise``: each monolithic file is inflated once, in chunks; every record becomes a gzip member of its own, and
   an index line (offset, length, inflated length, type, record id) is emitted beside it. Both go out in one text
   write, partitioned by kind and archive. The separator is a zero byte: a gzip member ends with the high byte of its
   length, which is zero below 16 MiB, so a row is the member without that byte. Larger records get an empty member
   behind them, which ends in zero.
3. ``read_archives``: walks the members of the normalised archives; ``indexed`` keeps the records whose offset and
   length stand in the index.

Only Spark's readers and writers touch files, so any store that Spark reaches will do. Archives are as large as the
tasks' partitions.

Defined cases: null html is an empty payload; a null page_id takes part with a record id made from its payload; rows
that repeat the winning page_id with an equal payload are all responses; an empty table writes empty archives;
line breaks and blanks in a url are dropped from the header; a damaged archive fails with its name. Other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the WARC format
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
CHUNK = 1 << 20
BATCH_BYTES = 8 << 20


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: four groups of 40 bits, each eight digits of base 32."""
    hexed = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(page_id: Column, fingerprint: Column) -> Column:
    h = F.md5(F.when(page_id.isNull(), F.concat(F.lit("payload|"), F.hex(fingerprint)))
              .otherwise(F.concat(F.lit("page|"), page_id.cast("string"))).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def records(pages: DataFrame, min_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One serialised record per page, without its last CRLF (column ``value``, raw bytes as a string)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"),
                        F.unhex(F.sha2(payload, 256)).alias("fp"))
    size = F.length("payload")
    eligible = size >= F.lit(int(min_revisit_bytes))
    groups = (rows.where(eligible).groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first_id"))
              .where("n > 1").select("fp", "first_id", F.lit(True).alias("grouped")))
    j = rows.join(groups, "fp", "left")
    revisit = F.coalesce(F.col("grouped") & eligible & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.lit(False))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    size.cast("string"), F.lit(CRLF * 2)).cast("binary")
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    url = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7F]", ""), F.lit(""))
    page_line = F.coalesce(F.concat(F.lit("X-Page-Id: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit(""))
    ref = F.when(revisit, F.concat(
        F.lit("WARC-Refers-To: <"), _record_id(F.col("first_id"), F.col("fp")),
        F.lit(f">{CRLF}WARC-Profile: {REVISIT_PROFILE}{CRLF}"))).otherwise(F.lit(""))
    head = F.concat(
        F.lit(f"{VERSION}{CRLF}WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"{CRLF}WARC-Record-ID: <"), _record_id(F.col("page_id"), F.col("fp")),
        F.lit(f">{CRLF}WARC-Date: {date}{CRLF}WARC-Target-URI: "), url,
        F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"), base32_sha1(F.col("payload")), F.lit(CRLF), page_line, ref,
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        F.length(block).cast("string"), F.lit(CRLF * 2)).cast("binary")
    return j.select(F.concat(head, block, F.lit(CRLF).cast("binary")).cast("string").alias("value"))


def write_monolithic(recs: DataFrame, folder: str) -> None:
    """One gzip stream per task; every row is closed by the second CRLF of its record."""
    recs.write.option("lineSep", CRLF).option("compression", "gzip").text(folder)


def stream_records(content, name: str):
    """Records (header bytes, block bytes) of a gzip file of one or more members, inflated chunk by chunk."""
    data, pos, buf = memoryview(content), 0, bytearray()
    inflate = zlib.decompressobj(31)
    head_end = need = None

    def parsed():
        nonlocal head_end, need
        while True:
            if head_end is None:
                head_end = buf.find(b"\r\n\r\n")
                if head_end < 0:
                    head_end = None
                    return
                fields = header_fields(bytes(buf[:head_end]))
                if "content-length" not in fields:
                    raise ValueError(f"{name}: record without Content-Length")
                need = head_end + 4 + int(fields["content-length"]) + 4
            if len(buf) < need:
                return
            rec, h = bytes(buf[:need]), head_end
            del buf[:need]
            head_end = None
            yield rec, h

    while pos < len(data):
        piece = data[pos:pos + CHUNK]
        pos += len(piece)
        while piece:
            buf += inflate.decompress(piece)
            piece = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(31)
            yield from parsed()
    if buf:
        raise ValueError(f"{name}: truncated record at the end")


def header_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split(CRLF)
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """A gzip member whose last byte is zero (see the module text)."""
    def one(x):
        c = zlib.compressobj(level, zlib.DEFLATED, 31)
        return c.compress(x) + c.flush()
    out = one(data)
    return out if out[-1] == 0 else out + one(b"")


def normalise(spark: SparkSession, source: str, target: str, level: int = 6) -> None:
    """Rewrite the monolithic archives of ``source`` under ``target``/kind=warc and /kind=index."""
    def rewrite(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                name = path.rsplit("/", 1)[-1].split(".", 1)[0]
                rows, held, offset = [], 0, 0
                for seq, (rec, h) in enumerate(stream_records(content.as_buffer(), name)):
                    f = header_fields(rec[:h])
                    member = gzip_member(rec, level)
                    line = f"{offset} {len(member)} {len(rec)} {f.get('warc-type')} {f.get('warc-record-id')}"
                    rows += [("warc", name, seq, member[:-1]), ("index", name, seq, line.encode())]
                    offset += len(member)
                    held += len(member)
                    if held >= BATCH_BYTES:
                        yield _batch(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, schema)

    schema = pa.schema([("kind", pa.string()), ("archive", pa.string()), ("seq", pa.int64()), ("value", pa.binary())])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path", "content")
    out = files.mapInArrow(rewrite, "kind string, archive string, seq long, value binary")
    (out.sortWithinPartitions("kind", "archive", "seq")
     .select("kind", "archive", F.col("value").cast("string").alias("value"))
     .write.option("lineSep", "\u0000").partitionBy("kind", "archive").text(target))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types,
                                                                      strict=True)], schema=schema)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The sidecar index: ``archive, offset, length, inflated, record_type, record_id``."""
    lines = (spark.read.schema("value string, kind string, archive string").option("lineSep", "\u0000").text(folder)
             .where("kind = 'index'"))
    p = F.split("value", " ")
    return lines.select("archive", p[0].cast("long").alias("offset"), p[1].cast("long").alias("length"),
                        p[2].cast("long").alias("inflated"), p[3].alias("record_type"), p[4].alias("record_id"))


ARCHIVE_SCHEMA = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                            ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to_id", pa.string()),
                            ("page_id", pa.string()), ("stated_digest", pa.string()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("payload", pa.binary())])


def _parse_member(archive: str, offset: int, length: int, rec: bytes, with_payload: bool) -> tuple:
    h = rec.index(b"\r\n\r\n")
    f = header_fields(rec[:h])
    block = rec[h + 4:-4]
    payload = block[block.index(b"\r\n\r\n") + 4:]
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    stated = f.get("warc-payload-digest", "").removeprefix("sha1:")
    if f["warc-type"] == "response" and digest != stated:
        raise ValueError(f"{archive} at {offset}: payload digest differs from the header's")
    return (archive, offset, length, f["warc-type"], f["warc-record-id"], f.get("warc-refers-to"), f.get("x-page-id"),
            stated, len(payload), digest, payload if with_payload else None)


def members(content, name: str):
    """(offset, length, inflated bytes) of each gzip member; an empty member belongs to the one before it."""
    data, pos, held = memoryview(content), 0, None
    while pos < len(data):
        d, out, start = zlib.decompressobj(31), [], pos
        while not d.eof:
            if pos >= len(data):
                raise ValueError(f"{name}: truncated member at {start}")
            piece = data[pos:pos + CHUNK]
            out.append(d.decompress(piece))
            pos += len(piece) - len(d.unused_data)
        rec = b"".join(out)
        if not rec and held:
            held = (held[0], pos - held[0], held[2])
            continue
        if held:
            yield held
        held = (start, pos - start, rec)
    if held:
        yield held


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """Every record of the normalised archives, parsed, its payload digest computed and held against the header."""
    def parse(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                name = path.rsplit("archive=", 1)[-1].split("/", 1)[0]
                rows, held = [], 0
                for offset, length, rec in members(content.as_buffer(), name):
                    rows.append(_parse_member(name, offset, length, rec, with_payload))
                    held += len(rec)
                    if held >= BATCH_BYTES:
                        yield _batch(rows, ARCHIVE_SCHEMA)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, ARCHIVE_SCHEMA)

    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*")
             .load(folder).where(F.col("path").contains("/kind=warc/")).select("path", "content"))
    return files.mapInArrow(parse, "archive string, offset long, length long, record_type string, record_id string, "
                            "refers_to_id string, page_id string, stated_digest string, payload_bytes long, "
                            "payload_digest string, payload binary")


def indexed(parsed: DataFrame, index: DataFrame) -> DataFrame:
    """Records found exactly where the index says."""
    keys = ["archive", "offset", "length", "record_id"]
    return parsed.join(index.select(*keys), keys, "left_semi")


def resolve_revisits(recs: DataFrame, id_type: str = "bigint") -> DataFrame:
    """One row per record: the full payload's size and digest, and for revisits the page that holds the payload."""
    resp = (recs.where("record_type = 'response'").groupBy("record_id")
            .agg(F.first("page_id", ignorenulls=True).alias("r_page"), F.first("payload_bytes").alias("r_bytes"),
                 F.first("payload_digest").alias("r_digest")))
    # keys of their own on both sides: exchanged for the join, so that AQE can split a payload with many revisits
    resp = resp.select(F.concat("record_id", F.lit("")).alias("key"), "r_page", "r_bytes", "r_digest")
    rev = (recs.where("record_type = 'revisit'").withColumn("key", F.concat("refers_to_id", F.lit("")))
           .join(resp, "key", "left"))
    page = F.col("page_id").cast(id_type).alias("page_id")
    return (recs.where("record_type = 'response'")
            .select(page, "payload_bytes", "payload_digest", "record_type", F.lit(None).cast(id_type).alias("refers_to"))
            .unionByName(rev.select(page, F.col("r_bytes").alias("payload_bytes"), F.col("r_digest").alias(
                "payload_digest"), "record_type", F.col("r_page").cast(id_type).alias("refers_to"))))
