"""WARC archives: written record by record, read back, and assembled into captures.

Each capture is a response (or a revisit of an equal payload), a request and a
metadata record, tied by WARC-Concurrent-To.  Reading gives one row for each
record; assembly joins the three kinds through these identifiers into one nested
row for each capture.

Archives are written and read by Spark's text source with record boundaries as
line separators, so large archives are written, split and read in parallel and
go wherever Spark can write.  A payload that holds the boundary string itself is
sent in chunked transfer coding with a chunk border inside the string; the
payload is the same and the archive can still be cut at the boundary.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costframe.llm.common import saved, scratch_path, table

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads of fewer bytes are never revisits.
MIN_PAYLOAD = 0
RECORD = ("record_id string, type string, concurrent_to string, refers_to string, target_uri string, "
          "payload_bytes long, payload_digest string, fields map<string,string>, payload binary")


def base32(hex_digits: Column) -> Column:
    """Base-32 text of a 40-digit hexadecimal SHA-1."""
    parts = [F.lpad(F.conv(F.substring(hex_digits, i, 10), 16, 32), 8, "0") for i in range(1, 41, 10)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(kind: str) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), "pid", "digest", F.col("copy").cast("string")).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _record(kind: str, record_id: Column, headers: list[Column], content_type: str, block: Column) -> Column:
    return F.concat(F.lit(f"{VERSION}WARC-Type: {kind}\r\nWARC-Date: {DATE}\r\nWARC-Record-ID: "), record_id, F.lit("\r\n"),
                    *headers, F.lit(f"Content-Type: {content_type}\r\nContent-Length: "),
                    F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block)


def _chunked(body: Column) -> Column:
    """Chunked coding of a payload with a border inside each boundary string."""
    parts = F.split(body, r"WARC/1\.1")
    n = F.size(parts)
    pieces = F.transform(parts, lambda p, i: F.concat(
        F.when(i > 0, "/1.1").otherwise(""), p, F.when(i < n - 1, "WARC").otherwise("")))
    return F.concat(F.array_join(F.transform(F.filter(pieces, lambda p: p != ""), lambda p: F.concat(
        F.hex(F.octet_length(p)), F.lit("\r\n"), p, F.lit("\r\n"))), ""), F.lit("0\r\n\r\n"))


def captures_to_write(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """The texts of the records of ``pages`` (page_id, url, html), one row for each record.

    Which record is a response is settled on identifiers and digests; payloads
    go through one shuffle, once for each page and payload.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.select("page_id", F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("pid"),
                         F.coalesce("url", F.lit("")).alias("url"), body.alias("html"))
    pages = pages.withColumn("digest", base32(F.sha1(F.col("html").cast("binary"))))
    key = ["pid", "digest"]
    marks = (pages.select("page_id", *key, "url", F.octet_length("html").alias("bytes"))
             .groupBy("page_id", *key, "bytes", "url").agg(F.count(F.lit(1)).alias("times")))
    # copies of a page and payload are numbered through all their urls, as the record ids need
    order = (Window.partitionBy(*key).orderBy(F.col("page_id").isNull(), "url")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marks = marks.withColumn("upto", F.sum("times").over(order))
    first = (marks.groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull(), "page_id", "pid")).getField("pid").alias("least"),
                                         F.sum("times").alias("size")).where("size > 1").select("digest", "least"))
    # written, so that both sides of the join are plain exchanges: a hot payload's rows can then be split
    rows = (marks.join(saved(first, "equal-payloads"), "digest", "left").withColumn("first", F.coalesce("least", "pid"))
            .withColumn("copy", F.explode(F.sequence(F.col("upto") - F.col("times") + 1, F.col("upto")))))
    rows = rows.withColumn("revisit", (F.col("bytes") >= min_payload) & ((F.col("pid") != F.col("first")) | (F.col("copy") > 1)))
    payload = pages.groupBy(*key).agg(F.first("html").alias("html"))
    answers = rows.where("not revisit").join(payload, key)
    again = rows.where("revisit").withColumn("html", F.lit(""))

    safe = F.regexp_replace(F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20"), "WARC/", "WARC%2F")
    uri = F.when(F.col("url") != "", F.concat(F.lit("WARC-Target-URI: "), safe, F.lit("\r\n"))).otherwise("")
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n"))
    refers = F.concat(F.lit("WARC-Refers-To: "), F.regexp_replace(
        F.md5(F.concat_ws("|", F.lit("capture"), "first", "digest", F.lit("1")).cast("binary")),
        r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>"), F.lit(f"\r\nWARC-Profile: {PROFILE}\r\n"))
    together = F.concat(F.lit("WARC-Concurrent-To: "), _urn("capture"), F.lit("\r\n"))
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    plain = F.concat(F.lit(f"{http}Content-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    marked = F.col("html").contains("WARC/1.1")
    answer = F.when(marked, F.concat(F.lit(f"{http}Transfer-Encoding: chunked\r\n\r\n"), _chunked(F.col("html")))).otherwise(
        F.concat(plain, F.col("html")))
    ask = F.concat(F.lit("GET "), F.when(F.col("url") != "", safe).otherwise("/"),
                   F.lit(" HTTP/1.1\r\n\r\n"))
    notes = F.concat(F.when(F.col("page_id").isNotNull(), F.concat(F.lit("page-id: "), F.col("pid"), F.lit("\r\n"))).otherwise(""),
                     F.lit("url: "), F.url_encode("url"), F.lit("\r\n"))

    def texts(rows: DataFrame, main: Column) -> DataFrame:
        return rows.select(F.explode(F.array(
            main, _record("request", _urn("request"), [uri, together], "application/http; msgtype=request", ask),
            _record("metadata", _urn("metadata"), [uri, together], "application/warc-fields", notes))).alias("value"))

    kind = "application/http; msgtype=response"
    return texts(answers, _record("response", _urn("capture"), [uri, digest], kind, answer)).union(
        texts(again, _record("revisit", _urn("capture"), [uri, digest, refers], kind, plain)))


def write_warc(pages: DataFrame, path: str, min_payload: int = MIN_PAYLOAD, compression: str = "gzip") -> None:
    """Write ``pages`` as WARC files in the folder ``path``."""
    captures_to_write(pages, min_payload).write.option("lineSep", END).option("compression", compression).text(path)


def _dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[line + 2:line + 2 + size])
        at = line + 4 + size


def _headers(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = block.partition(b"\r\n\r\n")
    pairs = (line.partition(b":") for line in head.split(b"\r\n"))
    return {k.strip().lower().decode("utf-8", "replace"): v.strip().decode("utf-8", "replace") for k, c, v in pairs if c}, rest


def parse_record(text: bytes, with_payload: bool) -> dict:
    """One record, from behind its version line; its length must agree with its header."""
    head, rest = _headers(text)
    length = int(head["content-length"])
    block = rest[:length]
    if len(block) < length or rest[length:].strip(b"\r\n"):
        raise ValueError(f"record {head.get('warc-record-id')}: {len(rest)} bytes where its header says {length}")
    kind = head["warc-type"]
    out = {"record_id": head["warc-record-id"], "type": kind, "concurrent_to": head.get("warc-concurrent-to"),
           "refers_to": head.get("warc-refers-to"), "target_uri": head.get("warc-target-uri"), "payload_bytes": None,
           "payload_digest": None, "fields": None, "payload": None}
    if kind in ("response", "revisit"):
        _, _, http_block = block.partition(b"\r\n")
        http, body = _headers(http_block)
        said = head.get("warc-payload-digest", "").partition(":")[2]
        if kind == "revisit":
            out |= {"payload_bytes": int(http["content-length"]) if "content-length" in http else None, "payload_digest": said}
        else:
            if http.get("transfer-encoding", "").lower() == "chunked":
                body = _dechunked(body)
            digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
            if said and said != digest:
                raise ValueError(f"record {out['record_id']}: its payload has digest {digest}, its header says {said}")
            out |= {"payload_bytes": len(body), "payload_digest": digest, "payload": body if with_payload else None}
    elif kind == "metadata":
        out["fields"] = list(_headers(block)[0].items())
    return out


def read_warc(spark, path: str, with_payload: bool = True) -> DataFrame:
    """One row for each record of the archives in ``path``: ``RECORD``'s columns, the payload only if asked for."""
    lines = spark.read.option("lineSep", VERSION).text(path).where("value != ''")
    schema = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.string()),
                        ("refers_to", pa.string()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = [parse_record(v.as_buffer().to_pybytes(), with_payload) for v in batch.column(0).slice(lo, 256)]
                yield pa.RecordBatch.from_pylist(rows, schema)

    return lines.mapInArrow(run, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row for each response or revisit: ``main``, its requests and its metadata records.

    Requests and metadata meet the record that WARC-Concurrent-To names, in one
    exchange of all records; a capture without either has an empty array there.
    Records that point to no capture belong to none; of repeated main records
    each has its row.
    """
    is_main = F.col("type").isin("response", "revisit")
    rest = [c for c in records.columns if c not in ("concurrent_to", "fields")]

    def beside(kind: str, name: str) -> Column:
        note = F.struct(F.col("record_id").alias("id"), F.map_entries("fields").alias("fields"))
        return F.sort_array(F.collect_list(F.when(F.col("type") == kind, note))).alias(name)

    met = (records.withColumn("capture", F.when(is_main, F.col("record_id")).otherwise(F.col("concurrent_to")))
           .where("capture is not null").groupBy(F.col("capture").alias("record_id"))
           .agg(F.collect_list(F.when(is_main, F.struct(*rest))).alias("mains"), beside("request", "requests"), beside("metadata", "metadata")))
    return met.select("record_id", F.explode("mains").alias("main"), "requests", "metadata")


def archived(pages: DataFrame, path: str, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to ``path``, read them back: one row per page.

    page_id, payload_bytes, payload_digest, record_type, refers_to.  A null html
    is an empty payload; a null url has no target URI; a null page_id is never
    the response of a group with others, and repeated rows are revisits of the
    first.  Other columns are ignored; an empty table gives an empty result.
    """
    write_warc(pages, path, min_payload)
    spark = pages.sparkSession
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = captures(read_warc(spark, path, with_payload=False).drop("payload"))
    note = F.map_from_entries(F.coalesce(F.try_element_at("metadata", F.lit(1)).getField("fields"), F.array()))
    rows = rows.select(F.try_element_at(note, F.lit("page-id")).cast(kind).alias("page_id"), "record_id", "main.payload_bytes",
                       "main.payload_digest", F.col("main.type").alias("record_type"),
                       # a key of its own that nothing has, so that responses don't meet under null
                       F.coalesce("main.refers_to", F.concat(F.lit("none "), "record_id")).alias("to"))
    # written, so that the archives are parsed once for both sides of the join
    rows = saved(rows, "captures")
    named = rows.where("record_type = 'response'").select(F.col("record_id").alias("to"), F.col("page_id").alias("refers_to"))
    return rows.join(named, "to", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_warc_captures(spark, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


OP8_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, min(page_id) OVER (PARTITION BY hex) AS first_id,
             list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
               (CAST('0x' || substr(hex, 1 + 5 * CAST(floor(i / 4) AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31
               AS INTEGER), 1)), 'string_agg', '') AS payload_digest
      FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
"""
