"""WARC archives with revisit records.

Headers are shuffled, payloads are not: the payload digest groups the records,
the one with the largest page id stays a response, and the digests that occur
more than once are joined back to the pages.  That table is written first, so
Spark sees its size before it chooses to broadcast it or to deal the pages out
by digest.  Archives are written as text whose line separator is the record
separator of the format, with fresh headers, and read back by a parser that
follows the lengths in the headers, so a payload may hold anything.

Defined cases: a null payload is empty; a record without a url has no target
header; a page without an id is a revisit of the largest id with its payload,
or a response where no such page has an id; rows that repeat the largest id are
each a response; an empty table gives empty archives; columns other than the
three named ones are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlink.session import checkpoint_root

from .common import bind, stage, take_columns, text_of

#: Fixed values of the format.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BREAK = "\r\n"
RECORD_END = "\r\n\r\n"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ROWS = 2000


def base32(hexdigest: Column) -> Column:
    """Base32 of a SHA-1 in hex: four characters for every five hex digits."""

    def four(k: int) -> Column:
        bits = F.conv(F.substring(hexdigest, 1 + 5 * k, 5), 16, 10).cast("int")
        return bind(bits, lambda b: F.concat(*[
            F.lit(BASE32).substr(F.shiftright(b, 15 - 5 * i).bitwiseAND(31) + 1, F.lit(1)) for i in range(4)]))

    return F.concat(*[four(k) for k in range(8)])


def _urn(hexdigest: Column) -> Column:
    parts = [F.substring(hexdigest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record_id(digest: Column, page_id: Column) -> Column:
    """Name of the one response of a payload, from what its revisits know too."""
    return _urn(F.md5(F.concat(F.lit("response:"), digest, F.lit(":"), page_id.cast("string"))))


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; a field that is null is left out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(BREAK)), F.lit(""))
                      for name, value in fields])


def resolved(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
             min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_bytes, digest (base32 SHA-1), refers_to
    (the response's page_id for a revisit, else null), single (of repeated
    payloads: whether one row alone has that page_id)."""
    own = take_columns(pages, page_id=id_col, url=url_col, payload=payload_col)
    own = own.withColumn("payload", text_of("payload"))
    own = own.withColumns({"sha1": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    headers = own.where(F.col("payload_bytes") >= min_bytes).select("sha1", "page_id")
    copies = (headers.groupBy("sha1", "page_id").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("sha1").agg(F.sum("n").alias("rows"), F.max("page_id").alias("original"),
                                   (F.max_by("n", "page_id") == 1).alias("single"))
              .where("rows > 1").select("sha1", "original", "single"))
    out = own.join(stage(copies, "copies"), "sha1", "left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return out.select("page_id", "url", "payload", "payload_bytes", base32(F.col("sha1")).alias("digest"),
                      F.when(revisit, F.col("original")).alias("refers_to"), "single")


def write_archives(records: DataFrame, folder: str) -> None:
    """Write the rows of :func:`resolved` as compressed archives."""
    is_revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(BREAK + BREAK))
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(F.lit(VERSION + BREAK), _lines(
        ("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", F.when(F.col("single") & ~is_revisit, _record_id(F.col("digest"), F.col("page_id"))).otherwise(
            F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">")))),
        ("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        ("WARC-Target-URI", F.regexp_replace("url", "[\\r\\n]+", "%0A")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Refers-To", F.when(is_revisit & F.col("single"), _record_id(F.col("digest"), F.col("refers_to")))),
        ("WARC-Profile", F.when(is_revisit, F.lit(REVISIT_PROFILE))),
        ("X-Page-ID", F.col("page_id")),
        ("X-Refers-To-Page-ID", F.col("refers_to")),
        ("X-Payload-Length", F.col("payload_bytes")),
        ("Content-Type", F.lit("application/http;msgtype=response")),
        ("Content-Length", F.octet_length("block"))), F.lit(BREAK))
    rows = records.withColumn("block", block).select(F.concat(head, F.col("block")).alias("value"))
    rows.write.option("lineSep", RECORD_END).option("compression", "gzip").text(folder)


def parse(lines: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record, from the lines of whole archives (split
    at line feeds, which are left out)."""
    source = iter(lines)
    for line in source:
        if line != f"{VERSION}\r".encode():
            raise ValueError(f"not the start of a record: {line[:80]!r}")
        headers = {}
        for line in source:
            if line == b"\r":
                break
            name, _, value = line.decode().rstrip("\r").partition(": ")
            headers[name] = value
        need, held, size = int(headers["Content-Length"]), [], 0
        while size < need + len(RECORD_END):
            line = next(source, None)
            if line is None:
                raise ValueError("an archive ends within a record")
            held.append(line)
            size += len(line) + 1
        block = b"\n".join(held) + b"\n"
        if size != need + len(RECORD_END) or block[need:] != RECORD_END.encode():
            raise ValueError(f"a record is not {need} bytes long")
        yield headers, block[:need]


def read_archives(spark: SparkSession, folder: str, id_type: str = "bigint", with_payload: bool = False) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type,
    refers_to, and with ``with_payload`` target_uri and payload (null for a
    revisit).  Lengths and digests of responses are taken from the payload read
    and held against the headers.

    A compressed archive is read by one task from start to end, line by line."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def lines() -> Iterator[bytes]:
            for b in batches:
                yield from b["value"]

        rows: list[tuple] = []
        for headers, block in parse(lines()):
            digest, size = headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["X-Payload-Length"])
            payload = None
            if headers["WARC-Type"] == "response":
                payload = block[block.index(b"\r\n\r\n") + 4:]
                found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if (found, len(payload)) != (digest, size):
                    raise ValueError(f"payload of record {headers['WARC-Record-ID']} does not match its header")
            rows.append((headers.get("X-Page-ID"), size, digest, headers["WARC-Type"], headers.get("X-Refers-To-Page-ID"),
                         headers.get("WARC-Target-URI"), payload)[:7 if with_payload else 5])
            if len(rows) >= ROWS or payload is not None and with_payload and len(payload) > 1 << 20:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=names)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "payload"]
    names = names[:7 if with_payload else 5]
    kinds = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string" + (
        ", target_uri string, payload binary" if with_payload else "")
    text = spark.read.option("lineSep", "\n").text(folder).select(F.col("value").cast("binary").alias("value"))
    return text.mapInPandas(run, kinds).withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
             min_bytes: int = 0) -> DataFrame:
    """Write the archives below the shared folder and return the rows read back."""
    folder = f"{checkpoint_root(pages.sparkSession).rstrip('/')}/llm-warc-{uuid.uuid4().hex}"
    rows = resolved(pages, id_col, url_col, payload_col, min_bytes)
    write_archives(rows, folder)
    return read_archives(pages.sparkSession, folder, rows.schema["page_id"].dataType.simpleString())
