import base64
import gzip
import hashlib
import re
import uuid

import duckdb
import pytest
from frames import SF, table
from pyspark.sql import functions as F

from eventlink.llm import oracles
from eventlink.llm.warc import archives, base32, parse, read_archives, resolved, write_archives

PAGES = "page_id long, url string, html string"


def slow(rows, least=0):
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = max(same, default=None)
        revisit = len(raw) >= least and first is not None and page != first
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page, len(raw), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (9, None, "<p>one</p>"), (3, "u\r\nX: y", None), (4, "", ""),
        (5, "http://b", "WARC/1.1\r\n\r\n\r\nWARC-Type: response\r\n\r\n"), (6, "x", "\n\n\r\n\r\n"), (7, "x", "\r"), (8, "é", "ü\x00\x1cß 😀\r\n"),
        (10, "t", "tie"), (10, "t", "tie"), (None, "n", "tie"), (None, "n", "alone"), (None, "n", "alone"), (11, "l", "long " * 100_000)]


@pytest.mark.parametrize("least", [0, 4])
def test_edge_cases(spark, least):
    df = spark.createDataFrame(ROWS, PAGES).withColumns({c: F.lit("x") for c in ("sha1", "payload", "original", "digest")})
    got = sorted((tuple(r) for r in archives(df, min_bytes=least).collect()), key=str)
    assert got == slow(ROWS, least)
    assert archives(df.limit(0)).count() == 0


def test_archives_are_warc(spark, tmp_path):
    df = spark.createDataFrame(ROWS, PAGES)
    folder = f"file://{tmp_path}/warc"
    write_archives(resolved(df).repartition(3), folder)
    found, ids, refers = [], {}, []
    for f in sorted((tmp_path / "warc").glob("*.gz")):
        data = gzip.decompress(f.read_bytes())
        for headers, block in parse(data.split(b"\n")[:-1]):
            assert headers["WARC-Type"] in ("response", "revisit")
            assert uuid.UUID(re.fullmatch("<urn:uuid:(.*)>", headers["WARC-Record-ID"])[1]).int
            ids[headers["WARC-Record-ID"]] = headers
            assert block.startswith(b"HTTP/1.1 200 OK\r\n")
            if headers["WARC-Type"] == "revisit":
                assert block.endswith(b"\r\n\r\n") and headers["WARC-Profile"]
                refers.append(headers)
            found.append(headers["WARC-Type"])
    assert sorted(found) == sorted(x[3] for x in slow(ROWS))
    assert len(ids) == len(found)  # pages without an id and repeated ids too
    for headers in refers:  # two responses of page 10 hold "tie": neither is named
        one = ids.get(headers.get("WARC-Refers-To"))
        assert (one is None) == (headers["X-Refers-To-Page-ID"] == "10")
        assert one is None or (one["WARC-Type"], one["X-Page-ID"], one["WARC-Payload-Digest"]) == (
            "response", headers["X-Refers-To-Page-ID"], headers["WARC-Payload-Digest"])
    back = read_archives(spark, folder, with_payload=True).collect()
    pages = {p: (h or "").encode() for p, _, h in ROWS if p is not None}
    for r in back:
        if r["record_type"] == "response" and r["page_id"] is not None:
            assert bytes(r["payload"]) == pages[r["page_id"]]
    assert sum(r["payload"] is None for r in back) == found.count("revisit")


def test_damaged_archives_raise():
    good = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in parse(good.split(b"\n")[:-1])] == [b"abc"]
    for bad in (good[:-2], good.replace(b"3", b"2"), good.replace(b"3", b"9"), b"x" + good):
        with pytest.raises(ValueError):
            list(parse(bad.split(b"\n")[:-1]))


def test_base32(spark):
    rows = [(hashlib.sha1(str(i).encode()).hexdigest(), base64.b32encode(hashlib.sha1(str(i).encode()).digest()).decode())
            for i in range(40)]
    got = spark.createDataFrame(rows, "h string, want string").select(base32(F.col("h")), "want").collect()
    assert all(a == b for a, b in got)


def test_oracle_on_the_smallest_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = con.execute(oracles.WARC_RECORDS).fetchall()
    got = [tuple(r) for r in archives(table(spark, "pages")).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) == slow([tuple(r) for r in table(spark, "pages").collect()])
