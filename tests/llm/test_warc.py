import base64
import hashlib

import duckdb

from lakeweave.llm import warc
from lakeweave.llm.oracle import oracle_sql
from lakeweave.llm.queries import op4_warc

from .conftest import SF_CHECK


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_CHECK}/pages.parquet'")
    expected = sorted(con.execute(oracle_sql()["op4_warc"]).fetchall())
    assert sorted(map(tuple, op4_warc(spark, SF_CHECK).collect())) == expected


def test_copies_nulls_and_repeats(spark):
    rows = [(5, "u5", "same"), (3, "u3", "same"), (9, None, "same"), (3, "u3", "same"), (None, "u", "same"), (None, None, None)]
    rows += [(1, "a b\r\nc", None), (2, "", ""), (4, "http://x", "é" * 50_000), (-7, "x", "\r\n\r\nWARC/1.1")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS sha256", "2 AS head", "3 AS size")
    path = warc.write_archive(pages)
    got = sorted(map(tuple, warc.read_archive(spark, path).drop("target_uri").collect()), key=str)

    def row(page, html, first):
        data = (html or "").encode()
        return page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if first is not None else "response", first

    expected = [row(5, "same", 3), row(3, "same", None), row(9, "same", 3), row(3, "same", None), row(None, "same", 3)]
    expected += [row(None, None, 1), row(1, None, None), row(2, "", 1), row(4, "é" * 50_000, None), row(-7, "\r\n\r\nWARC/1.1", None)]
    assert got == sorted(expected, key=str)
    assert spark.read.parquet(f"{path}/payloads").count() == 4  # each payload once
    for r in warc.rebuilt_records(spark, path).collect():
        headers, body = warc.parse_record(bytes(r["record"]))
        if headers["WARC-Type"] == b"response":
            assert "sha1:" + warc.sha1_base32(body) == headers["WARC-Payload-Digest"].decode()
        else:
            assert body == b"" and b"Content-Length" not in body
    small = warc.read_archive(spark, warc.write_archive(pages, min_revisit=100)).where("record_type = 'revisit'")
    assert small.count() == 0


def test_a_changed_payload_is_refused(spark):
    path = warc.write_archive(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"))
    damaged = path + "-damaged"
    spark.read.parquet(f"{path}/records").write.parquet(f"{damaged}/records")
    spark.read.parquet(f"{path}/payloads").selectExpr("sha256", "cast('abd' AS binary) AS payload").write.parquet(f"{damaged}/payloads")
    try:
        warc.read_archive(spark, damaged).collect()
    except Exception as e:
        assert "fails its digest" in str(e)
    else:
        raise AssertionError("a damaged payload was accepted")


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archive(spark, warc.write_archive(pages)).count() == 0
