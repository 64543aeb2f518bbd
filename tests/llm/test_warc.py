"""The archive: exact bytes back, payloads once, damage found."""

import base64
import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from treeledger.llm import warc
from treeledger.llm.queries import ORACLES, QUERIES
from treeledger.session import scratch_path

PAGES = [
    (1, "http://a", "same"), (2, "http://b", "same"), (9, "http://c\r\nX: y", "same"), (3, None, None), (4, "u", ""),
    (5, "é", "WARC/1.1\r\n\r\nWARC-Type: trap"), (6, "f", "x" * 300_000), (None, "g", "lone"), (9, "http://c\r\nX: y", "same"),
]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id long, url string, html string, digest string")


@pytest.fixture()
def archive(spark, pages):
    path = scratch_path(spark, "test-warc")
    warc.write_archive(warc.records(pages), path)
    return path


def test_records_come_back(spark, archive):
    got = warc.read_archive(spark, archive).collect()
    assert sorted(bytes(r.payload) for r in got) == sorted((p[2] or "").encode() for p in PAGES)
    bodies = spark.read.parquet(f"{archive}/payloads").collect()
    assert len(bodies) == len({p[2] or "" for p in PAGES})  # each payload once
    for r in got:
        assert hashlib.sha256(r.payload).hexdigest() == r.digest


def test_kinds(spark, pages):
    found = {(r.page_id, r.refers_to) for r in warc.records(pages).collect()}
    assert found == {(1, 9), (2, 9), (9, None), (3, 4), (4, None), (5, None), (6, None), (None, None)}
    long_only = {(r.page_id, r.refers_to) for r in warc.records(pages, least_bytes=5).collect()}
    assert all(refers is None for _, refers in long_only)


def test_digest(spark):
    rows = [(b"",), (b"abc",), (os.urandom(1000),)]
    for r in spark.createDataFrame(rows, "b binary").select("b", warc.sha1_base32(F.col("b")).alias("d")).collect():
        assert r.d == base64.b32encode(hashlib.sha1(r.b).digest()).decode()


def test_damage_is_found(spark, pages):
    path = scratch_path(spark, "test-warc")
    found = warc.records(pages)
    warc.write_archive(found.withColumn("payload", F.when(F.col("page_id") == 6, F.lit(b"y")).otherwise(F.col("payload"))), path)
    with pytest.raises(Exception, match="does not have the digest"):
        warc.read_archive(spark, path).collect()
    path = scratch_path(spark, "test-warc")
    warc.write_archive(found.withColumn("payload", F.when(F.col("page_id") != 6, F.col("payload"))), path)
    with pytest.raises(Exception, match="no payload"):
        warc.read_archive(spark, path).collect()


def test_files(spark, archive, tmp_path):
    rows = warc.read_archive(spark, archive).select(warc.original_bytes(F.col("header"), F.col("payload")).alias("b")).collect()
    records = sorted(bytes(r.b) for r in rows)
    (tmp_path / "plain.warc").write_bytes(b"".join(records[:4]))
    (tmp_path / "zipped.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records[4:]))
    read = warc.read_files(spark, str(tmp_path))
    again = scratch_path(spark, "test-warc")
    warc.write_archive(warc.from_files(read), again)
    back = warc.read_archive(spark, again)
    assert sorted(bytes(r.b) for r in back.select(warc.original_bytes(F.col("header"), F.col("payload")).alias("b")).collect()) == records
    assert sorted(bytes(r.payload) for r in back.collect()) == sorted((p[2] or "").encode() for p in PAGES)
    with pytest.raises(ValueError):
        list(warc.split_records(records[0][:-3]))


def test_query_and_empty_table(spark, sf_dir, pages):
    assert difference(QUERIES["op8_warc"](spark, sf_dir), connect(sf_dir), ORACLES["op8_warc"]) is None
    path = scratch_path(spark, "test-warc")
    warc.write_archive(warc.records(pages.limit(0)), path)
    assert warc.read_archive(spark, path).collect() == []
