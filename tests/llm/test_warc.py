"""Operator 3: round trips, splitting, pushed predicates, skipped payloads."""

import gzip
import io
import re

from pyspark.sql import functions as F

from tessera.llm import warc

LONG = "é<p>" * 100


def _pages(spark):
    rows = [(1, "http://a/\r\nX: y", LONG), (2, None, LONG), (3, "u", "short"), (4, "v", "short"),
            (5, "w", None), (None, "n", LONG), (1, "http://a/", LONG), (6, "x", "z" * 300_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "record_type", F.lit("clash"))


def test_round_trip_of_odd_rows(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_pages(_pages(spark).repartition(3), path, split_bytes=300)
    back = warc.read_warc(spark, path)
    assert back.rdd.getNumPartitions() >= 3
    rows = sorted(((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes, r.payload)
                   for r in back.collect()), key=str)
    assert rows == sorted([
        (0, "revisit", 1, 500, None), (1, "response", None, 500, LONG),
        (1, "response", None, 500, LONG), (2, "revisit", 1, 500, None),
        (3, "response", None, 5, "short"), (4, "response", None, 5, "short"),
        (5, "response", None, 0, ""), (6, "response", None, 300_000, "z" * 300_000)], key=str)


def test_predicates_are_pushed_and_payloads_skipped(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_pages(_pages(spark), path)
    some = warc.read_warc(spark, path, "skip").filter(
        (F.col("record_type") == "response") & (F.col("page_id") > 3))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"\bFilter\b", plan)
    assert sorted((r.page_id, r.payload) for r in some.collect()) == [(4, None), (5, None), (6, None)]
    other = warc.read_warc(spark, path, "skip").filter(F.col("page_id").isin(2, 3)).collect()
    assert sorted(r.page_id for r in other) == [2, 3]
    reader = warc.WarcReader(path, "skip")
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"),
                                    warc.EqualTo(("payload",), "x")]))
    assert len(left) == 1 and len(reader.tests) == 1


def test_unwanted_payloads_are_not_inflated():
    data = warc.member(warc.record(1, "u", "response", None, 1 << 20, "0", b"ab" * (1 << 19)))
    two = data + warc.member(warc.record(2, "u", "response", None, 2, "0", b"hi"))
    read = [0]

    class Counting(io.BytesIO):
        def read(self, n=-1):
            out = super().read(n)
            read[0] += len(out)
            return out

    assert [r.row["page_id"] for r in warc.records(Counting(two), 0, len(two))] == [1, 2]
    assert read[0] <= 2 * 4096
    assert gzip.decompress(two).count(b"WARC/1.1") == 2  # any gzip reader can read the file
    assert [r.payload() for r in warc.records(io.BytesIO(two), 0, len(two))][1] == b"hi"


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_pages(_pages(spark).limit(0), path)
    assert warc.read_warc(spark, path).count() == 0
