import hashlib
import os

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from sievery.llm import warc

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                       T.StructField("html", T.StringType()), T.StructField("same", T.StringType()),
                       T.StructField("value", T.StringType())])
MAGIC = ("\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\n"
         "Content-Length: 5\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 1\r\n\r\nx\r\n\r\n")
LONG = "<p>" + "long payload é🙂 " * 100
PAGES = [(1, "http://a.org/1", "short"), (2, "http://a.org/2", "short"), (3, None, None), (4, "u", ""),
         (5, "http://a.org/5", LONG), (6, "x", LONG), (7, "y\r\nWARC-Type: fake", LONG + MAGIC + "end"),
         (8, "z", MAGIC), (9, "z", MAGIC * 40), (10, "w", "WARC/1.0\r\n"), (11, "w", LONG),
         (None, "n", LONG), (None, "n", "no id"), (12, "v", "\r\n\r\n"), (12, "v", "\r\n\r\n"),
         (13, "q", MAGIC * 40), (14, "e", "ends with WARC/1.0\r\n")]


def expected():
    best = {}
    for i, _, h in PAGES:
        if len((h or "").encode()) >= 1000 and i is not None:
            best[h] = max(best.get(h, i), i)
    out = []
    for i, _, h in PAGES:
        data = (h or "").encode()
        copies = sum(x[2] == h for x in PAGES)
        to = best.get(h) if copies > 1 else None
        to = None if to == i else to
        out.append((str(i), "revisit" if to is not None else "response", len(data),
                    hashlib.sha1(data).hexdigest(), to))
    return sorted(out, key=str)


def pages(spark, rows=PAGES):
    return spark.createDataFrame([Row(*r, "s", "v") for r in rows], SCHEMA).repartition(2)


def result(df):
    rows = df.collect()
    assert all(r.intact for r in rows)
    return sorted(((str(r.page_id), r.record_type, r.payload_bytes, r.payload_digest, r.refers_to)
                   for r in rows), key=str)


def test_round_trip_with_magic_inside_payloads(spark):
    path = warc.write(pages(spark))
    assert result(warc.read(spark, path)) == expected()


def test_small_splits(spark):
    """Records that span many splits, so the chain jumps from split to split."""
    path = warc.write(pages(spark))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("200", "1000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            assert result(warc.read(spark, path)) == expected()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_file_is_plain_warc(spark):
    path = warc.write(pages(spark, [(1, "http://a.org/", "hello")]).coalesce(1))
    text = spark.read.text(path, wholetext=True).filter("value <> ''").first()["value"]
    head, http, body = text.split("\r\n\r\n")[:3]
    assert head.startswith("WARC/1.0\r\nWARC-Type: response\r\n") and text.endswith("hello\r\n\r\n")
    assert f"Content-Length: {len(http) + 4 + 5}" in head and body == "hello"


def test_empty_table(spark):
    assert warc.read(spark, warc.write(pages(spark).limit(0))).count() == 0


def test_split_sizes_that_change_between_the_scans(spark, monkeypatch):
    path, key = warc.write(pages(spark)), "spark.sql.files.maxPartitionBytes"
    before, cuts, sizes = spark.conf.get(key), warc.cuts, iter(["100000", "300", "300"])

    def changing(*args):
        spark.conf.set(key, next(sizes))
        return cuts(*args)
    monkeypatch.setattr(warc, "cuts", changing)
    try:
        assert result(warc.read(spark, path)) == expected()
    finally:
        spark.conf.set(key, before)


def test_a_lost_record_raises(spark, monkeypatch):
    path, key = warc.write(pages(spark)), "spark.sql.files.maxPartitionBytes"
    before, cuts, sizes = spark.conf.get(key), warc.cuts, iter(["100000", "300", "100000"])

    def changing(*args):
        spark.conf.set(key, next(sizes))
        return cuts(*args)
    monkeypatch.setattr(warc, "cuts", changing)
    try:
        with pytest.raises(warc.ArchiveError, match="could not be put together"):
            warc.read(spark, path)
    finally:
        spark.conf.set(key, before)


def test_splits_are_fixed_for_the_scan_only(spark):
    key = "spark.sql.files.minPartitionNum"
    assert spark.conf.get(key, None) is None
    with warc.fixed_splits(spark):
        assert int(spark.conf.get(key)) >= 1
    assert spark.conf.get(key, None) is None


def test_a_last_record_before_other_text_is_read(spark, tmpdir_path):
    path = warc.write(pages(spark, [(1, "http://a.org/", "hello"), (2, "http://b.org/", "you")]).coalesce(1),
                      tmpdir_path + "/w")
    import glob
    for f in glob.glob(path + "/part-*"):
        with open(f, "ab") as out:
            out.write(b"trailing bytes")
    for f in glob.glob(path + "/.*.crc"):
        os.remove(f)
    assert sorted(r.page_id for r in warc.read(spark, path).collect()) == [1, 2]
