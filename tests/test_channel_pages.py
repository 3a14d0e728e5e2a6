"""The source that is split by channel ids."""

import os

import pytest
from pyspark.sql import functions as F

from sievery.sources import channelpages as CP
from sievery.sources import landing, pages
from sievery.sources import tables as T

SMALL = "/root/testdata/sf0.001"


def lines(spark, rows):
    return spark.createDataFrame(rows, "channel string, value string")


def page(*texts):
    return '{"ok":true,"messages":[' + ",".join('{"ts":"1.5","text":"%s"}' % t for t in texts) + "]}"


@pytest.mark.parametrize("n, k", [(10, 10), (10, 9), (5, 3), (1, 4), (7, 1), (103, 8)])
def test_groups_cover_each_id_once_in_near_equal_sizes(n, k):
    ids = [f"C{i:03}" for i in range(n)]
    got = CP.groups(ids, k)
    assert [i for g in got for i in g] == ids and len(got) == min(n, k)
    assert max(map(len, got)) - min(map(len, got)) <= 1


def test_same_rows_as_the_page_reader_and_one_split_per_channel(spark, tmpdir_path):
    made = landing.history_page_lines(T.load_messages(spark, SMALL), page_size=50)
    CP.land_channel_folders(made, tmpdir_path + "/split", 0)
    landing.land_history_pages(T.load_messages(spark, SMALL), tmpdir_path + "/flat", page_size=50)
    read = CP.read_channel_pages(spark, tmpdir_path + "/split", 4)
    assert read.rdd.getNumPartitions() == 4
    a = pages.valid_canonical(pages.wire_messages(read))
    b, _ = pages.read_history(spark, tmpdir_path + "/flat")
    cols = ["channel", "seq", "ts", "text", "raw"]
    assert sorted(map(str, a.select(*cols).collect())) == sorted(map(str, b.select(*cols).collect()))
    per = read.withColumn("split", F.spark_partition_id()).groupBy("channel").agg(
        F.count_distinct("split").alias("n")).collect()
    assert len(per) == T.load_messages(spark, SMALL).select("channel").distinct().count() > 4
    assert {r.n for r in per} == {1}


def test_odd_channel_names_faulty_lines_and_unfinished_landings(spark, tmpdir_path):
    CP.land_channel_folders(lines(spark, [("a/b c=1", page("x", "ü")), ("Ω", "no page"), ("Ω", page("y")),
                                          ("e", '{"ok":false,"error":"denied"}')]), tmpdir_path, 3)
    os.makedirs(tmpdir_path + "/landing=4/channel=q")
    with open(tmpdir_path + "/landing=4/channel=q/part-0", "w") as f:
        f.write(page("not yet") + "\n")
    read = CP.read_channel_pages(spark, tmpdir_path, 2)
    got = pages.wire_messages(read).select("channel", F.col("m.text").alias("t")).collect()
    assert sorted(map(tuple, got)) == [("a/b c=1", "x"), ("a/b c=1", "ü"), ("Ω", "y")]
    faults = pages.rejected_texts(read).select("key", "reason", "text").collect()
    assert sorted(map(str, map(tuple, faults))) == [
        "('e', 'denied', None)", "('Ω', 'malformed page', 'no page')"]
    open(tmpdir_path + "/landing=4/_SUCCESS", "w").close()
    assert CP.read_channel_pages(spark, tmpdir_path, 2).filter("channel = 'q'").count() == 1


def test_nothing_landed_and_missing_options(spark, tmpdir_path):
    assert CP.read_channel_pages(spark, tmpdir_path + "/none").count() == 0
    with pytest.raises(Exception, match="option path"):
        spark.read.format(CP.FORMAT).load().count()
    with pytest.raises(Exception, match="0 groups"):
        CP.read_channel_pages(spark, tmpdir_path, 0).count()


def test_a_stream_goes_on_behind_its_offset(spark, tmpdir_path):
    path, out = tmpdir_path + "/in", tmpdir_path + "/out"

    def run():
        df = pages.wire_messages(CP.stream_channel_pages(spark, path, 3, max_landings=1)).select(
            "channel", F.col("m.text").alias("text"))
        q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-ck")
             .start())
        q.processAllAvailable()
        ended = [p["batchId"] for p in q.recentProgress if p["numInputRows"]]
        q.stop()
        return ended, sorted(map(tuple, spark.read.schema("channel string, text string").parquet(out).collect()))
    for n in range(3):
        CP.land_channel_folders(lines(spark, [(f"C{i}", page(f"{n}-{i}")) for i in range(4)]), path, n)
    ended, got = run()
    assert len(ended) == 3 and got == sorted((f"C{i}", f"{n}-{i}") for n in range(3) for i in range(4))
    ended, again = run()
    assert ended == [] and again == got
    CP.land_channel_folders(lines(spark, [("C9", page("late"))]), path, 7)
    ended, got = run()
    assert len(ended) == 1 and len(got) == 13 and ("C9", "late") in got
