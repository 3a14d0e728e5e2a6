import pytest

from sievery.llm import common


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_unique_equals_a_join_whatever_is_hot(spark, how):
    rows = spark.createDataFrame([("hot", i) for i in range(3000)] + [(f"k{i % 700}", i) for i in range(2000)]
                                 + [(None, 1), ("", 2), ("x" * 5000, 3), ("x" * 5000, 4)], "key string, v int")
    table = rows.filter("key IS NOT NULL AND key <> 'k5'").groupBy("key").count().selectExpr(
        "key", "count AS weight", "concat(key, '!') AS named")
    got = common.join_unique(rows, table, "key", "weight", rows.count(), how)
    plain = rows.join(table.drop("weight"), "key", how)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_free_name_avoids_clashes_in_any_case(spark):
    df = spark.createDataFrame([(1, 2)], "Lines int, own int")
    assert common.free_name(df, "lines").lower() not in ("lines", "own")
    assert common.free_name(df, "other") == "other"


def test_batches_are_bounded_and_never_widened(spark):
    keys = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[1], "50000")
        common.bounded_batches(spark)
        assert [spark.conf.get(k) for k in keys] == [str(16 << 20), "1000"]
        spark.conf.set(keys[1], "10")
        common.bounded_batches(spark)
        assert spark.conf.get(keys[1]) == "10"
    finally:
        for k, v in zip(keys, before, strict=True):
            spark.conf.set(k, v)
