"""The delivery ledger and the payload sink as a data source."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sievery.sinks import datasource, delivery, ledger


def payloads(spark, n=30, copies=1):
    rows = spark.range(n).selectExpr(
        "'posts' AS kind", "'T' AS team_id", "concat('C', id) AS channel", "0L AS chunk", "'u' AS url",
        "1L AS n_items", "concat('[', id, ']') AS body", "sha2(cast(id AS string), 256) AS key")
    for _ in range(copies - 1):
        rows = rows.unionByName(rows)
    return rows


def noting(path, attempt=1):
    """A service that writes down every call and refuses as ``recovering_service``."""
    answer = ledger.recovering_service(attempt)

    def deliver(url, body, key):
        with open(f"{path}/{key}", "a") as f:
            f.write(f"{attempt}\n")
        return answer(url, body, key)
    return deliver


def calls(path):
    return {k: len(open(f"{path}/{k}").read().split()) for k in os.listdir(path)}


def refusals(key):
    h = int(key[:8], 16)
    return (h % 3 == 0) + (h % 9 == 0)


def test_every_key_is_accepted_once(spark, tmpdir_path):
    os.makedirs(tmpdir_path + "/calls")
    book = ledger.Ledger(spark, tmpdir_path + "/book")
    p = payloads(spark, 60)
    assert book.log().count() == 0 and book.state().count() == 0
    assert book.deliver(p, lambda a: noting(tmpdir_path + "/calls", a)) == 60
    keys = [r.key for r in p.collect()]
    assert calls(tmpdir_path + "/calls") == {k: 1 + refusals(k) for k in keys}
    got = {r.key: (r.attempts, r.accepted, r.status) for r in book.state().collect()}
    assert got == {k: (1 + refusals(k), 1, "OK") for k in keys}
    assert book.log().count() == sum(1 + refusals(k) for k in keys)      # nothing is overwritten
    assert book.deliver(p, lambda a: noting(tmpdir_path + "/calls", a)) == 60
    assert calls(tmpdir_path + "/calls") == {k: 1 + refusals(k) for k in keys}


def test_attempts_run_out(spark, tmpdir_path):
    book = ledger.Ledger(spark, tmpdir_path)
    with pytest.raises(delivery.DeliveryError):
        book.deliver(payloads(spark, 60), ledger.recovering_service, most=2)
    left = {r.key for r in book.pending(payloads(spark, 60)).collect()}
    assert left == {r.key for r in payloads(spark, 60).collect() if refusals(r.key) == 2} and left


def test_repeated_keys_and_other_batches(spark, tmpdir_path):
    os.makedirs(tmpdir_path + "/calls")
    book, three = ledger.Ledger(spark, tmpdir_path + "/book"), noting(tmpdir_path + "/calls", 3)
    book.attempt(payloads(spark, 10, copies=3), three, batch_id=1)
    assert set(calls(tmpdir_path + "/calls").values()) == {1}
    book.attempt(payloads(spark, 12), three, batch_id=2, everywhere=True)       # two new ones
    assert len(calls(tmpdir_path + "/calls")) == 12 and set(calls(tmpdir_path + "/calls").values()) == {1}
    assert (book.log(1).count(), book.log(2).count(), book.check()) == (10, 2, 12)
    book.attempt(payloads(spark, 12), three, batch_id=3)                        # looks at its own batch only
    assert set(calls(tmpdir_path + "/calls").values()) == {2}
    assert {(r.attempts, r.accepted) for r in book.state().collect()} == {(2, 2)}


def test_a_sink_that_dies_between_delivery_and_check(spark, tmpdir_path, monkeypatch):
    os.makedirs(tmpdir_path + "/calls")
    sink = delivery.batch_sink(tmpdir_path + "/out", deliver=noting(tmpdir_path + "/calls", 1))
    check = ledger.Ledger.check
    monkeypatch.setattr(ledger.Ledger, "check", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        sink(payloads(spark, 60), 7)
    monkeypatch.setattr(ledger.Ledger, "check", check)
    again = delivery.batch_sink(tmpdir_path + "/out", deliver=noting(tmpdir_path + "/calls", 3))
    again(payloads(spark, 60), 7)                                               # the replay
    keys = [r.key for r in payloads(spark, 60).collect()]
    assert calls(tmpdir_path + "/calls") == {k: 1 + (refusals(k) > 0) for k in keys}
    book = ledger.Ledger(spark, tmpdir_path + "/out-receipts")
    assert book.check() == 60 and {r.accepted for r in book.state().collect()} == {1}


def test_an_attempt_that_left_no_receipts_is_written_anew(spark, tmpdir_path):
    os.makedirs(tmpdir_path + "/batch_id=0/attempt=1/_temporary/0")
    book = ledger.Ledger(spark, tmpdir_path)
    assert book.attempt(payloads(spark, 5), delivery.accepting_service) == 1
    assert book.attempt(payloads(spark, 5), delivery.accepting_service) == 2
    assert book.log().count() == 5


# ---------------------------------------------------------------- data source

OK = "sievery.sinks.delivery:accepting_service"
SOME = "sievery.sinks.delivery:selective_service"


def write(df, path, service, **options):
    datasource.register(df.sparkSession)
    w = df.write.format(datasource.FORMAT).mode("append").option("path", path).option("service", service)
    w.options(**options).save()


def test_written_receipts_equal_delivered_ones(spark, tmpdir_path):
    p = payloads(spark, 40).repartition(4)
    write(p, tmpdir_path, SOME, failOnRefusal="false")
    write(p.limit(0), tmpdir_path, SOME)                                        # nothing to deliver
    got = datasource.read_receipts(spark, tmpdir_path)
    want = delivery.deliver_payloads(p, delivery.selective_service)
    assert got.columns == delivery.RECEIPTS.names
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    for response in ('{"received":1}', '{"received":"1"}', '{"received":true}', "x", '{"received":1.5}', "[]",
                     '{"received":null}', None):
        row = spark.createDataFrame([(response,)], "r string").select(
            delivery.response_status(F.col("r")).alias("s")).first()
        assert datasource._accepted(response) == (row.s == "OK"), response


def test_refusals_fail_the_job_and_accepted_ones_stay_known(spark, tmpdir_path):
    with pytest.raises(Exception, match="not accepted"):
        write(payloads(spark, 40), tmpdir_path, SOME)
    got = datasource.read_receipts(spark, tmpdir_path)
    assert got.count() == 40 and 0 < got.filter("status = 'OK'").count() < 40


def test_an_aborted_job_publishes_nothing(spark, tmpdir_path):
    p = payloads(spark, 40).repartition(4, "key").withColumn(
        "body", F.when(F.col("channel") == "C7", F.raise_error(F.lit("lost"))).otherwise(F.col("body")))
    with pytest.raises(Exception, match="lost"):
        write(p, tmpdir_path, OK)
    assert not os.path.exists(tmpdir_path + "/published")
    write(payloads(spark, 5), tmpdir_path, OK)
    assert datasource.read_receipts(spark, tmpdir_path).count() == 5


def test_a_stream_publishes_under_its_batch(spark, tmpdir_path):
    datasource.register(spark)
    for part in range(3):
        payloads(spark, 30).filter(F.col("channel").substr(2, 9).cast("int") % 3 == part).coalesce(1).write.mode(
            "append").parquet(tmpdir_path + "/in")
    schema = payloads(spark, 1).schema

    def run():
        q = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(tmpdir_path + "/in")
             .writeStream.format(datasource.FORMAT).option("path", tmpdir_path + "/out").option("service", OK)
             .option("checkpointLocation", tmpdir_path + "/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
    run()
    assert sorted(os.listdir(tmpdir_path + "/out/published")) == ["batch-0", "batch-1", "batch-2"]
    got = datasource.read_receipts(spark, tmpdir_path + "/out")
    assert got.count() == got.select("key").distinct().count() == 30
    payloads(spark, 33).filter("channel IN ('C30', 'C31', 'C32')").write.mode("append").parquet(tmpdir_path + "/in")
    run()
    assert datasource.read_receipts(spark, tmpdir_path + "/out").count() == 33


def test_a_stream_stops_at_refusals(spark, tmpdir_path):
    datasource.register(spark)
    payloads(spark, 40).write.parquet(tmpdir_path + "/in")
    q = (spark.readStream.schema(payloads(spark, 1).schema).parquet(tmpdir_path + "/in")
         .writeStream.format(datasource.FORMAT).option("path", tmpdir_path + "/out").option("service", SOME)
         .option("checkpointLocation", tmpdir_path + "/checkpoint").trigger(availableNow=True).start())
    with pytest.raises(StreamingQueryException):
        q.awaitTermination()
    assert datasource.read_receipts(spark, tmpdir_path + "/out").count() == 40


def test_options_are_needed_and_overwriting_is_refused(spark, tmpdir_path):
    datasource.register(spark)
    with pytest.raises(Exception, match="path and service"):
        payloads(spark, 1).write.format(datasource.FORMAT).mode("append").save()
    with pytest.raises(Exception, match="mode append"):
        payloads(spark, 1).write.format(datasource.FORMAT).mode("overwrite").option(
            "path", tmpdir_path).option("service", OK).save()


def test_a_task_holds_one_body_as_a_text(spark, tmpdir_path):
    """However many bodies a batch has; and batches of payloads are small."""
    import tracemalloc

    import pyarrow as pa

    rows = {c: ["x"] * 32 for c in ("kind", "team_id", "channel", "key", "url")}
    batch = pa.RecordBatch.from_pydict({**rows, "chunk": [0] * 32, "n_items": [1] * 32, "body": ["[" + "1" * (1 << 20) + "]"] * 32})
    writer = datasource.BatchWriter({"path": tmpdir_path, "service": "tests.test_ledger_writer:received"})
    tracemalloc.start()
    try:
        assert writer.write(iter([batch])).rows == 32
        assert tracemalloc.get_traced_memory()[1] < 6 << 20
    finally:
        tracemalloc.stop()
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        for now, then in ((str(64 << 20), delivery.BATCH_BYTES), ("67108864b", delivery.BATCH_BYTES), ("1000", 1000)):
            spark.conf.set(key, now)
            datasource.register(spark)
            assert int(spark.conf.get(key)) == then
    finally:
        spark.conf.set(key, before)


def received(url, body, key):
    return '{"received": 1}'
