"""SNK-1..SNK-4 as a Spark data source: ``df.write.format("payload_delivery")`` and
``writeStream`` deliver payloads and publish receipts.

Register it once per session (``register``).  Options: ``path`` (a folder of shared
storage for the receipts), ``service`` (``package.module:function``, called in the
tasks as ``(url, body, key) -> response``), ``failOnRefusal`` (default true, R-2).

A task delivers its rows one after the other, in Arrow batches of few bodies, and writes their receipts as a file of
its own below ``path/staged``; its commit message holds the file's name and two
counts only.  ``commit`` publishes the names of the files of the successful tasks in
one small file below ``path/published`` and then, if any payload was refused, fails
the job: what was accepted stays known.  ``abort`` publishes nothing and removes the
files that it is told of; files of tasks that died are never published.  A stream
publishes under its batch id, so a batch that is replayed replaces its receipts.

``read_receipts`` gives the receipts of published files: the names are joined to
the files' rows, so nothing of them passes through the driver.
"""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage,
)

from ..functions.responses import response_status
from .delivery import RECEIPTS, DeliveryError, bounded_batches

FORMAT = "payload_delivery"
COLUMNS = ["kind", "team_id", "channel", "chunk", "key", "url", "n_items"]
STAGED = pa.schema([(c, pa.int64() if c in ("chunk", "n_items") else pa.string())
                    for c in [*COLUMNS, "response"]])
FLUSH = 10_000                # receipts that a task holds


@dataclass
class Staged(WriterCommitMessage):
    """One task's file of receipts."""

    name: str
    rows: int
    refused: int


def _store(path: str) -> tuple[fs.FileSystem, str]:
    system, at = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return system, at.rstrip("/")


def _accepted(response: str) -> bool:
    """R-1 in the task, for the count of refusals: ``received`` is a whole number."""
    try:
        found = json.loads(response)
    except (TypeError, ValueError):
        return False
    value = found.get("received") if isinstance(found, dict) else None
    return isinstance(value, int) and not isinstance(value, bool)


class _Delivery:
    """What the batch and the stream writer share; it travels to the tasks."""

    def __init__(self, options: dict) -> None:
        if not options.get("path") or not options.get("service"):
            raise ValueError("payload_delivery needs the options path and service")
        self.path, self.service = options["path"], options["service"]
        self.strict = options.get("failonrefusal", options.get("failOnRefusal", "true")).lower() != "false"
        self.name = uuid.uuid4().hex

    def _deliver(self) -> Callable[[str, str, str], str]:
        module, _, function = self.service.partition(":")
        return getattr(importlib.import_module(module), function)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        deliver, (system, root) = self._deliver(), _store(self.path)
        name, rows, refused = f"{uuid.uuid4().hex}.parquet", 0, 0
        system.create_dir(f"{root}/staged", recursive=True)
        with system.open_output_stream(f"{root}/staged/{name}") as out, pq.ParquetWriter(out, STAGED) as file:
            for batch in iterator:
                held = []
                bodies = batch.column("body")
                rest = zip(*(batch.column(c).to_pylist() for c in COLUMNS), strict=True)
                for body, known in zip(bodies, rest, strict=True):      # one body at a time as a text
                    try:
                        response = deliver(known[5], body.as_py(), known[4])
                    except Exception as exc:  # noqa: BLE001 - any failure is a reject
                        response = f"delivery failed: {type(exc).__name__}: {exc}"
                    rows, refused = rows + 1, refused + (not _accepted(response))
                    held.append((*known, response))
                    if len(held) == FLUSH:
                        file.write_table(self._table(held))
                        held = []
                if held:
                    file.write_table(self._table(held))
        return Staged(name, rows, refused)

    @staticmethod
    def _table(rows: list[tuple]) -> pa.Table:
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), STAGED,
                                                                         strict=True)], schema=STAGED)

    def publish(self, name: str, messages: list) -> None:
        system, root = _store(self.path)
        system.create_dir(f"{root}/published", recursive=True)
        done = [m for m in messages if m is not None]
        with system.open_output_stream(f"{root}/published/{name}") as out:
            out.write("".join(f"{m.name}\n" for m in done).encode())
        refused = sum(m.refused for m in done)
        if refused and self.strict:
            raise DeliveryError(f"{refused} of {sum(m.rows for m in done)} payload(s) not accepted")

    def withdraw(self, name: str, messages: list) -> None:
        system, root = _store(self.path)
        if system.get_file_info(f"{root}/published/{name}").type != fs.FileType.NotFound:
            return                                    # commit published, then failed the job
        for m in messages:
            if m is not None and system.get_file_info(f"{root}/staged/{m.name}").type != fs.FileType.NotFound:
                system.delete_file(f"{root}/staged/{m.name}")


class BatchWriter(_Delivery, DataSourceArrowWriter):
    def commit(self, messages: list) -> None:
        self.publish(f"write-{self.name}", messages)

    def abort(self, messages: list) -> None:
        self.withdraw(f"write-{self.name}", messages)


class StreamWriter(_Delivery, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self.publish(f"batch-{batchId}", messages)

    def abort(self, messages: list, batchId: int) -> None:
        self.withdraw(f"batch-{batchId}", messages)


class PayloadDelivery(DataSource):
    """The sink; its rows are payloads (``sinks.delivery.PAYLOAD``)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> BatchWriter:
        if overwrite:
            raise ValueError("receipts are a log: use mode append")
        return BatchWriter(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> StreamWriter:
        return StreamWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    """The source's name, and small batches of payloads for its tasks."""
    bounded_batches(spark)
    spark.dataSource.register(PayloadDelivery)


def read_receipts(spark: SparkSession, path: str) -> DataFrame:
    """The published receipts, with their status (``RECEIPTS``)."""
    path = path.rstrip("/")
    names = spark.read.text(f"{path}/published").select(F.col("value").alias("_name")).distinct()
    staged = [f for f in RECEIPTS.fields if f.name != "status"]
    rows = (spark.read.schema(type(RECEIPTS)(staged)).parquet(f"{path}/staged")
            .select("*", F.col("_metadata.file_name").alias("_name")))
    return (rows.join(names, "_name", "left_semi").withColumn("status", response_status(F.col("response")))
            .select(*RECEIPTS.names))
