"""SRC-8 / SRC-10: landed pages as a source that is split by channel ids (PART-1).

``spark.read.format("channel_pages")`` and ``readStream`` read pages that lie in one
folder per landing and channel, ``path/landing=<number>/channel=<id>/``, one page a
line.  The channel ids are cut into ``splits`` groups of near-equal size in id order,
as the original's splittable list of ids; a group is one input partition, so all pages
of a channel are read by one task and no page is shuffled to get there.

The stream's offset is the number of the last landing read.  A landing counts once its
``_SUCCESS`` is there, so one that is still being written is left for the next batch; a
restarted query goes on behind the offset in its checkpoint.  ``maxLandings`` bounds a
batch.

Planning lists folders only; a task streams its files line by line.  Register the
source once per session (``register``).  Paths are opened by the tasks themselves, so
they must be in a store that pyarrow reads (local or shared folders, hdfs, s3, gs).
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .. import schemas

FORMAT = "channel_pages"
SCHEMA = "channel string, file string, line long, value string"
LINES, BYTES = 1000, 8 << 20  # of an Arrow batch
LANDING = re.compile(r"landing=(\d+)$")


@dataclass
class Group(InputPartition):
    """A group of channel ids and the folders of their pages."""

    ids: list[str]
    folders: list[tuple[str, str]]

    def __init__(self, ids: list[str], folders: list[tuple[str, str]]) -> None:
        super().__init__(0)
        self.ids, self.folders = ids, folders


def groups(ids: Sequence[str], k: int) -> list[list[str]]:
    """At most ``k`` groups of consecutive ids, whose sizes differ by one at most."""
    n, k = len(ids), min(k, len(ids))
    ends = [n * (i + 1) // k for i in range(k)]
    return [list(ids[a:z]) for a, z in zip([0, *ends], ends)]


class _Pages:
    """What the batch and the stream reader share."""

    def __init__(self, options: dict) -> None:
        if not options.get("path"):
            raise ValueError("channel_pages needs the option path")
        self.path = options["path"]
        self.splits = int(options.get("splits", "8"))
        self.most = int(options.get("maxlandings", options.get("maxLandings", "0")))
        if self.splits < 1:
            raise ValueError(f"cannot make {self.splits} groups")

    def _root(self) -> tuple[fs.FileSystem, str]:
        path = self.path if re.match(r"\w+:", self.path) else f"file://{self.path}"
        system, root = fs.FileSystem.from_uri(path)
        return system, root.rstrip("/")

    def landings(self) -> list[int]:
        """The numbers of the complete landings, in order."""
        system, root = self._root()
        out = []
        for found in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            name = LANDING.search(found.path)
            if name and system.get_file_info(f"{found.path}/_SUCCESS").type == fs.FileType.File:
                out.append(int(name[1]))
        return sorted(out)

    def plan(self, landings: list[int]) -> list[Group]:
        system, root = self._root()
        folders: dict[str, list[str]] = {}
        for n in landings:
            for found in system.get_file_info(fs.FileSelector(f"{root}/landing={n}")):
                if found.type == fs.FileType.Directory and found.base_name.startswith("channel="):
                    folders.setdefault(unquote(found.base_name[8:]), []).append(found.path)
        return [Group(ids, [(i, f) for i in ids for f in folders[i]])
                for ids in groups(sorted(folders), self.splits)] if folders else []

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        system, _ = self._root()
        held, size = [], 0
        for channel, folder in partition.folders:
            for found in sorted(system.get_file_info(fs.FileSelector(folder)), key=lambda f: f.path):
                if found.type != fs.FileType.File or found.base_name[0] in "._":
                    continue
                with io.TextIOWrapper(system.open_input_stream(found.path), "utf-8", "replace", newline="\n") as lines:
                    for k, line in enumerate(lines):
                        held.append((channel, found.path, k, line.rstrip("\r\n")))
                        size += len(line)
                        if len(held) == LINES or size > BYTES:
                            yield _batch(held)
                            held, size = [], 0
        if held:
            yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    channel, file, line, value = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(channel, pa.string()), pa.array(file, pa.string()), pa.array(line, pa.int64()),
         pa.array(value, pa.string())], ["channel", "file", "line", "value"])


class PageReader(_Pages, DataSourceReader):
    def partitions(self) -> list[Group]:
        return self.plan(self.landings()) or [Group([], [])]


class PageStreamReader(_Pages, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"landing": -1}

    def __init__(self, options: dict) -> None:
        super().__init__(options)
        self.at = -1                              # the end of the batch before

    def latestOffset(self) -> dict:
        new = [n for n in self.landings() if n > self.at]
        if new:
            self.at = new[min(self.most, len(new)) - 1] if self.most else new[-1]
        return {"landing": self.at}

    def partitions(self, start: dict, end: dict) -> list[Group]:
        self.at = max(self.at, end["landing"])
        return self.plan([n for n in self.landings() if start["landing"] < n <= end["landing"]])


class ChannelPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(dict(self.options))

    def streamReader(self, schema) -> PageStreamReader:
        return PageStreamReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ChannelPages)


def pages_of(lines: DataFrame) -> DataFrame:
    """The source's lines (batch or stream) as history pages, for ``sources.pages``; the folder
    names the channel.  A line that is no page has its text in the corrupt column."""
    page = F.from_json("value", schemas.HISTORY_PAGE, {"columnNameOfCorruptRecord": schemas.CORRUPT})
    named = [F.col("p")[f].alias(f) for f in schemas.HISTORY_PAGE.names if f not in ("channel", schemas.CORRUPT)]
    text = F.when(F.col("p")["ok"].isNull() & F.col("p")["error"].isNull(), F.col("value"))
    return lines.withColumn("p", page).select(
        "channel", *named, text.alias(schemas.CORRUPT), F.col("file").alias("_page"), F.col("line").alias("_block"))


def read_channel_pages(spark: SparkSession, path: str, splits: int = 8) -> DataFrame:
    register(spark)
    return pages_of(spark.read.format(FORMAT).option("splits", splits).load(path))


def stream_channel_pages(spark: SparkSession, path: str, splits: int = 8, max_landings: int = 0) -> DataFrame:
    register(spark)
    return pages_of(spark.readStream.format(FORMAT).option("splits", splits)
                    .option("maxLandings", max_landings).load(path))


def land_channel_folders(pages: DataFrame, path: str, landing: int) -> None:
    """Write pages (channel, value: the page's JSON) as one landing, clustered by channel first
    so that a task keeps one open file at a time."""
    (pages.select("channel", "value").repartitionByRange("channel").sortWithinPartitions("channel")
     .write.mode("overwrite").partitionBy("channel").text(f"{path.rstrip('/')}/landing={int(landing)}"))
