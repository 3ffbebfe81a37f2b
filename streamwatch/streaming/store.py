"""Folders written batch by batch, with a log that says which of them count.

A batch writes its folders first and its record last. Readers follow the newest record, so they see all parts of a batch or none, and a
batch that is repeated after a failure starts over unseen. Records are small files put in place by a rename.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "_log"
#: Old records that stay, for readers that are about to open one.
KEPT_RECORDS = 5
VERSION = "__version"


@dataclass(frozen=True)
class Record:
    """What counts after a batch: one folder of merged rows, the folders of later batches, and what else the batch said."""

    batch_id: int
    base: str | None = None
    versions: tuple[str, ...] = ()
    #: folders that no record names any more, kept until the next record
    replaced: tuple[str, ...] = ()
    notes: dict = field(default_factory=dict)


class Folder:
    """A folder of Hadoop's file systems, on the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.path = path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._utf8 = spark._jvm.java.nio.charset.StandardCharsets.UTF_8
        self._read = spark._jvm.org.apache.commons.io.IOUtils.toString

    def _at(self, name: str):
        return self._path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        if not self._fs.exists(self._at(name)):
            return []
        return sorted(found.getPath().getName() for found in self._fs.listStatus(self._at(name)))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def put(self, name: str, text: str) -> None:
        """Write a small file whole: readers see all of it or nothing."""
        unseen = self._at(f"{LOG}/.{name.rpartition('/')[2]}.new")
        out = self._fs.create(unseen, True)
        out.write(bytearray(text.encode()))
        out.close()
        if self._fs.exists(self._at(name)):
            self._fs.delete(self._at(name), False)
        if not self._fs.rename(unseen, self._at(name)):
            raise OSError(f"cannot write {self.path}/{name}")

    def get(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._read(stream, self._utf8)
        finally:
            stream.close()


class Store:
    """A log and the folders that it names."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.folder = spark, path.rstrip("/"), Folder(spark, path.rstrip("/"))

    def records(self) -> list[str]:
        return [name for name in self.folder.names(LOG) if name.endswith(".json")]

    def last(self) -> Record | None:
        names = self.records()
        if not names:
            return None
        found = json.loads(self.folder.get(f"{LOG}/{names[-1]}"))
        return Record(**found | {"versions": tuple(found["versions"]), "replaced": tuple(found["replaced"])})

    def commit(self, record: Record) -> None:
        """Make ``record`` the state; what the record before had replaced goes."""
        names = self.records()
        before = self.last()
        number = int(names[-1].split("-")[1].removesuffix(".json")) + 1 if names else 0
        self.folder.put(f"{LOG}/r-{number:012d}.json", json.dumps(asdict(record)))
        for name in before.replaced if before else ():
            self.folder.delete(name)
        for name in names[:-KEPT_RECORDS]:
            self.folder.delete(f"{LOG}/{name}")

    def is_done(self, batch_id: int) -> bool:
        before = self.last()
        return before is not None and before.batch_id >= batch_id

    def read(self, part: str = "") -> DataFrame:
        """All rows that count, of one part of each folder."""
        record = self.last()
        folders = [name for name in ((record.base, *record.versions) if record else ()) if name]
        paths = [f"{self.path}/{name}/{part}".rstrip("/") for name in folders if self.folder.exists(f"{name}/{part}".rstrip("/"))]
        # without any, the error is Spark's own for a path that is not there
        return self.spark.read.parquet(*(paths or [f"{self.path}/{part}"]))


def newest_states(versions: DataFrame, group: list[str]) -> DataFrame:
    """Of each group the row with the newest ``VERSION``."""
    values = [name for name in versions.columns if name not in (*group, VERSION)]
    newest = F.max_by(F.struct(*values, VERSION), F.col(VERSION)).alias("newest")
    return versions.groupBy(*group).agg(newest).select(*group, "newest.*")
