"""Session settings, and scratch folders that every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

SETTINGS = {
    # naive event times are read as UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # hash instead of sort where every partition of the smaller side proves small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # window and join state of a large stream does not fit the executor heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the package's settings; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, ready for ``checkpoint()``.

    A local session without the setting gets a temporary folder. On a cluster a
    folder of one machine would lose data with its executor, so there the
    setting is required.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = context.getCheckpointDir()
    if root is None:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="streamwatch-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


#: Scratch folders that this process has named, in order.
_SCRATCH: list[str] = []


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that nothing else uses."""
    path = f"{checkpoint_root(spark).rstrip('/')}/streamwatch-{purpose}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def scratch_mark() -> int:
    """A mark for :func:`remove_scratch`: folders named from here on are newer."""
    return len(_SCRATCH)


def remove_scratch(spark: SparkSession, since: int = 0, keep: Sequence[str] = ()) -> None:
    """Delete the scratch folders of this process that are newer than a mark, but for ``keep``. Results that were not
    written yet may need them, so this is for the end of a job, or of a stage whose result is a table."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    for path in [path for path in _SCRATCH[since:] if path not in keep]:
        at = path_of(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        _SCRATCH.remove(path)
