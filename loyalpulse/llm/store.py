"""Intermediate tables on storage that every executor and the driver share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_own: list[str] = []
#: Of each thread, the tables made so far by every ``distilled`` it is in.
_made = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Where the session names none and runs on one machine, as in tests, a temporary folder is
    used; on a cluster, whose machines would not share it, that is an error.
    """
    root = spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all machines of {master} share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="llm-"))
        root = _own[0]
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table and read back: computed once, and safe from lost executors.

    The shuffle files of the write are of no use afterwards, so Spark may drop them at once.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    for made in getattr(_made, "by", ()):
        made.append(table)
    return table


def distilled(build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` returns, stored; the tables stored on the way to it are deleted."""
    made: list[DataFrame] = []
    _made.by = [*getattr(_made, "by", ()), made]
    try:
        table = stored(build())
    finally:
        _made.by = _made.by[:-1]
    discard(*made[:-1])
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by ``stored`` whose last reader has been written."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
