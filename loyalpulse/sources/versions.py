"""Tables as versions in a folder, so that a reader always finds a whole one.

Every write goes to a folder of its own, ``version=<number>-<kind>-<random>``, and counts
from the moment its marker file exists.  A ``full`` version starts the table anew; a
``dates`` version replaces only the partitions it holds.  What readers of the state before
the latest write may still use is kept; older versions are deleted.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

COMMITTED = "_COMMITTED"
FULL, DATES = "full", "dates"
_PREFIX = "version="


class VersionedFolder:
    """The committed versions of one table below ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root
        at = self._path(root)
        self._files = at.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, text: str) -> JavaObject:
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _names(self, folder: str) -> list[str]:
        at = self._path(folder)
        if not self._files.exists(at):
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(at))

    def committed(self) -> list[str]:
        """Names of the committed versions, oldest first."""
        return [
            name
            for name in self._names(self.root)
            if name.startswith(_PREFIX) and self._files.exists(self._path(f"{self.root}/{name}/{COMMITTED}"))
        ]

    def write(
        self,
        df: DataFrame,
        kind: str = FULL,
        partition: str | None = None,
        emptied: Iterable[str] = (),
    ) -> str:
        """Writes a version and commits it; returns its name.

        ``emptied`` are partition folders that have no rows from now on unless ``df`` has some.
        A write that fails leaves a folder that no reader looks at.
        """
        taken = [int(n.removeprefix(_PREFIX).split("-")[0]) for n in self._names(self.root) if n.startswith(_PREFIX)]
        name = f"{_PREFIX}{max(taken, default=0) + 1:010d}-{kind}-{uuid.uuid4().hex[:8]}"
        writer = df.write.partitionBy(partition) if partition else df.write
        writer.parquet(f"{self.root}/{name}")
        for folder in emptied:
            self._files.mkdirs(self._path(f"{self.root}/{name}/{folder}"))
        self._files.create(self._path(f"{self.root}/{name}/{COMMITTED}"), False).close()
        return name

    def latest(self) -> str:
        """The folder of the newest version of a table without partitions."""
        versions = self.committed()
        if not versions:
            raise FileNotFoundError(f"no version of a table in {self.root}")
        return f"{self.root}/{versions[-1]}"

    def partitions(self, versions: Iterable[str] | None = None) -> dict[str, str]:
        """Partition folder name to the version that holds its newest rows."""
        newest: dict[str, str] = {}
        for version in self.committed() if versions is None else versions:
            if f"-{FULL}-" in version:
                newest = {}
            newest |= {n: version for n in self._names(f"{self.root}/{version}") if "=" in n}
        return newest

    def expire(self) -> list[str]:
        """Deletes the versions that neither the current state nor the one before it uses."""
        versions = self.committed()
        used = set(versions[-2:])
        for state in (versions, versions[:-1]):
            used |= set(self.partitions(state).values())
        gone = [version for version in versions if version not in used]
        for version in gone:
            # the marker first: what is half deleted is no version
            self._files.delete(self._path(f"{self.root}/{version}/{COMMITTED}"), False)
            self._files.delete(self._path(f"{self.root}/{version}"), True)
        return gone
