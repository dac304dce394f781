"""Reading the input tables and writing a run's results."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from loyalpulse.functions.dates import dates_as_text
from loyalpulse.operators.history import RUN_DATE
from loyalpulse.sources.schemas import TABLES, check
from loyalpulse.sources.versions import DATES, FULL, VersionedFolder


def load(spark: SparkSession, table: str, location: str | None = None) -> DataFrame:
    """An input table from the catalog, or from a parquet folder, with its types checked."""
    df = spark.table(table) if location is None else spark.read.parquet(location)
    return check(df, table)


def load_all(
    spark: SparkSession, root: str | None = None, tables: Iterable[str] = tuple(TABLES)
) -> dict[str, DataFrame]:
    """Input tables by name, from the catalog or from ``root/<table>``."""
    return {t: load(spark, t, root and f"{root.rstrip('/')}/{t}") for t in tables}


class Workspace:
    """A folder on shared storage holding a run's tables, snapshots and history.

    Every table written is read back from storage, so a later stage never recomputes an
    earlier one and survives the loss of any executor.  Tables are versioned folders: a
    reader sees a table as it was before a write or after it, and a table may be replaced by
    a frame that reads it.

    With ``database`` every table is also found in the catalog: a table as a view of its
    newest version, a history as a table whose partitions point to their newest rows.
    """

    def __init__(self, spark: SparkSession, root: str, database: str | None = None) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database

    def _versions(self, name: str) -> VersionedFolder:
        return VersionedFolder(self.spark, f"{self.root}/tables/{name}")

    def _layer(self, layer: str, name: str, as_of: date) -> str:
        return f"{self.root}/{layer}/{name}_{as_of.isoformat()}"

    def _name(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def table(self, name: str) -> DataFrame:
        """The newest version of a table or history."""
        versions = self._versions(name)
        if versions.partitions():
            return self._newest_partitions(versions, self.spark.read).drop("version")
        return self.spark.read.parquet(versions.latest())

    def materialize(self, df: DataFrame, name: str) -> DataFrame:
        """Create or replace a table and return it as stored."""
        versions = self._versions(name)
        path = f"{versions.root}/{versions.write(df)}"
        if self.database is not None:
            self.spark.sql(f"CREATE OR REPLACE VIEW {self._name(name)} AS SELECT * FROM parquet.`{path}`")
        versions.expire()
        return self.spark.read.schema(df.schema).parquet(path)

    def snapshot(
        self, df: DataFrame, layer: str, name: str, as_of: date, text_dates: bool = False
    ) -> str:
        """Dated copy in a layer such as silver or gold; returns its folder.

        ``text_dates`` writes dates as yyyy-mm-dd text, for readers that expect strings.
        """
        path = self._layer(layer, name, as_of)
        (dates_as_text(df) if text_dates else df).write.mode("overwrite").parquet(path)
        return path

    def replace_dates(self, df: DataFrame, name: str) -> DataFrame:
        """Replace the history of the dates in ``df`` and keep every other date.

        History is partitioned by run date, so only those dates are written and a rerun of
        a day gives the same table.
        """
        return self._write_dates(df, name, DATES, RUN_DATE)

    def bootstrap_history(self, df: DataFrame, name: str) -> DataFrame:
        """Start the history anew from ``df``, which may read the history itself."""
        return self._write_dates(df, name, FULL, RUN_DATE)

    def has_dates(self, name: str) -> bool:
        """Whether a table is stored by date, so that some of its dates can be replaced."""
        return bool(self._versions(name).partitions())

    def replace_from(self, df: DataFrame, name: str, column: str, first: date) -> DataFrame:
        """Replace every date of a table from ``first`` on, also those that ``df`` lacks.

        ``column`` is the date that the table is stored by; all of ``df`` lies on ``first`` or
        later.  Earlier dates are neither read nor written.  A table that is not stored by
        date yet is started anew from ``df``.
        """
        if not self.has_dates(name):
            return self._write_dates(df, name, FULL, column)
        later = [
            folder
            for folder in self._versions(name).partitions()
            if folder.partition("=")[2] >= first.isoformat()
        ]
        return self._write_dates(df, name, DATES, column, later)

    def _write_dates(
        self, df: DataFrame, name: str, kind: str, column: str, emptied: Sequence[str] = ()
    ) -> DataFrame:
        versions = self._versions(name)
        written = versions.write(df.hint("rebalance", column), kind, column, emptied)
        if self.database is not None:
            self._publish_dates(df, name, versions, written, column)
        versions.expire()
        return self.history(name, df)

    def _publish_dates(
        self, df: DataFrame, name: str, versions: VersionedFolder, written: str, column: str
    ) -> None:
        """Point the catalog's partitions of the dates just written to their new folders."""
        table = self._name(name)
        fields = [f for f in df.schema if f.name != column] + [df.schema[column]]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
            f"PARTITIONED BY ({column}) LOCATION '{versions.root}'"
        )
        known = self.spark.table(table).columns
        added = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields if f.name not in known]
        if added:
            self.spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(added)})")
        listed = {row[0] for row in self.spark.sql(f"SHOW PARTITIONS {table}").collect()}
        newest = versions.partitions()
        for folder in [f for f, version in newest.items() if version == written]:
            at = f"'{versions.root}/{written}/{folder}'"
            which = f"PARTITION ({column} = '{folder.partition('=')[2]}')"
            if folder in listed:
                self.spark.sql(f"ALTER TABLE {table} {which} SET LOCATION {at}")
            else:
                self.spark.sql(f"ALTER TABLE {table} ADD {which} LOCATION {at}")
        for folder in listed - set(newest):
            which = f"PARTITION ({column} = '{folder.partition('=')[2]}')"
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {which}")

    def _newest_partitions(self, versions: VersionedFolder, reader: DataFrameReader) -> DataFrame:
        paths = [f"{versions.root}/{version}/{folder}" for folder, version in versions.partitions().items()]
        return reader.option("basePath", versions.root).parquet(*paths)

    def history(self, name: str, like: DataFrame) -> DataFrame:
        """A history table with the columns of ``like`` in their order."""
        versions = self._versions(name)
        if not versions.partitions():
            return self.spark.createDataFrame([], like.schema)
        return self._newest_partitions(versions, self.spark.read.schema(like.schema)).select(like.columns)

    def export_history(self, history: DataFrame, name: str, as_of: date) -> str:
        """Whole history as a dated gold copy."""
        return self.snapshot(history, "gold", f"{name}_history", as_of)
