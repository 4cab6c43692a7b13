"""Tables that shrink: whole folders go, or a new version takes the place of the old one."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import fresh_path

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: how Spark names the folder of rows without a key


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, path: str) -> list[str]:
    at, fs = _path(spark, path)
    found = fs.listStatus(at) if fs.exists(at) else []
    return [s.getPath().getName() for s in found if s.isDirectory() and not s.getPath().getName().startswith(("_", "."))]


def partitions_of(spark: SparkSession, path: str, columns: list[str]) -> list[tuple[str, dict[str, str | None]]]:
    """Folders of a table partitioned by ``columns``, with their values as text; only folder names are listed, no files."""
    out = [(path.rstrip("/"), {})]
    for column in columns:
        below = []
        for folder, values in out:
            for name in _folders(spark, folder):
                key, _, value = name.partition("=")
                if key == column:
                    below.append((f"{folder}/{name}", values | {column: None if value == NULL_FOLDER else unquote(value)}))
        out = below
    return out


def drop_partitions(spark: SparkSession, path: str, columns: list[str], gone: Callable[[dict[str, str | None]], bool]) -> int:
    """Delete the folders whose values ``gone`` holds for and return their number; all other files stay as they are.

    A run that was broken off is finished by the next one.
    """
    dropped = [folder for folder, values in partitions_of(spark, path, columns) if gone(values)]
    for folder in dropped:
        at, fs = _path(spark, folder)
        fs.delete(at, True)
    return len(dropped)


def _rows_of(df: DataFrame, where, store: str) -> DataFrame:
    """How many rows a condition on partition columns holds for, fixed before they are deleted."""
    n = df.where(where).count()
    return df.sparkSession.createDataFrame([(store, n)], "store string, n long")


def retire_tenant_folders(spark: SparkSession, tenant: object, tables: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """(store, n): rows of a tenant in each of some tables, whose folders are then deleted.

    ``tables``: by store its frame, its path, and the columns it is partitioned by, ``tenant_id`` among them.
    """
    if not tables:
        return spark.createDataFrame([], "store string, n long")
    out = None
    for store, (df, path, columns) in tables.items():
        counted = _rows_of(df, F.col("tenant_id") == F.lit(tenant), store)
        drop_partitions(spark, path, columns, lambda values: values["tenant_id"] == str(tenant))
        out = counted if out is None else out.unionByName(counted)
    return out


def expire_bodies(spark: SparkSession, path: str, as_of: datetime, columns: list[str] | None = None, period: str = "day") -> dict[str, int]:
    """Delete what is due at ``as_of`` (a time in the session's zone) from bodies partitioned by ``columns``, ``purge_date`` among them.

    Folders of earlier days (or months, if that is the ``period`` they were written by) are dropped without being read. Of the day itself the rows that are not due yet are written aside first and then
    take the folder's place, so that a failure on the way leaves either the old or the new rows. Bodies without a purge time stay.
    """
    columns = columns or ["purge_date"]
    today = (as_of.date() if period == "day" else as_of.date().replace(day=1)).isoformat()
    counts = {"folders_dropped": drop_partitions(spark, path, columns, lambda v: v["purge_date"] is not None and v["purge_date"] < today), "rows_rewritten": 0}
    mixed = [(folder, values) for folder, values in partitions_of(spark, path, columns) if values["purge_date"] == today]
    for folder, _ in mixed:
        rows = spark.read.parquet(folder)
        left = rows.where(F.col("purge_at") > F.lit(as_of).cast(rows.schema["purge_at"].dataType))
        if left.count() == rows.count():
            continue
        aside = fresh_path(spark, "aside")
        left.write.parquet(aside)
        counts["rows_rewritten"] += spark.read.schema(rows.schema).parquet(aside).count()
        _replace_folder(spark, aside, folder)
    return counts


def _replace_folder(spark: SparkSession, new: str, old: str) -> None:
    """``new`` in the place of ``old``: beside it first, under a name no reader looks at, then by renames alone."""
    base, name = old.rsplit("/", 1)
    at, fs = _path(spark, old)
    beside, _ = _path(spark, f"{base}/_new-{uuid.uuid4().hex}-{name.partition('=')[0]}")
    away, _ = _path(spark, f"{base}/_old-{uuid.uuid4().hex}-{name.partition('=')[0]}")
    source, from_fs = _path(spark, new)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(from_fs, source, fs, beside, True, spark._jsc.hadoopConfiguration())
    fs.rename(at, away)
    fs.rename(beside, at)
    fs.delete(away, True)


class VersionedTable:
    """A table as folders of versions, one of which a pointer file names; readers follow the pointer.

    A version is written in full before the pointer is replaced, in one atomic rename, so a run that fails leaves the version before it in
    place and readable, and whoever reads meanwhile sees one of the two.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def current(self) -> str | None:
        """The name of the version that counts."""
        at, fs = _path(self.spark, f"{self.path}/_current")
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def read(self, schema=None) -> DataFrame:
        version = self.current()
        if version is None:
            raise FileNotFoundError(f"no version of {self.path} yet")
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(f"{self.path}/{version}")

    def replace(self, rows: DataFrame, partition_by: list[str] | None = None) -> str:
        """Write ``rows``, which may be read from the table itself, as the version that counts from now on."""
        version = f"version-{uuid.uuid4().hex}"
        writer = rows.write if not partition_by else rows.write.partitionBy(*partition_by)
        writer.parquet(f"{self.path}/{version}")
        self._point_to(version)
        return version

    def _point_to(self, version: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        draft, fs = _path(self.spark, f"{self.path}/_next-{version}")
        out = fs.create(draft, True)
        try:
            out.write(version.encode())
        finally:
            out.close()
        at, _ = _path(self.spark, f"{self.path}/_current")
        how = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(draft), fs.makeQualified(at), how)

    def drop_old(self) -> int:
        """Delete all versions but the one that counts, once nobody reads them any more; returns their number."""
        keep = self.current()
        old = [n for n in _folders(self.spark, self.path) if n != keep]
        for name in old:
            at, fs = _path(self.spark, f"{self.path}/{name}")
            fs.delete(at, True)
        return len(old)
