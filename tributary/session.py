"""Session, shared folder and sizing helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

_fallback: dict[str, str] = {}


def local_session(cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tributary")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.streaming.metricsEnabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="run-")
        spark.sparkContext.setCheckpointDir(_fallback[app] + "/checkpoints")
    return _fallback[app]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that they find it wherever the driver started."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "tributary.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody used before, inside the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Cut lineage through a Parquet table in the shared folder: computed once, safe from executor loss."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    _made.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def as_one(tables: Sequence[DataFrame]) -> DataFrame:
    """Materialized tables of one schema as one scan, so that no plan grows with their number."""
    return tables[0].sparkSession.read.schema(tables[0].schema).parquet(*[t._written_to for t in tables])


_made: dict[str, list[str]] = {}


def discard(table: DataFrame) -> None:
    """Delete a materialized table that nothing will read any more: all that was made of it must be written itself."""
    spark, path = table.sparkSession, table._written_to
    _delete(spark, path)
    _made.get(spark.sparkContext.applicationId, [path]).remove(path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def cleanup(spark: SparkSession) -> int:
    """Delete the tables that this application has materialized; call it when results that read them are written.

    Returns their number. What others have written into the shared folder stays.
    """
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


def by_range(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Rows sorted over range slices, as many as the session's shuffle parallelism.

    No number is given, so adaptive execution may merge neighbouring small slices; their order stays.
    """
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)
