"""State tables, blob offload and the chunk body store."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions import content as k

# fixed values: table schemas
STATE_TABLES = {
    "connectors": "id string, tenant_id string, type string, name string, config_json string, metadata_json string, "
    "status string, last_sync_cursor string, last_sync_time timestamp, created_at timestamp, updated_at timestamp",
    "sync_jobs": "id string, connector_id string, tenant_id string, type string, start_time timestamp, "
    "end_time timestamp, status string, stats_json struct<documents_synced:bigint,sync_type:string>, "
    "error_message string",
    "file_blobs": "id string, connector_id string, tenant_id string, file_id string, file_name string, "
    "blob_url string, content_hash string, size bigint, mime_type string, created_at timestamp",
    "webhook_events": "id string, connector_id string, provider string, event_type string, payload string, "
    "signature string, received_at timestamp, processed_at timestamp, status string, error_message string",
    "chunks": "id string, tenant_id string, source_id string, source_type string, content_hash string, "
    "neo4j_id string, embedding_state string, content_summary string, chunk_index int, token_count int, "
    "created_at timestamp, embedded_at timestamp",
}


#: Hashes in hex make up most of a state table's bytes; they take half of them by entropy coding, which the default codec lacks.
STORED = {"compression": "zstd"}


def _clustered(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of one folder together, for few and even files; adaptive execution splits a folder that is too large."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


#: From so many rows into so few folders on, tasks write the folders themselves; each may have a file in each of them open.
UNSHUFFLED_ROWS, OPEN_FOLDERS = 1_000_000, 32


def _write_folders(rows: DataFrame, columns: tuple[str, ...], path: str, mode: str) -> None:
    """Rows into a folder for each value of ``columns``.

    Many rows for few folders are written where they are, without a shuffle or a sort: every task leaves a large file in each folder.
    All others are brought together first, as a file for each task and folder would be a small one.
    """
    spark, setting = rows.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    folders = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    found = folders.agg(F.count(F.lit(1)).alias("folders"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    if found["folders"] > OPEN_FOLDERS or found["n"] < UNSHUFFLED_ROWS:
        _clustered(rows, *columns).write.mode(mode).options(**STORED).partitionBy(*columns).parquet(path)
        return
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, str(OPEN_FOLDERS))
    try:
        rows.write.mode(mode).options(**STORED).partitionBy(*columns).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def write_state(df: DataFrame, table: str, path: str, mode: str = "append") -> None:
    """Write rows of a state table; missing columns become null, extra ones are dropped.

    Chunks carry the tenant as a partition so that retiring one touches only its folder.
    """
    schema = df.sparkSession.createDataFrame([], STATE_TABLES[table]).schema
    have = set(df.columns)
    cols = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    rows = df.select(*cols)
    if table == "chunks":
        _write_folders(rows, ("tenant_id",), path, mode)
    else:
        rows.write.mode(mode).options(**STORED).parquet(path)


def read_state(spark: SparkSession, table: str, path: str) -> DataFrame:
    read = spark.read.schema(STATE_TABLES[table]).parquet(path)
    return read.select(*[f.name for f in spark.createDataFrame([], STATE_TABLES[table]).schema])


def blob_references(docs: DataFrame, base_url: str, threshold_kb: int = 256) -> DataFrame:
    """Documents above the threshold as blob rows that still carry their content."""
    size = F.octet_length("content")
    blob_id = k.content_hash(F.col("content"))
    key = k.blob_key(F.col("tenant_id"), F.col("id"), blob_id, F.col("name"))
    return docs.where(k.route_by_size(size, threshold_kb) == "reference").select(
        k.document_id(F.col("tenant_id"), F.col("id")).alias("id"), "connector_id", "tenant_id",
        F.col("id").alias("file_id"), F.col("name").alias("file_name"),
        F.concat(F.lit(base_url.rstrip("/") + "/"), key).alias("blob_url"), blob_id.alias("content_hash"),
        size.cast("long").alias("size"), F.coalesce("mime_type", F.lit("text/plain")).alias("mime_type"), "created_at",
        "content",
    )


def blob_offload(docs: DataFrame, path: str, threshold_kb: int = 256, run: str | None = None) -> DataFrame:
    """Write large contents below ``path`` and return this run's file_blobs rows, read back from there.

    Each run has a folder of its own, so a run that is repeated under its name replaces itself. A tenant may own a third
    of the rows; its folder is then written by several tasks. ``fetch_blobs`` finds a content by its ``blob_url``.
    """
    folder = f"{path.rstrip('/')}/run={run or uuid.uuid4().hex}"
    blobs = blob_references(docs, path, threshold_kb)
    _clustered(blobs, "tenant_id").write.mode("overwrite").partitionBy("tenant_id").parquet(folder)
    schema = STATE_TABLES["file_blobs"]
    return docs.sparkSession.read.schema(schema).parquet(folder)


def fetch_blobs(refs: DataFrame, path: str, tenant: str | None = None) -> DataFrame:
    """``refs`` with the content that their ``blob_url`` names; the same content stored by several runs counts once.

    With a ``tenant`` only its references are answered, and only its folders are read.
    """
    stored = refs.sparkSession.read.option("mergeSchema", "false").parquet(path)
    if tenant is not None:
        stored = stored.where(F.col("tenant_id") == tenant)
        refs = refs.where(F.col("tenant_id") == tenant) if "tenant_id" in refs.columns else refs
    stored = stored.select("blob_url", "content")
    wanted = stored.join(refs.select("blob_url").distinct(), "blob_url", "left_semi").dropDuplicates(["blob_url"])
    return refs.join(wanted, "blob_url")


def chunk_bodies(chunks: DataFrame, mode: str, ttl_days: int = 7) -> DataFrame:
    """Bodies with their purge time in ``mongo-ttl`` mode, without one in ``postgres`` mode, none when ephemeral."""
    if mode == "ephemeral":
        return chunks.where(F.lit(False)).withColumn("purge_at", F.lit(None).cast(chunks.schema["created_at"].dataType))
    if mode == "postgres":
        return chunks.withColumn("purge_at", F.lit(None).cast(chunks.schema["created_at"].dataType))
    return chunks.withColumn("purge_at", F.col("created_at") + F.make_dt_interval(F.lit(ttl_days)))


def period_of(at: Column, period: str = "day") -> Column:
    """The first day of the day or month of a time."""
    return F.to_date(at) if period == "day" else F.to_date(F.trunc(at, period))


def write_chunk_bodies(
    chunks: DataFrame, path: str, mode: str = "mongo-ttl", ttl_days: int = 7, partition_by: tuple[str, ...] = ("purge_date",), period: str = "day"
) -> None:
    """Partitioned by purge date, so that expiry drops whole folders, or by tenant as well or instead, so that retirement does.

    With ``mongo-ttl`` and no backlog there are as many dates as days to live, and one; a long backlog is better kept by ``month``.
    """
    bodies = chunk_bodies(chunks, mode, ttl_days).withColumn("purge_date", period_of(F.col("purge_at"), period))
    _write_folders(bodies, partition_by, path, "append")


def live_bodies(bodies: DataFrame, as_of: Column) -> DataFrame:
    """Bodies not yet due; the date predicate prunes folders, the time predicate is exact."""
    live = F.col("purge_at").isNull() | (F.col("purge_at") > as_of)
    if "purge_date" in bodies.columns:
        live = live & (F.col("purge_date").isNull() | (F.col("purge_date") >= F.to_date(as_of)))
    return bodies.where(live)
