"""End-to-end flows: each is one declarative plan from listing to sink rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions import classify as c
from tributary.functions import content as k
from tributary.operators import aggregates as agg
from tributary.operators import changes as ch
from tributary.operators import dedup, joins, lifecycle
from tributary.operators import events as ev
from tributary.session import materialize
from tributary.sources.listings import SyncOptions
from tributary.streaming.operators import run_batches


def full_sync(
    files: DataFrame, options: SyncOptions = SyncOptions(), threshold_kb: int = 256, drop_duplicates: bool = False
) -> DataFrame:
    """Listing with content → filtered, classified, hashed, routed documents, by the rules of each connector type.

    Filters use listing columns only, so they run before the content is hashed. Dropping duplicates is
    off by default; hashes and sizes are then written once, and the first of each hash is matched by its number.
    """
    ext = c.file_extension(F.col("path"))
    kept = files.where(sync_filter(files, options))
    language = language_of(kept)
    measures = {"content_hash": k.content_hash(F.col("content")), "size_bytes": F.octet_length("content").cast("long")}
    if drop_duplicates:
        measured = materialize(kept.select(F.col("seq").alias("_seq"), *[m.alias(n) for n, m in measures.items()]), "measures")
        measured = measured.join(dedup.first_seen(measured, F.col("content_hash"), "_seq"), "_seq", "left_semi")
        kept, measures = kept.join(measured, F.col("seq") == F.col("_seq")).drop("_seq"), {}
    docs = kept.withColumns({
        "external_id": F.col("id").cast("string"),
        "id": k.document_id(F.col("source_id"), F.col("id").cast("string")),
        "content_type": content_type_of(kept, ext),
        "language": language,
        **measures,
        "chunk_strategy": c.chunk_strategy(F.col("connector_type"), language),
    })
    return docs.withColumn("route", k.route_by_size(F.col("size_bytes"), threshold_kb))


def _mime(files: DataFrame) -> Column:
    return F.coalesce("mime_type", F.lit("")) if "mime_type" in files.columns else F.lit("")


def sync_filter(files: DataFrame, options: SyncOptions) -> Column:
    """Which listed files are fetched: office sources keep documents and ignore case, drives go by media type."""
    path, size = F.col("path"), F.col("size")
    repo = c.not_binary_repo(c.file_extension(path)) & c.sync_filter_repo(path, size, options.include, options.exclude, options.max_mb)
    folder = c.not_binary_office(c.file_extension(path)) & c.sync_filter_folder(path, size, options.include, options.exclude, options.max_mb)
    drive = c.not_skipped_mime(_mime(files)) & c.sync_filter_mime(_mime(files), size, options.include_mimes, options.max_mb)
    local = (
        c.not_hidden(path) & c.not_binary_repo(c.local_extension(c.file_name(path)))
        & c.sync_filter_repo(path, size, options.include, options.exclude, options.max_mb)
    )
    kind = F.col("connector_type")
    return F.when(kind.isin("dropbox", "onedrive"), folder).when(kind == "google_drive", drive).when(kind == "local_file", local).otherwise(repo)


def content_type_of(files: DataFrame, ext: Column) -> Column:
    kind = F.col("connector_type")
    return (
        F.when(kind == "dropbox", c.content_type_office(ext, "dropbox")).when(kind == "onedrive", c.content_type_office(ext, "onedrive"))
        .when(kind == "google_drive", c.content_type_by_mime(_mime(files)))
        .when(kind == "local_file", c.content_type_by_ext(c.local_extension(c.file_name(F.col("path")))))
        .otherwise(c.content_type_by_ext(ext))
    )


def language_of(files: DataFrame) -> Column:
    """Only code hosts and local files know languages, each by a list of its own."""
    kind, ext = F.col("connector_type"), c.file_extension(F.col("path"))
    return (
        F.when(kind == "bitbucket", c.language_by_ext(ext, "bitbucket"))
        .when(kind == "local_file", c.language_by_ext(c.local_extension(c.file_name(F.col("path"))), "local"))
        .when(~kind.isin("dropbox", "onedrive", "google_drive"), c.language_by_ext(ext))
    )


def sync_requests(docs: DataFrame, base_url: str) -> DataFrame:
    """Request to send per synced document: its content inline, or a reference to its blob."""
    key = k.blob_key(F.col("tenant_id"), F.col("id"), F.col("content_hash"), F.col("name"))
    rows = docs.withColumns({"connector_id": F.col("source_id"), "blob_url": F.concat(F.lit(base_url.rstrip("/") + "/"), key)})
    body = F.when(F.col("route") == "inline", F.to_json(ev.inline_body(rows))).otherwise(F.to_json(ev.reference_body(rows)))
    return rows.select("id", "route", body.alias("payload"))


def full_sync_stats(docs: DataFrame) -> DataFrame:
    """Per source: documents and bytes, inline and by reference."""
    return docs.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("documents_synced"), F.sum("size_bytes").alias("total_bytes"),
        F.count_if(F.col("route") == "inline").alias("inline_documents"),
        F.count_if(F.col("route") == "reference").alias("reference_documents"),
    )


def incremental_sync(changes: DataFrame, items: DataFrame, cursors: Column | DataFrame, threshold_kb: int = 256) -> tuple[DataFrame, DataFrame]:
    """Documents changed since their source's cursor with their route, and the next cursor per source."""
    fresh = ch.changes_since(changes, cursors)
    docs = joins.incremental_documents(fresh, items).withColumn(
        "size_bytes", F.octet_length("content").cast("long")
    )
    routed = docs.withColumn("route", k.route_by_size(F.col("size_bytes"), threshold_kb))
    return routed, ch.new_cursor(fresh, ["source_id"])


def webhook_events(raw: DataFrame, secrets: DataFrame) -> DataFrame:
    """Raw webhooks as event rows, ``verified`` by their provider's own proof; batch or stream.

    ``secrets``: (connector_id, ipad, opad, token), the hex pads of each connector's secret and the secret itself where the provider sends it.
    """
    keys = secrets.select(F.col("connector_id").alias("_cid"), *[F.col(n).alias(f"_{n}") for n in ("ipad", "opad", "token")])
    keyed = raw.join(keys, F.col("connector_id") == F.col("_cid"), "left")
    proof = k.verify_by_provider(F.col("provider"), F.col("body"), F.col("signature"), F.col("_ipad"), F.col("_opad"), F.col("_token"))
    named = keyed.withColumns({"payload": k.webhook_payload(F.col("body")), "verified": proof, "status": F.lit("pending")})
    return named.drop("body", "_cid", "_ipad", "_opad", "_token")


def _changes_in(events: DataFrame) -> DataFrame:
    return ch.changes_of(events.where("verified").select("id", "connector_id", "provider", "payload"))


def _jobs_for(events: DataFrame, changes: DataFrame, connectors: DataFrame) -> DataFrame:
    asked = events.where("verified").join(changes.select("id").distinct(), "id", "left_semi").select(
        F.col("id").alias("request_id"), "connector_id", F.lit("webhook").alias("type"), F.col("received_at").alias("requested_at"),
    )
    return lifecycle.new_jobs(asked, connectors)[0]


def webhook_flow(raw: DataFrame, connectors: DataFrame, secrets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw webhooks → verified events → changes by provider, and one pending job per accepted event that changes something.

    The event log is a table of its own; everything after it reads the log, and jobs read the changes.
    """
    events = materialize(webhook_events(raw, secrets), "webhook_events")
    changes = materialize(_changes_in(events), "webhook_changes")
    return events, changes, _jobs_for(events, changes, connectors)


SINKS = ("events", "changes", "jobs")


def run_webhook_stream(stream: DataFrame, connectors: DataFrame, secrets: DataFrame, path: str, checkpoint: str) -> None:
    """The webhook flow over everything that a stream of raw webhooks has, into three tables below ``path``.

    A batch is verified once, on its way into the event table; its changes are read from there, its jobs from both. Each table has a folder for
    each batch, which a batch that is repeated after a failure overwrites, so nothing is logged, changed or asked for twice.
    """
    spark = stream.sparkSession

    def flow(batch: DataFrame, epoch: int) -> None:
        events, changes, jobs = (f"{path}/{name}/epoch={epoch}" for name in SINKS)
        webhook_events(batch, secrets).write.mode("overwrite").parquet(events)
        logged = spark.read.parquet(events)
        _changes_in(logged).write.mode("overwrite").parquet(changes)
        _jobs_for(logged, spark.read.parquet(changes), connectors).write.mode("overwrite").parquet(jobs)

    run_batches(stream, checkpoint, flow)


def webhook_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events, changes and jobs that a webhook stream has written."""
    return tuple(spark.read.parquet(f"{path}/{name}") for name in SINKS)


def retention_cycle(jobs: DataFrame, bodies: DataFrame, chunks: DataFrame, vectors: DataFrame, as_of: Column) -> DataFrame:
    """What one hourly cleanup removes and reports."""
    deleted = jobs.agg(F.count_if(lifecycle.is_purged(as_of)).alias("value")).select(
        F.lit("deleted_jobs").alias("metric"), "value"
    )
    return agg.retention_report(bodies, chunks, vectors, as_of).unionByName(deleted)
