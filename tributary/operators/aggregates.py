"""Counts and summaries. Plain aggregates combine map-side, so hot keys shuffle one row per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tributary.functions import content as k
from tributary.functions import tables as t
from tributary.operators.slicing import ranked


def sync_stats(docs: DataFrame, sync_type: str = "full", by: str = "job_id") -> DataFrame:
    """Documents per job, counted before any dedup."""
    return docs.groupBy(by).agg(F.count(F.lit(1)).alias("documents_synced")).withColumn("sync_type", F.lit(sync_type))


def chunk_count(chunks: DataFrame, tenant: str | None = None) -> DataFrame:
    return by_tenant(chunks, tenant).agg(F.count(F.lit(1)).alias("chunks"))


def chunks_by_state(chunks: DataFrame, tenant: str | None = None) -> DataFrame:
    return by_tenant(chunks, tenant).groupBy("embedding_state").agg(F.count(F.lit(1)).alias("chunks"))


def by_tenant(df: DataFrame, tenant: str | None) -> DataFrame:
    return df if tenant is None else df.where(F.col("tenant_id") == tenant)


def by_id(df: DataFrame, value) -> DataFrame:
    return df.where(F.col("id") == value)


def files_query(files: DataFrame, source_id: str, prefix: str = "", language: str | None = None, limit: int | None = None) -> DataFrame:
    """Files of a source by path prefix and language; the first ``limit`` in path order."""
    kept = files.where((F.col("source_id") == source_id) & F.col("path").startswith(prefix))
    if language is not None:
        kept = kept.where(F.col("language") == language)
    return kept if limit is None else kept.orderBy("path").limit(limit)


def jobs_query(jobs: DataFrame, source: object | None = None, status: str | None = None, limit: int = 20) -> DataFrame:
    """Newest jobs first, by source and status."""
    if source is not None:
        jobs = jobs.where(F.col("connector_id") == source)
    if status is not None:
        jobs = jobs.where(F.col("status") == status)
    return jobs.orderBy(F.desc("start_time"), F.desc("id")).limit(limit)


def priority_band(priority: Column) -> Column:
    """Band of a priority; anything out of range is normal."""
    band = F.lit("normal")
    for name, (low, high) in reversed(t.BANDS.items()):
        band = F.when(priority.between(low, high), F.lit(name)).otherwise(band)
    return band


def queue_stats(entries: DataFrame, queue: str = "queue") -> DataFrame:
    """Size, entries per priority and the most urgent priority of every queue."""
    per = entries.groupBy(queue, "priority").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(queue).agg(
        F.sum("n").alias("size"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("priority", "n")))).alias("priorities"),
        F.min("priority").alias("highest_priority"),
    )


def band_stats(entries: DataFrame) -> DataFrame:
    return queue_stats(entries.withColumn("band", priority_band(F.col("priority"))), "band")


def language_breakdown(files: DataFrame) -> DataFrame:
    """Files per source and language with their share; the window runs over the counts only."""
    per = files.groupBy("source_id", "language").agg(F.count(F.lit(1)).alias("files"))
    share = F.round(F.col("files") / F.sum("files").over(Window.partitionBy("source_id")), 6)
    return per.withColumn("share", share)


def source_stats(files: DataFrame, chunks: DataFrame, jobs: DataFrame) -> DataFrame:
    """Files, bytes, chunks and the duration of the last finished job per source."""
    f = files.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("files_indexed"), F.sum("size").alias("total_size")
    )
    c = chunks.groupBy("source_id").agg(F.count(F.lit(1)).alias("chunks_created"))
    seconds = (F.unix_micros("end_time") - F.unix_micros("start_time")) / 1_000_000
    j = (
        jobs.where("end_time is not null")
        .groupBy("source_id")
        .agg(F.max_by(seconds, F.struct("end_time", "id")).cast("long").alias("last_sync_seconds"))
    )
    return f.join(c, "source_id", "left").join(j, "source_id", "left").withColumn(
        "chunks_created", F.coalesce("chunks_created", F.lit(0))
    )


def dlq_candidates(failures: DataFrame, max_retries: int = 3) -> DataFrame:
    """Every ``max_retries``-th failure of a message becomes a dead-letter envelope; counting then restarts.

    A value that is no JSON goes as a string, a missing one as null, so the envelope is always JSON.
    """
    # only the ids are ranked; payloads move once, for the attempts that die
    counted = ranked(failures.select("topic", "partition", "offset", "seq"), [F.col("seq")], ["topic", "partition", "offset"], "_attempt")
    dead = failures.join(counted.where(F.col("_attempt") % max_retries == 0).select("seq"), "seq", "left_semi")
    return dead.select(F.concat(F.lit("dlq."), "topic").alias("topic"), "key", dead_letter_value(max_retries).alias("value"), "seq")


def dead_letter_value(max_retries: int) -> Column:
    """The envelope of a row with topic, partition, offset, value and error."""
    return F.concat(
        F.lit('{"original_topic":'), _json_string(F.col("topic")),
        F.lit(',"original_partition":'), F.col("partition").cast("string"),
        F.lit(',"original_offset":'), F.col("offset").cast("string"),
        F.lit(',"original_value":'),
        F.coalesce(F.when(F.try_parse_json("value").isNotNull(), F.col("value")), _json_string(F.col("value")), F.lit("null")),
        F.lit(',"error":'), F.coalesce(_json_string(F.col("error")), F.lit("null")),
        F.lit(f',"retry_count":{max_retries}}}'),
    )


def _json_string(text: Column) -> Column:
    """A JSON string literal, null for null."""
    boxed = F.to_json(F.array(text))
    return F.when(text.isNotNull(), F.substr(boxed, F.lit(2), F.length(boxed) - 2))


def bloom_stats(flagged: DataFrame, expected_items: int = 100_000, false_positive_rate: float = 0.01) -> DataFrame:
    """Size and fill of the filter after a pass over the flagged items."""
    bits, hashes = k.bloom_size(expected_items, false_positive_rate)
    counted = flagged.agg(
        F.count_if(~F.col("is_duplicate")).alias("items_added"), F.count(F.lit(1)).alias("checks"),
        F.count_if("is_duplicate").alias("positives"),
    )
    fill = F.col("items_added") * hashes / F.lit(bits)
    return counted.select(
        F.lit(bits).cast("long").alias("size_bits"), F.lit(-(-bits // 8)).cast("long").alias("size_bytes"),
        F.lit(hashes).cast("long").alias("num_hashes"), "items_added", "checks", "positives",
        fill.alias("fill_ratio"), F.pow(1 - F.exp(-fill), F.lit(hashes)).alias("estimated_false_positive_rate"),
    )


def reuse_stats(requests: DataFrame) -> DataFrame:
    n = requests.agg(F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"))
    total = F.col("hits") + F.col("misses")
    return n.withColumn("hit_rate", F.when(total > 0, F.col("hits") / total).otherwise(F.lit(0.0)))


def destination_health(calls: DataFrame) -> DataFrame:
    """Totals per destination, the last failure and the successes since then."""
    totals = calls.groupBy("destination").agg(
        F.count_if(~F.col("ok")).alias("failures"), F.count_if("ok").alias("successes"),
        F.count(F.lit(1)).alias("total_requests"),
        F.max(F.when(~F.col("ok"), F.struct("ts", "seq"))).alias("_last"),
    )
    # successes after the last failure: one narrow pass against one row per destination
    marks = totals.select("destination", "_last")
    after = (
        calls.where("ok").select("destination", F.struct("ts", "seq").alias("_at"))
        .join(marks, "destination")
        .where(F.col("_last").isNull() | (F.col("_at") > F.col("_last")))
        .groupBy("destination").agg(F.count(F.lit(1)).alias("consecutive_successes"))
    )
    return totals.join(after, "destination", "left").select(
        "destination", "failures", "successes", "total_requests", F.col("_last.ts").alias("last_failure_time"),
        F.coalesce("consecutive_successes", F.lit(0)).alias("consecutive_successes"),
    )


def consume_summary(messages: DataFrame, batch_size: int = 100) -> DataFrame:
    """Messages handled per batch in arrival order."""
    at = ranked(messages.select("seq", "ok"), [F.col("seq")])
    batch = F.floor((F.col("rn") - 1) / batch_size).alias("batch")
    return at.groupBy(batch).agg(F.count(F.lit(1)).alias("polled"), F.count_if("ok").alias("processed"))


def chunk_job_batches(docs: DataFrame, batch_size: int = 100) -> DataFrame:
    """Job payloads of at most ``batch_size`` documents of one source."""
    # only the ids are ranked; contents move once to their rank and once to their batch
    at = ranked(docs.select("source_id", "seq"), [F.col("seq")], ["source_id"])
    placed = docs.join(at.select("seq", F.floor((F.col("rn") - 1) / batch_size).alias("batch")), "seq")
    item = F.struct(
        F.col("seq").alias("seq"),
        F.struct("id", "source_id", "source_kind", "content_type", "content", "metadata", "created_at", "updated_at").alias("item"),
    )
    grouped = placed.groupBy("source_id", "source_kind", "batch").agg(
        F.array_sort(F.collect_list(item), lambda a, b: F.signum(a["seq"] - b["seq"]).cast("int")).alias("_rows")
    )
    return grouped.select(
        "source_id", "source_kind", "batch", F.transform("_rows", lambda r: r["item"]).alias("items"),
        F.size("_rows").alias("item_count"),
    )


def job_progress(files: DataFrame) -> DataFrame:
    """Files of a job, how many are processed or failed, and the whole percent done."""
    n = files.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("files_total"), F.count_if("processed").alias("files_processed"),
        F.count_if("failed").alias("errors"),
    )
    return n.withColumn("percent", F.floor(100 * F.col("files_processed") / F.col("files_total")))


def callback_summary(callbacks: DataFrame) -> DataFrame:
    return callbacks.groupBy("job_id").agg(
        F.sum(F.size("chunks")).alias("chunks_processed"),
        F.sum(F.when(F.col("errors").isNull(), 0).otherwise(F.size("errors"))).alias("errors"),
    )


def retention_report(bodies: DataFrame, chunks: DataFrame, vectors: DataFrame, as_of: Column, tenant: object | None = None) -> DataFrame:
    """Expired bodies, stale and orphaned chunks, and the rows a retired tenant would lose.

    One pass over the bodies and one over the chunks; only stale chunks that name a node look it up.
    """
    stale = (F.col("embedding_state") == "pending") & (F.col("created_at") < as_of - F.make_dt_interval(hours=F.lit(24)))
    nodes = vectors.select(F.col("node_id").alias("neo4j_id"))
    lost = chunks.where(stale & F.col("neo4j_id").isNotNull()).select("neo4j_id").join(nodes, "neo4j_id", "left_anti")
    of_tenant = F.col("tenant_id") == tenant if tenant is not None else F.lit(False)
    c = chunks.agg(
        F.count(F.lit(1)).alias("chunks"), F.count_if(of_tenant).alias("tenant_chunks"),
        F.count_if(stale).alias("stale_pending"), F.count_if(stale & F.col("neo4j_id").isNull()).alias("orphaned_chunks"),
    )
    o = lost.agg(F.count(F.lit(1)).alias("orphaned_chunks"))
    b = bodies.agg(F.count_if(F.col("purge_at") <= as_of).alias("expired_bodies"))
    chunk_metrics = _as_metrics(c).unionByName(_as_metrics(o)).groupBy("metric").agg(F.sum("value").alias("value"))
    return _as_metrics(b).unionByName(chunk_metrics)


def _as_metrics(one_row: DataFrame) -> DataFrame:
    pairs = [F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in one_row.columns]
    return one_row.select(F.explode(F.array(*pairs)).alias("m")).select("m.*")


def removal_counts(files: DataFrame, chunks: DataFrame, removed: DataFrame) -> DataFrame:
    """Files and chunks that go when sources are removed."""
    f = files.groupBy("source_id").agg(F.count(F.lit(1)).alias("files_removed"))
    c = chunks.groupBy("source_id").agg(F.count(F.lit(1)).alias("chunks_removed"))
    return removed.select("source_id").join(f, "source_id", "left").join(c, "source_id", "left").select(
        "source_id", F.coalesce("files_removed", F.lit(0)).alias("files_removed"),
        F.coalesce("chunks_removed", F.lit(0)).alias("chunks_removed"),
    )
