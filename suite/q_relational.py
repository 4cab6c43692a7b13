"""Joins, aggregates, lifecycle and set operations on the state views."""

import datetime

from pyspark.sql import functions as F

from suite import views as v
from suite.q_content import fixed_now, docs
from suite.registry import query
from tributary.functions import classify as c
from tributary.operators import aggregates as agg
from tributary.operators import joins, lifecycle
from tributary.operators import changes as ch
from tributary.session import fresh_path
from tributary.sources import tables
from tributary.sources.retention import VersionedTable, expire_bodies, retire_tenant_folders


MID = datetime.datetime(1998, 6, 1)
MID_MONTH = datetime.datetime(1998, 6, 15, 12)


def mid():
    return F.lit(MID).cast("timestamp_ntz")


SQL_MID = "TIMESTAMP '1998-06-01'"


def vectors(spark, d):
    return v.table(spark, d, "embeddings").select(F.col("vec_id").alias("node_id"))


@query("job_connector", """SELECT j.id, j.status, c.id AS connector_id, c.type AS connector_type, c.tenant_id AS connector_tenant
  FROM sync_jobs j JOIN connectors c ON j.connector_id = c.id""")
def job_connector(spark, d):
    return joins.job_connector(v.sync_jobs(spark, d), v.connectors(spark, d)).select(
        "id", "status", "connector_id", "connector_type", "connector_tenant"
    )


@query("sync_status", """SELECT c.id AS connector_id, last_sync_time, j.id AS last_job_id, j.status AS last_sync_status, j.stats_json AS stats
  FROM connectors c LEFT JOIN (SELECT * FROM sync_jobs QUALIFY row_number() OVER (PARTITION BY connector_id ORDER BY start_time DESC, id DESC) = 1) j
  ON c.id = j.connector_id""")
def sync_status(spark, d):
    return joins.sync_status(v.connectors(spark, d), v.sync_jobs(spark, d))


def item_changes(spark, d):
    """Up to three changes per file, a day apart."""
    i = F.col("id")

    def change(kind, days):
        at = v.at(F.lit(1704067200) + i + days * 86400)
        return F.struct(kind.alias("change_type"), at.alias("timestamp"))

    base = F.when(i % 3 == 0, F.lit("created")).when(i % 3 == 1, F.lit("updated")).otherwise(F.lit("deleted"))
    all_ = F.array_compact(F.array(
        change(base, 0), F.when(i % 4 == 0, change(F.lit("deleted"), 1)), F.when(i % 5 == 0, change(F.lit("updated"), 2))
    ))
    f = v.files(spark, d).select("source_id", F.col("path").alias("item_id"), v.text(v.div("id", 5)).alias("cursor"), F.explode(all_).alias("e"))
    return f.select("source_id", "item_id", "cursor", "e.*")


SQL_CHANGES = """(SELECT source_id, path AS item_id, CAST(id // 5 AS VARCHAR) AS cursor, id,
    CASE k WHEN 0 THEN CASE id % 3 WHEN 0 THEN 'created' WHEN 1 THEN 'updated' ELSE 'deleted' END WHEN 1 THEN 'deleted' ELSE 'updated' END AS change_type,
    make_timestamp((1704067200 + id + k * 86400) * 1000000) AS timestamp
  FROM files, range(3) r(k) WHERE k = 0 OR (k = 1 AND id % 4 = 0) OR (k = 2 AND id % 5 = 0))"""


def items(spark, d):
    """Content that can be fetched: one file in ten is gone."""
    return v.files(spark, d).where(F.col("id") % 10 != 7).withColumn("external_id", F.col("path"))


@query("incremental_documents", f"""SELECT f.id, f.path, x.change_type, x.cursor, strlen(f.content) AS size_bytes FROM
  (SELECT * FROM {SQL_CHANGES} QUALIFY row_number() OVER (PARTITION BY source_id, item_id ORDER BY timestamp DESC) = 1) x
  JOIN files f ON f.source_id = x.source_id AND f.path = x.item_id WHERE x.change_type <> 'deleted' AND f.id % 10 <> 7""")
def incremental_documents(spark, d):
    found = joins.incremental_documents(item_changes(spark, d), items(spark, d))
    return found.select("id", "path", "change_type", "cursor", F.octet_length("content").cast("long").alias("size_bytes"))


@query("incremental_cursor", f"""SELECT source_id, count(*) AS changes, max(timestamp) AS cursor FROM {SQL_CHANGES}
  WHERE timestamp >= TIMESTAMP '2024-01-02 00:01:00' GROUP BY 1""")
def incremental_cursor(spark, d):
    since = F.lit(datetime.datetime(2024, 1, 2, 0, 1)).cast("timestamp_ntz")
    fresh = ch.changes_since(item_changes(spark, d), since)
    n = fresh.groupBy("source_id").agg(F.count(F.lit(1)).alias("changes"))
    return ch.new_cursor(fresh, ["source_id"]).join(n, "source_id")


@query("insert_if_absent", """SELECT min(seq) AS seq, sha256(content) AS content_hash FROM files f
  WHERE NOT EXISTS (SELECT 1 FROM files s WHERE s.id % 8 = 3 AND s.content = f.content) GROUP BY content""")
def insert_if_absent(spark, d):
    rows = docs(spark, d).select("seq", F.lit("t").alias("tenant_id"), F.lit("s").alias("source_id"), F.sha2("content", 256).alias("content_hash"))
    stored = rows.where(F.col("seq") % 8 == 3)
    new = joins.insert_if_absent(rows, stored, ["tenant_id", "source_id", "content_hash"], "seq")
    return new.select("seq", "content_hash")


@query("orphan_files", "SELECT id, path FROM files WHERE id % 10 = 2")
def orphan_files(spark, d):
    f = v.files(spark, d)
    return joins.orphan_files(f, f.where(F.col("id") % 10 != 2)).select("id", "path")


@query("cascade_delete", """SELECT 'jobs' AS child, id FROM sync_jobs WHERE connector_id NOT IN (SELECT id FROM connectors WHERE status = 'disabled')
  UNION ALL SELECT 'events', seq FROM requests WHERE key NOT IN (SELECT id FROM connectors WHERE status = 'disabled')""")
def cascade_delete(spark, d):
    gone = v.connectors(spark, d).where("status = 'disabled'")
    jobs = joins.cascade_delete(v.sync_jobs(spark, d), gone)
    events = joins.cascade_delete(v.requests(spark, d).withColumnRenamed("key", "connector_id"), gone)
    return jobs.select(F.lit("jobs").alias("child"), "id").unionByName(
        events.select(F.lit("events").alias("child"), F.col("seq").alias("id"))
    )


@query("callback_check", """SELECT doc_id, job_id, doc_id % 7 = 0 AS invalid_id,
  doc_id % 7 <> 0 AND doc_id % 5 <> 0 AND doc_id IN (SELECT id FROM connectors) AS connector_exists FROM callbacks""")
def callback_check(spark, d):
    known = v.connectors(spark, d).select(F.concat(F.lit(v.ZERO_UUID), F.lpad(v.text("id"), 12, "0")).alias("id"))
    return joins.callback_check(v.callbacks(spark, d), known).select("doc_id", "job_id", "invalid_id", "connector_exists")


@query("missing_vector_chunks", f"""SELECT id, source_id, wanted_node, created_at FROM chunks WHERE embedding_state = 'pending'
  AND created_at < {SQL_MID} - INTERVAL 24 HOUR AND wanted_node NOT IN (SELECT vec_id FROM embeddings)""")
def missing_vector_chunks(spark, d):
    wanted = v.chunks(spark, d).withColumn("neo4j_id", F.col("wanted_node"))
    return joins.missing_vector_chunks(wanted, vectors(spark, d), mid()).select("id", "source_id", "wanted_node", "created_at")


@query("reprocess_plan", f"""SELECT id, CASE WHEN created_at + INTERVAL 7 DAY > TIMESTAMP '2024-01-02' THEN 'reuse' ELSE 'refetch' END AS plan
  FROM (SELECT id, make_timestamp((1703462400 + id * 600) * 1000000) AS created_at FROM files)""")
def reprocess_plan(spark, d):
    i = F.col("id")
    made = v.at(F.lit(1703462400) + i * 600)
    rows = v.files(spark, d).select("id", made.alias("created_at"))
    stored = rows.select(F.col("id").alias("chunk_id"), (F.col("created_at") + F.make_dt_interval(F.lit(7))).alias("purge_at"))
    now = F.lit(datetime.datetime(2024, 1, 2)).cast("timestamp_ntz")
    return joins.reprocess_plan(rows, stored, now).select("id", "plan")


@query("events_with_connector", """SELECT seq FROM requests WHERE key IN (SELECT id FROM connectors WHERE status = 'active')""")
def events_with_connector(spark, d):
    live = v.connectors(spark, d).where("status = 'active'")
    return joins.events_with_connector(v.requests(spark, d).withColumnRenamed("key", "connector_id"), live).select("seq")


@query("sync_stats", "SELECT source_id AS job_id, count(*) AS documents_synced, 'full' AS sync_type FROM files GROUP BY 1")
def sync_stats(spark, d):
    return agg.sync_stats(v.files(spark, d).withColumnRenamed("source_id", "job_id"))


@query("chunk_count", "SELECT 'all' AS scope, count(*) AS chunks FROM chunks UNION ALL SELECT 'tenant 3', count(*) FROM chunks WHERE tenant_id = 3")
def chunk_count(spark, d):
    k = v.chunks(spark, d)
    return agg.chunk_count(k).withColumn("scope", F.lit("all")).unionByName(agg.chunk_count(k, 3).withColumn("scope", F.lit("tenant 3")))


@query("chunks_by_state", """SELECT 'all' AS scope, embedding_state, count(*) AS chunks FROM chunks GROUP BY 2
  UNION ALL SELECT 'tenant 3', embedding_state, count(*) FROM chunks WHERE tenant_id = 3 GROUP BY 2""")
def chunks_by_state(spark, d):
    k = v.chunks(spark, d)
    return agg.chunks_by_state(k).withColumn("scope", F.lit("all")).unionByName(
        agg.chunks_by_state(k, 3).withColumn("scope", F.lit("tenant 3"))
    )


def stats_rows(stats, key):
    return stats.select(
        key, "size", "highest_priority", F.explode("priorities").alias("priority", "entries")
    )


@query("queue_stats", """SELECT queue, CAST(sum(count(*)) OVER (PARTITION BY queue) AS BIGINT) AS size, min(priority) OVER (PARTITION BY queue) AS highest_priority,
  priority, count(*) AS entries FROM queue GROUP BY queue, priority""")
def queue_stats(spark, d):
    return stats_rows(agg.queue_stats(v.queue(spark, d)), "queue")


SQL_BAND = """CASE WHEN priority <= 2 THEN 'critical' WHEN priority <= 4 THEN 'high' WHEN priority <= 6 THEN 'normal'
  WHEN priority <= 9 THEN 'low' ELSE 'normal' END"""


@query("band_stats", f"""SELECT band, CAST(sum(count(*)) OVER (PARTITION BY band) AS BIGINT) AS size, min(priority) OVER (PARTITION BY band) AS highest_priority,
  priority, count(*) AS entries FROM (SELECT *, {SQL_BAND} AS band FROM routes) GROUP BY band, priority""")
def band_stats(spark, d):
    return stats_rows(agg.band_stats(v.routes(spark, d)), "band")


@query("language_breakdown", """SELECT source_id, language, count(*) AS files, round(count(*) / sum(count(*)) OVER (PARTITION BY source_id), 6) AS share
  FROM files GROUP BY 1, 2""")
def language_breakdown(spark, d):
    return agg.language_breakdown(v.files(spark, d))


@query("source_stats", """SELECT f.source_id, files_indexed, total_size, coalesce(chunks_created, 0) AS chunks_created, last_sync_seconds FROM
  (SELECT id % 100 AS source_id, count(*) AS files_indexed, CAST(sum(size) AS BIGINT) AS total_size FROM files GROUP BY 1) f
  LEFT JOIN (SELECT source_id % 100 AS source_id, count(*) AS chunks_created FROM chunks GROUP BY 1) c USING (source_id)
  LEFT JOIN (SELECT connector_id % 100 AS source_id, CAST(arg_max(epoch(end_time) - epoch(start_time), (end_time, id)) AS BIGINT) AS last_sync_seconds
    FROM sync_jobs WHERE end_time IS NOT NULL GROUP BY 1) j USING (source_id)""")
def source_stats(spark, d):
    f = v.files(spark, d).withColumn("source_id", F.col("id") % 100)
    k = v.chunks(spark, d).withColumn("source_id", F.col("source_id") % 100)
    j = v.sync_jobs(spark, d).withColumn("source_id", F.col("connector_id") % 100).withColumns(
        {x: F.col(x).cast("timestamp") for x in ("start_time", "end_time")}
    )
    return agg.source_stats(f, k, j)


SQL_CALLBACK_ERRORS = "CAST(sum(CASE WHEN doc_id % 9 = 0 THEN 1 ELSE 0 END) AS BIGINT)"


@query("job_progress", """SELECT source_id AS job_id, count(*) AS files_total, count(*) FILTER (WHERE embedding_state = 'embedded') AS files_processed,
  count(*) FILTER (WHERE embedding_state = 'failed') AS errors, 100 * count(*) FILTER (WHERE embedding_state = 'embedded') // count(*) AS percent
  FROM chunks GROUP BY 1""")
def job_progress(spark, d):
    return agg.job_progress(v.chunks(spark, d).select(
        F.col("source_id").alias("job_id"), (F.col("embedding_state") == "embedded").alias("processed"),
        (F.col("embedding_state") == "failed").alias("failed"),
    ))


@query("callback_summary", f"SELECT job_id, CAST(sum(len(lines)) AS BIGINT) AS chunks_processed, {SQL_CALLBACK_ERRORS} AS errors FROM callbacks GROUP BY 1")
def callback_summary(spark, d):
    return agg.callback_summary(v.callbacks(spark, d))


SQL_REPORT = f"""SELECT 'expired_bodies' AS metric, count(*) FILTER (WHERE purge_at <= {SQL_MID}) AS value FROM bodies
  UNION ALL SELECT 'chunks', count(*) FROM chunks
  UNION ALL SELECT 'tenant_chunks', count(*) FILTER (WHERE tenant_id = 3) FROM chunks
  UNION ALL SELECT 'stale_pending', count(*) FROM chunks WHERE embedding_state = 'pending' AND created_at < {SQL_MID} - INTERVAL 24 HOUR
  UNION ALL SELECT 'orphaned_chunks', count(*) FROM chunks WHERE embedding_state = 'pending' AND created_at < {SQL_MID} - INTERVAL 24 HOUR
    AND wanted_node NOT IN (SELECT vec_id FROM embeddings)"""


@query("retention_report", SQL_REPORT)
def retention_report(spark, d):
    wanted = v.chunks(spark, d).withColumn("neo4j_id", F.col("wanted_node"))
    return agg.retention_report(v.bodies(spark, d), wanted, vectors(spark, d), mid(), 3)


@query("removal_counts", """SELECT id AS source_id, (SELECT count(*) FROM sync_jobs j WHERE j.connector_id = c.id) AS files_removed,
  (SELECT count(*) FROM chunks k WHERE k.source_id = c.id) AS chunks_removed FROM connectors c WHERE status = 'disabled'""")
def removal_counts(spark, d):
    removed = v.connectors(spark, d).where("status = 'disabled'").select(F.col("id").alias("source_id"))
    files = v.sync_jobs(spark, d).select(F.col("connector_id").alias("source_id"))
    return agg.removal_counts(files, v.chunks(spark, d), removed)


@query("union_sources", """SELECT CAST(id AS VARCHAR) AS external_id, source_id, connector_type, path, language, strlen(content) AS size_bytes,
    CASE WHEN connector_type IN ('github','gitlab','bitbucket') THEN 'code_repo' WHEN connector_type IN ('notion','confluence') THEN 'wiki'
      WHEN connector_type = 'slack' THEN 'chat' WHEN connector_type = 'url_scraper' THEN 'web' ELSE 'document' END AS source_kind FROM files
  UNION ALL SELECT CAST(page_id AS VARCHAR), 'pages', 'url_scraper', url, NULL, strlen(html), 'web' FROM pages
  UNION ALL SELECT conv_id || ':' || turn, 'conversations', 'slack', NULL, NULL, strlen(text), 'chat' FROM conversations""")
def union_sources(spark, d):
    f = v.files(spark, d).select(v.text("id").alias("external_id"), "source_id", "connector_type", "path", "language", "content")
    web = v.table(spark, d, "pages").select(
        v.text("page_id").alias("external_id"), F.lit("pages").alias("source_id"), F.lit("url_scraper").alias("connector_type"),
        F.col("url").alias("path"), F.col("html").alias("content"),
    )
    chat = v.table(spark, d, "conversations").select(
        F.concat(v.text("conv_id"), F.lit(":"), v.text("turn")).alias("external_id"), F.lit("conversations").alias("source_id"),
        F.lit("slack").alias("connector_type"), F.col("text").alias("content"),
    )
    both = joins.union_all([f, web, chat])
    return both.select(
        "external_id", "source_id", "connector_type", "path", "language", F.octet_length("content").cast("long").alias("size_bytes"),
        c.source_kind(F.col("connector_type")).alias("source_kind"),
    )


@query("listing_diff", """SELECT source_id, path, CASE id % 10 WHEN 1 THEN 'added' WHEN 2 THEN 'removed' ELSE 'changed' END AS change FROM files WHERE id % 10 IN (1, 2, 3)""")
def listing_diff(spark, d):
    i = F.col("id")
    f = v.files(spark, d).select("id", "source_id", "path", "content")
    old = f.where(i % 10 != 1).withColumn("content_hash", F.sha2("content", 256))
    new = f.where(i % 10 != 2).withColumn(
        "content_hash", F.sha2(F.when(i % 10 == 3, F.concat("content", F.lit("!"))).otherwise(F.col("content")), 256)
    )
    return joins.listing_diff(old, new).select("source_id", "path", "change")


# ---- lifecycle ---------------------------------------------------------------------------------


@query("purge_finished_jobs", f"""SELECT id, status, end_time FROM sync_jobs WHERE status NOT IN ('completed','failed') OR end_time IS NULL
  OR end_time >= {SQL_MID} - INTERVAL 7 DAY""")
def purge_finished_jobs(spark, d):
    table = VersionedTable(spark, fresh_path(spark, "jobs"))
    table.replace(v.sync_jobs(spark, d).select("id", "status", "end_time"))
    table.replace(lifecycle.purge_finished_jobs(table.read(), mid()))
    table.drop_old()
    return table.read()


@query("stale_pending", f"SELECT id, created_at FROM chunks WHERE embedding_state = 'pending' AND created_at < {SQL_MID} - INTERVAL 24 HOUR")
def stale_pending(spark, d):
    return joins.stale_pending(v.chunks(spark, d), mid()).select("id", "created_at")


@query("ttl_expire", "SELECT id, purge_at FROM bodies WHERE purge_at > TIMESTAMP '1998-06-15 12:00:00'")
def ttl_expire(spark, d):
    path = fresh_path(spark, "bodies")
    # a backlog of years: a folder for each month
    tables.write_chunk_bodies(v.chunks(spark, d).select("id", "created_at"), path, period="month")
    expire_bodies(spark, path, MID_MONTH, period="month")
    return spark.read.parquet(path).select("id", "purge_at")


@query("retire_tenant", """SELECT 'kept' AS store, count(*) AS n FROM chunks WHERE tenant_id <> 4
  UNION ALL SELECT 'chunks', count(*) FROM chunks WHERE tenant_id = 4 UNION ALL SELECT 'bodies', count(*) FROM bodies WHERE tenant_id = 4""")
def retire_tenant(spark, d):
    chunks, bodies = fresh_path(spark, "chunks"), fresh_path(spark, "bodies")
    tables.write_state(v.chunks(spark, d), "chunks", chunks)
    tables.write_chunk_bodies(v.chunks(spark, d).select("id", "tenant_id", "created_at"), bodies, partition_by=("tenant_id",))
    removed = retire_tenant_folders(spark, 4, {
        "chunks": (tables.read_state(spark, "chunks", chunks), chunks, ["tenant_id"]),
        "bodies": (spark.read.parquet(bodies), bodies, ["tenant_id"]),
    })
    kept = tables.read_state(spark, "chunks", chunks).agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("store"), "n")
    return kept.unionByName(removed)


@query("storage_mode_split", """SELECT 'metadata' AS store, id, NULL AS bytes, NULL AS purge_at FROM files
  UNION ALL SELECT 'mongo-ttl', id, strlen(content), TIMESTAMP '2024-02-08' FROM files UNION ALL SELECT 'postgres', id, strlen(content), NULL FROM files""")
def storage_mode_split(spark, d):
    k = v.files(spark, d).select("id", "tenant_id", "content").withColumn("created_at", fixed_now())
    out = []
    for mode in ("ephemeral", "mongo-ttl", "postgres"):
        meta, body = lifecycle.storage_mode_split(k, mode)
        out.append(body.select(F.lit(mode).alias("store"), "id", F.octet_length("content").cast("long").alias("bytes"), "purge_at"))
    out.append(meta.select(F.lit("metadata").alias("store"), "id"))
    return joins.union_all(out)


def job_log(spark, d):
    """Status log of every job; one in thirteen loses its running step."""
    o = v.table(spark, d, "orders")
    last = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("failed")).otherwise(F.lit("completed"))
    steps = F.array_compact(F.array(
        F.lit("pending"), F.when((F.col("o_orderstatus") != "O") & (F.col("o_orderkey") % 13 != 0), F.lit("running")),
        F.when(F.col("o_orderstatus") == "F", last),
    ))
    key = F.col("o_orderkey")
    log = o.select(key.alias("job_id"), F.col("o_custkey").alias("connector_id"), "o_orderdate", F.posexplode(steps).alias("i", "status"))
    return log.select(
        "job_id", "connector_id", (F.col("job_id") * 10 + F.col("i")).alias("seq"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=F.col("i"))).alias("ts"), "status",
        (F.col("job_id") % 100).alias("documents_synced"), F.concat(F.lit("error "), v.text("job_id")).alias("error_message"),
        F.when((F.col("job_id") % 3 != 0) & (F.col("status") == "completed"), F.concat(F.lit("cur"), v.text("job_id"))).alias("cursor"),
    )


SQL_LOG = """(SELECT o_orderkey AS job_id, o_custkey AS connector_id, o_orderkey * 10 + i AS seq, o_orderdate + to_hours(i) AS ts, status,
    CASE WHEN o_orderkey % 3 <> 0 AND status = 'completed' THEN 'cur' || o_orderkey END AS cursor
  FROM (SELECT *, unnest(steps) AS status, unnest(range(len(steps))) AS i FROM (SELECT *, list_filter(['pending',
    CASE WHEN o_orderstatus <> 'O' AND o_orderkey % 13 <> 0 THEN 'running' END,
    CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'failed' ELSE 'completed' END END], lambda x: x IS NOT NULL) AS steps FROM orders)))"""


@query("job_lifecycle", f"""SELECT job_id, arg_max(status, seq) AS status, min(ts) AS start_time,
  max(CASE WHEN status IN ('completed','failed') THEN ts END) AS end_time,
  CASE WHEN arg_max(status, seq) = 'completed' THEN job_id % 100 END AS documents_synced,
  CASE WHEN arg_max(status, seq) = 'failed' THEN 'error ' || job_id END AS error_message,
  count(*) FILTER (WHERE coalesce(b, 'none') || '>' || status NOT IN ('none>pending','pending>running','pending>failed','running>completed','running>failed')) AS illegal_steps
  FROM (SELECT *, lag(status) OVER (PARTITION BY job_id ORDER BY seq) AS b FROM {SQL_LOG}) GROUP BY 1""")
def job_lifecycle(spark, d):
    return lifecycle.job_lifecycle(job_log(spark, d))


@query("connector_state", f"""SELECT connector_id, CASE arg_max(status, seq) WHEN 'running' THEN 'syncing' WHEN 'completed' THEN 'active' ELSE 'error' END AS status,
  max(CASE WHEN status = 'completed' THEN ts END) AS last_sync_time,
  arg_max(cursor, seq) FILTER (WHERE cursor IS NOT NULL) AS last_sync_cursor
  FROM {SQL_LOG} WHERE status <> 'pending' GROUP BY 1""")
def connector_state(spark, d):
    return lifecycle.connector_state(job_log(spark, d))


@query("new_jobs", """SELECT CASE WHEN c.id IS NULL THEN 'rejected' ELSE 'accepted' END AS outcome, seq AS request_id, o.connector_id, c.tenant_id,
  CASE WHEN c.id IS NOT NULL THEN sha256(seq || '|' || o.connector_id) END AS id, CASE WHEN c.id IS NOT NULL THEN 'pending' END AS status
  FROM (SELECT o_orderkey AS seq, o_custkey * 2 AS connector_id FROM orders) o LEFT JOIN connectors c ON c.id = o.connector_id""")
def new_jobs(spark, d):
    asked = v.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("request_id"), (F.col("o_custkey") * 2).alias("connector_id"), F.lit("full").alias("type"),
        F.col("o_orderdate").alias("requested_at"),
    )
    jobs, rejected = lifecycle.new_jobs(asked, v.connectors(spark, d))
    good = jobs.select(F.lit("accepted").alias("outcome"), "request_id", "connector_id", "tenant_id", "id", "status")
    bad = rejected.select(F.lit("rejected").alias("outcome"), "request_id", "connector_id")
    return good.unionByName(bad, allowMissingColumns=True)


@query("upsert_state", """SELECT id, CASE WHEN id % 3 = 0 AND id % 2 = 0 THEN 'done' ELSE status END AS status,
  CASE WHEN id % 3 = 0 AND id % 2 = 0 THEN 11 ELSE 10 END AS version FROM sync_jobs
  UNION ALL SELECT id + 10000000, 'new', 1 FROM sync_jobs WHERE id % 50 = 0""")
def upsert_state(spark, d):
    jobs = v.sync_jobs(spark, d).select("id", "status", F.lit(10).alias("version"))
    changed = jobs.where("id % 3 = 0").select("id", F.lit("done").alias("status"), F.when(F.col("id") % 2 == 0, 11).otherwise(9).alias("version"))
    new = jobs.where("id % 50 = 0").select((F.col("id") + 10000000).alias("id"), F.lit("new").alias("status"), F.lit(1).alias("version"))
    table = VersionedTable(spark, fresh_path(spark, "jobs"))
    table.replace(jobs)
    table.replace(lifecycle.upsert_state(table.read(), changed.unionByName(new), ["id"], "version"))
    return table.read()
