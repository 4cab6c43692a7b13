"""Hashing, payloads, envelopes, signatures, routing."""

import datetime

from pyspark.sql import functions as F

from suite import views as v
from suite.q_classify import SQL_STRATEGY
from suite.registry import query
from tributary.functions import classify as c
from tributary.functions import content as k
from tributary.operators import aggregates as agg
from tributary.operators import events as ev
from tributary.operators import joins, throttle


def fixed_now():
    return F.lit(datetime.datetime(2024, 2, 1)).cast("timestamp_ntz")


def docs(spark, d):
    """Files as normalized documents."""
    f = v.files(spark, d)
    ext = c.file_extension(F.col("path"))
    return f.withColumns({
        "id": F.col("id").cast("string"), "connector_id": F.col("source_id"),
        "content_type": c.content_type_by_ext(ext), "source_kind": c.source_kind(F.col("connector_type")),
        "created_at": v.at(F.lit(1704067200) + F.col("seq")),
    })


@query("content_hash", "SELECT id, sha256(content) AS content_hash FROM files")
def content_hash(spark, d):
    return v.files(spark, d).select("id", k.content_hash(F.col("content")).alias("content_hash"))


def size_bytes():
    return F.octet_length("content").cast("long")


@query("route_by_size", """SELECT id, strlen(content) AS size_bytes, CASE WHEN strlen(content) <= 4096 THEN 'inline' ELSE 'reference' END AS route,
  'inline' AS route_without_store FROM files""")
def route_by_size(spark, d):
    return v.files(spark, d).select(
        "id", size_bytes().alias("size_bytes"), k.route_by_size(size_bytes(), 4).alias("route"),
        k.route_by_size(size_bytes(), 4, blob_store=False).alias("route_without_store"),
    )


SQL_BLOB_KEY = """tenant_id || '/' || id || '/' || sha256(content)
  || CASE WHEN contains(name, '.') THEN '.' || regexp_extract(name, '([^.]*)$', 1) ELSE '' END"""


@query("blob_key", f"SELECT id, {SQL_BLOB_KEY} AS blob_key FROM files")
def blob_key(spark, d):
    f = v.files(spark, d)
    key = k.blob_key(F.col("tenant_id"), F.col("id").cast("string"), k.content_hash(F.col("content")), F.col("name"))
    return f.select("id", key.alias("blob_key"))


@query("normalize_documents", """SELECT sha256(source_id || '|' || id) AS id, source_id, connector_type, CAST(id AS VARCHAR) AS external_id, name, path,
  strlen(content) AS size_bytes, sha256(content) AS content_hash, language, 'text/plain' AS mime_type FROM files WHERE id % 10 <> 3""")
def normalize_documents(spark, d):
    f = v.files(spark, d)
    items = f.select(
        F.col("id").cast("string").alias("id"), "source_id", "connector_type", "name", "path",
        F.create_map(F.lit("seq"), F.col("seq").cast("string")).alias("metadata"),
        fixed_now().alias("created_at"), fixed_now().alias("updated_at"),
    )
    bodies = f.where(F.col("id") % 10 != 3).select(
        "source_id", "path", "content", c.content_type_by_ext(c.file_extension(F.col("path"))).alias("content_type"), "language"
    )
    return ev.normalize_documents(items, bodies).select(
        "id", "source_id", "connector_type", "external_id", "name", "path", "size_bytes", "content_hash", "language",
        "mime_type",
    )


SQL_FLAGS = '\',"ingest_flags":{"for_embeddings":true,"for_graph":true,"priority":"normal"}\''
SQL_HEAD = """'{"tenant_id":"' || tenant_id || '","connector_id":"' || source_id || '","source_type":"' || connector_type
  || '","file_id":"' || id || '","file_name":"' || name || '"' """


@query("ingest_payload", f"""SELECT id, {SQL_HEAD} || ',"file_path":"' || path || '","content":' || CAST(to_json(content) AS VARCHAR) || {SQL_FLAGS}
  || coalesce(',"suggest_chunk_strategy":"' || {SQL_STRATEGY} || '"', '') || ',"size_bytes":' || strlen(content) || '}}' AS payload
  FROM (SELECT * REPLACE (CAST(id AS VARCHAR) AS id), language AS lang FROM files)""")
def ingest_payload(spark, d):
    return ev.ingest_payload(docs(spark, d))


@query("reference_payload", f"""SELECT id, {SQL_HEAD} || ',"blob_url":"s3://blobs/' || {SQL_BLOB_KEY} || '","size_bytes":' || strlen(content) || {SQL_FLAGS}
  || coalesce(',"suggest_chunk_strategy":"' || {SQL_STRATEGY} || '"', '') || '}}' AS payload
  FROM (SELECT * REPLACE (CAST(id AS VARCHAR) AS id), language AS lang FROM files) WHERE strlen(content) > 4096""")
def reference_payload(spark, d):
    large = docs(spark, d).where(k.route_by_size(size_bytes(), 4) == "reference")
    key = k.blob_key(F.col("tenant_id"), F.col("id"), k.content_hash(F.col("content")), F.col("name"))
    return ev.reference_payload(
        large.withColumns({"blob_url": F.concat(F.lit("s3://blobs/"), key), "size_bytes": F.octet_length("content")})
    )


@query("event_envelope", """SELECT id, '{"event_id":"e' || id || '","source_id":"' || source_id || '","file_path":"' || path || '","file_type":'
    || CASE WHEN id % 4 = 0 THEN 'null' ELSE '"t"' END || ',"content":' || CAST(to_json(content) AS VARCHAR) || ',"metadata":{"name":"' || name
    || '"},"timestamp":"' || CASE WHEN id % 2 = 0 THEN '2024-01-01T00:00:00' ELSE '2024-02-01T00:00:00' END || '"}' AS file_ingested,
  '{"event_id":"e' || id || '","source_id":"' || source_id || '","file_path":"' || path || '","language":"' || language || '","normalized_content":null,"entities":null,"metadata":{"name":"'
    || name || '"},"timestamp":"' || CASE WHEN id % 2 = 0 THEN '2024-01-01T00:00:00' ELSE '2024-02-01T00:00:00' END || '"}' AS code_normalized,
  '{"event_id":"e' || id || '","source":"github","event_type":"push","payload":{"path":"' || path || '"},"priority":5}' AS webhook,
  '{"job_id":"j' || id || '","source_id":"' || source_id || '","job_type":"manual","priority":5,"metadata":{"name":"' || name || '"}}' AS sync_job FROM files""")
def event_envelope(spark, d):
    f = v.files(spark, d)
    e = f.withColumns({
        "event_id": F.concat(F.lit("e"), v.text("id")), "file_path": F.col("path"),
        "file_type": F.when(F.col("id") % 4 != 0, F.lit("t")), "metadata": F.create_map(F.lit("name"), F.col("name")),
        "timestamp": F.when(F.col("id") % 2 == 0, F.lit("2024-01-01T00:00:00")), "source": F.lit("github"),
        "event_type": F.lit("push"), "payload": F.create_map(F.lit("path"), F.col("path")),
        "job_id": F.concat(F.lit("j"), v.text("id")), "job_type": F.lit("manual"),
    })
    return e.select("id", *[ev.event_envelope(e, kind, fixed_now()).alias(kind) for kind in ev.ENVELOPES])


@query("event_parse", """SELECT id, CASE id % 5 WHEN 0 THEN 'malformed' WHEN 1 THEN 'missing field' WHEN 2 THEN 'unknown field' END AS error,
  CASE WHEN id % 5 > 2 THEN 'e' || id END AS event_id, CASE WHEN id % 5 > 2 THEN content END AS content, CASE WHEN id % 5 > 2 THEN name END AS meta_name FROM files""")
def event_parse(spark, d):
    f = v.files(spark, d)
    body = {
        "event_id": F.concat(F.lit("e"), v.text("id")), "source_id": F.col("source_id"), "file_path": F.col("path"),
        "file_type": F.lit("t"), "content": F.col("content"), "metadata": F.create_map(F.lit("name"), F.col("name")),
    }

    def dump(**fields):
        return F.to_json(F.struct(*[x.alias(n) for n, x in fields.items()]))

    short = {n: x for n, x in body.items() if n != "file_type"}
    r = F.col("id") % 5
    value = (
        F.when(r == 0, F.concat(F.lit("{"), F.col("content"))).when(r == 1, dump(**short))
        .when(r == 2, dump(**body, extra=F.lit(1))).otherwise(dump(**body))
    )
    parsed = ev.event_parse(f.select("id", value.alias("value")), "file_ingested")
    return parsed.select(
        "id", "error", F.col("event.event_id").alias("event_id"), F.col("event.content").alias("content"),
        F.col("event.metadata")["name"].alias("meta_name"),
    )


@query("route_message", """SELECT seq, message_type, CASE WHEN message_type IN ('file.ingested','code.normalized','chunk.created','embedding.generated','graph.updated') THEN 'kafka'
  WHEN message_type IN ('mail.sent','webhooks') THEN 'unknown' ELSE 'rabbit' END AS backend,
  (message_type IN ('file.ingested','code.normalized','chunk.created','embedding.generated','graph.updated','webhook.github','webhook.gitlab','sync.scheduled','sync.manual')) AS published FROM routes""")
def route_message(spark, d):
    return ev.route_message(v.routes(spark, d)).select("seq", "message_type", "backend", "published")


@query("routing_key", """SELECT seq, CASE WHEN starts_with(message_type, 'webhook.') THEN split_part(message_type, '.', 2) || '.' || event_type
  WHEN starts_with(message_type, 'sync.') THEN split_part(message_type, '.', 2) END AS routing_key FROM routes""")
def routing_key(spark, d):
    return v.routes(spark, d).select("seq", ev.routing_key(F.col("message_type"), F.col("event_type")).alias("routing_key"))


@query("priority_band", """SELECT seq, CASE WHEN priority <= 2 THEN 'critical' WHEN priority <= 4 THEN 'high' WHEN priority <= 6 THEN 'normal'
  WHEN priority <= 9 THEN 'low' ELSE 'normal' END AS band FROM routes""")
def priority_band(spark, d):
    return v.routes(spark, d).select("seq", agg.priority_band(F.col("priority")).alias("band"))


@query("retry_schedule", """SELECT seq, least(1.0 * pow(2.0, seq % 9), 60.0) AS delay_seconds,
  ts + to_microseconds(CAST(least(pow(2.0, seq % 9), 60.0) * 500000 AS BIGINT)) AS earliest_attempt_at,
  ts + to_microseconds(CAST(least(pow(2.0, seq % 9), 60.0) * 1000000 AS BIGINT)) AS latest_attempt_at FROM messages WHERE NOT ok""")
def retry_schedule(spark, d):
    failed = v.messages(spark, d).where(~F.col("ok")).withColumn("attempt", F.col("seq") % 9)
    return throttle.retry_schedule(failed, "ts", "attempt").select("seq", "delay_seconds", "earliest_attempt_at", "latest_attempt_at")


@query("parse_sync_options", """SELECT id, CASE id % 5 WHEN 0 THEN 'py,.RS' WHEN 1 THEN 'md' ELSE '' END AS include_languages,
  CASE WHEN id % 5 = 3 THEN 'dist,x' ELSE '' END AS exclude_paths, CASE WHEN id % 5 = 2 THEN 'Old' ELSE '' END AS exclude_folders,
  CASE WHEN id % 5 = 1 THEN CAST(1.5 AS DOUBLE) END AS max_file_size_mb, id % 5 <> 2 AS include_shared,
  CASE WHEN id % 5 = 0 THEN 'dev' ELSE 'main' END AS branch,
  CASE id % 5 WHEN 0 THEN 'o/r' WHEN 1 THEN 'g/p' WHEN 3 THEN 'r' || id ELSE '' END AS repository,
  CASE WHEN id % 5 = 2 THEN 'root9' END AS folder_id, CASE WHEN id % 5 = 3 THEN 'ws' ELSE '' END AS workspace,
  CASE WHEN id % 5 = 2 THEN '/in' ELSE '' END AS folder_path, CASE WHEN id % 5 = 2 THEN '/srv' ELSE '' END AS path,
  CASE WHEN id % 5 = 3 THEN '*.tmp' ELSE '' END AS exclude_patterns FROM connectors""")
def parse_sync_options(spark, d):
    o = ev.parse_sync_options(v.connectors(spark, d))
    joined = [F.array_join(x, ",").alias(x) for x in ("include_languages", "exclude_paths", "exclude_folders", "exclude_patterns")]
    return o.select("id", *joined, "max_file_size_mb", "include_shared", "branch", "repository", "folder_id", "workspace", "folder_path", "path")


@query("verify_signature", """SELECT id, id % 7 <> 0 AS verified, id % 3 = 0 AS token_ok FROM pushes""")
def verify_signature(spark, d):
    p = v.pushes(spark, d)
    token = F.when(F.col("id") % 3 == 0, F.lit(v.SECRET)).when(F.col("id") % 3 == 1, F.lit("other"))
    return p.select(
        "id", k.verify_signature(F.col("body"), F.col("signature"), v.SECRET).alias("verified"),
        k.verify_token(token, v.SECRET).alias("token_ok"),
    )


@query("webhook_event_type", """SELECT id, CASE WHEN id % 3 = 0 THEN 'push' WHEN id % 3 = 1 AND id % 2 = 0 THEN 'Push Hook' WHEN id % 5 = 0 THEN 'inner' END AS event_type FROM pushes""")
def webhook_event_type(spark, d):
    i = F.col("id")
    body = F.when(i % 5 == 0, F.lit('{"event_type":"inner"}')).otherwise(F.col("body"))
    kind = k.webhook_event_type(
        F.when(i % 3 == 0, F.lit("push")).when(i % 3 == 1, F.lit("")), F.when((i % 3 == 1) & (i % 2 == 0), F.lit("Push Hook")), body
    )
    return v.pushes(spark, d).select("id", kind.alias("event_type"))


@query("webhook_raw_read", """SELECT id, CASE WHEN id % 4 = 1 THEN '{"raw_body":' || CAST(to_json('oops ' || body) AS VARCHAR) || '}' ELSE body END AS payload FROM pushes""")
def webhook_raw_read(spark, d):
    raw = F.when(F.col("id") % 4 == 1, F.concat(F.lit("oops "), F.col("body"))).otherwise(F.col("body"))
    return v.pushes(spark, d).select("id", k.webhook_payload(raw).alias("payload"))


@query("request_key", """SELECT id, md5('{"file_path":"' || path || '","source_type":"' || connector_type || '","tenant_id":"' || tenant_id || '"}') AS request_key FROM files""")
def request_key(spark, d):
    key = k.request_key(tenant_id=F.col("tenant_id"), source_type=F.col("connector_type"), file_path=F.col("path"))
    return v.files(spark, d).select("id", key.alias("request_key"))


@query("source_summary_view", """SELECT id, name, type AS connector_type, status, 'pending' AS sync_status, 0 AS documents_count,
  strftime(last_sync_time, '%Y-%m-%dT%H:%M:%S') AS last_synced_at, strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS created_at FROM connectors""")
def source_summary_view(spark, d):
    return ev.source_summary_view(v.connectors(spark, d))


@query("fanout_chunks", """SELECT 'embedding' AS kind, doc_id || '-' || n AS chunk_id, content, source, tenant_id, NULL AS job_id FROM lines WHERE n % 3 <> 0
  UNION ALL SELECT 'graph', doc_id || '-' || n, content, source, tenant_id, job_id FROM lines WHERE n % 2 = 0""")
def fanout_chunks(spark, d):
    embed, graph = ev.fanout_chunks(v.callbacks(spark, d))
    e = embed.select(
        F.lit("embedding").alias("kind"), F.col("id").alias("chunk_id"), "content", F.col("source_meta")["source"].alias("source"),
        "tenant_id", F.lit(None).cast("string").alias("job_id"),
    )
    g = graph.select(
        F.lit("graph").alias("kind"), "chunk_id", "content", F.col("source_meta")["source"].alias("source"), "tenant_id",
        F.col("provenance")["job_id"].alias("job_id"),
    )
    return e.unionByName(g)


@query("hash_ring_partition", """WITH ring AS (SELECT md5('partition-' || p || '-vnode-' || i) AS h, CAST(p AS INT) AS p FROM range(3) a(p), range(150) b(i)),
  wrapped AS (SELECT h, p FROM ring UNION ALL SELECT 'g', arg_min(p, h) FROM ring),
  keyed AS (SELECT seq, key, md5(key) AS m FROM (SELECT seq, 'u' || key || '-' || seq AS key FROM messages))
  SELECT seq, key, p AS ring_partition FROM keyed ASOF LEFT JOIN wrapped ON keyed.m <= wrapped.h""")
def hash_ring_partition(spark, d):
    m = v.messages(spark, d).select("seq", F.concat(F.lit("u"), "key", F.lit("-"), v.text("seq")).alias("key"))
    return joins.hash_ring_partition(m, "key", 3)
