"""End-to-end flows."""

from pyspark.sql import functions as F

from suite import landing, views as v
from suite.q_classify import SQL_EXT, SQL_STRATEGY
from suite.q_relational import mid, SQL_CHANGES, SQL_MID, SQL_REPORT, item_changes, items, vectors
from suite.registry import query
from tributary.functions import content as k
from tributary.plans import flows
from tributary.session import fresh_path
from tributary.sources.listings import SyncOptions

# per family, from what each connector keeps; the lists are spelled out here so that a wrong entry in the library shows
IMAGES = "'png','jpg','jpeg','gif','ico','svg','webp','bmp','woff','woff2','ttf','eot','otf','zip','tar','gz','rar','7z','exe','dll','so','dylib','bin','mp3','mp4','wav','avi','mov','mkv','db','sqlite'"
DOCUMENTS = "'pdf','doc','docx','xls','xlsx','ppt','pptx','lock'"
SQL_FAMILY = """CASE WHEN connector_type IN ('dropbox', 'onedrive') THEN 'folder' WHEN connector_type = 'google_drive' THEN 'drive'
    WHEN connector_type = 'local_file' THEN 'local' ELSE 'repo' END"""
SQL_LANGUAGE = """CASE family WHEN 'folder' THEN NULL WHEN 'drive' THEN NULL ELSE CASE
    WHEN ext = 'hpp' AND connector_type = 'bitbucket' THEN 'cpp' WHEN ext = 'hpp' THEN 'c'
    WHEN connector_type = 'bitbucket' AND ext IN ('cc', 'sass', 'html', 'json', 'yml', 'ps1', 'xml') THEN NULL
    WHEN family = 'local' AND ext IN ('cc', 'sass') THEN NULL
    WHEN ext = 'py' THEN 'python' WHEN ext = 'js' THEN 'javascript' WHEN ext = 'rs' THEN 'rust' WHEN ext = 'cc' THEN 'cpp' WHEN ext = 'sass' THEN 'scss'
    WHEN ext = 'md' THEN 'markdown' WHEN ext IN ('html', 'json', 'xml', 'sql') THEN ext WHEN ext = 'yml' THEN 'yaml' WHEN ext = 'ps1' THEN 'powershell'
    WHEN ext = 'tsx' THEN 'typescript' END END"""
SQL_TYPE = """CASE family WHEN 'drive' THEN CASE mime WHEN 'application/vnd.google-apps.document' THEN 'document'
    WHEN 'application/vnd.google-apps.spreadsheet' THEN 'spreadsheet' WHEN 'application/vnd.google-apps.presentation' THEN 'presentation'
    WHEN 'text/plain' THEN 'text' WHEN 'text/markdown' THEN 'markdown' WHEN 'text/x-python' THEN 'code' WHEN 'text/css' THEN 'text'
    WHEN 'application/x-y' THEN 'code' WHEN 'application/pdf' THEN 'pdf' ELSE 'unknown' END
  ELSE CASE WHEN ext = 'md' THEN 'markdown' WHEN ext IN ('html', 'json', 'xml') THEN ext WHEN ext = 'yml' THEN 'yaml' WHEN ext = 'txt' THEN 'text'
    WHEN family = 'folder' THEN CASE WHEN ext = 'csv' THEN 'spreadsheet' WHEN ext = 'pdf' THEN 'pdf' WHEN ext = 'docx' THEN 'document' ELSE 'unknown' END
    WHEN ext IN ('py', 'js', 'rs', 'hpp', 'sass', 'ps1', 'sql', 'tsx') THEN 'code' ELSE 'unknown' END END"""
SQL_SYNCED = f"""(SELECT *, strlen(content) AS size_bytes, {SQL_LANGUAGE} AS lang, {SQL_TYPE} AS content_type FROM
    (SELECT *, {SQL_FAMILY} AS family, CASE WHEN connector_type = 'local_file' THEN lower(regexp_extract(name, '^.+[.]([^.]+)$', 1)) ELSE {SQL_EXT} END AS ext
     FROM mimes)
  WHERE NOT (size > 16384) AND CASE family
    WHEN 'folder' THEN ext NOT IN ({IMAGES}) AND NOT contains(lower(path), 'node_modules')
    WHEN 'drive' THEN NOT starts_with(mime, 'image/') AND mime <> 'application/zip'
    WHEN 'local' THEN ext NOT IN ({IMAGES}, {DOCUMENTS}) AND NOT contains(path, 'node_modules') AND path NOT LIKE '.git/%'
    ELSE ext NOT IN ({IMAGES}, {DOCUMENTS}) AND NOT contains(path, 'node_modules') END)"""
OPTIONS = SyncOptions(exclude=["node_modules"], max_mb=1 / 64)


def listed(spark, d):
    """Files of all connector types, with the media type that drives list."""
    return v.mimes(spark, d).withColumnRenamed("mime", "mime_type")


@query("full_sync", f"""SELECT source_id, count(*) AS documents_synced, CAST(sum(size_bytes) AS BIGINT) AS total_bytes,
  count(*) FILTER (WHERE size_bytes <= 4096) AS inline_documents, count(*) FILTER (WHERE size_bytes > 4096) AS reference_documents FROM {SQL_SYNCED} GROUP BY 1""")
def full_sync(spark, d):
    return flows.full_sync_stats(flows.full_sync(listed(spark, d), OPTIONS, 4))


@query("full_sync_documents", f"""SELECT seq, sha256(source_id || '|' || seq) AS id, path, content_hash, size_bytes, CASE WHEN size_bytes <= 4096 THEN 'inline' ELSE 'reference' END AS route, lang AS language, content_type
  FROM (SELECT *, sha256(content) AS content_hash FROM {SQL_SYNCED})
  QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY seq) = 1""")
def full_sync_documents(spark, d):
    out = flows.full_sync(listed(spark, d), OPTIONS, 4, drop_duplicates=True)
    return out.select("seq", "id", "path", "content_hash", "size_bytes", "route", "language", "content_type")


SQL_ID = "sha256(source_id || '|' || seq)"
SQL_REQUEST = f"""'{{"tenant_id":"' || tenant_id || '","connector_id":"' || source_id || '","source_type":"' || connector_type || '","file_id":"' || {SQL_ID} || '","file_name":"' || name || '",' """
SQL_TAIL = f"""',"ingest_flags":{{"for_embeddings":true,"for_graph":true,"priority":"normal"}}' || coalesce(',"suggest_chunk_strategy":"' || {SQL_STRATEGY} || '"', '')"""


@query("full_sync_requests", f"""SELECT {SQL_ID} AS id, CASE WHEN size_bytes <= 4096 THEN 'inline' ELSE 'reference' END AS route,
  {SQL_REQUEST} || CASE WHEN size_bytes <= 4096
    THEN '"file_path":"' || path || '","content":' || CAST(to_json(content) AS VARCHAR) || {SQL_TAIL} || ',"size_bytes":' || size_bytes || '}}'
    ELSE '"blob_url":"s3://blobs/' || tenant_id || '/' || {SQL_ID} || '/' || sha256(content) || CASE WHEN contains(name, '.') THEN '.' || regexp_extract(name, '([^.]*)$', 1) ELSE '' END
      || '","size_bytes":' || size_bytes || {SQL_TAIL} || '}}' END AS payload
  FROM {SQL_SYNCED}""")
def full_sync_requests(spark, d):
    return flows.sync_requests(flows.full_sync(listed(spark, d), OPTIONS, 4), "s3://blobs")


SQL_SOURCE_NO = "CAST(regexp_extract(source_id, '(\\d+)$', 1) AS INT)"
SQL_FRESH = f"""({SQL_SOURCE_NO} % 5 = 4 OR timestamp >= TIMESTAMP '2024-01-01 00:02:00' + to_minutes({SQL_SOURCE_NO} % 3))"""


def cursors(spark, d):
    """A cursor per source; one source in five has none yet."""
    sources = v.files(spark, d).select("source_id").distinct()
    no = F.regexp_extract("source_id", r"(\d+)$", 1).cast("int")
    return sources.where(no % 5 != 4).select("source_id", v.at(F.lit(1704067320) + no % 3 * 60).alias("cursor"))


@query("incremental_sync", f"""SELECT 'document' AS kind, f.path AS what, CASE WHEN strlen(f.content) <= 4096 THEN 'inline' ELSE 'reference' END AS value FROM
  (SELECT * FROM {SQL_CHANGES} WHERE {SQL_FRESH} QUALIFY row_number() OVER (PARTITION BY source_id, item_id ORDER BY timestamp DESC) = 1) x
  JOIN files f ON f.source_id = x.source_id AND f.path = x.item_id WHERE x.change_type <> 'deleted' AND f.id % 10 <> 7
  UNION ALL SELECT 'cursor', source_id, strftime(max(timestamp), '%Y-%m-%d %H:%M:%S') FROM {SQL_CHANGES} WHERE {SQL_FRESH} GROUP BY source_id""")
def incremental_sync(spark, d):
    found, cursor = flows.incremental_sync(item_changes(spark, d), items(spark, d), cursors(spark, d), 4)
    return found.select(F.lit("document").alias("kind"), F.col("path").alias("what"), F.col("route").alias("value")).unionByName(
        cursor.select(F.lit("cursor").alias("kind"), F.col("source_id").alias("what"), F.date_format("cursor", "yyyy-MM-dd HH:mm:ss").alias("value"))
    )


PROVIDERS = ["github", "gitlab", "bitbucket", "google_drive", "dropbox", "onedrive"]


def webhooks(spark, d):
    """Webhooks of six providers with the proof each gives, a token or a signature, by one of three secrets; every seventh carries a wrong one."""
    g = F.col("id")
    shapes = {
        "bitbucket": ('{"push":{"changes":[{"commits":[{"hash":"h', '"}]}]}}'), "google_drive": ('{"resourceId":"r', '"}'),
        "dropbox": ('{"delta":{"users":["u', '"]}}'), "onedrive": ('{"value":[{"resource":"res', '","changeType":"created"}]}'),
    }
    body = F.col("body")
    for provider, (head, tail) in shapes.items():
        body = F.when(F.col("provider") == provider, F.concat(F.lit(head), v.text(g), F.lit(tail))).otherwise(body)
    sent = v.pushes(spark, d).withColumn("provider", v.pick(PROVIDERS, g % 6)).withColumn("body", body)
    signed = F.lit(None).cast("string")
    for n in range(3):
        ipad, opad = k.hmac_pads(f"secret {n}")
        signed = F.when(g % 3 == n, F.concat(F.lit("sha256="), k.hmac_sha256(F.col("body"), F.lit(ipad), F.lit(opad)))).otherwise(signed)
    token = F.concat(F.lit("secret "), v.text(g % 3))
    proof = F.when(F.col("provider") == "gitlab", token).otherwise(signed)
    return sent.withColumn("signature", F.when(g % 7 == 0, F.lit("sha256=00")).otherwise(proof))


def secrets(spark, d):
    pads = [k.hmac_pads(f"secret {n}") for n in range(3)]
    g = F.col("id")
    return v.pushes(spark, d).select(
        g.alias("connector_id"), v.pick([a for a, _ in pads], g % 3).alias("ipad"), v.pick([b for _, b in pads], g % 3).alias("opad"),
        F.concat(F.lit("secret "), v.text(g % 3)).alias("token"),
    )


SQL_WEBHOOK_CHANGES = """(SELECT g AS id, item_id FROM push_files WHERE g % 6 = 0 OR (g % 6 = 1 AND g % 4 <> 0)
  UNION ALL SELECT id, CASE id % 6 WHEN 2 THEN 'h' WHEN 3 THEN 'r' WHEN 4 THEN 'u' ELSE 'res' END || id FROM pushes WHERE id % 6 > 1)"""


SQL_WEBHOOK_FLOW = f"""SELECT 'event' AS kind, id, CASE WHEN id % 7 <> 0 THEN 'verified' ELSE 'refused' END AS what FROM pushes
  UNION ALL SELECT 'change', id, item_id FROM {SQL_WEBHOOK_CHANGES} WHERE id % 7 <> 0
  UNION ALL SELECT 'job', p.id, sha256(p.id || '|' || p.connector_id) FROM pushes p JOIN connectors c ON c.id = p.connector_id
    WHERE p.id % 7 <> 0 AND p.id IN (SELECT id FROM {SQL_WEBHOOK_CHANGES})"""


def flow_rows(events, changes, jobs):
    return (
        events.select(F.lit("event").alias("kind"), "id", F.when(F.col("verified"), F.lit("verified")).otherwise(F.lit("refused")).alias("what"))
        .unionByName(changes.select(F.lit("change").alias("kind"), "id", F.col("item_id").alias("what")))
        .unionByName(jobs.select(F.lit("job").alias("kind"), F.col("request_id").alias("id"), F.col("id").alias("what")))
    )


@query("webhook_flow", SQL_WEBHOOK_FLOW)
def webhook_flow(spark, d):
    return flow_rows(*flows.webhook_flow(webhooks(spark, d), v.connectors(spark, d), secrets(spark, d)))


@query("webhook_flow_stream", SQL_WEBHOOK_FLOW)
def webhook_flow_stream(spark, d):
    feed = landing.feed_of(webhooks(spark, d), "received_at", "webhooks", batches=3)
    path, checkpoint = fresh_path(spark, "webhooks"), fresh_path(spark, "progress")
    flows.run_webhook_stream(feed, v.connectors(spark, d), secrets(spark, d), path, checkpoint)
    return flow_rows(*flows.webhook_tables(spark, path))


@query("retention_cycle", f"""{SQL_REPORT.replace("count(*) FILTER (WHERE tenant_id = 3) FROM chunks", "0")}
  UNION ALL SELECT 'deleted_jobs', count(*) FROM sync_jobs WHERE status IN ('completed','failed') AND end_time < {SQL_MID} - INTERVAL 7 DAY""")
def retention_cycle(spark, d):
    wanted = v.chunks(spark, d).withColumn("neo4j_id", F.col("wanted_node"))
    return flows.retention_cycle(v.sync_jobs(spark, d), v.bodies(spark, d), wanted, vectors(spark, d), mid())
