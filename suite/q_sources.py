"""Sources, sinks and provider change feeds."""

from pyspark.sql import functions as F

from suite import landing, views as v
from suite.q_classify import SQL_EXT, quoted
from suite.q_content import fixed_now, SQL_BLOB_KEY
from suite.registry import query
from tributary.functions import content as k
from tributary.functions import tables as t
from tributary.operators import changes as ch
from tributary.operators import joins
from tributary.session import fresh_path
from tributary.sources import listings as ls
from tributary.sources import local_files, tables
from tributary.streaming import operators as st

SQL_REPO = f"{SQL_EXT} NOT IN {quoted(t.BINARY_REPO)}"
SQL_OFFICE = f"{SQL_EXT} NOT IN {quoted(t.BINARY_OFFICE)}"


@query("scan_local_files", f"""SELECT name, path, 'file' AS item_type, strlen(content) AS size FROM files
  WHERE NOT starts_with(path, '.') AND lower(regexp_extract(name, '^.+[.]([^.]+)$', 1)) NOT IN {quoted(t.BINARY_REPO)}""")
def scan_local_files(spark, d):
    base = landing.land_files(v.files(spark, d))
    return local_files.scan_local_files(spark, base).select("name", "path", "item_type", "size")


def sha(f):
    return F.sha2(F.concat(F.lit("blob"), v.text("id")), 256)


def node_kind():
    return F.when(F.col("id") % 9 == 4, F.lit("tree")).otherwise(F.lit("blob"))


@query("scan_repo_tree", f"""SELECT sha256('blob' || id) AS id, name, path, size, 'o/r' AS repository, 'main' AS branch FROM files
  WHERE id % 9 <> 4 AND {SQL_REPO} AND NOT (size > 4096) AND NOT contains(path, 'node_modules')""")
def scan_repo_tree(spark, d):
    entry = F.struct(node_kind().alias("type"), "path", sha(None).alias("sha"), "size")
    path = landing.land_pages(v.files(spark, d), entry, "tree", landing.page_of())
    got = ls.scan_repo_tree(ls.read_pages(spark, path, ls.TREE), "o/r", options=ls.SyncOptions(exclude=["node_modules"], max_mb=1 / 256))
    return got.select("id", "name", "path", "size", F.col("metadata")["repository"].alias("repository"), F.col("metadata")["branch"].alias("branch"))


@query("scan_repo_tree_paged", f"""SELECT sha256('blob' || id) AS id, name, path, '100644' AS mode FROM files
  WHERE id % 9 <> 4 AND {SQL_REPO} AND {SQL_EXT} IN ('py','md','html')""")
def scan_repo_tree_paged(spark, d):
    entry = F.struct(node_kind().alias("type"), "path", sha(None).alias("id"), "name", F.lit("100644").alias("mode"))
    path = landing.land_pages(v.files(spark, d), entry, None, landing.page_of())
    got = ls.scan_repo_tree_paged(ls.read_pages(spark, path, ls.TREE_PAGED), "g/p", options=ls.SyncOptions(include=["py", ".md", "HTML"]))
    return got.select("id", "name", "path", F.col("metadata")["mode"].alias("mode"))


@query("scan_repo_dirs", f"""SELECT CASE WHEN id % 4 = 0 THEN path ELSE 'commit' || id END AS id, name, path, size FROM files WHERE id % 9 <> 4 AND {SQL_REPO}""")
def scan_repo_dirs(spark, d):
    kind = F.when(F.col("id") % 9 == 4, F.lit("commit_directory")).otherwise(F.lit("commit_file"))
    commit = F.when(F.col("id") % 4 != 0, F.struct(F.concat(F.lit("commit"), v.text("id")).alias("hash")))
    entry = F.struct(kind.alias("type"), "path", "size", commit.alias("commit"))
    path = landing.land_pages(v.files(spark, d), entry, "values", landing.page_of())
    return ls.scan_repo_dirs(ls.read_pages(spark, path, ls.DIRS), "w", "r").select("id", "name", "path", "size")


@query("scan_drive_listing", f"""SELECT CAST(id AS VARCHAR) AS id, name, name AS path, CASE WHEN size > 0 THEN size END AS size, mime AS mime_type, modified AS modified_time,
  row_number() OVER (ORDER BY modified DESC) - 1 AS place FROM mimes
  WHERE NOT trashed AND mime <> '{t.FOLDER_MIME}' AND folder = 'f2' AND mine AND NOT starts_with(mime, 'image/') AND mime <> 'application/zip' AND NOT (size > 4096)
    AND (starts_with(mime, 'text/') OR starts_with(mime, 'application/'))""")
def scan_drive_listing(spark, d):
    entry = F.struct(
        v.text("id").alias("id"), "name", F.col("mime").alias("mimeType"), v.text("size").alias("size"),
        F.col("modified").alias("modifiedTime"), F.array("folder").alias("parents"), "trashed", F.col("mine").alias("ownedByMe"),
    )
    path = landing.land_pages(v.mimes(spark, d), entry, "files", landing.page_of())
    got = ls.scan_drive_listing(ls.read_pages(spark, path, ls.DRIVE), "f2", False, ls.SyncOptions(include_mimes=["text/", "application/"], max_mb=1 / 256))
    # the order of the listing, made visible as a position
    from tributary.operators.slicing import ranked

    placed = ranked(got, [F.desc("modified_time")], name="place").withColumn("place", F.col("place") - 1)
    return placed.select("id", "name", "path", "size", "mime_type", "modified_time", "place")


@query("scan_folder_listing", f"""SELECT 'id:' || id AS id, name, '/' || path AS path, size, 'r' || id AS rev FROM files
  WHERE id % 9 <> 4 AND {SQL_OFFICE} AND NOT contains(lower(path), 'node_modules') AND {SQL_EXT} IN ('pdf','docx','md','csv','lock')""")
def scan_folder_listing(spark, d):
    tag = F.when(F.col("id") % 9 == 4, F.lit("folder")).otherwise(F.lit("file"))
    entry = F.struct(
        tag.alias(".tag"), F.concat(F.lit("id:"), v.text("id")).alias("id"), "name", F.concat(F.lit("/"), "path").alias("path_display"),
        "size", F.concat(F.lit("r"), v.text("id")).alias("rev"),
    )
    path = landing.land_pages(v.files(spark, d), entry, "entries", landing.page_of())
    options = ls.SyncOptions(include=["pdf", "docx", "md", "csv", "lock"], exclude=["Node_Modules"])
    got = ls.scan_folder_listing(ls.read_pages(spark, path, ls.FOLDER), options)
    return got.select("id", "name", "path", "size", F.col("metadata")["rev"].alias("rev"))


@query("scan_folder_tree", f"""SELECT 'i' || id AS id, name, CASE WHEN id % 7 = 0 THEN name ELSE 'a' || (id % 3) || '/b' || (id % 5) || '/c' || (id % 2) || '/d' || (id % 11) || '/' || name END AS path, size
  FROM files WHERE {SQL_OFFICE.replace('path', 'name')} AND id % 13 <> 0""")
def scan_folder_tree(spark, d):
    i = F.col("id")
    parts = [F.concat(F.lit(p), v.text(i % n)) for p, n in (("a", 3), ("b", 5), ("c", 2), ("d", 11))]
    f = v.files(spark, d)

    def folder_id(depth):
        return F.concat_ws("/", F.lit("F"), *parts[:depth])

    # every folder on the way, from its own id to its parent's
    folders = f.select(F.explode(F.array(*[
        F.struct(folder_id(n + 1).alias("id"), parts[n].alias("name"), F.when(F.lit(n == 0), F.lit("root")).otherwise(folder_id(n)).alias("parent"))
        for n in range(4)
    ])).alias("x")).select("x.*").distinct()
    # one file in thirteen sits in a folder nobody listed
    parent = F.when(i % 13 == 0, F.lit("lost")).when(i % 7 == 0, F.lit("root")).otherwise(folder_id(4))

    def entry(id_, name, size, is_file, parent_):
        return F.struct(
            id_.alias("id"), name.alias("name"), size.alias("size"),
            F.when(F.lit(is_file), F.struct(F.lit("text/plain").alias("mimeType"))).alias("file"),
            F.when(F.lit(not is_file), F.struct(F.lit(1).cast("long").alias("childCount"))).alias("folder"),
            F.struct(parent_.alias("id")).alias("parentReference"),
        ).alias("e")

    all_ = folders.select(
        entry(F.col("id"), F.col("name"), F.lit(0).cast("long"), False, F.col("parent")), F.lit(-1).cast("long").alias("page")
    ).unionByName(f.select(entry(F.concat(F.lit("i"), v.text("id")), F.col("name"), F.col("size"), True, parent), landing.page_of().alias("page")))
    # folder entries of one page: at most 3 * 5 * 2 * 11 leaf folders and their parents
    path = landing.land_pages(all_, F.col("e"), "value", F.col("page"))
    return ls.scan_folder_tree(ls.read_pages(spark, path, ls.FOLDER_TREE)).select("id", "name", "path", "size")


@query("decode_base64_content", """SELECT id, CASE WHEN id % 20 = 0 THEN 'bad!' WHEN id % 21 = 0 THEN '/w==' ELSE content END AS by_id,
  CASE WHEN id % 20 = 0 OR id % 21 = 0 THEN '' ELSE content END AS by_path FROM files""")
def decode_base64_content(spark, d):
    i = F.col("id")
    encoded = F.base64(F.encode("content", "UTF-8"))
    # providers break the text into lines
    broken = F.concat(F.substr(encoded, F.lit(1), F.lit(60)), F.lit("\n"), F.substr(encoded, F.lit(61)), F.lit("\n"))
    raw = F.when(i % 20 == 0, F.lit("bad!")).when(i % 21 == 0, F.lit("/w==")).otherwise(broken)
    f = v.files(spark, d).select("id", raw.alias("raw"))
    return f.select("id", k.decode_base64(F.col("raw")).alias("by_id"), k.decode_base64(F.col("raw"), by_path=True).alias("by_path"))


@query("decode_text_fallback", "SELECT id, CASE WHEN id % 10 = 0 THEN chr(233) || name ELSE content END AS content FROM files")
def decode_text_fallback(spark, d):
    latin = F.concat(F.unhex(F.lit("E9")), F.encode("name", "UTF-8"))
    raw = F.when(F.col("id") % 10 == 0, latin).otherwise(F.encode("content", "UTF-8"))
    return v.files(spark, d).select("id", k.decode_text(raw).alias("content"))


@query("union_pages", "SELECT path, size FROM files UNION ALL SELECT path, size FROM files WHERE id % 2 = 0")
def union_pages(spark, d):
    f = v.files(spark, d)
    entry = F.struct(F.lit("blob").alias("type"), "path", sha(None).alias("sha"), "size")
    one = landing.land_pages(f, entry, "tree", landing.page_of())
    two = landing.land_pages(f.where("id % 2 = 0"), entry, "tree", landing.page_of())
    pages = joins.union_all([ls.read_pages(spark, p, ls.TREE) for p in (one, two)])
    return pages.select(F.explode("tree").alias("n")).select("n.path", "n.size")


# ---- tables and stores -------------------------------------------------------------------------


@query("state_tables", """SELECT 'connectors' AS name, CAST(id AS VARCHAR) AS id, CAST(tenant_id AS VARCHAR) AS tenant_id, status FROM connectors
  UNION ALL SELECT 'sync_jobs', CAST(id AS VARCHAR), NULL, status FROM sync_jobs
  UNION ALL SELECT 'chunks', id, CAST(tenant_id AS VARCHAR), embedding_state FROM chunks
  UNION ALL SELECT 'file_blobs', sha256(tenant_id || '|' || id), tenant_id, sha256(content) FROM files WHERE strlen(content) > 4096
  UNION ALL SELECT 'webhook_events', CAST(id AS VARCHAR), NULL, 'pending' FROM pushes""")
def state_tables(spark, d):
    base = fresh_path(spark, "state")
    jobs = v.sync_jobs(spark, d).withColumn(
        "stats_json", F.struct(F.col("stats_json").alias("documents_synced"), F.lit("full").alias("sync_type"))
    )
    tables.write_state(v.connectors(spark, d), "connectors", f"{base}/connectors")
    tables.write_state(jobs, "sync_jobs", f"{base}/sync_jobs")
    tables.write_state(v.chunks(spark, d), "chunks", f"{base}/chunks")
    named = v.files(spark, d).withColumns({
        "id": v.text("id"), "connector_id": F.col("source_id"), "mime_type": F.lit(None).cast("string"), "created_at": fixed_now(),
    })
    tables.write_state(tables.blob_references(named, "s3://blobs", 4), "file_blobs", f"{base}/file_blobs")
    none = F.lit(None).cast("string")
    log = st.webhook_log(v.pushes(spark, d), F.lit("github"), F.lit("push"), none, F.col("body"), F.col("signature"))
    tables.write_state(log, "webhook_events", f"{base}/webhook_events")
    shown = {"connectors": "status", "sync_jobs": "status", "chunks": "embedding_state", "file_blobs": "content_hash", "webhook_events": "status"}
    out = []
    for name, status in shown.items():
        read = tables.read_state(spark, name, f"{base}/{name}")
        tenant = F.col("tenant_id") if "tenant_id" in read.columns else none
        out.append(read.select(F.lit(name).alias("name"), "id", tenant.alias("tenant_id"), F.col(status).alias("status")))
    return joins.union_all(out)


@query("blob_offload", f"""SELECT sha256(tenant_id || '|' || id) AS id, CAST(id AS VARCHAR) AS file_id, name AS file_name, tenant_id, source_id AS connector_id, {SQL_BLOB_KEY} AS blob_key,
  sha256(content) AS content_hash, strlen(content) AS size, 'text/plain' AS mime_type FROM files WHERE strlen(content) > 4096""")
def blob_offload(spark, d):
    path = fresh_path(spark, "blobs")
    rows = v.files(spark, d).withColumns({
        "id": v.text("id"), "connector_id": F.col("source_id"), "mime_type": F.lit(None).cast("string"), "created_at": fixed_now(),
    })
    refs = tables.blob_offload(rows, path, 4)
    return refs.select(
        "id", "file_id", "file_name", "tenant_id", "connector_id", F.substr("blob_url", F.lit(len(path) + 2)).alias("blob_key"),
        "content_hash", "size", "mime_type",
    )


@query("chunk_body_store", """SELECT id, strlen(content) AS bytes, TIMESTAMP '2024-01-01' + to_days(CAST(id % 30 AS INT)) + INTERVAL 7 DAY AS purge_at FROM files
  WHERE TIMESTAMP '2024-01-01' + to_days(CAST(id % 30 AS INT)) + INTERVAL 7 DAY > TIMESTAMP '2024-01-20 12:00:00'""")
def chunk_body_store(spark, d):
    path = fresh_path(spark, "bodies")
    made = F.expr("timestamp_ntz '2024-01-01'") + F.make_dt_interval((F.col("id") % 30).cast("int"))
    tables.write_chunk_bodies(v.files(spark, d).select("id", "content", made.alias("created_at")), path)
    live = tables.live_bodies(spark.read.parquet(path), F.expr("timestamp_ntz '2024-01-20 12:00:00'"))
    return live.select("id", F.octet_length("content").cast("long").alias("bytes"), "purge_at")


# ---- provider change feeds ---------------------------------------------------------------------


def push_payloads(spark, d):
    return v.pushes(spark, d).select("id", F.col("body").alias("payload"))


SQL_ORDERED = """(SELECT *, 0 AS commit_no, CAST(row_number() OVER (PARTITION BY g
  ORDER BY CASE change_type WHEN 'created' THEN 0 WHEN 'updated' THEN 1 ELSE 2 END, item_id) - 1 AS INT) AS position FROM push_files)"""


@query("changes_github", f"SELECT g AS id, item_id, change_type, cursor, commit_no, position FROM {SQL_ORDERED}")
def changes_github(spark, d):
    return ch.changes_github(push_payloads(spark, d))


@query("changes_gitlab", f"SELECT g AS id, item_id, change_type, cursor, commit_no, position FROM {SQL_ORDERED} WHERE g % 4 <> 0")
def changes_gitlab(spark, d):
    return ch.changes_gitlab(push_payloads(spark, d))


def payloads(spark, d, body):
    return v.files(spark, d).select("id", body.alias("payload"))


@query("changes_bitbucket", """SELECT id, 'h' || id || '-' || n AS item_id, 'updated' AS change_type, 'h' || id || '-' || n AS cursor FROM files, range(3) r(n)""")
def changes_bitbucket(spark, d):
    def h(n):
        return F.concat(F.lit('{"hash":"h'), v.text("id"), F.lit(f'-{n}"}}'))

    body = F.concat(F.lit('{"push":{"changes":[{"commits":['), h(0), F.lit(","), h(1), F.lit(']},{"commits":['), h(2), F.lit("]}]}}"))
    return ch.changes_bitbucket(payloads(spark, d, body))


@query("changes_drive", """SELECT id, CASE WHEN id % 3 = 0 THEN 'r' ELSE 's' END || id AS item_id, 'updated' AS change_type, CAST(NULL AS VARCHAR) AS cursor FROM files WHERE id % 3 <> 2""")
def changes_drive(spark, d):
    i = F.col("id")
    body = F.when(i % 3 == 0, F.concat(F.lit('{"resourceId":"r'), v.text("id"), F.lit('"}'))).when(
        i % 3 == 1, F.concat(F.lit('{"resourceId":"","resource_id":"s'), v.text("id"), F.lit('"}'))
    ).otherwise(F.lit("{}"))
    return ch.changes_drive(payloads(spark, d, body))


@query("changes_dropbox", """SELECT id, CAST(id + n AS VARCHAR) AS item_id, 'updated' AS change_type, CAST(NULL AS VARCHAR) AS cursor FROM files, range(2) r(n)""")
def changes_dropbox(spark, d):
    body = F.concat(F.lit('{"delta":{"users":['), v.text("id"), F.lit(","), v.text(F.col("id") + 1), F.lit("]}}"))
    return ch.changes_dropbox(payloads(spark, d, body))


@query("changes_onedrive", """SELECT id, CASE n WHEN 0 THEN 'res' || id ELSE '' END AS item_id, CASE n WHEN 0 THEN 'created' ELSE 'updated' END AS change_type,
  CASE n WHEN 0 THEN 'sub' || id END AS cursor FROM files, range(2) r(n)""")
def changes_onedrive(spark, d):
    body = F.concat(F.lit('{"value":[{"resource":"res'), v.text("id"), F.lit('","changeType":"created","subscriptionId":"sub'), v.text("id"), F.lit('"},{}]}'))
    return ch.changes_onedrive(payloads(spark, d, body))
