"""Classification and filters."""

from pyspark.sql import functions as F

from suite import views as v
from suite.registry import query
from tributary.functions import classify as c
from tributary.functions import tables as t
from tributary.operators import aggregates as agg

SQL_EXT = "CASE WHEN contains(path, '.') THEN lower(regexp_extract(path, '([^.]*)$', 1)) ELSE '' END"


def quoted(values) -> str:
    return "(" + ", ".join(f"'{x}'" for x in values) + ")"


def cases(table: dict, key: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{x}'" for k, x in table.items()) + " END"


def with_ext(spark, d):
    return v.files(spark, d).withColumn("ext", c.file_extension(F.col("path")))


SQL_FILES = f"(SELECT *, {SQL_EXT} AS ext FROM files)"


@query("file_extension", f"SELECT id, {SQL_EXT} AS ext, lower(regexp_extract(name, '^.+\\.([^.]+)$', 1)) AS local_ext FROM files")
def file_extension(spark, d):
    return v.files(spark, d).select(
        "id", c.file_extension(F.col("path")).alias("ext"), c.local_extension(F.col("name")).alias("local_ext")
    )


@query("content_type_by_ext", f"""SELECT id, coalesce({cases(t.CONTENT_TYPES, 'ext')},
  CASE WHEN ext IN {quoted(t.CODE_EXTENSIONS)} THEN 'code' END, 'unknown') AS content_type FROM {SQL_FILES}""")
def content_type_by_ext(spark, d):
    return with_ext(spark, d).select("id", c.content_type_by_ext(F.col("ext")).alias("content_type"))


@query("content_type_office", f"""SELECT id, coalesce({cases(t.DROPBOX_TYPES, 'ext')}, 'unknown') AS dropbox_type,
  coalesce({cases(t.ONEDRIVE_TYPES, 'ext')}, 'unknown') AS onedrive_type FROM {SQL_FILES}""")
def content_type_office(spark, d):
    return with_ext(spark, d).select(
        "id", c.content_type_office(F.col("ext"), "dropbox").alias("dropbox_type"),
        c.content_type_office(F.col("ext"), "onedrive").alias("onedrive_type"),
    )


@query("content_type_by_mime", f"""SELECT id, coalesce({cases(t.MIME_TYPES, 'mime')},
  CASE WHEN starts_with(mime, 'text/x-') OR starts_with(mime, 'application/x-') THEN 'code'
       WHEN starts_with(mime, 'text/') THEN 'text' ELSE 'unknown' END) AS content_type FROM mimes""")
def content_type_by_mime(spark, d):
    return v.mimes(spark, d).select("id", c.content_type_by_mime(F.col("mime")).alias("content_type"))


@query("language_by_ext", f"""SELECT id, {cases(t.LANGUAGES, 'ext')} AS git_language,
  {cases(t.BITBUCKET_LANGUAGES, 'ext')} AS bitbucket_language,
  {cases(t.LOCAL_LANGUAGES, "lower(regexp_extract(name, '^.+[.]([^.]+)$', 1))")} AS local_language FROM {SQL_FILES}""")
def language_by_ext(spark, d):
    return with_ext(spark, d).select(
        "id", c.language_by_ext(F.col("ext")).alias("git_language"),
        c.language_by_ext(F.col("ext"), "bitbucket").alias("bitbucket_language"),
        c.language_by_ext(c.local_extension(F.col("name")), "local").alias("local_language"),
    )


@query("export_mime", f"SELECT id, coalesce({cases(t.EXPORT_MIMES, 'mime')}, mime) AS export_mime FROM mimes")
def export_mime(spark, d):
    return v.mimes(spark, d).select("id", c.export_mime(F.col("mime")).alias("export_mime"))


@query("source_kind", f"SELECT id, coalesce({cases(t.SOURCE_KINDS, 'type')}, 'other') AS source_kind FROM connectors")
def source_kind(spark, d):
    return v.connectors(spark, d).select("id", c.source_kind(F.col("type")).alias("source_kind"))


SQL_STRATEGY = """CASE WHEN connector_type IN ('github','gitlab','bitbucket') THEN
    CASE WHEN coalesce(lang, '') <> '' THEN 'code_ast' ELSE 'code_block' END
  WHEN connector_type IN ('notion','confluence') THEN 'doc_heading'
  WHEN connector_type = 'slack' THEN 'chat_sliding_window' END"""


@query("chunk_strategy", f"SELECT id, {SQL_STRATEGY} AS strategy FROM (SELECT *, {cases(t.LANGUAGES, 'ext')} AS lang FROM {SQL_FILES})")
def chunk_strategy(spark, d):
    return with_ext(spark, d).select(
        "id", c.chunk_strategy(F.col("connector_type"), c.language_by_ext(F.col("ext"))).alias("strategy")
    )


@query("skip_binary_repo", f"SELECT id, path FROM {SQL_FILES} WHERE ext NOT IN {quoted(t.BINARY_REPO)}")
def skip_binary_repo(spark, d):
    return with_ext(spark, d).where(c.not_binary_repo(F.col("ext"))).select("id", "path")


@query("skip_binary_office", f"SELECT id, path FROM {SQL_FILES} WHERE ext NOT IN {quoted(t.BINARY_OFFICE)}")
def skip_binary_office(spark, d):
    return with_ext(spark, d).where(c.not_binary_office(F.col("ext"))).select("id", "path")


SQL_SKIP_MIME = "NOT (" + " OR ".join(f"starts_with(mime, '{m}')" for m in t.SKIP_MIMES) + ")"


@query("skip_mime", f"SELECT id, mime FROM mimes WHERE {SQL_SKIP_MIME}")
def skip_mime(spark, d):
    return v.mimes(spark, d).where(c.not_skipped_mime(F.col("mime"))).select("id", "mime")


@query("skip_hidden", "SELECT id, path FROM files WHERE NOT list_bool_or([starts_with(p, '.') FOR p IN string_split(path, '/')])")
def skip_hidden(spark, d):
    return v.files(spark, d).where(c.not_hidden(F.col("path"))).select("id", "path")


REPO = dict(include=["py", ".MD", "tsx", "sql", "rs"], exclude=["node_modules", "_5", "SRC"], max_mb=0.003)
SQL_REPO = f"""NOT (size > 3145) AND NOT contains(path, 'node_modules') AND NOT contains(path, '_5') AND NOT contains(path, 'SRC')
  AND {SQL_EXT} IN ('py','md','tsx','sql','rs')"""


@query("sync_filter_repo", f"SELECT id, path, size FROM files WHERE {SQL_REPO}")
def sync_filter_repo(spark, d):
    return v.files(spark, d).where(c.sync_filter_repo(F.col("path"), F.col("size"), **REPO)).select("id", "path", "size")


@query("sync_filter_folder", f"""SELECT id, path, size FROM files WHERE NOT (size > 2097) AND NOT contains(lower(path), 'src')
  AND NOT contains(lower(path), 'doc_1') AND {SQL_EXT} IN ('py','csv','docx','md')""")
def sync_filter_folder(spark, d):
    keep = c.sync_filter_folder(F.col("path"), F.col("size"), ["PY", ".csv", "docx", "md"], ["SRC", "Doc_1"], 0.002)
    return v.files(spark, d).where(keep).select("id", "path", "size")


@query("sync_filter_mime", """SELECT id, mime, size FROM mimes WHERE NOT (size > 2097)
  AND (starts_with(mime, 'text/') OR starts_with(mime, 'application/vnd.google-apps.document'))""")
def sync_filter_mime(spark, d):
    keep = c.sync_filter_mime(F.col("mime"), F.col("size"), ["text/", "application/vnd.google-apps.document"], 0.002)
    return v.mimes(spark, d).where(keep).select("id", "mime", "size")


def _sql_globs() -> str:
    tests = []
    for g in [*t.DEFAULT_EXCLUDES, "docs/doc_1*"]:
        if g.endswith("/**"):
            tests.append(f"contains('/' || path, '/{g[:-2]}')")
        elif "/" in g:
            head, tail = g.rsplit("/", 1)
            tests.append(f"('/' || path) LIKE '%/{head}/{tail.replace('_', '!_').replace('*', '%')}' ESCAPE '!'")
        else:
            tests.append(f"name LIKE '{g.replace('*', '%')}'")
    return "NOT (" + " OR ".join(tests) + ")"


@query("glob_exclude", f"""SELECT id, path, size, language FROM files WHERE {_sql_globs()} AND size <= 4096 AND language <> 'de'
  AND (starts_with(path, 'docs/') OR starts_with(path, '_priv/') OR starts_with(path, 'a.b/') OR name LIKE '%.py')""")
def glob_exclude(spark, d):
    keep = c.glob_filter(
        F.col("path"), F.col("size"), F.col("language"), include=["docs/**", "_priv/**", "a.b/**", "*.py"],
        exclude=["docs/doc_1*"], exclude_languages=["de"], max_bytes=4096,
    )
    return v.files(spark, d).where(keep).select("id", "path", "size", "language")


@query("only_files", """SELECT id, node_type FROM (SELECT id, ['blob','tree','commit_file','commit_directory','file','folder'][id % 6 + 1] AS node_type
  FROM files) WHERE node_type IN ('blob','commit_file','file')""")
def only_files(spark, d):
    kinds = ["blob", "tree", "commit_file", "commit_directory", "file", "folder"]
    nodes = v.files(spark, d).select("id", v.pick(kinds, F.col("id") % 6).alias("node_type"))
    return nodes.where(c.only_files(F.col("node_type")))


@query("drive_predicate", f"""SELECT id, mime FROM mimes WHERE NOT trashed AND mime <> '{t.FOLDER_MIME}' AND folder = 'f2' AND mine""")
def drive_predicate(spark, d):
    m = v.mimes(spark, d)
    keep = c.drive_predicate(F.col("trashed"), F.col("mime"), F.array("folder"), F.col("mine"), "f2", False)
    return m.where(keep).select("id", "mime")


@query("by_tenant", "SELECT id, type, tenant_id FROM connectors WHERE tenant_id = 3")
def by_tenant(spark, d):
    return agg.by_tenant(v.connectors(spark, d), 3).select("id", "type", "tenant_id")


@query("files_query", """SELECT id, path, language, size FROM files WHERE source_id = 'src3' AND starts_with(path, 'docs/')
  AND language = 'en' ORDER BY path LIMIT 50""")
def files_query(spark, d):
    return agg.files_query(v.files(spark, d), "src3", "docs/", "en", 50).select("id", "path", "language", "size")


@query("jobs_query", """SELECT id, connector_id, status, start_time FROM sync_jobs WHERE status = 'completed'
  ORDER BY start_time DESC, id DESC LIMIT 20""")
def jobs_query(spark, d):
    return agg.jobs_query(v.sync_jobs(spark, d), status="completed").select("id", "connector_id", "status", "start_time")


@query("drop_deleted", "SELECT g, item_id, change_type FROM push_files WHERE change_type <> 'deleted'")
def drop_deleted(spark, d):
    from tributary.operators.joins import drop_deleted as op

    i = F.col("id")
    change = F.when(i % 3 == 0, F.lit("created")).when(i % 3 == 1, F.lit("updated")).otherwise(F.lit("deleted"))
    return op(v.files(spark, d).select(v.div("id", 5).alias("g"), F.col("path").alias("item_id"), change.alias("change_type")))


@query("by_id", "SELECT id, name, type FROM connectors WHERE id = 42")
def by_id(spark, d):
    return agg.by_id(v.connectors(spark, d), 42).select("id", "name", "type")
