"""Domain views derived from the given tables, in Spark and as DuckDB common table expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.content import hmac_pads, hmac_sha256

EXTS = ["py", "js", "rs", "hpp", "cc", "sass", "md", "html", "json", "yml", "txt", "csv", "pdf", "docx", "png", "zip",
        "lock", "ps1", "sql", "tsx", "xml", "bin", "", "PY"]
DIRS = ["src", "docs", "node_modules", ".git", "a.b", "_priv"]
MIMES = ["application/vnd.google-apps.document", "application/vnd.google-apps.spreadsheet",
         "application/vnd.google-apps.presentation", "application/vnd.google-apps.folder", "text/plain",
         "text/markdown", "text/x-python", "text/css", "application/x-y", "application/zip", "image/png",
         "application/pdf"]
TYPES = ["github", "gitlab", "bitbucket", "local_file", "google_drive", "dropbox", "onedrive", "slack", "notion",
         "confluence", "url_scraper"]
MESSAGES = ["file.ingested", "code.normalized", "chunk.created", "embedding.generated", "graph.updated",
            "webhook.github", "webhook.gitlab", "auth.verify", "auth.session", "notification.email",
            "notification.slack", "sync.scheduled", "sync.manual", "mail.sent", "webhooks"]
SECRET = "a-fixed-test-secret"
ZERO_UUID = "00000000-0000-0000-0000-"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def div(c: str, n: int) -> Column:
    return F.floor(F.col(c) / n)


def at(seconds: Column) -> Column:
    """Wall-clock time of an epoch second, whatever the session's zone."""
    return F.expr("timestamp_ntz '1970-01-01'") + F.make_dt_interval(secs=seconds)


def files(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents")
    i = F.col("doc_id")
    ext = pick(EXTS, i % 24)
    name = F.concat(F.lit("doc_"), text(i), F.when(ext != "", F.concat(F.lit("."), ext)).otherwise(F.lit("")))
    return t.select(
        i.alias("id"), F.col("source").alias("source_id"), name.alias("name"),
        F.concat(pick(DIRS, div("doc_id", 24) % 6), F.lit("/"), name).alias("path"),
        F.when(i % 50 == 0, F.lit(0).cast("long")).otherwise(F.octet_length("text").cast("long")).alias("size"),
        F.col("text").alias("content"), F.col("lang").alias("language"), i.alias("seq"),
        pick(TYPES, F.regexp_extract("source", r"(\d+)$", 1).cast("int") % 11).alias("connector_type"),
        F.concat(F.lit("t"), text(i % 7)).alias("tenant_id"),
    )


def mimes(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("id")
    return files(spark, d).withColumns({
        "mime": pick(MIMES, i % 12), "trashed": i % 11 == 0, "mine": i % 3 != 0,
        "folder": F.concat(F.lit("f"), text(i % 5)),
        "modified": F.date_format(at(F.lit(1704067200) + i * 60), "yyyy-MM-dd'T'HH:mm:ss"),
    })


def connectors(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "customer")
    i = F.col("c_custkey")
    kind = pick(TYPES, i % 11)
    config = F.when(i % 5 == 0, F.lit('{"include_languages":["py",".RS"],"repository":"o/r","branch":"dev"}')).when(
        i % 5 == 1, F.lit('{"include_languages":[],"file_extensions":["md"],"project_path":"g/p","max_file_size_mb":1.5}')
    ).when(i % 5 == 2, F.lit('{"root_folder_id":"root9","include_shared":false,"exclude_folders":["Old"],"folder_path":"/in","path":"/srv"}')).when(
        i % 5 == 3, F.concat(F.lit('{"repo_slug":"r'), text(i), F.lit('","workspace":"ws","exclude_paths":["dist","x"],"exclude_patterns":["*.tmp"]}'))
    ).otherwise(F.lit("{}"))
    return t.select(
        i.alias("id"), F.col("c_nationkey").cast("long").alias("tenant_id"), kind.alias("type"), F.col("c_name").alias("name"),
        config.alias("config_json"), F.when(i % 10 == 0, F.lit("disabled")).otherwise(F.lit("active")).alias("status"),
        at(F.lit(1704067200) + i * 60).alias("created_at"),
        F.when(i % 4 != 0, at(F.lit(1706745600) + i)).alias("last_sync_time"),
    )


def sync_jobs(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    ends = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("_end"), F.count(F.lit(1)).alias("_n"))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    status = (
        F.when((F.col("o_orderstatus") == "F") & urgent, F.lit("failed")).when(F.col("o_orderstatus") == "F", F.lit("completed"))
        .when(F.col("o_orderstatus") == "O", F.lit("pending")).otherwise(F.lit("running"))
    )
    return o.join(ends, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("connector_id"), F.col("o_orderdate").alias("start_time"),
        status.alias("status"),
        F.when(F.col("o_orderstatus") == "F", F.col("_end")).alias("end_time"),
        F.when((F.col("o_orderstatus") == "F") & ~urgent, F.coalesce("_n", F.lit(0).cast("long"))).alias("stats_json"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"), F.col("o_orderkey").alias("seq"),
    )


def queue(spark: SparkSession, d: str) -> DataFrame:
    """Pending jobs without the end time: orders only."""
    return table(spark, d, "orders").select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"), F.col("o_orderkey").alias("seq"),
        F.col("o_orderstatus").alias("queue"),
    )


def chunks(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lineitem")
    flag = F.col("l_returnflag")
    state = F.when(flag == "A", F.lit("embedded")).when(flag == "N", F.lit("pending")).otherwise(F.lit("failed"))
    key = F.concat_ws("-", *[text(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    return t.select(
        key.alias("id"), F.col("l_orderkey").alias("source_id"), F.col("l_linenumber").cast("long").alias("chunk_index"),
        (F.col("l_suppkey") % 7).alias("tenant_id"), F.sha2(text("l_partkey"), 256).alias("content_hash"),
        state.alias("embedding_state"), F.col("l_shipdate").alias("created_at"),
        F.when(flag != "N", (F.col("l_orderkey") % 600)).alias("neo4j_id"),
        (F.col("l_orderkey") % 600).alias("wanted_node"), F.col("l_partkey").alias("part"),
    )


def messages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 3).alias("partition"),
        F.get_json_object("props", "$.k").cast("long").alias("offset"), text("user_id").alias("key"),
        F.col("props").alias("value"), (F.col("event_type") != "error").alias("ok"), "ts", F.col("event_id").alias("seq"),
    )


def calls(spark: SparkSession, d: str) -> DataFrame:
    """Calls to ten destinations; about a fifth fail."""
    return table(spark, d, "events").select(
        F.concat(F.lit("d"), text(F.col("user_id") % 10)).alias("destination"), "ts", F.col("event_id").alias("seq"),
        (F.col("event_type") != "error").alias("ok"),
    )


def requests(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("user_id").alias("key"), "ts", F.col("event_id").alias("seq"))


def routes(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("event_id")
    return table(spark, d, "events").select(
        i.alias("seq"), pick(MESSAGES, i % 15).alias("message_type"), (i % 12).cast("int").alias("priority"),
        F.col("event_type"),
    )


def pushes(spark: SparkSession, d: str) -> DataFrame:
    """Push webhooks: five files each, sent as one body; every seventh carries a wrong signature."""
    f = files(spark, d).select("path", "id", div("id", 5).alias("g"))

    def listed(r: int) -> Column:
        found = F.array_sort(F.collect_list(F.when(F.col("id") % 3 == r, F.concat(F.lit('"'), "path", F.lit('"')))))
        return F.array_join(found, ",")

    grouped = f.groupBy("g").agg(listed(0).alias("a"), listed(1).alias("m"), listed(2).alias("r"))
    kind = F.when(F.col("g") % 4 == 0, F.lit("note")).otherwise(F.lit("push"))
    body = F.concat(
        F.lit('{"object_kind":"'), kind, F.lit('","commits":[{"id":"'), F.sha2(F.concat(F.lit("c"), text("g")), 256),
        F.lit('","added":['), F.col("a"), F.lit('],"modified":['), F.col("m"), F.lit('],"removed":['), F.col("r"), F.lit("]}]}"),
    )
    ipad, opad = hmac_pads(SECRET)
    signed = F.concat(F.lit("sha256="), hmac_sha256(body, F.lit(ipad), F.lit(opad)))
    return grouped.select(
        F.col("g").alias("id"), body.alias("body"),
        F.when(F.col("g") % 7 == 0, F.lit("sha256=00")).otherwise(signed).alias("signature"),
        F.col("g").alias("connector_id"),
        at(F.lit(1704067200) + F.col("g")).alias("received_at"),
    )


def callbacks(spark: SparkSession, d: str) -> DataFrame:
    """One callback per document: its text cut into lines as chunks, an error for every ninth."""
    t = table(spark, d, "documents")
    i = F.col("doc_id")
    lines = F.split("text", "\n")
    chunk = F.transform(
        lines,
        lambda x, n: F.struct(
            F.concat(text(i), F.lit("-"), text(n)).alias("chunk_id"), text(i).alias("parent_file_id"), x.alias("content"),
            F.create_map(F.lit("source"), F.col("source")).alias("source_meta"),
            F.struct((n % 3 != 0).alias("for_embeddings"), (n % 2 == 0).alias("for_graph")).alias("ingest_flags"),
        ),
    )
    padded = F.concat(F.lit(ZERO_UUID), F.lpad(text(i), 12, "0"))
    return t.select(
        i.alias("doc_id"), F.concat(F.lit("j"), text(div("doc_id", 5))).alias("job_id"), text(i).alias("parent_file_id"),
        F.when(i % 7 == 0, F.lit("not-a-uuid")).when(i % 5 == 0, F.lit(None)).when(i % 3 == 0, F.upper(F.replace(padded, F.lit("-"))))
        .otherwise(padded).alias("connector_id"),
        F.concat(F.lit("t"), text(i % 7)).alias("tenant_id"), chunk.alias("chunks"),
        F.when(i % 9 == 0, F.array(F.create_map(F.lit("error"), F.lit("bad chunk")))).alias("errors"),
    )


def bodies(spark: SparkSession, d: str, ttl_days: int = 7) -> DataFrame:
    """Chunk bodies with purge time."""
    return chunks(spark, d).withColumn("purge_at", F.col("created_at") + F.make_dt_interval(F.lit(ttl_days)))


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


_IPAD, _OPAD = hmac_pads(SECRET)

# DuckDB counterparts; each may use the ones before it
CTES = {
    "files": f"""
      SELECT doc_id AS id, source AS source_id,
        'doc_' || doc_id || CASE WHEN ext <> '' THEN '.' || ext ELSE '' END AS name,
        {_list(DIRS)}[(doc_id // 24) % 6 + 1] || '/doc_' || doc_id || CASE WHEN ext <> '' THEN '.' || ext ELSE '' END AS path,
        CASE WHEN doc_id % 50 = 0 THEN 0 ELSE strlen(text) END AS size, text AS content, lang AS language, doc_id AS seq,
        {_list(TYPES)}[CAST(regexp_extract(source, '(\\d+)$', 1) AS INT) % 11 + 1] AS connector_type,
        't' || (doc_id % 7) AS tenant_id
      FROM (SELECT *, {_list(EXTS)}[doc_id % 24 + 1] AS ext FROM documents)""",
    "mimes": f"""
      SELECT *, {_list(MIMES)}[id % 12 + 1] AS mime, id % 11 = 0 AS trashed, id % 3 <> 0 AS mine, 'f' || (id % 5) AS folder,
        strftime(make_timestamp((1704067200 + id * 60) * 1000000), '%Y-%m-%dT%H:%M:%S') AS modified FROM files""",
    "connectors": f"""
      SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS tenant_id, {_list(TYPES)}[c_custkey % 11 + 1] AS type, c_name AS name,
        CASE WHEN c_custkey % 10 = 0 THEN 'disabled' ELSE 'active' END AS status,
        make_timestamp((1704067200 + c_custkey * 60) * 1000000) AS created_at,
        CASE WHEN c_custkey % 4 <> 0 THEN make_timestamp((1706745600 + c_custkey) * 1000000) END AS last_sync_time
      FROM customer""",
    "sync_jobs": """
      SELECT o_orderkey AS id, o_custkey AS connector_id, o_orderdate AS start_time,
        CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'failed' WHEN o_orderstatus = 'F' THEN 'completed'
             WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'running' END AS status,
        CASE WHEN o_orderstatus = 'F' THEN e END AS end_time,
        CASE WHEN o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' THEN coalesce(n, 0) END AS stats_json,
        CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority, o_orderkey AS seq
      FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS e, count(*) AS n FROM lineitem GROUP BY 1)
        ON o_orderkey = l_orderkey""",
    "queue": """
      SELECT CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority, o_orderkey AS seq, o_orderstatus AS queue FROM orders""",
    "chunks": """
      SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, l_orderkey AS source_id,
        CAST(l_linenumber AS BIGINT) AS chunk_index, l_suppkey % 7 AS tenant_id,
        sha256(CAST(l_partkey AS VARCHAR)) AS content_hash,
        CASE l_returnflag WHEN 'A' THEN 'embedded' WHEN 'N' THEN 'pending' ELSE 'failed' END AS embedding_state,
        l_shipdate AS created_at, CASE WHEN l_returnflag <> 'N' THEN l_orderkey % 600 END AS neo4j_id,
        l_orderkey % 600 AS wanted_node, l_partkey AS part FROM lineitem""",
    "messages": """
      SELECT event_type AS topic, user_id % 3 AS partition, CAST(json_extract_string(props, '$.k') AS BIGINT) AS "offset",
        CAST(user_id AS VARCHAR) AS key, props AS value, event_type <> 'error' AS ok, ts, event_id AS seq FROM events""",
    "calls": """
      SELECT 'd' || (user_id % 10) AS destination, ts, event_id AS seq, event_type <> 'error' AS ok FROM events""",
    "requests": "SELECT user_id AS key, ts, event_id AS seq FROM events",
    "routes": f"""
      SELECT event_id AS seq, {_list(MESSAGES)}[event_id % 15 + 1] AS message_type, CAST(event_id % 12 AS INT) AS priority,
        event_type FROM events""",
    "pushes": """
      SELECT g AS id, '{"object_kind":"' || CASE WHEN g % 4 = 0 THEN 'note' ELSE 'push' END || '","commits":[{"id":"'
          || sha256('c' || g) || '","added":[' || a || '],"modified":[' || m || '],"removed":[' || r || ']}]}' AS body,
        g AS connector_id, make_timestamp((1704067200 + g) * 1000000) AS received_at
      FROM (SELECT id // 5 AS g,
          coalesce(string_agg('"' || path || '"', ',' ORDER BY path) FILTER (WHERE id % 3 = 0), '') AS a,
          coalesce(string_agg('"' || path || '"', ',' ORDER BY path) FILTER (WHERE id % 3 = 1), '') AS m,
          coalesce(string_agg('"' || path || '"', ',' ORDER BY path) FILTER (WHERE id % 3 = 2), '') AS r
        FROM files GROUP BY 1)""",
    "push_files": """
      SELECT id // 5 AS g, path AS item_id, CASE id % 3 WHEN 0 THEN 'created' WHEN 1 THEN 'updated' ELSE 'deleted' END AS change_type,
        sha256('c' || (id // 5)) AS cursor FROM files""",
    "callbacks": f"""
      SELECT doc_id, 'j' || (doc_id // 5) AS job_id, CAST(doc_id AS VARCHAR) AS parent_file_id,
        CASE WHEN doc_id % 7 = 0 THEN 'not-a-uuid' WHEN doc_id % 5 = 0 THEN NULL
          WHEN doc_id % 3 = 0 THEN replace('{ZERO_UUID}', '-', '') || lpad(CAST(doc_id AS VARCHAR), 12, '0')
          ELSE '{ZERO_UUID}' || lpad(CAST(doc_id AS VARCHAR), 12, '0') END AS connector_id,
        't' || (doc_id % 7) AS tenant_id, string_split(text, chr(10)) AS lines, source FROM documents""",
    "lines": """
      SELECT doc_id, source, tenant_id, job_id, unnest(lines) AS content, unnest(range(len(lines))) AS n FROM callbacks""",
    "bodies": "SELECT *, created_at + INTERVAL 7 DAY AS purge_at FROM chunks",
}


def sql(body: str, recursive: bool = False) -> str:
    """The body with exactly the common table expressions it uses."""
    wanted, seen = [], [body]
    for n in reversed(list(CTES)):
        if any(re.search(rf"\b{n}\b", part) for part in seen):
            wanted.insert(0, n)
            seen.append(CTES[n])
    head = ",\n".join(f"{n} AS ({CTES[n]})" for n in wanted)
    body = body.strip()
    if not head:
        return body
    if body[:5].upper() == "WITH ":
        rest = re.sub(r"^WITH\s+(RECURSIVE\s+)?", "", body, flags=re.I)
        return f"WITH RECURSIVE {head},\n{rest}"
    return f"WITH {head}\n{body}"
