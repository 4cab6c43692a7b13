"""Normalized documents, request payloads, event envelopes and message routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import classify as c
from tributary.functions import content as k
from tributary.functions import tables as t

# fixed values: envelope fields in wire order, with their types
ENVELOPES = {
    "file_ingested": "event_id string, source_id string, file_path string, file_type string, content string, "
    "metadata map<string,string>, timestamp string",
    "code_normalized": "event_id string, source_id string, file_path string, language string, "
    "normalized_content string, entities array<map<string,string>>, metadata map<string,string>, timestamp string",
    "webhook": "event_id string, source string, event_type string, payload map<string,string>, priority int",
    "sync_job": "job_id string, source_id string, job_type string, priority int, metadata map<string,string>",
}
# fixed values: fields an event may leave out
OPTIONAL_FIELDS = {"file_ingested": ["timestamp"], "code_normalized": ["timestamp"], "webhook": ["priority"], "sync_job": ["priority", "metadata"]}
# fixed value: priority of an event that names none
DEFAULT_PRIORITY = 5


def normalize_documents(items: DataFrame, contents: DataFrame, on: str = "path") -> DataFrame:
    """Listing entries joined with their source's content as normalized documents; items without content are skipped."""
    body = contents.select(F.col("source_id").alias("_source"), F.col(on).alias("_on"), "content", "content_type", "language")
    joined = items.join(body, (F.col("source_id") == F.col("_source")) & (F.col(on) == F.col("_on")))
    return joined.select(
        k.document_id(F.col("source_id"), F.col("id")).alias("id"), "source_id", "connector_type",
        F.col("id").alias("external_id"), "name", "path", "content",
        F.coalesce("content_type", F.lit("unknown")).alias("content_type"), "metadata",
        F.lit(None).cast("string").alias("block_type"), "language",
        F.coalesce("mime_type", F.lit("text/plain")).alias("mime_type") if "mime_type" in items.columns else F.lit("text/plain").alias("mime_type"),
        k.content_hash(F.col("content")).alias("content_hash"),
        F.octet_length("content").cast("long").alias("size_bytes"), "created_at", "updated_at",
    )


def _flags(for_embeddings: bool, for_graph: bool, priority: str) -> Column:
    return F.struct(
        F.lit(for_embeddings).alias("for_embeddings"), F.lit(for_graph).alias("for_graph"),
        F.lit(priority).alias("priority"),
    ).alias("ingest_flags")


def _optional(docs: DataFrame, names: list[str]) -> list[Column]:
    return [F.col(n) for n in names if n in docs.columns]


def inline_body(docs: DataFrame, for_embeddings: bool = True, for_graph: bool = True, priority: str = "normal") -> Column:
    """Fields of a request that carries the content."""
    return F.struct(
        "tenant_id", "connector_id", F.col("connector_type").alias("source_type"), F.col("id").alias("file_id"),
        F.col("name").alias("file_name"), F.col("path").alias("file_path"),
        *_optional(docs, ["file_mime", "repo", "branch", "commit", "author"]), "content",
        _flags(for_embeddings, for_graph, priority),
        c.chunk_strategy(F.col("connector_type"), F.col("language")).alias("suggest_chunk_strategy"),
        F.octet_length("content").alias("size_bytes"),
    )


def reference_body(docs: DataFrame, for_embeddings: bool = True, for_graph: bool = True, priority: str = "normal") -> Column:
    """Fields of a request that names a blob instead."""
    return F.struct(
        "tenant_id", "connector_id", F.col("connector_type").alias("source_type"), F.col("id").alias("file_id"),
        F.col("name").alias("file_name"), "blob_url", F.col("size_bytes").alias("size_bytes"),
        *_optional(docs, ["file_mime", "repo", "branch", "commit", "author"]),
        _flags(for_embeddings, for_graph, priority),
        c.chunk_strategy(F.col("connector_type"), F.col("language")).alias("suggest_chunk_strategy"),
    )


def ingest_payload(docs: DataFrame, for_embeddings: bool = True, for_graph: bool = True, priority: str = "normal") -> DataFrame:
    """Inline request per document as JSON; null fields are dropped."""
    return docs.select("id", F.to_json(inline_body(docs, for_embeddings, for_graph, priority)).alias("payload"))


def reference_payload(docs: DataFrame, for_embeddings: bool = True, for_graph: bool = True, priority: str = "normal") -> DataFrame:
    """Request that names a blob instead of carrying the content."""
    return docs.select("id", F.to_json(reference_body(docs, for_embeddings, for_graph, priority)).alias("payload"))


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def event_envelope(events: DataFrame, kind: str, as_of: Column) -> Column:
    """JSON of an event, nulls kept; a missing timestamp becomes ``as_of``, a missing priority the default."""
    schema = events.sparkSession.createDataFrame([], ENVELOPES[kind]).schema
    fields = []
    for f in schema:
        value = F.col(f.name).cast(f.dataType) if f.name in events.columns else F.lit(None).cast(f.dataType)
        if f.name == "timestamp":
            value = F.coalesce(value, iso(as_of))
        if f.name == "priority":
            value = F.coalesce(value, F.lit(DEFAULT_PRIORITY))
        fields.append(value.alias(f.name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def event_parse(messages: DataFrame, kind: str, value: str = "value") -> DataFrame:
    """Typed event plus an error for malformed JSON, missing fields and unknown fields."""
    names = [f.split(" ")[0] for f in _fields(ENVELOPES[kind])]
    required = [n for n in names if n not in OPTIONAL_FIELDS[kind]]
    parsed = F.from_json(F.col(value), ENVELOPES[kind] + ", _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    keys = F.json_object_keys(F.when(F.try_parse_json(F.col(value)).isNotNull(), F.col(value)))
    with_event = messages.withColumn("_event", parsed).withColumn("_keys", keys)
    error = (
        F.when(F.col("_keys").isNull() | F.col("_event._corrupt_record").isNotNull(), F.lit("malformed"))
        .when(F.size(F.array_except(F.lit(required), F.col("_keys"))) > 0, F.lit("missing field"))
        .when(F.size(F.array_except(F.col("_keys"), F.lit(names))) > 0, F.lit("unknown field"))
    )
    typed = F.struct(*[F.col(f"_event.{n}").alias(n) for n in names])
    return with_event.withColumn("error", error).withColumn("event", F.when(F.col("error").isNull(), typed)).drop("_event", "_keys")


def _fields(ddl: str) -> list[str]:
    """Top-level fields of a DDL string."""
    out, depth, current = [], 0, ""
    for ch in ddl:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            out.append(current.strip())
            current = ""
        else:
            current += ch
    return [*out, current.strip()]


def route_message(messages: DataFrame, type_col: str = "message_type") -> DataFrame:
    """Backend per message type, and whether the backend really publishes it."""
    mt = F.col(type_col)
    backend = F.when(mt.isin(t.KAFKA_TYPES), F.lit("kafka")).when(mt.isin(t.RABBIT_TYPES), F.lit("rabbit")).otherwise(F.lit("unknown"))
    sent = mt.startswith("webhook.") | mt.startswith("sync.")
    published = F.when(F.col("backend") == "kafka", F.lit(True)).when(F.col("backend") == "rabbit", sent).otherwise(F.lit(False))
    return messages.withColumn("backend", F.coalesce(backend, F.lit("unknown"))).withColumn("published", F.coalesce(published, F.lit(False)))


def routing_key(message_type: Column, event_type: Column) -> Column:
    """``source.event_type`` for webhooks, the job type for syncs."""
    second = F.split_part(message_type, F.lit("."), F.lit(2))
    return F.when(message_type.startswith("webhook."), F.concat_ws(".", second, event_type)).when(
        message_type.startswith("sync."), second
    )


# fixed values: option keys of a source config
OPTIONS = (
    "include_languages array<string>, file_extensions array<string>, include_extensions array<string>, "
    "include_mime_types array<string>, exclude_paths array<string>, exclude_folders array<string>, "
    "max_file_size_mb double, include_shared boolean, branch string, repository string, project_path string, "
    "repo_slug string, workspace string, folder_id string, root_folder_id string, folder_path string, path string, "
    "exclude_patterns array<string>"
)


def parse_sync_options(connectors: DataFrame, config: str = "config_json") -> DataFrame:
    """Typed option columns of every connector; fallback keys apply where the first is absent or empty."""
    o = connectors.withColumn("_o", F.from_json(F.col(config), OPTIONS))

    def filled(name: str) -> Column:
        value = F.col(f"_o.{name}")
        return F.when(F.size(value) > 0, value)

    def text(name: str) -> Column:
        return F.nullif(F.col(f"_o.{name}"), F.lit(""))

    none = F.array().cast("array<string>")
    return o.select(
        *connectors.columns,
        F.coalesce(filled("include_languages"), filled("file_extensions"), none).alias("include_languages"),
        F.coalesce(filled("include_extensions"), none).alias("include_extensions"),
        F.coalesce(filled("include_mime_types"), none).alias("include_mime_types"),
        F.coalesce(filled("exclude_paths"), none).alias("exclude_paths"),
        F.coalesce(filled("exclude_folders"), none).alias("exclude_folders"),
        F.col("_o.max_file_size_mb").alias("max_file_size_mb"),
        F.coalesce("_o.include_shared", F.lit(True)).alias("include_shared"),
        F.coalesce("_o.branch", F.lit("main")).alias("branch"),
        F.coalesce(text("repository"), text("project_path"), text("repo_slug"), F.lit("")).alias("repository"),
        F.coalesce(text("folder_id"), text("root_folder_id")).alias("folder_id"),
        *[F.coalesce(text(n), F.lit("")).alias(n) for n in ("workspace", "folder_path", "path")],
        F.coalesce(filled("exclude_patterns"), none).alias("exclude_patterns"),
    )


def source_summary_view(connectors: DataFrame) -> DataFrame:
    """Legacy listing row with its constant columns."""
    return connectors.select(
        "id", "name", F.col("type").alias("connector_type"), "status", F.lit("pending").alias("sync_status"),
        F.lit(0).alias("documents_count"), iso(F.col("last_sync_time")).alias("last_synced_at"),
        iso(F.col("created_at")).alias("created_at"),
    )


def fanout_chunks(callbacks: DataFrame, embeddings_enabled: bool = True, graph_enabled: bool = True) -> tuple[DataFrame, DataFrame]:
    """Embedding rows and graph rows of the chunks in callbacks, each where its flag allows."""
    chunk = callbacks.select("job_id", "tenant_id", F.explode("chunks").alias("c"))
    wants = lambda flag: F.coalesce(F.col(f"c.ingest_flags.{flag}"), F.lit(True))
    embed = chunk.where(F.lit(embeddings_enabled) & wants("for_embeddings")).select(
        F.col("c.chunk_id").alias("id"), "c.content", "c.source_meta", "tenant_id"
    )
    graph = chunk.where(F.lit(graph_enabled) & wants("for_graph")).select(
        "c.chunk_id", "c.content", "c.source_meta",
        F.create_map(F.lit("job_id"), F.col("job_id"), F.lit("parent_file_id"), F.col("c.parent_file_id")).alias("provenance"),
        "tenant_id",
    )
    return embed, graph
