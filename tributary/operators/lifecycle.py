"""Jobs, connector state, retention and upserts on plain tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.classify import in_domain
from tributary.functions.tables import DOMAINS
from tributary.operators.joins import latest_by
from tributary.operators.slicing import previous

FINISHED = ["completed", "failed"]

# fixed values: legal steps of a job, from nothing to its end
LEGAL_STEPS = [
    (None, "pending"), ("pending", "running"), ("pending", "failed"), ("running", "completed"), ("running", "failed"),
]


def is_purged(as_of: Column, days: int = 7) -> Column:
    gone = F.col("status").isin(FINISHED) & (F.col("end_time") < as_of - F.make_dt_interval(F.lit(days)))
    return F.coalesce(gone, F.lit(False))


def purge_finished_jobs(jobs: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Jobs that stay: all but finished ones that ended more than ``days`` ago."""
    return jobs.where(~is_purged(as_of, days))


def ttl_expire(bodies: DataFrame, as_of: Column) -> DataFrame:
    """Bodies that stay; one without a purge time is kept."""
    return bodies.where(F.col("purge_at").isNull() | (F.col("purge_at") > as_of))


def retire_tenant(df: DataFrame, tenant: object) -> DataFrame:
    """Everything but one tenant; on a table partitioned by tenant this prunes folders."""
    return df.where(~F.coalesce(F.col("tenant_id") == tenant, F.lit(False)))


def retirement_counts(chunks: DataFrame, bodies: DataFrame, tenant: object) -> DataFrame:
    c = chunks.where(F.col("tenant_id") == tenant).agg(F.count(F.lit(1)).alias("n")).select(F.lit("chunks").alias("store"), "n")
    b = bodies.where(F.col("tenant_id") == tenant).agg(F.count(F.lit(1)).alias("n")).select(F.lit("bodies").alias("store"), "n")
    return c.unionByName(b)


def storage_mode_split(chunks: DataFrame, mode: str, ttl_days: int = 7) -> tuple[DataFrame, DataFrame]:
    """Metadata always, the body as the mode says."""
    from tributary.sources.tables import chunk_bodies

    meta = chunks.drop("content")
    return meta, chunk_bodies(chunks, mode, ttl_days).select("id", "tenant_id", "content", "created_at", "purge_at")


def job_lifecycle(log: DataFrame) -> DataFrame:
    """State of every job from its status log (job_id, seq, ts, status, documents_synced, error_message).

    Only (job_id, seq, code) goes through the ordered pass; what needs no order is one combining aggregate over the log.
    """
    # statuses are compared as their place in the list of statuses, 0 for an unknown one
    place = DOMAINS["job_status"].index
    code = F.coalesce(F.array_position(F.lit(DOMAINS["job_status"]), F.col("status")), F.lit(0)).cast("int")
    steps = log.select("job_id", "seq", code.alias("_code"))
    stepped = previous(steps, "_code", [F.col("seq")], ["job_id"], "_before", nullable=False)
    legal = F.lit(False)
    for before, after in LEGAL_STEPS:
        came = F.col("_before").isNull() if before is None else F.col("_before") == place(before) + 1
        legal = legal | (came & (F.col("_code") == place(after) + 1))
    wrong = stepped.groupBy("job_id").agg(F.count_if(~F.coalesce(legal, F.lit(False))).alias("illegal_steps"))
    ends = F.col("status").isin(FINISHED)
    states = log.groupBy("job_id").agg(
        F.max_by("status", "seq").alias("status"),
        F.min("ts").alias("start_time"),
        F.max(F.when(ends, F.col("ts"))).alias("end_time"),
        F.max_by(F.when(F.col("status") == "completed", F.col("documents_synced")), "seq").alias("documents_synced"),
        F.max_by(F.when(F.col("status") == "failed", F.col("error_message")), "seq").alias("error_message"),
    )
    wrong = wrong.withColumnRenamed("job_id", "_job")
    return states.join(wrong, F.col("job_id").eqNullSafe(F.col("_job"))).drop("_job")


def connector_state(log: DataFrame) -> DataFrame:
    """Connector status from its job log (connector_id, seq, ts, status, cursor).

    Running shows as syncing, completed as active, failed as error; a null cursor keeps the stored one.
    """
    shown = (
        F.when(F.col("status") == "running", F.lit("syncing")).when(F.col("status") == "completed", F.lit("active"))
        .when(F.col("status") == "failed", F.lit("error"))
    )
    done = F.col("status") == "completed"
    moved = log.where("status in ('running','completed','failed')").withColumn("_shown", shown)
    return moved.groupBy("connector_id").agg(
        F.max_by("_shown", "seq").alias("status"),
        F.max(F.when(done, F.col("ts"))).alias("last_sync_time"),
        F.max(F.when(done & F.col("cursor").isNotNull(), F.struct("seq", "cursor")))["cursor"].alias("last_sync_cursor"),
    )


def new_jobs(requests: DataFrame, connectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pending jobs for known connectors and sync types, and the rejected requests."""
    known = connectors.select(F.col("id").alias("connector_id"), "tenant_id")
    valid = in_domain(F.col("type"), "sync_type")
    jobs = requests.where(valid).join(known, "connector_id").select(
        F.sha2(F.concat_ws("|", F.col("request_id").cast("string"), F.col("connector_id").cast("string")), 256).alias("id"),
        "request_id", "connector_id", "tenant_id", F.col("type"), F.lit("pending").alias("status"),
        F.col("requested_at").alias("start_time"),
    )
    unknown = requests.where(valid).join(known.select("connector_id"), "connector_id", "left_anti")
    rejected = unknown.unionByName(requests.where(~valid).select(*unknown.columns))
    return jobs, rejected


def upsert_state(table: DataFrame, updates: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The table after the updates: newest version per key, an update wins a tie."""
    both = table.withColumn("_new", F.lit(0)).unionByName(updates.withColumn("_new", F.lit(1)))
    return latest_by(both, keys, [version, "_new"]).drop("_new")
