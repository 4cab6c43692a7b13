"""Lookups, anti-joins and the hash-ring as-of join.

Keys of the dimension side are unique, so a hot key only widens the fact side; adaptive execution
broadcasts a dimension that measures small and splits a skewed fact partition otherwise.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VIRTUAL_NODES = 150  # fixed value: ring points per partition


def job_connector(jobs: DataFrame, connectors: DataFrame) -> DataFrame:
    """Every job with its connector's type, tenant and config."""
    c = connectors.select(
        F.col("id").alias("_cid"), F.col("type").alias("connector_type"), F.col("tenant_id").alias("connector_tenant"),
        "config_json",
    )
    return jobs.join(c, F.col("connector_id") == F.col("_cid")).drop("_cid")


#: Bits that a value of a type takes; times lie within half of theirs, whatever the calendar.
WIDTHS = {"boolean": 1, "tinyint": 8, "smallint": 16, "int": 32, "date": 32, "timestamp": 62, "timestamp_ntz": 62, "bigint": 64}


def _number(column: str, kind: str) -> Column:
    """A value as a long of the same order, the least of all for null."""
    c = F.col(column)
    n = {
        "date": lambda: F.unix_date(c), "timestamp": lambda: F.unix_micros(c),
        "timestamp_ntz": lambda: F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz '1970-01-01'"), c),
    }.get(kind, lambda: c)().cast("long")
    return F.coalesce(n, F.lit(-(1 << (WIDTHS[kind] - 1))).cast("long"))


def packed_version(df: DataFrame, version: list[str]) -> tuple[Column | None, list[str]]:
    """One number in the order of as many of the leading columns as fit, and the columns that are left.

    Up to 64 bits are a long, up to 126 a decimal; either is a fixed-width buffer, so that a hash aggregate finds the greatest.
    """
    kinds, bits, n = dict(df.dtypes), 0, 0
    while n < len(version) and kinds[version[n]] in WIDTHS and bits + WIDTHS[kinds[version[n]]] <= 126:
        bits += WIDTHS[kinds[version[n]]]
        n += 1
    wide = bits > 64 and n > 1
    out = None
    for c in version[:n]:
        number, width = _number(c, kinds[c]), WIDTHS[kinds[c]]
        if out is None:
            out = number.cast("decimal(38,0)") if wide else number
        elif wide:
            # the part below is counted from 0
            below = number.cast("decimal(38,0)") + F.lit(str(1 << (width - 1))).cast("decimal(38,0)")
            out = out * F.lit(str(1 << width)).cast("decimal(38,0)") + below
        else:
            out = F.shiftleft(out, width) + number + F.lit(1 << (width - 1)).cast("long")
    return out, version[n:]


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    out = None
    for c in names:
        one = left[c].eqNullSafe(right[f"_r_{c}"])
        out = one if out is None else out & one
    return out


def latest_by(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """Newest row per key; ``version`` must be unique per key.

    The greatest version of a key is found as one number by a hash aggregate, map-side first, and rows that have it are kept by a semi-join, so
    that no whole row is sorted or carried along. Columns that don't fit into the number, or have no fixed width, decide among these.
    """
    rest = list(version)
    while rest:
        number, left = packed_version(df, rest)
        if number is None:  # text decides among the few rows that are equal so far
            others = [c for c in df.columns if c not in keys]
            newest = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*rest)).alias("_row"))
            return newest.select(*keys, "_row.*").select(*df.columns)
        numbered = df.withColumn("_version", number)
        best = numbered.groupBy(*keys).agg(F.max("_version").alias("_version"))
        best = best.select(*[F.col(c).alias(f"_r_{c}") for c in [*keys, "_version"]])
        df = numbered.join(best, _same(numbered, best, [*keys, "_version"]), "left_semi").drop("_version")
        rest = left
    return df


def sync_status(connectors: DataFrame, jobs: DataFrame) -> DataFrame:
    """Every connector with the status and stats of its latest job, null without one."""
    latest = latest_by(
        jobs.select("connector_id", "start_time", "id", "status", "stats_json"), ["connector_id"], ["start_time", "id"]
    ).select(
        F.col("connector_id").alias("_cid"), F.col("id").alias("last_job_id"),
        F.col("status").alias("last_sync_status"), F.col("stats_json").alias("stats"),
    )
    return connectors.join(latest, F.col("id") == F.col("_cid"), "left").select(
        F.col("id").alias("connector_id"), "last_sync_time", "last_job_id", "last_sync_status", "stats"
    )


def incremental_documents(changes: DataFrame, items: DataFrame) -> DataFrame:
    """Documents of changed items: latest change per source and item, deletions dropped, missing items skipped.

    Item ids are unique in their source only. Changes of one push carry (commit_no, position), which order equal times; where that leaves
    several, a hash of cursor and type decides, and one that comes twice counts once.
    """
    order = [c for c in ("commit_no", "position") if c in changes.columns]
    told = changes.select("source_id", "item_id", "change_type", "cursor", "timestamp", *order).withColumn("_tie", F.xxhash64("cursor", "change_type"))
    latest = latest_by(told, ["source_id", "item_id"], ["timestamp", *order, "_tie"]).select("source_id", "item_id", "change_type", "cursor").distinct()
    live = drop_deleted(latest).select(F.col("source_id").alias("_source"), "item_id", "change_type", "cursor")
    same = (F.col("_source") == F.col("source_id")) & (F.col("item_id") == F.col("external_id"))
    return live.join(items, same).drop("item_id", "_source")


def drop_deleted(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("change_type") != "deleted")


def insert_if_absent(batch: DataFrame, stored: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Rows whose key is not stored yet, first one per key inside the batch.

    The first ``seq`` per key is found by a combining aggregate and matched back on ``seq``, which is
    unique, so a key shared by a third of the rows never meets in one task.
    """
    firsts = batch.groupBy(*keys).agg(F.min(seq).alias(seq))
    # an outer join stays above the aggregate; an anti-join would be pushed below it, onto the raw rows
    known = stored.select(*keys).withColumn("_stored", F.lit(True))
    new = firsts.join(known, keys, "left").where("_stored is null").select(seq)
    return batch.join(new, seq, "left_semi")


def orphan_files(stored: DataFrame, listing: DataFrame) -> DataFrame:
    """Stored files that the current listing no longer has."""
    return stored.join(listing.select("source_id", "path"), ["source_id", "path"], "left_anti")


def cascade_delete(child: DataFrame, deleted: DataFrame) -> DataFrame:
    """Rows of a child table that survive the deletion of connectors."""
    return child.join(deleted.select(F.col("id").alias("connector_id")), "connector_id", "left_anti")


def _uuid_hex(text: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(text, "urn:|uuid:", ""), r"^[{}]+|[{}]+$|-", "")
    return F.when(F.rlike(bare, F.lit("^[0-9a-fA-F]{32}$")), F.lower(bare))


def callback_check(callbacks: DataFrame, connectors: DataFrame) -> DataFrame:
    """Flags a callback whose connector id is malformed or unknown."""
    known = connectors.select(_uuid_hex(F.col("id")).alias("_hex"))
    checked = callbacks.withColumn("_want", _uuid_hex(F.col("connector_id")))
    joined = checked.join(known, F.col("_want") == F.col("_hex"), "left")
    return joined.select(
        *callbacks.columns,
        F.col("_hex").isNotNull().alias("connector_exists"),
        (F.col("connector_id").isNotNull() & F.col("_want").isNull()).alias("invalid_id"),
    )


def stale_pending(chunks: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Chunks still pending after a day; reported, never deleted."""
    cutoff = as_of - F.make_dt_interval(hours=F.lit(hours))
    return chunks.where((F.col("embedding_state") == "pending") & (F.col("created_at") < cutoff))


def missing_vector_chunks(chunks: DataFrame, vectors: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Stale chunks that have no vector node."""
    nodes = vectors.select(F.col("node_id").alias("neo4j_id"))
    return stale_pending(chunks, as_of, hours).join(nodes, "neo4j_id", "left_anti")


def hash_ring(spark, num_partitions: int) -> DataFrame:
    """The ring as half-open intervals (lo, hi] of hex keys, repeated per prefix they touch.

    A prefix has as many digits as leave about one interval under each, however large the ring is.
    """
    points = sorted(
        (hashlib.md5(f"partition-{p}-vnode-{i}".encode()).hexdigest(), p)
        for p in range(num_partitions)
        for i in range(VIRTUAL_NODES)
    )
    spans = [(lo, hi, owner) for (lo, _), (hi, owner) in zip([("", 0), *points], points)]
    spans.append((points[-1][0], "g", points[0][1]))
    ring = spark.createDataFrame(spans, "lo string, hi string, ring_partition int")
    digits = prefix_digits(num_partitions)
    first = F.when(F.col("lo") == "", 0).otherwise(F.conv(F.substring("lo", 1, digits), 16, 10).cast("long"))
    last = F.when(F.col("hi") == "g", 16**digits - 1).otherwise(F.conv(F.substring("hi", 1, digits), 16, 10).cast("long"))
    prefix = F.explode(F.sequence(first, last))
    return ring.withColumn("_n", prefix).withColumn("_prefix", F.lower(F.lpad(F.hex(F.col("_n")), digits, "0"))).drop("_n")


def prefix_digits(num_partitions: int) -> int:
    return max(2, math.ceil(math.log(num_partitions * VIRTUAL_NODES, 16)))


def hash_ring_partition(df: DataFrame, key: str, num_partitions: int = 3) -> DataFrame:
    """Partition of every key by consistent hashing: owner of the first ring point at or after md5(key).

    Equal-width lower-case hex compares like the number. The size of the ring is left to be measured, like
    that of any table. A null key keeps its row and gets no partition.
    """
    ring = hash_ring(df.sparkSession, num_partitions)
    hashed = df.withColumn("_h", F.md5(F.col(key))).withColumn("_p", F.substring("_h", 1, prefix_digits(num_partitions)))
    match = (F.col("_p") == F.col("_prefix")) & (F.col("_h") > F.col("lo")) & (F.col("_h") <= F.col("hi"))
    return hashed.join(ring, match, "left").drop("_h", "_p", "_prefix", "lo", "hi")


def reprocess_plan(chunks: DataFrame, bodies: DataFrame, as_of: Column) -> DataFrame:
    """Reuse a chunk's stored body while it lives, otherwise fetch from the source again."""
    live = bodies.where(F.col("purge_at") > as_of).select(F.col("chunk_id").alias("_live"))
    return chunks.join(live, F.col("id") == F.col("_live"), "left").select(
        *chunks.columns, F.when(F.col("_live").isNotNull(), F.lit("reuse")).otherwise(F.lit("refetch")).alias("plan")
    )


def events_with_connector(events: DataFrame, connectors: DataFrame) -> DataFrame:
    live = connectors.select(F.col("id").alias("connector_id"))
    return events.join(live, "connector_id", "left_semi")


def listing_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Added, removed and changed paths between two listings of (source_id, path, content_hash).

    A listing may have no hashes; a path is there if its row is.
    """
    o = old.select("source_id", "path", F.col("content_hash").alias("old_hash"), F.lit(True).alias("_old"))
    n = new.select("source_id", "path", F.col("content_hash").alias("new_hash"), F.lit(True).alias("_new"))
    both = o.join(n, ["source_id", "path"], "full_outer")
    change = (
        F.when(F.col("_old").isNull(), F.lit("added"))
        .when(F.col("_new").isNull(), F.lit("removed"))
        .when(~F.col("old_hash").eqNullSafe(F.col("new_hash")), F.lit("changed"))
    )
    return both.withColumn("change", change).where("change is not null").drop("_old", "_new")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """One table from many sources; columns a source lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
