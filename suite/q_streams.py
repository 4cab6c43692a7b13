"""Streaming operators, driven over everything that has landed."""

from pyspark.sql import functions as F

from suite import landing, views as v
from suite.q_content import docs
from suite.q_order import DAY, SQL_ROTATING, SQL_SLIDING
from suite.q_relational import SQL_CHANGES, item_changes
from suite.registry import query
from tributary.operators import changes as ch
from tributary.operators import events as ev
from tributary.session import fresh_path
from tributary.sources import feeds, streams
from tributary.streaming import operators as st


def drained(stream, schema=None):
    """Everything the stream appends, read back from its Parquet sink."""
    spark = stream.sparkSession
    path, checkpoint = fresh_path(spark, "sink"), fresh_path(spark, "progress")
    st.run_available(stream, path, checkpoint)
    return spark.read.schema(stream.schema).parquet(path)


@query("read_event_stream", """SELECT topic, CAST(partition AS INT) AS partition, "offset", key, value, epoch_us(ts) // 1000 AS timestamp FROM messages""")
def read_event_stream(spark, d):
    path = landing.land_messages(v.messages(spark, d))
    return drained(streams.read_event_stream(spark, "parquet", path, batch_size=2).drop("event_time"))


@query("write_event_stream", """WITH ring AS (SELECT md5('partition-' || p || '-vnode-' || i) AS h, CAST(p AS INT) AS p FROM range(3) a(p), range(150) b(i)),
  wrapped AS (SELECT h, p FROM ring UNION ALL SELECT 'g', arg_min(p, h) FROM ring),
  keyed AS (SELECT source_id AS key, md5(source_id) AS m, 'file.ingested' AS topic, '{"event_id":"e' || id || '","source_id":"' || source_id || '","file_path":"' || path
    || '","file_type":"t","content":' || CAST(to_json(content) AS VARCHAR) || ',"metadata":null,"timestamp":"2024-02-01T00:00:00"}' AS value FROM files)
  SELECT key, value, topic, p AS partition FROM keyed ASOF LEFT JOIN wrapped ON keyed.m <= wrapped.h""")
def write_event_stream(spark, d):
    from suite.q_content import fixed_now

    f = docs(spark, d).select("id", "source_id", F.col("path").alias("file_path"), F.lit("t").alias("file_type"), "content")
    stream = landing.stream_of(f, "ingested").withColumn("event_id", F.concat(F.lit("e"), "id"))
    rows = streams.event_rows(stream, "file_ingested", ev.event_envelope(stream, "file_ingested", fixed_now()))
    path, checkpoint = fresh_path(spark, "published"), fresh_path(spark, "progress")
    streams.write_event_stream(rows, checkpoint, "parquet", path).start().awaitTermination()
    out = spark.read.schema("key binary, value binary, topic string, partition int").parquet(path)
    return out.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "topic", "partition")


@query("webhook_log", """SELECT id, 'github' AS provider, 'push' AS event_type, CASE WHEN id % 4 = 1 THEN '{"raw_body":' || CAST(to_json('oops ' || body) AS VARCHAR) || '}' ELSE body END AS payload, 'pending' AS status FROM pushes""")
def webhook_log(spark, d):
    raw = F.when(F.col("id") % 4 == 1, F.concat(F.lit("oops "), F.col("body"))).otherwise(F.col("body"))
    stream = landing.stream_of(v.pushes(spark, d).withColumn("body", raw), "webhooks")
    none = F.lit(None).cast("string")
    log = st.webhook_log(stream, F.lit("github"), F.lit("push"), none, F.col("body"), F.col("signature"))
    return drained(log).select("id", "provider", "event_type", "payload", "status")


@query("stream_consume_dlq", """SELECT 'done' AS outcome, topic, key, CAST(seq AS VARCHAR) AS what FROM messages WHERE ok
  UNION ALL SELECT 'dead', 'dlq.' || topic, key, CAST(seq AS VARCHAR) FROM
  (SELECT *, row_number() OVER (PARTITION BY topic, partition, "offset" ORDER BY seq) AS n FROM messages WHERE NOT ok) WHERE n % 3 = 0""")
def stream_consume_dlq(spark, d):
    m = v.messages(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    out = st.stream_consume_dlq(landing.feed_of(m, "ts", "consumed"), F.col("ok"), F.concat(F.lit("boom "), v.text("seq")))
    return drained(out).select("outcome", "topic", "key", v.text("seq").alias("what"))


@query("stream_dedup", "SELECT DISTINCT content_hash FROM (SELECT sha256(content) AS content_hash FROM files)")
def stream_dedup(spark, d):
    made = v.at(F.lit(1704067200) + F.col("seq")).cast("timestamp")
    hashes = v.files(spark, d).select("seq", F.sha2("content", 256).alias("content_hash"), made.alias("ts"))
    stream = landing.feed_of(hashes, "ts", "hashes", late=F.col("seq") % 5 == 0)
    # all of the table lies within the days for which a repeat is one
    return drained(st.stream_dedup(stream, "content_hash", F.col("seq"), ts="ts", lateness="3650 days")).select("content_hash")


@query("stream_dedup_expiring", f"{SQL_ROTATING} SELECT key, seq FROM f WHERE NOT dup")
def stream_dedup_expiring(spark, d):
    r = v.requests(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    stream = landing.feed_of(r, "ts", "requests", late=F.col("seq") % 9 == 0)
    out = st.stream_dedup_expiring(stream, "key", "ts", "seq", DAY, lateness="10 days")
    return drained(out).select("key", "seq")


@query("stream_throttle", f"{SQL_SLIDING} SELECT key, seq, allowed FROM f")
def stream_throttle(spark, d):
    r = v.requests(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    out = st.stream_throttle(landing.feed_of(r, "ts", "requests"), "key", "ts", "seq", 2, DAY, lateness="2 days")
    return drained(out).select("key", "seq", "allowed")


@query("stream_failure_burst", """SELECT destination, s AS window_start, s + INTERVAL 1 DAY AS window_end, failures FROM (
    SELECT destination, time_bucket(INTERVAL 6 HOUR, ts) - to_hours(CAST(6 * k AS INT)) AS s, count(*) AS failures FROM calls, range(4) r(k) WHERE NOT ok GROUP BY 1, 2)
  WHERE failures >= 5 AND s + INTERVAL 1 DAY <= (SELECT max(ts) FROM calls WHERE NOT ok) - INTERVAL 1 HOUR""")
def stream_failure_burst(spark, d):
    c = v.calls(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    out = drained(st.stream_failure_burst(landing.stream_of(c, "calls"), "1 day", "6 hours", 5, "1 hour"))
    return out.withColumns({x: F.col(x).cast("timestamp_ntz") for x in ("window_start", "window_end")})


@query("stream_changes_to_documents", """SELECT g, f.id, f.path, change_type, cursor, strlen(content) AS size_bytes FROM push_files p
  JOIN (SELECT id // 5 AS h, min(source_id) AS pushed FROM files GROUP BY 1) s ON s.h = p.g
  JOIN files f ON f.path = p.item_id AND f.source_id = s.pushed WHERE change_type <> 'deleted'""")
def stream_changes_to_documents(spark, d):
    # a push comes from one source and reaches none but its files
    source = v.files(spark, d).groupBy(v.div("id", 5).alias("g")).agg(F.min("source_id").alias("source_id"))
    pushed = v.pushes(spark, d).select(F.col("id").alias("g"), F.col("body").alias("payload")).join(source, "g")
    stream = landing.stream_of(pushed, "pushes")
    out = st.stream_changes_to_documents(stream, v.files(spark, d))
    return drained(out.select("g", "id", "path", "change_type", "cursor", F.octet_length("content").cast("long").alias("size_bytes")))


@query("change_feed_stream", f"""SELECT source_id, count(*) AS changes, max(timestamp) AS cursor FROM {SQL_CHANGES} GROUP BY 1""")
def change_feed_stream(spark, d):
    """Changes landed as pages of each source, read by a feed that is stopped half-way and goes on from its checkpoint."""
    path = landing.land_change_pages(item_changes(spark, d), parts=(0, 1))
    out, checkpoint = fresh_path(spark, "changes"), fresh_path(spark, "progress")
    st.run_available(feeds.read_change_feed(spark, path), out, checkpoint)
    landing.land_change_pages(item_changes(spark, d), parts=(2, 3), path=path)
    st.run_available(feeds.read_change_feed(spark, path), out, checkpoint)
    read = spark.read.schema(feeds.SCHEMA).parquet(out).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    n = read.groupBy("source_id").agg(F.count(F.lit(1)).alias("changes"))
    return ch.new_cursor(read, ["source_id"]).join(n, "source_id")
