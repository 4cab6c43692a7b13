"""Ordering, dedup, throttles and the summaries built on them."""

from pyspark.sql import functions as F

from suite import views as v
from suite.q_content import docs
from suite.q_relational import SQL_BAND
from suite.registry import query
from tributary.functions.content import bloom_size
from tributary.operators import aggregates as agg
from tributary.operators import dedup, ordering, throttle

DAY = 86400


@query("order_by_size", "SELECT seq, strlen(content) AS sort_key, row_number() OVER (ORDER BY strlen(content), seq) AS position FROM files")
def order_by_size(spark, d):
    return ordering.order_by_size(v.files(spark, d), "seq", F.octet_length("content").cast("long"))


@query("dequeue_order", """SELECT queue, seq, priority, row_number() OVER (PARTITION BY queue ORDER BY priority, seq) AS position FROM queue""")
def dequeue_order(spark, d):
    return ordering.dequeue_order(v.queue(spark, d), "queue")


@query("band_dequeue_order", f"""SELECT seq, message_type, priority, event_type, band, row_number() OVER (ORDER BY list_position(['critical','high','normal','low'], band), priority, seq) AS position
  FROM (SELECT *, {SQL_BAND} AS band FROM routes)""")
def band_dequeue_order(spark, d):
    return ordering.band_dequeue_order(v.routes(spark, d))


@query("peek_top", "SELECT queue, priority, seq FROM queue QUALIFY row_number() OVER (PARTITION BY queue ORDER BY priority, seq) = 1")
def peek_top(spark, d):
    return ordering.peek_top(v.queue(spark, d), "queue")


@query("recent_sources", "SELECT id, name, created_at FROM connectors ORDER BY created_at DESC, id DESC")
def recent_sources(spark, d):
    return ordering.recent_sources(v.connectors(spark, d)).select("id", "name", "created_at")


@query("dedup_first_seen", """SELECT seq, sha256(content) AS content_hash, row_number() OVER (PARTITION BY content ORDER BY seq) > 1 AS is_duplicate FROM files""")
def dedup_first_seen(spark, d):
    return dedup.dedup_first_seen(v.files(spark, d), "seq")


BLOOM = (400, 0.05)
BITS, HASHES = bloom_size(*BLOOM)
SQL_BLOOM = f"""(SELECT i.seq, bool_and(first < i.seq) AS is_duplicate FROM
    (SELECT seq, CAST((h1 + k * h2) % {BITS} AS BIGINT) AS pos, min(seq) OVER (PARTITION BY CAST((h1 + k * h2) % {BITS} AS BIGINT)) AS first FROM
      (SELECT seq, ('0x' || substr(s, 1, 32))::UHUGEINT % {BITS} AS h1, (('0x' || substr(s, 33, 32))::UHUGEINT | 1) % {BITS} AS h2
        FROM (SELECT seq, sha256(content) AS s FROM files)), range({HASHES}) r(k)) i GROUP BY 1)"""


@query("bloom_dedup", f"SELECT seq, is_duplicate FROM {SQL_BLOOM}")
def bloom_dedup(spark, d):
    return dedup.bloom_dedup(v.files(spark, d).select("seq", "content"), "content", "seq", *BLOOM).drop("content")


@query("bloom_stats", f"""SELECT size_bits, size_bytes, num_hashes, items_added, checks, positives, round(items_added * {HASHES} / {BITS}, 9) AS fill_ratio,
  round(pow(1 - exp(-(items_added * {HASHES} / {BITS})), {HASHES}), 9) AS estimated_false_positive_rate FROM
  (SELECT CAST({BITS} AS BIGINT) AS size_bits, CAST({-(-BITS // 8)} AS BIGINT) AS size_bytes, CAST({HASHES} AS BIGINT) AS num_hashes,
  count(*) FILTER (WHERE NOT is_duplicate) AS items_added, count(*) AS checks, count(*) FILTER (WHERE is_duplicate) AS positives FROM {SQL_BLOOM})""")
def bloom_stats(spark, d):
    s = agg.bloom_stats(bloom_dedup(spark, d), *BLOOM)
    return s.withColumns({c: F.round(c, 9) for c in ("fill_ratio", "estimated_false_positive_rate")})


SQL_STEPS = "o AS (SELECT key, seq, epoch_us(ts) AS us, row_number() OVER (PARTITION BY key ORDER BY ts, seq) AS rn FROM requests)"


SQL_ROTATING = f"""WITH RECURSIVE {SQL_STEPS}, f(key, rn, seq, last, dup) AS (
    SELECT key, rn, seq, us // {DAY * 1000000}, false FROM o WHERE rn = 1 UNION ALL
    SELECT o.key, o.rn, o.seq, CASE WHEN o.us // {DAY * 1000000} - f.last < 3 THEN f.last ELSE o.us // {DAY * 1000000} END,
      o.us // {DAY * 1000000} - f.last < 3 FROM f JOIN o ON o.key = f.key AND o.rn = f.rn + 1)"""


@query("rotating_dedup", f"{SQL_ROTATING} SELECT key, seq, dup AS is_duplicate FROM f")
def rotating_dedup(spark, d):
    return dedup.rotating_dedup(v.requests(spark, d), "key", "ts", "seq", DAY).drop("ts")


SQL_SLIDING = f"""WITH RECURSIVE {SQL_STEPS}, f(key, rn, seq, us, allowed, kept) AS (
    SELECT key, rn, seq, us, true, [us] FROM o WHERE rn = 1 UNION ALL
    SELECT key, rn, seq, us, len(p) < 2, CASE WHEN len(p) < 2 THEN list_append(p, us) ELSE p END FROM
      (SELECT o.key, o.rn, o.seq, o.us, list_filter(f.kept, lambda x: x >= o.us - {DAY * 1000000}) AS p FROM f JOIN o ON o.key = f.key AND o.rn = f.rn + 1))"""


@query("throttle_sliding", f"{SQL_SLIDING} SELECT key, seq, allowed FROM f")
def throttle_sliding(spark, d):
    return throttle.throttle_sliding(v.requests(spark, d), "key", "ts", "seq", 2, DAY).drop("ts")


@query("retry_after", f"{SQL_SLIDING} SELECT key, seq, round(greatest(0, kept[1] + {DAY * 1000000} - us) / 1000000, 6) AS retry_after FROM f")
def retry_after(spark, d):
    out = throttle.retry_after(v.requests(spark, d), "key", "ts", "seq", 2, DAY)
    return out.select("key", "seq", F.round("retry_after", 6).alias("retry_after"))


@query("throttle_token_bucket", f"""WITH RECURSIVE {SQL_STEPS}, f(key, rn, seq, us, allowed, tokens) AS (
    SELECT key, rn, seq, us, true, 2e0 FROM o WHERE rn = 1 UNION ALL
    SELECT key, rn, seq, us, t >= 1, CASE WHEN t >= 1 THEN t - 1 ELSE t END FROM
      (SELECT o.key, o.rn, o.seq, o.us, least(3e0, f.tokens + CAST(o.us - f.us AS DOUBLE) / 1e6 * 2e-5) AS t FROM f JOIN o ON o.key = f.key AND o.rn = f.rn + 1))
  SELECT key, seq, allowed, round(tokens, 6) AS tokens FROM f""")
def throttle_token_bucket(spark, d):
    out = throttle.throttle_token_bucket(v.requests(spark, d), "key", "ts", "seq", 3, 2e-5)
    return out.select("key", "seq", "allowed", F.round("tokens", 6).alias("tokens"))


SQL_REUSE = f"""WITH RECURSIVE {SQL_STEPS}, f(key, rn, seq, stored, hit) AS (
    SELECT key, rn, seq, us, false FROM o WHERE rn = 1 UNION ALL
    SELECT o.key, o.rn, o.seq, CASE WHEN o.us - f.stored <= {DAY * 1000000} THEN f.stored ELSE o.us END,
      o.us - f.stored <= {DAY * 1000000} FROM f JOIN o ON o.key = f.key AND o.rn = f.rn + 1)"""


@query("request_reuse", f"{SQL_REUSE} SELECT key, seq, hit FROM f")
def request_reuse(spark, d):
    return throttle.request_reuse(v.requests(spark, d), "key", "ts", "seq", DAY).drop("ts")


@query("reuse_stats", f"""{SQL_REUSE} SELECT count(*) FILTER (WHERE hit) AS hits, count(*) FILTER (WHERE NOT hit) AS misses,
  round(count(*) FILTER (WHERE hit) / count(*), 9) AS hit_rate FROM f""")
def reuse_stats(spark, d):
    return agg.reuse_stats(request_reuse(spark, d)).withColumn("hit_rate", F.round("hit_rate", 9))


@query("failure_burst", """SELECT seq, destination, n AS recent_failures, n >= 20 AS burst FROM (SELECT *, count(*) FILTER (WHERE NOT ok) OVER
  (PARTITION BY destination ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS n FROM calls)""")
def failure_burst(spark, d):
    return throttle.failure_burst(v.calls(spark, d), DAY, 20, ties_together=True)


@query("destination_health", """SELECT destination, count(*) FILTER (WHERE NOT ok) AS failures, count(*) FILTER (WHERE ok) AS successes, count(*) AS total_requests,
  max(ts) FILTER (WHERE NOT ok) AS last_failure_time,
  count(*) FILTER (WHERE ok AND ts > coalesce((SELECT max(ts) FROM calls x WHERE NOT x.ok AND x.destination = calls.destination), TIMESTAMP '1970-01-01')) AS consecutive_successes
  FROM calls GROUP BY 1""")
def destination_health(spark, d):
    return agg.destination_health(v.calls(spark, d))


@query("dlq_candidates", """SELECT 'dlq.' || topic AS topic, key, '{"original_topic":"' || topic || '","original_partition":' || partition || ',"original_offset":' || "offset"
    || ',"original_value":' || value || ',"error":"boom ' || seq || '","retry_count":3}' AS value, seq
  FROM (SELECT *, row_number() OVER (PARTITION BY topic, partition, "offset" ORDER BY seq) AS n FROM messages WHERE NOT ok) WHERE n % 3 = 0""")
def dlq_candidates(spark, d):
    failed = v.messages(spark, d).where(~F.col("ok")).withColumn("error", F.concat(F.lit("boom "), v.text("seq")))
    return agg.dlq_candidates(failed)


@query("consume_summary", """SELECT CAST((n - 1) // 100 AS BIGINT) AS batch, count(*) AS polled, count(*) FILTER (WHERE ok) AS processed
  FROM (SELECT ok, row_number() OVER (ORDER BY seq) AS n FROM messages) GROUP BY 1""")
def consume_summary(spark, d):
    return agg.consume_summary(v.messages(spark, d))


@query("chunk_job_batches", """SELECT source_id, batch, count(*) AS item_count, string_agg(seq, ',' ORDER BY seq) AS ids, CAST(sum(strlen(content)) AS BIGINT) AS bytes FROM
  (SELECT *, CAST((row_number() OVER (PARTITION BY source_id ORDER BY seq) - 1) // 20 AS BIGINT) AS batch FROM files) GROUP BY 1, 2""")
def chunk_job_batches(spark, d):
    rows = docs(spark, d).withColumns({"metadata": F.create_map(F.lit("name"), F.col("name")), "updated_at": F.col("created_at")})
    b = agg.chunk_job_batches(rows, 20)
    return b.select(
        "source_id", "batch", F.col("item_count").cast("long").alias("item_count"), F.array_join(F.transform("items", lambda x: x["id"]), ",").alias("ids"),
        F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x["content"])).alias("bytes"),
    )
