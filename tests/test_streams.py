"""Streams over several micro-batches give what the batch operators give."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_sequences import T0, hot_events
from tributary.operators import dedup, throttle
from tributary.session import fresh_path
from tributary.streaming import operators as st

SCHEMA = "key string, ts timestamp, seq bigint"


@pytest.fixture(scope="module")
def feed(spark):
    """The events in time order, landed one file after the other, one file per micro-batch."""
    rows = [(k or "none", t, s) for k, t, s in hot_events(600)]
    path = fresh_path(spark, "feed")
    for i in range(0, 600, 150):
        spark.createDataFrame(rows[i : i + 150], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.createDataFrame(rows, SCHEMA), path


def stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def drained(df):
    spark = df.sparkSession
    out, progress = fresh_path(spark, "out"), fresh_path(spark, "progress")
    st.run_available(df, out, progress)
    return spark.read.schema(df.schema).parquet(out)


def test_throttle(spark, feed):
    batch, path = feed
    want = {r["seq"]: r["allowed"] for r in throttle.throttle_sliding(batch, "key", "ts", "seq", 5, 60).collect()}
    got = drained(st.stream_throttle(stream(spark, path), "key", "ts", "seq", 5, 60)).collect()
    assert {r["seq"]: r["allowed"] for r in got} == want


def test_expiring_dedup(spark, feed):
    batch, path = feed
    want = {r["seq"] for r in dedup.rotating_dedup(batch, "key", "ts", "seq", 100).where("not is_duplicate").collect()}
    got = drained(st.stream_dedup_expiring(stream(spark, path), "key", "ts", "seq", 100)).collect()
    assert {r["seq"] for r in got} == want and len(got) == len(want)


def test_salted_dedup(spark, feed):
    got = drained(st.stream_dedup(stream(spark, feed[1]), "key", F.col("seq"))).collect()
    assert sorted(r["key"] for r in got) == ["a", "hot", "none"]


MESSAGES = "topic string, partition int, offset long, key string, value string, ok boolean, ts timestamp, seq long"


def messages(n=240):
    """Every message of a fifth of the offsets fails, most of them several times over."""
    return [("t", k % 2, k % 12, "key", f'{{"n":{k}}}', k % 12 % 5 != 0, T0 + timedelta(seconds=k), k) for k in range(n)]


def landed(spark, rows, schema, label, batches=4):
    path = fresh_path(spark, label)
    size = -(-len(rows) // batches)
    for i in range(0, len(rows), size):
        spark.createDataFrame(rows[i : i + size], schema).coalesce(1).write.mode("append").parquet(path)
    return path


def test_letters_leave_in_their_batch_and_never_twice(spark):
    rows = messages()
    path, out, progress = landed(spark, rows, MESSAGES, "messages"), fresh_path(spark, "out"), fresh_path(spark, "progress")
    before = set(os.listdir(os.path.dirname(path)))

    def consume():
        feed = spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", 1).parquet(path)
        st.run_available(st.stream_consume_dlq(feed, F.col("ok"), F.concat(F.lit("boom "), F.col("seq")), 3), out, progress)
        return spark.read.parquet(out).collect()

    got = consume()
    failures: dict = {}
    want = []
    for t, p, o, _, value, ok, _, seq in rows:
        if not ok:
            failures[t, p, o] = failures.get((t, p, o), 0) + 1
            if failures[t, p, o] % 3 == 0:
                want.append(("dlq.t", seq))
    assert sorted((r["topic"], r["seq"]) for r in got if r["outcome"] == "dead") == sorted(want) and want
    assert sorted(r["seq"] for r in got if r["outcome"] == "done") == [m[7] for m in rows if m[5]]
    letter = json.loads(next(r for r in got if r["outcome"] == "dead")["value"])
    assert letter["retry_count"] == 3 and letter["error"].startswith("boom ") and letter["original_topic"] == "t"
    assert sorted(map(tuple, consume())) == sorted(map(tuple, got))  # a restart finds nothing new
    commits = sorted((int(n) for n in os.listdir(f"{progress}/commits") if n.isdigit()))
    for name in (str(commits[-1]), f".{commits[-1]}.crc"):
        if os.path.exists(f"{progress}/commits/{name}"):
            os.remove(f"{progress}/commits/{name}")
    assert sorted(map(tuple, consume())) == sorted(map(tuple, got))  # the last batch is run again and sends nothing twice
    assert set(os.listdir(os.path.dirname(path))) - before == {os.path.basename(out), os.path.basename(progress)}  # no copy of a batch stays


def test_counts_at_rest_are_given_up(spark):
    fails = [("t", 0, 1, "k", "v", False, T0 + timedelta(seconds=s), s) for s in (0, 1)]
    later = [("t", 0, k, "k", "v", True, T0 + timedelta(days=k), 10 + k) for k in (5, 6, 7)]
    path = landed(spark, [*fails, *later, ("t", 0, 1, "k", "v", False, T0 + timedelta(days=7), 99)], MESSAGES, "messages", batches=6)
    feed = spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", 1).parquet(path)
    out = st.stream_consume_dlq(feed, F.col("ok"), F.lit("x"), 3, ts="ts", lateness="1 hour", keep_seconds=86_400)
    assert {r["outcome"] for r in drained(out).collect()} == {"done"}  # the third failure comes when the first two are forgotten


def states(progress):
    return [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in progress]


def run_with_progress(df):
    spark, out, progress = df.sparkSession, fresh_path(df.sparkSession, "out"), fresh_path(df.sparkSession, "progress")
    seen = st.run_available(df, out, progress)
    return spark.read.schema(df.schema).parquet(out).collect(), seen


@pytest.fixture(scope="module")
def days(spark):
    """Ten keys on each of six days, each day's rows as a batch; every fifth row comes again a day later; the last day has one key."""
    rows = [(f"d{d}k{k % 10}", T0 + timedelta(days=d, seconds=k), d * 100 + k) for d in range(6) for k in range(40)]
    path = fresh_path(spark, "days")
    for d in range(7):
        batch = [r for r in rows if r[2] // 100 == d] + [r for r in rows if r[2] // 100 == d - 1 and r[2] % 5 == 0]
        if d == 6:
            batch.append(("end", T0 + timedelta(days=60), 999))
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([("end", T0 + timedelta(days=61), 1000)], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return rows, path


def test_state_behind_the_watermark_is_freed(spark, days):
    rows, path = days
    firsts = {k: min(r[2] for r in rows if r[0] == k) for k in {r[0] for r in rows}}
    got, seen = run_with_progress(st.stream_dedup(stream(spark, path), "key", ts="ts", lateness="30 hours"))
    assert sorted(r["key"] for r in got if r["key"] != "end") == sorted(firsts)
    assert max(states(seen)) > 10 and states(seen)[-1] <= 1
    got, seen = run_with_progress(st.stream_dedup_expiring(stream(spark, path), "key", "ts", "seq", 86_400, 1, lateness="30 hours"))
    assert {r["key"]: r["seq"] for r in got if r["key"] != "end"} == firsts
    assert max(states(seen)) > 10 and states(seen)[-1] <= 2
    got, seen = run_with_progress(st.stream_throttle(stream(spark, path), "key", "ts", "seq", 2, 60, lateness="30 hours"))
    assert max(states(seen)) > 10 and states(seen)[-1] <= 4


def test_throttle_of_rows_out_of_order(spark):
    """Whatever the order and the frames they come in, no window holds more than the limit, and a row that fits is allowed."""
    rng = random.Random(3)
    rows = [("k", T0 + timedelta(seconds=rng.randrange(900)), k) for k in range(400)]
    path = landed(spark, rows, SCHEMA, "unordered")
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(setting, "30")
    try:
        got = drained(st.stream_throttle(stream(spark, path), "key", "ts", "seq", 5, 60, lateness="2 hours")).collect()
    finally:
        spark.conf.unset(setting)
    assert sorted(r["seq"] for r in got) == list(range(400))
    kept = sorted(r["us"] for r in got if r["allowed"])
    assert all(kept[i + 5] - kept[i] > 60_000_000 for i in range(len(kept) - 5)) and len(kept) > 30
    refused = [r["us"] for r in got if not r["allowed"]]
    assert all(sum(1 for t in kept if t >= now - 60_000_000) >= 5 for now in refused)


def test_failure_windows(spark):
    rows = [("d", T0 + timedelta(seconds=s), False) for s in (1, 2, 3, 4, 5)] + [("d", datetime(2024, 1, 2), False)]
    path = fresh_path(spark, "calls")
    spark.createDataFrame(rows, "destination string, ts timestamp, ok boolean").write.parquet(path)
    calls = spark.readStream.schema("destination string, ts timestamp, ok boolean").parquet(path)
    got = drained(st.stream_failure_burst(calls, threshold=5)).collect()
    assert {(r["window_end"] - T0).total_seconds() for r in got} == {10.0, 20.0, 30.0, 40.0, 50.0, 60.0}


def test_keys_share_state_rows_and_are_judged_in_order(spark, monkeypatch):
    """Many keys, one of them null and some beyond a double, whose rows come unordered in small frames: verdicts are those of the batch operators."""
    monkeypatch.setattr(st, "SHARDS", 4, raising=False)
    rng = random.Random(11)
    names = [None, 2**60, 2**60 + 1, *range(40)]
    rows = [(rng.choice(names), T0 + timedelta(seconds=rng.randrange(3000)), k) for k in range(3000)]
    rows = sorted(rows, key=lambda r: (r[1] >= T0 + timedelta(seconds=1500), rng.random()))  # ordered between batches only
    schema, path = "key bigint, ts timestamp, seq bigint", fresh_path(spark, "shards")
    cut = sum(r[1] < T0 + timedelta(seconds=1500) for r in rows)
    for part in (rows[:cut], rows[cut:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    batch, setting = spark.createDataFrame(rows, schema), "spark.sql.execution.arrow.maxRecordsPerBatch"
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    spark.conf.set(setting, "30")
    try:
        got, seen = run_with_progress(st.stream_throttle(feed, "key", "ts", "seq", 2, 60))
        first, seen2 = run_with_progress(st.stream_dedup_expiring(feed, "key", "ts", "seq", 100))
    finally:
        spark.conf.unset(setting)
    want = throttle.throttle_sliding(batch, "key", "ts", "seq", 2, 60).collect()
    assert sorted((r["seq"], r["key"] or 0, r["allowed"]) for r in got) == sorted((r["seq"], r["key"] or 0, r["allowed"]) for r in want)
    want = dedup.rotating_dedup(batch, "key", "ts", "seq", 100).where("not is_duplicate").collect()
    assert sorted((r["seq"], r["key"] or 0) for r in first) == sorted((r["seq"], r["key"] or 0) for r in want)
    assert max(states(seen)) <= 4 and max(states(seen2)) <= 4
