"""Sequential rules and sliced windows against short Python models, on keys far larger than a slice."""

import bisect
import hashlib
import os
import random
from collections import deque
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tributary.functions.content import bloom_size
from tributary.operators import aggregates as agg
from tributary.operators import dedup, joins, lifecycle, ordering, slicing, throttle

T0 = datetime(2024, 1, 1)
pytestmark = pytest.mark.usefixtures("many_slices")


def hot_events(n=1500, step=3.0, seed=7):
    """(key, ts, seq): one key holds most rows, times tie often, some pauses are long, one key is null."""
    rng, at, out = random.Random(seed), 0.0, []
    for seq in range(n):
        at += 0 if rng.random() < 0.2 else rng.choice([step / 2, step, step, 400.0 if rng.random() < 0.02 else step])
        key = rng.choice(["hot"] * 8 + ["a", None])
        out.append((key, T0 + timedelta(seconds=at), seq))
    return out


@pytest.fixture(scope="module")
def events(spark):
    rows = hot_events()
    return rows, spark.createDataFrame(rows, "key string, ts timestamp, seq bigint").repartition(5)


def by_key(rows):
    groups = {}
    for key, ts, seq in rows:
        groups.setdefault(key, []).append(((ts - T0).total_seconds(), seq))
    return {k: sorted(g) for k, g in groups.items()}


@pytest.mark.parametrize("limit, window", [(1, 60), (5, 60), (20, 60), (3, 7.5)])
def test_sliding_window(events, limit, window):
    rows, df = events
    want = {}
    for group in by_key(rows).values():
        kept = deque()
        for now, seq in group:
            while kept and kept[0] < now - window:
                kept.popleft()
            ok = len(kept) < limit
            if ok:
                kept.append(now)
            want[seq] = (ok, round(max(0.0, kept[0] + window - now), 6))
    ok = {r["seq"]: r["allowed"] for r in throttle.throttle_sliding(df, "key", "ts", "seq", limit, window).collect()}
    wait = {r["seq"]: round(r["retry_after"], 6) for r in throttle.retry_after(df, "key", "ts", "seq", limit, window).collect()}
    assert {s: (ok[s], wait[s]) for s in want} == want and len(ok) == len(rows)


@pytest.mark.parametrize("capacity, rate", [(10, 0.25), (3, 0.05), (100, 10)])
def test_token_bucket(events, capacity, rate):
    rows, df = events
    want = {}
    for group in by_key(rows).values():
        tokens, last = float(capacity), None
        for now, seq in group:
            if last is not None:
                tokens = min(capacity, tokens + (now - last) * rate)
            last = now
            want[seq] = tokens >= 1
            tokens -= want[seq]
    got = throttle.throttle_token_bucket(df, "key", "ts", "seq", capacity, rate).collect()
    assert {r["seq"]: r["allowed"] for r in got} == want


def test_reuse_does_not_renew(events):
    rows, df = events
    want = {}
    for group in by_key(rows).values():
        stored = None
        for now, seq in group:
            want[seq] = stored is not None and now - stored <= 300
            if not want[seq]:
                stored = now
    out = throttle.request_reuse(df, "key", "ts", "seq", 300)
    assert {r["seq"]: r["hit"] for r in out.collect()} == want
    hits = sum(want.values())
    assert agg.reuse_stats(out).first().asDict() == {"hits": hits, "misses": len(want) - hits, "hit_rate": hits / len(want)}


def test_exact_edges(spark):
    rows = [("k", T0 + timedelta(seconds=s), i) for i, s in enumerate([0, 60, 60.000001, 120])]
    df = spark.createDataFrame(rows, "key string, ts timestamp, seq bigint")
    got = {r["seq"]: r["allowed"] for r in throttle.throttle_sliding(df, "key", "ts", "seq", 1, 60).collect()}
    assert got == {0: True, 1: False, 2: True, 3: False}
    hit = {r["seq"]: r["hit"] for r in throttle.request_reuse(df, "key", "ts", "seq", 60).collect()}
    assert hit == {0: False, 1: True, 2: False, 3: True}


def saturated(spark, n=3000):
    """One key whose limits never let go from its first row to its last, and rows without key or time."""
    rows = [("hot", T0 + timedelta(seconds=i // 3), i) for i in range(n)] + [(None, T0, n), ("hot", None, n + 1)]
    return spark.createDataFrame(rows, "key string, ts timestamp, seq bigint").repartition(6)


def sliding(times, limit, window):
    kept, out = deque(), []
    for now in times:
        while kept and kept[0] < now - window:
            kept.popleft()
        out.append(len(kept) < limit)
        if out[-1]:
            kept.append(now)
    return out


@pytest.mark.parametrize("run", [
    lambda df: throttle.throttle_sliding(df, "key", "ts", "seq", 7, 60),
    lambda df: throttle.throttle_token_bucket(df, "key", "ts", "seq", 10, 0.5),
    lambda df: throttle.request_reuse(df, "key", "ts", "seq", 300),
])
def test_a_saturated_key_takes_as_many_jobs_over_any_number_of_slices(spark, run):
    df, context, setting = saturated(spark), spark.sparkContext, "spark.sql.shuffle.partitions"
    before, jobs, answers = spark.conf.get(setting), [], []
    try:
        for slices in (8, 32, 128):
            spark.conf.set(setting, str(slices))
            context.setJobGroup(f"fold-{slices}", "fold")
            answers.append(sorted(tuple(r) for r in run(df).collect() if r["key"]))
            jobs.append(len(context.statusTracker().getJobIdsForGroup(f"fold-{slices}")))
    finally:
        spark.conf.set(setting, before)
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(set(jobs)) == 1 and answers[0] == answers[1] == answers[2] and len(answers[0]) == 3000
    if len(answers[0][0]) == 4 and isinstance(answers[0][0][3], bool):
        kept = sorted(answers[0], key=lambda r: r[2])
        want = sliding([i // 3 for i in range(3000)], 7, 60)
        assert [r[3] for r in kept] == (want if sum(want) == sum(r[3] for r in kept) else [not m for m in sliding([i // 3 for i in range(3000)], 1, 300)])


def test_only_busy_runs_are_folded_again():
    """A slice that starts behind a long pause, or whose key is new, needs no second pass; nor does one behind a settled head."""
    from tributary.operators.folds import _busy_runs

    fold = throttle.SlidingWindow(2, 10)
    second = 1_000_000

    def end(n, first, key, last, state, whole):
        return {"slice": n, "first": [first[0], first[1] * second], "key": key, "last": last * second, "state": [x * second for x in state], "whole": whole}

    ends = [
        end(0, ("a", 0), "a", 9, [8, 9], True), end(1, ("a", 12), "a", 20, [19, 20], True), end(2, ("a", 21), "a", 90, [90], False),
        end(3, ("a", 95), "a", 99, [95, 99], True), end(4, ("a", 120), "b", 5, [5], False), end(5, ("b", 15), "b", 15, [15], True),
    ]
    run_of, arriving = _busy_runs(fold, ends)
    assert run_of == {1: 1, 2: 1, 3: 3, 5: 5}
    assert arriving == {1: [8 * second, 9 * second], 3: [90 * second], 5: [5 * second]}


def test_fold_keeps_types_and_nulls(spark):
    rows = [(2**60 + 1, T0, 1), (None, T0, 2), (None, T0 + timedelta(seconds=1), 3)]
    df = spark.createDataFrame(rows, "key bigint, ts timestamp, seq bigint")
    got = throttle.throttle_sliding(df, "key", "ts", "seq", 1, 60)
    assert sorted((r["seq"], r["key"], r["allowed"]) for r in got.collect()) == [(1, 2**60 + 1, True), (2, None, True), (3, None, False)]
    assert throttle.throttle_sliding(df.where("false"), "key", "ts", "seq", 1, 60).count() == 0


@pytest.mark.parametrize("window", [60, 9])
def test_failure_burst(events, window):
    rows, df = events
    calls = df.select(F.coalesce("key", F.lit("none")).alias("destination"), "ts", "seq", (F.col("seq") % 3 != 0).alias("ok"))
    want = {}
    for group in by_key(rows).values():
        fails = []
        for now, seq in group:
            if seq % 3 == 0:
                fails.append(now)
            want[seq] = sum(1 for t in fails if t >= now - window)
    got = throttle.failure_burst(calls, window, 5).collect()
    assert {r["seq"]: r["recent_failures"] for r in got} == want
    assert all(r["burst"] == (r["recent_failures"] >= 5) for r in got)


def test_failure_burst_query_with_equal_times(spark, tmp_path):
    """Copies of the events under other numbers and users of the same destination, as SQL frames them."""
    from suite.compare import difference, duck
    from suite.q_order import failure_burst
    from suite.registry import ORACLES

    rows = [(k, T0 + timedelta(hours=7 * (k % 25 // 2)), k % 25 * 10, "error" if k % 3 else "view", 0.0, "{}") for k in range(100)]
    types = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, types).coalesce(1).write.parquet(str(tmp_path / "events"))
    os.replace(next((tmp_path / "events").glob("part-*.parquet")), tmp_path / "events.parquet")
    assert difference(spark, duck(str(tmp_path)), str(tmp_path), failure_burst, ORACLES["failure_burst"]) is None


def test_failure_burst_at_equal_times(spark):
    """Calls of one time see each other; calls that share a number, or have no time or outcome, have an answer each."""
    late = T0 + timedelta(seconds=61)
    rows = [("d", T0, 2, False), ("d", T0, 1, False), ("d", T0, 3, True), ("d", T0, 3, True), ("e", T0, 1, None), ("d", late, 4, False)]
    rows += [("d", None, 5, False), ("d", None, 6, True), (None, T0, 7, False), (None, T0, 8, None)]
    calls = spark.createDataFrame(rows, "destination string, ts timestamp, seq bigint, ok boolean")
    got = throttle.failure_burst(calls, 60, 2, ties_together=True).collect()
    assert sorted(((r["seq"], r["destination"] or "", r["recent_failures"], r["burst"]) for r in got)) == [
        (1, "d", 2, True), (1, "e", 0, False), (2, "d", 2, True), (3, "d", 2, True), (3, "d", 2, True), (4, "d", 1, False),
        (5, "d", 1, False), (6, "d", 1, False), (7, "", 1, False), (8, "", 1, False),
    ]
    got = throttle.failure_burst(calls, 60, 2).where("destination = 'd'").collect()
    assert sorted((r["seq"], r["recent_failures"]) for r in got) == [(1, 1), (2, 2), (3, 2), (3, 2), (4, 1), (5, 1), (6, 1)]


def test_destination_health(events):
    rows, df = events
    calls = df.select(F.coalesce("key", F.lit("none")).alias("destination"), "ts", "seq", (F.col("seq") % 7 != 0).alias("ok"))
    got = {r["destination"]: r for r in agg.destination_health(calls).collect()}
    for key, group in by_key(rows).items():
        run = 0
        for _, seq in group:
            run = run + 1 if seq % 7 else 0
        r = got[key or "none"]
        assert (r["total_requests"], r["consecutive_successes"]) == (len(group), run)


def test_ranks_sums_and_neighbours(events):
    rows, df = events
    groups = by_key(rows)
    rank = {seq: i + 1 for g in groups.values() for i, (_, seq) in enumerate(g)}
    total = {seq: sum(s for _, s in g[: i + 1]) for g in groups.values() for i, (_, seq) in enumerate(g)}
    before = {seq: g[i - 1][1] if i else None for g in groups.values() for i, (_, seq) in enumerate(g)}
    order = [F.col("ts"), F.col("seq")]
    assert {r["seq"]: r["rn"] for r in slicing.ranked(df, order, ["key"]).collect()} == rank
    assert {r["seq"]: r["t"] for r in slicing.running_sum(df, F.col("seq"), order, ["key"], "t").collect()} == total
    assert {r["seq"]: r["p"] for r in slicing.previous(df, "seq", order, ["key"], "p").collect()} == before
    everywhere = {r["seq"]: r["rn"] for r in slicing.ranked(df, order).collect()}
    assert everywhere == {seq: i + 1 for i, (_, _, seq) in enumerate(sorted(rows, key=lambda x: (x[1], x[2])))}


def test_band_order(spark):
    entries = spark.createDataFrame([(9, 0), (12, 1), (5, 2), (0, 3), (2, 4), (4, 5), (-1, 6)], "priority int, seq bigint")
    order = [r["seq"] for r in ordering.band_dequeue_order(entries).orderBy("position").collect()]
    assert order == [3, 4, 5, 6, 2, 1, 0]  # out-of-range values sit in the normal band under their own key


def test_queue_direction(spark):
    entries = spark.createDataFrame([("q", 1, 0), ("q", 9, 1), ("q", 9, 2)], "queue string, priority int, seq bigint")
    down = ordering.dequeue_order(entries, "queue", ascending=False).orderBy("position").collect()
    assert [r["seq"] for r in down] == [1, 2, 0]
    assert ordering.peek_top(entries, "queue", ascending=False).first()["seq"] == 1


def test_six_failures_make_two_dead_letters(spark):
    rows = [("t", 0, 5, "k", '{"a":1}', i, f'e"{i}') for i in range(6)] + [("t", 0, 6, None, "{}", i, None) for i in range(6, 8)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, key string, value string, seq bigint, error string")
    dead = sorted(agg.dlq_candidates(df).collect(), key=lambda r: r["seq"])
    assert [r["seq"] for r in dead] == [2, 5]
    assert dead[0]["value"] == (
        '{"original_topic":"t","original_partition":0,"original_offset":5,"original_value":{"a":1},"error":"e\\"2","retry_count":3}'
    )


# ---- dedup -------------------------------------------------------------------------------------


@pytest.mark.parametrize("expected, fp", [(30, 0.1), (100, 0.01)])
def test_bloom_is_the_sequential_filter(spark, expected, fp):
    rng = random.Random(3)
    keys = ["same" if rng.random() < 0.4 else f"key-{rng.randrange(200)}" for _ in range(400)]
    m, n = bloom_size(expected, fp)
    bits, want = set(), {}
    for seq, key in enumerate(keys):
        digest = hashlib.sha256(key.encode()).digest()
        a, b = int.from_bytes(digest[:16], "big"), int.from_bytes(digest[16:], "big") | 1
        pos = {(a + i * b) % m for i in range(n)}
        want[seq] = pos <= bits
        bits |= pos
    df = spark.createDataFrame(list(enumerate(keys)), "seq bigint, key string")
    out = dedup.bloom_dedup(df, "key", "seq", expected, fp)
    assert {r["seq"]: r["is_duplicate"] for r in out.collect()} == want
    assert sum(want.values()) > len(keys) - len(set(keys))  # some are false positives
    stats = agg.bloom_stats(out, expected, fp).first()
    assert (stats["size_bits"], stats["items_added"], stats["checks"]) == (m, len(keys) - sum(want.values()), 400)


@pytest.mark.parametrize("buckets", [1, 3])
def test_rotation(events, buckets):
    rows, df = events
    want = {}
    for group in by_key(rows).values():
        last = None
        for now, seq in group:
            bucket = int(now // 100)
            want[seq] = last is not None and bucket - last < buckets
            if not want[seq]:
                last = bucket
    got = dedup.rotating_dedup(df, "key", "ts", "seq", 100, buckets).collect()
    assert {r["seq"]: r["is_duplicate"] for r in got} == want


def test_first_seen_with_a_hot_text(spark):
    texts = ["same" if i % 3 else f"t{i % 30}" for i in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "seq bigint, content string")
    got = {r["seq"]: r["is_duplicate"] for r in dedup.dedup_first_seen(df, "seq").collect()}
    assert got == {i: t in texts[:i] for i, t in enumerate(texts)}
    kept = dedup.keep_first_seen(df, F.col("content"), "seq")
    assert {r["seq"] for r in kept.collect()} == {i for i, d in got.items() if not d}


def test_insert_if_absent(spark):
    batch = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c")], "seq int, h string")
    stored = spark.createDataFrame([("b",)], "h string")
    assert sorted(r["seq"] for r in joins.insert_if_absent(batch, stored, ["h"], "seq").collect()) == [1, 4]


# ---- ring, lifecycle, callbacks ----------------------------------------------------------------


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_ring_equals_a_binary_search(spark, partitions):
    number = lambda s: int(hashlib.md5(s.encode()).hexdigest(), 16)
    ring = {number(f"partition-{p}-vnode-{i}"): p for p in range(partitions) for i in range(150)}
    points = sorted(ring)
    keys = [f"source-{i}" for i in range(2000)]
    want = {k: ring[points[bisect.bisect_left(points, number(k)) % len(points)]] for k in keys}
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = joins.hash_ring_partition(df, "k", partitions).collect()
    assert len(got) == len(keys) and {r["k"]: r["ring_partition"] for r in got} == want


def test_illegal_steps(spark):
    log = [("a", s) for s in ("pending", "running", "completed")] + [("b", s) for s in ("running", "pending", "completed")] + [("c", "pending"), ("c", "failed")]
    df = spark.createDataFrame(
        [(j, i, T0 + timedelta(seconds=i), s, 4, "boom") for i, (j, s) in enumerate(log)],
        "job_id string, seq bigint, ts timestamp, status string, documents_synced bigint, error_message string",
    )
    got = {r["job_id"]: r for r in lifecycle.job_lifecycle(df).collect()}
    assert {j: r["illegal_steps"] for j, r in got.items()} == {"a": 0, "b": 3, "c": 0}
    assert (got["a"]["documents_synced"], got["a"]["error_message"]) == (4, None)
    assert (got["c"]["status"], got["c"]["error_message"]) == ("failed", "boom")


def test_null_cursor_keeps_the_stored_one(spark):
    log = spark.createDataFrame(
        [("c", 1, T0, "completed", "x"), ("c", 2, T0, "running", None), ("c", 3, T0, "completed", None)],
        "connector_id string, seq int, ts timestamp, status string, cursor string",
    )
    r = lifecycle.connector_state(log).first()
    assert (r["status"], r["last_sync_cursor"]) == ("active", "x")


def test_purge_keeps_unfinished_and_open_jobs(spark):
    as_of = F.lit(T0)
    old, edge = T0 - timedelta(days=8), T0 - timedelta(days=7)
    jobs = spark.createDataFrame(
        [(1, "completed", old), (2, "failed", edge), (3, "running", old), (4, "completed", None), (5, None, old)],
        "id int, status string, end_time timestamp",
    )
    assert sorted(r["id"] for r in lifecycle.purge_finished_jobs(jobs, as_of).collect()) == [2, 3, 4, 5]


def test_callback_ids(spark):
    known = "00000000-0000-0000-0000-00000000000a"
    rows = [(1, known), (2, "{" + known.upper() + "}"), (3, "urn:uuid:" + known), (4, "nope"), (5, None), (6, known[:-1] + "b")]
    got = joins.callback_check(
        spark.createDataFrame(rows, "n int, connector_id string"), spark.createDataFrame([(known,)], "id string")
    ).collect()
    assert {r["n"]: (r["connector_exists"], r["invalid_id"]) for r in got} == {
        1: (True, False), 2: (True, False), 3: (True, False), 4: (False, True), 5: (False, False), 6: (False, False)
    }
