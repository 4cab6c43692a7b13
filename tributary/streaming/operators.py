"""Streaming forms of the operators. State is per key, expires by watermark and lives in RocksDB."""

from __future__ import annotations

import json
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState

from tributary.operators import changes as ch
from tributary.operators.aggregates import dead_letter_value
from tributary.operators.throttle import Rotation, SlidingWindow
from tributary.session import ship

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> list[dict]:
    """Drive a stream over everything that is there, into Parquet; returns the progress of its last batches."""
    query = (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode(mode).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return [json.loads(p.json) for p in query.recentProgress]


def run_batches(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
        .trigger(availableNow=True).foreachBatch(handle).start()
    )
    query.awaitTermination()


def webhook_log(raw: DataFrame, provider: Column, github: Column, gitlab: Column, body: Column, signature: Column) -> DataFrame:
    """Webhook rows to append: parsed or wrapped body, event type, status pending."""
    from tributary.functions.content import webhook_event_type, webhook_payload

    payload = webhook_payload(body)
    return raw.select(
        F.col("id"), provider.alias("provider"), webhook_event_type(github, gitlab, payload).alias("event_type"),
        payload.alias("payload"), signature.alias("signature"), F.col("received_at"), F.lit("pending").alias("status"),
    )


def stream_dedup(
    stream: DataFrame, key: str, spread: Column | None = None, salts: int = 16, ts: str | None = None, lateness: str | None = None
) -> DataFrame:
    """Drop repeated ids: for ever, or, with an event time ``ts`` and a ``lateness``, repeats up to that much later than the first.

    State of an id is freed when the watermark, ``lateness`` behind the newest time, has passed its first row by as much; rows behind the
    watermark are left out. With ``spread``, a column that varies inside a hot id, repeats are first dropped per salt in
    parallel, so at most ``salts`` rows of an id ever reach its one state.
    """
    if ts is not None:
        stream = stream.withWatermark(ts, lateness)

    def once(rows: DataFrame, keys: list[str]) -> DataFrame:
        return rows.dropDuplicates(keys) if ts is None else rows.dropDuplicatesWithinWatermark(keys)

    if spread is not None:
        stream = once(stream.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts))), [key, "_salt"]).drop("_salt")
    return once(stream, [key])


def stream_failure_burst(stream: DataFrame, window: str = "60 seconds", slide: str = "10 seconds", threshold: int = 5, lateness: str = "60 seconds") -> DataFrame:
    """Failures per destination and sliding window; windows at or above the threshold."""
    failures = stream.where(~F.col("ok")).withWatermark("ts", lateness)
    return (
        failures.groupBy("destination", F.window("ts", window, slide)).agg(F.count(F.lit(1)).alias("failures"))
        .where(F.col("failures") >= threshold)
        .select("destination", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "failures")
    )


#: Groups that keys are dealt to, and rows of one that are put in order together (a key with more in a batch is judged by as many at a time).
SHARDS, TOGETHER = 4096, 1_000_000


def _by_key(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]]:
    """Keys, times and numbers of a shard's rows, ordered, and where each key starts and the last one ends.

    A frame ends where an Arrow batch does, so the frames are joined first.
    """
    held, n = [], 0

    def ordered() -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        rows = held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
        keys, us, seq = rows["key"].to_numpy(object), rows["us"].to_numpy(), rows["seq"].to_numpy()
        code = pd.factorize(keys, use_na_sentinel=False)[0]
        order = np.lexsort((seq, us, code))
        code = code[order]
        return keys[order], us[order], seq[order], [0, *(np.flatnonzero(code[1:] != code[:-1]) + 1).tolist(), len(code)]

    for frame in frames:
        held.append(frame)
        n += len(frame)
        if n >= TOGETHER:
            yield ordered()
            held, n = [], 0
    if n:
        yield ordered()


def _hold(state: GroupState, value: tuple[list, ...], due: int | None) -> None:
    """Keep what is left of a shard and ask for a call once the watermark has passed ``due``, which must lie ahead of it."""
    if value[0]:
        state.update(value)
        if due is not None:
            state.setTimeoutTimestamp(max(due // 1000 + 1, state.getCurrentWatermarkMs() + 1))
    elif state.exists:
        state.remove()


def _allowed(rule: SlidingWindow, held: list[int], us: np.ndarray) -> np.ndarray:
    """Verdicts on ordered rows of a key; its allowed times, in order, grow by those of them."""
    if not held or us[0] >= held[-1]:
        allowed = rule.run(held, us)[1][0]
        held += us[allowed].tolist()
        return allowed
    allowed = np.zeros(len(us), bool)
    for i, now in enumerate(us.tolist()):
        if len(held) - bisect_left(held, now - rule.window) < rule.limit:
            insort(held, now)
            allowed[i] = True
    return allowed


def _throttle(rule: SlidingWindow, expires: bool) -> Callable:
    """The state of a shard is the allowed times of each of its keys, in order, behind each other."""

    def judge(shard: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        times: dict[str | None, list[int]] = {}
        if state.exists:
            keys, ends, flat = state.get
            times = {k: list(flat[at:to]) for k, at, to in zip(keys, [0, *ends[:-1]], ends, strict=True)}
        passed = state.getCurrentWatermarkMs() * 1000 if expires else None
        if not state.hasTimedOut:
            for keys, us, seq, starts in _by_key(frames):
                allowed = np.zeros(len(us), bool)
                for at, to in zip(starts[:-1], starts[1:], strict=True):
                    held = times.setdefault(keys[at], [])
                    allowed[at:to] = _allowed(rule, held, us[at:to])
                    if held:
                        del held[: bisect_left(held, (held[-1] if passed is None else min(passed, held[-1])) - rule.window)]
                yield pd.DataFrame({"key": keys, "us": us, "seq": seq, "allowed": allowed})
        left = {k: held for k, held in times.items() if held and (passed is None or held[-1] + rule.window >= passed)}
        due = min((held[-1] + rule.window for held in left.values()), default=None) if expires else None
        ends = np.cumsum([len(held) for held in left.values()]).tolist()
        _hold(state, (list(left), ends, [t for held in left.values() for t in held]), due)

    return judge


def _rotating(rule: Rotation, expires: bool) -> Callable:
    """The state of a shard is the period in which each of its keys was last added. Of a batch, only a key's first row of each period is held."""

    def judge(shard: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last: dict[str | None, int] = dict(zip(*state.get, strict=True)) if state.exists else {}
        first: dict[str | None, dict[int, tuple[int, int]]] = {}
        if not state.hasTimedOut:
            for keys, us, seq, starts in _by_key(frames):
                period = us // rule.period
                new = np.ones(len(us), bool)
                new[1:] = period[1:] != period[:-1]
                new[starts[:-1]] = True
                for key, p, *row in zip(keys[new].tolist(), period[new].tolist(), us[new].tolist(), seq[new].tolist(), strict=True):
                    of_key = first.setdefault(key, {})
                    of_key[p] = min(of_key.get(p, tuple(row)), tuple(row))
        added = []
        for key, of_key in first.items():
            for p in sorted(of_key):
                if key not in last or p - last[key] >= rule.buckets:
                    last[key] = p
                    added.append((key, *of_key[p]))
        if expires:
            passed = state.getCurrentWatermarkMs() * 1000
            last = {k: p for k, p in last.items() if (p + rule.buckets) * rule.period > passed}
        due = (min(last.values()) + rule.buckets) * rule.period if expires and last else None
        _hold(state, (list(last), list(last.values())), due)
        if added:
            keys, us, seq = zip(*added, strict=True)
            yield pd.DataFrame({"key": keys, "us": us, "seq": seq})

    return judge


class _Attempts(StatefulProcessor):
    """Failures of a message since its last dead letter."""

    def __init__(self, max_retries: int, keep_ms: int | None):
        self.most, self.keep_ms = max_retries, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.failures = handle, handle.getValueState("failures", "n int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self.failures.get()
        n = before = state[0] if state is not None else 0
        for frame in rows:
            frame = frame.sort_values("seq", ignore_index=True)
            failed = ~frame["ok"].to_numpy(bool)
            count = n + np.cumsum(failed)
            n = int(count[-1]) % self.most
            dead = failed & (count % self.most == 0)
            frame["outcome"] = np.where(failed, "dead", "done")
            yield frame[dead | ~failed].drop(columns="ok")
        if n == 0 and before:
            self.failures.clear()
        elif n != before:
            self.failures.update((n,))
        if n and self.keep_ms is not None:
            self.handle.registerTimer(timerValues.getCurrentWatermarkInMs() + self.keep_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # a later failure has set a later timer
        if not [t for t in self.handle.listTimers() if t > expiredTimerInfo.getExpiryTimeInMs()]:
            self.failures.clear()
        return iter(())

    def close(self) -> None:
        pass


def _stateful(rows: DataFrame, keys: list[str], processor: StatefulProcessor, schema: str | T.StructType, expires: bool) -> DataFrame:
    use_rocksdb(rows.sparkSession)
    ship(rows.sparkSession)
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="append", timeMode="EventTime" if expires else "None"
    )


def _folded(rows: DataFrame, judge: Callable, columns: str, state: str, expires: bool) -> DataFrame:
    """``judge`` on shards of keys, so that its calls, Arrow batches and state rows are shared by many keys; keys travel as text."""
    use_rocksdb(rows.sparkSession)
    ship(rows.sparkSession)
    kind = rows.schema["key"].dataType
    binary = isinstance(kind, T.BinaryType)
    text = F.hex("key") if binary else F.col("key").cast("string")
    shards = rows.withColumns({"shard": F.pmod(F.xxhash64(text), F.lit(SHARDS)), "key": text}).groupBy("shard")
    out = shards.applyInPandasWithState(judge, f"key string, {columns}", state, "append", "EventTimeTimeout" if expires else "NoTimeout")
    return out.withColumn("key", F.unhex("key") if binary else F.col("key").cast(kind))


def _timed(stream: DataFrame, key: str, ts: str, seq: str, lateness: str | None) -> DataFrame:
    """(key, us, seq), and the event time where a watermark is wanted."""
    if lateness is not None:
        stream = stream.withWatermark(ts, lateness)
    timed = [F.col(ts).alias("event_time")] if lateness is not None else []
    return stream.select(F.col(key).alias("key"), F.unix_micros(ts).alias("us"), F.col(seq).cast("long").alias("seq"), *timed)


def stream_throttle(
    stream: DataFrame, key: str, ts: str, seq: str, limit: int = 100, window_seconds: float = 60.0, lateness: str | None = None
) -> DataFrame:
    """(key, us, seq, allowed): the sliding-window limit on a stream.

    Rows that come in time order have the batch operator's verdicts. One that comes after later ones is allowed if fewer than ``limit`` allowed
    ones lie from a window before it on, so that no window ever holds more than ``limit``. With ``lateness`` rows further behind the newest are
    left out, and the state of a key is freed once the watermark has passed its window; without it the state stays.
    """
    rows = _timed(stream, key, ts, seq, lateness)
    judge = _throttle(SlidingWindow(limit, window_seconds), lateness is not None)
    return _folded(rows, judge, "us long, seq long, allowed boolean", "keys array<string>, ends array<int>, times array<long>", lateness is not None)


def stream_dedup_expiring(
    stream: DataFrame, key: str, ts: str, seq: str, period_seconds: int, buckets: int = 3, lateness: str | None = None
) -> DataFrame:
    """(key, us, seq) without ids added in the current or one of the last periods; a repeat does not renew the first sight.

    A row of a period before the one its id was last added in never adds. With ``lateness`` an id's state is freed when the watermark
    has passed the last period it counts for, and rows behind the watermark are left out; without it the state stays.
    """
    rows = _timed(stream, key, ts, seq, lateness)
    judge = _rotating(Rotation(period_seconds, buckets), lateness is not None)
    return _folded(rows, judge, "us long, seq long", "keys array<string>, periods array<long>", lateness is not None)


MESSAGE = "topic string, partition int, offset long, key string, value string, error string, seq long"


def stream_consume_dlq(
    stream: DataFrame, ok: Column, error: Column, max_retries: int = 3, ts: str | None = None, lateness: str = "1 hour", keep_seconds: int = 86_400
) -> DataFrame:
    """(outcome, topic, key, value, seq): messages a handler accepts, as ``done``, and dead letters, as ``dead``, as they fall due.

    ``ok`` is the handler as a column: a built-in predicate or a pandas UDF, evaluated once per message and batch. Failures are counted in
    keyed state per (topic, partition, offset); the one that reaches ``max_retries`` leaves as a letter in its own batch, and counting
    starts again. Written with ``run_available``, whose sink keeps a list of the files of each batch, no letter is sent twice
    by a restart or a repeated batch. With an event time ``ts``, a count that rests for ``keep_seconds`` is given up.
    """
    rows = stream if ts is None else stream.withWatermark(ts, lateness)
    shape = [f.split(" ")[0] for f in MESSAGE.split(", ")]
    judged = rows.withColumn("error", error).withColumn("ok", F.coalesce(ok, F.lit(False))).select(
        *[F.col(n).cast(k).alias(n) for n, k in (f.split(" ") for f in MESSAGE.split(", "))], "ok", *([F.col(ts).alias("event_time")] if ts else [])
    )
    processor = _Attempts(max_retries, None if ts is None else keep_seconds * 1000)
    timed = [T.StructField("event_time", T.TimestampType())] if ts else []
    schema = T.StructType([*(judged.schema[n] for n in shape), *timed, T.StructField("outcome", T.StringType())])
    left = _stateful(judged, ["topic", "partition", "offset"], processor, schema, ts is not None)
    dead = F.col("outcome") == "dead"
    letter = dead_letter_value(max_retries)
    return left.select(
        "outcome", F.when(dead, F.concat(F.lit("dlq."), "topic")).otherwise(F.col("topic")).alias("topic"), "key",
        F.when(dead, letter).otherwise(F.col("value")).alias("value"), "seq",
    )


def stream_changes_to_documents(webhooks: DataFrame, items: DataFrame) -> DataFrame:
    """Push payloads to changed files to documents: a stream against a static content table.

    Where both name a ``source_id``, a push only reaches its own source's files.
    """
    changed = ch.changes_github(webhooks).where("change_type <> 'deleted'").drop("commit_no", "position")
    same = changed["item_id"] == items["path"]
    if "source_id" in changed.columns and "source_id" in items.columns:
        return changed.join(items, same & (changed["source_id"] == items["source_id"])).drop(changed["source_id"]).drop("item_id")
    return changed.join(items, same).drop("item_id")
