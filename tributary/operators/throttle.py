"""Rate limits, reuse windows, failure bursts and retry schedules."""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators.folds import sequential_fold
from tributary.operators.slicing import running_sum

SECOND = 1_000_000


@dataclass
class SlidingWindow:
    """Allow an event if fewer than ``limit`` allowed ones lie in the trailing window; one exactly that old counts.

    The state is the list of allowed times in the window, ``limit`` at most.
    """

    limit: int = 100
    window_seconds: float = 60.0
    fields: list = field(default_factory=lambda: [
        T.StructField("allowed", T.BooleanType()), T.StructField("retry_after", T.DoubleType())
    ])

    def __post_init__(self) -> None:
        self.window = int(self.window_seconds * SECOND)

    def start(self) -> list[int]:
        return []

    def trim(self, state: list[int], micros: int) -> list[int]:
        return [t for t in state if t >= micros - self.window]

    def forgets(self, earlier: np.ndarray, later: np.ndarray) -> np.ndarray:
        return later - earlier > self.window

    def run(self, state: list[int], micros: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
        """While the window is full, all events up to the one that finds its oldest entry gone are turned away at once."""
        recorded = deque(state)
        allowed, oldest = np.zeros(len(micros), bool), np.zeros(len(micros), np.int64)
        times, at, n = micros.tolist(), 0, len(micros)
        while at < n:
            now = times[at]
            while recorded and recorded[0] < now - self.window:
                recorded.popleft()
            if len(recorded) < self.limit:
                recorded.append(now)
                allowed[at], oldest[at] = True, recorded[0]
                at += 1
            elif not recorded:  # a limit of 0
                oldest[at] = now - self.window
                at += 1
            else:
                to = at + int(np.searchsorted(micros[at:], recorded[0] + self.window, "right"))
                oldest[at:to] = recorded[0]
                at = to
        return list(recorded), [allowed, np.maximum(oldest + self.window - micros, 0) / SECOND]


@dataclass
class TokenBucket:
    """Take ``cost`` tokens if the bucket has them; it refills steadily up to its capacity."""

    capacity: float = 100
    refill_rate: float = 10.0
    cost: float = 1
    fields: list = field(default_factory=lambda: [T.StructField("allowed", T.BooleanType()), T.StructField("tokens", T.DoubleType())])

    def start(self) -> list | None:
        return None

    def trim(self, state: list | None, micros: int) -> list | None:
        # a bucket that is full again cannot be told from a new one
        if state is None or min(self.capacity, self._refilled(state, micros)) >= self.capacity:
            return None
        return state

    def forgets(self, earlier: np.ndarray, later: np.ndarray) -> np.ndarray:
        return (later - earlier) / SECOND * self.refill_rate >= self.capacity

    def _refilled(self, state: list, micros: int) -> float:
        return state[0] + (micros - state[1]) / SECOND * self.refill_rate

    def run(self, state: list | None, micros: np.ndarray) -> tuple[list | None, list[np.ndarray]]:
        allowed, left, most, cost, rate = [], [], float(self.capacity), self.cost, self.refill_rate
        tokens, before = (most, None) if state is None else state
        for now in micros.tolist():
            if before is not None:
                tokens = min(most, tokens + (now - before) / SECOND * rate)
            before, take = now, tokens >= cost
            if take:
                tokens -= cost
            allowed.append(take)
            left.append(tokens)
        return [tokens, before] if left else state, [np.array(allowed, bool), np.array(left, float)]


def _reached(state: int | None, times: np.ndarray, reach: int) -> tuple[int | None, np.ndarray]:
    """Marks the times that lie more than ``reach`` behind the last marked one, from one to the next."""
    marked, at = np.zeros(len(times), bool), 0
    while True:
        if state is not None:
            at += int(np.searchsorted(times[at:], state + reach, "right"))
        if at >= len(times):
            return state, marked
        marked[at], state = True, int(times[at])


@dataclass
class ReuseWindow:
    """Hit if the stored response is at most ``ttl`` old; a hit does not renew it, a miss stores."""

    ttl_seconds: float = 300.0
    fields: list = field(default_factory=lambda: [T.StructField("hit", T.BooleanType())])

    def __post_init__(self) -> None:
        self.ttl = int(self.ttl_seconds * SECOND)

    def start(self) -> int | None:
        return None

    def trim(self, state: int | None, micros: int) -> int | None:
        return state if state is not None and micros - state <= self.ttl else None

    def forgets(self, earlier: np.ndarray, later: np.ndarray) -> np.ndarray:
        return later - earlier > self.ttl

    def run(self, state: int | None, micros: np.ndarray) -> tuple[int | None, list[np.ndarray]]:
        state, missed = _reached(state, micros, self.ttl)
        return state, [~missed]


@dataclass
class Rotation:
    """Duplicate if the key was added in the current or one of the last ``buckets - 1`` periods."""

    period_seconds: int
    buckets: int = 3
    fields: list = field(default_factory=lambda: [T.StructField("is_duplicate", T.BooleanType())])

    def __post_init__(self) -> None:
        self.period = self.period_seconds * SECOND

    def start(self) -> int | None:
        return None

    def trim(self, state: int | None, micros: int) -> int | None:
        return state if state is not None and micros // self.period - state < self.buckets else None

    def forgets(self, earlier: np.ndarray, later: np.ndarray) -> np.ndarray:
        return later // self.period - earlier // self.period >= self.buckets

    def run(self, state: int | None, micros: np.ndarray) -> tuple[int | None, list[np.ndarray]]:
        state, added = _reached(state, micros // self.period, self.buckets - 1)
        return state, [~added]


def throttle_sliding(events: DataFrame, key: str, ts: str, seq: str, limit: int = 100, window_seconds: float = 60.0) -> DataFrame:
    return sequential_fold(events, key, ts, seq, SlidingWindow(limit, window_seconds)).drop("retry_after")


def retry_after(events: DataFrame, key: str, ts: str, seq: str, limit: int = 100, window_seconds: float = 60.0) -> DataFrame:
    """Seconds until the oldest recorded event leaves the window, seen right after each event."""
    return sequential_fold(events, key, ts, seq, SlidingWindow(limit, window_seconds)).drop("allowed")


def throttle_token_bucket(
    events: DataFrame, key: str, ts: str, seq: str, capacity: float = 100, refill_rate: float = 10.0, cost: float = 1
) -> DataFrame:
    return sequential_fold(events, key, ts, seq, TokenBucket(capacity, refill_rate, cost))


def request_reuse(requests: DataFrame, key: str, ts: str, seq: str, ttl_seconds: float = 300.0) -> DataFrame:
    return sequential_fold(requests, key, ts, seq, ReuseWindow(ttl_seconds))


def failure_burst(calls: DataFrame, window_seconds: int = 60, threshold: int = 5, ties_together: bool = False) -> DataFrame:
    """Failures of a destination in the trailing window at every call, and whether they reach the threshold.

    Calls of one time follow each other by ``seq``; with ``ties_together`` they all see each other, as a SQL frame by range has it.
    Calls without a time only see each other, and one without an outcome has not failed.

    Calls that share a place are counted as one row. Each such row contributes itself and a probe at the far end of its window. One
    running total over both gives the failures up to it and those before the window; their difference is the answer of all its calls.
    """
    place = ["_t"] if ties_together else ["_t", "seq"]
    timed = calls.withColumn("_t", F.unix_micros(F.col("ts").cast("timestamp")))
    placed = timed.groupBy("destination", *place).agg(F.count_if(~F.col("ok")).alias("_fail")).withColumn("_of", F.col("_t"))
    probe = placed.withColumns({"_t": F.col("_t") - window_seconds * SECOND, "_fail": F.lit(0).cast("long"), "_kind": F.lit(0)})
    total = running_sum(
        placed.withColumn("_kind", F.lit(1)).unionByName(probe), F.col("_fail"),
        [F.col("_t"), F.col("_kind"), *(F.col(c) for c in place[1:])], ["destination"], "_sum",
    )
    signed = F.when(F.col("_kind") == 1, F.col("_sum")).otherwise(-F.col("_sum"))
    answer = total.groupBy("destination", "_of", *place[1:]).agg(F.sum(signed).alias("recent_failures"))
    named = answer.select(*[F.col(c).alias(f"_a_{c}") for c in ("destination", "_of", *place[1:])], "recent_failures")
    same = timed["destination"].eqNullSafe(named["_a_destination"]) & timed["_t"].eqNullSafe(named["_a__of"])
    for c in place[1:]:
        same = same & timed[c].eqNullSafe(named[f"_a_{c}"])
    return timed.join(named, same).select("seq", "destination", "recent_failures", (F.col("recent_failures") >= threshold).alias("burst"))


def backoff_seconds(attempt: Column, base: float = 1.0, maximum: float = 60.0) -> Column:
    return F.least(F.lit(float(base)) * F.pow(F.lit(2.0), attempt), F.lit(float(maximum)))


def retry_schedule(failed: DataFrame, ts: str, attempt: str, base: float = 1.0, maximum: float = 60.0) -> DataFrame:
    """Earliest and latest time of the next attempt: the capped delay times a jitter in [0.5, 1.0)."""
    delay = backoff_seconds(F.col(attempt), base, maximum)

    def after(seconds: Column) -> Column:
        return F.col(ts) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))

    return failed.withColumns({
        "delay_seconds": delay, "earliest_attempt_at": after(delay * 0.5), "latest_attempt_at": after(delay)
    })
