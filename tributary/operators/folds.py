"""Sequential per-key folds (rate limits, reuse windows) on range slices, in a number of jobs that doesn't depend on the data.

Every slice is folded in parallel as if its first key started there. That is right but for the head of a slice: the rows of a key that
goes on from the slice before, up to the first gap after which the rule can't remember anything. Heads that follow each other without
such a gap make a busy run, and all busy runs are folded once more, each in one pass over its rows in order, from the state the slice
before the run ends with. A task holds a batch of rows and one state, whatever the length of a run.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.session import by_range, materialize, ship

NO_KEY = "\u0000"  # stands for a null key inside the fold, so that its rows stay one group


class Fold(Protocol):
    """A small sequential rule. State must be JSON-serialisable."""

    fields: list[T.StructField]

    def start(self) -> Any: ...

    def run(self, state: Any, micros: np.ndarray) -> tuple[Any, list[np.ndarray]]:
        """The state after some rows in order, and a column for each field."""
        ...

    def trim(self, state: Any, micros: int) -> Any:
        """The part of a state that still matters at a given time."""
        ...

    def forgets(self, earlier: np.ndarray, later: np.ndarray) -> np.ndarray:
        """Whether nothing up to a row at ``earlier`` can matter at ``later``, the time of the next one."""
        ...


def _parts(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive rows with one key."""
    ends = [*(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else []
    yield from zip([0, *ends[:-1]], ends, strict=True)


def _columns(fold: Fold, parts: list[list[np.ndarray]]) -> list[pa.Array]:
    kinds = {"boolean": pa.bool_(), "double": pa.float64()}
    return [pa.array(np.concatenate([p[i] for p in parts]), kinds[f.dataType.simpleString()]) for i, f in enumerate(fold.fields)]


def _fold_slices(fold: Fold):
    """Rows of a slice with the fold's columns and whether they are in its head; one more row says how the slice ends."""
    names = ["_key", "_us", "_seq"]

    def fold_slice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, key, last, state, head = TaskContext.get().partitionId(), None, None, None, None, True
        schema = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, us = batch.column("_key").to_numpy(zero_copy_only=False), batch.column("_us").to_numpy()
            found, heads = [], np.zeros(len(us), bool)
            for at, to in _parts(keys):
                if first is None:
                    first, key, state = (keys[at], int(us[at])), keys[at], fold.start()
                elif keys[at] != key:
                    key, state, last, head = keys[at], fold.start(), None, False
                now = us[at:to]
                if head:
                    before = np.concatenate([now[:1] if last is None else [last], now[:-1]])
                    forgot = np.flatnonzero(fold.forgets(before, now))
                    heads[at : at + (forgot[0] if len(forgot) else len(now))] = True
                    head = not len(forgot)
                state, columns = fold.run(state, now)
                found.append(columns)
                last = int(now[-1])
            rows = [*(batch.column(n) for n in names), pa.array(np.full(len(us), part)), *_columns(fold, found), pa.array(heads), pa.nulls(len(us), pa.string())]
            out = pa.RecordBatch.from_arrays(rows, names=[*names, "_slice", *(f.name for f in fold.fields), "_head", "_end"])
            schema = out.schema
            yield out
        if first is not None:
            end = json.dumps({"first": first, "key": key, "last": last, "state": state, "whole": head})
            values = {"_slice": part, "_end": end}
            yield pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)

    return fold_slice


def _fold_runs(fold: Fold, arriving: dict[int, Any]):
    """Busy runs, one behind the other, each from the state it arrives with."""
    names = ["_key", "_us", "_seq"]

    def fold_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, state = None, None
        for batch in batches:
            runs, us = batch.column("_run").to_numpy(), batch.column("_us").to_numpy()
            found = []
            for at, to in _parts(runs):
                if runs[at] != run:
                    run = int(runs[at])
                    state = arriving[run]
                state, columns = fold.run(state, us[at:to])
                found.append(columns)
            if found:
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *_columns(fold, found)], names=[*names, *(f.name for f in fold.fields)])

    return fold_run


def _busy_runs(fold: Fold, ends: list[dict]) -> tuple[dict[int, int], dict[int, Any]]:
    """The run each wrong head belongs to, by slice, and the state each run arrives with.

    A run is named by its first slice. While a head fills its slice, the state it really ends with isn't known, so the next one
    belongs to the run as well, unless the time between them settles it.
    """
    run_of: dict[int, int] = {}
    arriving: dict[int, Any] = {}
    run = None
    for before, now in zip(ends, ends[1:], strict=False):
        key, us = now["first"]
        goes_on = key == before["key"] and not fold.forgets(np.array([before["last"]]), np.array([us]))[0]
        if not (goes_on and before["whole"]):
            run = None
        if goes_on and run is None:
            state = fold.trim(before["state"], us)
            if state != fold.trim(fold.start(), us):
                run = now["slice"]
                arriving[run] = state
        if run is not None:
            run_of[now["slice"]] = run
    return run_of, arriving


def sequential_fold(df: DataFrame, key: str, ts: str, seq: str, fold: Fold) -> DataFrame:
    """Add the fold's columns to every row of (key, ts, seq); ``seq`` is unique, ``ts`` a timestamp.

    Three steps at most: the slices, a row for each of them to the driver, the busy runs. Rows without a time have no place in the order
    and are left out; so an empty table gives an empty one.
    """
    spark = df.sparkSession
    ship(spark)
    names = [f.name for f in fold.fields]
    # the key travels as text, so that a null one has a value too
    rows = df.select(
        F.coalesce(F.col(key).cast("string"), F.lit(NO_KEY)).alias("_key"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"), F.col(seq).alias("_seq"),
    ).where("_us is not null")
    kept = rows.schema.fields
    schema = T.StructType([
        *(T.StructField(f.name, f.dataType) for f in kept), T.StructField("_slice", T.LongType()), *fold.fields,
        T.StructField("_head", T.BooleanType()), T.StructField("_end", T.StringType()),
    ])
    laid = by_range(rows, [F.col("_key"), F.col("_us"), F.col("_seq")])
    base = materialize(laid.mapInArrow(_fold_slices(fold), schema), "fold")
    ends = [json.loads(r["_end"]) | {"slice": r["_slice"]} for r in base.where("_end is not null").select("_slice", "_end").collect()]
    run_of, arriving = _busy_runs(fold, sorted(ends, key=lambda x: x["slice"]))
    out = base.where("_end is null")
    if run_of:
        # a row for each slice at most
        runs = F.broadcast(spark.createDataFrame(list(run_of.items()), "_slice long, _run long"))
        marked = out.join(runs, "_slice", "left").withColumn("_again", F.col("_run").isNotNull() & F.col("_head"))
        again = marked.where("_again").select("_run", "_key", "_us", "_seq").repartition("_run").sortWithinPartitions("_run", "_us", "_seq")
        done = again.mapInArrow(_fold_runs(fold, arriving), T.StructType([*schema.fields[:3], *fold.fields]))
        out = marked.where("not _again").select("_key", "_us", "_seq", *names).unionByName(done)
    return out.select(
        F.nullif("_key", F.lit(NO_KEY)).cast(df.schema[key].dataType).alias(key), F.timestamp_micros("_us").cast(df.schema[ts].dataType).alias(ts),
        F.col("_seq").alias(seq), *names,
    )
