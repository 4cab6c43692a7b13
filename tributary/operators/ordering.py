"""Queue and document ordering as exact ranks over range slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import tables as t
from tributary.operators.aggregates import priority_band
from tributary.operators.joins import latest_by
from tributary.operators.slicing import ranked


def order_by_size(docs: DataFrame, seq: str, key: Column | None = None, name: str = "position") -> DataFrame:
    """Stable ascending rank by content size, or by any other key."""
    key = F.octet_length("content") if key is None else key
    return ranked(docs.select(seq, key.alias("_size")), [F.col("_size"), F.col(seq)], name=name).withColumnRenamed("_size", "sort_key")


def dequeue_order(entries: DataFrame, queue: str, ascending: bool = True, name: str = "position") -> DataFrame:
    """Rank inside every queue: most urgent first, then arrival."""
    priority = F.asc("priority") if ascending else F.desc("priority")
    return ranked(entries, [priority, F.asc("seq")], [queue], name)


def band_dequeue_order(entries: DataFrame, name: str = "position") -> DataFrame:
    """Bands from critical to low, inside a band by own priority and arrival."""
    band = priority_band(F.col("priority"))
    rank = F.array_position(F.lit(list(t.BANDS)), band)
    return ranked(
        entries.withColumn("band", band).withColumn("_rank", rank), [F.asc("_rank"), F.asc("priority"), F.asc("seq")], name=name
    ).drop("_rank")


def peek_top(entries: DataFrame, queue: str, ascending: bool = True) -> DataFrame:
    """Head of every queue: the greatest of one number made of urgency and arrival, by a combining hash aggregate."""
    urgency = -F.col("priority") if ascending else F.col("priority")
    turned = entries.withColumns({"_urgency": urgency, "_turn": -F.col("seq")})
    return latest_by(turned, [queue], ["_urgency", "_turn"]).drop("_urgency", "_turn")


def recent_sources(connectors: DataFrame) -> DataFrame:
    return connectors.orderBy(F.desc("created_at"), F.desc("id"))
