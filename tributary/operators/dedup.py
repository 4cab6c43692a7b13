"""Exact, Bloom-filter and time-expiring duplicates.

Whatever decides who comes first is a combining aggregate; verdicts travel back on the unique
sequence number. A content shared by a third of all rows is therefore never gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import content as k
from tributary.operators.folds import sequential_fold
from tributary.operators.throttle import Rotation
from tributary.session import materialize


def _flag(df: DataFrame, firsts: DataFrame, seq: str) -> DataFrame:
    """Everything is a duplicate except the listed sequence numbers."""
    marks = firsts.select(F.col(seq).alias("_first"))
    return df.join(marks, F.col(seq) == F.col("_first"), "left").withColumn(
        "is_duplicate", F.col("_first").isNull()
    ).drop("_first")


def first_seen(df: DataFrame, key: Column, seq: str) -> DataFrame:
    """Sequence number of the first row per key."""
    return df.groupBy(key.alias("_key")).agg(F.min(seq).alias(seq)).select(seq)


def dedup_first_seen(docs: DataFrame, seq: str) -> DataFrame:
    """Hash of every document and whether it was seen earlier: (seq, content_hash, is_duplicate).

    The hashes are written once, so the contents are read a single time.
    """
    hashed = materialize(docs.select(seq, k.content_hash(F.col("content")).alias("content_hash")), "hashes")
    return _flag(hashed, first_seen(hashed, F.col("content_hash"), seq), seq)


def keep_first_seen(docs: DataFrame, key: Column, seq: str) -> DataFrame:
    """Only the first document per key, bodies moved once and only by ``seq``."""
    return docs.join(first_seen(docs, key, seq), seq, "left_semi")


def bloom_dedup(items: DataFrame, key: str, seq: str, expected_items: int = 100_000, false_positive_rate: float = 0.01) -> DataFrame:
    """What one pass of check-and-add over a Bloom filter answers, false positives included.

    An item is new iff it is the first to set at least one of its bits. So the first sequence number
    per bit position, one combining aggregate over at most ``bits`` groups, names all new items.
    """
    bits, hashes = k.bloom_size(expected_items, false_positive_rate)
    set_bits = k.bloom_positions(items.select(seq, key), F.col(key).cast("string"), bits, hashes, "_bit")
    new = set_bits.groupBy("_bit").agg(F.min(seq).alias(seq)).select(seq).distinct()
    return _flag(items, new, seq)


def rotating_dedup(items: DataFrame, key: str, ts: str, seq: str, period_seconds: int, buckets: int = 3) -> DataFrame:
    """Duplicate if the key was added in the current or one of the last ``buckets - 1`` periods.

    Only the first row of a period can be an addition, so rows shrink to one per key and period before they are folded: a key with a
    third of all rows is as many rows as it has periods.
    """
    length = period_seconds * 1_000_000
    bucket = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / length)
    firsts = items.groupBy(F.col(key).alias("_key"), bucket.alias("_bucket")).agg(
        F.min(F.struct(F.col(ts), F.col(seq).alias("seq"))).alias("_row")
    ).select("_key", F.timestamp_micros(F.col("_bucket") * length).alias("_ts"), F.col("_row.seq").alias("_seq"))
    added = sequential_fold(firsts, "_key", "_ts", "_seq", Rotation(period_seconds, buckets)).where("not is_duplicate")
    return _flag(items, added.select(F.col("_seq").alias(seq)), seq)
