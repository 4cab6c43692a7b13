"""Message streams with Kafka's row shape.

``kafka`` needs its connector on the cluster; any file format with the same columns reads alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tributary.operators.joins import hash_ring_partition

ROW = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"

# fixed values: topic and key column per event
TOPICS = {"file_ingested": ("file.ingested", "source_id"), "code_normalized": ("code.normalized", "file_path")}


def read_event_stream(
    spark: SparkSession, fmt: str = "kafka", path: str | None = None, servers: str | None = None,
    topics: list[str] | None = None, batch_size: int | None = None,
) -> DataFrame:
    """Messages from the earliest offset with text key and value.

    ``batch_size`` bounds a micro-batch: messages of Kafka, files of other formats. Without it a batch takes what there is.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = (
            reader.option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics or []))
            .option("startingOffsets", "earliest")
        )
        raw = (reader.option("maxOffsetsPerTrigger", batch_size) if batch_size else reader).load()
    else:
        reader = reader.schema(ROW)
        raw = (reader.option("maxFilesPerTrigger", batch_size) if batch_size else reader).load(path)
        if topics:
            raw = raw.where(F.col("topic").isin(topics))
    return raw.select(
        "topic", "partition", "offset", F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"), F.unix_millis("timestamp").alias("timestamp"),
        F.col("timestamp").alias("event_time"),
    )


def event_rows(events: DataFrame, kind: str, envelope, num_partitions: int = 3) -> DataFrame:
    """Rows to publish: key, value, topic and the ring partition of the key."""
    topic, key = TOPICS[kind]
    rows = events.select(F.col(key).cast("string").alias("key"), envelope.alias("value"), F.lit(topic).alias("topic"))
    return hash_ring_partition(rows, "key", num_partitions).withColumnRenamed("ring_partition", "partition")


def write_event_stream(rows: DataFrame, checkpoint: str, fmt: str = "kafka", path: str | None = None, servers: str | None = None) -> DataStreamWriter:
    """Writer for published rows: all replicas acknowledge, retries stay idempotent."""
    out = rows.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "topic", "partition")
    writer = out.writeStream.option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    if fmt == "kafka":
        return (
            writer.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all")
            .option("kafka.enable.idempotence", "true").option("kafka.compression.type", "snappy")
        )
    return writer.format(fmt).option("path", path)
