"""Lands provider pages, files and message files in the shared folder, written by Spark from the views."""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from suite import views as v
from tributary.session import fresh_path

PAGE = 100


def land_pages(rows: DataFrame, entry: Column, wrap: str | None, page: Column) -> str:
    """JSON pages of at most PAGE entries, one per line; ``wrap`` names the array, None leaves a bare array."""
    path = fresh_path(rows.sparkSession, "pages")
    pages = rows.groupBy(page.alias("_page")).agg(F.collect_list(entry).alias("_e"))
    body = F.to_json("_e") if wrap is None else F.to_json(F.struct(F.col("_e").alias(wrap)))
    pages.select(body.alias("value")).write.text(path)
    return path


def page_of(column: str = "id") -> Column:
    """Ids are dense, so this puts at most PAGE entries on a page."""
    return v.div(column, PAGE)


def land_files(files: DataFrame) -> str:
    """Files below a posix path of the shared folder, written by the tasks that hold them."""
    where = urlparse(fresh_path(files.sparkSession, "files"))
    if where.scheme not in ("", "file"):
        raise RuntimeError(f"local files need a shared folder that executors mount, not {where.scheme}://")
    base = where.path

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                target = os.path.join(base, path)
                os.makedirs(os.path.dirname(target), exist_ok=True)
                with open(target, "w", encoding="utf-8", newline="") as f:
                    f.write(content)
            yield pd.DataFrame({"n": [len(pdf)]})

    files.select("path", "content").mapInPandas(write, "n bigint").agg(F.sum("n")).collect()
    return base


def land_messages(messages: DataFrame) -> str:
    """Messages with Kafka's row shape as Parquet files."""
    path = fresh_path(messages.sparkSession, "messages")
    messages.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "topic",
        F.col("partition").cast("int").alias("partition"), "offset", F.col("ts").cast("timestamp").alias("timestamp"),
    ).write.parquet(path)
    return path


def land(df: DataFrame, label: str) -> str:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return path


def stream_of(df: DataFrame, label: str) -> DataFrame:
    """The rows as a file stream."""
    path = land(df, label)
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


def feed_of(df: DataFrame, ts: str, label: str, late: Column | None = None, batches: int = 3, files: int = 2) -> DataFrame:
    """The rows as a stream of several micro-batches in the order of their times; those marked ``late`` come once more a batch later."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    rows = df.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
    cuts = rows.approxQuantile("_us", [k / batches for k in range(1, batches)], 0.01)
    rows = rows.withColumn("_batch", sum((F.when(F.col("_us") > c, 1).otherwise(0) for c in cuts), F.lit(0)))
    for k in range(batches):
        part = rows.where(F.col("_batch") == k)
        if late is not None and k:
            part = part.unionByName(rows.where((F.col("_batch") == k - 1) & late))
        part.drop("_us", "_batch").repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def land_change_pages(changes: DataFrame, parts: tuple[int, ...], path: str | None = None) -> str:
    """Some of four pages of each source's changes, in the order of their times, as JSON lines below a posix folder."""
    where = urlparse(path or fresh_path(changes.sparkSession, "pages"))
    base = where.path
    rows = changes.select(
        "source_id", "item_id", "change_type", "cursor", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
    )
    rows = rows.withColumn("page", F.ntile(4).over(Window.partitionBy("source_id").orderBy("timestamp", "item_id")) - 1).where(F.col("page").isin(list(parts)))

    def write(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        folder = os.path.join(base, f"source={key[0]}")
        os.makedirs(folder, exist_ok=True)
        draft = os.path.join(folder, f".draft-{key[1]}")
        pdf[["item_id", "change_type", "cursor", "timestamp"]].to_json(draft, orient="records", lines=True)
        os.replace(draft, os.path.join(folder, f"page-{key[1]:06d}"))
        return pd.DataFrame({"n": [len(pdf)]})

    rows.groupBy("source_id", "page").applyInPandas(write, "n long").agg(F.sum("n")).collect()
    return base
