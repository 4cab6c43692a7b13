"""A change feed over landed pages as a streaming source, with a cursor for each source of it."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tributary.session import ship

SCHEMA = "source_id string, page string, item_id string, change_type string, cursor string, timestamp timestamp"
PREFIX = "source="


@dataclass
class Page(InputPartition):
    source_id: str
    name: str


class ChangeFeedReader(DataSourceStreamReader):
    """Pages ``<path>/source=<id>/<name>`` of JSON lines, read in the order of their names.

    An offset is the name of the last page of each source, so every source goes on from a cursor of its own, whatever the others
    do. Pages are written under another name (with a dot or underscore in front) and renamed when they are whole, and names of one source grow.
    """

    def __init__(self, path: str):
        self.path = path

    def _pages(self, source: str, after: str | None, upto: str | None = None) -> list[str]:
        try:
            names = os.listdir(os.path.join(self.path, PREFIX + source))
        except FileNotFoundError:
            return []
        return sorted(n for n in names if n[:1] not in "._" and (after is None or n > after) and (upto is None or n <= upto))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """The newest page of every source. A batch takes what there is, a page a task, so pages bound what a task holds."""
        out = {}
        for folder in sorted(os.listdir(self.path)) if os.path.isdir(self.path) else []:
            if folder.startswith(PREFIX) and (pages := self._pages(folder[len(PREFIX) :], None)):
                out[folder[len(PREFIX) :]] = pages[-1]
        return out

    def partitions(self, start: dict, end: dict) -> list[Page]:
        return [Page(s, n) for s in sorted(end) for n in self._pages(s, start.get(s), end[s])]

    def read(self, partition: Page) -> Iterator[tuple]:
        with open(os.path.join(self.path, PREFIX + partition.source_id, partition.name), encoding="utf-8") as f:
            for line in f:
                if line.strip():
                    x = json.loads(line)
                    at = datetime.fromisoformat(x["timestamp"])
                    at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
                    yield partition.source_id, partition.name, x["item_id"], x["change_type"], x.get("cursor"), at

    def commit(self, end: dict) -> None:
        """Nothing to release: pages stay, and the checkpoint holds the cursors."""


class ChangeFeed(DataSource):
    """``spark.readStream.format("change_feed").load(dir)``"""

    @classmethod
    def name(cls) -> str:
        return "change_feed"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> ChangeFeedReader:
        return ChangeFeedReader(self.options["path"])


def read_change_feed(spark: SparkSession, path: str) -> DataFrame:
    """The feed as a stream of changes; times without a zone are UTC."""
    ship(spark)
    spark.dataSource.register(ChangeFeed)
    return spark.readStream.format("change_feed").load(path)
