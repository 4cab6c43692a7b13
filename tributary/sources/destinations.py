"""Destinations that messages are sent to, each in two steps: tasks write parts, one rename makes them all visible."""

from __future__ import annotations

import base64
import json
import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

PARTS, LISTS = "parts", "lists"


@dataclass
class Written(WriterCommitMessage):
    part: str
    rows: int


def _plain(value):
    return base64.b64encode(bytes(value)).decode() if isinstance(value, (bytes, bytearray)) else value


class _Parts:
    """Parts of JSON lines in a folder that every task can reach. Only parts that a list names count."""

    def __init__(self, path: str):
        self.path = path

    def write_part(self, rows: Iterator) -> Written:
        folder = os.path.join(self.path, PARTS)
        os.makedirs(folder, exist_ok=True)
        name, n = f"{uuid.uuid4().hex}.json", 0
        draft = os.path.join(folder, "." + name)
        with open(draft, "w", encoding="utf-8") as f:
            for row in rows:
                f.write(json.dumps({k: _plain(v) for k, v in row.asDict().items()}, default=str) + "\n")
                n += 1
        os.replace(draft, os.path.join(folder, name))
        return Written(name, n)

    def publish(self, messages: list[Written | None], label: str) -> None:
        """The list of a label once; a second one, of a repeated batch, is dropped with its parts."""
        folder = os.path.join(self.path, LISTS)
        os.makedirs(folder, exist_ok=True)
        target = os.path.join(folder, f"{label}.json")
        if os.path.exists(target):
            self.discard(messages)
            return
        draft = os.path.join(folder, f".{uuid.uuid4().hex}")
        with open(draft, "w", encoding="utf-8") as f:
            json.dump({"parts": [m.part for m in messages if m], "rows": sum(m.rows for m in messages if m)}, f)
        os.replace(draft, target)

    def discard(self, messages: list[Written | None]) -> None:
        for m in messages:
            if m is not None:
                try:
                    os.remove(os.path.join(self.path, PARTS, m.part))
                except FileNotFoundError:
                    pass


class DestinationWriter(DataSourceWriter, _Parts):
    def __init__(self, path: str, label: str):
        super().__init__(path)
        self.label = label

    def write(self, iterator: Iterator) -> Written:
        return self.write_part(iterator)

    def commit(self, messages: list[Written | None]) -> None:
        self.publish(messages, self.label)

    def abort(self, messages: list[Written | None]) -> None:
        self.discard(messages)


class DestinationStreamWriter(DataSourceStreamWriter, _Parts):
    def write(self, iterator: Iterator) -> Written:
        return self.write_part(iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self.publish(messages, f"batch-{batchId:09d}")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self.discard(messages)


class Destination(DataSource):
    """``df.write.format("destination").option("label", run).mode("append").save(dir)``, and the same on streams, a list for each batch.

    A run or batch that is repeated under its label adds nothing. Parts of failed tasks are named by no list, so no reader sees them.
    """

    @classmethod
    def name(cls) -> str:
        return "destination"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> DestinationWriter:
        return DestinationWriter(self.options["path"], self.options.get("label") or uuid.uuid4().hex)

    def streamWriter(self, schema, overwrite: bool) -> DestinationStreamWriter:
        return DestinationStreamWriter(self.options["path"])


def read_destination(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What has been committed to a destination."""
    folder = os.path.join(path, LISTS)
    parts = []
    for name in sorted(os.listdir(folder)) if os.path.isdir(folder) else []:
        if not name.startswith("."):
            with open(os.path.join(folder, name), encoding="utf-8") as f:
                parts += json.load(f)["parts"]
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json([os.path.join(path, PARTS, p) for p in parts])


def send_to_all(rows: DataFrame, sends: dict[str, Callable[[DataFrame], None]]) -> DataFrame:
    """(destination, sent, error): ``rows`` given to each destination; one that fails stops none of the others."""
    out = []
    for name, send in sends.items():
        try:
            send(rows)
            out.append((name, True, None))
        except Exception as failure:  # whatever a destination raises is its own result
            out.append((name, False, str(failure).splitlines()[0][:500]))
    return rows.sparkSession.createDataFrame(out, "destination string, sent boolean, error string")
