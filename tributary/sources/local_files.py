"""Listing of a directory tree.

Spark's own file sources silently drop names that start with ``_``; a content listing must keep them. ``scan_local_files`` expands the
tree from the top in tasks, whatever its shape and depth, and reads contents in evenly filled parts. ``local_files`` is the same listing as a
data source, with filters pushed into its reader.
"""

from __future__ import annotations

import json
import os
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, Not, StringContains, StringEndsWith, StringStartsWith,
)

from tributary.functions import classify
from tributary.session import as_one, materialize, ship
from tributary.sources.listings import SyncOptions

SCHEMA = "id string, name string, path string, extension string, size bigint, mtime_us bigint, content binary"
#: Names of files that one part of the data source reads, or rows of a batch of a listing, and files of a batch whose contents are read together.
NAMES, CONTENTS = 2000, 64
#: Entries that a task lists below a directory it was given; what lies further below goes to the next round.
NEAR = 1000
LISTED = pa.schema({"directory": pa.string(), "name": pa.string(), "size": pa.int64(), "mtime_us": pa.int64(), "above": pa.list_(pa.string())})


def extension_of(name: str) -> str:
    """Lower-case text behind the last dot of a file name, unless that is all there is before it."""
    head, dot, tail = name.rpartition(".")
    return tail.lower() if dot and head else ""


def _entry(directory: str, name: str) -> tuple[int, int | None]:
    try:
        stat = os.stat(os.path.join(directory, name))
        return stat.st_size, stat.st_mtime_ns // 1000
    except OSError:
        return 0, None


def _content(path: str) -> bytes:
    try:
        with open(path, "rb") as f:
            return f.read()
    except OSError:
        return b""


def _entries(directory: str, most: int | None) -> list[os.DirEntry]:
    try:
        with os.scandir(directory) as entries:
            return [*islice(entries, most)]
    except OSError:
        return []


def _yes(ask: Callable[[], bool]) -> bool:
    try:
        return ask()
    except OSError:  # such as a link to itself
        return False


def _within(path: str, top: str) -> bool:
    return path == top or path.startswith(os.path.join(top, ""))


def _leads_back(real: str, way: list[str]) -> bool:
    """Whether a directory is one of those on the way to it.

    A way is given as real paths, the first and the last of each run of directories without a link. Unlike device and inode numbers
    they are the same on every executor, and their number grows with the links on the way only.
    """
    return any(_within(real, first) and _within(last, real) for first, last in zip(way[::2], way[1::2], strict=True))


def _near(given: str, above: list[str]) -> Iterator[tuple]:
    """Rows of LISTED: the files in a directory and near below it, and, without a name, the directories to look into next.

    The directory itself is listed whatever its size, those below it up to NEAR entries together. So a deep tree takes few rounds, and a
    large directory still is a row of its own.
    """
    ahead, left = deque([(given, above or [os.path.realpath(given)] * 2)]), None
    while ahead and left != 0:
        directory, way = ahead.popleft()
        entries = _entries(directory, left)
        if left is None:
            left = NEAR
        elif len(entries) < left:
            left -= len(entries) + 1
        else:  # there may be more
            ahead.appendleft((directory, way))
            break
        for e in entries:
            if e.name.startswith("."):
                continue
            if not _yes(e.is_dir):
                yield directory, e.name, *_entry(directory, e.name), None
                continue
            whole, link = f"{directory}/{e.name}", _yes(e.is_symlink)
            real = os.path.realpath(whole) if link else os.path.join(way[-1], e.name)
            if not _leads_back(real, way):
                ahead.append((whole, [*way, real, real] if link else [*way[:-1], real]))
    for directory, way in ahead:
        yield directory, None, None, None, way


def _listed(directories: DataFrame) -> DataFrame:
    """What lies in some directories and near below them: files with size and time, and the directories to look into next."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (
            row for batch in batches
            for given, above in zip(batch.column("directory").to_pylist(), batch.column("above").to_pylist(), strict=True) for row in _near(given, above)
        )
        while some := [*islice(found, NAMES)]:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), LISTED, strict=True)], schema=LISTED)

    return directories.mapInArrow(look, "directory string, name string, size long, mtime_us long, above array<string>")


def walk_tree(spark: SparkSession, base: str) -> DataFrame:
    """(directory, name, size, mtime_us) of every visible file below ``base``, followed through links, however deep it lies.

    A round lists the directories that the one before has found, and what lies near below them, in tasks; the driver looks at none of them.
    Each round is written once, and all are read as one table.
    """
    ship(spark)
    # one row; the tasks see a folder that is not there as an empty one, so it is refused here
    if not os.path.isdir(base):
        raise FileNotFoundError(f"no such directory: {base}")
    level, rounds = spark.createDataFrame([(base, [])], "directory string, above array<string>"), []
    while True:
        listed = materialize(_listed(level), "listing")
        rounds.append(listed)
        below = listed.where("name is null")
        if below.isEmpty():
            return as_one(rounds).where("name is not null").select("directory", "name", "size", "mtime_us")
        # by no key: the directories of one parent are spread over all tasks
        level = below.select("directory", "above").repartition(spark.sparkContext.defaultParallelism)


def with_content(files: DataFrame, path: Column) -> DataFrame:
    """``files`` with the bytes at ``path``, read in parts of even numbers of files; one that can't be read is empty."""
    ship(files.sparkSession)
    rows = files.withColumn("_path", path).repartition(max(files.sparkSession.sparkContext.defaultParallelism, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CONTENTS):
                some = batch.slice(at, CONTENTS)
                bodies = pa.array([_content(p) for p in some.column("_path").to_pylist()], pa.binary())
                yield some.drop_columns(["_path"]).append_column("content", bodies)

    return rows.mapInArrow(read, files.schema.add("content", "binary"))


def scan_local_files(spark: SparkSession, base: str, content: bool = False, options: SyncOptions = SyncOptions()) -> DataFrame:
    """One row per visible, non-binary file below ``base`` that the include and exclude options keep; contents only of these."""
    base = base.rstrip("/") or "/"
    files = walk_tree(spark, base)
    whole = F.concat_ws("/", "directory", "name")
    relative = F.substr(whole, F.lit(len(base) + 2 - (base == "/")))
    files = files.withColumns({"path": relative, "id": whole})
    kept = files.where(
        classify.not_binary_repo(classify.local_extension(F.col("name")))
        & classify.sync_filter_repo(F.col("path"), F.col("size"), options.include, options.exclude, options.max_mb)
    )
    if content:
        kept = with_content(kept, F.col("id"))
    return kept.select(
        "id", "name", "path", F.lit("file").alias("item_type"), "size",
        F.create_map(
            F.lit("base_path"), F.lit(base), F.lit("relative_path"), F.col("path"), F.lit("absolute_path"), F.col("id")
        ).alias("metadata"),
        F.timestamp_micros("mtime_us").alias("updated_at"),
        *(["content"] if content else []),
    )


@dataclass
class Part(InputPartition):
    """Some files of the root directory by name, or a directory of it with everything below."""

    directory: str
    names: list[str] | None = None


def _holds(rule: Filter, row: dict) -> bool:
    if isinstance(rule, Not):
        return not _holds(rule.child, row)
    value = row[rule.attribute[0]]
    if isinstance(rule, In):
        return value in rule.value
    if isinstance(rule, StringContains):
        return rule.value in value
    if isinstance(rule, StringStartsWith):
        return value.startswith(rule.value)
    if isinstance(rule, StringEndsWith):
        return value.endswith(rule.value)
    return value == rule.value


class LocalFilesReader(DataSourceReader):
    """Reads names first; files that an option or a pushed filter on name, path or extension leaves out are neither measured nor opened."""

    def __init__(self, base: str, content: bool, include: list[str], exclude: list[str]):
        self.base, self.content = base, content
        self.include, self.exclude = {x.lower().lstrip(".") for x in include}, exclude
        self.rules: list[Filter] = []

    def partitions(self) -> list[Part]:
        """The driver lists the root alone: its files go out by name, so that no part lists them again."""
        with os.scandir(self.base) as entries:
            shown = [(e.name, e.is_dir()) for e in entries if not e.name.startswith(".")]
        names = sorted(n for n, folder in shown if not folder)
        flat = [Part(self.base, names[k : k + NAMES]) for k in range(0, len(names), NAMES)]
        return [*flat, *(Part(os.path.join(self.base, n)) for n, folder in sorted(shown) if folder)] or [Part(self.base, [])]

    def _wanted(self, row: dict) -> bool:
        if self.include and row["extension"] not in self.include:
            return False
        return not any(x in row["path"] for x in self.exclude) and all(_holds(r, row) for r in self.rules)

    def _walk(self, part: Part) -> Iterator[tuple[str, str]]:
        if part.names is not None:
            yield from ((part.directory, n) for n in part.names)
            return
        seen: set[str] = set()
        for directory, dirs, files in os.walk(part.directory, followlinks=True):
            real = os.path.realpath(directory)
            dirs[:] = [] if real in seen else [d for d in dirs if not d.startswith(".")]
            if real not in seen:
                yield from ((directory, n) for n in files if not n.startswith("."))
            seen.add(real)

    def read(self, part: Part) -> Iterator[tuple]:
        for directory, name in self._walk(part):
            whole = os.path.join(directory, name)
            row = {"name": name, "path": os.path.relpath(whole, self.base), "extension": extension_of(name)}
            if self._wanted(row):
                size, mtime = _entry(directory, name)
                yield os.path.abspath(whole), name, row["path"], row["extension"], size, mtime, _content(whole) if self.content else None


class PushedLocalFilesReader(LocalFilesReader):
    """The same with filters; Spark takes such a reader only where pushing is switched on."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes filters on the text columns and leaves the others to Spark."""
        for rule in filters:
            inner = rule.child if isinstance(rule, Not) else rule
            plain = isinstance(inner, (EqualTo, In, StringContains, StringStartsWith, StringEndsWith))
            if plain and inner.attribute in (("name",), ("path",), ("extension",)):
                self.rules.append(rule)
            else:
                yield rule


class LocalFiles(DataSource):
    """``spark.read.format("local_files").load(dir)``; option ``content`` adds the bytes, ``include`` and ``exclude`` are JSON lists.

    With option ``pushdown``, which needs ``spark.sql.python.filterPushdown.enabled``, filters on name, path and extension reach the reader.
    """

    @classmethod
    def name(cls) -> str:
        return "local_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LocalFilesReader:
        o = self.options
        kind = PushedLocalFilesReader if o.get("pushdown", "false") == "true" else LocalFilesReader
        return kind(o["path"], o.get("content", "false") == "true", json.loads(o.get("include", "[]")), json.loads(o.get("exclude", "[]")))
