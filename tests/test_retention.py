"""Deleting folders and swapping versions: what goes, what stays, and what a failure leaves."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tributary.operators import lifecycle
from tributary.sources import tables
from tributary.sources.retention import VersionedTable, expire_bodies, partitions_of, retire_tenant_folders

NOW = datetime(2024, 2, 1, 12)
KEYS = ("tenant_id", "purge_date")


def files_below(path):
    return {os.path.relpath(os.path.join(d, n), path) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def bodies(spark, path, tenants=("a", "b c/d", None)):
    """Bodies due three days ago, on this day before and after noon, and tomorrow."""
    due = [NOW - timedelta(days=3), NOW - timedelta(hours=1), NOW, NOW + timedelta(seconds=1), NOW + timedelta(days=1)]
    rows = [(f"{t}{i}", t, "text", at - timedelta(days=7)) for t in tenants for i, at in enumerate(due)]
    tables.write_chunk_bodies(spark.createDataFrame(rows, "id string, tenant_id string, content string, created_at timestamp_ntz"), path, partition_by=KEYS)
    return rows


def test_expiry_drops_folders_and_rewrites_the_day(spark, tmp_path):
    path = str(tmp_path / "bodies")
    rows = bodies(spark, path)
    before = files_below(path)
    counts = expire_bodies(spark, path, NOW, list(KEYS))
    after = files_below(path)
    assert counts == {"folders_dropped": 3, "rows_rewritten": 3}
    left = {r["id"] for r in spark.read.parquet(path).collect()}
    assert left == {i for i, _, _, made in rows if made + timedelta(days=7) > NOW}
    assert {f for f in before if "2024-02-02" in f} == {f for f in after if "2024-02-02" in f} and not [f for f in after if "2024-01-29" in f]
    again = files_below(path)
    assert expire_bodies(spark, path, NOW, list(KEYS)) == {"folders_dropped": 0, "rows_rewritten": 0} and files_below(path) == again


def test_expiry_by_month(spark, tmp_path):
    path = str(tmp_path / "bodies")
    due = [NOW - timedelta(days=40), NOW - timedelta(days=1), NOW - timedelta(seconds=1), NOW + timedelta(days=20), NOW + timedelta(days=40)]
    rows = spark.createDataFrame([(k, at - timedelta(days=7)) for k, at in enumerate(due)], "id int, created_at timestamp_ntz")
    tables.write_chunk_bodies(rows, path, period="month")
    before = files_below(path)
    assert expire_bodies(spark, path, NOW, period="month") == {"folders_dropped": 2, "rows_rewritten": 1}
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [3, 4]
    assert {f for f in before if "2024-03" in f} == {f for f in files_below(path) if "2024-03" in f}


def test_bodies_without_a_purge_time_stay(spark, tmp_path):
    path = str(tmp_path / "bodies")
    tables.write_chunk_bodies(spark.createDataFrame([("x", NOW)], "id string, created_at timestamp_ntz"), path, mode="postgres")
    assert expire_bodies(spark, path, NOW + timedelta(days=900)) == {"folders_dropped": 0, "rows_rewritten": 0}
    assert spark.read.parquet(path).count() == 1


def test_a_retired_tenant_leaves_other_files_alone(spark, tmp_path):
    stored, chunks = str(tmp_path / "bodies"), str(tmp_path / "chunks")
    bodies(spark, stored)
    rows = spark.createDataFrame([(str(k), "b c/d" if k % 3 else "a") for k in range(9)], "id string, tenant_id string")
    tables.write_state(rows, "chunks", chunks)
    before = files_below(tmp_path)
    named = {"chunks": (tables.read_state(spark, "chunks", chunks), chunks, ["tenant_id"]), "bodies": (spark.read.parquet(stored), stored, ["tenant_id"])}
    got = {r["store"]: r["n"] for r in retire_tenant_folders(spark, "b c/d", named).collect()}
    assert got == {"chunks": 6, "bodies": 5}
    gone = before - files_below(tmp_path)
    assert gone and all("tenant_id=b c%2Fd" in f for f in gone) and not files_below(tmp_path) - before
    assert tables.read_state(spark, "chunks", chunks).count() == 3 and spark.read.parquet(stored).count() == 10
    assert {v["tenant_id"] for _, v in partitions_of(spark, stored, ["tenant_id"])} == {"a", None}


def test_many_rows_for_few_tenants_are_written_in_place(spark, tmp_path):
    """Each of four tasks leaves its part in each folder, so nothing is shuffled; few rows or many tenants are brought together."""
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    rows = spark.range(0, 1_200_000, 1, 4).select(F.col("id").cast("string").alias("id"), (F.col("id") % 3).alias("tenant_id"), F.lit(NOW).alias("created_at"))
    path = str(tmp_path / "bodies")
    tables.write_chunk_bodies(rows, path, partition_by=("tenant_id",))
    assert len(files_below(path)) == 12 and spark.conf.get(setting) == before
    got = spark.read.parquet(path).groupBy("tenant_id").agg(F.count("id").alias("n"), F.countDistinct("id").alias("d")).collect()
    assert sorted(map(tuple, got)) == [(t, 400_000, 400_000) for t in range(3)]
    out = retire_tenant_folders(spark, 1, {"bodies": (spark.read.parquet(path), path, ["tenant_id"])})
    assert [tuple(r) for r in out.collect()] == [("bodies", 400_000)] and len(files_below(path)) == 8
    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    tables.write_chunk_bodies(rows.where("id < 300000 or id >= 1199000"), few, partition_by=("tenant_id",))
    tables.write_chunk_bodies(rows.withColumn("tenant_id", F.col("id").cast("long") % 40), many, partition_by=("tenant_id",))
    assert len(files_below(few)) == 3 and len(files_below(many)) == 40


def test_versions_swap_whole(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "jobs"))
    with pytest.raises(FileNotFoundError):
        table.read()
    first = table.replace(spark.createDataFrame([(1, "completed", NOW - timedelta(days=9)), (2, "running", None)], "id int, status string, end_time timestamp"))
    old = table.read()
    fails = table.read().withColumn("id", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        table.replace(fails)
    assert table.current() == first and table.read().count() == 2  # a failed run leaves the old version readable
    table.replace(lifecycle.purge_finished_jobs(table.read(), F.lit(NOW)))
    assert [r["id"] for r in table.read().collect()] == [2] and old.count() == 2
    assert table.drop_old() == 2 and [r["id"] for r in table.read().collect()] == [2]


def test_upserts_into_a_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "state"))
    table.replace(spark.createDataFrame([(1, "a", 1), (2, "b", 5)], "id int, status string, version int"))
    fresh = spark.createDataFrame([(1, "c", 1), (2, "old", 4), (3, "new", 1)], "id int, status string, version int")
    table.replace(lifecycle.upsert_state(table.read(), fresh, ["id"], "version"))
    assert sorted(map(tuple, table.read().collect())) == [(1, "c", 1), (2, "b", 5), (3, "new", 1)]
