"""Listings and stores on small hand-made inputs."""

import os

import pytest
from pyspark.sql import functions as F

from tributary.session import fresh_path
from tributary.sources import listings as ls
from tributary.sources import local_files, tables


def test_local_walk(spark, tmp_path):
    for p in ("a.py", "pkg/__init__.py", "_under.md", ".hidden/x.py", "b/.env", "pic.PNG", "deep/er/still/n.txt", "x.lock"):
        f = tmp_path / p
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(p)
    os.symlink(tmp_path / "pkg", tmp_path / "linked")
    got = local_files.scan_local_files(spark, str(tmp_path), content=True).collect()
    assert sorted(r["path"] for r in got) == [
        "_under.md", "a.py", "deep/er/still/n.txt", "linked/__init__.py", "pkg/__init__.py"
    ]
    row = next(r for r in got if r["name"] == "a.py")
    assert (row["size"], bytes(row["content"]), row["metadata"]["base_path"]) == (4, b"a.py", str(tmp_path))


def test_partitions_cover_every_file_once(tmp_path, monkeypatch):
    monkeypatch.setattr(local_files, "NAMES", 3)
    for i in range(40):
        f = tmp_path / (f"d{i % 4}/e{i % 3}/f{i}.txt" if i % 5 else f"f{i}.txt")
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text("x")
    reader = local_files.LocalFilesReader(str(tmp_path), False, [], [])
    names = [row[1] for part in reader.partitions() for row in reader.read(part)]
    assert sorted(names) == sorted(f"f{i}.txt" for i in range(40))


def test_folder_paths_of_a_deep_chain(spark):
    rows = [("n0", None, "n0")] + [(f"n{i}", f"n{i - 1}", f"n{i}") for i in range(1, 20)] + [("lost", "gone", "lost")]
    got = {r["id"]: r["path"] for r in ls.folder_paths(spark.createDataFrame(rows, "id string, parent_id string, name string")).collect()}
    assert got == {f"n{i}": "/".join(f"n{j}" for j in range(i + 1)) for i in range(20)}


def test_size_zero_passes_and_pages_without_sizes(spark):
    pages = spark.createDataFrame(
        [([("blob", "a.py", "s1", 0), ("blob", "b.py", "s2", None), ("blob", "c.py", "s3", 2000), ("tree", "d", "s4", 0)],)], ls.TREE
    )
    got = ls.scan_repo_tree(pages, "o/r", options=ls.SyncOptions(max_mb=0.001)).collect()
    assert [(r["path"], r["size"]) for r in got] == [("a.py", 0), ("b.py", 0)]


def test_state_round_trip(spark):
    path = fresh_path(spark, "state")
    rows = spark.createDataFrame([("1", "t", "pending")], "id string, tenant_id string, embedding_state string")
    tables.write_state(rows, "chunks", path)
    tables.write_state(rows.withColumn("tenant_id", F.lit("u")), "chunks", path)
    back = tables.read_state(spark, "chunks", path)
    assert back.where("tenant_id = 'u'").select("id", "tenant_id", "neo4j_id").collect() == [("1", "u", None)]
    assert back.count() == 2


def test_many_chunks_of_few_tenants_are_written_in_place(spark, tmp_path):
    path = str(tmp_path / "chunks")
    rows = spark.range(0, 1_200_000, 1, 4).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 2 == 0, "t").alias("tenant_id"))
    tables.write_state(rows, "chunks", path)
    assert sum(n.endswith(".parquet") for _, _, names in os.walk(path) for n in names) == 8
    got = tables.read_state(spark, "chunks", path).groupBy("tenant_id").agg(F.count("id"), F.countDistinct("id")).collect()
    assert {tuple(r) for r in got} == {("t", 600_000, 600_000), (None, 600_000, 600_000)}


@pytest.mark.parametrize(("table", "least"), [("file_blobs", 0), ("chunks", 1_000_000), ("chunks", 0)])
def test_stored_hashes_take_half_their_length(spark, tmp_path, monkeypatch, table, least):
    """Written plainly, with folders brought together, and with folders in place; a hash of 64 digits holds 32 bytes."""
    monkeypatch.setattr(tables, "UNSHUFFLED_ROWS", least)
    path, n = str(tmp_path / table), 200_000
    rows = spark.range(0, n, 1, 2).select(F.sha2(F.col("id").cast("string"), 256).alias("content_hash"), (F.col("id") % 2).alias("tenant_id"))
    tables.write_state(rows, table, path)
    assert sum(os.path.getsize(os.path.join(at, f)) for at, _, names in os.walk(path) for f in names if f.endswith(".parquet")) < 40 * n
    back = tables.read_state(spark, table, path).select("content_hash", F.col("tenant_id").cast("long"))
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()


def test_ephemeral_mode_stores_nothing(spark):
    rows = spark.createDataFrame([(1, "x")], "id int, content string").withColumn("created_at", F.lit("2024-01-01").cast("timestamp"))
    assert tables.chunk_bodies(rows, "ephemeral").count() == 0
    assert tables.chunk_bodies(rows, "postgres").first()["purge_at"] is None


def test_the_listing_query_keeps_large_files_and_every_folder(spark, tmp_path):
    from suite.compare import difference, duck
    from suite.q_sources import scan_local_files as listing
    from suite.registry import ORACLES

    rows = [(0, "x" * 20000, "en", "s1", 20000), (48, "y", "en", "s1", 1), (72, "hidden", "en", "s1", 6)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1).write.parquet(str(tmp_path / "d"))
    os.replace(next((tmp_path / "d").glob("part-*.parquet")), tmp_path / "documents.parquet")
    got = {r["path"]: r["size"] for r in listing(spark, str(tmp_path)).collect()}
    assert got == {"src/doc_0.py": 20000, "node_modules/doc_48.py": 1}
    assert difference(spark, duck(str(tmp_path)), str(tmp_path), listing, ORACLES["scan_local_files"]) is None
