"""Paths that several sources share, order inside a push, listings without hashes, and folders without a root."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tributary.operators import aggregates as agg
from tributary.operators import changes as ch
from tributary.operators import events as ev
from tributary.operators import joins
from tributary.plans import flows
from tributary.sources.listings import folder_paths

T0 = datetime(2024, 1, 1)


def test_one_path_in_two_sources(spark):
    changes = spark.createDataFrame(
        [("A", "README.md", "c1", "updated", T0), ("B", "README.md", "c2", "deleted", T0 + timedelta(hours=1)), ("A", "x", "c3", "updated", T0)],
        "source_id string, item_id string, cursor string, change_type string, timestamp timestamp_ntz",
    )
    items = spark.createDataFrame(
        [(s, p, f"{s} {p}") for s in "AB" for p in ("README.md", "x")], "source_id string, external_id string, content string"
    )
    cursors = spark.createDataFrame([("A", T0), ("B", T0 + timedelta(hours=2))], "source_id string, cursor timestamp_ntz")
    got = joins.incremental_documents(changes, items).collect()
    assert sorted(r["content"] for r in got) == ["A README.md", "A x"]
    docs, cursor = flows.incremental_sync(changes, items, cursors)
    assert sorted(r["content"] for r in docs.collect()) == ["A README.md", "A x"]
    assert [(r["source_id"], r["cursor"]) for r in cursor.collect()] == [("A", T0)]
    listed = items.select(
        F.col("external_id").alias("id"), "source_id", F.lit("github").alias("connector_type"), F.col("external_id").alias("name"),
        F.col("external_id").alias("path"), F.lit(None).cast("map<string,string>").alias("metadata"),
        F.lit(T0).alias("created_at"), F.lit(T0).alias("updated_at"),
    )
    bodies = items.select("source_id", F.col("external_id").alias("path"), "content", F.lit("text").alias("content_type"), F.lit("en").alias("language"))
    assert sorted((r["source_id"], r["content"]) for r in ev.normalize_documents(listed, bodies).collect()) == sorted(
        (s, f"{s} {p}") for s in "AB" for p in ("README.md", "x")
    )


def test_a_file_removed_by_the_next_commit_of_a_push(spark):
    body = '{"commits":[{"id":"zz","added":["a","b"],"modified":[],"removed":[]},{"id":"aa","added":[],"modified":[],"removed":["a"]}]}'
    push = spark.createDataFrame([("A", T0, body)], "source_id string, timestamp timestamp_ntz, payload string")
    changes = ch.changes_github(push)
    assert sorted((r["commit_no"], r["position"], r["item_id"]) for r in changes.collect()) == [(0, 0, "a"), (0, 1, "b"), (1, 0, "a")]
    items = spark.createDataFrame([("A", "a"), ("A", "b")], "source_id string, external_id string")
    assert [r["external_id"] for r in joins.incremental_documents(changes, items).collect()] == ["b"]


def test_listings_without_hashes(spark):
    shape = "source_id string, path string, content_hash string"
    old = spark.createDataFrame([("A", "same", None), ("A", "gone", None), ("A", "hashed", None)], shape)
    new = spark.createDataFrame([("A", "same", None), ("A", "new", None), ("A", "hashed", "h")], shape)
    assert {r["path"]: r["change"] for r in joins.listing_diff(old, new).collect()} == {"gone": "removed", "new": "added", "hashed": "changed"}


def test_dead_letters_of_any_value(spark):
    import json

    values = ['{"a":1}', "not json", None, '"text"', '{"broken":']
    failed = spark.createDataFrame(
        [("t", 0, k, "key", v, "boom", k) for k, v in enumerate(values)],
        "topic string, partition int, offset bigint, key string, value string, error string, seq bigint",
    )
    got = {r["seq"]: json.loads(r["value"])["original_value"] for r in agg.dlq_candidates(failed, 1).collect()}
    assert got == {0: {"a": 1}, 1: "not json", 2: None, 3: "text", 4: '{"broken":'}


def test_folders_on_a_cycle_and_listed_twice(spark):
    chain = [(f"f{k}", f"f{k - 1}" if k else None, f"n{k}") for k in range(70)]
    odd = [("x", "y", "x"), ("y", "x", "y"), ("below", "x", "b"), ("lost", "nowhere", "l"), ("f1", "f0", "n1")]
    got = {r["id"]: r["path"] for r in folder_paths(spark.createDataFrame(chain + odd, "id string, parent_id string, name string")).collect()}
    assert got == {f"f{k}": "/".join(f"n{j}" for j in range(k + 1)) for k in range(70)}


def test_ring_prefixes_follow_its_size(spark):
    assert joins.prefix_digits(3) == 3 and joins.prefix_digits(1000) == 5
    ring = joins.hash_ring(spark, 40)
    assert ring.groupBy("_prefix").count().agg(F.avg("count")).first()[0] < 3


def test_blobs_of_a_run_and_their_content(spark, tmp_path):
    from tributary.sources import tables

    docs = spark.createDataFrame(
        [("d1", "c", "t", "a.txt", "x" * 3000), ("d2", "c", "t", "b.txt", "small"), ("d3", "c", "u", "c.txt", "y" * 4000)],
        "id string, connector_id string, tenant_id string, name string, content string",
    ).withColumns({"mime_type": F.lit(None).cast("string"), "created_at": F.lit(T0)})
    path = str(tmp_path / "blobs")
    assert tables.blob_offload(docs, path, 1, run="r1").count() == 2
    assert tables.blob_offload(docs.where("id = 'd3'"), path, 1, run="r2").count() == 1
    again = tables.blob_offload(docs, path, 1, run="r1")
    assert again.count() == 2
    got = tables.fetch_blobs(again.select("file_id", "blob_url"), path).collect()
    assert sorted((r["file_id"], len(r["content"])) for r in got) == [("d1", 3000), ("d3", 4000)]


def test_families_keep_and_name_their_files(spark):
    from tributary.sources.listings import SyncOptions

    kinds = ["github", "gitlab", "bitbucket", "local_file", "google_drive", "dropbox", "onedrive"]
    names = ["a.pdf", "b.xlsx", "c.hpp", "d.cc", "Node/e.md", ".f/g.py", "h.png"]
    rows = [(f"{c}{n}", "s", c, n.split("/")[-1], n, 10, "text/plain" if n != "h.png" else "image/png", "body", "t", k) for k, (c, n) in enumerate((c, n) for c in kinds for n in names)]
    files = spark.createDataFrame(
        rows, "id string, source_id string, connector_type string, name string, path string, size long, mime_type string, content string, tenant_id string, seq long"
    )
    got = flows.full_sync(files, SyncOptions(exclude=["node"])).collect()
    kept = {k: {r["path"]: (r["content_type"], r["language"]) for r in got if r["connector_type"] == k} for k in kinds}
    assert kept["github"] == kept["gitlab"] == {
        "c.hpp": ("code", "c"), "d.cc": ("unknown", "cpp"), "Node/e.md": ("markdown", "markdown"), ".f/g.py": ("code", "python"),
    }
    assert kept["bitbucket"]["c.hpp"] == ("code", "cpp") and kept["bitbucket"]["d.cc"] == ("unknown", None)
    assert set(kept["local_file"]) == {"c.hpp", "d.cc", "Node/e.md"} and kept["local_file"]["d.cc"] == ("unknown", None)
    assert set(kept["google_drive"]) == set(names) - {"h.png"} and set(kept["google_drive"].values()) == {("text", None)}
    assert kept["dropbox"]["a.pdf"] == ("pdf", None) and kept["dropbox"]["b.xlsx"] == ("unknown", None) and "Node/e.md" not in kept["dropbox"]
    assert kept["onedrive"]["b.xlsx"] == ("spreadsheet", None) and "h.png" not in kept["onedrive"]
