"""Listings in tasks and with pushed filters, the change feed, destinations, and webhooks as a stream."""

import json
import os
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, Not, StringContains

from suite import q_flows, views
from tributary.functions import content as k
from tributary.plans import flows
from tributary.session import fresh_path
from tributary.sources import destinations, feeds, local_files
from tributary.sources.listings import SyncOptions
from tributary.streaming import operators as st

T0 = datetime(2024, 1, 1)


def tree(base, names):
    for p in names:
        f = base / p
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(p)


def test_options_reach_the_listing(spark, tmp_path):
    tree(tmp_path, ["a.py", "b.md", "node_modules/c.py", "deep/d.PY", "deep/er/e.txt", "big.py", ".git/f.py"])
    (tmp_path / "big.py").write_text("x" * 5000)
    options = SyncOptions(include=["py"], exclude=["node_modules"], max_mb=1 / 256)
    got = local_files.scan_local_files(spark, str(tmp_path), content=True, options=options).collect()
    assert {r["path"]: bytes(r["content"]).decode() for r in got} == {"a.py": "a.py", "deep/d.PY": "deep/d.PY"}


def test_links_in_a_circle_end(spark, tmp_path):
    tree(tmp_path, ["x/a.txt", "x/y/b.txt"])
    os.symlink(tmp_path / "x", tmp_path / "x" / "y" / "back")
    os.symlink(tmp_path / "nowhere", tmp_path / "x" / "broken.txt")
    got = {r["path"]: r["size"] for r in local_files.scan_local_files(spark, str(tmp_path)).collect()}
    assert got == {"x/a.txt": 7, "x/y/b.txt": 9, "x/broken.txt": 0}
    with pytest.raises(FileNotFoundError):
        local_files.walk_tree(spark, str(tmp_path / "missing"))


def walked(base):
    """What a plain walk finds, without hidden names."""
    found = []
    for at, folders, names in os.walk(base, followlinks=True):
        folders[:] = [d for d in folders if not d.startswith(".")]
        found += [os.path.relpath(os.path.join(at, n), base) for n in names if not n.startswith(".")]
    return sorted(found)


def in_rounds(base):
    """What the listing finds when its rounds run in this process, and the number of rounds."""
    ahead, found, rounds = [(str(base), [])], [], 0
    while ahead:
        rows = [r for given, above in ahead for r in local_files._near(given, above)]
        found += [os.path.relpath(os.path.join(at, name), base) for at, name, *_ in rows if name is not None]
        ahead, rounds = [(at, way) for at, name, _, _, way in rows if name is None], rounds + 1
    return sorted(found), rounds


def test_files_at_any_depth_are_listed(spark, tmp_path):
    tree(tmp_path, [f"{'d/' * k}{name}" for k in range(151) for name in ("a.txt", "b.py", "side/c.md", ".hidden/d.py", *(f"{n}.js" for n in range(9)))])
    got = sorted(r["path"] for r in local_files.scan_local_files(spark, str(tmp_path)).collect())
    assert got == walked(tmp_path) and len(got) == 151 * 12
    assert max(p.count("/") for p in got) == 151


def test_each_round_lists_some_entries_further_down(tmp_path, monkeypatch):
    tree(tmp_path, [f"{'d/' * k}{name}" for k in range(80) for name in ("a.txt", "side/b.txt")] + [f"big/{n}.txt" for n in range(300)])
    every = walked(tmp_path)
    assert in_rounds(tmp_path) == (every, 1)
    for near, rounds in ((200, 5), (100, 10), (1, 81)):
        monkeypatch.setattr(local_files, "NEAR", near)
        got, n = in_rounds(tmp_path)
        assert got == every and n <= rounds
    monkeypatch.setattr(local_files, "NEAR", 200)
    rows = list(local_files._near(str(tmp_path), []))
    assert str(tmp_path / "big") in [at for at, name, *_ in rows if name is None] and len(rows) < 300  # left for a row of its own


def test_links_are_followed_unless_they_lead_back(spark, tmp_path):
    base = tmp_path / "outer" / "base"
    tree(base, ["a/x.txt", "b/c/y.txt", "ab/z.txt", "deep/" + "e/" * 70 + "f.txt"])
    os.symlink(base / "b", base / "a" / "to_b")
    os.symlink(base / "a", base / "b" / "c" / "to_a")
    os.symlink(base / "a", base / "ab" / "to_a")  # "a" begins "ab", but isn't above it
    os.symlink(tmp_path / "outer", base / "b" / "up")
    os.symlink("self.txt", base / "self.txt")
    got = {r["path"]: (r["size"], r["updated_at"] is None) for r in local_files.scan_local_files(spark, str(base)).collect()}
    assert got.pop("self.txt") == (0, True)
    assert sorted(got) == sorted([
        "a/x.txt", "a/to_b/c/y.txt", "b/c/y.txt", "b/c/to_a/x.txt", "ab/z.txt", "ab/to_a/x.txt", "ab/to_a/to_b/c/y.txt", "deep/" + "e/" * 70 + "f.txt",
    ])
    assert in_rounds(base)[0] == sorted([*got, "self.txt"])


def test_numbers_of_devices_and_files_leave_nothing_out(tmp_path, monkeypatch):
    """Mounts may number their directories otherwise on each executor."""
    tree(tmp_path, ["a.txt", "x/b.txt", "x/y/c.txt"])
    stat = os.stat

    def alike(path, **how):
        s = stat(path, **how)
        return SimpleNamespace(st_dev=7, st_ino=7, st_mode=s.st_mode, st_size=s.st_size, st_mtime_ns=s.st_mtime_ns)

    with monkeypatch.context() as patched:
        patched.setattr(os, "stat", alike)
        assert in_rounds(tmp_path)[0] == ["a.txt", "x/b.txt", "x/y/c.txt"]


def test_a_flat_directory_is_read_in_even_parts(spark, tmp_path, monkeypatch):
    tree(tmp_path, [f"f{k:05d}.txt" for k in range(3000)])
    files = local_files.walk_tree(spark, str(tmp_path))
    read = local_files.with_content(files, F.concat_ws("/", "directory", "name"))
    sizes = [r["n"] for r in read.groupBy(F.spark_partition_id().alias("p")).agg(F.count("content").alias("n")).collect()]
    assert sum(sizes) == 3000 and len(sizes) >= 8 and max(sizes) < 2 * min(sizes)
    monkeypatch.setattr(local_files, "NAMES", 400)
    reader = local_files.LocalFilesReader(str(tmp_path), False, [], [])
    parts = reader.partitions()
    assert sorted(len(p.names) for p in parts) == [200, *[400] * 7]
    listed = []
    monkeypatch.setattr(os, "scandir", lambda path: listed.append(path))
    assert sum(len(list(reader.read(p))) for p in parts) == 3000 and not listed  # no part lists the directory again


def test_filters_are_pushed_into_the_reader(spark, tmp_path):
    tree(tmp_path, ["a.py", "b.md", "src/c.py", "src/vendor/d.py"])
    reader = local_files.PushedLocalFilesReader(str(tmp_path), False, [], ["vendor"])
    kept = list(reader.pushFilters([In(("extension",), ("py",)), Not(StringContains(("path",), "x")), GreaterThan(("size",), 3), EqualTo(("size",), 4)]))
    assert kept == [GreaterThan(("size",), 3), EqualTo(("size",), 4)]
    assert sorted(r[2] for p in reader.partitions() for r in reader.read(p)) == ["a.py", "src/c.py"]
    setting = "spark.sql.python.filterPushdown.enabled"
    spark.dataSource.register(local_files.LocalFiles)
    for on in ("true", "false"):
        spark.conf.set(setting, on)
        try:
            df = spark.read.format("local_files").option("pushdown", on).load(str(tmp_path)).where("extension = 'py' and not contains(path, 'vendor') and size > 4")
            assert [r["path"] for r in df.collect()] == ["src/c.py"]
        finally:
            spark.conf.unset(setting)


def page(base, source, name, changes):
    folder = os.path.join(base, f"source={source}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for item, kind, at in changes:
            f.write(json.dumps({"item_id": item, "change_type": kind, "cursor": None, "timestamp": at.isoformat()}) + "\n")


def test_a_feed_goes_on_from_each_sources_cursor(spark, tmp_path):
    base, out, progress = str(tmp_path / "pages"), str(tmp_path / "out"), str(tmp_path / "progress")
    page(base, "A", "p1", [("a", "created", T0), ("b", "created", T0)])
    page(base, "A", "p2", [("a", "updated", T0 + timedelta(hours=1))])
    page(base, "B", "p7", [("x", "created", T0)])
    page(base, "B", ".half", [("never", "created", T0)])

    def run():
        st.run_available(feeds.read_change_feed(spark, base), out, progress)
        return sorted((r["source_id"], r["page"], r["item_id"]) for r in spark.read.schema(feeds.SCHEMA).parquet(out).collect())

    first = [("A", "p1", "a"), ("A", "p1", "b"), ("A", "p2", "a"), ("B", "p7", "x")]
    assert run() == first
    assert run() == first  # nothing new
    page(base, "B", "p8", [("x", "deleted", T0 + timedelta(hours=2))])
    page(base, "C", "p0", [("late", "created", T0)])  # a source nobody knew, with older times
    assert run() == sorted([*first, ("B", "p8", "x"), ("C", "p0", "late")])


def test_offsets_name_the_last_page_of_each_source(tmp_path):
    for n in range(3):
        page(str(tmp_path), "A", f"p{n}", [("a", "created", T0)])
    reader = feeds.ChangeFeedReader(str(tmp_path))
    assert reader.initialOffset() == {} and reader.latestOffset() == {"A": "p2"}
    assert [p.name for p in reader.partitions({}, {"A": "p1"})] == ["p0", "p1"]  # a page that came later waits
    assert [p.name for p in reader.partitions({"A": "p1"}, {"A": "p2"})] == ["p2"]
    assert not feeds.ChangeFeedReader(str(tmp_path / "none")).latestOffset()


def test_nothing_of_a_killed_task_is_visible(spark, tmp_path):
    path, schema = str(tmp_path / "there"), "id long, body string"
    spark.dataSource.register(destinations.Destination)
    rows = spark.range(100).withColumn("body", F.concat(F.lit("b"), "id")).repartition(4)

    def send(df, label):
        df.write.format("destination").option("label", label).mode("append").save(path)

    send(rows, "one")
    with pytest.raises(Exception):
        send(rows.withColumn("body", F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("body"))), "two")
    assert destinations.read_destination(spark, path, schema).count() == 100
    left = set(os.listdir(f"{path}/parts"))
    send(rows, "one")  # again under its label
    got = destinations.read_destination(spark, path, schema)
    assert got.count() == 100 and {n for n in os.listdir(f"{path}/parts") if not n.startswith(".")} == {n for n in left if not n.startswith(".")}
    send(rows.limit(3), "three")
    assert destinations.read_destination(spark, path, schema).count() == 103


def test_a_failing_destination_stops_no_other(spark, tmp_path):
    spark.dataSource.register(destinations.Destination)
    rows = spark.range(5).selectExpr("id", "'x' as body")

    def good(name):
        return lambda df: df.write.format("destination").option("label", "run").mode("append").save(str(tmp_path / name))

    def bad(df):
        raise RuntimeError("out of order")

    got = {r["destination"]: (r["sent"], r["error"]) for r in destinations.send_to_all(rows, {"a": good("a"), "b": bad, "c": good("c")}).collect()}
    assert got == {"a": (True, None), "b": (False, "out of order"), "c": (True, None)}
    assert destinations.read_destination(spark, str(tmp_path / "c"), "id long, body string").count() == 5


def test_batches_of_a_stream_are_published_once(spark, tmp_path):
    source, path = fresh_path(spark, "sent"), str(tmp_path / "there")
    spark.range(50).selectExpr("id", "'x' as body").repartition(3).write.parquet(source)
    spark.dataSource.register(destinations.Destination)
    progress = str(tmp_path / "progress")
    for _ in range(2):
        stream = spark.readStream.schema("id long, body string").option("maxFilesPerTrigger", 1).parquet(source)
        query = stream.writeStream.format("destination").option("checkpointLocation", progress).trigger(availableNow=True).start(path)
        query.awaitTermination()
        assert destinations.read_destination(spark, path, "id long, body string").count() == 50
    writer = destinations.DestinationStreamWriter(path)
    again = writer.write(iter(spark.range(2).selectExpr("id", "'y' as body").collect()))
    writer.commit([again, None], 0)  # a batch that was committed before
    assert destinations.read_destination(spark, path, "id long, body string").count() == 50 and not os.path.exists(f"{path}/parts/{again.part}")


def test_gitlab_proves_itself_by_token(spark):
    ipad, opad = k.hmac_pads("secret")
    body = '{"object_kind":"push","commits":[{"id":"c","added":["a"],"modified":[],"removed":[]}]}'
    signed = spark.range(1).select(F.concat(F.lit("sha256="), k.hmac_sha256(F.lit(body), F.lit(ipad), F.lit(opad)))).first()[0]
    rows = [(1, "gitlab", "secret"), (2, "gitlab", signed), (3, "github", "secret"), (4, "github", signed), (5, "gitlab", None), (6, "dropbox", "secret"), (7, "onedrive", signed)]
    raw = spark.createDataFrame([(i, "c1", p, body, s, T0) for i, p, s in rows], "id long, connector_id string, provider string, body string, signature string, received_at timestamp")
    secrets = spark.createDataFrame([("c1", ipad, opad, "secret")], "connector_id string, ipad string, opad string, token string")
    connectors = spark.createDataFrame([("c1", "t")], "id string, tenant_id string")
    events, changes, jobs = flows.webhook_flow(raw, connectors, secrets)
    assert {r["id"] for r in events.where("verified").collect()} == {1, 4, 7}
    assert sorted((r["id"], r["item_id"], r["position"]) for r in changes.collect()) == [(1, "a", 0), (4, "a", 0)]
    assert sorted(r["request_id"] for r in jobs.collect()) == [1, 4]


def test_the_webhook_stream_equals_the_batch(spark, sf_dir):
    raw, known, keys = q_flows.webhooks(spark, sf_dir), views.connectors(spark, sf_dir), q_flows.secrets(spark, sf_dir)
    want = sorted(map(str, q_flows.flow_rows(*flows.webhook_flow(raw, known, keys)).collect()))
    source, path, progress = (fresh_path(spark, x) for x in ("hooks", "tables", "progress"))
    raw.repartition(3).write.parquet(source)
    for again in range(2):
        stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(source)
        flows.run_webhook_stream(stream, known, keys, path, progress)
        assert sorted(map(str, q_flows.flow_rows(*flows.webhook_tables(spark, path)).collect())) == want
        last = sorted(int(n) for n in os.listdir(f"{progress}/commits") if n.isdigit())[-1]
        for name in (str(last), f".{last}.crc"):  # the last batch is run again
            if not again and os.path.exists(f"{progress}/commits/{name}"):
                os.remove(f"{progress}/commits/{name}")
    assert {r["provider"] for r in flows.webhook_tables(spark, path)[0].select("provider").distinct().collect()} == set(q_flows.PROVIDERS)
