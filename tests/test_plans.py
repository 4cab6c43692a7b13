"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

QUERIES = entry.queries()
NARROW = {
    "chunk_count": ["l_suppkey"], "jobs_query": ["o_orderkey"], "sync_stats": ["doc_id", "source"], "route_message": ["event_id"],
    "file_extension": ["doc_id"], "peek_top": ["o_orderkey"],
}
# built-in functions only: nothing leaves the JVM
PURE = [
    "full_sync", "content_hash", "glob_exclude", "verify_signature", "bloom_dedup", "hash_ring_partition", "ingest_payload", "event_parse",
    "changes_github", "rotating_dedup", "destination_health", "insert_if_absent", "retention_report", "failure_burst", "job_lifecycle",
]


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("key", PURE)
def test_no_python_and_no_products(spark, sf_dir, key):
    text = plan(QUERIES[key](spark, sf_dir))
    assert "BatchEvalPython" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("key", sorted(NARROW))
def test_scans_read_few_columns(spark, sf_dir, key):
    text = plan(QUERIES[key](spark, sf_dir))
    schema = text.split("ReadSchema: struct<", 1)[1].split("\n")[0]
    assert all(c in text for c in NARROW[key]) and "text:string" not in schema and "l_comment" not in schema


def test_filters_reach_the_scan(spark, sf_dir):
    assert "PushedFilters: [IsNotNull(c_custkey), EqualTo(c_custkey,42)]" in plan(QUERIES["by_id"](spark, sf_dir))
    assert "EqualTo(c_nationkey,3)" in plan(QUERIES["by_tenant"](spark, sf_dir))


def test_dedup_verdict_travels_on_the_sequence_number(spark, sf_dir):
    text = plan(QUERIES["dedup_first_seen"](spark, sf_dir))
    assert "Window" not in text  # no group is ever gathered


@pytest.mark.parametrize("key", ["sync_status", "upsert_state", "peek_top", "incremental_documents"])
def test_latest_rows_are_found_by_hash_aggregates(spark, sf_dir, key):
    from tributary.operators import joins, lifecycle

    if key == "upsert_state":  # the registered query reads its result back from a table
        some = spark.range(9).selectExpr("id", "'s' as status", "cast(id as int) as version")
        text = plan(lifecycle.upsert_state(some, some, ["id"], "version"))
    else:
        text = plan(QUERIES[key](spark, sf_dir))
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_packed_versions_keep_the_order_of_rows(spark):
    import itertools
    from datetime import date, datetime

    from tributary.operators import joins

    whens = [None, datetime(1, 1, 1), datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(2024, 1, 1), datetime(9999, 12, 31)]
    longs = [None, -(2**62), -1, 0, 1, 2**62]
    rows = [(t, n, k) for k, (t, n) in enumerate(itertools.product(whens, longs))]
    df = spark.createDataFrame(rows, "t timestamp_ntz, n bigint, k int")
    for version in (["t", "n"], ["t", "k"], ["n"], ["k", "n"], ["t"]):
        number, rest = joins.packed_version(df, version)
        assert not rest
        got = [r["k"] for r in df.select("*", number.alias("v")).orderBy("v", "k").collect()]
        want = sorted(df.collect(), key=lambda r: (tuple((x is not None, x if x is not None else (whens[1] if c == "t" else 0)) for c, x in ((c, r[c]) for c in version)), r["k"]))
        assert got == [r["k"] for r in want], version
    assert joins.packed_version(df.withColumn("s", joins.F.lit("x")), ["s"])[0] is None
    many = spark.createDataFrame([(None, 1, date(2024, 1, 1), "a"), (None, 1, date(2024, 1, 2), "b"), (5, 1, None, "c"), (5, 0, None, "d")], "key int, v bigint, d date, x string")
    assert sorted(r["x"] for r in joins.latest_by(many, ["key"], ["v", "d"]).collect()) == ["b", "c"]


def test_retired_tenant_prunes_folders(spark, tmp_path):
    from tributary.operators.lifecycle import retire_tenant
    from tributary.sources import tables

    rows = spark.createDataFrame([("1", "t"), ("2", "u")], "id string, tenant_id string")
    tables.write_state(rows, "chunks", str(tmp_path / "chunks"))
    kept = retire_tenant(tables.read_state(spark, "chunks", str(tmp_path / "chunks")), "t")
    assert [r["id"] for r in kept.collect()] == ["2"]
    assert "PartitionFilters: [" in plan(kept) and "tenant_id" in plan(kept).split("PartitionFilters: [", 1)[1].split("]")[0]
    assert kept.where(F.col("tenant_id") == "t").count() == 0
