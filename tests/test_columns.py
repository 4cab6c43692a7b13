"""Hand tables for classification, filters and content functions."""

import base64
import datetime
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from tributary.functions import classify as c
from tributary.functions import content as k
from tributary.operators import events as ev
from tributary.operators.throttle import backoff_seconds


def one(spark, column, **values):
    """Value of a column expression over one row."""
    row = spark.range(1).select(*[F.lit(v).alias(n) for n, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("path, ext, kind", [
    ("a.b/Makefile", "b/makefile", "unknown"), ("Makefile", "", "unknown"), ("x/Y.PY", "py", "code"), ("r.tar.gz", "gz", "unknown"),
    ("dot.", "", "unknown"), (".md", "md", "markdown"),
])
def test_extension_is_taken_from_the_whole_path(spark, path, ext, kind):
    e = c.file_extension(F.col("p"))
    assert one(spark, e, p=path) == ext
    assert one(spark, c.content_type_by_ext(e), p=path) == kind


@pytest.mark.parametrize("name, ext", [(".bashrc", ""), ("a.Py", "py"), ("a.", ""), ("a.b.c", "c"), ("plain", "")])
def test_local_extension(spark, name, ext):
    assert one(spark, c.local_extension(F.col("n")), n=name) == ext


@pytest.mark.parametrize("ext, family, language", [
    ("hpp", "git", "c"), ("hpp", "bitbucket", "cpp"), ("cc", "git", "cpp"), ("cc", "local", None), ("sass", "git", "scss"),
    ("sass", "local", None), ("json", "bitbucket", None), ("ps1", "bitbucket", None),
])
def test_language_families(spark, ext, family, language):
    assert one(spark, c.language_by_ext(F.col("e"), family), e=ext) == language


@pytest.mark.parametrize("size, max_mb, kept", [
    (0, 0.001, True), (None, 0.001, True), (1048, 0.001, True), (1049, 0.001, False), (9999, 0, True), (9999, None, True),
])
def test_size_rule(spark, size, max_mb, kept):
    assert one(spark, c.within_size(F.col("s").cast("long"), max_mb), s=size) is kept


def test_excludes_differ_in_case(spark):
    repo = c.sync_filter_repo(F.col("p"), None, exclude=["Dist"])
    folder = c.sync_filter_folder(F.col("p"), None, exclude=["Dist"])
    assert one(spark, repo, p="x/dist/a.py") is True and one(spark, folder, p="x/dist/a.py") is False
    assert one(spark, c.sync_filter_repo(F.col("p"), None, include=["..PY"]), p="a.py") is True


@pytest.mark.parametrize("path, hit", [
    ("node_modules/a/b.js", True), ("web/node_modules/b.js", True), ("my_node_modules/b.js", False), ("a/b.min.js", True),
    ("package-lock.json", True), ("a/yarn.lock", True), ("src/a.js", False), ("x.tar.gz", True), ("lib/a.so.1", False),
])
def test_default_globs(spark, path, hit):
    assert one(spark, c.glob_filter(F.col("p")), p=path) is not hit


def test_mime_prefix_order(spark):
    kind = c.content_type_by_mime(F.col("m"))
    got = [one(spark, kind, m=m) for m in ("text/x-c", "application/x-sh", "text/csv", "text/javascript", "image/png")]
    assert got == ["code", "code", "text", "code", "unknown"]


@pytest.mark.parametrize("secret", ["s", "é", "x" * 64, "y" * 65])
def test_hmac_equals_the_library(spark, secret):
    body = '{"a": "ü"}'
    good = "sha256=" + hmac.new(secret.encode(), body.encode(), hashlib.sha256).hexdigest()
    check = k.verify_signature(F.col("b"), F.col("h"), secret)
    assert one(spark, check, b=body, h=good) is True
    assert one(spark, check, b=body + " ", h=good) is False
    assert one(spark, check, b=body, h=None) is False


@pytest.mark.parametrize("raw, by_id, by_path", [
    (base64.b64encode("naïve\n".encode()).decode(), "naïve\n", "naïve\n"),
    ("aGVs\nbG8=\n", "hello", "hello"), ("a*G V-sbG8=", "hello", "hello"), ("/w==", "/w==", ""), ("abc", "abc", ""), ("", "", ""),
])
def test_base64(spark, raw, by_id, by_path):
    assert one(spark, k.decode_base64(F.col("r")), r=raw) == by_id
    assert one(spark, k.decode_base64(F.col("r"), by_path=True), r=raw) == by_path


def test_base64_cleans_only_what_does_not_decode(spark):
    """The search for characters outside the alphabet stands once in the plan, and only behind the plain decoder."""
    rows = spark.createDataFrame([("aGVsbG8=",), ("a*GVsbG8=",), ("aGVs\r\nbG8=\n",), ("aGVsbG8",), (None,)], "r string")
    got = rows.select("r", k.decode_base64(F.col("r")).alias("t"))
    assert [r["t"] for r in got.collect()] == ["hello", "hello", "hello", "hello", None]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1 and plan.index("replace(replace(r") < plan.index("regexp_replace")


def test_text_fallback(spark):
    rows = spark.createDataFrame([(bytearray("ü".encode()),), (bytearray(b"\xfc!"),), (None,)], "raw binary")
    assert [r[0] for r in rows.select(k.decode_text(F.col("raw"))).collect()] == ["ü", "ü!", ""]


@pytest.mark.parametrize("body, payload", [
    ('{"a":1}', '{"a":1}'), ("[1]", "[1]"), ("oops", '{"raw_body":"oops"}'), ("", '{"raw_body":""}'), (None, '{"raw_body":""}'),
])
def test_webhook_payload(spark, body, payload):
    assert one(spark, k.webhook_payload(F.col("b").cast("string")), b=body) == payload


def test_blob_key(spark):
    key = k.blob_key(F.lit("t"), F.lit("f"), F.lit("b"), F.col("n"))
    assert [one(spark, key, n=n) for n in ("a.TXT", "a", "a.")] == ["t/f/b.TXT", "t/f/b", "t/f/b"]


def test_route_threshold_is_inclusive(spark):
    r = k.route_by_size(F.col("s"), 4)
    assert [one(spark, r, s=s) for s in (4096, 4097)] == ["inline", "reference"]


def test_bloom_size():
    assert k.bloom_size(100_000, 0.01) == (958506, 7)


def test_bloom_positions(spark):
    m, n = k.bloom_size(100_000, 0.01)
    keys = [f"key-{i}" for i in range(50)]
    rows = k.bloom_positions(spark.createDataFrame([(x,) for x in keys], "k string"), F.col("k"), m, n, "p")
    for row in rows.groupBy("k").agg(F.collect_list("p").alias("p")).collect():
        digest = hashlib.sha256(row["k"].encode()).digest()
        a, b = int.from_bytes(digest[:16], "big"), int.from_bytes(digest[16:], "big") | 1
        assert sorted(row["p"]) == sorted((a + i * b) % m for i in range(n))


def test_backoff(spark):
    assert [one(spark, backoff_seconds(F.col("a"), 30, 300), a=a) for a in (0, 1, 3, 4)] == [30.0, 60.0, 240.0, 300.0]


def test_envelope_keeps_nulls_and_fills_the_time(spark):
    now = F.lit(datetime.datetime(2024, 1, 1))
    event = spark.createDataFrame([("e", None)], "event_id string, content string")
    text = event.select(ev.event_envelope(event, "file_ingested", now)).first()[0]
    assert text == (
        '{"event_id":"e","source_id":null,"file_path":null,"file_type":null,"content":null,"metadata":null,'
        '"timestamp":"2024-01-01T00:00:00"}'
    )


def test_parse_errors(spark):
    good = '{"job_id":"j","source_id":"s","job_type":"manual"}'
    bad = {"{": "malformed", '{"job_id":"j"}': "missing field", good[:-1] + ',"x":1}': "unknown field", "[1]": "malformed"}
    rows = spark.createDataFrame([(good,), *[(b,) for b in bad]], "value string")
    got = {r["value"]: r["error"] for r in ev.event_parse(rows, "sync_job").collect()}
    assert got == {good: None, **bad}


def test_empty_option_lists_fall_back(spark):
    config = '{"include_languages":[],"file_extensions":["go"],"folder_id":"","root_folder_id":"r","include_shared":false}'
    o = ev.parse_sync_options(spark.createDataFrame([(config,), ("{}",)], "config_json string")).collect()
    assert (o[0]["include_languages"], o[0]["folder_id"], o[0]["include_shared"]) == (["go"], "r", False)
    assert (o[1]["branch"], o[1]["include_shared"], o[1]["exclude_paths"], o[1]["repository"]) == ("main", True, [], "")


def test_domains(spark):
    ok = c.in_domain(F.col("x").cast("string"), "connector_status")
    assert [one(spark, ok, x=x) for x in ("syncing", "gone", None)] == [True, False, False]
