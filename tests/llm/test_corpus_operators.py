"""Operators over the whole corpus: near-duplicates, repeats, language model, top-k, and the pipeline."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from suite.compare import difference, duck
from tests.llm.helpers import backoff_scores, clashing, components, odd_rows, removed, table
from tributary.llm import anchors, graph, lm, neardup, repeats, suffixes, topk
from tributary.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def rows():
    return odd_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return clashing(table(spark, rows, parts=5))


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_queries_equal_their_sql(spark, sf_dir, key):
    assert difference(spark, duck(sf_dir), sf_dir, QUERIES[key], ORACLES[key]) is None


def test_every_operator_is_registered():
    found = entry.queries()
    assert {k.split("_")[0] for k in QUERIES} == {f"op{n}" for n in range(1, 14)} and set(QUERIES) | {"pipeline"} <= set(found)


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_all_pairs(spark, rows, docs, size, percent):
    want = components(rows, size, percent)
    got = neardup.near_duplicates(docs, size, percent).collect()
    assert sorted(map(str, ((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got))) == sorted(
        str((i, want[i, t or ""][0], want[i, t or ""][1] if want[i, t or ""][0] else i)) for i, t in rows
    )
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_chains_and_families_of_near_duplicates(spark):
    """A chain whose ends have little in common, and a family around one text, in which each has other neighbours."""
    rng, rows, words = random.Random(3), [], [f"w{k}" for k in range(200)]
    chain = words[:]
    for k in range(25):
        rows.append((1000 - k, " ".join(chain)))
        chain[8 * k] = f"c{k}"
    for k in range(120):
        some = [f"f{j}" for j in range(120)]
        for j in rng.sample(range(120), rng.randrange(1, 5)):
            some[j] = f"r{rng.randrange(6)}"
        rows.append((k, " ".join(some)))
    rng.shuffle(rows)
    want = components(rows, 3, 85)
    got = neardup.near_duplicates(table(spark, rows), 3, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: want[i, t][1] for i, t in rows}


@pytest.mark.parametrize("n", [20, 60])
def test_rows_without_id_and_copies_grow_linearly(spark, n):
    """As many texts meet their node, and as many parts are cut, as there are rows, however many share an id or have none."""
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefgh") * 3 + str(rng.randrange(60)) for _ in range(60)) for _ in range(n)]
    docs = table(spark, [(None, t) for t in texts] + [(None, texts[0] + " more")])
    rows = neardup.sketches(docs, 3, neardup.bands_for(85), "doc_id", "text")
    got = neardup.near_duplicates(docs, 3, 85).collect()
    assert len(got) == n + 1 and rows.count() == n + 1
    nodes = rows.select(F.col("doc_id").alias("label"), "print", "f1", "f2").withColumn("node", F.monotonically_increasing_id())
    assert neardup._sets_of(docs, nodes, 3, "doc_id", "text").count() == n + 1
    copies = table(spark, [(1, texts[0] + texts[1])] * n + [(2, texts[2] + texts[1])], parts=4)
    numbered = repeats._numbered(copies, "doc_id", "text")
    wanted = repeats._segments(numbered, 100).where("not repeated")
    one = repeats._parts(numbered.dropDuplicates(["ord", "print"]), wanted.dropDuplicates(["ord", "print", "start"]), 100).count()
    assert repeats._parts(numbered, wanted, 100).count() <= n * one


def test_one_row_of_each_group_stays(spark, rows, docs):
    out = neardup.without_near_duplicates(docs)
    left = out.collect()
    want = components(rows, 5, 80)
    assert out.columns == docs.columns and all(r["kept"] == "own kept" for r in left)
    kept = {(i, t or "") for i, t in rows if not want[i, t or ""][0] or want[i, t or ""][1] == i}
    assert sorted(str((r["doc_id"], r["text"] or "")) for r in left) == sorted(map(str, kept))


def test_components_of_paths_and_stars(spark):
    rng, links = random.Random(4), [(k, k + 1) for k in range(60)] + [(500, 500 + k) for k in range(80)] + [(900, 900), (901, 902), (902, 901)]
    rng.shuffle(links)
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(61)} | {500 + k: 500 for k in range(80)} | {901: 901, 902: 901}
    assert not graph.components(spark.createDataFrame([], "a bigint, b bigint")).count()


def test_densified_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    found = []
    for _ in range(30):
        both, a, b = (rng.integers(0, 1 << 63, n, np.uint64) for n in (80, 10, 10))
        x, y = (neardup.signature(np.union1d(both, z), 160) for z in (a, b))
        found.append((x == y).mean())
    assert abs(np.mean(found) - 0.8) < 0.04
    one = neardup.signature(np.array([5], np.uint64), 160)
    assert len(set(one.tolist())) == 1


def test_suffix_arrays_equal_sorted_suffixes():
    rng = random.Random(3)
    for _ in range(500):
        size, n = rng.choice([1, 2, 3, 5]), rng.randrange(1, 60)
        t = np.array([rng.randrange(1, size + 1) for _ in range(n)] + [0], np.int64)
        want = sorted(range(n + 1), key=lambda i: t[i:].tolist())  # noqa: B023
        for wide in (True, False):
            assert suffixes.suffix_array(t, size + 1, wide).tolist() == want
        common = suffixes.common_prefixes(t, np.array(want))
        for a, b in zip(want, want[1:], strict=False):
            k = 0
            while a + k <= n and b + k <= n and t[a + k] == t[b + k]:
                k += 1
            assert common[b] == k


def test_equal_windows_share_an_anchor():
    rng = np.random.default_rng(2)
    text = rng.integers(97, 100, 5000).astype(np.uint8)
    text[3000:3400] = text[500:900]
    gram, _, start, n = anchors.segments(text, np.array([0, 2000, 5000]), 100)
    of = {int(s) + k: int(g) for g, s, c in zip(gram, start, n, strict=True) for k in range(int(c))}
    assert sorted(of) == [*range(1901), *range(2000, 4901)]
    assert all(of[500 + k] == of[3000 + k] for k in range(301))


def in_order(rows):
    """Documents as the operator orders them: by id, rows without id last; rows that say the same are one."""
    return sorted({(i is None, i or 0, t) for i, t in rows if t})


@pytest.mark.parametrize("group", [repeats.GROUP, 3])
def test_repeats_equal_brute_force(spark, rows, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    rng = random.Random(8)
    # one passage with other words around it in many texts, and texts within texts
    passage = " ".join(f"p{rng.randrange(50)}" for _ in range(60))
    more = [(200 + k, f"{rng.random()} {passage[rng.randrange(90):]} {rng.random()}") for k in range(40)]
    some = [r for r in rows if r[0] is not None and r[0] != 4] + more
    got = repeats.repeat_digests(clashing(table(spark, some, parts=4))).collect()
    listed = in_order(some)
    want = {(k[1], k[2]): w for k, w in zip(listed, removed([k[2] for k in listed], 100), strict=True)}
    empty = removed([""], 100)[0]
    assert sorted(str(tuple(r)) for r in got) == sorted(str((i, *(want[i, t] if t else empty))) for i, t in some)


def test_repeats_without_ids_and_under_one_id(spark, rows):
    """Their order among themselves is fixed by a hash; what goes in all is the same."""
    got = repeats.repeat_digests(table(spark, [(None, "a" * 150), (None, "a" * 150), (5, "b" * 250), (5, "b" * 250 + "c"), (None, None)])).collect()
    by = sorted((r["doc_id"] or 99, r["n_bytes"], r["n_removed"]) for r in got)
    assert [x for x in by if x[0] == 99] == [(99, 0, 0), (99, 150, 149), (99, 150, 149)] and sum(x[2] for x in by if x[0] == 5) in (249 + 250, 250 + 250)
    assert not repeats.repeat_digests(spark.createDataFrame([], "doc_id bigint, text string")).count()


def test_cut_texts_keep_rows_and_columns(spark, rows, docs):
    out = repeats.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert all(r["row"] == "own row" and (r["text"] is None) == (r["doc_id"] in (50, None) and r["text"] is None) for r in out.collect())


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores_equal_brute_force(spark, rows, docs, order):
    got = lm.score(docs, lm.train(docs, order)).collect()
    want = backoff_scores(rows, order, lm.LEAST, lm.BACKOFF)
    key = lambda r: (str(r[0]), r[1], r[2] or 0)
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and (a[2] is None) == (b[2] is None) and (a[2] is None or abs(a[2] - b[2]) < 1e-7)


def test_lm_scores_words_it_never_saw(spark, docs):
    other = table(spark, [(1, "never seen words here"), (2, None)])
    got = {r["doc_id"]: r for r in lm.score(other, lm.train(docs, 2)).collect()}
    assert got[1]["score"] < -1 and got[2]["score"] is None and got[2]["n_words"] == 0
    assert not lm.score(docs.limit(0), lm.train(docs.limit(0))).count()


def test_top_k_with_ties_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "CELL", (16, 16))
    monkeypatch.setattr(topk, "CHUNK", (4, 4))
    rng = np.random.default_rng(3)
    rows = [(k, [float(np.float32(x)) for x in rng.normal(size=6)]) for k in range(150)]
    rows += [(200 + k, rows[3][1]) for k in range(40)] + [(300, None), (301, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6)]
    rows += [(303, [float("inf")] * 6), (None, rows[0][1]), (304, [1.0, 2.0]), (310, [0.5, 0.5]), (350, []), (5, rows[5][1]), (5, rows[6][1]), (10, rows[7][1]), (20, rows[20][1])]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("own")).repartition(4)
    got = topk.top_k(docs, F.col("vec_id") % 10 == 0, 5).collect()
    whole = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for a, (q, x) in enumerate(whole):
        if q % 10 == 0:
            scores = sorted((-sum(s * t for s, t in zip(x, y, strict=True)), i) for c, (i, y) in enumerate(whole) if c != a and len(x) == len(y))
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:5])]
    assert sorted(map(tuple, got)) == sorted(want)
    assert not topk.top_k(docs.limit(0), F.col("vec_id") % 10 == 0, 5).count()


def test_pipeline_stages(spark, tmp_path):
    from tributary.llm import secrets, toxicity

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "suffix_dedup", "secret_scan", "packing"]
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in now.collect()}
        stage(spark, now, sf).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert after.columns == docs.columns
            texts = {r["doc_id"]: r["text"] for r in after.collect()}
        if name == "toxicity":
            rejected = toxicity.held_out_scores(now, labels).where("predicted = 1").count()
            assert len(texts) == len(before) - rejected and all(before[i] == t for i, t in texts.items())
        elif name == "near_duplicates":
            want = components(list(before.items()), 5, 80)
            assert set(texts) == {i for i, t in before.items() if not want[i, t][0] or want[i, t][1] == i}
        elif name == "suffix_dedup":
            order = sorted(before)
            sizes = removed([before[i] for i in order], 100)
            assert set(texts) == set(before)
            assert all(len(texts[i].encode()) in range(n - gone - 8 * runs, n - gone + 1) for i, (n, gone, runs, _) in zip(order, sizes, strict=True))
        elif name == "secret_scan":
            assert set(texts) == set(before) and not any(r["found"] for r in secrets.find_secrets(after, secrets.BASE_RULES).collect())
        now = after
    assert now.agg(F.sum("length")).first()[0] == now.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]


@pytest.mark.parametrize("rows,left", [
    ([], 0), ([(None, None, None, None, None)] * 3, 1), ([(1, "hello world", None, "s", 11)], 1),
    ([(1, "", None, None, 0), (2, " ", None, None, 1), (2, " ", None, None, 1)], 2),
])
def test_pipeline_on_odd_tables(spark, sf_dir, tmp_path, rows, left):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == left


def test_rare_words_keep_counts_of_their_own(spark):
    """More words than one in 65 000: each is counted as itself, with few of many words as with many of few."""
    often = [(k, "common " * 1000) for k in range(300)]
    some = [*often, (1000, "zq1 zq2 zq3"), (1001, "zq1 zq2"), (1002, "zq4 zq5")]
    got = {r["doc_id"]: r["score"] for r in lm.score(table(spark, some), lm.train(table(spark, some), 1)).collect()}
    total = 300_000 + 7
    assert abs(got[1002] - math.log10(1 / total)) < 1e-7
    assert abs(got[1001] - math.log10(2 / total)) < 1e-7


def test_words_of_many_slices_add_up(spark, rows, docs, monkeypatch):
    monkeypatch.setattr(lm, "TOGETHER", 2000)
    want = backoff_scores(rows, 3, lm.LEAST, lm.BACKOFF)
    key = lambda r: (str(r[0]), r[1], r[2] or 0)
    for asking in (docs, docs.select("*")):  # the corpus itself, and a table like any other
        got = lm.score(asking, lm.train(docs, 3)).collect()
        for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
            assert a[:2] == b[:2] and (a[2] is None or abs(a[2] - b[2]) < 1e-7)


def test_ngrams_seen_once_count(spark):
    """Of three words and of two, those seen once as well: the registered query backs off only from what no document has."""
    some = [(1, "a b c"), (2, "a b d"), (3, "e f")]
    docs = table(spark, some)
    got = {r["doc_id"]: r["score"] for r in lm.score(docs, lm.train(docs)).collect()}
    a, e = math.log10(2 / 8), math.log10(1 / 8)
    assert abs(got[1] - (a + math.log10(2 / 2) + math.log10(1 / 2)) / 3) < 1e-7
    assert abs(got[3] - (e + math.log10(1 / 1)) / 2) < 1e-7


def test_repeats_are_found_however_later_scans_are_cut(spark):
    """A copy left out beside its original is a repeat even if the next scan has smaller batches."""
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefghij ") for _ in range(300))
    spans = repeats.repeated_spans(table(spark, [(1, text), (2, text)], parts=1))
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(setting, "1")
    try:
        got = {(r["ord"], r["begin"], r["end"]) for r in spans.collect()}
    finally:
        spark.conf.unset(setting)
    assert got == {(2, 0, 300)}
