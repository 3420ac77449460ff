"""WARC archives, embeddings, components, the pipeline and the registered names."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from rollcall.llm import embedding_dedup, queries, warc
from rollcall.llm.support import Scratch, components

SMALL = "/root/testdata/sf0.001"


def test_archives_round_trip(spark):
    big, other = "x\r\n\r\n" * 400, "é" * 600
    rows = [
        (1, "http://b.org/p?z=1&a=2", big), (7, "https://www.A.org/", big), (3, "http://b.org/p", other), (4, None, None),
        (5, "bad url\r\nX: y", ""), (6, "http://c.org/", "short"), (8, "http://c.org/", "short"), (None, "http://b.org/", big), (7, "http://d.org", big),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS place", "2 AS run", "3 AS keep")
    out = warc.archived(pages).collect()
    assert len(out) == len(rows)
    got = sorted(((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in out))
    assert got == [
        (0, "revisit", 7, 2000), (1, "revisit", 7, 2000), (3, "response", None, 1200), (4, "response", None, 0), (5, "response", None, 0),
        (6, "response", None, 5), (7, "response", None, 2000), (7, "response", None, 2000), (8, "response", None, 5),
    ]
    assert {r.payload_digest for r in out if r.page_id in (1, 7)} == {hashlib.sha1(big.encode()).hexdigest()}
    order = [warc.order_key((r.url_key, r.captured_at, r.page_id)) for r in sorted(out, key=lambda r: (r.range_no, r.place))]
    assert order == sorted(order)
    assert warc.archived(pages.limit(0)).count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 5, 8, 13])
def test_loser_tree_merges(k):
    rng = random.Random(k)
    sources = [sorted(((rng.randint(0, 9),), (i, j)) for j in range(rng.randint(0, 12))) for i in range(k)]
    got = list(warc.LoserTree([iter(s) for s in sources]))
    want = sorted((key, row) for s in sources for key, row in s)
    assert [r for _, r in want] == got


def test_url_keys_sort_sites_together():
    assert warc.url_key("http://www.B.org:80/X?b=1&a=2") == "org,b)/x?a=2&b=1"
    assert warc.url_key("http://m.b.org:81") == "org,b,m:81)/" and warc.url_key("http://[bad") == "http://[bad"


def test_embeddings_equal_brute_force(spark):
    rng = np.random.Generator(np.random.PCG64(1))
    centers = rng.normal(size=(60, 16))
    x = np.concatenate([c + 0.12 * rng.normal(size=(n, 16)) for c, n in zip(centers, [300, 40, 12] + [2] * 57, strict=True)])
    x = np.concatenate([x, x[:5], rng.normal(size=(400, 16))])
    ids = rng.permutation(len(x)).tolist()
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)]
    odd = [(9001, None), (9002, []), (9003, [0.0] * 16), (9004, [float("nan")] * 16), (9005, [1.0, None]), (9006, [1.0, 2.0]), (9007, [2.0, 4.0]), (None, [1.0, 2.0])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "1 AS id", "2 AS unit", "3 AS links")
    out = {r.vec_id: r for r in embedding_dedup.near_duplicates(frame).collect()}
    y = x / np.linalg.norm(x, axis=1)[:, None]
    near = y @ y.T >= 0.9
    truth = near.sum(axis=1) - 1
    found = np.array([out[i].n_links for i in ids])
    assert (found <= truth).all() and found.sum() >= 0.98 * truth.sum()
    assert all(out[i].n_links == 0 and out[i].component_id == i and out[i].kept for i in range(9001, 9006))
    assert out[9006].n_links == 1 and out[9007].component_id == 9006 and not out[9007].kept and out[None].component_id is None
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_recall_counts_pairs_beside_a_hot_group(spark, monkeypatch):
    """Few trees, no rounds: the links of a hot group are all counted, while many pairs are missed at first."""
    for name, value in (("TREES", 3), ("ROUNDS", 0), ("LEAF", 8)):
        monkeypatch.setattr(embedding_dedup, name, value)
    rng = np.random.Generator(np.random.PCG64(2))
    hot = rng.normal(size=32) + 0.02 * rng.normal(size=(300, 32))
    x = np.repeat(rng.normal(size=(300, 32)), 2, axis=0) + 0.25 * rng.normal(size=(600, 32))
    x = np.concatenate([hot, x])
    y = x / np.linalg.norm(x, axis=1)[:, None]
    truth = (y @ y.T >= 0.9).sum(axis=1) - 1
    rows = [(50 * i, v.tolist()) for i, v in enumerate(x)]
    out = {r.vec_id // 50: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    few = [i for i in range(300, 900) if truth[i]]
    assert len(few) > 300
    assert np.mean([out[i].n_links == truth[i] for i in few]) >= 0.97 and out[0].audit_recall >= 0.97
    assert embedding_dedup.recall_of(np.array([5000, 1, 1]), np.array([5000, 0, 1])) == 0.5
    assert embedding_dedup.recall_of(np.array([0, 0]), np.array([0, 0])) is None


def test_audit_takes_all_widths_in_blocks(spark, monkeypatch):
    """Vectors of two widths, more of them than a block holds; without any link nothing is measured."""
    monkeypatch.setattr(embedding_dedup, "AUDITED", 7)
    rng = np.random.Generator(np.random.PCG64(5))
    rows = [(50 * i, np.repeat(rng.normal(size=(40, 8 if i % 2 else 6)), 1, axis=0)[i % 40].tolist()) for i in range(60)]
    rows += [(50 * i + 1, (np.array(v) * 1.5 + 1e-3).tolist()) for i, v in ((r[0] // 50, r[1]) for r in rows)]
    out = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.audit_recall for r in out} == {1.0} and all(r.n_links >= 1 for r in out)
    alone = [(50 * i, [float(i == k) for k in range(20)]) for i in range(20)]
    out = embedding_dedup.near_duplicates(spark.createDataFrame(alone, "vec_id long, embedding array<double>")).collect()
    assert {r.audit_recall for r in out} == {None} and {r.attempts for r in out} == {1}


def test_links_between_saturated_groups(spark):
    """Pairs of tight groups, each larger than a list, that link with each other."""
    rng = np.random.Generator(np.random.PCG64(3))
    groups = []
    for size in [30] * 12 + [100] * 2:
        a, b = np.linalg.qr(rng.normal(size=(64, 2)))[0].T
        for center in (a, 0.93 * a + (1 - 0.93**2) ** 0.5 * b):
            groups.append(center + 0.002 * rng.normal(size=(size, 64)))
    x = np.concatenate(groups)
    y = x / np.linalg.norm(x, axis=1)[:, None]
    truth = (y @ y.T >= 0.9).sum(axis=1) - 1
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = embedding_dedup.near_duplicates(frame).collect()
    assert all(r.n_links == truth[r.vec_id] for r in out) and sum(r.kept for r in out) == 14


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(300, 299), (299, 300), (7, 7)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df, Scratch(spark, "test")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {299: 299, 300: 299}
    assert got == want
    assert components(df.limit(0), Scratch(spark, "test")).count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_equals_query(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SMALL)
    result = con.execute(queries.SQL[name])
    assert [d[0] for d in result.description] == df.columns
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, result.fetchall()))


def test_pipeline_stages(spark, documents):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, "aa"), (2, text, "aa"), (3, text + " bob@x.org", "aa"), (4, "123", None), (5, None, None), (6, "other text here", "aa"), (None, "no id", "aa")]
    docs, scratch = documents(rows), Scratch(spark, "test")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = scratch.save(stage(spark, docs, ""), name)
        assert out.columns == docs.columns
        docs = out
    assert sorted((r.doc_id or 0, r.text) for r in docs.collect()) == [(0, "no id"), (1, text), (6, "other text here")]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert sorted(r.n_tokens for r in packed) == [2, 3, 60]
    empty = documents([])
    for name, stage in corpus_pipeline.STAGES:
        empty_out = scratch.save(stage(spark, empty, ""), name)
        assert empty_out.count() == 0


def test_registered_names():
    names = set(entry_module.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names and len(queries.QUERIES) == 13
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.SQL) <= set(entry_module.oracle_sql())


def test_release_deletes_scratch_tables(spark, monkeypatch):
    from rollcall.sources import scratch

    monkeypatch.setattr(scratch, "_tables", {})
    table = Scratch(spark, "short").save(spark.range(3), "x")
    assert scratch.release(spark) == 1
    with pytest.raises(Exception):
        table.count()
