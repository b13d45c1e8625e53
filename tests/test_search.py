"""Top-k search against brute force: what the bounds spare, ties, odd weights and vectors."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import similarity as SIM
from strata.operators import vector_search as VS
from strata.operators import decorate as D
from strata.session import materialize
from strata.sources.tables import read_table

from conftest import SMALL


def half_up(x):
    return int(np.floor(x * 1e6 + 0.5))


def brute_sparse(q, d, k):
    by_token = defaultdict(list)
    for doc, token, w in d:
        by_token[token].append((doc, w))
    scores = defaultdict(float)
    for query, token, w in q:
        for doc, v in by_token[token]:
            scores[query, doc] += w * v
    best = defaultdict(list)
    for (query, doc), s in scores.items():
        best[query].append((-half_up(s), doc))
    return sorted((query, doc, r) for query, found in best.items() for r, (_, doc) in enumerate(sorted(found)[:k], 1))


def sparse_rows(spark, rows, key):
    return spark.createDataFrame(rows, f"{key} long, token string, weight double")


@pytest.mark.parametrize("weight", ["tf", "equal", "negative", "zero"])
def test_sparse_topk_is_exact(spark, weight):
    r = random.Random(5)
    make = {"tf": lambda n: r.randrange(1, 9) / n, "equal": lambda n: 0.5, "negative": lambda n: r.randrange(-3, 6) / n,
            "zero": lambda n: r.randrange(0, 2) / n}[weight]

    def rows(n_rows, low, high):
        out = []
        for i in range(n_rows):
            n = r.randrange(low, high)
            out += [(i, f"t{t}", make(n)) for t in {min(int(r.paretovariate(0.6)), 300) for _ in range(n)}]
        return out

    d, q = rows(300, 1, 40), rows(12, 2, 15)
    got = SIM.sparse_dot_topk(sparse_rows(spark, q, "q"), "q", sparse_rows(spark, d, "d"), "d", k=5)
    assert sorted((x.q, x.d, x.rank) for x in got.collect()) == brute_sparse(q, d, 5)


def test_sparse_candidates_are_few(spark):
    q = materialize(D.token_weights(read_table(spark, SMALL, "benchmark"), "item_id", "text").select(
        F.col("item_id").alias("q"), F.col("token").alias("t"), F.col("weight").cast("double").alias("wq")), "q")
    d = D.token_weights(read_table(spark, SMALL, "documents"), "doc_id", "text").select(
        F.col("doc_id").alias("d"), F.col("token").alias("t"), F.col("weight").cast("double").alias("wd"))
    d = materialize(d.join(q.select("t").distinct(), "t", "left_semi"), "d")
    every = q.join(d, "t").select("q", "d").distinct().count()
    assert SIM.sparse_candidates(q, d, 10).count() < every / 3


def test_sparse_maps_and_empty_tables(spark):
    d = spark.createDataFrame([(1, {"a": 0.5, "b": 0.5}), (2, {"a": 1.0}), (3, None), (4, {})], "d long, weights map<string,double>")
    q = spark.createDataFrame([(9, {"a": 1.0, "z": 1.0}), (8, {"z": 1.0})], "q long, weights map<string,double>")
    got = SIM.sparse_dot_topk(q, "q", d, "d", k=3)
    assert sorted(map(tuple, got.collect())) == [(9, 1, 0.5, 2), (9, 2, 1.0, 1)]
    assert SIM.sparse_dot_topk(q.limit(0), "q", d, "d").count() == SIM.sparse_dot_topk(q, "q", d.limit(0), "d").count() == 0


def vectors(spark, x, key="d"):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], f"{key} long, v array<float>")


@pytest.mark.parametrize("measure", ["cosine", "dot"])
def test_dense_topk_skips_clusters_and_is_exact(spark, measure, monkeypatch):
    monkeypatch.setattr(VS, "SHARD_ROWS", 40)
    g = np.random.default_rng(2)
    centres = g.normal(size=(30, 16)) * 5
    x = np.repeat(centres, 40, axis=0) + g.normal(size=(1200, 16)) * 0.2
    x[7] = x[3]  # a tie
    x = x.astype(np.float32).astype(np.float64)
    q = x[::60]
    found, searched = VS.search_clusters(vectors(spark, q, "q"), "q", vectors(spark, x), "d", "v", 5, measure)
    got = VS.dense_query_topk(vectors(spark, q, "q"), "q", vectors(spark, x), "d", "v", 5, measure)
    a, b = (y / np.linalg.norm(y, axis=1, keepdims=True) if measure == "cosine" else y for y in (q, x))
    s = np.floor(a @ b.T * 1e6 + 0.5)
    want = sorted((i, int(j), r) for i in range(len(q)) for r, j in enumerate(np.lexsort((np.arange(1200), -s[i]))[:5], 1))
    assert sorted((r.q, r.d, r.rank) for r in got.collect()) == want  # recall 1
    compared = searched.agg(F.sum("n")).first()[0]
    assert compared < len(q) * len(x) / (4 if measure == "cosine" else 1.2)


def test_dense_odd_vectors(spark):
    d = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (None, [2.0, 0.0])], "d long, v array<float>")
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "q long, v array<float>")
    got = VS.dense_query_topk(q, "q", d, "d", "v", 5)
    assert [tuple(r) for r in got.collect()] == [(1, 1, 1.0, 1)]
    assert VS.dense_query_topk(q, "q", d.limit(0), "d", "v").count() == 0
    assert VS.dense_query_topk(q.limit(0), "q", d, "d", "v").count() == 0


def test_postings_meet_the_queries_in_tasks_of_bounded_size(spark, monkeypatch):
    from pyspark.sql import functions as F
    from strata.operators import similarity as SIM

    rows = [(d, f"t{t}", 1.0 / (1 + (d * 7 + t * 3) % 11)) for d in range(60) for t in range(12) if (d + t) % 3]
    postings = spark.createDataFrame(rows, "d long, t string, wd double")
    q = spark.createDataFrame([(i, f"t{t}", 0.5 + i) for i in range(3) for t in range(i, 12, 2)], "q long, t string, wq double")
    monkeypatch.setattr(SIM, "TASK_POSTINGS", 100, raising=False)
    pairs = SIM.sparse_candidates(q, postings, 3)
    assert "REPARTITION_BY_NUM" in pairs._jdf.queryExecution().executedPlan().toString()
    best = {}
    for r in q.join(postings, "t").groupBy("q", "d").agg(F.round(F.sum(F.col("wq") * F.col("wd")), 6).alias("s")).collect():
        best.setdefault(r.q, []).append((-r.s, r.d))
    few = {(r.q, r.d) for r in pairs.collect()}
    monkeypatch.setattr(SIM, "BROADCAST_TOKENS", 0, raising=False)
    many = {(r.q, r.d) for r in SIM.sparse_candidates(q, postings, 3).collect()}
    assert few == many and {(i, d) for i, s in best.items() for _, d in sorted(s)[:3]} <= few
