"""Ranked search against scoring every document, and what the block bounds spare."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strata.llm import block_search as B
from strata.sources.tables import read_table
from tests.conftest import SMALL
from tests.llm.cases import LOWER, empty, hostile, prose, rows_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    own = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    n_docs, n_terms = sum(bool(c) for _, c in own), sum(c.total() for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item_id, text in sorted(set(items), key=repr):
        asked = terms(text)
        scores = []
        for doc_id, c in own:
            m = 25 + (75 * c.total() * n_docs) // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                    for t in asked if c[t])
            if s > 0:
                scores.append((-s, doc_id is not None, doc_id or 0, doc_id))
        out += [(item_id, i, x[3], -x[0]) for i, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def pairs(df, key="doc_id"):
    return [(r[key], r.text) for r in df.select(key, "text").collect()]


def test_same_as_brute_force(spark):
    docs, items = read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "benchmark")
    expected = brute(pairs(docs), pairs(items, "item_id"))
    assert rows_of(B.search(docs, items)) == expected
    assert rows_of(B.search(docs, items, shard_docs=40, block=4)) == expected


def test_hostile_rows(spark, monkeypatch):
    docs = hostile(spark)
    docs = docs.withColumn("query", F.lit(1)).withColumn("score", F.lit("s")).withColumn("rank", F.lit(2)).withColumn("shard", F.lit(0))
    asked = [(1, prose(1, 60)), (2, "one"), (2, "one"), (3, None), (4, ""), (5, "la la LA the"), (6, "no-such-term"), (None, "two w1"),
             (2, "é ü w5 w5"), (7, prose(2, 4000)), (8, "x" * 50_000), (9, "\u0085a b c")]
    items = spark.createDataFrame(asked, "item_id long, text string")
    expected = brute(pairs(docs), asked)
    assert rows_of(B.search(docs, items, shard_docs=16, block=2)) == expected
    monkeypatch.setattr(B, "QUERIES", 3)
    assert rows_of(B.search(docs, items)) == expected
    assert B.search(empty(spark), items).count() == 0
    assert B.search(docs, items.limit(0)).count() == 0


def test_ties_go_by_id(spark):
    docs = spark.createDataFrame([(i * 7 % 50, "same words here") for i in range(50)] + [(99, "other")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "words"), (2, "same here")], "item_id long, text string")
    got = B.search(docs, items, shard_docs=16, block=4).orderBy("item_id", "rank").collect()
    assert [r.doc_id for r in got] == [*range(10), *range(10)]


def test_blocks_of_other_topics_are_skipped():
    """Topics share a common word; their blocks of its list are skipped, and no result changes."""
    r = random.Random(3)
    texts = [" ".join(["common"] + [f"t{i % 8}w{r.randrange(40)}" for _ in range(30)]) for i in range(800)]
    vocabulary = sorted({t for x in texts for t in x.split()})
    place = {t: i for i, t in enumerate(vocabulary)}
    counts = [Counter(place[t] for t in x.split()) for x in texts]
    rows = [np.array(sorted(c), dtype="<u2") for c in counts]
    tf = [np.array([c[t] for t in sorted(c)], dtype="<u4") for c in counts]
    df = np.bincount(np.concatenate(rows), minlength=len(vocabulary))
    corpus = B.Corpus(800, 800 * 31, df)
    row = dict(zip(B._INDEX_FIELDS[1:], B.shard_row(list(range(800)), np.full(800, 31), rows, tf, corpus, corpus.weights(), 10),
                   strict=True))
    shard = B.Shard(row, len(vocabulary))
    weights = corpus.weights()
    for _ in range(20):
        topic = r.randrange(8)
        asked = sorted({place[f"t{topic}w{r.randrange(40)}"] for _ in range(3)} | {place["common"]})
        asked, w = np.array(asked), weights[asked]
        scores = shard.vectors[:, asked].astype(np.int64) @ w
        best = sorted(((-s, d) for d, s in enumerate(scores.tolist()) if s > 0))[:10]
        assert shard.best(asked, w, 10, 0) == [(-s, d) for s, d in best]
    few = shard.scored
    assert few < 20 * 800 / 4
    # The common word asked so often that its list comes first: only its blocks of the topic can win.
    w = np.where(asked == place["common"], 10 ** 6, w)
    scores = shard.vectors[:, asked].astype(np.int64) @ w
    best = sorted(((-s, d) for d, s in enumerate(scores.tolist()) if s > 0))[:10]
    shard.skipped = 0
    assert shard.best(asked, w, 10, 0) == [(-s, d) for s, d in best]
    assert shard.skipped > 20 and shard.scored - few < 800 / 2
