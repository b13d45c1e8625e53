"""Line dedup against a brute-force version, its reversibility, and the cuckoo filters."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import line_store as L
from tests.llm.cases import LOWER, empty, hostile, prose, rows_of

BLANK = " \t\n\x0b\x0c\r"


def key(line: str) -> str:
    return line.strip(BLANK).translate(LOWER)


def brute(rows, min_docs):
    """(doc_id, n_lines, n_dropped, text) per row, every row a document."""
    n = Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")})
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not key(x) or n[key(x)] < min_docs]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def corpus(spark):
    shared = ["Terms of use", "  terms OF use\t", "read more", "É accent", ""]
    rows = []
    for i in range(60):
        own = [prose(i, 12), f"only {i}", shared[i % 5], shared[(i * 7) % 5], "everywhere" if i % 3 == 0 else f"group {i % 4}"]
        rows.append((i, "\n".join(own)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_same_as_brute_force(spark, corpus):
    for min_docs in (2, 10, 15):
        state = L.insert(L.empty_state(min_docs), corpus)
        assert rows_of(L.line_report(state, corpus)) == brute(pairs(corpus), min_docs)


def test_hostile_rows(spark):
    docs = hostile(spark)
    docs = docs.union(docs.limit(0)).withColumn("hits", F.lit(1)).withColumn("bucket", F.lit("b")).withColumn("row", F.lit(2))
    state = L.insert(L.empty_state(2), docs)
    assert rows_of(L.line_report(state, docs)) == brute(pairs(docs), 2)
    cleaned = L.clean(state, docs)
    assert cleaned.columns == docs.columns
    assert sorted(map(repr, pairs(cleaned))) == sorted(repr((r[0], r[3])) for r in brute(pairs(docs), 2))
    nothing = L.insert(L.empty_state(2), empty(spark))
    assert nothing.repeated == 0 and L.clean(nothing, empty(spark)).count() == 0
    assert L.line_report(nothing, docs).where("n_dropped > 0").count() == 0


def members(spark, state):
    return sorted((bytes(r.key), r.n_docs) for r in state.counts(spark).collect())


def test_deleting_reverses_inserting(spark, corpus):
    first, second = corpus.where("doc_id < 40"), corpus.where("doc_id >= 40")
    one = L.insert(L.empty_state(10), first)
    both = L.insert(one, second)
    whole = L.insert(L.empty_state(10), corpus)
    assert members(spark, both) == members(spark, whole) and both.repeated == whole.repeated > one.repeated
    assert rows_of(L.line_report(both, corpus)) == brute(pairs(corpus), 10)
    back = L.delete(both, second)
    assert members(spark, back) == members(spark, one)
    assert rows_of(L.line_report(back, corpus)) == rows_of(L.line_report(one, corpus))
    fingerprints = [sorted(np.frombuffer(b"".join(bytes(r.payload) for r in s.filters(spark).collect()), "<u2").tolist())
                    for s in (one, back)]
    assert [x for x in fingerprints[0] if x] == [x for x in fingerprints[1] if x]
    gone = L.delete(back, first)
    assert members(spark, gone) == [] and gone.repeated == 0
    with pytest.raises(ValueError, match="never inserted"):
        L.delete(one, second)


def test_every_way_of_asking_is_the_same(spark, corpus, monkeypatch):
    state = L.insert(L.empty_state(10), corpus)
    expected = rows_of(L.line_report(state, corpus))
    monkeypatch.setattr(L, "BROADCAST_KEYS", 0)
    assert rows_of(L.line_report(state, corpus)) == expected
    monkeypatch.setattr(L, "FILTER_BYTES", 0)
    assert rows_of(L.line_report(state, corpus)) == expected


def test_filters_spare_lookups(spark, corpus):
    state = L.insert(L.empty_state(10), corpus)
    asked = L._asked(state, corpus).count()
    held = sum(len({key(x) for x in text.split("\n")} - {""}) for _, text in pairs(corpus))
    repeated = state.counts(spark).where("n_docs >= 10").select(F.sum("n_docs")).first()[0]
    assert repeated <= asked <= repeated + 2 < held


def test_more_shards_and_fuller_filters(spark, monkeypatch):
    monkeypatch.setattr(L, "SHARD_KEYS", 8)
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.concat(F.lit("line "), F.col("id") % 300).alias("text"))
    few = docs.where("doc_id % 300 < 40")
    small = L.insert(L.empty_state(2), few)
    state = L.insert(small, docs.where("doc_id % 300 >= 40"))
    assert small.shards == 16 and state.shards == 64 and state.repeated == 300
    assert rows_of(L.line_report(state, docs)) == brute(pairs(docs), 2)
    monkeypatch.setattr(L, "SHARD_KEYS", 1 << 16)  # as many shards, so that filters outgrow their room
    state = L.insert(small, docs.where("doc_id % 300 >= 40"))
    assert state.shards == 16 and state.filters(spark).where("payload IS NULL").count() == 0
    assert rows_of(L.line_report(state, docs)) == brute(pairs(docs), 2)


def test_cuckoo_filter():
    r = np.random.default_rng(1)
    keys = r.integers(0, 256, (20_000, 16), dtype=np.uint8)
    lows = L._numbers(keys)[1]
    made = L._filled(lows[:10_000])
    bank = L.FilterBank(16, [(s, made.to_bytes()) for s in range(16)])
    found = bank.contains(keys)
    assert found[:10_000].all() and found[10_000:].mean() < 0.002
    assert all(made.remove(x) for x in lows[:10_000].tolist()) and not made.table.any()
    tight = L.CuckooFilter.sized(1)
    results = [tight.insert(x) for x in lows[:100].tolist()]
    assert not all(results)  # too full: the caller builds a larger one
    assert len(L._filled(lows[:100]).table) * L.SLOTS >= 100
