"""Streaming: two-step resume from one checkpoint, empty reruns, replay safety."""

from pyspark.sql import functions as F

from strata.plans.fixtures import f1_change_log
from strata.plans.q_streaming import commit_versions
from strata.sources import changelog as CL
from strata.streaming import cdf

from conftest import SMALL


def test_resume_and_empty_rerun(spark, scratch):
    root = scratch("stream")
    log = f1_change_log(spark, SMALL)
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    commit_versions(spark, log, bronze, [0])
    v = cdf.seed_silver(spark, bronze, silver, "o_orderkey", {"summary": "string"})
    cfg = cdf.StreamConfig(bronze, silver, f"{root}/ckpt", "t", starting_version=v + 1)
    flt = cdf.default_filter()
    commit_versions(spark, log, bronze, [1])
    cdf.run_stream(spark, cfg, "o_orderkey", change_filter=flt, columns=["o_orderkey", "o_custkey", "o_orderstatus",
                                                                          "o_totalprice", "o_orderdate", "o_orderpriority"])
    after1 = CL.committed_versions(spark, silver)
    assert len(after1) == 2
    q = cdf.run_stream(spark, cfg, "o_orderkey", change_filter=flt)  # nothing new: no commit
    assert CL.committed_versions(spark, silver) == after1
    assert cdf.progress(q)["rows"] in (None, 0)
    commit_versions(spark, log, bronze, [2, 3])
    cdf.run_stream(spark, cfg, "o_orderkey", change_filter=flt)
    final = CL.snapshot(CL.read_log(spark, silver), "o_orderkey")
    expect = CL.snapshot(log, "o_orderkey")
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    assert sorted(map(tuple, final.select(cols).collect())) == sorted(map(tuple, expect.select(cols).collect()))
    assert final.where(F.col("summary").isNotNull()).count() == 0


def test_replayed_batch_is_skipped(spark, scratch):
    root = scratch("replay")
    log = f1_change_log(spark, SMALL)
    commit_versions(spark, log, f"{root}/bronze", [0])
    cdf.seed_silver(spark, f"{root}/bronze", f"{root}/silver", "o_orderkey", {})
    cfg = cdf.StreamConfig(f"{root}/bronze", f"{root}/silver", f"{root}/ckpt", "r")
    batch = log.where(F.col("_commit_version") == 1)
    assert cdf.merge_batch(spark, batch, 7, cfg, "o_orderkey") == 1
    assert cdf.merge_batch(spark, batch, 7, cfg, "o_orderkey") is None  # same (query, batch) again
    assert cdf.merge_batch(spark, batch.limit(0), 8, cfg, "o_orderkey") is None  # empty batch


def _rows(spark, ids, name):
    return spark.createDataFrame([(i, name, "insert") for i in ids], "k long, name string, _change_type string")


def _target(spark, path):
    CL.commit(spark, _rows(spark, [], ""), path, operation="CREATE")


def test_two_unnamed_streams_share_a_target(spark, scratch):
    root = scratch("two")
    _target(spark, f"{root}/t")
    for name, k in (("a", 1), ("b", 2)):
        CL.commit(spark, _rows(spark, [k], name), f"{root}/{name}")
        cdf.run_stream(spark, cdf.StreamConfig(f"{root}/{name}", f"{root}/t", f"{root}/ck-{name}"), "k")
    state = CL.snapshot(CL.read_log(spark, f"{root}/t"), "k").select("k", "name")
    assert sorted(map(tuple, state.collect())) == [(1, "a"), (2, "b")]


def test_fresh_checkpoint_under_an_old_query_name(spark, scratch):
    root = scratch("fresh")
    _target(spark, f"{root}/t")
    CL.commit(spark, _rows(spark, [1], "a"), f"{root}/s")
    cdf.run_stream(spark, cdf.StreamConfig(f"{root}/s", f"{root}/t", f"{root}/ck1", "same"), "k")
    CL.commit(spark, _rows(spark, [2], "b"), f"{root}/s")
    cdf.run_stream(spark, cdf.StreamConfig(f"{root}/s", f"{root}/t", f"{root}/ck2", "same", starting_version=1), "k")
    state = CL.snapshot(CL.read_log(spark, f"{root}/t"), "k").select("k", "name")
    assert sorted(map(tuple, state.collect())) == [(1, "a"), (2, "b")]


def test_each_stream_keeps_its_own_quarantine(spark, scratch):
    root = scratch("aside")
    _target(spark, f"{root}/t")
    for name in ("qc", "qd"):
        CL.commit(spark, _rows(spark, [None, 5], name), f"{root}/{name}")
        config = cdf.StreamConfig(f"{root}/{name}", f"{root}/t", f"{root}/ck-{name}", name)
        cdf.run_stream(spark, config, "k")
        cdf.run_stream(spark, config, "k")  # nothing new
    aside = spark.read.parquet(cdf.quarantine_root(f"{root}/t"))
    assert sorted(r.name for r in aside.collect()) == ["qc", "qd"]
    assert aside.select("stream").distinct().count() == 2
