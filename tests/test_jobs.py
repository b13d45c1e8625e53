"""A configured job set runs sync -> stream -> decorate end to end."""

import pytest
from pyspark.sql import functions as F

from strata.plans import jobs as J
from strata.plans.jobs import run_jobs, with_defaults
from strata.sources import changelog as CL
from strata.sources.collection import write_events_collection

from conftest import SMALL


def test_defaults_and_absent_sections(spark):
    assert with_defaults("decorate", {"table": "t"})["limit"] is None  # a cap is configured, never assumed
    assert run_jobs(spark, {}) == []


def test_job_set_end_to_end(spark, scratch):
    root = scratch("jobs")
    coll = write_events_collection(spark, SMALL, f"{root}/collection")
    cfg = {
        "sync": [{"source": coll, "target": f"{root}/bronze", "partition_ts": "ts", "json_columns": ["props"]}],
        "streams": [{"source": f"{root}/bronze", "target": f"{root}/silver", "checkpoint": f"{root}/ckpt"}],
        "decorate": [{"table": f"{root}/silver", "limit": 50, "text": "event_type"}],
    }
    out = run_jobs(spark, cfg)
    assert [o["job"] for o in out] == ["sync", "stream", "decorate"]
    silver = CL.snapshot(CL.read_log(spark, f"{root}/silver"), "_id")
    n = spark.read.json(coll).count()
    assert silver.count() == n
    assert silver.where(F.col("summary").isNotNull()).count() == 50  # one run decorates at most `limit` rows
    bronze = spark.read.parquet(CL.version_path(f"{root}/bronze", 0))
    assert {"year", "month"} <= set(bronze.columns) and out[0]["residual"].count() == 0
    more = run_jobs(spark, {"decorate": [
        {"table": f"{root}/silver", "decorator": d, "text": "event_type", "metrics": f"{root}/metrics"}
        for d in ("summary", "ner_nel", "embeddings")]})
    assert [(o["pending"], o["succeeded"]) for o in more] == [(n - 50, n - 50), (n, n), (n, n)]
    silver = CL.snapshot_at(spark, f"{root}/silver", "_id")
    for c in ("summary", "ner_nel", "text_embedding_dense", "text_embedding_sparse", "summary_embedding_dense"):
        assert silver.where(F.col(c).isNull()).count() == 0, c
    counts = {(r.stream, r.metric, r.label): r.value for r in spark.read.parquet(f"{root}/metrics").collect()}
    assert counts["ner_nel", "pending", None] == n == counts["ner_nel", "decorated", "succeeded"]


def test_dry_run_and_upsert_leave_the_source_alone(spark, scratch):
    root = scratch("jobs")
    coll = write_events_collection(spark, SMALL, f"{root}/collection")
    n = spark.read.json(coll).count()
    out = run_jobs(spark, {"sync": [
        {"source": coll, "target": f"{root}/bronze", "dry_run": True},
        {"source": coll, "target": f"{root}/bronze", "mode": "upsert", "key": "_id", "json_columns": ["props"]}]})
    assert out[0] == {"job": "sync", "rows": n, "version": None, "dry_run": True}
    assert out[1] == {"job": "sync", "version": 0}
    assert CL.snapshot_at(spark, f"{root}/bronze", "_id").count() == n


def test_replay_is_seen_behind_another_writers_commit(spark, scratch):
    root = scratch("log")
    df = CL.as_changes(spark.range(3).withColumnRenamed("id", "k"), 0).drop(CL.VERSION, CL.COMMIT_TS)
    CL.commit(spark, df, root, batch_ref="s:0")
    CL.commit(spark, df, root, batch_ref="s:1")
    CL.commit(spark, df, root, operation="DECORATE")
    assert CL.batch_seen(spark, root, "s:1") and not CL.batch_seen(spark, root, "s:2") and not CL.batch_seen(spark, root, "t:1")


def test_a_model_fails_row_by_row_and_a_run_without_success_fails(spark, scratch):
    def shout(pdf):
        if pdf["text"].str.contains("bad").any():
            raise ValueError("refused")
        return pdf.assign(summary=pdf["text"].str.upper())[["summary"]]

    root = scratch("model")
    rows = [(i, f"text {i}" if i % 4 else f"bad {i}", None, "insert") for i in range(12)]
    CL.commit(spark, spark.createDataFrame(rows, "_id long, text string, summary string, _change_type string"), f"{root}/t")
    job = {"table": f"{root}/t", "model": shout, "schema": "summary string", "batch_rows": 5, "metrics": f"{root}/m"}
    done = J.run_jobs(spark, {"decorate": [job]})[0]
    assert (done["pending"], done["succeeded"], done["failed"]) == (12, 9, 3)
    state = {r._id: r.summary for r in CL.snapshot_at(spark, f"{root}/t", "_id").collect()}
    assert state == {i: None if i % 4 == 0 else f"TEXT {i}" for i in range(12)}
    versions = CL.committed_versions(spark, f"{root}/t")
    with pytest.raises(J.DecorationFailed, match="none of 3 pending"):  # only the refused ones are left
        J.run_jobs(spark, {"decorate": [job]})
    assert CL.committed_versions(spark, f"{root}/t") == versions
    counts = {(r.label, r.value) for r in spark.read.parquet(f"{root}/m").where("metric = 'decorated'").collect()}
    assert counts == {("succeeded", 9.0), ("failed", 3.0), ("succeeded", 0.0)}
