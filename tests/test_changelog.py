"""Change log storage, merge semantics and metamorphic properties."""

import pytest
from pyspark.sql import functions as F

from strata.operators import merge as M
from strata.operators.relational import change_type_filter, required_columns
from strata.plans.fixtures import f1_change_log
from strata.sources import changelog as CL

from conftest import SMALL


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_commit_is_write_once_and_readable(spark, scratch):
    root = scratch("log")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    assert CL.commit(spark, CL.as_changes(df, 0).drop("_commit_version"), root) == 0
    with pytest.raises(Exception):
        CL.commit(spark, CL.as_changes(df, 0).drop("_commit_version"), root, version=0)
    assert CL.committed_versions(spark, root) == [0]
    assert rows(CL.snapshot(CL.read_log(spark, root), "id"), "id", "v") == [(1, "a"), (2, "b")]


def test_snapshot_replays_stored_snapshot(spark, scratch):
    root = scratch("log-snap")
    log = f1_change_log(spark, SMALL)
    for v in range(4):
        CL.commit(spark, log.where(F.col("_commit_version") == v), root, version=v)
    CL.write_snapshot(spark, root, "o_orderkey", 1)
    direct = CL.snapshot(CL.read_log(spark, root), "o_orderkey")
    stored = CL.snapshot_at(spark, root, "o_orderkey")
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    assert rows(direct, *cols) == rows(stored, *cols)


def test_apply_diff_roundtrip(spark):
    # apply(snapshot_diff(a, b), a) == b
    log = f1_change_log(spark, SMALL)
    a = CL.snapshot(log, "o_orderkey", as_of=0)
    b = CL.snapshot(log, "o_orderkey")
    diff = M.snapshot_diff(a, b, "o_orderkey")
    got = M.apply_changes(a, diff, "o_orderkey").table
    assert rows(got, *b.columns) == rows(b, *b.columns)


def test_latest_snapshot_equals_applying_all_changes(spark):
    log = f1_change_log(spark, SMALL)
    empty = CL.snapshot(log, "o_orderkey").limit(0)
    applied = M.apply_changes(empty, log, "o_orderkey").table
    latest = CL.snapshot(log, "o_orderkey")
    assert rows(applied, *latest.columns) == rows(latest, *latest.columns)


def test_null_keys_never_match(spark):
    target = spark.createDataFrame([(None, "t")], "id long, v string")
    changes = spark.createDataFrame([(None, "s", "insert", 1)], "id long, v string, _change_type string, _commit_version long")
    out = M.apply_changes(target, changes, "id").table
    assert out.count() == 2  # '=' on NULL keys: the source row is inserted again
    out_ns = M.apply_changes(target, changes, "id", null_safe=True).table
    assert rows(out_ns, "v") == [("s",)]


def test_change_type_filter_validation(spark):
    df = spark.createDataFrame([("insert",)], "_change_type string")
    with pytest.raises(ValueError):
        change_type_filter(df, [])
    with pytest.raises(ValueError):
        change_type_filter(df, ["insert", "upsert"])


def test_required_columns_rules(spark):
    df = spark.createDataFrame([("insert", " ", 1), ("delete", None, None), ("insert", "x", 2), ("insert", "y", None)],
                               "_change_type string, s string, n long")
    assert rows(required_columns(df, ["s", "n"]), "_change_type", "s") == [("delete", None), ("insert", "x")]
    with pytest.raises(ValueError):
        required_columns(df, [])
    with pytest.raises(KeyError):
        required_columns(df, ["missing"])


def test_upsert_first_run_creates_and_rerun_is_idempotent(spark):
    src = spark.createDataFrame([("1", "a"), ("2", "b")], "_id string, v string")
    first = M.upsert_by_hash(None, src, "_id", as_of="2024-01-01 00:00:00").table
    again = M.upsert_by_hash(first, src, "_id", as_of="2024-02-01 00:00:00")
    t = again.table.select("_id", F.col("_last_updated_at").cast("string").alias("u")).collect()
    assert sorted((r._id, r.u) for r in t) == [("1", "2024-01-01 00:00:00"), ("2", "2024-01-01 00:00:00")]
