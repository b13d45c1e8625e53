"""More change-log behaviour: schema evolution in the upsert, restricted snapshots, history, overwrite."""

from pyspark.sql import functions as F

from strata.operators import merge as M
from strata.sources import changelog as CL


def test_upsert_adds_new_columns(spark):
    first = spark.createDataFrame([("1", "a")], "_id string, v string")
    target = M.upsert_by_hash(None, first, "_id", as_of="2024-01-01 00:00:00").table
    second = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y")], "_id string, v string, extra string")
    out = M.upsert_by_hash(target, second, "_id", as_of="2024-02-01 00:00:00").table
    assert "extra" in out.columns
    rows = {r._id: (r.v, r.extra) for r in out.collect()}
    assert rows == {"1": ("a", "x"), "2": ("b", "y")}  # a new non-null column changes the content hash


def test_snapshot_restricted_to_keys(spark, scratch):
    root = scratch("restrict")
    df = spark.createDataFrame([(i, f"v{i}") for i in range(10)], "id long, v string")
    CL.commit(spark, CL.as_changes(df, 0).drop("_commit_version"), root, operation="WRITE")
    upd = spark.createDataFrame([(3, "new")], "id long, v string")
    CL.commit(spark, CL.as_changes(upd, 1, "update_postimage").drop("_commit_version"), root, operation="MERGE")
    keys = spark.createDataFrame([(3,), (4,)], "id long")
    got = sorted(tuple(r) for r in CL.snapshot_at(spark, root, "id", only_keys=keys).collect())
    assert got == [(3, "new"), (4, "v4")]


def test_history_reports_operations(spark, scratch):
    root = scratch("hist")
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    CL.commit(spark, CL.as_changes(df, 0).drop("_commit_version"), root, operation="WRITE")
    CL.commit(spark, CL.as_changes(df, 1, "delete").drop("_commit_version"), root, operation="DELETE")
    h = [(r.version, r.operation, r.num_delete) for r in CL.history(CL.read_log(spark, root)).collect()]
    assert h == [(1, "DELETE", 1), (0, "WRITE", 0)]


def test_overwrite_is_a_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "id long, v string")
    ch = CL.overwrite_changes(old, new, "id")
    got = sorted((r.id, r.v, r._change_type) for r in ch.collect())
    assert got == [(1, "a", "delete"), (2, "B", "update_postimage"), (2, "b", "update_preimage"), (3, "c", "insert")]
    after = M.apply_changes(old, ch.withColumn("_commit_version", F.lit(1)), "id").table
    assert sorted(tuple(r) for r in after.collect()) == [(2, "B"), (3, "c")]


def test_large_limit_is_distributed_and_exact(spark):
    from strata.operators import relational as R

    df = spark.range(0, 600_000, 3).withColumnRenamed("id", "k")
    big = R.top_rows(df, ["k"], 150_000)
    assert "TakeOrderedAndProject" not in big._jdf.queryExecution().executedPlan().toString()
    got = big.agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("mx")).first()
    assert (got.n, got.mx) == (150_000, 449_997)
    small = R.top_rows(df, ["k"], 5)
    assert [r.k for r in small.collect()] == [0, 3, 6, 9, 12]
