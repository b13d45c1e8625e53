"""Streaming queries (S04, T01-T07, Z01): the F1 log is committed version by version into a
bronze change log under the shared folder, streamed, and the result returned as a DataFrame."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.decorate import DECORATOR_COLUMNS
from strata.plans.fixtures import F1_FINAL_SQL, F1_SQL, ORDER_COLS, f1_change_log
from strata.plans.registry import query
from strata.session import scratch_path
from strata.sources import changelog as CL
from strata.sources.tables import read_table
from strata.streaming import cdf

META = ["_change_type", "_commit_version", "_commit_timestamp"]
DECOR_SQL = ", ".join(f"CAST(NULL AS {'VARCHAR' if t == 'string' else 'FLOAT[]' if t == 'array<float>' else 'MAP(VARCHAR, FLOAT)'}) AS {n}"
                      for n, t in DECORATOR_COLUMNS.items())


def commit_versions(spark, log, root, versions):
    """Write F1 versions into a change log, keeping their commit times."""
    for v in versions:
        part = log.where(F.col("_commit_version") == v)
        CL.commit(spark, part, root, version=v, operation="WRITE")


def _collect(spark, config, transform=None, change_filter=None):
    """Run the change stream into a plain append table (K07 sink) and read it back."""
    out = config.target

    def sink(batch, batch_id):
        if not batch.isEmpty():
            batch.write.mode("append").parquet(out)

    stream = cdf.read_change_stream(spark, config)
    stream = (transform or cdf.identity)(stream)
    if change_filter is not None:
        stream = change_filter(stream)
    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", config.checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


@query("cdf_stream", f"WITH {F1_SQL} SELECT * FROM f1 WHERE _commit_version >= 1")
def cdf_stream(spark, sf_dir):
    root = scratch_path(spark, "cdf-stream")
    commit_versions(spark, f1_change_log(spark, sf_dir), f"{root}/bronze", range(4))
    cfg = cdf.StreamConfig(f"{root}/bronze", f"{root}/out", f"{root}/ckpt", "cdf_stream", starting_version=1)
    return _collect(spark, cfg).select(*ORDER_COLS, *META)


@query("cdf_transform", f"""WITH {F1_SQL} SELECT {', '.join(ORDER_COLS)}, o_totalprice / 1000.0 AS price_k, {', '.join(META)}
FROM f1 WHERE _commit_timestamp >= TIMESTAMP '2024-01-01 02:00:00' AND _change_type IN ('insert', 'delete')""")
def cdf_transform(spark, sf_dir):
    root = scratch_path(spark, "cdf-transform")
    commit_versions(spark, f1_change_log(spark, sf_dir), f"{root}/bronze", range(4))
    cfg = cdf.StreamConfig(f"{root}/bronze", f"{root}/out", f"{root}/ckpt", "cdf_transform",
                           starting_timestamp="2024-01-01 02:00:00")

    def add_price_k(df):
        # No rounding: the engines round ties differently (decimal text vs binary double).
        return df.withColumn("price_k", F.col("o_totalprice") / 1000.0)

    out = _collect(spark, cfg, add_price_k, cdf.default_filter(["insert", "delete"]))
    return out.select(*ORDER_COLS, "price_k", *META)


@query("seed_silver", f"""WITH {F1_SQL}, r AS (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY _commit_version DESC,
    CASE _change_type WHEN 'update_preimage' THEN 0 WHEN 'insert' THEN 1 WHEN 'update_postimage' THEN 2 ELSE 3 END DESC) AS rn
  FROM f1 WHERE _commit_version <= 1 AND _change_type <> 'update_preimage')
SELECT {', '.join(ORDER_COLS)}, {DECOR_SQL} FROM r WHERE rn = 1 AND _change_type <> 'delete'""")
def seed_silver(spark, sf_dir):
    root = scratch_path(spark, "seed")
    commit_versions(spark, f1_change_log(spark, sf_dir), f"{root}/bronze", range(2))
    cdf.seed_silver(spark, f"{root}/bronze", f"{root}/silver", "o_orderkey", DECORATOR_COLUMNS)
    return CL.snapshot(CL.read_log(spark, f"{root}/silver"), "o_orderkey")


def bronze_to_silver_run(spark, sf_dir, root):
    """Z01 in two steps sharing one checkpoint (F3): v0..v1, then v2..v3, then a run with nothing new."""
    log = f1_change_log(spark, sf_dir)
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    commit_versions(spark, log, bronze, [0])
    seeded = cdf.seed_silver(spark, bronze, silver, "o_orderkey", DECORATOR_COLUMNS)
    cfg = cdf.StreamConfig(bronze, silver, f"{root}/ckpt", "bronze_to_silver", starting_version=seeded + 1)
    source_cols = [c for c in CL.data_columns(CL.read_log(spark, bronze)) if c not in DECORATOR_COLUMNS]
    flt = cdf.default_filter(["insert", "update_postimage", "delete"])
    for step in ([1], [2, 3], []):
        commit_versions(spark, log, bronze, step)
        cdf.run_stream(spark, cfg, "o_orderkey", change_filter=flt, columns=source_cols,
                       metrics_path=f"{root}/metrics", runs_path=f"{root}/runs")
    return CL.snapshot(CL.read_log(spark, silver), "o_orderkey")


@query("bronze_to_silver", f"WITH {F1_FINAL_SQL} SELECT *, {DECOR_SQL} FROM f1_final")
def bronze_to_silver(spark, sf_dir):
    return bronze_to_silver_run(spark, sf_dir, scratch_path(spark, "b2s"))


@query("stream_runs", f"""WITH {F1_SQL}, c AS (SELECT CASE WHEN _commit_version = 1 THEN 1 ELSE 2 END AS run, _commit_version AS v FROM f1
  WHERE _commit_version >= 1 AND _change_type <> 'update_preimage')
SELECT CAST(run AS INTEGER) AS run, CAST(min(v) AS BIGINT) AS start_version, CAST(max(v) AS BIGINT) AS end_version, count(*) AS rows
FROM c GROUP BY run UNION ALL SELECT 3, NULL, NULL, 0""")
def stream_runs(spark, sf_dir):
    # What each run of the bronze-to-silver stream merged; the third found nothing new.
    root = scratch_path(spark, "runs")
    bronze_to_silver_run(spark, sf_dir, root)
    runs = spark.read.parquet(f"{root}/runs")
    order = Window.partitionBy("query_name").orderBy("ts")  # a row per run
    return runs.select(F.row_number().over(order).alias("run"), "start_version", "end_version", "rows")


@query("stream_metrics", f"""WITH {F1_SQL}, b AS (SELECT _commit_version >= 2 AS late, _change_type AS t FROM f1
  WHERE _commit_version >= 1 AND _change_type <> 'update_preimage')
SELECT 'batch_rows' AS metric, CAST(NULL AS VARCHAR) AS label, CAST(count(*) AS DOUBLE) AS value FROM b GROUP BY late
UNION ALL SELECT 'processed', t, CAST(count(*) AS DOUBLE) FROM b GROUP BY late, t
UNION ALL SELECT 'batches', 'succeeded', 1.0 FROM b GROUP BY late""")
def stream_metrics(spark, sf_dir):
    # The counts that the two batches of the stream left, observed as they passed.
    root = scratch_path(spark, "stream-metrics")
    bronze_to_silver_run(spark, sf_dir, root)
    rows = spark.read.parquet(f"{root}/metrics")
    return rows.where("metric IN ('batch_rows', 'processed', 'batches')").select("metric", "label", "value")


@query("stream_null_keys", """SELECT CASE WHEN c_custkey % 7 = 0 THEN 'quarantined' ELSE 'merged' END AS fate, c_name,
  c_mktsegment || CASE WHEN c_custkey % 7 > 0 AND c_custkey % 3 = 0 THEN '-NEW' ELSE '' END AS c_mktsegment FROM customer""")
def stream_null_keys(spark, sf_dir):
    # Rows without a key are set aside; the others are inserted and, a commit later, updated.
    root = scratch_path(spark, "null-keys")
    c = read_table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 7 > 0, F.col("c_custkey")).alias("c_custkey"), "c_name", "c_mktsegment")
    CL.commit(spark, c.withColumn(CL.CHANGE_TYPE, F.lit("insert")), f"{root}/bronze")
    config = cdf.StreamConfig(f"{root}/bronze", f"{root}/silver", f"{root}/checkpoint", "null-keys")
    CL.commit(spark, c.limit(0).withColumn(CL.CHANGE_TYPE, F.lit("insert")), f"{root}/silver", operation="CREATE")
    cdf.run_stream(spark, config, "c_custkey")
    new = c.where(F.col("c_custkey") % 3 == 0).withColumn("c_mktsegment", F.concat("c_mktsegment", F.lit("-NEW")))
    CL.commit(spark, new.withColumn(CL.CHANGE_TYPE, F.lit("update_postimage")), f"{root}/bronze")
    cdf.run_stream(spark, config, "c_custkey")
    merged = CL.snapshot_at(spark, f"{root}/silver", "c_custkey").select(F.lit("merged").alias("fate"), "c_name", "c_mktsegment")
    aside = spark.read.parquet(cdf.quarantine_root(f"{root}/silver"))
    return merged.unionByName(aside.select(F.lit("quarantined").alias("fate"), "c_name", "c_mktsegment"))
