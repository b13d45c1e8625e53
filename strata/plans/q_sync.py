"""Collection -> bronze queries (S08, K06, K14, U02, Z02, Z03) over the F4 collection and F2 pair."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import merge as M
from strata.operators import sync as SY
from strata.plans.registry import query
from strata.session import scratch_path
from strata.sources import changelog as CL
from strata.sources.collection import read_collection, write_events_collection
from strata.sources.tables import read_table

COLL_COLS = ["_id", "event_id", "ts", "user_id", "event_type", "value", "props", "empty_field", "null_list"]
TS_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"


def _collection(spark, sf_dir, name):
    path = write_events_collection(spark, sf_dir, scratch_path(spark, name))
    return read_collection(spark, path)


@query("collection_scan", f"""SELECT CAST(event_id AS VARCHAR) AS _id, event_id, {TS_SQL} AS ts, user_id, event_type, value,
  CAST(json_extract(props, '$.k') AS BIGINT) AS prop_k, CAST(NULL AS VARCHAR) AS empty_field, [CAST(NULL AS VARCHAR)] AS null_list
FROM events""")
def collection_scan(spark, sf_dir):
    c = _collection(spark, sf_dir, "collection")
    return c.select("_id", "event_id", "ts", "user_id", "event_type", "value", F.col("props.k").alias("prop_k"),
                    F.col("empty_field").cast("string").alias("empty_field"),
                    F.col("null_list").cast("array<string>").alias("null_list"))


SYNCED_AT = "2024-02-01 00:00:00"


@query("sync_append", f"""SELECT CAST(event_id AS VARCHAR) AS _id, event_id, event_type,
  '{{"k":' || CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) || '}}' AS props,
  CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month FROM events""")
def sync_append(spark, sf_dir):
    # Read the collection, derive year/month, JSON columns, write partitioned bronze, read it back.
    src = _collection(spark, sf_dir, "sync-append")
    res = SY.sync_append(src, partition_ts="ts", json_cols=["props"], synced_at=SYNCED_AT)
    bronze = scratch_path(spark, "bronze-append")
    SY.write_bronze(spark, res.rows, bronze, partition_by=["year", "month"])
    back = spark.read.parquet(bronze)
    return back.select("_id", "event_id", "event_type", "props", F.col("year").cast("int").alias("year"),
                       F.col("month").cast("int").alias("month"))


@query("sync_residual", """SELECT CAST(event_id AS VARCHAR) AS _id FROM events ORDER BY _id OFFSET 1000""")
def sync_residual(spark, sf_dir):
    # K14 after a run that may take 1,000 documents (the configured cap): the commit's ids leave the source, the rest stays.
    src = _collection(spark, sf_dir, "sync-residual")
    rows = SY.prepare_batch(src, "ts", ["props"], limit=1000, synced_at=SYNCED_AT)
    root = scratch_path(spark, "residual-bronze")
    version = CL.commit(spark, rows.withColumn(CL.CHANGE_TYPE, F.lit("insert")), root, operation="SYNC", partition_by=("year", "month"))
    return SY.residual_after_commit(spark, src, root, version).select("_id")


T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
CUST_HASH = """sha256('{{"c_custkey":' || CAST({k} AS VARCHAR) || ',"c_mktsegment":"' || {seg} || '","c_name":"' || c_name ||
  '","c_nationkey":' || CAST(c_nationkey AS VARCHAR) || '}}')"""


def _f2(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    k = F.col("c_custkey")
    target = M.upsert_by_hash(None, c, "c_custkey", as_of=T1).table
    same = c.where(k % 3 == 0)
    changed = c.where(k % 3 == 1).withColumn("c_mktsegment", F.concat(F.col("c_mktsegment"), F.lit("-NEW")))
    new = c.where(k % 3 == 2).withColumn("c_custkey", k + 10_000_000)
    dup = c.where(k % 50 == 0).withColumn("c_mktsegment", F.lit("DUP"))
    return target, same.unionByName(changed).unionByName(new).unionByName(dup)


F2_SQL = f"""src AS (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_mktsegment || '-NEW' FROM customer WHERE c_custkey % 3 = 1
  UNION ALL SELECT c_custkey + 10000000, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_custkey % 3 = 2
  UNION ALL SELECT c_custkey, c_name, c_nationkey, 'DUP' FROM customer WHERE c_custkey % 50 = 0),
h AS (SELECT *, {CUST_HASH.format(k='c_custkey', seg='c_mktsegment')} AS hh FROM src),
s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY hh) AS rn FROM h) WHERE rn = 1),
t AS (SELECT *, {CUST_HASH.format(k='c_custkey', seg='c_mktsegment')} AS hh FROM customer)"""


@query("upsert_by_hash", f"""WITH {F2_SQL}
SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey, coalesce(s.c_mktsegment, t.c_mktsegment) AS c_mktsegment,
  CASE WHEN s.c_custkey IS NULL OR s.hh = t.hh THEN t.hh ELSE s.hh END AS _content_hash,
  CASE WHEN s.c_custkey IS NULL THEN TIMESTAMP '{T1}' ELSE TIMESTAMP '{T2}' END AS _last_processed_at,
  CASE WHEN s.c_custkey IS NULL OR s.hh = t.hh THEN TIMESTAMP '{T1}' ELSE TIMESTAMP '{T2}' END AS _last_updated_at
FROM t FULL OUTER JOIN s ON s.c_custkey = t.c_custkey""")
def upsert_by_hash(spark, sf_dir):
    target, source = _f2(spark, sf_dir)
    out = M.upsert_by_hash(target, source, "c_custkey", as_of=T2).table
    return out.select("c_custkey", "c_mktsegment", "_content_hash",
                      F.col("_last_processed_at").cast("timestamp_ntz").alias("_last_processed_at"),
                      F.col("_last_updated_at").cast("timestamp_ntz").alias("_last_updated_at"))


@query("upsert_changes", f"""WITH {F2_SQL}
SELECT _change_type, count(*) AS n FROM (
  SELECT CASE WHEN t.c_custkey IS NULL THEN 'insert' ELSE 'update_postimage' END AS _change_type FROM s LEFT JOIN t ON s.c_custkey = t.c_custkey
  UNION ALL SELECT 'update_preimage' FROM s JOIN t ON s.c_custkey = t.c_custkey) GROUP BY _change_type""")
def upsert_changes(spark, sf_dir):
    target, source = _f2(spark, sf_dir)
    return M.upsert_by_hash(target, source, "c_custkey", as_of=T2).changes.groupBy("_change_type").agg(
        F.count(F.lit(1)).alias("n"))


@query("sync_upsert", f"""SELECT CAST(event_id AS VARCHAR) AS _id,
  CASE WHEN event_id % 3 = 1 THEN value + 1 ELSE value END AS value,
  CASE WHEN ts < TIMESTAMP '2024-01-20 00:00:00' AND event_id % 3 <> 1 THEN TIMESTAMP '{T1}' ELSE TIMESTAMP '{T2}' END
    AS _last_updated_at,
  TIMESTAMP '{T2}' AS _last_processed_at FROM events""")
def sync_upsert(spark, sf_dir):
    # First run creates bronze from the documents seen so far; the second run upserts all of them.
    src = _collection(spark, sf_dir, "sync-upsert")
    first = src.where(F.col("ts") < "2024-01-20T00:00:00")
    created, _ = SY.sync_upsert(None, first, "_id", exclude=["ts"], json_cols=["props"], as_of=T1)
    bronze = scratch_path(spark, "bronze-upsert")
    created.table.write.parquet(bronze)
    second = src.withColumn("value", F.when(F.col("event_id") % 3 == 1, F.col("value") + 1).otherwise(F.col("value")))
    result, _ = SY.sync_upsert(spark.read.parquet(bronze), second, "_id", exclude=["ts"], json_cols=["props"], as_of=T2)
    return result.table.select("_id", "value", F.col("_last_updated_at").cast("timestamp_ntz").alias("_last_updated_at"),
                               F.col("_last_processed_at").cast("timestamp_ntz").alias("_last_processed_at"))


@query("move_late_arrival", "SELECT CAST(event_id AS VARCHAR) AS _id FROM events WHERE event_id % 10 = 0")
def move_late_arrival(spark, sf_dir):
    # What arrives between the write and the clean-up is not in the commit, so it stays in the source.
    everything = _collection(spark, sf_dir, "late")
    early = everything.where(F.col("event_id") % 10 != 0)
    root = scratch_path(spark, "late-bronze")
    rows = SY.prepare_batch(early, None, ["props"])
    version = CL.commit(spark, rows.withColumn(CL.CHANGE_TYPE, F.lit("insert")), root, operation="SYNC")
    return SY.residual_after_commit(spark, everything, root, version).select("_id")
