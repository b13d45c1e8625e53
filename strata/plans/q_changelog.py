"""Queries over versioned tables and the merge family."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import merge as M
from strata.operators.relational import change_type_filter, required_columns
from strata.plans.fixtures import F1_FINAL_SQL, F1_SQL, F1N_EXTRA_SQL, ORDER_COLS, _sql_ts, f1_change_log, f1n_change_log
from strata.plans.registry import query
from strata.session import scratch_path
from strata.sources import changelog as CL
from strata.sources import sketches as SK
from strata.sources.tables import read_table, scan_table

OC = ", ".join(ORDER_COLS)
META = "_change_type, _commit_version, _commit_timestamp"
RANK_SQL = ("CASE _change_type WHEN 'update_preimage' THEN 0 WHEN 'insert' THEN 1 "
            "WHEN 'update_postimage' THEN 2 ELSE 3 END")


@query("scan_path", "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem "
                    "WHERE l_shipdate >= TIMESTAMP '1995-01-01 00:00:00'")
def scan_path(spark, sf_dir):
    # Projection and the date filter reach the parquet scan (ReadSchema / PushedFilters).
    return (read_table(spark, sf_dir, "lineitem")
            .where(F.col("l_shipdate") >= F.to_timestamp_ntz(F.lit("1995-01-01 00:00:00")))
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"))


@query("scan_table", "SELECT * FROM customer")
def scan_table_q(spark, sf_dir):
    read_table(spark, sf_dir, "customer").createOrReplaceTempView("customer_by_name")
    return scan_table(spark, "customer_by_name")


@query("time_travel", f"""WITH {F1_SQL}, r AS (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY _commit_version DESC, {RANK_SQL} DESC) AS rn
  FROM f1 WHERE _commit_version <= 1 AND _change_type <> 'update_preimage')
SELECT {OC} FROM r WHERE rn = 1 AND _change_type <> 'delete'""")
def time_travel(spark, sf_dir):
    return CL.snapshot(f1_change_log(spark, sf_dir), "o_orderkey", as_of=1)


@query("time_travel_latest", f"WITH {F1_FINAL_SQL} SELECT * FROM f1_final")
def time_travel_latest(spark, sf_dir):
    return CL.snapshot(f1_change_log(spark, sf_dir), "o_orderkey")


@query("cdf_from_timestamp", f"WITH {F1_SQL} SELECT * FROM f1 "
                             "WHERE _commit_timestamp >= TIMESTAMP '2024-01-01 01:30:00'")
def cdf_from_timestamp(spark, sf_dir):
    return CL.change_feed(f1_change_log(spark, sf_dir), start_ts="2024-01-01 01:30:00")


@query("change_feed_range", f"WITH {F1_SQL} SELECT * FROM f1 WHERE _commit_version BETWEEN 1 AND 2")
def change_feed_range(spark, sf_dir):
    return CL.change_feed(f1_change_log(spark, sf_dir), start=1, end=2)


@query("latest_version", f"WITH {F1_SQL} SELECT max(_commit_version) AS version FROM f1")
def latest_version(spark, sf_dir):
    return CL.latest_version(f1_change_log(spark, sf_dir))


@query("table_history", f"""WITH {F1_SQL}
SELECT _commit_version AS version, min(_commit_timestamp) AS timestamp, CAST(NULL AS VARCHAR) AS operation,
       count(*) AS num_rows,
       CAST(sum(CASE WHEN _change_type = 'insert' THEN 1 ELSE 0 END) AS BIGINT) AS num_insert,
       CAST(sum(CASE WHEN _change_type = 'update_preimage' THEN 1 ELSE 0 END) AS BIGINT) AS num_update_preimage,
       CAST(sum(CASE WHEN _change_type = 'update_postimage' THEN 1 ELSE 0 END) AS BIGINT) AS num_update_postimage,
       CAST(sum(CASE WHEN _change_type = 'delete' THEN 1 ELSE 0 END) AS BIGINT) AS num_delete
FROM f1 GROUP BY _commit_version ORDER BY version DESC""")
def table_history(spark, sf_dir):
    return CL.history(f1_change_log(spark, sf_dir))


@query("apply_changes", f"WITH {F1_FINAL_SQL} SELECT * FROM f1_final")
def apply_changes(spark, sf_dir):
    log = f1_change_log(spark, sf_dir)
    target = CL.snapshot(log, "o_orderkey", as_of=0)
    return M.apply_changes(target, CL.change_feed(log, start=1), "o_orderkey").table


@query("apply_changes_columns", f"""WITH {F1_FINAL_SQL}
SELECT * FROM f1_final WHERE o_orderkey % 5 <> 4
UNION ALL
SELECT o_orderkey, CAST(NULL AS BIGINT), o_orderstatus, o_totalprice, CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR)
FROM orders WHERE o_orderkey % 5 = 4""")
def apply_changes_columns(spark, sf_dir):
    log = f1_change_log(spark, sf_dir)
    target = CL.snapshot(log, "o_orderkey", as_of=0)
    return M.apply_changes(target, CL.change_feed(log, start=1), "o_orderkey",
                           columns=["o_orderkey", "o_orderstatus", "o_totalprice"]).table


# Closed form over one scan of orders: each key's last change by the definition of F1 and its extra rows.
_LAST = "CASE WHEN o_orderkey = 2 OR o_orderkey % 5 = 4 THEN 3 WHEN o_orderkey % 7 = 0 THEN 2 WHEN o_orderkey % 10 = 1 THEN 1 ELSE 0 END"
COLLAPSED_SQL = f"""WITH o AS (SELECT *, {_LAST} AS v, o_orderkey <> 2 AND o_orderkey % 5 <> 4 AND o_orderkey % 10 = 1 AS changed FROM orders)
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey = 2 THEN 'C' WHEN changed THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN changed THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority,
  CASE WHEN o_orderkey = 2 OR v = 1 THEN 'update_postimage' WHEN v = 2 THEN 'delete' ELSE 'insert' END AS _change_type,
  CAST(v AS BIGINT) AS _commit_version, CASE v WHEN 0 THEN {_sql_ts(0)} WHEN 1 THEN {_sql_ts(1)} WHEN 2 THEN {_sql_ts(2)}
    ELSE {_sql_ts(3)} END AS _commit_timestamp FROM o
UNION ALL SELECT NULL, o_custkey, CASE n WHEN 1 THEN o_orderstatus ELSE 'N' END, o_totalprice, o_orderdate, o_orderpriority,
  'insert', CAST(n AS BIGINT), CASE n WHEN 1 THEN {_sql_ts(1)} ELSE {_sql_ts(2)} END
FROM orders, (VALUES (1), (2)) AS x(n) WHERE o_orderkey = 2"""


@query("collapse_changes", COLLAPSED_SQL)
def collapse_changes(spark, sf_dir):
    return M.collapse_changes(f1n_change_log(spark, sf_dir), "o_orderkey")


@query("apply_changes_null_keys", f"""WITH {F1_SQL}, {F1N_EXTRA_SQL}, {F1_FINAL_SQL}
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey = 2 THEN 'C' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority FROM f1_final
UNION ALL SELECT {OC} FROM f1n WHERE o_orderkey IS NULL""")
def apply_changes_null_keys(spark, sf_dir):
    log = f1n_change_log(spark, sf_dir)
    target = CL.snapshot(log, "o_orderkey", as_of=0)
    return M.apply_changes(target, CL.change_feed(log, start=1), "o_orderkey").table


@query("snapshot_diff", f"""WITH {F1_SQL}, {F1_FINAL_SQL},
b AS (SELECT {OC} FROM f1 WHERE _commit_version = 0),
j AS (SELECT b.o_orderkey AS bk, a.o_orderkey AS ak, b.o_orderkey AS b_o_orderkey, b.o_custkey AS b_o_custkey,
        b.o_orderstatus AS b_o_orderstatus, b.o_totalprice AS b_o_totalprice, b.o_orderdate AS b_o_orderdate,
        b.o_orderpriority AS b_o_orderpriority, a.*
      FROM b FULL OUTER JOIN f1_final a ON a.o_orderkey = b.o_orderkey)
SELECT b_o_orderkey AS o_orderkey, b_o_custkey AS o_custkey, b_o_orderstatus AS o_orderstatus,
       b_o_totalprice AS o_totalprice, b_o_orderdate AS o_orderdate, b_o_orderpriority AS o_orderpriority,
       CASE WHEN ak IS NULL THEN 'delete' ELSE 'update_preimage' END AS _change_type
FROM j WHERE bk IS NOT NULL AND (ak IS NULL OR b_o_orderstatus IS DISTINCT FROM o_orderstatus
      OR b_o_totalprice IS DISTINCT FROM o_totalprice OR b_o_custkey IS DISTINCT FROM o_custkey
      OR b_o_orderdate IS DISTINCT FROM o_orderdate OR b_o_orderpriority IS DISTINCT FROM o_orderpriority)
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CASE WHEN bk IS NULL THEN 'insert' ELSE 'update_postimage' END
FROM j WHERE ak IS NOT NULL AND (bk IS NULL OR b_o_orderstatus IS DISTINCT FROM o_orderstatus
      OR b_o_totalprice IS DISTINCT FROM o_totalprice OR b_o_custkey IS DISTINCT FROM o_custkey
      OR b_o_orderdate IS DISTINCT FROM o_orderdate OR b_o_orderpriority IS DISTINCT FROM o_orderpriority)""")
def snapshot_diff(spark, sf_dir):
    log = f1_change_log(spark, sf_dir)
    return M.snapshot_diff(CL.snapshot(log, "o_orderkey", as_of=0), CL.snapshot(log, "o_orderkey"),
                           "o_orderkey")


@query("merge_counts", """SELECT
  CAST(sum(CASE WHEN o_orderkey % 5 = 4 THEN 1 ELSE 0 END) AS BIGINT) AS num_inserted_rows,
  CAST(sum(CASE WHEN o_orderkey % 10 = 1 AND o_orderkey % 7 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_updated_rows,
  CAST(sum(CASE WHEN o_orderkey % 5 <> 4 AND o_orderkey % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_deleted_rows
FROM orders""")
def merge_counts(spark, sf_dir):
    log = f1_change_log(spark, sf_dir)
    target = CL.snapshot(log, "o_orderkey", as_of=0)
    return M.apply_changes(target, CL.change_feed(log, start=1), "o_orderkey").counts()


@query("update_where", f"""SELECT {OC}, 'update_preimage' AS _change_type FROM orders WHERE o_orderpriority LIKE '1%'
UNION ALL
SELECT o_orderkey, o_custkey, 'X', o_totalprice * 2, o_orderdate, o_orderpriority, 'update_postimage'
FROM orders WHERE o_orderpriority LIKE '1%'""")
def update_where(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(*ORDER_COLS)
    return M.update_where(o, F.col("o_orderpriority").startswith("1"),
                          {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") * 2}).changes


@query("update_where_table", """SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderpriority LIKE '1%' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderpriority LIKE '1%' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
  o_orderdate, o_orderpriority FROM orders""")
def update_where_table(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(*ORDER_COLS)
    return M.update_where(o, F.col("o_orderpriority").startswith("1"),
                          {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") * 2}).table


@query("merge_update", """SELECT c_custkey, c_name, c_nationkey, c_acctbal,
  CASE WHEN c_custkey % 3 = 0 THEN 'SEG' || CAST(c_custkey % 5 AS VARCHAR) ELSE c_mktsegment END AS c_mktsegment
FROM customer""")
def merge_update(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    upd = c.where(F.col("c_custkey") % 3 == 0).select(
        "c_custkey", F.concat(F.lit("SEG"), (F.col("c_custkey") % 5).cast("string")).alias("c_mktsegment"))
    stray = c.select((F.col("c_custkey") + 10_000_000).alias("c_custkey"), F.lit("NEW").alias("c_mktsegment"))
    return M.merge_update(c, upd.unionByName(stray), "c_custkey", ["c_mktsegment"]).table


@query("append_rows", f"""WITH {F1_FINAL_SQL}
SELECT * FROM f1_final UNION ALL
SELECT o_orderkey + 100000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def append_rows(spark, sf_dir):
    log = f1_change_log(spark, sf_dir)
    new = read_table(spark, sf_dir, "orders").select(*ORDER_COLS).withColumn(
        "o_orderkey", F.col("o_orderkey") + 100_000_000)
    appended = log.unionByName(CL.as_changes(new, 4, "insert", "2024-01-01 04:00:00"))
    return CL.snapshot(appended, "o_orderkey")


@query("schema_evolution", """SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer
WHERE c_custkey % 2 = 0
UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 2 = 1""")
def schema_evolution(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    v1 = c.where(F.col("c_custkey") % 2 == 0).select("c_custkey", "c_name")
    v2 = c.where(F.col("c_custkey") % 2 == 1).select("c_custkey", "c_name", "c_mktsegment")
    return CL.append_schema(v1, v2)


@query("change_counts", f"WITH {F1_SQL} SELECT _change_type, count(*) AS count FROM f1 GROUP BY _change_type")
def change_counts(spark, sf_dir):
    return f1_change_log(spark, sf_dir).groupBy("_change_type").count()


@query("change_type_filter", f"WITH {F1_SQL} SELECT * FROM f1 "
                             "WHERE _change_type IN ('insert', 'update_postimage', 'delete')")
def change_type_filter_q(spark, sf_dir):
    return change_type_filter(f1_change_log(spark, sf_dir), ["insert", "update_postimage", "delete"])


REQ_FEED_SQL = f"""feed AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice, o_orderdate,
         CASE WHEN o_orderkey % 13 = 0 THEN '   ' WHEN o_orderkey % 19 = 0 THEN '' ELSE o_orderpriority END
           AS o_orderpriority, {META} FROM f1)"""


def _req_feed(spark, sf_dir):
    k = F.col("o_orderkey")
    return (f1_change_log(spark, sf_dir)
            .withColumn("o_totalprice", F.when(k % 17 == 0, F.lit(None)).otherwise(F.col("o_totalprice")))
            .withColumn("o_orderpriority", F.when(k % 13 == 0, F.lit("   ")).when(k % 19 == 0, F.lit(""))
                        .otherwise(F.col("o_orderpriority"))))


@query("required_columns", f"""WITH {F1_SQL}, {REQ_FEED_SQL}
SELECT * FROM feed WHERE _change_type = 'delete'
   OR (o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL AND trim(o_orderpriority) <> '')""")
def required_columns_q(spark, sf_dir):
    return required_columns(_req_feed(spark, sf_dir), ["o_totalprice", "o_orderpriority"])


@query("log_schema_evolution", """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority
FROM orders UNION ALL SELECT o_orderkey + 10000000, o_totalprice, NULL FROM orders WHERE o_orderkey % 10 = 1""")
def log_schema_evolution(spark, sf_dir):
    # K05 on a stored log: a column that comes with the second commit, and a third commit without it.
    root = scratch_path(spark, "evolving")
    o = read_table(spark, sf_dir, "orders")
    narrow = o.select("o_orderkey", "o_totalprice")
    CL.commit(spark, narrow.withColumn(CL.CHANGE_TYPE, F.lit("insert")), root)
    CL.write_snapshot(spark, root, "o_orderkey", 0)
    wide = o.where(F.col("o_orderkey") % 2 == 0).select("o_orderkey", "o_totalprice", "o_orderpriority")
    CL.commit(spark, wide.withColumn(CL.CHANGE_TYPE, F.lit("update_postimage")), root)
    late = narrow.where(F.col("o_orderkey") % 10 == 1).withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000)
    CL.commit(spark, late.withColumn(CL.CHANGE_TYPE, F.lit("insert")), root)
    return CL.snapshot_at(spark, root, "o_orderkey")


@query("count_distinct_sketch", """SELECT 'o_custkey' AS "column", count(DISTINCT o_custkey) AS exact, true AS close FROM orders
UNION ALL SELECT 'o_orderkey', count(DISTINCT o_orderkey), true FROM orders
UNION ALL SELECT 'o_orderdate', count(DISTINCT o_orderdate), true FROM orders
UNION ALL SELECT 'text', count(DISTINCT text), true FROM documents""")
def count_distinct_sketch(spark, sf_dir):
    # A02, opt-in: three commits of orders and of documents; their sketches are united, their rows not read again.
    out = []
    for table, key, columns in (("orders", "o_orderkey", ["o_custkey", "o_orderkey", "o_orderdate"]), ("documents", "doc_id", ["text"])):
        root, rows = scratch_path(spark, f"sketch-{table}"), read_table(spark, sf_dir, table).select("*")
        for part in range(3):
            CL.commit(spark, rows.where(F.col(key) % 3 == part).withColumn(CL.CHANGE_TYPE, F.lit("insert")), root)
        SK.sketch_missing(spark, root, columns)
        exact = rows.agg(*[F.count_distinct(c).alias(c) for c in columns]).unpivot([], columns, "column", "exact")
        out.append(SK.distinct_estimates(spark, root).join(exact, "column"))
    close = F.abs(F.col("estimate") - F.col("exact")) <= 3 * SK.STANDARD_ERROR * F.col("exact") + 1
    return out[0].union(out[1]).select("column", "exact", close.alias("close"))
