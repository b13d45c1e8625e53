"""Relational queries: projection, filters, joins, aggregates, sort/limit, schema rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StringType, StructField, StructType, TimestampType

from strata.functions.schema import add_missing_columns, not_null_violations, void_to_string
from strata.operators import merge as M
from strata.operators.relational import anti_join_known, most_common, semi_join, top_rows
from strata.plans.registry import query
from strata.sources.tables import TABLES, read_table, register_tables


def T(spark, sf_dir, name):
    return read_table(spark, sf_dir, name)


@query("project_alias", """SELECT l_orderkey AS order_key, l_linenumber AS "line number",
  l_extendedprice * (1 - l_discount) AS revenue FROM lineitem""")
def project_alias(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line number"),
                     (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))


@query("filter_compare", """SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders
WHERE o_totalprice <> 0.0 AND o_orderdate > TIMESTAMP '1995-06-30 00:00:00'
  AND (o_orderstatus = 'F' OR o_orderpriority = '1-URGENT')""")
def filter_compare(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    return o.where((F.col("o_totalprice") != 0.0) & (F.col("o_orderdate") > F.lit("1995-06-30").cast("timestamp_ntz"))
                   & ((F.col("o_orderstatus") == "F") | (F.col("o_orderpriority") == "1-URGENT"))
                   ).select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")


@query("filter_nulls", """SELECT d.doc_id, d.source FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
WHERE l.quality IS NULL AND d.text IS NOT NULL AND d.text <> ''""")
def filter_nulls(spark, sf_dir):
    d = T(spark, sf_dir, "documents").select("doc_id", "source", "text")
    lab = T(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(lab, "doc_id", "left")
    return j.where(F.col("quality").isNull() & F.col("text").isNotNull() & (F.col("text") != "")
                   ).select("doc_id", "source")


@query("filter_like", "SELECT p_partkey, p_name, p_brand FROM part WHERE p_brand LIKE 'Brand#1%'")
def filter_like(spark, sf_dir):
    return T(spark, sf_dir, "part").where(F.col("p_brand").like("Brand#1%")).select("p_partkey", "p_name", "p_brand")


@query("null_safe_compare", """SELECT c_custkey,
  nullif(c_mktsegment, 'BUILDING') IS NOT DISTINCT FROM nullif(c_mktsegment, 'MACHINERY') AS same_null_safe,
  nullif(c_mktsegment, 'BUILDING') = nullif(c_mktsegment, 'MACHINERY') AS same_plain FROM customer""")
def null_safe_compare(spark, sf_dir):
    c = T(spark, sf_dir, "customer")
    a = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    b = F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY"))
    return c.select("c_custkey", a.eqNullSafe(b).alias("same_null_safe"), (a == b).alias("same_plain"))


@query("metadata_join", """SELECT r.r_name AS region, n.n_name AS nation, COALESCE(s.s_name, '') AS supplier
FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN supplier s ON s.s_nationkey = n.n_nationkey ORDER BY region, nation""")
def metadata_join(spark, sf_dir):
    # nation/region are dimension tables: Catalyst broadcasts them from their measured size.
    n, r, s = T(spark, sf_dir, "nation"), T(spark, sf_dir, "region"), T(spark, sf_dir, "supplier")
    j = n.join(r, r.r_regionkey == n.n_regionkey).join(s, s.s_nationkey == n.n_nationkey, "left")
    return j.select(F.col("r_name").alias("region"), F.col("n_name").alias("nation"),
                    F.coalesce(F.col("s_name"), F.lit("")).alias("supplier")).orderBy("region", "nation")


@query("dedupe_against_table", """WITH items AS (SELECT doc_id, sha256(text) AS file_hash FROM documents),
known AS (SELECT DISTINCT sha256(d.text) AS file_hash FROM documents d JOIN labels l ON l.doc_id = d.doc_id)
SELECT * FROM items WHERE file_hash NOT IN (SELECT file_hash FROM known)""")
def dedupe_against_table(spark, sf_dir):
    d = T(spark, sf_dir, "documents")
    items = d.select("doc_id", F.sha2("text", 256).alias("file_hash"))
    known = d.join(T(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").select(
        F.sha2("text", 256).alias("file_hash"))
    return anti_join_known(items, known, "file_hash")


SYNCED = "ts < TIMESTAMP '2024-01-20 00:00:00'"


@query("moved_rows", f"SELECT event_id, event_type FROM events WHERE event_id IN (SELECT event_id FROM events WHERE {SYNCED})")
def moved_rows(spark, sf_dir):
    ev = T(spark, sf_dir, "events")
    synced = ev.where(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")).select("event_id")
    return semi_join(ev, synced, "event_id").select("event_id", "event_type")


@query("move_residual", f"SELECT event_id, event_type FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE {SYNCED})")
def move_residual(spark, sf_dir):
    from strata.operators.sync import residual_after_move

    ev = T(spark, sf_dir, "events")
    synced = ev.where(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")).select("event_id")
    return residual_after_move(ev, synced, "event_id").select("event_id", "event_type")


@query("count_rows", "SELECT count(*) AS count FROM lineitem")
def count_rows(spark, sf_dir):
    return T(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("count"))


@query("count_distinct", "SELECT count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts FROM lineitem")
def count_distinct(spark, sf_dir):
    return T(spark, sf_dir, "lineitem").agg(F.count_distinct("l_orderkey").alias("orders"),
                                            F.count_distinct("l_partkey").alias("parts"))


@query("group_count", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type ORDER BY count DESC")
def group_count(spark, sf_dir):
    return T(spark, sf_dir, "events").groupBy("event_type").count().orderBy(F.col("count").desc())


@query("distinct_values", "SELECT DISTINCT c_mktsegment FROM customer")
def distinct_values(spark, sf_dir):
    return T(spark, sf_dir, "customer").select("c_mktsegment").distinct()


@query("dedupe_by_key", """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn
  FROM lineitem) WHERE rn = 1""")
def dedupe_by_key(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    # (l_orderkey, l_linenumber) is not unique in the data: the order must be total.
    return M.dedupe_by_key(li, "l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
                           ).drop("l_suppkey")


@query("most_common", """WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n, min(o_orderkey) AS first
  FROM orders GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, first) AS rn,
             max(n) OVER (PARTITION BY o_custkey) AS mx FROM c)
SELECT o_custkey, o_orderpriority, mx AS count FROM r WHERE rn = 1""")
def most_common_q(spark, sf_dir):
    return most_common(T(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")


@query("order_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def order_rows(spark, sf_dir):
    return T(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.col("o_totalprice").desc(), "o_orderkey")


@query("batch_limit", "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 100")
def batch_limit(spark, sf_dir):
    # The limit is the feature (one run handles at most n rows); order makes it reproducible.
    return top_rows(T(spark, sf_dir, "documents").select("doc_id", "source"), ["doc_id"], 100)


@query("partition_columns", """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""")
def partition_columns(spark, sf_dir):
    from strata.operators.sync import with_partition_columns

    o = T(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate"))
    return with_partition_columns(o, "o_orderdate").select("o_orderkey", "year", "month")


@query("json_columns", """SELECT event_id, '{"k":' || CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) || '}'
  AS props FROM events""")
def json_columns(spark, sf_dir):
    from strata.operators.sync import json_columns as to_json_cols

    ev = T(spark, sf_dir, "events").select("event_id", F.from_json("props", "map<string,bigint>").alias("props"))
    return to_json_cols(ev, ["props", "missing_column"])


HASH_SQL = """sha256('{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name
  || '","c_nationkey":' || c_nationkey || '}')"""


@query("content_hash_groups", f"SELECT c_custkey, {HASH_SQL} AS _content_hash FROM customer")
def content_hash_groups(spark, sf_dir):
    c = T(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment",
                                            F.current_timestamp().alias("_synced_at"))
    return c.select("c_custkey", M.content_hash(c, "c_custkey").alias("_content_hash"))


@query("void_to_string", """SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_comment, [CAST(NULL AS VARCHAR)] AS tags,
  {'a': CAST(NULL AS VARCHAR)} AS nested FROM customer""")
def void_to_string_q(spark, sf_dir):
    c = T(spark, sf_dir, "customer").select(
        "c_custkey", F.lit(None).alias("c_comment"), F.array(F.lit(None)).alias("tags"),
        F.struct(F.lit(None).alias("a")).alias("nested"))
    assert isinstance(c.schema["c_comment"].dataType, NullType)
    return void_to_string(c)


DOC_SCHEMA = StructType([
    StructField("document_id", StringType(), False), StructField("file_hash", StringType(), False),
    StructField("filename", StringType(), False), StructField("title", StringType(), True),
    StructField("ingested_at", TimestampType(), False)])


@query("not_null_violations", """WITH r AS (SELECT CAST(l.doc_id AS VARCHAR) AS document_id, sha256(d.text) AS file_hash,
  d.source AS filename FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT 'document_id' AS column_name, CAST(count(*) - count(document_id) AS BIGINT) AS violations FROM r
UNION ALL SELECT 'file_hash', CAST(count(*) - count(file_hash) AS BIGINT) FROM r
UNION ALL SELECT 'filename', CAST(count(*) - count(filename) AS BIGINT) FROM r
UNION ALL SELECT 'ingested_at', CAST(0 AS BIGINT) FROM r LIMIT 4""")
def not_null_violations_q(spark, sf_dir):
    d = T(spark, sf_dir, "documents")
    lab = T(spark, sf_dir, "labels").select(F.col("doc_id").alias("l_doc_id"))
    rows = d.join(lab, d.doc_id == lab.l_doc_id, "left").select(
        F.col("l_doc_id").cast("string").alias("document_id"), F.sha2("text", 256).alias("file_hash"),
        F.col("source").alias("filename"), F.lit(None).cast("string").alias("title"),
        F.current_timestamp().alias("ingested_at"))
    return not_null_violations(rows, DOC_SCHEMA)


DECORATOR_TYPES = {"summary": "string", "ner_nel": "string", "text_embedding_dense": "array<float>",
                   "text_embedding_sparse": "map<string,float>", "summary_embedding_dense": "array<float>",
                   "TEXT": "string"}


@query("add_missing_columns", """SELECT doc_id, text, lang, source, n_chars, CAST(NULL AS VARCHAR) AS summary,
  CAST(NULL AS VARCHAR) AS ner_nel, CAST(NULL AS FLOAT[]) AS text_embedding_dense,
  CAST(NULL AS MAP(VARCHAR, FLOAT)) AS text_embedding_sparse, CAST(NULL AS FLOAT[]) AS summary_embedding_dense
FROM documents""")
def add_missing_columns_q(spark, sf_dir):
    # "TEXT" already exists as "text": names compare case-insensitively.
    return add_missing_columns(T(spark, sf_dir, "documents"), DECORATOR_TYPES)


@query("list_tables", " UNION ALL ".join(f"SELECT 'lt_{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES))
def list_tables(spark, sf_dir):
    # The catalog's tables, each with what it holds now.
    register_tables(spark, sf_dir, prefix="lt_")
    listed = spark.sql("SHOW TABLES").where(F.col("tableName").startswith("lt_")).select("tableName")
    counts = [spark.table(f"lt_{t}").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(f"lt_{t}")) for t in TABLES]
    counted = reduce(DataFrame.unionByName, counts)
    return listed.join(counted, F.col("tableName") == F.col("table_name")).select("table_name", "n_rows")
