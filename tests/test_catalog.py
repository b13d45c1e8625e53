"""Catalog helpers, file readers, empty inbox, start without a version."""

import os

from pyspark.sql import functions as F

from strata.operators.ingest import CHAPTER_SCHEMA, run_ingest
from strata.plans.fixtures import f1_change_log
from strata.plans.q_streaming import commit_versions
from strata.session import as_local
from strata.sources import catalog as C
from strata.sources import changelog as CL
from strata.sources.collection import read_files
from strata.streaming import cdf

from conftest import SMALL


def test_database_table_properties(spark, scratch):
    loc = scratch("warehouse")
    C.ensure_database(spark, "strata_test_db", loc)
    C.ensure_table(spark, "strata_test_db.chapters", CHAPTER_SCHEMA)
    assert spark.catalog.tableExists("strata_test_db.chapters")
    C.enable_change_feed(spark, "strata_test_db.chapters")
    assert C.table_properties(spark, "strata_test_db.chapters")[C.CDF_PROPERTY] == "true"
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    assert C.create_or_append(df, "strata_test_db.t") == "create"
    assert C.create_or_append(df, "strata_test_db.t") == "append"
    assert spark.table("strata_test_db.t").count() == 2
    assert C.list_tables(spark, "strata_test_db").count() == 2
    C.drop_table(spark, "strata_test_db.t")
    C.drop_database(spark, "strata_test_db")
    assert not spark.catalog.databaseExists("strata_test_db")


def test_read_files(spark, scratch):
    d = as_local(scratch("files"))
    os.makedirs(d)
    with open(f"{d}/a.md", "w") as fh:
        fh.write("# T\n\nline\n")
    with open(f"{d}/b.csv", "w") as fh:
        fh.write("x,y\n1,2\n")
    assert read_files(spark, f"{d}/a.md", "md").first().text == "# T\n\nline\n"
    assert read_files(spark, f"{d}/b.csv", "csv").first().text == '{"x":"1","y":"2"}'


def test_empty_inbox_stops(spark):
    empty = spark.createDataFrame([], "doc_id long, filename string, path string, text string, modified_at timestamp")
    assert run_ingest(spark, empty, empty.select(F.lit("h").alias("file_hash"))) is None


def test_start_without_version_takes_snapshot_first(spark, scratch):
    root = scratch("nostart")
    log = f1_change_log(spark, SMALL)
    commit_versions(spark, log, f"{root}/bronze", [0, 1])
    cfg = cdf.StreamConfig(f"{root}/bronze", f"{root}/silver", f"{root}/ckpt", "ns")
    cfg2 = cdf.start_without_version(spark, cfg, "o_orderkey")
    assert cfg2.starting_version == 2
    commit_versions(spark, log, f"{root}/bronze", [2, 3])
    cdf.run_stream(spark, cfg2, "o_orderkey", change_filter=cdf.default_filter())
    got = CL.snapshot(CL.read_log(spark, f"{root}/silver"), "o_orderkey")
    assert got.count() == CL.snapshot(log, "o_orderkey").count()
