"""Decorator runner, metric lines, schema rules, and plan shape checks."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.functions.schema import ddl_from_schema, void_to_string
from strata.operators import decorate as D
from strata.operators import metrics as MX
from strata.operators.ingest import CHAPTER_SCHEMA
from strata.operators.sync import table_name
from strata.plans.registry import QUERIES, load_all

from conftest import SMALL


def test_decorator_isolates_failures(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(1, 8)], "doc_id long, text string")

    def model(pdf):
        if any(len(t) == 3 for t in pdf["text"]):
            raise RuntimeError("bad row")
        return pd.DataFrame({"summary": [t.upper() for t in pdf["text"]]})

    res = D.run_decorator(df, model, "doc_id", ["text"], "summary string", batch_rows=4)
    c = D.run_status(D.decorate_counts(res)).first()
    assert (c.pending, c.succeeded, c.failed, c.run_failed) == (7, 6, 1, False)
    assert res.where("doc_id = 3").first().ok is False


def test_metric_lines(spark):
    df = MX.batch_outcome(spark, "river flow", 0.25, failed=True, rejected=7)
    name = MX.metric_name(F.col("stream"), F.col("metric"), F.col("label"), "jobs")
    lines = [r.l for r in df.select(MX.statsd_line(name, F.col("kind"), F.col("value")).alias("l")).collect()]
    assert lines == ["jobs.river_flow.batch_duration:250.000|ms", "jobs.river_flow.batches.failed:1|c",
                     "jobs.river_flow.merge.rejected:7|c"]
    line = lines[2]
    back = spark.createDataFrame([(line,)], "l string").select(MX.parse_statsd(F.col("l")).alias("p")).first().p
    assert (back.value, back.type) == (7.0, "c")


def test_mapping_depth_follows_the_rules(spark):
    rules = [("a.*.c.d.e.f.g.h", None, "deep", ("x",)), ("a.*", "counter", "flat", ("x",))]
    names = spark.createDataFrame([("a.b.c.d.e.f.g.h", "gauge"), ("a.q", "gauge"), ("a.q", "counter")], "name string, kind string")
    got = {(r.name, r.kind): (r.metric, r.labels) for r in MX.map_metric_names(names, rules, kind_col="kind").collect()}
    assert got == {("a.b.c.d.e.f.g.h", "gauge"): ("deep", "x=b"), ("a.q", "gauge"): ("a_q", ""), ("a.q", "counter"): ("flat", "x=q")}


def test_schema_rules(spark):
    df = spark.range(1).select(F.lit(None).alias("a"), F.array(F.lit(None)).alias("b"))
    fixed = void_to_string(df)
    assert fixed.schema["a"].dataType.simpleString() == "string"
    assert fixed.schema["b"].dataType.simpleString() == "array<string>"
    ddl = ddl_from_schema("db.chapters", CHAPTER_SCHEMA)
    assert "`chapter_id` string NOT NULL," in ddl and "`title` string," in ddl
    assert table_name("crawler.responses.raw") == "crawler_responses_raw"
    with pytest.raises(ValueError):
        table_name("bad name")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["apply_changes", "upsert_by_hash", "dense_topk", "sparse_dot", "metric_mapping",
                                  "counter_increase", "ingest_outcome", "bronze_to_silver", "entity_pairs", "sparse_dot_batch",
                                  "dense_query_topk", "duration_p95_exact", "counter_increase_sliding", "html_to_markdown"])
def test_no_cartesian_or_row_udf(spark, name):
    load_all()
    plan = _plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_scan_prunes_and_pushes(spark):
    load_all()
    plan = _plan(QUERIES["scan_path"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate:timestamp_ntz>" in plan


def test_token_rows_within_the_row(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None), (None, "C c d"), (5, "!!")], "k long, t string").repartition(8)
    got = sorted(((r.k, r.token, round(r.weight, 4)) for r in D.token_rows(df, "k", "t", slice_bytes=2).collect()), key=repr)
    assert got == [(1, "a", 0.6667), (1, "b", 0.3333), (None, "c", 0.6667), (None, "d", 0.3333)]
    assert D.token_rows(df.limit(0), "k", "t").count() == 0


def test_vectors_are_made_a_slice_of_texts_at_a_time(spark):
    import numpy as np
    import pyarrow as pa

    sizes = [len(x) for x in D._slices(pa.array(["a b c"] * 1000 + [None, ""]), 500)]
    assert sum(sizes) == 1002 and max(sizes) == 100
    long = "word " * (D.SLICE_BYTES // 4) + "other"  # longer than a slice
    texts = ["B a b", None, "", "?!", long, "Ünï x1"] + [f"t{i} t{i} u" for i in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    got = {r.i: r for r in df.select("i", D.sparse_vector(F.col("s")).alias("w"), D.dense_vector(F.col("s")).alias("v"),
                                     D.both_vectors(F.col("s")).alias("b")).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        words = D._words(text)
        weights = {w: float(np.float32(words.count(w) / len(words))) for w in set(words)} or None
        assert got[i].w == weights and got[i].b.sparse == weights and got[i].b.dense == got[i].v
        assert (got[i].v is None) == (not words)
    assert abs(sum(x * x for x in got[0].v) - 1) < 1e-5 and len(got[0].v) == D.DENSE_DIM


def test_missing_vectors_of_very_different_texts(spark):
    df = spark.createDataFrame([(i, None if i % 7 == 3 else "x y z " * (2000 if i % 50 == 0 else 1), [-1.0] if i % 8 == 0 else None)
                                for i in range(400)], "doc_id long, text string, text_embedding_dense array<float>")
    df = df.selectExpr("*", "cast(null as map<string,float>) text_embedding_sparse", "'a summary' summary",
                       "cast(null as array<float>) summary_embedding_dense")
    out = {r.doc_id: r for r in D.with_embeddings(df).collect()}
    assert len(out) == 400
    for i, r in out.items():
        assert (r.text_embedding_dense == [-1.0]) == (i % 8 == 0)
        assert (r.text_embedding_sparse is None) == (i % 7 == 3) and r.summary_embedding_dense is not None
    assert max(len(x) for x in D._slices(df.select("text").toArrow().column(0).combine_chunks(), 60)) <= 60  # null texts weigh nothing
