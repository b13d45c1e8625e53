"""Exact quantiles, counter segments and sliding ranges, sketches, entity pairs and row caps on hostile inputs."""

import datetime as dt
import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import counters as CT
from strata.operators import quantiles as QT
from strata.operators import relations as RL
from strata.operators import relational as R
from strata.sources import changelog as CL
from strata.sources import sketches as SK

START = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("q", [0.0, 0.5, 0.95, 1.0])
def test_exact_quantile(spark, q, monkeypatch):
    r = random.Random(1)
    rows = [("hot", r.choice([1.0, 2.0]) if i % 2 else r.expovariate(1e-3)) for i in range(6000)]  # a third of it and more
    rows += [("ties", 5.0)] * 3000 + [("two", 1.0), ("two", 2.0)] + [("one", -3.5)] + [("none", None), ("none", float("nan"))]
    rows += [(None, float(i)) for i in range(100)] + [("wide", x) for x in (-1e300, -1.0, 0.0, 1e-300, 1e300)]
    df = spark.createDataFrame(rows, "g string, value double")
    want = defaultdict(list)
    for g, v in rows:
        if v is not None and v == v:
            want[g].append(v)
    got = {x.g: x for x in QT.exact_quantile(df, q, ["g"]).collect()}
    assert got.keys() == want.keys()
    for g, values in want.items():
        values.sort()
        pos = q * (len(values) - 1)
        low, high = values[int(np.floor(pos))], values[int(np.ceil(pos))]
        assert got[g].n == len(values) and got[g]["quantile"] == low + (high - low) * (pos - np.floor(pos))


def test_exact_quantile_keeps_few_rows(spark):
    df = spark.range(400_000).select((F.col("id") % 2).alias("g"), F.rand(1).alias("v"))
    kept = QT._between(df.select(F.col("g").alias("k0"), "v"), ["k0"], 0.95, QT.MARGINS[0])
    assert kept.where("v IS NOT NULL").count() < 400_000 / 500


def brute_sliding(rows, range_s, step_s):
    series = defaultdict(list)
    for name, t, v in rows:
        if v is not None:
            series[name].append((t, v))
    out = {}
    for name, samples in series.items():
        samples.sort()
        first, last = (int(-(-(t - dt.datetime(1970, 1, 1)).total_seconds() // step_s)) for t in (samples[0][0], samples[-1][0]))
        for at in range(first, last + range_s // step_s):
            end = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=at * step_s)
            inside = [v for t, v in samples if end - dt.timedelta(seconds=range_s) < t <= end]
            if len(inside) > 1:
                out[name, end] = sum(b - a if b >= a else b for a, b in zip(inside, inside[1:]))
    return out


def test_sliding_increase_against_brute_force(spark):
    r = random.Random(4)
    rows, value = [], 0.0
    for i in range(400):  # a hot series, several samples a step, resets, samples on step ends
        value = 0.0 if r.random() < 0.05 else value + r.randrange(5)
        rows.append(("hot", START + dt.timedelta(seconds=3 * i), value))
    rows += [("slow", START + dt.timedelta(minutes=7 * i), float(i % 4)) for i in range(20)]
    rows += [("once", START, 1.0), ("null", START, None)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, value double").repartition(7)
    for range_s, step_s in ((60, 60), (300, 60), (1200, 300), (45, 15)):
        got = {(x.series, x.step_end): x.increase for x in CT.sliding_increase(df, ["series"], ["series"], range_s, step_s).collect()}
        assert got == pytest.approx(brute_sliding(rows, range_s, step_s))
    rate = CT.sliding_rate(df.where("series = 'hot'"), [], ["series"], 300, 60)
    assert rate.agg(F.max("rate")).first()[0] > 0
    with pytest.raises(ValueError, match="whole number"):
        CT.sliding_increase(df, [], ["series"], 100, 60)


def test_a_series_with_most_samples_spreads_over_slices(spark):
    df = spark.range(40_000).select(F.when(F.col("id") < 30_000, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("series"),
                                    (F.lit(START) + F.make_interval(secs=F.col("id") % 30_000 / 10)).cast("timestamp_ntz").alias("ts"),
                                    "id", F.col("id").cast("double").alias("value"))
    x = df.repartitionByRange(8, "series", "ts", "id").groupBy(F.spark_partition_id()).count()
    assert x.agg(F.max("count")).first()[0] < 10_000
    seg = CT.segments(df, ["series"], F.lit(0), ["ts", "id"]).where("series = 'hot'").first().seg
    assert (seg.first, seg.last, seg.increase, seg.n) == (0.0, 29_999.0, 29_999.0, 30_000)


def test_sketches_over_versions(spark, scratch):
    root = scratch("sketch")
    for v in range(4):
        CL.commit(spark, spark.range(v * 20_000, v * 20_000 + 30_000).select(F.col("id").alias("k"), F.lit("insert").alias("_change_type")), root)
    assert SK.sketch_missing(spark, root, ["k"]) == [0, 1, 2, 3] and SK.sketch_missing(spark, root, ["k"]) == []
    for start, end, exact in ((None, None, 90_000), (1, 2, 50_000), (3, 3, 30_000)):
        estimate = SK.distinct_estimates(spark, root, start, end).first().estimate
        assert abs(estimate - exact) <= 3 * SK.STANDARD_ERROR * exact
    plan = SK.distinct_estimates(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "_commit_version" not in plan  # the log is not read


def test_entity_pairs(spark):
    r = random.Random(2)
    names = [f"{a}{b}" for a in ("Ada", "Bel", "Cor", "Dan") for b in ("mar", "nix", "ola")]
    sentences = [[r.choice(names) for _ in range(r.randrange(5))] for _ in range(200)]
    text = " ".join(" met ".join(s) + "." for s in sentences)
    crowd = " and ".join("Q" + "abcdefghij"[i % 10] + "".join("abcdefghij"[int(c)] for c in str(i)) for i in range(10_000))
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, crowd + " met Adamar and Belnix.")], "doc_id long, text string")
    n = Counter(p for s in [*sentences, ["Adamar", "Belnix"]] for p in combinations(sorted(set(s)), 2))
    got = {(x.source, x.target): x.sentences for x in RL.entity_pairs(df, min_support=2).collect()}
    assert got == {p: c for p, c in n.items() if c >= 2}


@pytest.mark.parametrize("n", [1, 7, 40, 1000])
def test_row_cap_writes_keys_only(spark, n):
    rows = [(i % 9 if i % 5 else None, f"k{i % 4}", "x" * 50) for i in range(120)]
    df = spark.createDataFrame(rows, "a long, b string, wide string")
    got = [(x.a, x.b) for x in R.top_rows(df, ["a", "b"], n).collect()]
    want = sorted(((a, b) for a, b, _ in rows), key=lambda p: (p[0] is not None, p[0] or 0, p[1]))[:n]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    plan = R.top_rows(df, ["a", "b"], n)._jdf.queryExecution().executedPlan().toString()
    assert "RangePartitioning" not in plan and "rangepartitioning" not in plan and "Sort " not in plan
