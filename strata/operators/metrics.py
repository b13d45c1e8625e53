"""Metric rows and the dashboard expressions over them.

Samples are rows ``(ts, series..., value)``.  Counter increases are merged from
segments over slices of rows (``counters``), so a series that holds a third of
all samples never lands in one task; exact quantiles are in ``quantiles``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.text import sanitize_name
from strata.operators.counters import segments
from strata.sources.changelog import CHANGE_TYPE

# Statsd type letters per kind, and the exporter's name for each kind.
KIND_SUFFIX = {"counter": "c", "gauge": "g", "timer": "ms"}
KIND_TYPE = {"counter": "counter", "gauge": "gauge", "timer": "observer"}

# Name-mapping rules (dotted glob, metric type or None for any, metric name, labels), first match wins.
ENGINE_RULES = [
    ("spark.*.*.executor.recordsRead", None, "spark_executor_records_read_count", ("app_id", "executor_id")),
    ("spark.*.*.executor.recordsWritten", None, "spark_executor_records_written_count", ("app_id", "executor_id")),
    ("spark.*.*.executor.filesystem.file.read_bytes", None, "spark_executor_filesystem_file_read_bytes",
     ("app_id", "executor_id")),
    ("spark.*.*.executor.filesystem.file.write_bytes", None, "spark_executor_filesystem_file_write_bytes",
     ("app_id", "executor_id")),
]
STREAM_RULES = [
    ("*.processed.*", "counter", "records_processed_total", ("stream", "change_type")),
    ("*.merge.*", "counter", "merge_rows_total", ("stream", "operation")),
    ("*.batches.*", "counter", "batches_total", ("stream", "status")),
    ("*.batch_rows", "gauge", "batch_rows", ("stream",)),
    ("*.batch_duration", "observer", "batch_duration_seconds", ("stream",)),
    ("*.decorated.*", "counter", "decorated_rows_total", ("stream", "status")),
    ("*.pending", "gauge", "pending_rows", ("stream",)),
]
MAX_RULES = 10_000  # rules are configuration; more are refused, as the table is broadcast


def mapping_rules(prefix: str) -> list[tuple]:
    """The rules for streams whose metric names begin with ``prefix``."""
    return ENGINE_RULES + [(f"{prefix}.{glob}", kind, f"{prefix}_{name}", labels) for glob, kind, name, labels in STREAM_RULES]


# ------------------------------------------------------------ metric rows

def batch_metrics(changes: DataFrame, merged: DataFrame | None, stream: Column | str,
                  by: Sequence[str] = ()) -> DataFrame:
    """Metric rows of micro-batches (one per value of ``by``): the batch_rows gauge,
    a processed counter per change type present, merge inserted/updated/deleted and
    batches succeeded.  One aggregate over the batch and merge change rows; a
    batch without rows emits nothing.
    """
    st = F.lit(stream) if isinstance(stream, str) else stream
    u = changes.select(*by, F.lit(0).alias("__src"), CHANGE_TYPE)
    if merged is not None:
        u = u.unionByName(merged.select(*by, F.lit(1).alias("__src"), CHANGE_TYPE))
    src, ct = F.col("__src"), F.col(CHANGE_TYPE)

    def n(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("double")

    types = ("insert", "update_preimage", "update_postimage", "delete")
    agg = u.groupBy(*by).agg(n(src == 0).alias("rows"), *[n((src == 0) & (ct == t)).alias(t) for t in types],
                             n((src == 1) & (ct == "insert")).alias("m_ins"),
                             n((src == 1) & (ct == "update_postimage")).alias("m_upd"),
                             n((src == 1) & (ct == "delete")).alias("m_del"))
    agg = agg.where(F.col("rows") > 0)

    def row(metric, label, kind, value, when=None):
        r = F.struct(F.lit(metric).alias("metric"), F.lit(label).cast("string").alias("label"),
                     F.lit(kind).alias("kind"), value.alias("value"))
        return r if when is None else F.when(when, r)

    items = [row("batch_rows", None, "gauge", F.col("rows"))]
    items += [row("processed", t, "counter", F.col(t), F.col(t) > 0) for t in types]
    if merged is not None:
        items += [row("merge", "inserted", "counter", F.col("m_ins")), row("merge", "updated", "counter", F.col("m_upd")),
                  row("merge", "deleted", "counter", F.col("m_del"))]
    items.append(row("batches", "succeeded", "counter", F.lit(1.0)))
    out = agg.select(*by, F.explode(F.filter(F.array(*items), lambda x: x.isNotNull())).alias("m"))
    return out.select(*by, st.alias("stream"), "m.*")


def counted_metrics(spark, stream: str, batch: dict, merged: dict) -> DataFrame:
    """The rows of ``batch_metrics`` from counts observed as the batch and its commit passed."""
    rows = [("batch_rows", None, "gauge", batch["rows"])]
    rows += [("processed", t, "counter", batch[t]) for t in ("insert", "update_preimage", "update_postimage", "delete") if batch[t]]
    rows += [("merge", label, "counter", merged[t]) for label, t in (
        ("inserted", "insert"), ("updated", "update_postimage"), ("deleted", "delete"))]
    rows.append(("batches", "succeeded", "counter", 1))
    return spark.createDataFrame([(stream, m, x, k, float(v)) for m, x, k, v in rows],
                                 "stream string, metric string, label string, kind string, value double")


def batch_outcome(spark, stream: str, seconds: float, failed: bool, rejected: int = 0) -> DataFrame:
    """How long a batch took, whether it failed, and how many rows it could not merge, as metric rows."""
    rows = [("batch_duration", None, "timer", float(seconds))]
    if failed:
        rows.append(("batches", "failed", "counter", 1.0))
    if rejected:
        rows.append(("merge", "rejected", "counter", float(rejected)))
    return spark.createDataFrame([(stream, *r) for r in rows],
                                 "stream string, metric string, label string, kind string, value double")


def decorator_metrics(spark, stream: str, pending: int, succeeded: int, failed: int) -> DataFrame:
    """Rows waiting for a decorator before its run, decorated and failed in it."""
    rows = [("pending", None, "gauge", pending), ("decorated", "succeeded", "counter", succeeded),
            ("decorated", "failed", "counter", failed)]
    return spark.createDataFrame([(stream, m, x, k, float(v)) for m, x, k, v in rows],
                                 "stream string, metric string, label string, kind string, value double")


def metric_name(stream: Column, metric: Column, label: Column, prefix: str) -> Column:
    """``<prefix>.<stream>.<metric>[.<label>]`` with stream and label sanitised to one path segment."""
    return F.concat_ws(".", F.lit(prefix), sanitize_name(stream), metric,
                       F.when(label.isNotNull(), sanitize_name(label)))


def statsd_line(name: Column, kind: Column, value: Column) -> Column:
    """``name:value|c`` (integer counters), ``|g`` gauges, ``|ms`` timers (seconds x 1000)."""
    v = (F.when(kind == "counter", value.cast("bigint").cast("string"))
         .when(kind == "timer", F.format_number(value * 1000.0, 3))
         .otherwise(F.when(value == F.floor(value), value.cast("bigint").cast("string"))
                    .otherwise(value.cast("string"))))
    suffix = F.create_map(*[F.lit(x) for kv in KIND_SUFFIX.items() for x in kv])[kind]
    return F.concat(name, F.lit(":"), v, F.lit("|"), suffix)


def parse_statsd(line: Column) -> Column:
    """M03 reverse: struct(name, value, type) from a metric line."""
    pat = r"^([^:]+):([^|]+)\|(c|g|ms)$"
    return F.struct(F.regexp_extract(line, pat, 1).alias("name"),
                    F.regexp_extract(line, pat, 2).cast("double").alias("value"),
                    F.regexp_extract(line, pat, 3).alias("type"))


# ---------------------------------------------------------- name mapping

def map_metric_names(names: DataFrame, rules: Sequence[tuple], name_col: str = "name",
                     kind_col: str | None = None) -> DataFrame:
    """First matching glob rule per dotted name (and metric type, if ``kind_col`` gives the kind).

    A ``*`` stands for one part.  The rules' own places of ``*`` say which masks of
    a name can match, so each name is expanded into those masks only and
    equi-joined with the rule patterns, whatever the depth of names or rules.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} mapping rules")
    spark = names.sparkSession
    kind = F.lit(None).cast("string") if kind_col is None else F.col(kind_col)
    shapes = sorted({(pat.count(".") + 1, tuple(i for i, p in enumerate(pat.split(".")) if p == "*")) for pat, *_ in rules})
    rule_df = spark.createDataFrame(
        [(i, pat, type_, metric, list(labels)) for i, (pat, type_, metric, labels) in enumerate(rules)],
        "rule_index int, pattern string, rule_type string, metric string, label_names array<string>")
    shape_df = spark.createDataFrame([(n, list(stars)) for n, stars in shapes], "depth int, stars array<int>")
    given = names.select(F.col(name_col).alias("name"), kind.alias("kind")).distinct()
    n = given.withColumn("parts", F.split("name", r"\."))
    x = n.join(F.broadcast(shape_df), F.size("parts") == F.col("depth"))  # no more shapes than rules

    def starred(i):
        return F.array_contains("stars", i)

    pattern = F.array_join(F.transform("parts", lambda p, i: F.when(starred(i), F.lit("*")).otherwise(p)), ".")
    values = F.filter(F.transform("parts", lambda p, i: F.when(starred(i), p)), lambda v: v.isNotNull())
    x = x.select("name", "kind", pattern.alias("pattern"), values.alias("values"))
    kinds = F.create_map(*[F.lit(v) for kv in KIND_TYPE.items() for v in kv])
    right_type = F.col("rule_type").isNull() | F.col("kind").isNull() | (kinds[F.col("kind")] == F.col("rule_type"))
    hit = x.join(F.broadcast(rule_df), "pattern").where(right_type)  # at most MAX_RULES rows
    best = hit.groupBy("name", "kind").agg(F.min_by(F.struct("rule_index", "metric", "label_names", "values"),
                                            "rule_index").alias("r"))
    labels = F.array_join(F.array_sort(F.transform(F.arrays_zip(F.col("r.label_names"), F.col("r.values")),
                                                   lambda z: F.concat(z["label_names"], F.lit("="), z["values"]))), ",")
    matched = best.select(F.col("name").alias("m_name"), F.col("kind").alias("m_kind"), F.col("r.rule_index").alias("rule_index"), F.col("r.metric").alias("metric"),
                          labels.alias("labels"))
    # Names no rule matches keep the exporter's default: dots become underscores, no labels.
    out = given.join(matched, (F.col("name") == F.col("m_name")) & F.col("kind").eqNullSafe(F.col("m_kind")), "left")
    return out.select("name", *(["kind"] if kind_col else []), "rule_index",
                      F.coalesce(F.col("metric"), F.regexp_replace("name", r"\.", "_")).alias("metric"),
                      F.coalesce(F.col("labels"), F.lit("")).alias("labels"))


# ------------------------------------------------------- time-series math

def counter_increase(samples: DataFrame, by: Sequence[str], series: Sequence[str], window: str = "1 day",
                     order: Sequence[str] = ("ts",)) -> DataFrame:
    """``sum by (by) (increase(counter[window]))`` over tumbling windows.

    Only pairs of samples inside a window count (no extrapolation to the window
    edges, unlike Prometheus); sliding ranges are in ``counters``.
    """
    seg = segments(samples, series, F.window("ts", window).start, order).where("seg.n >= 2")
    return seg.groupBy(*by, F.col("step").alias("window_start")).agg(F.sum("seg.increase").alias("increase"))


def counter_rate(samples: DataFrame, by: Sequence[str], series: Sequence[str], window: str = "1 day",
                 window_seconds: int = 86400, order: Sequence[str] = ("ts",)) -> DataFrame:
    """``rate(counter[window])`` = increase / window seconds, summed by ``by``."""
    inc = counter_increase(samples, by, series, window, order)
    return inc.withColumn("rate", F.col("increase") / F.lit(float(window_seconds))).drop("increase")


def gauge_latest(samples: DataFrame, by: Sequence[str], order: Sequence[str] = ("ts",)) -> DataFrame:
    """The latest gauge value per series (partial aggregate)."""
    return samples.groupBy(*by).agg(F.max_by("value", F.struct(*order)).alias("value"))


def histogram_quantile(samples: DataFrame, q: float, by: Sequence[str], bounds: Sequence[float],
                       window: str | None = None) -> DataFrame:
    """``histogram_quantile(q, sum by (le, ...) (bucket counts))`` with linear interpolation.

    Observations are counted into cumulative ``le`` buckets (a small aggregate);
    the quantile is interpolated inside the bucket holding rank q x total.
    Past the last finite bound the last finite bound is returned.
    """
    keys = list(by) + (["window_start"] if window else [])
    x = samples.withColumn("window_start", F.window("ts", window).start) if window else samples
    b = sorted(bounds)
    le_idx = F.coalesce(*[F.when(F.col("value") <= F.lit(v), F.lit(i)) for i, v in enumerate(b)], F.lit(len(b)))
    counts = x.groupBy(*keys, le_idx.alias("le_idx")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys).orderBy("le_idx")
    bound_arr = F.array(*[F.lit(float(v)) for v in b])
    c = (counts.withColumn("cum", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("total", F.sum("n").over(Window.partitionBy(*keys))))
    c = c.withColumn("rank", F.lit(q) * F.col("total")).where(F.col("cum") >= F.col("rank"))
    first = c.groupBy(*keys).agg(F.min_by(F.struct("le_idx", "cum", "n", "rank"), "le_idx").alias("h"))
    i = F.col("h.le_idx")
    upper = F.when(i < len(b), F.element_at(bound_arr, (i + 1).cast("int")))
    lower = F.when(i == 0, F.lit(0.0)).otherwise(F.element_at(bound_arr, F.greatest(i, F.lit(1)).cast("int")))
    below = F.col("h.cum") - F.col("h.n")
    val = F.when(i >= len(b), F.lit(float(b[-1]))).otherwise(
        lower + (upper - lower) * (F.col("h.rank") - below) / F.col("h.n"))
    return first.select(*keys, val.alias("quantile"))


def fleet_status(samples: DataFrame, instance: Sequence[str], job_col: str, job_regex: str,
                 order: Sequence[str] = ("ts",)) -> DataFrame:
    """``sum(up{job=~re})``, ``max(value)`` and ``count`` with ``or vector(0)`` defaults."""
    latest = samples.where(F.col(job_col).rlike(job_regex)).groupBy(*instance).agg(
        F.max_by(F.struct("up", "value"), F.struct(*order)).alias("l"))
    agg = latest.agg(F.sum("l.up").alias("up"), F.max("l.value").alias("max_value"),
                     F.count(F.lit(1)).alias("instances"))
    return agg.select(F.coalesce(F.col("up"), F.lit(0)).cast("bigint").alias("up"),
                      F.coalesce(F.col("max_value"), F.lit(0.0)).alias("max_value"),
                      F.col("instances").cast("bigint").alias("instances"))
