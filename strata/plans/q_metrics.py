"""Metric and time-series queries (M01, M03-M09) over F1 batches, F7 counters and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import counters as CT
from strata.operators import merge as M
from strata.operators import metrics as MX
from strata.operators import quantiles as QT
from strata.operators.relational import change_type_filter
from strata.plans.fixtures import F1_SQL, F7_SQL, f1_change_log, f7_counters
from strata.plans.registry import query
from strata.sources import changelog as CL
from strata.sources.tables import read_table

STREAM = "orders silver"
PREFIX = "stream_jobs"


@query("batch_metrics", f"""WITH {F1_SQL},
b AS (SELECT * FROM f1 WHERE _commit_version >= 1 AND _change_type IN ('insert', 'update_postimage', 'delete'))
SELECT 'orders silver' AS stream, 'batch_rows' AS metric, CAST(NULL AS VARCHAR) AS label, 'gauge' AS kind,
       CAST(count(*) AS DOUBLE) AS value FROM b
UNION ALL SELECT 'orders silver', 'processed', _change_type, 'counter', CAST(count(*) AS DOUBLE) FROM b GROUP BY _change_type
UNION ALL SELECT 'orders silver', 'merge', 'inserted', 'counter', CAST(count(*) AS DOUBLE) FROM orders WHERE o_orderkey % 5 = 4
UNION ALL SELECT 'orders silver', 'merge', 'updated', 'counter', CAST(count(*) AS DOUBLE) FROM orders
  WHERE o_orderkey % 10 = 1 AND o_orderkey % 7 <> 0
UNION ALL SELECT 'orders silver', 'merge', 'deleted', 'counter', CAST(count(*) AS DOUBLE) FROM orders
  WHERE o_orderkey % 5 <> 4 AND o_orderkey % 7 = 0
UNION ALL SELECT 'orders silver', 'batches', 'succeeded', 'counter', 1.0""")
def batch_metrics(spark, sf_dir):
    log = f1_change_log(spark, sf_dir)
    batch = change_type_filter(CL.change_feed(log, start=1), ["insert", "update_postimage", "delete"])
    merged = M.apply_changes(CL.snapshot(log, "o_orderkey", as_of=0), batch, "o_orderkey").changes
    return MX.batch_metrics(batch, merged, STREAM)


@query("statsd_lines", f"""WITH {F1_SQL}, c AS (SELECT _commit_version AS version, _change_type, count(*) AS n FROM f1 GROUP BY ALL)
SELECT version, 'stream_jobs.orders_silver.batch_rows:' || CAST(sum(n) AS VARCHAR) || '|g' AS line FROM c GROUP BY version
UNION ALL SELECT version, 'stream_jobs.orders_silver.processed.' || _change_type || ':' || CAST(n AS VARCHAR) || '|c' FROM c
UNION ALL SELECT DISTINCT version, 'stream_jobs.orders_silver.batches.succeeded:1|c' FROM c""")
def statsd_lines(spark, sf_dir):
    m = MX.batch_metrics(f1_change_log(spark, sf_dir), None, STREAM, by=["_commit_version"])
    name = MX.metric_name(F.col("stream"), F.col("metric"), F.col("label"), PREFIX)
    return m.select(F.col("_commit_version").alias("version"),
                    MX.statsd_line(name, F.col("kind"), F.col("value")).alias("line"))


def _metric_names(spark, sf_dir):
    """Names with their kinds: executor counters, stream metrics (some of the wrong kind) and deep unknown names."""
    ev = read_table(spark, sf_dir, "events")
    kind = F.col("event_type")
    user = (F.col("user_id") % 5).cast("string")

    def named(metric_kind, *parts):
        return F.struct(F.concat(*[p if hasattr(p, "cast") else F.lit(p) for p in parts]).alias("name"),
                        F.lit(metric_kind).alias("kind"))

    names = F.array(
        named("gauge", "spark.app-", user, ".", kind, ".executor.recordsRead"),
        named("gauge", "spark.app-", user, ".", kind, ".executor.filesystem.file.read_bytes"),
        named("counter", "stream_jobs.", kind, ".processed.insert"), named("gauge", "stream_jobs.", kind, ".pending"),
        named("counter", "stream_jobs.", kind, ".pending"), named("timer", "stream_jobs.", kind, ".batch_duration"),
        named("counter", "stream_jobs.", kind, ".merge.u", user), named("gauge", "other.a.b.c.d.e.f.g.h.", kind, ".count"))
    return ev.select(F.explode(names).alias("x")).select("x.*")


NAMES_SQL = """n AS (SELECT DISTINCT x.name AS name, x.kind AS kind FROM (SELECT unnest([
  {'name': 'spark.app-' || CAST(user_id % 5 AS VARCHAR) || '.' || event_type || '.executor.recordsRead', 'kind': 'gauge'},
  {'name': 'spark.app-' || CAST(user_id % 5 AS VARCHAR) || '.' || event_type || '.executor.filesystem.file.read_bytes', 'kind': 'gauge'},
  {'name': 'stream_jobs.' || event_type || '.processed.insert', 'kind': 'counter'},
  {'name': 'stream_jobs.' || event_type || '.pending', 'kind': 'gauge'},
  {'name': 'stream_jobs.' || event_type || '.pending', 'kind': 'counter'},
  {'name': 'stream_jobs.' || event_type || '.batch_duration', 'kind': 'timer'},
  {'name': 'stream_jobs.' || event_type || '.merge.u' || CAST(user_id % 5 AS VARCHAR), 'kind': 'counter'},
  {'name': 'other.a.b.c.d.e.f.g.h.' || event_type || '.count', 'kind': 'gauge'}]) AS x FROM events))"""


def _rules_sql():
    rows = []
    for i, (pat, kind, metric, labels) in enumerate(MX.mapping_rules(PREFIX)):
        rx = "^" + pat.replace(".", "\\.").replace("*", "([^.]+)") + "$"
        l1 = labels[0] if labels else ""
        l2 = labels[1] if len(labels) > 1 else ""
        rows.append(f"({i}, '{rx}', '{(kind or '').replace('observer', 'timer')}', '{metric}', '{l1}', '{l2}')")
    return "r(rule_index, rx, rkind, metric, l1, l2) AS (VALUES " + ", ".join(rows) + ")"


@query("metric_mapping", f"""WITH {NAMES_SQL}, {_rules_sql()},
m AS (SELECT n.name, n.kind, r.*, row_number() OVER (PARTITION BY n.name, n.kind ORDER BY r.rule_index) AS rn
      FROM n JOIN r ON regexp_full_match(n.name, r.rx) AND (r.rkind = '' OR r.rkind = n.kind)),
b AS (SELECT name, kind, rule_index, metric,
        array_to_string(list_sort(list_filter([
          CASE WHEN l1 <> '' THEN l1 || '=' || regexp_extract(name, rx, 1) END,
          CASE WHEN l2 <> '' THEN l2 || '=' || regexp_extract(name, rx, 2) END], lambda x: x IS NOT NULL)), ',') AS labels
      FROM m WHERE rn = 1)
SELECT n.name, n.kind, b.rule_index, coalesce(b.metric, replace(n.name, '.', '_')) AS metric, coalesce(b.labels, '') AS labels
FROM n LEFT JOIN b ON b.name = n.name AND b.kind = n.kind""")
def metric_mapping(spark, sf_dir):
    return MX.map_metric_names(_metric_names(spark, sf_dir), MX.mapping_rules(PREFIX), kind_col="kind")


INC_SQL = f"""WITH {F7_SQL}, p AS (
  SELECT *, date_trunc('day', ts) AS w,
         lag(value) OVER (PARTITION BY stream, date_trunc('day', ts) ORDER BY ts, event_id) AS prev FROM f7)"""


@query("counter_increase", INC_SQL + """
SELECT stream, w AS window_start, sum(CASE WHEN value >= prev THEN value - prev ELSE value END) AS increase
FROM p WHERE prev IS NOT NULL GROUP BY stream, w""")
def counter_increase(spark, sf_dir):
    return MX.counter_increase(f7_counters(spark, sf_dir), ["stream"], ["stream"], "1 day",
                               order=("ts", "event_id"))


@query("counter_rate", INC_SQL + """
SELECT stream, w AS window_start, sum(CASE WHEN value >= prev THEN value - prev ELSE value END) / 86400.0 AS rate
FROM p WHERE prev IS NOT NULL GROUP BY stream, w""")
def counter_rate(spark, sf_dir):
    return MX.counter_rate(f7_counters(spark, sf_dir), ["stream"], ["stream"], "1 day", 86400,
                           order=("ts", "event_id"))


# Ranges of six hours, evaluated every hour: each sample is seen by the six ranges that reach it.
SLIDING_SQL = f"""WITH {F7_SQL}, s AS (SELECT *, CAST(ceil(epoch_us(ts) / 3600000000.0) AS BIGINT) AS step FROM f7),
e AS (SELECT stream, ts, event_id, value, unnest(range(step, step + 6)) AS n FROM s),
p AS (SELECT *, lag(value) OVER (PARTITION BY stream, n ORDER BY ts, event_id) AS prev FROM e)
SELECT stream, TIMESTAMP '1970-01-01' + to_hours(n) AS step_end,
  sum(CASE WHEN value >= prev THEN value - prev ELSE value END){{per}} AS {{name}} FROM p WHERE prev IS NOT NULL GROUP BY stream, n"""


@query("counter_increase_sliding", SLIDING_SQL.format(per="", name="increase"))
def counter_increase_sliding(spark, sf_dir):
    return CT.sliding_increase(f7_counters(spark, sf_dir), ["stream"], ["stream"], 6 * 3600, 3600, order=("ts", "event_id"))


@query("counter_rate_sliding", SLIDING_SQL.format(per=" / 21600.0", name="rate"))
def counter_rate_sliding(spark, sf_dir):
    return CT.sliding_rate(f7_counters(spark, sf_dir), ["stream"], ["stream"], 6 * 3600, 3600, order=("ts", "event_id"))


BOUNDS = (1.0, 2.5, 5.0, 10.0, 25.0, 50.0, 100.0)
_LE_SQL = "CASE " + " ".join(f"WHEN value <= {b} THEN {i}" for i, b in enumerate(BOUNDS)) + f" ELSE {len(BOUNDS)} END"
_B_SQL = "[" + ", ".join(str(b) for b in BOUNDS) + "]"


@query("duration_p95", f"""WITH e AS (SELECT event_type, date_trunc('day', ts) AS window_start, {_LE_SQL} AS le_idx FROM events),
c AS (SELECT event_type, window_start, le_idx, count(*) AS n FROM e GROUP BY ALL),
cc AS (SELECT *, sum(n) OVER (PARTITION BY event_type, window_start ORDER BY le_idx) AS cum,
              sum(n) OVER (PARTITION BY event_type, window_start) AS total FROM c),
r AS (SELECT *, 0.95 * total AS rk, row_number() OVER (PARTITION BY event_type, window_start ORDER BY le_idx) AS rn
      FROM cc WHERE cum >= 0.95 * total)
SELECT event_type, window_start, round(CASE WHEN le_idx >= {len(BOUNDS)} THEN {BOUNDS[-1]}
  ELSE (CASE WHEN le_idx = 0 THEN 0.0 ELSE {_B_SQL}[le_idx] END)
     + ({_B_SQL}[le_idx + 1] - (CASE WHEN le_idx = 0 THEN 0.0 ELSE {_B_SQL}[le_idx] END)) * (rk - (cum - n)) / n END, 6)
  AS quantile FROM r WHERE rn = 1""")
def duration_p95(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_type", "ts", "value")
    q = MX.histogram_quantile(ev, 0.95, ["event_type"], BOUNDS, window="1 day")
    return q.withColumn("quantile", F.round("quantile", 6))


@query("duration_p95_exact", """SELECT event_type, date_trunc('day', ts) AS window_start, count(value) AS n,
  round(quantile_cont(value, 0.95), 6) AS quantile FROM events GROUP BY ALL""")
def duration_p95_exact(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_type", F.window("ts", "1 day").start.alias("window_start"), "value")
    out = QT.exact_quantile(ev, 0.95, ["event_type", "window_start"])
    return out.withColumn("quantile", F.round("quantile", 6))


@query("gauge_latest", """SELECT event_type AS stream, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def gauge_latest(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").withColumnRenamed("event_type", "stream")
    return MX.gauge_latest(ev, ["stream"], order=("ts", "event_id"))


def _fleet(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    job = F.concat(F.when(F.col("event_type").isin("click", "view"), F.lit("spark-")).otherwise(F.lit("airflow-")),
                   F.col("event_type"))
    return ev.select("ts", "event_id", job.alias("job"), (F.col("user_id") % 4).alias("inst"),
                     F.when(F.col("value") > 5, 1).otherwise(0).alias("up"), "value")


FLEET_SQL = """s AS (SELECT ts, event_id, CASE WHEN event_type IN ('click', 'view') THEN 'spark-' ELSE 'airflow-' END || event_type AS job,
  user_id % 4 AS inst, CASE WHEN value > 5 THEN 1 ELSE 0 END AS up, value FROM events),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job, inst ORDER BY ts DESC, event_id DESC) AS rn FROM s
      WHERE regexp_matches(job, '{rx}')) WHERE rn = 1)
SELECT CAST(coalesce(sum(up), 0) AS BIGINT) AS up, coalesce(max(value), 0.0) AS max_value, count(*) AS instances FROM l"""


@query("fleet_status", "WITH " + FLEET_SQL.format(rx="^spark-.*"))
def fleet_status(spark, sf_dir):
    return MX.fleet_status(_fleet(spark, sf_dir), ["job", "inst"], "job", "^spark-.*", order=("ts", "event_id"))


@query("fleet_status_default", "WITH " + FLEET_SQL.format(rx="^spark-driver$"))
def fleet_status_default(spark, sf_dir):
    # No job matches: sum(up) "or vector(0)" gives 0 instead of nothing.
    return MX.fleet_status(_fleet(spark, sf_dir), ["job", "inst"], "job", "^spark-driver$", order=("ts", "event_id"))


@query("stream_picker", "SELECT DISTINCT event_type AS stream FROM events")
def stream_picker(spark, sf_dir):
    # Distinct streams for a picker.
    return read_table(spark, sf_dir, "events").select(F.col("event_type").alias("stream")).distinct()
