"""Change-feed streaming: change log -> transform -> filter -> merge into a target log.

The source is Spark's file stream over the bronze log's ``_commit_version=N``
folders; each micro-batch (``foreachBatch``, ``availableNow``) is collapsed to
one change per key, merged into the target's latest state and committed as one
new target version.  A batch replayed after a crash is recognised by the
stream's own id (from its checkpoint) and the batch id, stored in ``_batch_ref``,
and skipped; streams that share a target or a query name never meet.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators.merge import UPSERT_TYPES, apply_changes
from strata.operators.metrics import batch_outcome, counted_metrics
from strata.operators.relational import change_type_filter
from strata.sources import changelog as CL

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class StreamConfig:
    """Where to read, where to write, where to keep progress, and where to start."""
    source: str
    target: str
    checkpoint: str
    query_name: str | None = None
    starting_version: int | None = None
    starting_timestamp: str | None = None


def identity(df: DataFrame) -> DataFrame:
    """The default transformer."""
    return df


def read_change_stream(spark: SparkSession, config: StreamConfig, schema=None) -> DataFrame:
    """The change feed of ``config.source`` as a stream.

    A start version wins over a start timestamp; the checkpoint wins over both
    on a rerun (the file source remembers which commits it has delivered).
    """
    if schema is None:
        schema = CL.read_log(spark, config.source).schema
    df = spark.readStream.schema(schema).option("basePath", config.source).parquet(config.source)
    if has_progress(spark, config.checkpoint):
        return df
    if config.starting_version is not None:
        df = df.where(F.col(CL.VERSION) >= F.lit(config.starting_version))
    elif config.starting_timestamp is not None:
        df = df.where(F.col(CL.COMMIT_TS) >= F.lit(config.starting_timestamp).cast(schema[CL.COMMIT_TS].dataType))
    return df


def has_progress(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a stream has run with this checkpoint: then it, not a start option, says where to go on."""
    _, _, path, fs = CL._jvm_fs(spark, f"{checkpoint}/offsets")
    return bool(fs.exists(path)) and len(fs.listStatus(path)) > 0


def stream_key(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint; a checkpoint without a stream yet goes by its path."""
    _, _, path, fs = CL._jvm_fs(spark, f"{checkpoint}/metadata")
    if fs.exists(path):
        return json.loads("".join(r.value for r in spark.read.text(f"{checkpoint}/metadata").collect()))["id"]  # one line
    return "path-" + hashlib.md5(checkpoint.rstrip("/").encode(), usedforsecurity=False).hexdigest()


def quarantine_root(target: str) -> str:
    """Rows that cannot be merged (a NULL in their key) are kept beside the target log."""
    return target.rstrip("/") + "__quarantine"


def merge_batch(spark: SparkSession, batch: DataFrame, batch_id: int, config: StreamConfig, key,
                columns: Sequence[str] | None = None, upsert_types: Sequence[str] = UPSERT_TYPES,
                metrics_path: str | None = None, stream_name: str | None = None,
                snapshot_every: int = 10, counted: Callable[[dict], None] | None = None) -> int | None:
    """One micro-batch: nothing for an empty batch; otherwise collapse, merge into the
    target's current state and commit the resulting change rows as one target version.
    Errors propagate so the batch is retried.  Rows with a NULL in the key are not
    merged: they go to the quarantine folder, one sub-folder per stream and batch.

    Only the target rows of the batch's keys are rebuilt (semi join before the snapshot
    aggregate), and every ``snapshot_every`` versions the target state is stored beside
    the log, so a batch's cost follows its own size, not the table's history.  Rows,
    versions and change types are observed as the batch and its commit pass
    (``counted`` gets those of the batch), so no count reads them again.
    """
    ref_stream = stream_key(spark, config.checkpoint)
    ref = f"{ref_stream}:{batch_id}"
    if CL.batch_seen(spark, config.target, ref):
        return None
    key_cols = [key] if isinstance(key, str) else list(key)
    began, name = time.monotonic(), stream_name or config.query_name or "stream"
    no_key = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in key_cols])
    read, written = Observation(), Observation()
    versions = [F.min(CL.VERSION).alias("start_version"), F.max(CL.VERSION).alias("end_version")] if CL.VERSION in batch.columns else []
    batch = batch.observe(read, F.count(F.lit(1)).alias("rows"), F.count_if(no_key).alias("rejected"), *versions,
                          *_type_counts()).persist()  # its keys and its changes are read below
    try:
        if not batch.count():  # one pass fills the cache and the counts
            return None
        counts = read.get
        bad, good = batch.where(no_key), batch.where(~no_key)
        if counts["rejected"]:
            bad.write.mode("overwrite").parquet(f"{quarantine_root(config.target)}/stream={ref_stream}/batch={batch_id}")
        current = CL.snapshot_at(spark, config.target, key_cols, only_keys=good)
        result = apply_changes(current, good, key_cols, columns=columns, upsert_types=upsert_types)
        version = CL.commit(spark, result.changes.observe(written, *_type_counts()), config.target, operation="MERGE", batch_ref=ref)
        if snapshot_every and version % snapshot_every == 0:
            CL.write_snapshot(spark, config.target, key_cols, version)
        if metrics_path:
            rows = counted_metrics(spark, name, counts, written.get).unionByName(batch_outcome(
                spark, name, time.monotonic() - began, failed=False, rejected=counts["rejected"]))
            write_metrics(rows, batch_id, metrics_path)
        if counted is not None:
            counted(counts)
        return version
    except Exception:
        if metrics_path:
            write_metrics(batch_outcome(spark, name, time.monotonic() - began, failed=True), batch_id, metrics_path)
        raise
    finally:
        batch.unpersist()


def _type_counts() -> list[Column]:
    return [F.count_if(F.col(CL.CHANGE_TYPE) == t).alias(t) for t in CL.CHANGE_TYPES]


def write_metrics(rows: DataFrame, batch_id: int, path: str) -> None:
    rows.withColumn("batch_id", F.lit(batch_id)).withColumn("ts", F.localtimestamp()).write.mode("append").parquet(path)


def run_stream(spark: SparkSession, config: StreamConfig, key, transform: Transform | None = None,
               change_filter: Transform | None = None, columns: Sequence[str] | None = None,
               upsert_types: Sequence[str] = UPSERT_TYPES, metrics_path: str | None = None,
               wait: bool = True, runs_path: str | None = None) -> StreamingQuery:
    """Source -> transformer -> filter -> merge sink, ``availableNow``, checkpointed.

    ``runs_path`` (with ``wait``) gets one row per run: the first and the last
    source version that it merged, null if none, and the rows (T07).
    """
    run = {"start_version": None, "end_version": None, "rows": 0}

    def counted(counts: dict) -> None:
        run["rows"] += counts["rows"]
        for field, pick in (("start_version", min), ("end_version", max)):
            known = [v for v in (run[field], counts.get(field)) if v is not None]
            run[field] = pick(known) if known else None

    stream = read_change_stream(spark, config)
    stream = (transform or identity)(stream)
    if change_filter is not None:
        stream = change_filter(stream)

    def sink(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch.sparkSession, batch, batch_id, config, key, columns, upsert_types, metrics_path,
                    counted=counted)

    writer = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", config.checkpoint)
              .trigger(availableNow=True))
    if config.query_name:
        writer = writer.queryName(config.query_name)
    q = writer.start()
    if wait:
        q.awaitTermination()
        if runs_path:
            rows = [(config.query_name, str(q.runId), run["start_version"], run["end_version"], run["rows"])]
            row = spark.createDataFrame(rows, "query_name string, run_id string, start_version long, end_version long, rows long")
            row.withColumn("ts", F.localtimestamp()).write.mode("append").parquet(runs_path)
    return q


def default_filter(types: Sequence[str] = ("insert", "update_postimage", "delete")) -> Transform:
    """P05 as a stream stage; the type list is validated when the stage is applied."""
    return lambda df: change_type_filter(df, list(types))


def progress(query: StreamingQuery) -> dict:
    """Start and end offsets of the last run (empty when nothing ran)."""
    p = query.lastProgress or {}
    srcs = p.get("sources") or [{}]
    return {"batch_id": p.get("batchId"), "start": srcs[0].get("startOffset"), "end": srcs[0].get("endOffset"),
            "rows": p.get("numInputRows")}


def seed_silver(spark: SparkSession, source: str, target: str, key, extra_columns: dict[str, str],
                version: int | None = None) -> int:
    """Create the target from a snapshot of the source plus NULL decorator columns
    (same-named source columns are replaced); returns the source version seeded from.
    The stream then starts at that version + 1."""
    log = CL.read_log(spark, source)
    if version is None:
        version = CL.committed_versions(spark, source)[-1]
    snap = CL.snapshot(log, key, as_of=version)
    for name, dtype in extra_columns.items():
        snap = snap.withColumn(name, F.lit(None).cast(dtype))
    CL.commit(spark, CL.as_changes(snap, 0, "insert").drop(CL.VERSION, CL.COMMIT_TS), target, version=0,
              operation="CREATE")
    return version


def start_without_version(spark: SparkSession, config: StreamConfig, key) -> StreamConfig:
    """A new stream with no start option first takes the current snapshot as inserts,
    then follows the commits after it."""
    versions = CL.committed_versions(spark, config.source)
    if not versions:
        return config
    latest = versions[-1]
    snap = CL.snapshot(CL.read_log(spark, config.source), key, as_of=latest)
    CL.commit(spark, CL.as_changes(snap, 0, "insert").drop(CL.VERSION, CL.COMMIT_TS), config.target, version=0,
              operation="CREATE")
    return StreamConfig(config.source, config.target, config.checkpoint, config.query_name, latest + 1, None)
