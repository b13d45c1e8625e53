"""Configured job sets (Z06): one entry = one parameterised job; absent sections are skipped and
missing settings take their defaults.  Scheduling itself is left to the platform's scheduler."""

from __future__ import annotations

import copy
import importlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import decorate as D
from strata.operators import ingest as IG
from strata.operators import merge as M
from strata.operators import metrics as MX
from strata.operators import sync as SY
from strata.session import materialize
from strata.sources import changelog as CL
from strata.sources.collection import read_collection
from strata.streaming import cdf

# Defaults per section.
DEFAULTS = {
    "ingest": {"kind": "documents"},
    "sync": {"format": "json", "options": {}, "mode": "append", "key": None, "exclude": [],
             "partition_ts": None, "json_columns": [], "limit": None, "move": None, "id": "_id", "dry_run": False},
    "streams": {"key": "_id", "change_types": ["insert", "update_postimage", "delete"], "query_name": None},
    "decorate": {"decorator": "summary", "key": "_id", "text": "text", "limit": None, "metrics": None,
                 "model": None, "inputs": None, "schema": None, "batch_rows": 64},
}
SECTIONS = ("ingest", "sync", "streams", "decorate")


def with_defaults(section: str, entry: dict) -> dict:
    return {**copy.deepcopy(DEFAULTS[section]), **entry}


def run_ingest(spark: SparkSession, job: dict) -> dict:
    """Inbox folder -> document or chapter rows, one commit; counts of the outcomes."""
    done = IG.ingest_folder(spark, job["inbox"], job["target"], job["kind"])
    if done is None:
        return {"job": "ingest", "version": None, "outcomes": {}}
    outcomes, version = done
    counts = {r.outcome: r["count"] for r in outcomes.groupBy("outcome").count().collect()}  # three kinds
    return {"job": "ingest", "version": version, "outcomes": counts}


def run_sync(spark: SparkSession, job: dict) -> dict:
    """Collection -> bronze change log (append or hash upsert).

    ``move`` (the default of append only) gives the documents that stay: the source
    without the ids of this run's commit.  ``dry_run`` counts and writes nothing.
    """
    src = read_collection(spark, job["source"], job["format"], job["options"])
    upsert = job["mode"] == "upsert"
    if src.isEmpty():
        return {"job": "sync", "rows": 0}
    if job["dry_run"]:
        rows = SY.prepare_batch(src, None, (), job["limit"], job["id"])
        return {"job": "sync", "rows": rows.count(), "version": None, "dry_run": True}
    partition_by: tuple = ()
    if upsert:
        versions = CL.committed_versions(spark, job["target"])
        rows = SY.prepare_batch(src, None, job["json_columns"], job["limit"], job["id"])
        # Only the rows this run can touch are rebuilt from the bronze log.
        current = CL.snapshot_at(spark, job["target"], job["key"], only_keys=rows) if versions else None
        changes = M.upsert_by_hash(current, rows, job["key"], job["exclude"]).changes
    else:
        rows = SY.prepare_batch(src, job["partition_ts"], job["json_columns"], job["limit"], job["id"])
        changes = rows.withColumn(CL.CHANGE_TYPE, F.lit("insert"))
        partition_by = ("year", "month") if job["partition_ts"] else ()
    version = CL.commit(spark, changes, job["target"], operation="SYNC", partition_by=partition_by)
    out = {"job": "sync", "version": version}
    if job["move"] if job["move"] is not None else not upsert:
        out["residual"] = SY.residual_after_commit(spark, src, job["target"], version, job["id"])
    return out


def run_stream_job(spark: SparkSession, job: dict) -> dict:
    """Bronze -> silver: seed on the first run, then stream from the seeded version + 1."""
    start = None
    if not CL.committed_versions(spark, job["target"]):
        start = cdf.seed_silver(spark, job["source"], job["target"], job["key"], D.DECORATOR_COLUMNS) + 1
    cfg = cdf.StreamConfig(job["source"], job["target"], job["checkpoint"], job["query_name"], start)
    cols = [c for c in CL.data_columns(CL.read_log(spark, job["source"])) if c not in D.DECORATOR_COLUMNS]
    q = cdf.run_stream(spark, cfg, job["key"], change_filter=cdf.default_filter(job["change_types"]), columns=cols)
    return {"job": "stream", "progress": cdf.progress(q)}


def _decorated(todo: DataFrame, decorator: str, text: str) -> tuple[DataFrame, list[str]]:
    """The pending rows with the decorator's columns filled by its default backend."""
    if decorator == "summary":
        return todo.withColumn("summary", D.extractive_summary(F.col(text))), ["summary"]
    if decorator == "ner_nel":
        return todo.withColumn("ner_nel", D.entity_json(F.col(text))), ["ner_nel"]
    return D.with_embeddings(todo, text), list(D.EMBEDDING_COLUMNS)


class DecorationFailed(RuntimeError):
    """Rows were pending and the model succeeded on none of them."""


def _model(spec):
    """A function, or ``package.module:function``, that maps a batch of inputs to a batch of the decorator's columns."""
    if callable(spec):
        return spec
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def _modelled(todo: DataFrame, job: dict) -> tuple[DataFrame, list[str]]:
    """The rows on which the configured model succeeded, with the columns of ``schema`` (DDL); one failing row fails alone."""
    columns = StructType.fromDDL(job["schema"]).fieldNames()
    res = D.run_decorator(todo, _model(job["model"]), job["key"], job["inputs"] or [job["text"]], job["schema"], job["batch_rows"])
    return materialize(res, "decorated").where("ok"), columns


def run_decorate(spark: SparkSession, job: dict) -> dict:
    """Silver decoration by the configured model, or the decorator's default backend; one commit per run.

    Rows on which the model fails stay pending for the next run.  If it succeeds
    on none, nothing is committed and the run fails, its counts written first.
    """
    silver = CL.snapshot_at(spark, job["table"], job["key"])
    todo = materialize(D.pending(silver, job["decorator"], job["key"], job["text"], job["limit"]), "pending")
    waiting = todo.count()
    if not waiting:
        return {"job": "decorate", "version": None, "pending": 0, "succeeded": 0, "failed": 0}
    done, columns = _modelled(todo, job) if job["model"] else _decorated(todo, job["decorator"], job["text"])
    written, version = Observation(), None
    if not job["model"] or not done.isEmpty():
        res = M.merge_update(todo, done.select(job["key"], *columns), job["key"], columns)
        updated = F.count_if(F.col(CL.CHANGE_TYPE) == "update_postimage").alias("updated")
        version = CL.commit(spark, res.changes.observe(written, updated), job["table"], operation="DECORATE")
    ok = written.get["updated"] if version is not None else 0
    if job["metrics"]:
        rows = MX.decorator_metrics(spark, job["decorator"], waiting, ok, waiting - ok)
        cdf.write_metrics(rows, version or 0, job["metrics"])
    if not ok:
        raise DecorationFailed(f"{job['decorator']}: none of {waiting} pending rows was decorated")
    return {"job": "decorate", "version": version, "pending": waiting, "succeeded": ok, "failed": waiting - ok}


RUNNERS = {"ingest": run_ingest, "sync": run_sync, "streams": run_stream_job, "decorate": run_decorate}


def run_jobs(spark: SparkSession, config: dict) -> list[dict]:
    """Run every configured entry, section by section in a fixed order (ingest, sync, streams, decorate)."""
    return [RUNNERS[section](spark, with_defaults(section, entry))
            for section in SECTIONS for entry in config.get(section) or []]
