"""SparkSession factory and shared-folder resolution."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches stay small so a Python worker never holds a huge batch.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every job relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Jobs write intermediate tables, stream checkpoints and cut lineage there.
    Only when the setting is absent on a local master (tests) is a private folder
    created and registered; on a cluster that is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured and not current:
        sc.setCheckpointDir(configured)
        current = sc.getCheckpointDir()
    if not current and not configured:
        if not sc.master.startswith("local"):  # "local[*]", but also "local-cluster[...]", whose executors share a disk
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        local = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", local)
        sc.setCheckpointDir(local)
        current = sc.getCheckpointDir()
    root = current or configured
    # setCheckpointDir appends a per-application uuid folder; keep it.
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root (never reused)."""
    return f"{shared_root(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"


def as_local(path: str) -> str:
    """Strip a ``file:`` scheme for local-only helpers (tests)."""
    return path[5:] if path.startswith("file:") else path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Executors delete the shuffle files of each query run in this block as soon as it ends.

    Otherwise they stay until the driver happens to collect its garbage, and a job of
    many steps may hold the shuffles of all of them on disk at once.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df, name: str):
    """Write ``df`` once as parquet under the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` (the files outlive lost executors),
    but later reads are columnar: pruned to the columns each consumer needs and
    much cheaper than deserialising checkpointed rows.  What was shuffled for it
    is not needed again and goes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.mode("errorifexists").parquet(path)
    out = spark.read.parquet(path)
    out.scratch_folder = path
    return out


def discard(df) -> None:
    """Delete the files of a table of ``materialize`` that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df, *keys: str):
    """``df`` dealt by ``keys`` to twice the shuffle partitions, before Python work on its groups.

    Few bytes are much work there: adaptive execution, which goes by bytes, would
    put the groups together in a task or two.  A repartition to the number that the
    rows have already would be left out, hence twice.
    """
    return df.repartition(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
