"""Versioned tables as change logs.

A versioned table is one plain partitioned parquet dataset::

    <root>/_commit_version=N/part-*.parquet
      data columns..., _change_type, _commit_timestamp, _operation, _batch_ref

Snapshots, time travel, history and change feeds are DataFrame functions over
that log; the change stream is Spark's file source over the same folders
(``strata.streaming.cdf``).  All functions here take the log as a DataFrame so
they work the same on a log read from storage and on one derived in memory.

"Latest row per key" is a ``max_by`` aggregate, not a ``row_number`` window:
the aggregate combines map-side, so a key holding a third of all changes is
reduced before the shuffle instead of landing whole in one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

# The change types of a change feed and their order inside one version.
CHANGE_TYPES = ("insert", "update_preimage", "update_postimage", "delete")
VERSION = "_commit_version"
CHANGE_TYPE = "_change_type"
COMMIT_TS = "_commit_timestamp"
OPERATION = "_operation"
BATCH_REF = "_batch_ref"
META_COLUMNS = (CHANGE_TYPE, VERSION, COMMIT_TS, OPERATION, BATCH_REF)


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def type_rank(col: Column | None = None) -> Column:
    """Order of change types inside one version (preimage first, delete last)."""
    c = F.col(CHANGE_TYPE) if col is None else col
    return (F.when(c == "update_preimage", 0).when(c == "insert", 1)
            .when(c == "update_postimage", 2).when(c == "delete", 3).otherwise(4))


def data_columns(log: DataFrame) -> list[str]:
    return [c for c in log.columns if c not in META_COLUMNS]


def latest_per_key(df: DataFrame, key, order: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the greatest ``order`` (a struct of sort keys).

    Hash/sort aggregate with partial aggregation; NULL keys form one group, as
    ``GROUP BY`` does.
    """
    keys = _keys(key)
    cols = list(columns) if columns is not None else df.columns
    payload = F.struct(*[F.col(f"`{c}`") for c in cols])
    agg = df.groupBy(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.max_by(payload, order).alias("__row"))
    return agg.select("__row.*")


def snapshot(log: DataFrame, key, as_of: int | None = None, as_of_ts=None,
             keep_meta: bool = False) -> DataFrame:
    """Table state at version ``as_of`` (or at a commit timestamp), latest if both None."""
    df = log.where(F.col(CHANGE_TYPE) != "update_preimage")
    if as_of is not None:
        df = df.where(F.col(VERSION) <= F.lit(as_of))
    elif as_of_ts is not None:
        df = df.where(F.col(COMMIT_TS) <= F.lit(as_of_ts).cast(log.schema[COMMIT_TS].dataType))
    order = F.struct(F.col(VERSION), type_rank())
    last = latest_per_key(df, key, order)
    last = last.where(F.col(CHANGE_TYPE) != "delete")
    cols = last.columns if keep_meta else data_columns(last)
    return last.select(*[F.col(f"`{c}`") for c in cols])


def change_feed(log: DataFrame, start: int | None = None, end: int | None = None,
                start_ts=None, end_ts=None) -> DataFrame:
    """Change rows between versions (inclusive).

    A start version wins over a start timestamp.  A timestamp selects the
    versions committed at or after it; every row of a version carries the same
    commit time, so this is a plain filter that prunes ``_commit_version``.
    """
    df = log
    if start is not None:
        df = df.where(F.col(VERSION) >= F.lit(start))
    elif start_ts is not None:
        df = df.where(F.col(COMMIT_TS) >= F.lit(start_ts).cast(log.schema[COMMIT_TS].dataType))
    if end is not None:
        df = df.where(F.col(VERSION) <= F.lit(end))
    elif end_ts is not None:
        df = df.where(F.col(COMMIT_TS) <= F.lit(end_ts).cast(log.schema[COMMIT_TS].dataType))
    return df


def latest_version(log: DataFrame) -> DataFrame:
    """The newest version number, one row."""
    return log.agg(F.max(VERSION).alias("version"))


def history(log: DataFrame) -> DataFrame:
    """One row per version with its operation and row counts, newest first."""
    has_op = OPERATION in log.columns
    aggs = [
        F.min(COMMIT_TS).alias("timestamp"),
        (F.min(OPERATION) if has_op else F.lit(None).cast("string")).alias("operation"),
        F.count(F.lit(1)).alias("num_rows"),
    ]
    for t in CHANGE_TYPES:
        aggs.append(F.sum(F.when(F.col(CHANGE_TYPE) == t, 1).otherwise(0)).alias(f"num_{t}"))
    return log.groupBy(F.col(VERSION).alias("version")).agg(*aggs).orderBy(F.col("version").desc())


def as_changes(df: DataFrame, version, change_type: str = "insert", commit_ts=None,
               operation: str | None = None) -> DataFrame:
    """Tag plain rows as change rows of one version."""
    ts = F.lit(commit_ts) if commit_ts is not None else F.current_timestamp()
    if commit_ts is not None and isinstance(commit_ts, str):
        ts = F.to_timestamp_ntz(F.lit(commit_ts))
    out = (df.withColumn(CHANGE_TYPE, F.lit(change_type))
           .withColumn(VERSION, F.lit(version).cast("bigint"))
           .withColumn(COMMIT_TS, ts))
    if operation is not None:
        out = out.withColumn(OPERATION, F.lit(operation))
    return out


def overwrite_changes(current: DataFrame, new: DataFrame, key) -> DataFrame:
    """An overwrite as change rows = diff of the two states."""
    from strata.operators.merge import snapshot_diff

    return snapshot_diff(current, new, key)


def append_schema(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append with schema evolution; old rows read NULL for new columns, order kept."""
    return old.unionByName(new, allowMissingColumns=True)


# ----------------------------------------------------------------- storage

def _jvm_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, jpath, jpath.getFileSystem(conf)


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Version numbers present under ``root`` (a directory listing, not a data scan)."""
    jvm, _, jpath, fs = _jvm_fs(spark, root)
    if not fs.exists(jpath):
        return []
    out = []
    for st in fs.listStatus(jpath):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(VERSION + "="):
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def next_version(spark: SparkSession, root: str) -> int:
    v = committed_versions(spark, root)
    return (v[-1] + 1) if v else 0


def version_path(root: str, version: int) -> str:
    return f"{root}/{VERSION}={version}"


def log_schema(spark: SparkSession, root: str) -> StructType | None:
    """Schema of the log: that of its newest commit, which holds every earlier column (see ``commit``)."""
    versions = committed_versions(spark, root)
    if not versions:
        return None
    newest = spark.read.parquet(version_path(root, versions[-1])).schema
    return StructType([*newest.fields, StructField(VERSION, LongType(), True)])


def read_log(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """Read every committed version (staging folders start with ``_`` and stay hidden).

    Columns that came with a later commit read as NULL in the earlier ones.
    """
    reader = spark.read.option("basePath", root)
    schema = schema or log_schema(spark, root)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(root)


def batch_seen(spark: SparkSession, root: str, batch_ref: str) -> bool:
    """True when a commit carries ``batch_ref`` (a batch replayed after a crash).

    A replay follows its query's last commit, but other writers may have
    committed since: versions are looked at from the newest down to the first one
    of the same query, so the check does not grow with the table's history.
    """
    query = batch_ref.rsplit(":", 1)[0]
    for version in reversed(committed_versions(spark, root)):
        folder = spark.read.parquet(version_path(root, version))
        if BATCH_REF not in folder.columns:
            continue
        row = folder.select(BATCH_REF).first()  # one value per commit
        if row is not None and row[0] is not None and row[0].rsplit(":", 1)[0] == query:
            return row[0] == batch_ref
    return False


def commit(spark: SparkSession, changes: DataFrame, root: str, version: int | None = None,
           operation: str = "WRITE", commit_ts=None, batch_ref: str | None = None,
           partition_by: Sequence[str] = ()) -> int:
    """Write one version, once (its files below folders of ``partition_by``).

    Rows are written to ``<root>/_staging/<uuid>`` and the folder is renamed to
    ``_commit_version=N`` without overwrite, so readers and the change stream
    never see half a commit and a second writer of version N fails.
    """
    if version is None:
        version = next_version(spark, root)
    out = changes
    if VERSION in out.columns:
        out = out.drop(VERSION)
    if commit_ts is not None:
        ts = F.lit(commit_ts).cast("timestamp_ntz")
    elif COMMIT_TS in out.columns:
        ts = F.col(COMMIT_TS).cast("timestamp_ntz")
    else:
        ts = F.localtimestamp()
    known = log_schema(spark, root)
    for field in known.fields if known is not None else ():  # a commit holds all columns of those before it
        if field.name not in (VERSION, COMMIT_TS, OPERATION, BATCH_REF) and field.name not in out.columns:
            out = out.withColumn(field.name, F.lit(None).cast(field.dataType))
    out = (out.withColumn(COMMIT_TS, ts)
           .withColumn(OPERATION, F.lit(operation))
           .withColumn(BATCH_REF, F.lit(batch_ref).cast("string")))
    staging = f"{root}/_staging/{uuid.uuid4().hex}"
    out.write.mode("errorifexists").partitionBy(*partition_by).parquet(staging)
    jvm, conf, src, fs = _jvm_fs(spark, staging)
    dst = jvm.org.apache.hadoop.fs.Path(f"{root}/{VERSION}={version}")
    fc = jvm.org.apache.hadoop.fs.FileContext.getFileContext(src.toUri(), conf)
    # Rename without OVERWRITE: fails if the version exists (write-once commits).
    none = jvm.org.apache.hadoop.fs.Options.Rename.valueOf("NONE")
    fc.rename(src, dst, _rename_options(spark, none))
    return version


def _rename_options(spark: SparkSession, opt):
    gw = spark.sparkContext._gateway
    arr = gw.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    arr[0] = opt
    return arr


def snapshots_root(root: str) -> str:
    """Stored snapshots live beside the log, never inside it (the stream would replay them)."""
    return root.rstrip("/") + "__snapshots"


def write_snapshot(spark: SparkSession, root: str, key, version: int) -> str:
    """Materialise the state at ``version`` so later reads replay only newer commits."""
    state = snapshot_at(spark, root, key, as_of=version)  # from the stored snapshot before it
    path = f"{snapshots_root(root)}/version={version}"
    state.write.mode("errorifexists").parquet(path)
    return path


def snapshot_at(spark: SparkSession, root: str, key, as_of: int | None = None,
                only_keys: DataFrame | None = None) -> DataFrame:
    """S03 on storage: newest stored snapshot <= ``as_of`` + the commits after it.

    ``only_keys`` restricts the result to those keys with a null-safe semi join *before*
    the latest-per-key aggregate (a merge needs only the rows its batch touches).
    """
    log = read_log(spark, root)
    keys = _keys(key)

    def restrict(df):
        if only_keys is None:
            return df
        wanted = only_keys.select(*[F.col(k).alias(f"__want_{k}") for k in keys]).distinct()
        same = [df[k].eqNullSafe(wanted[f"__want_{k}"]) for k in keys]
        return df.join(wanted, same, "left_semi")

    base_version = None
    jvm, _, jpath, fs = _jvm_fs(spark, snapshots_root(root))
    if fs.exists(jpath):
        stored = sorted(int(st.getPath().getName().split("=", 1)[1]) for st in fs.listStatus(jpath)
                        if st.getPath().getName().startswith("version="))
        stored = [v for v in stored if as_of is None or v <= as_of]
        base_version = stored[-1] if stored else None
    if base_version is None:
        return snapshot(restrict(log), key, as_of=as_of)
    base = restrict(spark.read.schema(StructType([f for f in log.schema.fields if f.name in data_columns(log)]))
                    .parquet(f"{snapshots_root(root)}/version={base_version}"))
    newer = restrict(log.where(F.col(VERSION) > base_version))
    base_log = base.select(*[F.col(f"`{c}`") for c in data_columns(newer)]).withColumn(
        CHANGE_TYPE, F.lit("insert")).withColumn(VERSION, F.lit(base_version).cast("int"))
    merged = newer.select(*data_columns(newer), CHANGE_TYPE, VERSION).unionByName(
        base_log.withColumn(VERSION, F.col(VERSION).cast(newer.schema[VERSION].dataType)))
    return snapshot(merged, key, as_of=as_of)
