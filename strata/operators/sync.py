"""Collection -> bronze sync: append with move semantics, or content-hash upsert."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.schema import void_to_string
from strata.operators.merge import MergeResult, upsert_by_hash
from strata.operators.relational import top_rows
from strata.sources.changelog import version_path

_ILLEGAL = re.compile(r"[^0-9A-Za-z_]")


def table_name(configured: str) -> str:
    """Catalog identifiers allow letters, digits and ``_``: dots become ``_``, others are rejected."""
    name = configured.replace(".", "_")
    if _ILLEGAL.search(name):
        raise ValueError(f"illegal table name: {configured!r}")
    return name


def with_partition_columns(df: DataFrame, ts_column: str) -> DataFrame:
    """``year``/``month`` from a timestamp field; unparsable values give NULL (Spark-3 rule)."""
    ts = F.try_to_timestamp(F.col(ts_column).cast("string"))
    return df.withColumn("year", F.year(ts)).withColumn("month", F.month(ts))


def json_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Store free-form maps/structs as JSON text; absent columns are skipped."""
    for c in columns:
        if c in df.columns:
            df = df.withColumn(c, F.to_json(F.col(c)))
    return df


def residual_after_move(source: DataFrame, synced_ids: DataFrame, id_column: str = "_id") -> DataFrame:
    """The source minus exactly the ids that were synced; later arrivals stay.

    An anti join on the cluster replaces collecting the ids to the driver.
    """
    return source.join(synced_ids.select(id_column), id_column, "left_anti")


def moved_rows(source: DataFrame, synced_ids: DataFrame, id_column: str = "_id") -> DataFrame:
    """Rows that a move removes from the source (semi join)."""
    return source.join(synced_ids.select(id_column), id_column, "left_semi")


@dataclass
class SyncResult:
    rows: DataFrame          # what lands in bronze this run
    residual: DataFrame      # what stays in the source after the move


def prepare_batch(source: DataFrame, partition_ts: str | None = None, json_cols: Sequence[str] = (),
                  limit: int | None = None, id_column: str = "_id", synced_at=None) -> DataFrame:
    """Steps shared by both sync modes: optional batch limit (by id, reproducible), year/month,
    JSON columns, ``_synced_at``, void -> string."""
    df = top_rows(source, [id_column], limit) if limit else source
    if partition_ts:
        df = with_partition_columns(df, partition_ts)
    df = json_columns(df, json_cols)
    now = F.current_timestamp() if synced_at is None else F.lit(synced_at).cast("timestamp")
    return void_to_string(df.withColumn("_synced_at", now))


def sync_append(source: DataFrame, partition_ts: str | None = None, json_cols: Sequence[str] = (),
                limit: int | None = None, move: bool = True, id_column: str = "_id",
                synced_at=None) -> SyncResult:
    """Append the batch to bronze; with ``move`` the synced ids leave the source."""
    rows = prepare_batch(source, partition_ts, json_cols, limit, id_column, synced_at)
    residual = residual_after_move(source, rows, id_column) if move else source
    return SyncResult(rows, residual)


def sync_upsert(target: DataFrame | None, source: DataFrame, key: str, exclude: Sequence[str] = (),
                json_cols: Sequence[str] = (), limit: int | None = None, move: bool = False,
                id_column: str = "_id", as_of=None) -> tuple[MergeResult, DataFrame]:
    """Hash upsert into bronze (never partitioned, nothing deleted); move only on request."""
    rows = prepare_batch(source, None, json_cols, limit, id_column, as_of)
    result = upsert_by_hash(target, rows, key, exclude, as_of)
    residual = residual_after_move(source, rows, id_column) if move else source
    return result, residual


def residual_after_commit(spark, source: DataFrame, root: str, version: int, id_column: str = "_id") -> DataFrame:
    """The source minus the ids that version ``version`` of the log holds.

    The ids come from the commit, not from the source again: what arrived in
    between is not in the commit and stays.
    """
    written = spark.read.parquet(version_path(root, version)).select(id_column)
    return residual_after_move(source, written, id_column)


def write_bronze(spark, rows: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Create-or-append (the path existing decides), partitioned by year/month when asked."""
    writer = rows.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
