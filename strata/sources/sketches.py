"""Opt-in distinct counts of a change log by mergeable sketches, one per commit and column.

A commit's sketches are written once beside the log; a range of versions is
answered by their union, without reading a row of the log again.  Sketches count
the distinct non-null values that the commits of the range carry (inserted, updated
or deleted); an append-only log's range from its first commit is its table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources import changelog as CL

LG_K = 12  # 4,096 registers, 4 KB a sketch or so
STANDARD_ERROR = 1.04 / 2 ** (LG_K / 2)  # of an estimate, relative (1.6 %)


def sketches_root(root: str) -> str:
    return root.rstrip("/") + "__sketches"


def sketch_commit(spark: SparkSession, root: str, version: int, columns: Sequence[str]) -> None:
    """Sketch the values of ``columns`` in one commit (one pass over that commit)."""
    rows = spark.read.parquet(CL.version_path(root, version))
    made = rows.agg(*[F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), LG_K).alias(f"s{i}") for i, c in enumerate(columns)])
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)])
    made.select(F.explode(items).alias("x")).select("x.*").write.mode("errorifexists").parquet(
        f"{sketches_root(root)}/version={version}")


def sketch_missing(spark: SparkSession, root: str, columns: Sequence[str]) -> list[int]:
    """Sketch every commit that has none yet; the versions done."""
    _, _, path, fs = CL._jvm_fs(spark, sketches_root(root))
    have = {st.getPath().getName() for st in fs.listStatus(path)} if fs.exists(path) else set()
    todo = [v for v in CL.committed_versions(spark, root) if f"version={v}" not in have]
    for version in todo:
        sketch_commit(spark, root, version, columns)
    return todo


def distinct_estimates(spark: SparkSession, root: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """(column, estimate): distinct values over the commits ``start`` to ``end`` (both included; None: open)."""
    rows = spark.read.parquet(sketches_root(root))
    if start is not None:
        rows = rows.where(F.col("version") >= start)
    if end is not None:
        rows = rows.where(F.col("version") <= end)
    return rows.groupBy("column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
