"""Scans of the provided tables, by path and by catalog name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a table by path. Projection/filters on the result push into the scan."""
    return spark.read.parquet(table_path(sf_dir, name))


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES, prefix: str = "") -> list[str]:
    """Expose every table under its name so ``spark.table`` / SQL can use it."""
    out = []
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(prefix + name)
        out.append(prefix + name)
    return out


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Read a table by catalog name."""
    return spark.table(name)
