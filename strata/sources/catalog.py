"""Catalog helpers (S11, K03, K04, K08, K09, K11, K12): databases, tables, properties.

Plain Spark SQL against the session catalog; table locations are parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.functions.schema import assert_not_null, ddl_from_schema

CDF_PROPERTY = "delta.enableChangeDataFeed"


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS ... LOCATION ...``."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def ensure_table(spark: SparkSession, name: str, schema: StructType, using: str = "parquet") -> None:
    """Create the table from a StructType if missing (NOT NULL kept in the DDL)."""
    if "." in name:
        ensure_database(spark, name.rsplit(".", 1)[0])
    spark.sql(ddl_from_schema(name, schema, using))


def create_or_append(df: DataFrame, name: str, partition_by=()) -> str:
    """Append when the table exists, else create it; returns which one happened."""
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if exists:
        df = assert_not_null(df, [f.name for f in spark.table(name).schema.fields if not f.nullable])
    w = df.write.mode("append" if exists else "errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return "append" if exists else "create"


def table_properties(spark: SparkSession, name: str) -> dict:
    """``SHOW TBLPROPERTIES`` as a dict (a handful of rows)."""
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def enable_change_feed(spark: SparkSession, name: str) -> None:
    """Mark a table as change-feed enabled when it is not yet (our logs always carry changes)."""
    if table_properties(spark, name).get(CDF_PROPERTY) != "true":
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{CDF_PROPERTY}' = 'true')")


def drop_table(spark: SparkSession, name: str) -> None:
    """K12."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_database(spark: SparkSession, name: str) -> None:
    """K12."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables of a database as a DataFrame."""
    return spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")
