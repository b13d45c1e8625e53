"""Schemaless document collections (S08) and the test collection F4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.tables import read_table


def read_collection(spark: SparkSession, path: str, fmt: str = "json", options: dict | None = None,
                    schema=None) -> DataFrame:
    """The whole collection with an inferred schema.

    The format is a parameter so a document-store connector can be plugged in
    (``format="mongodb"`` with its options); JSON lines is the file default.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write_events_collection(spark: SparkSession, sf_dir: str, path: str) -> str:
    """``events`` as JSON lines: nested ``props``, an all-null field, an array of nulls, ``_id`` string."""
    ev = read_table(spark, sf_dir, "events")
    doc = ev.select(
        F.col("event_id").cast("string").alias("_id"), "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "user_id", "event_type", "value",
        F.from_json("props", "struct<k:bigint>").alias("props"),
        F.lit(None).cast("string").alias("empty_field"),
        F.array(F.lit(None).cast("string")).alias("null_list"))
    doc.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
    return path


def read_files(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """CSV / JSON / JSON-lines / text / Markdown inputs as rows ``(path, text)``.

    Text and Markdown are read whole (one row per file); CSV and JSON are parsed by
    Spark's readers and each record is rendered back to JSON text.
    """
    if fmt in ("txt", "text", "md", "markdown"):
        df = spark.read.text(path, wholetext=True)
        return df.select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    if fmt == "csv":
        df = spark.read.option("header", "true").csv(path)
    elif fmt in ("json", "jsonl"):
        df = spark.read.option("multiLine", fmt == "json").json(path)
    else:
        raise ValueError(f"unsupported input format {fmt!r}")
    return df.select(F.input_file_name().alias("path"), F.to_json(F.struct(*df.columns)).alias("text"))
