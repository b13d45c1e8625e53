"""Inbox -> bronze ingest as Spark jobs.

Files are parsed on the executors; the outcome of every file (failed /
duplicate / ingested) is a column computed with joins and aggregates: the
hashes already in the table are an anti/semi join (never a driver-side set)
and "an earlier file of this run has the same hash" is ``min(path)`` per hash.
Files are not moved: the archive decision is an output column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)

from strata.functions.schema import assert_not_null
from strata.functions.text import chapter_id
from strata.operators import metadata as MD
from strata.session import materialize
from strata.sources import changelog as CL

# The two table layouts (column order and NOT NULL columns).
CHAPTER_SCHEMA = StructType([
    StructField("chapter_id", StringType(), False), StructField("file_hash", StringType(), False),
    StructField("filename", StringType(), False), StructField("title", StringType(), True),
    StructField("author", StringType(), True), StructField("publication_date", DateType(), True),
    StructField("part_name", StringType(), True), StructField("chapter_number", IntegerType(), False),
    StructField("chapter_name", StringType(), True), StructField("text", StringType(), True),
    StructField("split_strategy", StringType(), True), StructField("ingested_at", TimestampType(), False)])
DOCUMENT_SCHEMA = StructType([
    StructField("document_id", StringType(), False), StructField("file_hash", StringType(), False),
    StructField("filename", StringType(), False), StructField("extension", StringType(), True),
    StructField("title", StringType(), True), StructField("author", StringType(), True),
    StructField("publication_date", DateType(), True), StructField("size_bytes", LongType(), True),
    StructField("modified_at", TimestampType(), True), StructField("char_count", IntegerType(), True),
    StructField("text", StringType(), True), StructField("ingested_at", TimestampType(), False)])

# Inputs whose conversion needs tools that are not part of this engine.
MEDIA_EXTENSIONS = ("jpg", "jpeg", "png", "wav", "mp3", "m4a", "mp4")
TEXT_EXTENSIONS = ("txt", "text", "md", "markdown", "html", "htm", "csv", "xml", "rss", "atom", "json", "jsonl")
MARKUP_EXTENSIONS = ("html", "htm", "xml", "rss", "atom")
PROCESSED, FAILED = "processed", "failed"


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"^.+\.([^.]+)$", 1))


def parse_error(name: Column) -> Column:
    """The converter's verdict by file type; NULL where the type converts."""
    ext = extension(name)
    return F.when(ext.isin(*MEDIA_EXTENSIONS), F.concat(F.lit("ValueError('no converter for "), ext, F.lit("')")))


def decode_files(files: DataFrame) -> DataFrame:
    """``scan_inbox`` rows -> file_hash (of the bytes), text, error: each file is really decoded.

    Text, Markdown, HTML, CSV and XML need valid UTF-8, JSON (one value, or one a
    line) must parse as well; what fails keeps its reason and a NULL text.  Pages
    and feeds are stored as Markdown.
    """
    raw, ext = F.col("content").cast("string"), extension(F.col("filename"))
    lines = F.filter(F.split(raw, "\n"), lambda x: F.trim(x) != "")
    broken = F.when(ext == "json", F.try_parse_json(raw).isNull()).when(
        ext == "jsonl", F.exists(lines, lambda x: F.try_parse_json(x).isNull()))
    error = (F.when(parse_error(F.col("filename")).isNotNull(), parse_error(F.col("filename")))
             .when(~ext.isin(*TEXT_EXTENSIONS), F.concat(F.lit("ValueError('no converter for "), ext, F.lit("')")))
             .when(~F.is_valid_utf8(raw), F.lit("UnicodeDecodeError('not valid utf-8')"))
             .when(broken, F.lit("JSONDecodeError('not valid json')")))
    return files.select("path", "filename", F.col("modificationTime").alias("modified_at"),
                        F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("file_hash"), error.alias("error"),
                        F.when(error.isNull(), F.when(ext.isin(*MARKUP_EXTENSIONS), MD.html_to_markdown(raw)).otherwise(
                            F.replace(raw, F.lit("\r\n"), F.lit("\n")))).alias("text"))


def classify_files(parsed: DataFrame, known_hashes: DataFrame) -> DataFrame:
    """Outcome per file: failed (parse error), duplicate (hash already stored, or an
    earlier path of this run has it), else ingested.  The duplicate test follows parsing,
    so a broken copy of a known file counts as failed."""
    ok = parsed.where(F.col("error").isNull())
    first = ok.groupBy("file_hash").agg(F.min("path").alias("first_path"))
    known = known_hashes.select("file_hash").distinct().withColumn("known", F.lit(True))
    j = parsed.join(first, "file_hash", "left").join(known, "file_hash", "left")
    outcome = (F.when(F.col("error").isNotNull(), F.lit("failed"))
               .when(F.coalesce(F.col("known"), F.lit(False)) | (F.col("path") != F.col("first_path")),
                     F.lit("duplicate")).otherwise(F.lit("ingested")))
    return j.withColumn("outcome", outcome).drop("first_path", "known")


def archive_targets(outcomes: DataFrame, archived: DataFrame, stamp: str) -> DataFrame:
    """Where each handled file goes: ``processed/`` or ``failed/`` (+ reason); a name
    already in that folder gets ``.<stamp>`` before its extension."""
    folder = F.when(F.col("outcome") == "failed", F.lit(FAILED)).otherwise(F.lit(PROCESSED))
    x = outcomes.withColumn("folder", folder)
    taken = archived.select(F.col("folder").alias("t_folder"), F.col("filename").alias("taken")).distinct()
    x = x.join(taken, (F.col("folder") == F.col("t_folder")) & (F.col("filename") == F.col("taken")),
               "left").drop("t_folder")
    stem = F.regexp_extract("filename", r"^(.+?)(\.[^.]*)?$", 1)
    suffix = F.regexp_extract("filename", r"^.+?(\.[^.]*)?$", 1)
    name = F.when(F.col("taken").isNotNull(), F.concat(stem, F.lit("."), F.lit(stamp), suffix)).otherwise(
        F.col("filename"))
    return x.select("filename", "outcome", F.concat_ws("/", "folder", name).alias("target"),
                    F.when(F.col("outcome") == "failed", F.col("error")).alias("reason"))


def ingest_summary(outcomes: DataFrame, rows_written: DataFrame) -> DataFrame:
    """Ingested / duplicates / failed / rows / total of one run (one aggregate each)."""
    o = outcomes.select(F.col("outcome"), F.lit(0).alias("__r"))
    r = rows_written.select(F.lit(None).cast("string").alias("outcome"), F.lit(1).alias("__r"))
    u = o.unionByName(r)
    is_file = F.col("__r") == 0

    def count(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")

    return u.agg(count(F.col("outcome") == "ingested").alias("ingested"),
                 count(F.col("outcome") == "duplicate").alias("duplicates"),
                 count(F.col("outcome") == "failed").alias("failed"),
                 count(~is_file).alias("rows"), count(is_file).alias("total"))


def file_metadata(text: Column, filename: Column) -> Column:
    """D11 with the file extractors in their order: header block, then the file name."""
    return MD.metadata_chain(MD.header_metadata(text), MD.filename_metadata(filename))


def document_rows(files: DataFrame, ingested_at: Column) -> DataFrame:
    """One row per ingested file in the fixed document layout.

    Metadata come from the header block, the stored text begins after it; the
    size is that of the file's bytes where the scan gave it.
    """
    meta = file_metadata(F.col("text"), F.col("filename"))
    size = F.col("size_bytes") if "size_bytes" in files.columns else F.octet_length("text")
    body = MD.strip_header(F.col("text"))
    return files.select(
        F.col("file_hash").alias("document_id"), "file_hash", "filename", extension(F.col("filename")).alias("extension"),
        meta["title"].alias("title"), meta["author"].alias("author"), meta["publication_date"].alias("publication_date"),
        size.cast("long").alias("size_bytes"), F.col("modified_at").cast("timestamp").alias("modified_at"),
        F.length(body).alias("char_count"), body.alias("text"), ingested_at.cast("timestamp").alias("ingested_at"))


def book_rows(books: DataFrame, chapters: DataFrame, ingested_at: Column) -> DataFrame:
    """One row per chapter in the fixed chapter layout (chapter id = sha1(hash:number))."""
    c = chapters.select("doc_id", F.col("number").cast("int").alias("chapter_number"), F.col("name").alias("chapter_name"),
                        F.col("part").alias("part_name"), "text", F.col("strategy").alias("split_strategy"))
    j = c.join(books.select("doc_id", "file_hash", "filename", "m"), "doc_id")
    return j.select(chapter_id(F.col("file_hash"), F.col("chapter_number")).alias("chapter_id"), "file_hash",
                    "filename", F.col("m.title").alias("title"), F.col("m.author").alias("author"),
                    F.col("m.publication_date").alias("publication_date"), "part_name", "chapter_number",
                    "chapter_name", "text", "split_strategy", ingested_at.cast("timestamp").alias("ingested_at"))


def book_chapters(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files with their metadata ``m``, without texts; chapters): books are split after their header block."""
    from strata.operators.splitting import split_cascade

    meta = file_metadata(F.col("text"), F.col("filename"))
    # Written, so the texts are not shuffled once more to meet their chapters.
    books = materialize(files.select("doc_id", "file_hash", "filename", meta.alias("m")), "books")
    return books, split_cascade(files.select("doc_id", MD.strip_header(F.col("text")).alias("text")))


LAYOUTS = {"documents": (DOCUMENT_SCHEMA, "document_id"), "books": (CHAPTER_SCHEMA, "chapter_id")}


def run_ingest(spark, inbox: DataFrame, known_hashes: DataFrame, kind: str = "documents"):
    """(outcomes, rows) of one run over decoded files (``decode_files``), or None for an empty
    inbox.  Rows are checked against the layout's NOT NULL columns when they are written."""
    if inbox.isEmpty():
        return None
    parsed = inbox
    if "file_hash" not in parsed.columns:
        parsed = parsed.withColumn("file_hash", F.sha2("text", 256))
    if "error" not in parsed.columns:
        parsed = parsed.withColumn("error", parse_error(F.col("filename")))
    outcomes = classify_files(parsed, known_hashes)
    new = outcomes.where(F.col("outcome") == "ingested")
    now = F.current_timestamp()
    if kind == "documents":
        rows = document_rows(new, now)
    else:
        if "doc_id" not in new.columns:
            new = new.withColumn("doc_id", F.col("path"))
        rows = book_rows(*book_chapters(new), now)
    return outcomes, assert_not_null(rows, [f.name for f in LAYOUTS[kind][0].fields if not f.nullable])


def ingest_folder(spark, folder: str, target: str, kind: str = "documents"):
    """Inbox to table: scan, decode, classify against the table, and one commit of the new rows.

    Returns (outcomes, version); None for an empty inbox; the version is None when no file was new.
    """
    files = MD.scan_inbox(spark, folder)
    if files.isEmpty():
        return None
    return ingest_files(spark, files, target, kind)


def ingest_files(spark, files: DataFrame, target: str, kind: str = "documents"):
    """``ingest_folder`` for the rows of a scan."""
    decoded = materialize(decode_files(files), "decoded")  # bytes are read and decoded once
    known = CL.read_log(spark, target).select("file_hash") if CL.committed_versions(spark, target) else \
        decoded.select("file_hash").limit(0)
    outcomes, rows = run_ingest(spark, decoded, known, kind)
    outcomes = materialize(outcomes.select("path", "filename", "file_hash", "outcome", "error"), "outcomes")
    if outcomes.where(F.col("outcome") == "ingested").isEmpty():
        return outcomes, None
    changes = rows.withColumn(CL.CHANGE_TYPE, F.lit("insert"))
    return outcomes, CL.commit(spark, changes, target, operation="INGEST")
