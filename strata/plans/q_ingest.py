"""Ingest queries (S10, I01, I03, A08, D15, Z05) over the F6 inbox and the F5 books."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import ingest as IG
from strata.operators import metadata as MD
from strata.plans.fixtures import F5_SQL, F6_SQL, f5_books, f6_inbox
from strata.plans.q_documents import BOOK_TEXT_SQL, CASCADE_BODY
from strata.plans.registry import query
from strata.session import scratch_path
from strata.sources import changelog as CL
from strata.sources.tables import read_table

RUN_TS = "2024-02-01 12:00:00"
STAMP = "20240201T120000000000"


def _known(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.join(read_table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").select(
        F.sha2("text", 256).alias("file_hash"))


def _parsed(spark, sf_dir):
    inbox = f6_inbox(spark, sf_dir).where(MD.inbox_accepts(F.col("filename")))
    return inbox.select("doc_id", "filename", "path", "text", "modified_at",
                        F.sha2("text", 256).alias("file_hash"), IG.parse_error(F.col("filename")).alias("error"))


def _outcomes(spark, sf_dir):
    return IG.classify_files(_parsed(spark, sf_dir), _known(spark, sf_dir))


@query("ingest_outcome", f"WITH {F6_SQL} SELECT filename, file_hash, outcome FROM f6o")
def ingest_outcome(spark, sf_dir):
    return _outcomes(spark, sf_dir).select("filename", "file_hash", "outcome")


ARCHIVED_SQL = "SELECT 'processed' AS folder, filename FROM f6a WHERE doc_id IN (SELECT doc_id FROM labels)"


@query("archive_targets", f"""WITH {F6_SQL}, archived AS ({ARCHIVED_SQL})
SELECT o.filename, o.outcome,
  CASE WHEN o.outcome = 'failed' THEN 'failed' ELSE 'processed' END || '/' ||
  CASE WHEN a.filename IS NOT NULL AND o.outcome <> 'failed'
       THEN regexp_extract(o.filename, '^(.+?)(\\.[^.]*)?$', 1) || '.{STAMP}' || regexp_extract(o.filename, '^.+?(\\.[^.]*)?$', 1)
       ELSE o.filename END AS target,
  CASE WHEN o.outcome = 'failed' THEN o.error END AS reason
FROM f6o o LEFT JOIN archived a ON a.filename = o.filename""")
def archive_targets(spark, sf_dir):
    # Files of the labelled documents were archived by an earlier run; their copies clash.
    inbox = f6_inbox(spark, sf_dir).where(MD.inbox_accepts(F.col("filename")))
    archived = inbox.join(read_table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").select(
        F.lit("processed").alias("folder"), "filename")
    return IG.archive_targets(_outcomes(spark, sf_dir), archived, STAMP)


def _document_rows(spark, sf_dir):
    ing = _outcomes(spark, sf_dir).where(F.col("outcome") == "ingested")
    return IG.document_rows(ing, F.to_timestamp(F.lit(RUN_TS)))


DOC_ROWS_SQL = """SELECT file_hash AS document_id, file_hash, filename, lower(regexp_extract(filename, '^.+\\.([^.]+)$', 1)) AS extension,
  regexp_replace(regexp_extract(filename, '^(.+)\\.[^.]*$', 1), '^[ \\-_]+|[ \\-_]+$', '', 'g') AS title,
  CAST(NULL AS VARCHAR) AS author, CAST(NULL AS VARCHAR) AS publication_date, CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes,
  modified_at, CAST(length(text) AS INTEGER) AS char_count, text, TIMESTAMP '2024-02-01 12:00:00' AS ingested_at
FROM f6o WHERE outcome = 'ingested'"""


@query("document_rows", f"WITH {F6_SQL} {DOC_ROWS_SQL}")
def document_rows(spark, sf_dir):
    return _document_rows(spark, sf_dir).withColumn("publication_date", F.date_format("publication_date", "yyyy-MM-dd"))


@query("ingest_documents", f"WITH {F6_SQL} SELECT document_id, filename, char_count FROM ({DOC_ROWS_SQL})")
def ingest_documents(spark, sf_dir):
    # Z05, generic scan type: inbox -> outcome -> one row per ingested file.
    return _document_rows(spark, sf_dir).select("document_id", "filename", "char_count")


@query("ingest_summary", f"""WITH {F6_SQL}
SELECT CAST(sum(CASE WHEN outcome = 'ingested' THEN 1 ELSE 0 END) AS BIGINT) AS ingested,
  CAST(sum(CASE WHEN outcome = 'duplicate' THEN 1 ELSE 0 END) AS BIGINT) AS duplicates,
  CAST(sum(CASE WHEN outcome = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
  CAST(sum(CASE WHEN outcome = 'ingested' THEN 1 ELSE 0 END) AS BIGINT) AS "rows", CAST(count(*) AS BIGINT) AS total FROM f6o""")
def ingest_summary(spark, sf_dir):
    return IG.ingest_summary(_outcomes(spark, sf_dir), _document_rows(spark, sf_dir))


HEADED_TEXT = "'**Title:** Paper ' || doc_id || chr(10) || '**Authors:** Writer ' || (doc_id % 7) || chr(10) || chr(10) || 'Body: '"


@query("ingest_files", f"""WITH f AS (
  SELECT doc_id, source || '-' || doc_id || CASE WHEN doc_id % 11 = 5 THEN '.json' WHEN doc_id % 13 = 6 THEN '.pdf' ELSE '.md' END AS filename,
    doc_id % 3 = 0 AS headed, doc_id % 17 = 4 AS bad, 'Body: ' || replace(regexp_replace(text, '[\\r\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]', ' ', 'g'), chr(10), ' ') || '.' AS body
  FROM documents),
c AS (SELECT *, CASE WHEN headed THEN {HEADED_TEXT.replace("'Body: '", "body")} ELSE body END AS content FROM f),
u AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY filename) AS copy FROM c
      WHERE NOT bad AND filename LIKE '%.md')
SELECT filename, 'ingested' AS outcome, sha256(content) AS file_hash, CASE WHEN headed THEN 'Paper ' || doc_id END AS title,
  CASE WHEN headed THEN 'Writer ' || (doc_id % 7) END AS author, octet_length(encode(content)) AS size_bytes,
  CAST(length(body) AS INTEGER) AS char_count, md5(body) AS body_md5 FROM u WHERE copy = 1
UNION ALL SELECT filename, 'duplicate', NULL, NULL, NULL, NULL, NULL, NULL FROM u WHERE copy > 1
UNION ALL SELECT filename, 'failed', NULL, NULL, NULL, NULL, NULL, NULL FROM c WHERE bad OR filename NOT LIKE '%.md'""")
def ingest_files(spark, sf_dir):
    # Every document as a file (some with a header block, some with bytes that are no UTF-8, some of
    # types that do not convert or JSON that does not parse) through decode, classify and one commit.
    d, k = read_table(spark, sf_dir, "documents"), F.col("doc_id")
    ext = F.when(k % 11 == 5, ".json").when(k % 13 == 6, ".pdf").otherwise(".md")
    name = F.concat("source", F.lit("-"), k.cast("string"), ext)
    plain = F.replace(F.regexp_replace("text", r"[\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]", " "), F.lit("\n"), F.lit(" "))
    body = F.concat(F.lit("Body: "), plain, F.lit("."))
    header = F.concat(F.lit("**Title:** Paper "), k.cast("string"), F.lit("\n**Authors:** Writer "), (k % 7).cast("string"), F.lit("\n\n"))
    content = F.encode(F.concat(F.when(k % 3 == 0, header).otherwise(""), body), "UTF-8")
    content = F.when(k % 17 == 4, F.concat(content, F.unhex(F.lit("FF")))).otherwise(content)
    files = d.select(F.concat(F.lit("inbox/"), name).alias("path"), F.lit(RUN_TS).cast("timestamp").alias("modificationTime"),
                     F.octet_length(content).cast("long").alias("length"), content.alias("content"), name.alias("filename"))
    target = scratch_path(spark, "ingested")
    outcomes, _ = IG.ingest_files(spark, files, target)
    stored = CL.snapshot(CL.read_log(spark, target), "document_id").select(
        F.col("filename").alias("stored"), "file_hash", F.when(F.col("author").isNotNull(), F.col("title")).alias("title"), "author",
        "size_bytes", "char_count", F.md5(F.col("text").cast("binary")).alias("body_md5"))
    rows = outcomes.select("filename", "outcome").join(stored, F.col("filename") == F.col("stored"), "left")
    return rows.drop("stored")


def book_files(spark, sf_dir):
    """F5 books as inbox files named "<Book> (<year>) - <Author>.epub"."""
    b = f5_books(spark, sf_dir)
    n = F.regexp_extract("book_id", r"#(\d+)$", 1)
    src = F.regexp_extract("book_id", r"^(.*)#", 1)
    name = F.concat(F.lit("book "), src, F.lit(" vol "), n, F.lit(" ("), (2000 + n.cast("int") % 20).cast("string"),
                    F.lit(") - Writer "), F.upper(src), F.lit(".epub"))
    return b.select(F.col("book_id").alias("doc_id"), "text", name.alias("filename"),
                    F.sha2("text", 256).alias("file_hash"))


BOOK_ROWS_SQL = f"""WITH {F5_SQL}, {BOOK_TEXT_SQL}, casc AS ({CASCADE_BODY}),
f AS (SELECT book_id, sha256(text) AS file_hash, 'book ' || source || ' vol ' || CAST(book_no AS VARCHAR) || ' (' ||
        CAST(2000 + book_no % 20 AS VARCHAR) || ') - Writer ' || upper(source) || '.epub' AS filename,
        'book ' || source || ' vol ' || CAST(book_no AS VARCHAR) AS title, 'Writer ' || upper(source) AS author,
        strftime(make_date(CAST(2000 + book_no % 20 AS INTEGER), 1, 1), '%Y-%m-%d') AS publication_date FROM bt),
r AS (SELECT sha1(f.file_hash || ':' || CAST(c.number AS VARCHAR)) AS chapter_id, f.file_hash, f.filename, f.title, f.author,
        f.publication_date, c.part AS part_name, c.number AS chapter_number, c.name AS chapter_name, c.text,
        c.strategy AS split_strategy, TIMESTAMP '{RUN_TS}' AS ingested_at FROM casc c JOIN f ON f.book_id = c.book_id)"""


@query("book_rows", BOOK_ROWS_SQL + " SELECT * FROM r")
def book_rows(spark, sf_dir):
    return _book_rows(spark, sf_dir).withColumn("publication_date", F.date_format("publication_date", "yyyy-MM-dd"))


def _book_rows(spark, sf_dir):
    return IG.book_rows(*IG.book_chapters(book_files(spark, sf_dir)), F.to_timestamp(F.lit(RUN_TS)))


@query("ingest_books", BOOK_ROWS_SQL + " SELECT chapter_id, filename, chapter_number, chapter_name, split_strategy FROM r")
def ingest_books(spark, sf_dir):
    # Z05, book scan type: every book of the first run is new, each becomes its chapter rows.
    rows = _book_rows(spark, sf_dir)
    return rows.select("chapter_id", "filename", "chapter_number", "chapter_name", "split_strategy")

