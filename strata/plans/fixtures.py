"""Derived fixtures (FIXTURES.md part C), built from the provided tables.

Each Spark builder has a twin SQL text (``*_SQL``) that DuckDB runs inside the
oracles, so both engines start from the same rows.  The fixtures re-shape
whole tables into versions or files; none drops rows to keep a check cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.changelog import CHANGE_TYPE, COMMIT_TS, VERSION
from strata.sources.tables import read_table

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority"]


def _ts(hours: int):
    return (F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) + F.make_interval(hours=F.lit(hours)))


def _tag(df: DataFrame, change_type: str, version: int) -> DataFrame:
    return (df.withColumn(CHANGE_TYPE, F.lit(change_type))
            .withColumn(VERSION, F.lit(version).cast("bigint"))
            .withColumn(COMMIT_TS, _ts(version)))


def f1_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """four versions over ``orders`` (insert / update / delete / insert)."""
    o = read_table(spark, sf_dir, "orders").select(*ORDER_COLS)
    k = F.col("o_orderkey")
    v0 = o.where(k % 5 != 4)
    upd = v0.where(k % 10 == 1)
    post = upd.withColumn("o_orderstatus", F.lit("U")).withColumn(
        "o_totalprice", F.col("o_totalprice") + 100)
    current = (v0.withColumn("o_orderstatus", F.when(k % 10 == 1, F.lit("U")).otherwise(F.col("o_orderstatus")))
               .withColumn("o_totalprice", F.when(k % 10 == 1, F.col("o_totalprice") + 100)
                           .otherwise(F.col("o_totalprice"))))
    dele = current.where(k % 7 == 0)
    v3 = o.where(k % 5 == 4)
    return (_tag(v0, "insert", 0).unionByName(_tag(upd, "update_preimage", 1))
            .unionByName(_tag(post, "update_postimage", 1)).unionByName(_tag(dele, "delete", 2))
            .unionByName(_tag(v3, "insert", 3)))


def _sql_ts(v: int) -> str:
    return f"(TIMESTAMP '2024-01-01 00:00:00' + INTERVAL {v} HOUR)"


F1_SQL = f"""f1 AS (
  SELECT {', '.join(ORDER_COLS)}, 'insert' AS _change_type, CAST(0 AS BIGINT) AS _commit_version,
         {_sql_ts(0)} AS _commit_timestamp
  FROM orders WHERE o_orderkey % 5 <> 4
  UNION ALL
  SELECT {', '.join(ORDER_COLS)}, 'update_preimage', CAST(1 AS BIGINT), {_sql_ts(1)}
  FROM orders WHERE o_orderkey % 5 <> 4 AND o_orderkey % 10 = 1
  UNION ALL
  SELECT o_orderkey, o_custkey, 'U', o_totalprice + 100, o_orderdate, o_orderpriority,
         'update_postimage', CAST(1 AS BIGINT), {_sql_ts(1)}
  FROM orders WHERE o_orderkey % 5 <> 4 AND o_orderkey % 10 = 1
  UNION ALL
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 10 = 1 THEN 'U' ELSE o_orderstatus END,
         CASE WHEN o_orderkey % 10 = 1 THEN o_totalprice + 100 ELSE o_totalprice END,
         o_orderdate, o_orderpriority, 'delete', CAST(2 AS BIGINT), {_sql_ts(2)}
  FROM orders WHERE o_orderkey % 5 <> 4 AND o_orderkey % 7 = 0
  UNION ALL
  SELECT {', '.join(ORDER_COLS)}, 'insert', CAST(3 AS BIGINT), {_sql_ts(3)}
  FROM orders WHERE o_orderkey % 5 = 4
)"""

# Final state of F1 written directly from its definition (independent of any log replay).
F1_FINAL_SQL = """f1_final AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 10 = 1 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 10 = 1 THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE NOT (o_orderkey % 5 <> 4 AND o_orderkey % 7 = 0)
)"""


def f1n_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1n: F1 plus two NULL-key rows and one key changed in v1, v2 and v3."""
    f1 = f1_change_log(spark, sf_dir)
    o = read_table(spark, sf_dir, "orders").select(*ORDER_COLS)
    k = F.col("o_orderkey")
    base = o.where(k == 2)  # key 2: inserted at v0, changed three more times
    extra = (_tag(base.withColumn("o_orderkey", F.lit(None).cast("bigint")), "insert", 1)
             .unionByName(_tag(base.withColumn("o_orderkey", F.lit(None).cast("bigint"))
                               .withColumn("o_orderstatus", F.lit("N")), "insert", 2)))
    chain = (_tag(base.withColumn("o_orderstatus", F.lit("A")), "update_postimage", 1)
             .unionByName(_tag(base.withColumn("o_orderstatus", F.lit("B")), "update_postimage", 2))
             .unionByName(_tag(base.withColumn("o_orderstatus", F.lit("C")), "update_postimage", 3)))
    return f1.unionByName(extra).unionByName(chain)


F1N_EXTRA_SQL = f"""f1n AS (
  SELECT * FROM f1
  UNION ALL SELECT CAST(NULL AS BIGINT), o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         'insert', CAST(1 AS BIGINT), {_sql_ts(1)} FROM orders WHERE o_orderkey = 2
  UNION ALL SELECT CAST(NULL AS BIGINT), o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority,
         'insert', CAST(2 AS BIGINT), {_sql_ts(2)} FROM orders WHERE o_orderkey = 2
  UNION ALL SELECT o_orderkey, o_custkey, 'A', o_totalprice, o_orderdate, o_orderpriority,
         'update_postimage', CAST(1 AS BIGINT), {_sql_ts(1)} FROM orders WHERE o_orderkey = 2
  UNION ALL SELECT o_orderkey, o_custkey, 'B', o_totalprice, o_orderdate, o_orderpriority,
         'update_postimage', CAST(2 AS BIGINT), {_sql_ts(2)} FROM orders WHERE o_orderkey = 2
  UNION ALL SELECT o_orderkey, o_custkey, 'C', o_totalprice, o_orderdate, o_orderpriority,
         'update_postimage', CAST(3 AS BIGINT), {_sql_ts(3)} FROM orders WHERE o_orderkey = 2
)"""


# --------------------------------------------------------------------- F5

# Book layouts, one per splitting strategy, and the chapter heading lines of each.
LAYOUTS = ("headings", "chapter_markers", "slides", "backlink_headings", "table_of_contents")
BOOK_SIZE = 10
PADDING = 12


def _heading_lines(layout: F.Column, n: F.Column) -> F.Column:
    ns = n.cast("string")
    title = F.concat(F.lit("Title "), ns)
    return (F.when(layout == "headings", F.array(F.concat(F.lit("# "), title)))
            .when(layout == "chapter_markers", F.array(F.concat(F.lit("Chapter "), ns), F.lit(""), title))
            .when(layout == "slides", F.array(F.concat(F.lit("<!-- Slide number: "), ns, F.lit(" -->")),
                                              F.concat(F.lit("# "), title)))
            .when(layout == "backlink_headings", F.array(F.concat(F.lit("["), title, F.lit("](toc.html#c"), ns,
                                                                  F.lit(")"))))
            .otherwise(F.array(title)))


def f5_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 chapters: every document becomes one chapter of a book of ~10 consecutive documents
    of its source (the short tail joins the last book); the layout cycles over the strategies."""
    from strata.operators.relational import position_within

    d = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    keys = d.select("doc_id", "source")
    if keys.groupBy("doc_id", "source").count().where("count > 1").isEmpty():
        # Only the keys are numbered and written; each text finds its own again.
        place = position_within(keys, ["source"], "doc_id").select(
            F.col("doc_id").alias("place_id"), F.col("source").alias("place_source"), "pos", "pos_count")
        p = d.join(place, F.col("doc_id").eqNullSafe(F.col("place_id")) & F.col("source").eqNullSafe(F.col("place_source")))
    else:
        p = position_within(d, ["source"], "doc_id")
    books = F.greatest(F.floor(F.col("pos_count") / BOOK_SIZE), F.lit(1))
    book_no = F.least(F.floor(F.col("pos") / BOOK_SIZE), books - 1)
    src_num = F.coalesce(F.regexp_extract("source", r"(\d+)$", 1).cast("int"), F.lit(0))
    layout = F.element_at(F.array(*[F.lit(x) for x in LAYOUTS]),
                          ((src_num + book_no) % len(LAYOUTS) + 1).cast("int"))
    return p.select("doc_id", "source", "text", book_no.alias("book_no"),
                    (F.col("pos") - book_no * BOOK_SIZE + 1).cast("int").alias("number"),
                    layout.alias("layout"),
                    F.concat(F.col("source"), F.lit("#"), book_no.cast("string")).alias("book_id"))


def f5_books(spark: SparkSession, sf_dir: str, chapters: DataFrame | None = None) -> DataFrame:
    """F5 books: (book_id, layout, text). Each chapter block is its heading lines, the text and
    12 blank lines; table-of-contents books start with a linked contents list."""
    ch = chapters if chapters is not None else f5_chapters(spark, sf_dir)
    block = F.array_join(F.concat(_heading_lines(F.col("layout"), F.col("number")), F.array(F.col("text")),
                                  F.array_repeat(F.lit(""), PADDING)), "\n")
    entry = F.concat(F.lit("[Title "), F.col("number").cast("string"), F.lit("](toc.html#c"),
                     F.col("number").cast("string"), F.lit(")"))
    books = ch.groupBy("book_id", "layout").agg(
        F.array_sort(F.collect_list(F.struct("number", block.alias("block"), entry.alias("entry")))).alias("c"))
    body = F.array_join(F.transform("c", lambda x: x["block"]), "\n")
    toc = F.concat(F.lit("Contents\n\n"), F.array_join(F.transform("c", lambda x: x["entry"]), "\n"), F.lit("\n\n"))
    return books.select("book_id", "layout", F.when(F.col("layout") == "table_of_contents", F.concat(toc, body))
                        .otherwise(body).alias("text"))


F5_SQL = """f5c AS (
  SELECT doc_id, source, text, book_no, CAST(pos - book_no * 10 + 1 AS INTEGER) AS number,
    (['headings', 'chapter_markers', 'slides', 'backlink_headings', 'table_of_contents'])[
      CAST((coalesce(TRY_CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER), 0) + book_no) % 5 + 1 AS INTEGER)] AS layout,
    source || '#' || CAST(book_no AS VARCHAR) AS book_id
  FROM (SELECT *, CAST(least(pos // 10, greatest(cnt // 10, 1) - 1) AS BIGINT) AS book_no FROM (
    SELECT doc_id, source, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
           count(*) OVER (PARTITION BY source) AS cnt FROM documents))
),
f5h AS (
  SELECT *, CASE layout WHEN 'headings' THEN 8 + length(CAST(number AS VARCHAR))
                        WHEN 'backlink_headings' THEN 20 + 2 * length(CAST(number AS VARCHAR)) ELSE 0 END
            + length(replace(text, chr(10), '')) AS chars
  FROM f5c
),
f5ok AS (
  SELECT book_id, sum(chars) / count(*) >= 800 OR min(layout) NOT IN ('headings', 'backlink_headings') AS ok
  FROM f5h GROUP BY book_id
)"""


# --------------------------------------------------------------------- F7

RESET_AT = "2024-01-15 00:00:00"


def f7_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one counter series per event type: running count of its events (by ts, event_id),
    restarted at 2024-01-15 by subtracting the count reached before that instant."""
    from strata.operators.relational import position_within

    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "user_id", "value")
    ev = ev.withColumn("ts_us", F.unix_micros(F.col("ts").cast("timestamp")))
    p = position_within(ev, ["event_type"], "ts_us", tiebreak=["event_id"])
    reset = F.to_timestamp_ntz(F.lit(RESET_AT))
    before = ev.where(F.col("ts") < reset).groupBy("event_type").agg(F.count(F.lit(1)).alias("before"))
    x = p.join(before, "event_type", "left")
    value = (F.col("pos") + 1 - F.when(F.col("ts") >= reset, F.coalesce(F.col("before"), F.lit(0))).otherwise(0))
    return x.select("event_id", "ts", F.col("event_type").alias("stream"), value.cast("double").alias("value"))


F7_SQL = f"""f7 AS (
  SELECT event_id, ts, event_type AS stream,
    CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id)
         - CASE WHEN ts >= TIMESTAMP '{RESET_AT}'
                THEN (SELECT count(*) FROM events e2 WHERE e2.event_type = e.event_type AND e2.ts < TIMESTAMP '{RESET_AT}')
                ELSE 0 END AS DOUBLE) AS value
  FROM events e
)"""


# --------------------------------------------------------------------- F8

def f8_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: documents as silver rows: decorator columns NULL, a summary already present for
    doc_id % 4 = 0, a (one-element) dense vector for % 8 = 0, empty text for % 50 = 0."""
    d = read_table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    return d.select(
        "doc_id", F.when(k % 50 == 0, F.lit("")).otherwise(F.col("text")).alias("text"), "lang", "source",
        F.when(k % 4 == 0, F.concat(F.lit("Summary of document "), k.cast("string"), F.lit(".")))
        .cast("string").alias("summary"),
        F.lit(None).cast("string").alias("ner_nel"),
        F.when(k % 8 == 0, F.array(F.lit(-1.0).cast("float"))).cast("array<float>").alias("text_embedding_dense"),
        F.lit(None).cast("map<string,float>").alias("text_embedding_sparse"),
        F.lit(None).cast("array<float>").alias("summary_embedding_dense"))


F8_SQL = """f8 AS (
  SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN '' ELSE text END AS text, lang, source,
         CASE WHEN doc_id % 4 = 0 THEN 'Summary of document ' || CAST(doc_id AS VARCHAR) || '.' END AS summary
  FROM documents
)"""


# --------------------------------------------------------------------- F6

# Inbox file extensions, chosen by doc_id % 8 (png/mp3 cannot be converted).
INBOX_EXTENSIONS = (".md", ".txt", ".epub", ".pdf", ".html", ".docx", ".png", ".mp3")


def f6_inbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every document delivered as an inbox file; ids divisible by 23 are hidden files,
    by 29 office lock files; the text is the converted content."""
    d = read_table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    ext = F.element_at(F.array(*[F.lit(e) for e in INBOX_EXTENSIONS]), (k % 8 + 1).cast("int"))
    base = F.concat(F.col("source"), F.lit("-"), k.cast("string"), ext)
    name = (F.when(k % 23 == 0, F.concat(F.lit("."), base)).when(k % 29 == 0, F.concat(F.lit("~$"), base))
            .otherwise(base))
    return d.select("doc_id", name.alias("filename"), F.concat(F.lit("inbox/"), name).alias("path"), "text",
                    (F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) + F.make_interval(secs=k.cast("int")))
                    .alias("modified_at"))


F6_SQL = """f6 AS (
  SELECT doc_id, filename, 'inbox/' || filename AS path, text, modified_at FROM (
    SELECT doc_id, text, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS modified_at,
      CASE WHEN doc_id % 23 = 0 THEN '.' WHEN doc_id % 29 = 0 THEN '~$' ELSE '' END || source || '-' ||
      CAST(doc_id AS VARCHAR) || (['.md', '.txt', '.epub', '.pdf', '.html', '.docx', '.png', '.mp3'])[doc_id % 8 + 1]
      AS filename FROM documents)
),
f6a AS (SELECT * FROM f6 WHERE filename NOT LIKE '.%' AND filename NOT LIKE '~$%'),
known AS (SELECT DISTINCT sha256(d.text) AS file_hash FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
f6p AS (SELECT *, sha256(text) AS file_hash,
          CASE WHEN doc_id % 8 IN (6, 7) THEN 'ValueError(''no converter for ' || CASE WHEN doc_id % 8 = 6 THEN 'png'
               ELSE 'mp3' END || ''')' END AS error FROM f6a),
f6f AS (SELECT file_hash, min(path) AS first_path FROM f6p WHERE error IS NULL GROUP BY file_hash),
f6o AS (SELECT p.*, CASE WHEN p.error IS NOT NULL THEN 'failed'
          WHEN p.file_hash IN (SELECT file_hash FROM known) OR p.path <> f.first_path THEN 'duplicate'
          ELSE 'ingested' END AS outcome FROM f6p p LEFT JOIN f6f f ON f.file_hash = p.file_hash)"""
