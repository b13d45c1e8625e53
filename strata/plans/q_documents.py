"""Document splitting queries over the F5 books and the documents table."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import splitting as S
from strata.plans.fixtures import F5_SQL, f5_books
from strata.plans.registry import query
from strata.sources.tables import read_table

LINE_RE_SQL = "'\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]'"

LINES_SQL = f"""l AS (SELECT doc_id, line_no, line FROM (
    SELECT doc_id, unnest(range(len(arr))) AS line_no, unnest(arr) AS line, len(arr) AS n
    FROM (SELECT doc_id, string_split_regex(text, {LINE_RE_SQL}) AS arr FROM documents))
  WHERE NOT (line_no = n - 1 AND line = ''))"""


@query("split_lines", f"WITH {LINES_SQL} SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM l")
def split_lines(spark, sf_dir):
    return S.split_lines(read_table(spark, sf_dir, "documents"))


@query("build_chapters", f"""WITH {LINES_SQL},
b AS (SELECT doc_id, line_no AS start, CASE WHEN line_no % 10 = 5 THEN 'part' ELSE 'chapter' END AS kind,
        CASE WHEN line_no % 10 = 5 THEN 'Part at ' ELSE 'Chapter at ' END || CAST(line_no AS VARCHAR) AS name
      FROM l WHERE line_no % 4 = 0 OR line_no % 10 = 5),
n AS (SELECT doc_id, count(*) AS n_lines FROM l GROUP BY doc_id),
e AS (SELECT b.*, coalesce(lead(start) OVER (PARTITION BY b.doc_id ORDER BY start), n_lines) AS stop,
        last_value(CASE WHEN kind = 'part' THEN name END IGNORE NULLS) OVER (
          PARTITION BY b.doc_id ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS part
      FROM b JOIN n ON n.doc_id = b.doc_id),
t AS (SELECT e.doc_id, e.start, e.name, e.part, string_agg(l.line, chr(10) ORDER BY l.line_no) AS raw
      FROM e JOIN l ON l.doc_id = e.doc_id AND l.line_no > e.start AND l.line_no < e.stop
      WHERE e.kind = 'chapter' GROUP BY e.doc_id, e.start, e.name, e.part),
s AS (SELECT *, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS text FROM t)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start) AS INTEGER) AS number, name, part, text
FROM s WHERE text <> ''""")
def build_chapters(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    lines = S.split_lines(docs)
    k = F.col("line_no")
    bounds = lines.where((k % 4 == 0) | (k % 10 == 5)).select(
        "doc_id", F.lit("fixed").alias("strategy"), F.col("line_no").cast("long").alias("start"),
        (F.col("line_no") + 1).cast("long").alias("body_start"),
        F.concat(F.when(k % 10 == 5, F.lit("Part at ")).otherwise(F.lit("Chapter at ")), k.cast("string")).alias("name"),
        F.when(k % 10 == 5, F.lit("part")).otherwise(F.lit("chapter")).alias("kind"))
    return S.build_chapters(docs.select("doc_id", "text"), bounds).select("doc_id", F.col("number").cast("int").alias("number"),
                                                         "name", "part", "text")


NAME_SQL = ("CASE layout WHEN 'chapter_markers' THEN 'Chapter ' || CAST(number AS VARCHAR) || ': Title ' || "
            "CAST(number AS VARCHAR) WHEN 'slides' THEN 'Slide ' || CAST(number AS VARCHAR) || ': Title ' || "
            "CAST(number AS VARCHAR) ELSE 'Title ' || CAST(number AS VARCHAR) END")
TEXT_SQL = "CASE WHEN layout = 'slides' THEN '# Title ' || CAST(number AS VARCHAR) || chr(10) || text ELSE text END"
BLOCK_SQL = """CASE layout WHEN 'headings' THEN '# Title ' || CAST(number AS VARCHAR)
  WHEN 'chapter_markers' THEN 'Chapter ' || CAST(number AS VARCHAR) || chr(10) || chr(10) || 'Title ' || CAST(number AS VARCHAR)
  WHEN 'slides' THEN '<!-- Slide number: ' || CAST(number AS VARCHAR) || ' -->' || chr(10) || '# Title ' || CAST(number AS VARCHAR)
  WHEN 'backlink_headings' THEN '[Title ' || CAST(number AS VARCHAR) || '](toc.html#c' || CAST(number AS VARCHAR) || ')'
  ELSE 'Title ' || CAST(number AS VARCHAR) END || chr(10) || text || repeat(chr(10), 12)"""


# Slide books also carry "# Title n" headings: under the headings strategy alone each chapter
# runs to the next heading, so it ends with the next slide's comment line.
SLIDES_AS_HEADINGS_SQL = """
UNION ALL
SELECT c.book_id, number, 'Title ' || CAST(number AS VARCHAR), CAST(NULL AS VARCHAR),
       CASE WHEN number < h.nch THEN text || repeat(chr(10), 13) || '<!-- Slide number: ' ||
            CAST(number + 1 AS VARCHAR) || ' -->' ELSE text END, 'headings'
FROM f5c c JOIN (
  SELECT book_id, count(*) AS nch,
         sum(31 + 2 * length(CAST(number AS VARCHAR)) + length(replace(text, chr(10), ''))) / count(*) >= 800 AS ok
  FROM f5c WHERE layout = 'slides' GROUP BY book_id) h ON h.book_id = c.book_id WHERE h.ok"""


def _strategy_sql(layout: str) -> str:
    extra = SLIDES_AS_HEADINGS_SQL if layout == "headings" else ""
    return f"""WITH {F5_SQL}
SELECT c.book_id, number, {NAME_SQL} AS name, CAST(NULL AS VARCHAR) AS part, {TEXT_SQL} AS text,
       c.layout AS strategy
FROM f5c c JOIN f5ok o ON o.book_id = c.book_id WHERE o.ok AND c.layout = '{layout}'{extra}"""


def _split_one(spark, sf_dir, layout):
    # One strategy on every F5 book: it yields chapters wherever its own rules apply.
    books = f5_books(spark, sf_dir)
    out = S.split_with(books.select(F.col("book_id").alias("doc_id"), "text"), layout)
    return out.select(F.col("doc_id").alias("book_id"), F.col("number").cast("int").alias("number"), "name",
                      "part", "text", "strategy")


@query("split_headings", _strategy_sql("headings"))
def split_headings(spark, sf_dir):
    return _split_one(spark, sf_dir, "headings")


@query("split_slides", _strategy_sql("slides"))
def split_slides(spark, sf_dir):
    return _split_one(spark, sf_dir, "slides")


@query("split_markers", _strategy_sql("chapter_markers"))
def split_markers(spark, sf_dir):
    return _split_one(spark, sf_dir, "chapter_markers")


@query("split_backlinks", _strategy_sql("backlink_headings"))
def split_backlinks(spark, sf_dir):
    return _split_one(spark, sf_dir, "backlink_headings")


@query("split_toc", _strategy_sql("table_of_contents"))
def split_toc(spark, sf_dir):
    return _split_one(spark, sf_dir, "table_of_contents")


CASCADE_BODY = f"""SELECT c.book_id, number, {NAME_SQL} AS name, CAST(NULL AS VARCHAR) AS part, {TEXT_SQL} AS text, c.layout AS strategy
FROM f5c c JOIN f5ok o ON o.book_id = c.book_id WHERE o.ok
UNION ALL
SELECT c.book_id, 1, 'Full text', CAST(NULL AS VARCHAR),
       rtrim(string_agg({BLOCK_SQL}, chr(10) ORDER BY number), chr(10)), 'whole_document'
FROM f5c c JOIN f5ok o ON o.book_id = c.book_id WHERE NOT o.ok GROUP BY c.book_id"""
CASCADE_SQL = f"WITH {F5_SQL} {CASCADE_BODY}"
BOOK_TEXT_SQL = f"""bt AS (SELECT book_id, min(source) AS source, min(book_no) AS book_no,
  CASE WHEN min(layout) = 'table_of_contents' THEN 'Contents' || chr(10) || chr(10) || string_agg('[Title ' ||
    CAST(number AS VARCHAR) || '](toc.html#c' || CAST(number AS VARCHAR) || ')', chr(10) ORDER BY number) || chr(10) || chr(10)
  ELSE '' END || string_agg({BLOCK_SQL}, chr(10) ORDER BY number) AS text FROM f5c GROUP BY book_id)"""


@query("split_cascade", CASCADE_SQL)
def split_cascade(spark, sf_dir):
    books = f5_books(spark, sf_dir)
    out = S.split_cascade(books.select(F.col("book_id").alias("doc_id"), "text"))
    return out.select(F.col("doc_id").alias("book_id"), F.col("number").cast("int").alias("number"), "name",
                      "part", "text", "strategy")


@query("split_documents", """SELECT doc_id, 1 AS number, 'Full text' AS name, CAST(NULL AS VARCHAR) AS part,
  regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text, 'whole_document' AS strategy FROM documents""")
def split_documents(spark, sf_dir):
    # Plain prose has no structure: every document of the table falls through to one chapter.
    out = S.split_cascade(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("number").cast("int").alias("number"), "name", "part", "text", "strategy")
