"""Text, hashing and metadata queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import text as X
from strata.operators import metadata as MD
from strata.plans.registry import query
from strata.sources.tables import read_table

RE_LINK = r"!?\[([^\]]*)\]\([^)]*\)"


def T(spark, sf_dir, name):
    return read_table(spark, sf_dir, name)


def _md_docs(spark, sf_dir):
    d = T(spark, sf_dir, "documents")
    md = F.concat(F.lit("# "), F.col("source"), F.lit("\n> **"), F.col("lang"), F.lit("** [link](http://x/"),
                  F.col("doc_id").cast("string"), F.lit(")\n"), F.col("text"))
    return d.select("doc_id", md.alias("md"))


MD_SQL = "'# ' || source || chr(10) || '> **' || lang || '** [link](http://x/' || CAST(doc_id AS VARCHAR) || ')' || chr(10) || text"


@query("strip_markdown", f"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace({MD_SQL},
  '{RE_LINK}', '\\1', 'g'), '[*_`>|#\\\\]+', ' ', 'g'), '\\s+', ' ', 'g')) AS stripped FROM documents""")
def strip_markdown_q(spark, sf_dir):
    return _md_docs(spark, sf_dir).select("doc_id", X.strip_markdown(F.col("md")).alias("stripped"))


@query("normalize_text")
def normalize_text(spark, sf_dir):
    # Whole texts through native folding and regex steps; golden cases in tests.
    return T(spark, sf_dir, "documents").select("doc_id", X.normalize(F.col("text")).alias("norm"))


NUMBER_WORDS_SQL = "MAP {" + ", ".join(f"'{k}': {v}" for k, v in X.NUMBER_WORDS.items()) + "}"
ROMAN_SQL = "CASE regexp_extract(tok, '^x{0,3}(ix|iv|v?i{0,3})$', 1) " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in X.ROMAN_UNITS.items()) + " END"


@query("number_tokens", f"""WITH t AS (SELECT unnest(regexp_split_to_array(lower(text), '[^0-9a-z]+')) AS tok FROM documents),
v AS (SELECT tok, CASE
  WHEN regexp_full_match(tok, '[0-9]+') THEN CASE WHEN length(tok) <= 3 THEN CAST(tok AS INTEGER) END
  WHEN {NUMBER_WORDS_SQL}[tok] IS NOT NULL THEN CAST({NUMBER_WORDS_SQL}[tok] AS INTEGER)
  WHEN tok <> '' AND regexp_full_match(tok, '(x{{0,3}})(ix|iv|v?i{{0,3}})')
    THEN CAST(length(regexp_extract(tok, '^(x{{0,3}})', 1)) * 10 + {ROMAN_SQL} AS INTEGER) END AS value
  FROM t WHERE tok <> '')
SELECT tok AS token, value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY tok, value""")
def number_tokens(spark, sf_dir):
    d = T(spark, sf_dir, "documents")
    toks = d.select(F.explode(F.split(F.lower("text"), "[^0-9a-z]+")).alias("tok")).where(F.col("tok") != "")
    return (toks.select(F.col("tok").alias("token"), X.token_value(F.col("tok")).alias("value"))
            .where(F.col("value").isNotNull()).groupBy("token", "value").agg(F.count(F.lit(1)).alias("n")))


@query("parse_date", """WITH o AS (SELECT o_orderkey, o_orderdate FROM orders)
SELECT o_orderkey, 'iso' AS variant, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS parsed FROM o
UNION ALL SELECT o_orderkey, 'pdf', strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') FROM o
UNION ALL SELECT o_orderkey, 'year', strftime(make_date(year(o_orderdate), 1, 1), '%Y-%m-%d') FROM o
UNION ALL SELECT o_orderkey, 'bad_day', strftime(make_date(year(o_orderdate), month(o_orderdate), 1), '%Y-%m-%d') FROM o
UNION ALL SELECT o_orderkey, 'bad_month', strftime(make_date(year(o_orderdate), 1, 1), '%Y-%m-%d') FROM o
UNION ALL SELECT o_orderkey, 'junk', CAST(NULL AS VARCHAR) FROM o""")
def parse_date_q(spark, sf_dir):
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    dt = F.col("o_orderdate")
    variants = F.array(
        F.struct(F.lit("iso").alias("variant"), F.date_format(dt, "yyyy-MM-dd").alias("raw")),
        F.struct(F.lit("pdf").alias("variant"), F.concat(F.lit("D:"), F.date_format(dt, "yyyyMMddHHmmss")).alias("raw")),
        F.struct(F.lit("year").alias("variant"), F.concat(F.lit("  "), F.date_format(dt, "yyyy")).alias("raw")),
        F.struct(F.lit("bad_day").alias("variant"), F.concat(F.date_format(dt, "yyyy-MM-"), F.lit("3"),
                                                             (F.dayofmonth(dt) % 8 + 2).cast("string")).alias("raw")),
        F.struct(F.lit("bad_month").alias("variant"), F.concat(F.date_format(dt, "yyyy-"),
                                                               (F.month(dt) + 12).cast("string"), F.lit("-01")).alias("raw")),
        F.struct(F.lit("junk").alias("variant"), F.concat(F.lit("n/a "), F.col("o_orderkey").cast("string")).alias("raw")))
    x = o.select("o_orderkey", F.inline(variants))
    return x.select("o_orderkey", "variant", F.date_format(X.parse_date(F.col("raw")), "yyyy-MM-dd").alias("parsed"))


@query("clean_markdown", "SELECT doc_id, text || chr(10) AS cleaned FROM documents")
def clean_markdown_q(spark, sf_dir):
    d = T(spark, sf_dir, "documents")
    raw = F.concat(F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n")), F.lit("\r\n![cover]("),
                   F.col("source"), F.lit(".png)"))
    return d.select("doc_id", X.clean_markdown(raw).alias("cleaned"))


@query("sanitize_name", "SELECT page_id, regexp_replace(url, '[^\\p{L}\\p{N}_]', '_', 'g') AS name FROM pages")
def sanitize_name_q(spark, sf_dir):
    return T(spark, sf_dir, "pages").select("page_id", X.sanitize_name(F.col("url")).alias("name"))


@query("chapter_id", "SELECT doc_id, sha1(sha256(text) || ':' || CAST(doc_id % 7 + 1 AS VARCHAR)) AS chapter_id "
                     "FROM documents")
def chapter_id_q(spark, sf_dir):
    d = T(spark, sf_dir, "documents")
    return d.select("doc_id", X.chapter_id(F.sha2("text", 256), F.col("doc_id") % 7 + 1).alias("chapter_id"))


@query("text_hash", "SELECT doc_id, sha256(text) AS file_hash FROM documents")
def text_hash(spark, sf_dir):
    return T(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("file_hash"))


@query("char_count", "SELECT doc_id, CAST(length(text) AS INTEGER) AS char_count, n_chars FROM documents")
def char_count(spark, sf_dir):
    return T(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("char_count"), "n_chars")


@query("url_extension", """SELECT page_id, lower(regexp_extract(regexp_extract(regexp_extract(url,
  '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1), '^.+\\.([^.]+)$', 1)) AS extension FROM pages""")
def url_extension(spark, sf_dir):
    p = T(spark, sf_dir, "pages")
    return p.select("page_id", X.file_extension(X.url_path(F.col("url"))).alias("extension"))


def _header_docs(spark, sf_dir):
    d = T(spark, sf_dir, "documents")
    k = F.col("doc_id")
    year = (1990 + k % 30).cast("string")
    month = (k % 9 + 1).cast("string")
    hdr = F.concat(F.lit("**Title:** "), F.col("source"), F.lit(" volume "), k.cast("string"),
                   F.lit("\n\n**Authors:** "), F.upper("lang"), F.lit(" Writer\n**Date:** "), year, F.lit("-0"),
                   month, F.lit("-15\n**Author:** Final "), F.col("lang"), F.lit("  \n\n"))
    return d.select("doc_id", "text", F.when(k % 5 == 0, F.col("text")).otherwise(F.concat(hdr, F.col("text")))
                    .alias("md"))


@query("header_metadata", """SELECT doc_id,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE source || ' volume ' || CAST(doc_id AS VARCHAR) END AS title,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'Final ' || lang END AS author,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE strftime(make_date(CAST(1990 + doc_id % 30 AS INTEGER), CAST(doc_id % 9 + 1 AS INTEGER), 15), '%Y-%m-%d') END
    AS publication_date,
  sha256(text) AS body_hash FROM documents""")
def header_metadata_q(spark, sf_dir):
    x = _header_docs(spark, sf_dir)
    h = MD.header_metadata(F.col("md"))
    return x.select("doc_id", h["title"].alias("title"), h["author"].alias("author"),
                    F.date_format(h["publication_date"], "yyyy-MM-dd").alias("publication_date"),
                    F.sha2(MD.strip_header(F.col("md")), 256).alias("body_hash"))


def _file_names(spark, sf_dir):
    c = T(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    title = F.concat(F.lit("the "), F.lower("c_mktsegment"), F.lit(" ledger "), k.cast("string"))
    author = F.concat(F.initcap(F.lower("c_mktsegment")), F.lit(" Nation"), F.col("c_nationkey").cast("string"))
    year = (1990 + k % 30).cast("string")
    name = (F.when(k % 4 == 0, F.concat(title, F.lit(" ("), year, F.lit(") - "), author, F.lit(".epub")))
            .when(k % 4 == 1, F.concat(title, F.lit(" by "), author, F.lit(".txt")))
            .when(k % 4 == 2, F.concat(title, F.lit(" ("), year, F.lit(").pdf")))
            .otherwise(F.concat(title, F.lit(".md"))))
    return c.select("c_custkey", name.alias("filename"))


FILENAME_TITLE_SQL = "'the ' || lower(c_mktsegment) || ' ledger ' || CAST(c_custkey AS VARCHAR)"
FILENAME_AUTHOR_SQL = ("upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) || ' Nation' || "
                       "CAST(c_nationkey AS VARCHAR)")


@query("filename_metadata", f"""SELECT c_custkey, {FILENAME_TITLE_SQL} AS title,
  CASE WHEN c_custkey % 4 IN (0, 1) THEN {FILENAME_AUTHOR_SQL} END AS author,
  CASE WHEN c_custkey % 4 IN (0, 2) THEN strftime(make_date(CAST(1990 + c_custkey % 30 AS INTEGER), 1, 1), '%Y-%m-%d') END AS publication_date
FROM customer""")
def filename_metadata_q(spark, sf_dir):
    x = _file_names(spark, sf_dir)
    m = MD.filename_metadata(F.col("filename"))
    return x.select("c_custkey", m["title"].alias("title"), m["author"].alias("author"),
                    F.date_format(m["publication_date"], "yyyy-MM-dd").alias("publication_date"))


def _core_xml(k, lang):
    return F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><cp:coreProperties xmlns:cp="http://schemas.openxmlformats.org/'
              'package/2006/metadata/core-properties" xmlns:dc="http://purl.org/dc/elements/1.1/" '
              'xmlns:dcterms="http://purl.org/dc/terms/"><dc:title> Xml title '), k.cast("string"),
        F.lit(" </dc:title><dc:creator>Creator "), lang, F.lit("</dc:creator><dcterms:created>"),
        (2000 + k % 20).cast("string"), F.lit("-03-04T05:06:07Z</dcterms:created></cp:coreProperties>"))


@query("xml_metadata", """SELECT doc_id, 'Xml title ' || CAST(doc_id AS VARCHAR) AS title, 'Creator ' || lang AS author,
  strftime(make_date(CAST(2000 + doc_id % 20 AS INTEGER), 3, 4), '%Y-%m-%d') AS publication_date FROM documents""")
def xml_metadata_q(spark, sf_dir):
    d = T(spark, sf_dir, "documents")
    m = MD.xml_metadata(_core_xml(F.col("doc_id"), F.col("lang")))
    return d.select("doc_id", m["title"].alias("title"), m["author"].alias("author"),
                    F.date_format(m["publication_date"], "yyyy-MM-dd").alias("publication_date"))


@query("metadata_chain", """SELECT doc_id,
  CASE WHEN doc_id % 2 = 0 THEN 'Header title ' || CAST(doc_id AS VARCHAR)
       WHEN doc_id % 3 = 0 THEN 'Xml title ' || CAST(doc_id AS VARCHAR)
       ELSE lower(source) || ' notes ' || CAST(doc_id AS VARCHAR) END AS title,
  CASE WHEN doc_id % 3 = 0 THEN 'Creator ' || lang ELSE 'Lang ' || upper(lang) END AS author,
  strftime(CASE WHEN doc_id % 4 = 0 THEN make_date(CAST(1980 + doc_id % 10 AS INTEGER), 1, 1)
       WHEN doc_id % 3 = 0 THEN make_date(CAST(2000 + doc_id % 20 AS INTEGER), 3, 4)
       ELSE make_date(CAST(2000 + doc_id % 20 AS INTEGER), 1, 1) END, '%Y-%m-%d') AS publication_date
FROM documents""")
def metadata_chain_q(spark, sf_dir):
    d = T(spark, sf_dir, "documents")
    k = F.col("doc_id")
    hdr_text = F.when(k % 2 == 0, F.concat(
        F.lit("**Title:** Header title "), k.cast("string"), F.lit("\n"),
        F.when(k % 4 == 0, F.concat(F.lit("**Date:** "), (1980 + k % 10).cast("string"), F.lit("\n")))
        .otherwise(F.lit("")), F.lit("\n"), F.col("text"))).otherwise(F.col("text"))
    xml = F.when(k % 3 == 0, _core_xml(k, F.col("lang")))
    fname = F.concat(F.lower("source"), F.lit(" notes "), k.cast("string"), F.lit(" ("),
                     (2000 + k % 20).cast("string"), F.lit(") - Lang "), F.upper("lang"), F.lit(".pdf"))
    chain = MD.metadata_chain(MD.header_metadata(hdr_text), MD.xml_metadata(xml), MD.filename_metadata(fname))
    return d.select("doc_id", chain["title"].alias("title"), chain["author"].alias("author"),
                    F.date_format(chain["publication_date"], "yyyy-MM-dd").alias("publication_date"))


@query("html_title", """SELECT page_id, trim(replace(replace(replace(replace(replace(replace(
  regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
  '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')) AS title FROM pages""")
def html_title_q(spark, sf_dir):
    return T(spark, sf_dir, "pages").select("page_id", MD.html_title(F.col("html")).alias("title"))


@query("html_to_markdown", f"SELECT page_id, {MD.markdown_sql('html')} AS markdown FROM pages")
def html_to_markdown_q(spark, sf_dir):
    return T(spark, sf_dir, "pages").select("page_id", MD.html_to_markdown(F.col("html")).alias("markdown"))


INBOX_NAME_SQL = """CASE c_custkey % 6 WHEN 0 THEN 'book' || CAST(c_custkey AS VARCHAR) || '.EPUB'
  WHEN 1 THEN '.hidden' || CAST(c_custkey AS VARCHAR) || '.pdf' WHEN 2 THEN '~$lock' || CAST(c_custkey AS VARCHAR) || '.docx'
  WHEN 3 THEN 'file' || CAST(c_custkey AS VARCHAR) || '.xyz' WHEN 4 THEN 'notes' || CAST(c_custkey AS VARCHAR) || '.md'
  ELSE 'noext' || CAST(c_custkey AS VARCHAR) END"""


def inbox_names(spark, sf_dir):
    c = T(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    ks = k.cast("string")
    name = (F.when(k % 6 == 0, F.concat(F.lit("book"), ks, F.lit(".EPUB")))
            .when(k % 6 == 1, F.concat(F.lit(".hidden"), ks, F.lit(".pdf")))
            .when(k % 6 == 2, F.concat(F.lit("~$lock"), ks, F.lit(".docx")))
            .when(k % 6 == 3, F.concat(F.lit("file"), ks, F.lit(".xyz")))
            .when(k % 6 == 4, F.concat(F.lit("notes"), ks, F.lit(".md")))
            .otherwise(F.concat(F.lit("noext"), ks)))
    return c.select("c_custkey", name.alias("filename"))


@query("inbox_filter", f"SELECT c_custkey, {INBOX_NAME_SQL} AS filename FROM customer WHERE c_custkey % 6 IN (0, 4)")
def inbox_filter(spark, sf_dir):
    return inbox_names(spark, sf_dir).where(MD.inbox_accepts(F.col("filename")))
