"""Document metadata as row expressions.

Each extractor returns a struct ``(title, author, publication_date)`` column;
:func:`metadata_chain` keeps the first non-empty value per field.  Everything
is a native expression, the HTML converter too.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import let, parse_date, pystrip

# Header fields of the converted-EPUB metadata block.
HEADER_LINE = r"\*\*(Title|Authors?|Language|Publisher|Date|Description|Identifier):\*\*"
# Every file extension the converter accepts (compared in lower case).
SUPPORTED_EXTENSIONS = ("pdf epub docx pptx xlsx xls html htm csv json jsonl xml rss atom txt text md "
                        "markdown ipynb msg zip jpg jpeg png wav mp3 m4a mp4").split()

_NL = r"(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029])"


def _header(text: Column) -> Column:
    """struct(head, body): the leading run of blank and ``**Field:** value`` lines, and the lines after it."""
    def cut(lines):
        other = F.transform(lines, lambda x: (F.length(pystrip(x)) > 0) & ~x.rlike("^" + HEADER_LINE))
        n = F.when(F.array_position(other, True) > 0, F.array_position(other, True) - 1).otherwise(F.size(lines))
        return let(n.cast("int"), lambda k: F.struct(
            F.filter(F.slice(lines, 1, k), lambda x: x.rlike("^" + HEADER_LINE)).alias("head"),
            F.slice(lines, k + 1, F.size(lines)).alias("body")))

    return let(F.split(text, _NL), cut)


def header_metadata(text: Column) -> Column:
    """Fields of the header block; a later line overrides an earlier one;
    ``Author`` and ``Authors`` are one field."""
    def fields(head):
        pairs = F.transform(head, lambda x: F.struct(
            F.regexp_replace(F.lower(F.regexp_extract(x, HEADER_LINE, 1)), "s$", "").alias("k"),
            pystrip(F.regexp_extract(x, "^" + HEADER_LINE + "(.*)$", 2)).alias("v")))

        def last(name):
            return F.nullif(F.try_element_at(F.filter(pairs, lambda p: p["k"] == name), F.lit(-1))["v"], F.lit(""))

        return F.struct(last("title").alias("title"), last("author").alias("author"),
                        parse_date(last("date")).alias("publication_date"), (F.size(head) > 0).alias("has_header"))

    return let(_header(text)["head"], fields)


def strip_header(text: Column) -> Column:
    """The body after the header block (lines re-joined with LF); unchanged without a header."""
    body = let(_header(text), lambda h: F.when(F.size(h["head"]) > 0, F.regexp_replace(
        F.array_join(h["body"], "\n"), r"\n$", "")))
    return F.coalesce(body, text)


# Year and author patterns of file names.
YEAR_RE = r"\((\d{4})(?:\s*,\s*\d{4})*\)"
AUTHOR_RE = r"(?U)(?:\s-\s|\sby\s)((?:[A-Z][\w.'’]*\s?){2,4}(?:\s&\s(?:[A-Z][\w.'’]*\s?){2,4})?)$"


def file_stem(name: Column) -> Column:
    return F.when(F.regexp_extract(name, r"^(.+)\.[^.]*$", 1) != "",
                  F.regexp_extract(name, r"^(.+)\.[^.]*$", 1)).otherwise(name)


def filename_metadata(name: Column) -> Column:
    """``Title (2011) - Jane Doe.pdf`` / ``Title by Jane Doe``: title, author, year."""
    stem = file_stem(name)
    year = F.regexp_extract(stem, YEAR_RE, 1)
    no_year = F.regexp_replace(F.regexp_replace(stem, YEAR_RE, ""), r"^[ \-_]+|[ \-_]+$", "")
    author = F.regexp_extract(no_year, AUTHOR_RE, 1)
    # Title = text before the author match (the separator is stripped with the edge characters).
    head = F.regexp_replace(no_year, r"(?U)(?:\s-\s|\sby\s)(?:(?:[A-Z][\w.'’]*\s?){2,4}"
                                     r"(?:\s&\s(?:[A-Z][\w.'’]*\s?){2,4})?)$", "")
    title = F.regexp_replace(F.when(author != "", head).otherwise(no_year), r"^[ \-_]+|[ \-_]+$", "")
    return F.struct(F.nullif(title, F.lit("")).alias("title"),
                    F.nullif(F.trim(author), F.lit("")).alias("author"),
                    F.when(year != "", F.try_to_date(F.concat(year, F.lit("-01-01")), "yyyy-MM-dd"))
                    .alias("publication_date"))


def xml_metadata(xml: Column) -> Column:
    """Title, creator and created date of an office core-properties XML document."""
    def text(tag):
        v = F.xpath_string(xml, F.lit(f"//*[local-name()='{tag}']"))
        return F.nullif(pystrip(v), F.lit(""))

    return F.struct(text("title").alias("title"), text("creator").alias("author"),
                    parse_date(text("created")).alias("publication_date"))


def metadata_chain(*sources: Column) -> Column:
    """Per field the first non-empty value across extractors, in the given order."""
    def pick(field):
        return F.coalesce(*[F.nullif(s[field].cast("string"), F.lit("")) for s in sources])

    return F.struct(pick("title").alias("title"), pick("author").alias("author"),
                    F.coalesce(*[s["publication_date"] for s in sources]).alias("publication_date"))


def inbox_accepts(name: Column, extensions: Sequence[str] = SUPPORTED_EXTENSIONS) -> Column:
    """A supported extension (any case), not hidden (``.``), not an office lock file (``~$``)."""
    ext = F.lower(F.regexp_extract(name, r"^.+\.([^.]+)$", 1))
    return ext.isin(*extensions) & ~name.startswith(".") & ~name.startswith("~$")


def scan_inbox(spark, folder: str) -> DataFrame:
    """Direct children of the inbox (not recursive), accepted names only.

    ``binaryFile`` reads bytes on the executors; a missing folder is an empty scan.
    """
    from pyspark.sql.types import (BinaryType, LongType, StringType, StructField, StructType,
                                   TimestampType)

    schema = StructType([StructField("path", StringType()), StructField("modificationTime", TimestampType()),
                         StructField("length", LongType()), StructField("content", BinaryType())])
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema).withColumn("filename", F.lit(None).cast("string"))
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder)
    df = df.withColumn("filename", F.regexp_extract("path", r"([^/]+)$", 1))
    return df.where(inbox_accepts(F.col("filename")))


# ------------------------------------------------------------------ HTML

HTML_ENTITIES = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " "}


def html_title(html: Column) -> Column:
    """The page title with the common entities decoded."""
    t = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    for k, v in HTML_ENTITIES.items():
        if k != "&amp;":
            t = F.replace(t, F.lit(k), F.lit(v))
    return F.trim(F.replace(t, F.lit("&amp;"), F.lit("&")))


_BLOCKS = "p|div|article|section|ul|ol|nav|footer|header|main|aside|table|tbody|thead|tr|br|hr|li|blockquote|pre|body|html|form|h[1-6]"

#: HTML -> Markdown, in this order: (pattern, replacement with \\1 for a group); all ignore case, a dot is any character.
MARKDOWN_RULES = [
    (r"<!--.*?-->", ""),
    *[(rf"<{tag}\b[^>]*>.*?</{tag}\s*>", "") for tag in ("script", "style", "head")],
    (r"[ \t\n\r\f]+", " "),
    *[(rf"<h{n}\b[^>]*>", "\n\n" + "#" * n + " ") for n in range(1, 7)],
    (r"<li\b[^>]*>", "\n\n- "),
    (r"<img\b[^>]*>", ""),
    (r"<a\b[^>]*?\bhref ?= ?\"([^\"]*)\"[^>]*>(.*?)</a ?>", r"[\2](\1)"),
    (r"<a\b[^>]*?\bhref ?= ?'([^']*)'[^>]*>(.*?)</a ?>", r"[\2](\1)"),
    (r"</?(?:b|strong)\b[^>]*>", "**"),
    (rf"</?(?:{_BLOCKS})\b[^>]*>", "\n\n"),
    (r"</?t[dh]\b[^>]*>", " "),
    (r"<[a-z/!?][^>]*>", ""),
]
#: After the entities are decoded: blanks around line ends, and at the ends of the page.
_TIDY = [(r"[ \n]*\n[ \n]*", "\n\n"), (r"^[ \n]+|[ \n]+$", "")]


def html_to_markdown(html: Column) -> Column:
    """A page as Markdown: headings, list items, links and bold text kept, one block a paragraph;
    scripts, styles, the head, comments, images and all other tags removed, common entities decoded."""
    out = html
    for pattern, replacement in MARKDOWN_RULES:
        out = F.regexp_replace(out, "(?is)" + pattern, re.sub(r"\\(\d)", r"$\1", replacement))
    for name, letter in sorted(HTML_ENTITIES.items(), key=lambda kv: kv[0] == "&amp;"):
        out = F.replace(out, F.lit(name), F.lit(letter))
    for pattern, replacement in _TIDY:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def markdown_sql(html: str) -> str:
    """The same rules as DuckDB SQL."""
    out = html
    for pattern, replacement in MARKDOWN_RULES:
        out = f"regexp_replace({out}, '{pattern.replace(chr(39), chr(39) * 2)}', '{replacement}', 'gis')"
    for name, letter in sorted(HTML_ENTITIES.items(), key=lambda kv: kv[0] == "&amp;"):
        out = f"replace({out}, '{name}', '{letter.replace(chr(39), chr(39) * 2)}')"
    for pattern, replacement in _TIDY:
        out = f"regexp_replace({out}, '{pattern}', '{replacement}', 'g')"
    return out
