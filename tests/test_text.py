"""Text rules: golden values, and normalisation against a rule stated over Unicode's own tables."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from strata.functions import text as X



def words_of(text):
    """Compatibility-decomposed, case-folded runs of a-z or 0-9; marks and quotes vanish, & is a word."""
    parts = []
    for ch in text:
        kept = [c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c) and c not in "'’‘`"]
        parts.append("".join(" and " if c == "&" else c for c in kept).casefold())
    return " ".join(re.findall("[a-z]+|[0-9]+", "".join(parts)))


def test_normalize_native_matches_unicode(spark):
    rng = random.Random(7)
    marks = set("*_`>|#\\[]()!")
    pool = [chr(c) for c in range(0x20, 0x2200) if unicodedata.category(chr(c))[0] in "LNPSZ" and chr(c) not in marks]
    far = [chr(c) for c in range(0x10000, 0x20000) if unicodedata.category(chr(c))[0] in "LN"]
    samples = ["Café ÉTÉ Straße", "ﬁne Ⅳ ½", "don’t A&B x1y", "ÅNGSTRÖM ǆ ĳ", "  ", "", "Ⅻ. The Return", "𝐂𝐡𝐩 𝐨𝐧𝐞", "🄀 𝟙𝟚x"]
    samples += ["".join(rng.choice(pool) for _ in range(24)) for _ in range(300)]
    samples += ["".join(rng.choice(far) for _ in range(24)) for _ in range(100)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    got = {r.i: r.n for r in df.select("i", X.normalize(F.col("s")).alias("n")).collect()}
    for i, s in enumerate(samples):
        assert got[i] == words_of(s), (s, got[i], words_of(s))


def test_number_tokens(spark):
    cases = {"chapter twenty one x": ("x", 21), "iv": ("", 4), "xl": ("xl", None), "1234 a": ("1234 a", None),
             "chap 7": ("", 7), "third act": ("act", 3), "twenty": ("", 20), "ninety nine": ("", 99)}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    rows = df.select("s", X.strip_number_prefix(F.col("s")).alias("p")).collect()
    for r in rows:
        assert (r.p.rest, r.p.value) == cases[r.s]


def test_markers_and_parts(spark):
    cases = {"chapter 3": (True, False), "iv": (True, False), "twelve": (True, False), "chapter 3 the end": (False, False),
             "part ii": (False, True), "section seven": (False, True), "book": (False, False), "": (False, False)}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    for r in df.select("s", X.is_number_marker(F.col("s")).alias("m"), X.is_part_title(F.col("s")).alias("p")).collect():
        assert (r.m, r.p) == cases[r.s], r.s


def test_parse_date(spark):
    cases = {"2011-05-06": "2011-05-06", "D:20110506120000": "2011-05-06", "2011": "2011-01-01",
             "2011-02-30": "2011-02-01", "2011-13-01": "2011-01-01", "n/a": None, "0000-01-01": None,
             "\t2011-05-06\n": "2011-05-06"}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    for r in df.select("s", F.date_format(X.parse_date(F.col("s")), "yyyy-MM-dd").alias("d")).collect():
        assert r.d == cases[r.s]


def test_sanitize_and_strip(spark):
    df = spark.createDataFrame([("my stream.é-1",)], "s string")
    r = df.select(X.sanitize_name(F.col("s")).alias("a"),
                  X.strip_markdown(F.lit("# **Title** [x](y)  `z`")).alias("b")).first()
    assert r.a == "my_stream_é_1"
    assert r.b == "Title x z"


def test_html_becomes_markdown(spark):
    from strata.operators.metadata import html_to_markdown

    page = """<html><HEAD><title>T</title><script>x < 1</script></HEAD><body><!-- <p>no</p> --><h1 class="a">One
      <b>two</b></h1><p>See <a class='q' href="b.html#1">the <i>page</i></a> &amp; more&nbsp;<img src="x.png" alt="y"> here.<br/>New line</p>
      <ul><li>first</li><li>second &lt;tag&gt;</li></ul><style>p {}</style><table><tr><td>a</td><td>b</td></tr></table></body></html>"""
    rows = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "plain, 1 < 2 and 3 > 2")], "i long, html string")
    got = {r.i: r.m for r in rows.select("i", html_to_markdown(F.col("html")).alias("m")).collect()}
    assert got[1] == ("# One **two**\n\nSee [the page](b.html#1) & more  here.\n\nNew line\n\n- first\n\n- second <tag>\n\na  b")
    assert got[2] is None and got[3] == "" and got[4] == "plain, 1 < 2 and 3 > 2"


def test_folding_takes_no_text_apart(spark):
    multi = X._fold_table()[2]
    text = "Straße ½ ﬁne word " * 2000 + "".join(multi)
    df = spark.createDataFrame([(0, text), (1, "plain"), (2, None)], "i int, s string").select(
        "i", X.normalize(F.col("s")).alias("n"))
    assert "split(" not in df._jdf.queryExecution().optimizedPlan().toString()
    got = {r.i: r.n for r in df.collect()}
    assert got == {0: words_of(text), 1: "plain", 2: None}
    assert len(X._char_class(multi)) < len(multi) * 4  # neighbours are one range
