"""Column functions for text.

All are native expressions.  Spark has no Unicode NFKD; :func:`fold_unicode`
replaces it with a character table derived from Python's ``unicodedata`` by
rule (``tests/test_text.py`` checks it against the plain-Python rule).
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number words understood as chapter numbers.
UNIT_WORDS = ("one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
              "fifteen sixteen seventeen eighteen nineteen").split()
TENS_WORDS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
ORDINAL_WORDS = {"first": 1, "second": 2, "third": 3}

NUMBER_WORDS: dict[str, int] = {
    **dict(zip(UNIT_WORDS, range(1, 20), strict=True)), **dict(zip(TENS_WORDS, range(20, 100, 10), strict=True)), **ORDINAL_WORDS}

# Roman numerals up to 39: tens part x{0,3}, units part from this table.
ROMAN_UNITS = {"": 0, "i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9}
ROMAN_RE = "^(x{0,3})(ix|iv|v?i{0,3})$"

# Markdown link, noise, image and letter/digit boundary patterns.
LINK_RE = r"!?\[([^\]]*)\]\([^)]*\)"
MD_NOISE_RE = r"[*_`>|#\\]+"
IMAGE_RE = r"!\[[^\]]*\]\([^)]*\)"
LETTER_DIGIT_RE = r"(?<=[a-z])(?=[0-9])|(?<=[0-9])(?=[a-z])"


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` (a one-element ``transform``).

    Column helpers that use an input several times would otherwise copy its
    whole expression tree each time, and nested helpers grow exponentially.
    """
    return F.get(F.transform(F.array(value), fn), 0)


def pystrip(c: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _map_literal(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def strip_markdown(c: Column) -> Column:
    """P20: unwrap links, blank out emphasis/code/quote/table/heading/backslash marks, squeeze spaces."""
    c = F.regexp_replace(c, LINK_RE, "$1")
    c = F.regexp_replace(c, MD_NOISE_RE, " ")
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def _fold_char(ch: str) -> str:
    """The rule applied to one character: NFKD, drop combining marks, '&' -> ' and ', casefold."""
    t = unicodedata.normalize("NFKD", ch)
    t = "".join(x for x in t if not unicodedata.combining(x))
    return t.replace("&", " and ").casefold()


_FOLD_TABLE = None
_QUOTES = "'’‘`"


def _fold_table():
    """Built from the rule, once: which non-ASCII characters survive :func:`normalize` and as what.

    Only ``[0-9a-z]`` survives normalisation, so a character either maps to one
    such letter (``translate``), disappears (combining marks, quotes), expands to
    several (``ß`` -> ``ss``, ligatures; a map lookup), or becomes a space like
    any other symbol (left alone).
    """
    global _FOLD_TABLE
    if _FOLD_TABLE is None:
        import re

        src, dst, gone, multi = [], [], [], {}
        for cp in range(0x80, 0x110000):
            if 0xD800 <= cp <= 0xDFFF:
                continue
            ch = chr(cp)
            t = "".join(x for x in _fold_char(ch) if x not in _QUOTES)
            if t == "":
                gone.append(ch)
            elif re.search("[0-9a-z]", t):
                t = re.sub("[^0-9a-z]+", " ", t)
                if len(t) == 1:
                    src.append(ch)
                    dst.append(t)
                else:
                    multi[ch] = t
        _FOLD_TABLE = ("".join(src) + "".join(gone), "".join(dst), multi)
    return _FOLD_TABLE


def _char_class(chars) -> str:
    """A regex class of the given characters, neighbours as ranges: each range is one test per character of a text."""
    points = sorted(map(ord, chars))
    first = [p for p, before in zip(points, [-2, *points], strict=False) if p != before + 1]
    last = [p for p, after in zip(points, [*points[1:], -2], strict=True) if after != p + 1]
    return "[" + "".join(f"\\x{{{a:04x}}}-\\x{{{b:04x}}}" for a, b in zip(first, last, strict=True)) + "]"


def fold_unicode(c: Column) -> Column:
    """NFKD + drop combining marks + '&' -> 'and' + casefold, as far as ``[0-9a-z]`` can tell: native.

    A character that expands to several is replaced in the whole text at once, for
    each of the few that the text has: no text is taken apart into characters.
    """
    src, dst, multi = _fold_table()

    def expand(x):
        pairs = F.create_map(*[F.lit(v) for kv in multi.items() for v in kv])
        found = F.array_distinct(F.regexp_extract_all(x, F.lit(r"[^\x00-\x7f]"), F.lit(0)))
        return F.aggregate(F.filter(found, lambda ch: ch.rlike(_char_class(multi))), x,
                           lambda text, ch: F.replace(text, ch, pairs[ch]))

    x = let(F.translate(c, src, dst), expand)
    return F.lower(F.replace(x, F.lit("&"), F.lit(" and ")))


def normalize(c: Column) -> Column:
    """Lower-case alphanumeric words separated by single spaces."""
    c = fold_unicode(strip_markdown(c))
    c = F.regexp_replace(c, "['’‘`]", "")
    c = F.regexp_replace(c, "[^0-9a-z]+", " ")
    return F.trim(F.regexp_replace(c, LETTER_DIGIT_RE, " "))


def token_value(tok: Column) -> Column:
    """Value of one normalised number token: digits (<= 3), number word, roman (<= 39)."""
    def value(t):
        roman_tens = F.length(F.regexp_extract(t, ROMAN_RE, 1)) * 10
        roman_units = _map_literal(ROMAN_UNITS)[F.regexp_extract(t, ROMAN_RE, 2)]
        word = _map_literal(NUMBER_WORDS)[t]
        return (F.when(t.rlike("^[0-9]+$"), F.when(F.length(t) <= 3, t.cast("int")))
                .when(word.isNotNull(), word)
                .when((t != "") & t.rlike(ROMAN_RE), roman_tens + roman_units))

    return let(tok, value)


def parse_number(tokens: Column) -> Column:
    """Leading number of a token array -> struct(value, used); NULL when none.

    "twenty one" uses two tokens: a tens word followed by a word worth < 10.
    """
    def parse(toks):
        first = F.coalesce(F.get(toks, 0), F.lit(""))
        word2 = _map_literal(NUMBER_WORDS)[F.coalesce(F.get(toks, 1), F.lit(""))]
        two = first.isin(*TENS_WORDS) & word2.isNotNull() & (word2 < 10)

        def build(v1):
            return F.when(v1.isNotNull(), F.struct(
                F.when(two, v1 + word2).otherwise(v1).alias("value"),
                F.when(two, F.lit(2)).otherwise(F.lit(1)).alias("used")))
        return let(token_value(first), build)

    return let(tokens, parse)


# A normalised text can only carry a number prefix if its first token looks like one.
NUMBERISH_RE = r"^(chapter|chap|[0-9]|[ivx]+( |$)|(" + "|".join(NUMBER_WORDS) + r")( |$))"


def strip_number_prefix(norm: Column) -> Column:
    """Drop a leading ``chapter 3`` / ``iv`` / ``twenty one``; struct(rest, value).

    Most lines do not start with anything number-like: a native regex guard
    sends only the others through the token logic.
    """
    def guarded(n):
        fast = F.struct(F.trim(F.regexp_replace(n, " +", " ")).alias("rest"), F.lit(None).cast("int").alias("value"))
        return F.when(n.rlike(NUMBERISH_RE), _strip_number_prefix(n)).otherwise(fast)

    return let(norm, guarded)


def _strip_number_prefix(norm: Column) -> Column:
    def drop_word(t):
        return F.when(F.get(t, 0).isin("chapter", "chap"), F.slice(t, 2, 1 << 20)).otherwise(t)

    def split_off(toks):
        def result(p):
            rest = F.when(p.isNull(), F.array_join(toks, " ")).otherwise(
                F.array_join(F.slice(toks, F.coalesce(p["used"], F.lit(0)) + 1, 1 << 20), " "))
            return F.struct(rest.alias("rest"), p["value"].alias("value"))
        return let(parse_number(toks), result)

    toks = let(F.filter(F.split(norm, " "), lambda t: t != ""), drop_word)
    return let(toks, split_off)


def canonical(norm: Column) -> Column:
    """Spell a leading number as digits: ``chapter two x`` -> ``2 x``."""
    def spell(n):
        return let(strip_number_prefix(n), lambda s: F.when(s["value"].isNull(), n).otherwise(
            F.trim(F.concat_ws(" ", s["value"].cast("string"), s["rest"]))))
    return let(norm, spell)


def is_number_marker(norm: Column) -> Column:
    """True for ``chapter 3``, ``iv``, ``twelve``."""
    def test(n):
        return let(strip_number_prefix(n), lambda s: F.coalesce(
            (n != "") & s["value"].isNotNull() & (s["rest"] == ""), F.lit(False)))
    return let(norm, test)


def is_part_title(norm: Column) -> Column:
    """``part|book|volume|section`` followed by a number token."""
    return let(F.regexp_extract(norm, r"^(part|book|volume|section)\s+(\S+)", 2),
               lambda tok: F.coalesce((tok != "") & token_value(tok).isNotNull(), F.lit(False)))


def join_title(texts: Column) -> Column:
    """``["I", "Neoliberalism"]`` -> ``"I. Neoliberalism"``; otherwise the texts joined by spaces."""
    first = F.get(texts, 0)
    numbered = (F.size(texts) > 1) & is_number_marker(normalize(first))
    return F.when(numbered, F.concat(first, F.lit(". "), F.array_join(F.slice(texts, 2, 1 << 20), " "))
                  ).otherwise(F.array_join(texts, " "))


def parse_date(c: Column) -> Column:
    """Leading ISO date, ``D:YYYYMMDD...`` or a bare year; a bad day gives the 1st,
    a bad month 1 January; no match or year 0 gives NULL."""
    v = pystrip(c)
    v = F.when(v.startswith("D:"), F.substring(v, 3, 1 << 20)).otherwise(v)
    pat = r"^(\d{4})-?(\d{2})?-?(\d{2})?"
    y = F.regexp_extract(v, pat, 1)
    m = F.coalesce(F.nullif(F.regexp_extract(v, pat, 2), F.lit("")), F.lit("01"))
    d = F.coalesce(F.nullif(F.regexp_extract(v, pat, 3), F.lit("")), F.lit("01"))

    def mk(mm, dd):
        return F.try_to_date(F.concat_ws("-", y, mm, dd), "yyyy-MM-dd")

    out = F.coalesce(mk(m, d), mk(m, F.lit("01")), mk(F.lit("01"), F.lit("01")))
    return F.when((y != "") & (y != "0000"), out)


def clean_markdown(c: Column) -> Column:
    """P25: drop images, CRLF -> LF."""
    return F.replace(F.regexp_replace(c, IMAGE_RE, ""), F.lit("\r\n"), F.lit("\n"))


def sanitize_name(c: Column) -> Column:
    """Every character that is not a letter, digit or ``_`` becomes ``_``."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}_]", "_")


def chapter_id(file_hash: Column, number: Column) -> Column:
    """SHA-1 of ``<file hash>:<chapter number>``."""
    return F.sha1(F.concat(file_hash, F.lit(":"), number.cast("string")))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def file_extension(path: Column) -> Column:
    """Extension of the last path segment, lower case, without the dot ('' when none).

    A leading dot alone (``.bashrc``) is a hidden name, not an extension.
    """
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.lower(F.regexp_extract(name, r"^.+\.([^.]+)$", 1))
