"""Small hostile tables and plain-Python counterparts shared by the tests."""

from __future__ import annotations

import random
import re

from pyspark.sql import Row
from pyspark.sql import types as T

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # further columns whose names clash with what operators work with
    T.StructField("n_words", T.StringType()), T.StructField("component_id", T.LongType()),
    T.StructField("node", T.LongType()), T.StructField("rejected", T.BooleanType()), T.StructField("position", T.LongType())])


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def prose(seed: int, n: int, vocabulary: int = 3000) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" + r.choice(["", "", ",", ".", "\n"]) for _ in range(n))


def hostile(spark, doc_ids_null: bool = True):
    """Nulls, empty, blank, very long and short texts, ties, repeated rows, near copies, odd white space."""
    base, long_text = prose(1, 200), prose(2, 60_000)
    near = base.split(" ")
    near[40], near[120] = "changed", "too"
    passage = prose(3, 60)
    texts = [None, "", " \t\n", "one", "one", "One  TWO\tthree", "one two three", base, base, " ".join(near), base.upper(),
             long_text, long_text + " end", prose(4, 80) + " " + passage + " " + prose(5, 90),
             passage + "\n" + prose(6, 50), "la " * 300, "x" * 50_000, "é ü ß " * 30, "<|endoftext|> a <|endoftext|>",
             "  lead and trail  ", "a  b\n\n c   d", "\x1c\x1d a\x85b", "line\nline\nline\n\nline",
             "mail me at a.b@c.de or 10.0.0.1, 4111 1111 1111 1111, +49 (30) 1234-5678 x" * 3]
    rows = [Row(doc_id=i, text=t, lang=None if i % 5 == 0 else "en", source=None if i % 7 == 0 else f"s{i % 3}",
                n_chars=None, n_words="x", component_id=1, node=2, rejected=True, position=3) for i, t in enumerate(texts)]
    rows.append(rows[8])  # a repeated row
    if doc_ids_null:
        rows += [rows[9].__class__(**{**rows[9].asDict(), "doc_id": None}), rows[0].__class__(**{**rows[0].asDict(), "doc_id": None})]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
