"""Cross-tokenizer alignment against whole-text encoding and all overlaps of byte ranges."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import cross_tokenizer as X
from strata.sources.tables import read_table
from tests.llm.cases import empty, hostile, prose, rows_of
from tests.conftest import SMALL


def paths():
    import public_tokenizers as P

    return P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@lru_cache
def pair():
    return X.TokenizerPair(*paths())


def tokens(text):
    """Whole text with both tokenizers: (ids of a, ids of b), None if the bytes differ."""
    p = pair()
    if not text:
        return None
    a, b = p.a.encode(" " + text, add_special_tokens=False).ids, p.b.encode(text)
    spelt = (" " + text).encode()
    return (a, b) if X._spelling(p.a_bytes, a) == spelt == X._spelling(p.b_bytes, b) else None


def overlaps(text):
    """(a, b, groups text, links) by comparing every byte range with every other that it can reach."""
    found = tokens(text)
    if found is None:
        return [], [], "", []
    a, b = found
    p = pair()
    ends_a, ends_b = np.cumsum(p.a_size[a]).tolist(), np.cumsum(p.b_size[b]).tolist()
    links, first = [], 0
    for x, end in zip(a, ends_a, strict=True):
        start = end - int(p.a_size[x])
        while ends_b[first] <= start:
            first += 1
        k = first
        while k < len(b) and ends_b[k] - p.b_size[b[k]] < end:
            links.append((x, b[k]))
            k += 1
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        k, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
        groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
        i, j = k, m
    return a, b, ";".join(groups), links


def brute(rows):
    found = [(doc_id, *overlaps(text)) for doc_id, text in rows]
    n = Counter(link for f in found for link in f[4])
    most = Counter()
    for (_, y), k in n.items():
        most[y] = max(most[y], k)
    return sorted(((doc_id, len(a), len(b), groups.count("|"), len(links), hashlib.sha256(groups.encode()).hexdigest() if groups else "",
                    sum(n[x] == most[x[1]] for x in links), sum(n[x] for x in links))
                   for doc_id, a, b, groups, links in found), key=repr)


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_same_as_brute_force_on_documents(spark):
    docs = read_table(spark, SMALL, "documents")
    assert rows_of(X.cross_tokenizer_alignment(docs, *paths())) == brute(texts(docs))


ODD = ["</s> <s><0x41> <|endoftext|>x", "a  b   c", " lead", "trail ", " ", "  ", "　x 　 y", "a▁b", "  q\u0085 r", "日本語 テキスト",
       "\x00 nul", "é ﬁ", "\n", "a \n b", "it's 's they'll", "\U0001f600 \U0001f468‍\U0001f469 x", "12345 6789,0", "x" * 3000, "日" * 700]


def test_hostile_rows(spark, monkeypatch):
    docs = hostile(spark).select("doc_id", "text", "lang", F.lit(1).alias("row_"), F.lit("p").alias("pairs"))
    odd = spark.createDataFrame([(100 + i, t, None, 1, "p") for i, t in enumerate(ODD)], docs.schema)
    docs = docs.union(odd)
    expected = brute(texts(docs))
    assert rows_of(X.cross_tokenizer_alignment(docs, *paths())) == expected
    # every text in many chunks and ranges, and the join instead of the broadcast
    docs = docs.where("text IS NULL OR length(text) < 4000")
    expected = brute(texts(docs))
    for name, value in (("LONG_BYTES", 40), ("CHUNK_CHARS", 64), ("RANGE_BYTES", 48), ("FAN", 6), ("MAX_PAIRS", 0)):
        monkeypatch.setattr(X, name, value)
    assert rows_of(X.cross_tokenizer_alignment(docs, *paths())) == expected
    assert X.cross_tokenizer_alignment(empty(spark), *paths()).count() == 0


def test_bytes_that_are_not_utf8(spark):
    docs = spark.createDataFrame([(1, bytearray(b"\xff\xfe bad")), (2, bytearray(b"fine"))], "doc_id long, text binary")
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = {r.doc_id: r for r in X.cross_tokenizer_alignment(docs, *paths()).collect()}
    assert (rows[1].n_a, rows[1].groups_sha256) == (0, "") and rows[2].n_a > 0


def closed_text(f):
    whole = X.BEGIN.then(pair(), f)
    assert not whole.suffix[0] and not whole.suffix[1]
    return whole.n_a, whole.n_b, whole.n_groups, whole.groups, sorted(np.frombuffer(whole.links, pair().code).tolist())


@pytest.mark.parametrize("seed", range(6))
def test_fragments_compose_in_any_order(seed):
    r = random.Random(seed)
    text = " ".join([prose(seed, 60), "日本語テキスト" * 20, "x" * 200, "\U0001f600" * 9, "réservé naïve"])
    a, b = tokens(text)
    p = pair()
    a, b = np.array(a, dtype=np.uint32), np.array(b, dtype=np.uint32)
    a_ends, b_ends = np.cumsum(p.a_size[a]), np.cumsum(p.b_size[b])
    cuts = sorted(r.sample(range(1, int(a_ends[-1])), (1, 7, 40, 300, 300, 2)[seed]))
    parts = []
    for low, high in zip([0, *cuts], [*cuts, int(a_ends[-1])], strict=True):
        x, y = (a_ends > low) & (a_ends <= high), (b_ends > low) & (b_ends <= high)
        parts.append(X.Fragment.of(p, a[x], a_ends[x], b[y], b_ends[y]))
    want_a, want_b, groups, links = overlaps(text)
    want = (len(want_a), len(want_b), groups.count("|"), groups, sorted(x * p.width + y for x, y in links))
    assert len(parts) < 300 or any(not f.cut for f in parts)
    while len(parts) > 1:  # neighbours join in a random order
        i = r.randrange(len(parts) - 1)
        parts[i:i + 2] = [parts[i].then(p, parts[i + 1])]
    assert closed_text(parts[0]) == want
