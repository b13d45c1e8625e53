"""Host-level quality rules.

Every document is measured by its own rules; the rule failures are added up per
host (the ``source`` column); each host's failure rate of a rule is shrunk
towards the other hosts with an empirical beta prior (moments over the hosts); a
host whose shrunk rate of any rule reaches ``max_rate`` is rejected, and the
verdict is joined back to its documents.

Null text: no words, so the base rules fail.  Null host: documents without a
host have no host verdict.  Empty tables give empty results; repeated rows are
counted and returned as often as they occur; other columns pass through
``filter_documents`` unread.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.words import covered, ngram_hashes, repeated, word_hashes
from strata.session import materialize

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
SYMBOLS = b"#*$%&|<>"
MAX_RATE = 0.5          # shrunk share of failing documents from which a host is rejected
PRIOR_STRENGTH = (2.0, 1000.0)  # bounds of the prior's weight in documents
RULES = ("short", "repetitive", "symbols", "duplicate_lines", "word_length")

BROADCAST_ROWS = 500_000  # failed documents (16 bytes each) that are sent to the tasks at most

_MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def measure(raw: bytes | None) -> tuple[int, int, int, int, int, int]:
    """The measures of one text, in the order of ``_MEASURES``."""
    words = raw.split() if raw else []
    if not words:
        return (0, 0, 0, 0, 0, 0)
    data = np.frombuffer(raw, dtype=np.uint8)
    inside = int(np.count_nonzero((data & 0xC0) == 0x80))  # continuation bytes are never white space
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = ngram_hashes(word_hashes(words), REPEAT_WINDOW)
    repeat = int(covered(repeated(windows), REPEAT_WINDOW, len(words)).sum()) if len(windows) else 0
    return (len(words), sum(map(len, words)) - inside, sum(raw.count(bytes([b])) for b in SYMBOLS),
            len(lines) - len(set(lines)), repeat, len(lines))


def _measure_batch(raw: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(x) for x in raw], columns=[f.split()[0] for f in _MEASURES.split(", ")])


def measures(text: Column) -> Column:
    return F.pandas_udf(_measure_batch, _MEASURES)(text.cast("binary"))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def rule_failures(m: Column) -> dict[str, Column]:
    return {
        "short": m["n_words"] < MIN_WORDS,
        "repetitive": 100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"],
        "symbols": 10 * m["n_symbols"] > m["n_words"],
        "duplicate_lines": 10 * m["n_dup_lines"] > 3 * m["n_lines"],
        "word_length": (m["word_chars"] < 3 * m["n_words"]) | (m["word_chars"] > 12 * m["n_words"]),
    }


def host_failures(rows: DataFrame) -> DataFrame:
    """(host, m) -> per host: documents and failures of each rule.  Hosts without a name are left out."""
    fails = rule_failures(F.col("m"))
    return rows.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.sum(c.cast("long")).alias(r) for r, c in fails.items()])


def beta_priors(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """Per rule (a, b) of the beta prior by moments: the spread of host rates around the pooled one sets its weight."""
    docs = F.sum("n_docs")
    pooled = hosts.agg(F.count(F.lit(1)).alias("hosts"), docs.alias("docs"),
                       *[(F.sum(r) / docs).alias(r) for r in RULES]).first()  # one row, whatever the corpus
    if not pooled.docs:
        return dict.fromkeys(RULES, (1.0, 1.0))
    spread = hosts.agg(*[(F.sum(F.col("n_docs") * F.pow(F.col(r) / F.col("n_docs") - pooled[r], 2)) / docs).alias(r)
                         for r in RULES]).first()
    low, high = PRIOR_STRENGTH
    priors = {}
    for r in RULES:
        mean = pooled[r]
        beyond = spread[r] - mean * (1 - mean) * pooled.hosts / pooled.docs  # less the binomial noise
        weight = mean * (1 - mean) / beyond - 1 if beyond > 0 else high
        weight = min(max(weight, low), high)
        priors[r] = (mean * weight, (1 - mean) * weight)
    return priors


def host_verdicts(rows: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """(host, m) -> host, n_docs, shrunk rate per rule, rejected."""
    hosts = materialize(host_failures(rows), "host-failures")
    shrunk = {r: (F.col(r) + F.lit(a)) / (F.col("n_docs") + F.lit(a + b)) for r, (a, b) in beta_priors(hosts).items()}
    return hosts.select("host", "n_docs", *[c.alias(r + "_rate") for r, c in shrunk.items()],
                        F.greatest(*shrunk.values()).alias("worst")) \
        .withColumn("rejected", F.col("worst") >= max_rate)


def judge_documents(docs: DataFrame, host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """Per input row: doc_id, the measures, base_failed, host_rejected, kept."""
    rows = docs.select("doc_id", F.col(host).alias("host"), measures(F.col("text")).alias("m"))
    rows = materialize(rows, "measures")  # a few numbers per document: the texts are measured once
    verdicts = host_verdicts(rows, max_rate).select(F.col("host").alias("verdict_host"), "rejected")
    failed = base_failed(F.col("m"))
    rejected = F.coalesce(F.col("rejected"), F.lit(False))
    return (rows.join(verdicts, F.col("host") == F.col("verdict_host"), "left")
            .select("doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
                    failed.alias("base_failed"), rejected.alias("host_rejected"),
                    (~failed & ~rejected).alias("kept")))


def filter_documents(docs: DataFrame, host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """The rows of ``docs`` (all columns) that the document rules and their host's verdict keep."""
    rows = docs.select(F.col("doc_id"), F.xxhash64("text").alias("text_hash"), F.col(host).alias("host"), measures(F.col("text")).alias("m"))
    rows = materialize(rows, "measures")  # a few numbers per document: the texts are measured once
    bad_host = host_verdicts(rows, max_rate).filter("rejected").select(F.col("host").alias("bad_host"))
    bad_text = rows.filter(base_failed(F.col("m"))).select(F.col("doc_id").alias("bad_doc"), F.col("text_hash").alias("bad_hash")).distinct()
    bad_text = materialize(bad_text, "failed-texts")
    if bad_text.count() <= BROADCAST_ROWS:
        bad_text = F.broadcast(bad_text)  # two numbers a row; more are joined by a shuffle
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # one struct, so its columns may have any names
    given = docs.select(row.alias("row"), F.xxhash64("text").alias("hash"))
    good = given.join(bad_host, F.col(f"row.`{host}`") == F.col("bad_host"), "left_anti")
    failed = F.col("row.doc_id").eqNullSafe(F.col("bad_doc")) & (F.col("hash") == F.col("bad_hash"))
    return good.join(bad_text, failed, "left_anti").select("row.*")
