"""Token counts: the exact histogram of encoded lengths and what follows from it.

Documents are counted by their number of tokens; suffix sums over the histogram
give, for every length that occurs taken as a context limit, how many documents
and tokens lie above it and how many tokens are left if each document is cut
there.  Between two occurring lengths the answers follow by arithmetic
(``truncated_totals``), so every limit has an exact one.

Only lengths and counts leave the executors' scan; the sums run within buckets of
``BUCKET`` lengths plus over one row per bucket.  Null and empty texts have length
0, repeated rows count as often as they occur, an empty table has no rows; other
columns are not read, and very long texts are encoded whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.encoder import encoder

BUCKET = 1024


def length_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """n_tokens, n_docs."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in batches:
            lengths = [len(enc.encode(text.as_py() or "")) for text in batch.column(0)]
            values, counts = np.unique(np.array(lengths, dtype=np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))],
                                             names=["n_tokens", "n"])

    return (docs.select("text").mapInArrow(scan, "n_tokens long, n long")
            .groupBy("n_tokens").agg(F.sum("n").alias("n_docs")))


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """Per occurring length as a limit: documents and tokens above it, totals, and tokens kept when cut there."""
    rows = histogram.withColumn("bucket", F.floor(F.col("n_tokens") / BUCKET)) \
        .withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    buckets = rows.groupBy("bucket").agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("toks"))
    beyond = Window.orderBy(F.col("bucket").desc())  # one row per BUCKET lengths
    above = buckets.select(F.col("bucket").alias("b"), (F.sum("docs").over(beyond) - F.col("docs")).alias("docs_beyond"),
                           (F.sum("toks").over(beyond) - F.col("toks")).alias("toks_beyond"))
    inside = Window.partitionBy("bucket").orderBy(F.col("n_tokens").desc())
    rows = rows.withColumn("docs_in", F.sum("n_docs").over(inside) - F.col("n_docs")) \
        .withColumn("toks_in", F.sum("tokens").over(inside) - F.col("tokens"))
    everything = histogram.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("total_docs"),
                               F.coalesce(F.sum(F.col("n_docs") * F.col("n_tokens")), F.lit(0)).alias("total_tokens"))
    total = everything.first()  # two numbers
    rows = rows.join(above, F.col("bucket") == F.col("b"))
    docs_above, toks_above = F.col("docs_in") + F.col("docs_beyond"), F.col("toks_in") + F.col("toks_beyond")
    return rows.select(
        "n_tokens", "n_docs", docs_above.alias("docs_above"), toks_above.alias("tokens_above"),
        (F.lit(total.total_docs) - docs_above).alias("docs_upto"), F.lit(total.total_docs).alias("total_docs"),
        F.lit(total.total_tokens).alias("total_tokens"),
        (F.lit(total.total_tokens) - toks_above + F.col("n_tokens") * docs_above).alias("tokens_if_cut"))


def quantiles(sums: DataFrame, percents: Sequence[int]) -> DataFrame:
    """percent, n_tokens: the least length that so many percent of the documents do not exceed."""
    rows = [F.min(F.when(100 * F.col("docs_upto") >= p * F.col("total_docs"), F.col("n_tokens"))).alias(f"p{p}") for p in percents]
    return sums.agg(*rows).select(F.explode(F.array(*[
        F.struct(F.lit(p).alias("percent"), F.col(f"p{p}").alias("n_tokens")) for p in percents])).alias("q")).select("q.*")


def truncated_totals(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """context_limit, tokens: tokens left when every document is cut at the limit, for any limits."""
    tokens = F.col("n_tokens") * F.col("n_docs")
    rows = [F.sum(F.when(F.col("n_tokens") <= n, tokens).otherwise(n * F.col("n_docs"))).alias(f"l{n}") for n in limits]
    return sums.agg(*rows).select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("context_limit"), F.coalesce(F.col(f"l{n}"), F.lit(0)).alias("tokens")) for n in limits])).alias("q")).select("q.*")
