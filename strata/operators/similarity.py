"""Similarity over stored vectors (E11): dense cosine/dot, sparse dot, top-k (given dense queries: ``vector_search``).

Top-k is two-phase: a local top-k inside (group, salt) sub-groups, then the
global top-k over at most ``salts x k`` survivors per group, so a group with
millions of candidates is never ranked whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


SLACK = 2e-6  # scores have six digits
BROADCAST_DOCS = 500_000  # documents (a key each) that are sent to the tasks at most
BROADCAST_TOKENS = 500_000  # (query, token, tier) rows that are sent to the tasks at most
TASK_POSTINGS = 1_000_000   # postings of a task that meets them
LIGHT = 0.3   # part of a query's k-th score that postings too light to be joined may add up to


def dot(a: Column, b: Column) -> Column:
    """Dense dot product in double precision (native ``zip_with`` + ``aggregate``)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                       lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, salt: Column,
          salts: int = 64) -> DataFrame:
    """Top ``k`` rows per group by ``order`` (a total order), in two phases."""
    local = Window.partitionBy(*group, F.pmod(salt, F.lit(salts))).orderBy(*order)
    first = df.withColumn("__r", F.row_number().over(local)).where(F.col("__r") <= k).drop("__r")
    final = Window.partitionBy(*group).orderBy(*order)
    return first.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)


def centroids(vectors: DataFrame, group: str, vec: str) -> DataFrame:
    """Mean vector per group: element-wise average via (group, position) partial aggregates."""
    e = vectors.select(group, F.posexplode(vec).alias("i", "x"))
    m = e.groupBy(group, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return m.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("c")).select(
        group, F.transform("c", lambda s: s["x"]).alias("centroid"))


def dense_topk(vectors: DataFrame, key: str, group: str, vec: str, k: int = 5) -> DataFrame:
    """Top-k vectors of each group by cosine similarity to the group's centroid.

    The vectors meet their own centroid through an equi-join on the group.
    """
    c = centroids(vectors, group, vec)
    j = vectors.join(c, group)
    scored = j.select(group, key, F.round(cosine(F.col(vec), F.col("centroid")), 6).alias("score"))
    return top_k(scored, [group], [F.col("score").desc(), F.col(key)], k, F.xxhash64(key))


def _token_rows(df: DataFrame, key: str, weights: str, alias: str, w: str) -> DataFrame:
    """Rows (key, t, weight) of stored sparse vectors or of (id, token, weight) rows; those without a key are left out."""
    df = df.where(F.col(key).isNotNull())
    if weights in df.columns:
        return df.select(F.col(key).alias(alias), F.explode(weights).alias("t", w)).withColumn(w, F.col(w).cast("double"))
    return df.select(F.col(key).alias(alias), F.col("token").alias("t"), F.col("weight").cast("double").alias(w))


def _dots(pairs: DataFrame, q: DataFrame, postings: DataFrame) -> DataFrame:
    """(q, d, score): full dot products of the given pairs.

    The pairs' documents are few as a rule: up to ``BROADCAST_DOCS`` of them are
    sent to the postings, so that only theirs are shuffled; more are met by a shuffle.
    """
    from strata.session import materialize

    pairs = materialize(pairs, "pairs")
    docs = materialize(pairs.select("d").distinct(), "pair-documents")
    few = docs.count() <= BROADCAST_DOCS
    postings = postings.select("d", "t", "wd").join(F.broadcast(docs) if few else docs, "d", "left_semi")
    return (pairs.join(q, "q").join(postings, ["d", "t"]).groupBy("q", "d")
            .agg(F.round(F.sum(F.col("wq") * F.col("wd")), 6).alias("score")))


def _tier(w: Column) -> Column:
    """The power of two below a weight, counted downwards: the tiers of a posting list."""
    return F.when(w > 0, F.greatest(F.lit(-64), F.least(F.lit(64), F.floor(-F.log2(w))))).otherwise(64).cast("int")


def _cut_weight(wq: np.ndarray, most: np.ndarray, bound: float) -> float:
    """The largest ``c`` found with sum(wq * min(c, most)) <= bound."""
    by = np.argsort(most)
    below = np.concatenate([[0.0], np.cumsum(wq[by] * most[by])[:-1]])
    above = np.cumsum(wq[by][::-1])[::-1]
    some = above > 0
    # Each of these lines lies above the sum, so where one meets the bound the sum has not.
    return max(0.0, float(((bound - below[some]) / above[some]).max())) if some.any() else np.inf


def _cuts(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per token of one query the weight that a posting must have to count, so that few postings do."""
    pdf = pdf.sort_values(["df", "t"])
    wq, most, df = (pdf[c].to_numpy(dtype=float) for c in ("wq", "most", "df"))
    least = pdf["least"].iloc[0]
    bound = 0.0 if pd.isna(least) else (least - SLACK) * LIGHT
    cut = np.zeros(len(pdf))
    if bound > 0:
        heavier = np.zeros((len(pdf), 130))  # postings per token by tier, the heaviest first
        for k, tiers in enumerate(pdf["tiers"]):
            for tier in tiers:
                heavier[k, tier["tier"] + 64] += tier["n"]
        heavier = np.cumsum(heavier, axis=1)
        best = df.sum()
        for rare in np.unique(np.linspace(0, len(pdf) - 1, 33).astype(int)).tolist():
            c = _cut_weight(wq[rare:], most[rare:], bound)
            tier = int(np.clip(np.floor(-np.log2(c)), -64, 64)) if 0 < c < np.inf else 64 if c == 0 else -64
            cost = df[:rare].sum() + heavier[rare:, tier + 64][most[rare:] >= c].sum()
            if cost < best:
                best, cut = cost, np.where(np.arange(len(pdf)) < rare, 0.0, c)
    light = wq * np.minimum(cut, most)  # what postings under the cut can give
    return pdf.assign(cut=cut, light=light, all_light=light.sum())[["q", "t", "wq", "least", "most", "cut", "light", "all_light"]]


def sparse_candidates(q: DataFrame, postings: DataFrame, k: int) -> DataFrame:
    """Pairs (q, d) among which are each query's ``k`` best, for weights that are not negative.

    The heaviest ``k`` postings of each token of a query give documents whose full
    scores bound its k-th best from below.  A document that has none of the query's
    rare tokens, and no other one with a weight of ``c`` or more, scores at most the
    sum of ``wq * min(c, heaviest posting)`` over the others.  Per query, ``c`` and
    what counts as rare are set so that this sum stays under the part ``LIGHT`` of
    the bound and the postings left are fewest, by the tiers (powers of two) of each
    list; only those postings are joined.  A document that they reach is a candidate
    if their sum, with all that its lighter postings could add, comes to the bound.
    """
    from strata.session import materialize

    tiered = postings.withColumn("tier", _tier(F.col("wd")))
    tiers = tiered.groupBy("t", "tier").agg(F.count(F.lit(1)).alias("n"), F.max("wd").alias("most"))
    lists = tiers.groupBy("t").agg(F.max("most").alias("most"), F.sum("n").alias("df"),
                                   F.collect_list(F.struct("tier", "n")).alias("tiers"))  # 129 tiers at most
    seeds = top_k(postings, ["t"], [F.col("wd").desc(), F.col("d")], k, F.xxhash64("d")).select("t", "d")
    seen = _dots(q.join(seeds, "t").select("q", "d").distinct(), q, postings)
    least = top_k(seen, ["q"], [F.col("score").desc(), F.col("d")], k, F.xxhash64("d")).where(F.col("rank") == k).select(
        "q", F.col("score").alias("least"))
    asked = q.join(lists, "t").join(least, "q", "left")
    kinds = {f.name: f.dataType.simpleString() for f in q.schema}
    # one query's tokens at a time
    cuts = asked.groupBy("q").applyInPandas(_cuts, f"q {kinds['q']}, t {kinds['t']}, wq double, least double, most double, "
                                                   "cut double, light double, all_light double")
    wanted = cuts.where(F.col("most") >= F.col("cut")).withColumn("tier", F.explode(F.sequence(
        _tier(F.col("most")) - 1, _tier(F.col("cut")) + 1)))
    # Up to a bound the queries' tokens are sent to the postings, which are dealt by document to tasks of bounded
    # size: no list of a frequent token is one task's, and a document's pairs meet where its postings are.
    wanted = materialize(wanted, "wanted")
    if wanted.count() <= BROADCAST_TOKENS:
        wanted, tiered = F.broadcast(wanted), tiered.repartition(-(-postings.count() // TASK_POSTINGS) + 1, "d")
    met = wanted.join(tiered, ["t", "tier"]).where(F.col("wd") >= F.col("cut"))
    reach = met.groupBy("q", "d").agg(F.sum(F.col("wq") * F.col("wd") - F.col("light")).alias("more"),
                                      F.max("all_light").alias("all_light"), F.max("least").alias("least"))
    can = F.col("least").isNull() | (F.col("more") + F.col("all_light") >= F.col("least") - SLACK)
    return reach.where(can).select("q", "d")


def sparse_dot_topk(queries: DataFrame, q_key: str, corpus: DataFrame, d_key: str, weights: str = "weights",
                    k: int = 10) -> DataFrame:
    """Top-k corpus rows per query by sparse dot product Σ_t w_q(t)·w_d(t), for any number of queries, exact.

    Inputs are stored sparse vectors (``map<string,float>`` column ``weights``) or,
    without that column, rows ``(id, token, weight)``.  Postings of tokens that a
    query has are kept once; only pairs of ``sparse_candidates`` are summed.  With
    a negative weight on either side its bounds do not hold, and every pair that
    shares a token is summed.  Scores have six digits, ties go to the lower key.
    """
    from strata.session import materialize

    q = materialize(_token_rows(queries, q_key, weights, "q", "wq"), "query-tokens")
    d = _token_rows(corpus, d_key, weights, "d", "wd")
    postings = materialize(d.join(q.select("t").distinct(), "t", "left_semi"), "postings")
    signs = [df.agg(F.min(w)).first()[0] or 0.0 for df, w in ((q, "wq"), (postings, "wd"))]  # two rows
    if min(signs) < 0:
        pairs = q.join(postings, "t").select("q", "d").distinct()
    else:
        pairs = sparse_candidates(q, postings, k)
    out = top_k(_dots(pairs, q, postings), ["q"], [F.col("score").desc(), F.col("d")], k, F.xxhash64("d"))
    return out.select(F.col("q").alias(q_key), F.col("d").alias(d_key), "score", "rank")


def sparse_centroid_topk(weights: DataFrame, key: str, group: str, k: int = 10) -> DataFrame:
    """Top-k rows of each group by sparse dot product with the group's mean sparse vector.

    ``weights`` are rows ``(key, group, token, weight)``.  The centroid is a
    (group, token) aggregate divided by the group's row count; every row token
    then meets exactly one centroid entry through an equi-join on (group, token),
    so the work is linear in the tokens: no pairs of rows are formed.
    """
    n = weights.select(key, group).distinct().groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    c = weights.groupBy(group, "token").agg(F.sum(F.col("weight").cast("double")).alias("s")).join(n, group)
    c = c.select(group, "token", (F.col("s") / F.col("n")).alias("cw"))
    s = weights.join(c, [group, "token"]).groupBy(group, key).agg(
        F.round(F.sum(F.col("weight").cast("double") * F.col("cw")), 9).alias("score"))
    return top_k(s, [group], [F.col("score").desc(), F.col(key)], k, F.xxhash64(key)).select(
        group, key, "score", "rank")
