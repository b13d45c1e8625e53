"""Exact top-k of stored vectors for given query vectors, with whole clusters skipped by their radius.

Vectors are assigned to the nearest of a few centroids, fitted on a bounded
sample (``SAMPLE`` rows by a hash of the key), and each cluster keeps the largest
distance of a member to its centroid.  For a query q and a member x of a cluster
with centroid c and radius r, ``q.x <= q.c + |q| r``: a cluster whose bound is
below the query's k-th best score cannot hold a result.  The first score comes
from the clusters with the highest bounds that hold k vectors; the second round
searches whatever the bound leaves.  The sample decides how much is skipped,
never what is found.

A cluster is searched in shards of some thousand vectors, each of which returns
its own k best per query, so that no cluster has to fit into one task and only
k rows per query and shard are shuffled.  Cosine works on vectors scaled to
length one; null vectors and those of length zero have no cosine and are left out,
as are rows without a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.similarity import top_k
from strata.session import materialize

SAMPLE = 8192         # vectors that the centroids are fitted on
CLUSTERS = 128        # at most; an eighth of the sample where that is less
ROUNDS = 8            # of the fit
SHARD_ROWS = 8192     # vectors searched at a time
QUERY_BLOCK = 32_768  # queries that meet a shard together
STEP = 256            # queries of one matrix product
SLACK = 2e-6          # scores are ranked at six digits


def _matrix(values: pa.Array) -> np.ndarray:
    """list<float> column -> matrix of doubles."""
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(values), -1) if len(values) else np.empty((0, 0))


def _unit(x: np.ndarray, scale: bool) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True) if scale else x


def _usable(df: DataFrame, key: str, vec: str, scale: bool) -> DataFrame:
    some = F.col(key).isNotNull() & F.col(vec).isNotNull()
    return df.where(some & F.exists(vec, lambda v: v != 0)) if scale else df.where(some)


def fit_centroids(vectors: DataFrame, key: str, vec: str, scale: bool) -> np.ndarray:
    """Centroids by Lloyd's rounds over a bounded sample."""
    rows = vectors.orderBy(F.xxhash64(key), F.col(key)).select(vec).limit(SAMPLE).toArrow()
    if not rows.num_rows:
        return np.empty((0, 0))
    x = _unit(_matrix(rows.column(0).combine_chunks()), scale)
    n = max(1, min(CLUSTERS, len(x) // 8))
    c = x[np.arange(n) * len(x) // n].copy()
    for _ in range(ROUNDS):
        own = np.argmin((c * c).sum(axis=1) - 2 * x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        size = np.bincount(own, minlength=n)
        c[size > 0] = sums[size > 0] / size[size > 0, None]
    return c


def assign(vectors: DataFrame, key: str, vec: str, centroids: np.ndarray, scale: bool) -> DataFrame:
    """(d, v, cluster, distance) of every vector, stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unit(_matrix(batch.column(1)), scale)
            own = np.argmin((centroids * centroids).sum(axis=1) - 2 * x @ centroids.T, axis=1)
            far = np.linalg.norm(x - centroids[own], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.int32()), pa.array(far)],
                                             names=["d", "v", "cluster", "distance"])

    rows = vectors.select(F.col(key).alias("d"), F.col(vec).alias("v"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return materialize(rows.mapInArrow(run, f"d {kinds['d']}, v {kinds['v']}, cluster int, distance double"), "clustered")


def cluster_bounds(queries: DataFrame, key: str, vec: str, centroids: np.ndarray, clusters: pd.DataFrame,
                   scale: bool) -> DataFrame:
    """(q, cluster, n, bound) for every query and cluster that has vectors: no member scores above ``bound``."""
    ids, n = clusters["cluster"].to_numpy(), clusters["n"].to_numpy()
    c, radius = centroids[ids], clusters["radius"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unit(_matrix(batch.column(1)), scale)
            bound = x @ c.T + np.linalg.norm(x, axis=1, keepdims=True) * radius
            place = np.repeat(np.arange(len(x)), len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(place)), pa.array(np.tile(ids, len(x)), pa.int32()),
                 pa.array(np.tile(n, len(x)), pa.int64()), pa.array(bound.reshape(-1))], names=["q", "cluster", "n", "bound"])

    rows = queries.select(F.col(key).alias("q"), F.col(vec).alias("v"))
    return rows.mapInArrow(run, f"q {rows.schema['q'].dataType.simpleString()}, cluster int, n long, bound double")


def _searched(pairs: DataFrame, asked: DataFrame, stored: DataFrame, k: int, blocks: int, scale: bool) -> DataFrame:
    """(q, d, score): the k best per query and shard, for pairs (q, cluster, shards)."""
    every = F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))
    wanted = pairs.join(asked, "q").select(
        "q", F.col("v").alias("qv"), "cluster", F.pmod(F.xxhash64("q"), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
    offered = stored.withColumn("block", F.explode(every))
    q_type, d_type = asked.schema["q"].dataType.simpleString(), stored.schema["d"].dataType.simpleString()

    def search(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(vectors):
            vectors = vectors.sort_values("d")
            keys = vectors["d"].to_numpy()
            x = _unit(np.stack(vectors["v"].to_numpy()).astype(np.float64), scale)
            asked = _unit(np.stack(queries["qv"].to_numpy()).astype(np.float64), scale)
            for i in range(0, len(asked), STEP):
                score = x @ asked[i:i + STEP].T
                first = np.argsort(-np.floor(score * 1e6 + 0.5), axis=0, kind="stable")[:k]  # ties by key
                names = queries["q"].to_numpy()[i:i + STEP]
                out.append(pd.DataFrame({"q": np.tile(names, len(first)), "d": keys[first].reshape(-1),
                                         "score": np.take_along_axis(score, first, axis=0).reshape(-1)}))
        return pd.concat(out) if out else pd.DataFrame({"q": [], "d": [], "score": []})

    keys = ["cluster", "shard", "block"]
    return wanted.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInPandas(search, f"q {q_type}, d {d_type}, score double")


def _kth(found: DataFrame, k: int) -> DataFrame:
    best = top_k(found.withColumn("score", F.round("score", 6)), ["q"], [F.col("score").desc(), F.col("d")], k, F.xxhash64("d"))
    return best.where(F.col("rank") == k).select("q", F.col("score").alias("least"))


def dense_query_topk(queries: DataFrame, q_key: str, vectors: DataFrame, d_key: str, vec: str, k: int = 5,
                     measure: str = "cosine") -> DataFrame:
    """Top-k stored vectors for each of any number of query vectors: (q_key, d_key, score, rank), exact.

    ``measure`` is cosine or dot; scores have six digits, ties go to the lower key.
    """
    found = search_clusters(queries, q_key, vectors, d_key, vec, k, measure)[0]
    out = top_k(found.withColumn("score", F.round("score", 6)), ["q"], [F.col("score").desc(), F.col("d")], k, F.xxhash64("d"))
    return out.select(F.col("q").alias(q_key), F.col("d").alias(d_key), "score", "rank")


def search_clusters(queries: DataFrame, q_key: str, vectors: DataFrame, d_key: str, vec: str, k: int,
                    measure: str) -> tuple[DataFrame, DataFrame]:
    """The candidates (q, d, score) of the shards searched, and the (q, cluster, n) that were."""
    scale = measure == "cosine"
    if measure not in ("cosine", "dot"):
        raise ValueError(f"measure must be cosine or dot, not {measure}")
    asked = materialize(_usable(queries, q_key, vec, scale).select(F.col(q_key).alias("q"), F.col(vec).alias("v")), "asked")
    given = _usable(vectors, d_key, vec, scale)
    centroids = fit_centroids(given, d_key, vec, scale)
    if not len(centroids):
        kinds = f"q {asked.schema['q'].dataType.simpleString()}, d {given.schema[d_key].dataType.simpleString()}, score double"
        spark = queries.sparkSession
        return spark.createDataFrame([], kinds), spark.createDataFrame([], "q int, cluster int, n long")
    stored = assign(given, d_key, vec, centroids, scale)
    clusters = stored.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius")).toPandas()  # <= CLUSTERS
    shards = F.ceil(F.col("n") / F.lit(SHARD_ROWS)).cast("long")
    sizes = queries.sparkSession.createDataFrame(clusters[["cluster", "n"]], "cluster int, n long").withColumn("shards", shards)
    stored = stored.join(F.broadcast(sizes), "cluster").select(  # <= CLUSTERS rows
        "d", "v", "cluster", F.pmod(F.xxhash64("d", F.lit(1)), F.col("shards")).alias("shard"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    bounds = materialize(cluster_bounds(asked, "q", "v", centroids, clusters, scale).withColumn("shards", shards), "bounds")
    before = Window.partitionBy("q").orderBy(F.col("bound").desc(), "cluster").rowsBetween(Window.unboundedPreceding, -1)
    probed = F.coalesce(F.sum("n").over(before), F.lit(0)) < k
    bounds = bounds.withColumn("first", probed)
    first = materialize(_searched(bounds.where("first"), asked, stored, k, blocks, scale), "first-results")
    left = bounds.where("NOT first").join(_kth(first, k), "q", "left").where(
        F.col("least").isNull() | (F.col("bound") >= F.col("least") - F.lit(SLACK)))
    left = materialize(left.select("q", "cluster", "n", "shards"), "second-pairs")
    found = first.union(_searched(left, asked, stored, k, blocks, scale))
    return found, bounds.where("first").select("q", "cluster", "n").union(left.select("q", "cluster", "n"))
