"""Decorators: derived columns on silver rows, computed on the executors.

The reference pulls pending rows to one client and calls model services row
by row.  Here the pending rows stay distributed: default backends are native
expressions (extractive summary, rule-based entities, hashed dense vectors,
tf sparse weights); a user model plugs in as ``fn(pandas.DataFrame) ->
pandas.DataFrame`` through :func:`run_decorator`, which isolates failing rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.relational import top_rows

# Decorator columns owned by silver and their types.
DECORATOR_COLUMNS = {
    "summary": "string",
    "ner_nel": "string",
    "text_embedding_dense": "array<float>",
    "text_embedding_sparse": "map<string,float>",
    "summary_embedding_dense": "array<float>",
}
EMBEDDING_COLUMNS = ("text_embedding_dense", "text_embedding_sparse", "summary_embedding_dense")
SUMMARY_CHARS = 200
DENSE_DIM = 64
TOKEN_RE = "[^a-z0-9]+"
SLICE_BYTES = 1 << 20   # characters of text whose vectors a Python worker holds at a time
MEMO_TOKENS = 200_000   # buckets of tokens that a task remembers; the memo is emptied beyond
_TOKEN = re.compile("[a-z0-9]+")


def _nonempty(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def pending_condition(decorator: str, text: str = "text") -> Column:
    """Rows still missing the decorator's value (and having something to decorate)."""
    t = F.col(text)
    if decorator in ("summary", "ner_nel"):
        return F.col(decorator).isNull() & _nonempty(t)
    if decorator == "embeddings":
        return ((_nonempty(t) & (F.col("text_embedding_dense").isNull() | F.col("text_embedding_sparse").isNull()))
                | (_nonempty(F.col("summary")) & F.col("summary_embedding_dense").isNull()))
    raise ValueError(f"unknown decorator {decorator!r}")


def pending(df: DataFrame, decorator: str, key: str, text: str = "text", limit: int | None = None) -> DataFrame:
    """Pending rows, optionally the first ``limit`` by key (a per-run cap; None = all)."""
    rows = df.where(pending_condition(decorator, text))
    return top_rows(rows, [key], limit) if limit else rows


# ---------------------------------------------------------------- backends

def extractive_summary(text: Column, max_chars: int = SUMMARY_CHARS) -> Column:
    """The sentence of the whole text with the most words, of those that fit ``max_chars``
    (the earliest of equals); if none fits, the beginning of the first."""
    def scored(s, i):
        plain = F.regexp_replace(s, "^[ \t\n\r]+|[ \t\n\r]+$", "")
        words = F.when(F.length(plain) <= max_chars, F.regexp_count(plain, F.lit("[^ \t\n\r]+"))).otherwise(0)
        return F.struct(words.alias("words"), (-i).alias("place"), plain.alias("sentence"))

    sentences = F.regexp_extract_all(text, F.lit("[^.!?]+[.!?]*"), 0)
    best = F.array_max(F.transform(sentences, scored))["sentence"]
    return F.substring(F.coalesce(best, text), 1, max_chars)


def sentences(text: Column) -> Column:
    return F.split(text, r"(?<=[.!?])\s+")


def entity_spans(sentence: Column) -> Column:
    """Runs of capitalised words."""
    return F.regexp_extract_all(sentence, F.lit(r"(\p{Lu}\p{Ll}+(?:\s+\p{Lu}\p{Ll}+)*)"), 1)


def entity_json(text: Column) -> Column:
    """Capitalised-word spans per sentence as entities; each entity relates to the next one of its
    sentence (linear in the text; all pairs of a sentence over the corpus: ``relations.entity_pairs``).
    JSON {topic, entities, relationships}."""
    per = F.transform(sentences(text), entity_spans)
    rel = F.flatten(F.transform(per, lambda es: F.filter(F.transform(es, lambda e, i: F.when(
        i + 1 < F.size(es), F.struct(e.alias("source"), F.lit("co_occurs").alias("relation"),
                                     F.get(es, i + 1).alias("target")))), lambda x: x.isNotNull())))
    ents = F.array_distinct(F.flatten(per))
    return F.to_json(F.struct(F.get(ents, 0).alias("topic"), ents.alias("entities"), rel.alias("relationships")))


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), TOKEN_RE), lambda t: t != "")


def _bucket(token: str, memo: dict[str, int]) -> int:
    if token not in memo:
        memo[token] = int(hashlib.md5(token.encode()).hexdigest()[:8], 16)
    return memo[token]


def _dense(counts: Counter, dim: int, memo: dict[str, int]) -> np.ndarray | None:
    out = np.zeros(dim)
    for token, n in counts.items():
        out[_bucket(token, memo) % dim] += n
    norm = np.sqrt((out * out).sum())
    return (out / norm).astype(np.float32) if norm else None


def _sparse(counts: Counter) -> dict | None:
    total = sum(counts.values())
    return {w: np.float32(n / total) for w, n in counts.items()} or None


def _slices(texts: pa.Array, slice_bytes: int) -> Iterator[list[Counter]]:
    """Token counts of the texts, in slices that end with the text that brings them to ``slice_bytes``."""
    held, size = [], 0
    for text in texts:
        text = text.as_py()
        held.append(Counter(_words(text)))
        size += len(text or "")
        if size >= slice_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def _dense_array(counts: list[Counter], dim: int, memo: dict[str, int]) -> pa.Array:
    if len(memo) > MEMO_TOKENS:
        memo.clear()
    vectors = [_dense(c, dim, memo) for c in counts]
    missing = np.array([v is None for v in vectors])
    flat = np.concatenate([np.empty(0, np.float32), *[v for v in vectors if v is not None]])
    return pa.ListArray.from_arrays(_offsets(np.where(missing, 0, dim)), pa.array(flat, pa.float32()), mask=pa.array(missing))


def _sparse_array(counts: list[Counter]) -> pa.Array:
    sizes = np.array([len(c) for c in counts])
    weights = [np.fromiter(c.values(), dtype=np.float64, count=len(c)) / max(sum(c.values()), 1) for c in counts]
    flat = np.concatenate([np.empty(0), *weights]).astype(np.float32)
    return pa.MapArray.from_arrays(_offsets(sizes), pa.array([w for c in counts for w in c], pa.string()),
                                   pa.array(flat), mask=pa.array(sizes == 0))


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))


def dense_vector(text: Column, dim: int = DENSE_DIM) -> Column:
    """Hashed bag-of-words vector of ``dim`` floats, L2-normalised, within the row (a slice of texts at a
    time).  A token's bucket is its md5's first 8 hex digits modulo ``dim``; NULL without tokens."""
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo: dict[str, int] = {}
        for texts in batches:
            for counts in _slices(texts, SLICE_BYTES):
                yield _dense_array(counts, dim, memo)

    return F.arrow_udf(vectors, "array<float>")(text)


def _words(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def sparse_vector(text: Column) -> Column:
    """Token -> tf weight (count / tokens in the row) as ``map<string,float>``, within the row (a slice of texts at a time)."""
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield from map(_sparse_array, _slices(texts, SLICE_BYTES))

    return F.arrow_udf(vectors, "map<string,float>")(text)


def both_vectors(text: Column, dim: int = DENSE_DIM) -> Column:
    """E06 and E07 of one text in one pass: struct(dense, sparse)."""
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo: dict[str, int] = {}
        for texts in batches:
            for counts in _slices(texts, SLICE_BYTES):
                yield pa.StructArray.from_arrays([_dense_array(counts, dim, memo), _sparse_array(counts)], names=["dense", "sparse"])

    return F.arrow_udf(vectors, "dense array<float>, sparse map<string,float>")(text)


def token_weights(df: DataFrame, key: str, text: str, carry: Sequence[str] = ()) -> DataFrame:
    """E07 as rows ``(key, *carry, token, weight)``: tf weight = count / tokens in the row (float).

    The row's own columns and its token total travel with the tokens, so one
    (row, token) partial aggregate is all there is: no join back.
    """
    rows = df.select(key, *carry, tokens(F.col(text)).alias("__t"))
    toks = rows.select(key, *carry, F.size("__t").alias("__total"), F.explode("__t").alias("token"))
    counts = toks.groupBy(key, "token", *carry, "__total").agg(F.count(F.lit(1)).alias("__n"))
    return counts.select(key, *carry, "token", (F.col("__n") / F.col("__total")).cast("float").alias("weight"))


def token_rows(df: DataFrame, key: str, text: str, slice_bytes: int = 2 << 20) -> DataFrame:
    """E07 as rows ``(key, token, weight)`` made within the row, without a shuffle: batches are cut by the bytes of
    their texts, and a slice's rows leave as flat columns."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(1).to_pylist()
            ends = np.cumsum([len(t or "") for t in texts]) // slice_bytes
            for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(ends)) + 1):
                places, names, weights = [], [], []
                for i in part.tolist():
                    counts = Counter(_words(texts[i]))
                    total = sum(counts.values())
                    places.append(np.full(len(counts), i))
                    names += counts
                    weights.append(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)) / max(total, 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.concatenate(places))), pa.array(names, pa.string()),
                     pa.array(np.concatenate(weights).astype(np.float32))], names=[key, "token", "weight"])

    kind = df.schema[key].dataType.simpleString()
    return df.where(F.col(text).isNotNull()).select(key, text).mapInArrow(rows, f"{key} {kind}, token string, weight float")


def with_embeddings(df: DataFrame, text: str = "text") -> DataFrame:
    """The three embedding columns filled where they are missing and have something to embed.

    The text's two vectors come from one pass over it.
    """
    dense, sparse, summary = EMBEDDING_COLUMNS
    wanted = _nonempty(F.col(text)) & (F.col(dense).isNull() | F.col(sparse).isNull())
    short = F.col(summary).isNull() & _nonempty(F.col("summary"))
    rows = df.withColumns({"__both": both_vectors(F.when(wanted, F.col(text))),
                           "__short": dense_vector(F.when(short, F.col("summary")))})
    return rows.withColumns({dense: F.coalesce(F.col(dense), F.col("__both.dense")),
                             sparse: F.coalesce(F.col(sparse), F.col("__both.sparse")),
                             summary: F.coalesce(F.col(summary), F.col("__short"))}).drop("__both", "__short")


# -------------------------------------------------------- generic runner

def run_decorator(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], key: str,
                  inputs: Sequence[str], out_schema: str, batch_rows: int = 64) -> DataFrame:
    """Run a model function on the executors with per-row failure isolation.

    Rows go to ``fn`` in Arrow batches of at most ``batch_rows`` (order kept).  If a
    batch fails, its rows are retried one at a time; rows that still fail come
    back with ``ok = false`` and the error text, and stay pending for the next run.
    """
    out_cols = [c.strip().split(" ")[0] for c in out_schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in range(0, len(pdf), batch_rows):
                part = pdf.iloc[start:start + batch_rows].reset_index(drop=True)
                if part.empty:
                    continue
                try:
                    res = fn(part[list(inputs)]).reset_index(drop=True)
                    res = res.assign(ok=True, error=None)
                except Exception:  # noqa: BLE001 - isolate the failing rows
                    rows = []
                    for i in range(len(part)):
                        try:
                            r = fn(part[list(inputs)].iloc[i:i + 1]).reset_index(drop=True)
                            rows.append(r.assign(ok=True, error=None))
                        except Exception as e:  # noqa: BLE001
                            rows.append(pd.DataFrame({c: [None] for c in out_cols}).assign(ok=False, error=repr(e)))
                    res = pd.concat(rows, ignore_index=True)
                res.insert(0, key, part[key].values)
                yield res[[key, *out_cols, "ok", "error"]]

    key_type = df.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, {out_schema}, ok boolean, error string"
    return df.select(key, *[c for c in inputs if c != key]).mapInPandas(run, schema)


def decorate_counts(results: DataFrame) -> DataFrame:
    """Pending, decorated ok and failed rows of one run (one aggregate)."""
    return results.agg(F.count(F.lit(1)).alias("pending"),
                       F.sum(F.col("ok").cast("int")).cast("bigint").alias("succeeded"),
                       F.sum((~F.col("ok")).cast("int")).cast("bigint").alias("failed"))


def run_status(counts: DataFrame) -> DataFrame:
    """A run fails when rows were pending and none succeeded."""
    return counts.withColumn("run_failed", (F.col("pending") > 0) & (F.coalesce(F.col("succeeded"), F.lit(0)) == 0))
