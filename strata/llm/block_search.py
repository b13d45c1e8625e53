"""Ranked lexical search over posting lists cut into blocks of similar documents, with exact bounds.

Score of a document for a query: the sum over the query's terms (repeats
included) of ``w(t) * impact(t, d)``, all integers (``weight``, ``impacts``).

A search takes a block of queries at a time, and with it the terms that these
queries can touch; every document is indexed, by its impacts on those terms.
The index has one row per shard of some thousand documents:

* each document's impacts (the exact vectors);
* each term's posting list.  A list of more than ``BLOCK`` documents is cut into
  blocks by similarity: random projections of the vectors place the documents,
  evenly chosen documents of the list are pivots, and each document joins its
  nearest one.  A block carries its *summary*, the largest impact per term over
  its documents (rounded up to a byte's steps).  Shorter lists are one block and are read whole, as a summary
  would be as long as they are.

For a query, a shard walks the lists by falling largest contribution.  A block
is skipped when the query's product with its summary is below the k-th best
score so far: no document in it can rank.  Lists end when all terms left
together stay below it.  The rest is scored exactly, once per document.  The
first k-th score comes from searching a 64th of the shards (at least one), a
lower bound of the final one, whatever those shards hold.

Null text has no terms.  A row is a document: repeated rows rank one by one, null
ids before others.  Equal rows of the query table are one query.  Queries without
terms, or an empty table on either side, give no rows.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.words import slices
from strata.session import materialize, scratch_path

TOP = 10
QUERIES = 1024           # queries of a block, about; each block reads the documents once
SHARD_DOCS = 4096
SHARD_CELLS = 1 << 23    # documents times terms of a shard
BLOCK = 256
SKETCH = 16              # random projections that place a document
PROBE = 64               # one shard in so many gives the first thresholds

# Terms are runs of ASCII letters and digits and of all bytes above; the rest separates.
_FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()

_INDEX_FIELDS = ["shard", "doc_ids", "doc_ptr", "doc_terms", "doc_impacts", "block_term", "block_ptr", "block_docs",
                 "summaries"]
INDEX = "shard long, doc_ids array<long>, " + ", ".join(f"{c} binary" for c in _INDEX_FIELDS[2:])


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a text in order, A-Z lower-cased."""
    return (text or b"").translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Impact per term occurrence count ``tf`` in documents of ``n`` terms; 0 where ``tf`` is 0."""
    m = 25 + (75 * n.astype(np.int64) * n_docs) // max(n_terms, 1)
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // np.maximum(1000 * tf + 8 * m, 1)


@dataclass(frozen=True)
class Corpus:
    """What the weights need: documents with a term, all terms with repeats, documents per term."""

    n_docs: int
    n_terms: int
    df: np.ndarray

    def weights(self) -> np.ndarray:
        return np.array([weight(self.n_docs, int(d)) for d in self.df], dtype=np.int64)


# ------------------------------------------------------------ vectors

def _kind(size: int) -> np.dtype:
    return np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")


def term_vectors(docs: DataFrame, terms: Sequence[bytes]) -> DataFrame:
    """Per document: doc_id, n (all its terms), and the places in ``terms`` and counts of those that it has."""
    places = {t: i for i, t in enumerate(terms)}
    kind = _kind(len(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = places.get
        for batch in slices(batches, "text"):
            n, ids, counts = [], [], []
            for text in batch.column(1).to_pylist():
                own = terms_of(text)
                found = np.array([i for i in map(known, own) if i is not None], dtype=kind)
                at, times = np.unique(found, return_counts=True)
                n.append(len(own))
                ids.append(at.tobytes())
                counts.append(times.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())],
                names=["doc_id", "n", "terms", "tf"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms binary, tf binary")


def corpus_of(vectors: DataFrame, n_terms: int) -> Corpus:
    """Statistics over all documents; the driver gets one row and one count per term."""
    kind = _kind(n_terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            df += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=kind), minlength=n_terms)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], names=["term", "df"])

    total = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    df = np.zeros(n_terms, dtype=np.int64)
    for r in vectors.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df
    return Corpus(total[0] or 0, total[1] or 0, df)


# --------------------------------------------------------------- the index

def _blocks(members: np.ndarray, place: np.ndarray, size: int) -> list[np.ndarray]:
    """A posting list in blocks of similar documents (about ``size`` each)."""
    if len(members) <= size:
        return [members]
    k = -(-len(members) // size)
    pivots = members[np.arange(k) * len(members) // k]
    nearest = np.argmax(np.einsum("ij,kj->ik", place[members], place[pivots]), axis=1)
    out = []
    for c in range(k):
        own = members[nearest == c]
        out += [own[i:i + 2 * size] for i in range(0, len(own), 2 * size)]
    return out


def shard_row(doc_ids: list, n: np.ndarray, rows: list[np.ndarray], counts: list[np.ndarray], corpus: Corpus,
              weights: np.ndarray, block_docs_about: int = BLOCK) -> tuple:
    """Index of one shard: its documents' ids, lengths, terms and counts -> the columns of ``INDEX`` behind ``shard``."""
    width = len(weights)
    kind = _kind(width)
    sizes = np.array([len(x) for x in rows], dtype=np.int64)
    doc_ptr = np.concatenate([[0], np.cumsum(sizes)])
    term = np.concatenate(rows).astype(np.int64)
    of = np.repeat(np.arange(len(rows)), sizes)
    value = impacts(np.concatenate(counts), np.repeat(n, sizes), corpus.n_docs, corpus.n_terms).astype(np.int32)
    dense = np.zeros((len(rows), width), dtype=np.int32)
    dense[of, term] = value
    signs = np.random.default_rng(1).choice(np.array([-1.0, 1.0], dtype=np.float32), (width, SKETCH))
    place = np.add.reduceat((value * weights[term]).astype(np.float32)[:, None] * signs[term], doc_ptr[:-1])
    place /= np.maximum(np.linalg.norm(place, axis=1, keepdims=True), 1e-9)
    order = np.argsort(term, kind="stable")
    members, ends = of[order], np.cumsum(np.bincount(term, minlength=width))
    block_term, block_docs, sums = [], [], []
    unit = _summary_unit(dense.max(axis=0))
    for t in np.unique(term).tolist():
        blocks = _blocks(members[ends[t - 1] if t else 0:ends[t]], place, block_docs_about)
        for block in blocks:
            block_term.append(t)
            block_docs.append(block)
            if len(blocks) > 1:
                sums.append((-(-dense[block].max(axis=0) // unit)).astype(np.uint8).tobytes())
    block_ptr = np.concatenate([[0], np.cumsum([len(x) for x in block_docs])])
    return (doc_ids, doc_ptr.astype("<i8").tobytes(), term.astype(kind).tobytes(), value.astype("<i4").tobytes(),
            np.array(block_term, dtype="<u4").tobytes(), block_ptr.astype("<i8").tobytes(),
            np.concatenate([*block_docs, np.empty(0, dtype=np.int64)]).astype("<u2").tobytes(), b"".join(sums))


def _summary_unit(most: np.ndarray) -> np.ndarray:
    """Summaries are kept in a 255th of a term's largest impact in the shard, rounded up: still upper bounds."""
    return np.maximum(1, -(-most // 255)).astype(np.int32)


def build_index(vectors: DataFrame, corpus: Corpus, shard_docs: int = SHARD_DOCS, block: int = BLOCK) -> DataFrame:
    """The stored index: a row per shard."""
    weights = corpus.weights()
    kind = _kind(len(weights))
    room = max(16, min(shard_docs, SHARD_CELLS // max(1, len(weights))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def close() -> pa.RecordBatch:
            doc_ids, n, terms, tf = zip(*held, strict=True)
            made = shard_row(list(doc_ids), np.array(n), [np.frombuffer(x, dtype=kind) for x in terms],
                             [np.frombuffer(x, dtype="<u4") for x in tf], corpus, weights, block)
            kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 7]
            return pa.RecordBatch.from_arrays([pa.array([v], type=k) for v, k in zip((number, *made), kinds, strict=True)],
                                              names=_INDEX_FIELDS)

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                held.append(row)
                if len(held) == room:
                    yield close()
                    held.clear()
                    number += 1
        if held:
            yield close()

    rows = vectors.where(F.octet_length("terms") > 0).select("doc_id", "n", "terms", "tf")  # others score 0
    path = scratch_path(vectors.sparkSession, "block-index")
    rows.mapInArrow(run, INDEX).write.option("parquet.block.size", 8 << 20).parquet(path)
    return vectors.sparkSession.read.schema(INDEX).parquet(path)


# ---------------------------------------------------------------- search

class Shard:
    """One row of the index, opened for queries."""

    def __init__(self, row: dict, width: int):
        kind = _kind(width)
        self.doc_ids = row["doc_ids"]
        #: rank of each document by id, null first, so that ties are settled on numbers
        self.by_id = np.empty(len(self.doc_ids), dtype=np.int64)
        self.by_id[sorted(range(len(self.doc_ids)), key=lambda i: (self.doc_ids[i] is not None, self.doc_ids[i] or 0))] = \
            np.arange(len(self.doc_ids))
        ptr = np.frombuffer(row["doc_ptr"], dtype="<i8")
        self.vectors = np.zeros((len(self.doc_ids), width), dtype=np.int32)
        self.vectors[np.repeat(np.arange(len(ptr) - 1), np.diff(ptr)), np.frombuffer(row["doc_terms"], dtype=kind)] = \
            np.frombuffer(row["doc_impacts"], dtype="<i4")
        term = np.frombuffer(row["block_term"], dtype="<u4").astype(np.int64)
        self.list_first = np.searchsorted(term, np.arange(width + 1))
        self.block_ptr = np.frombuffer(row["block_ptr"], dtype="<i8")
        self.block_docs = np.frombuffer(row["block_docs"], dtype="<u2").astype(np.int64)
        self.has_sum = np.repeat(np.diff(self.list_first) > 1, np.diff(self.list_first))
        self.sum_row = np.cumsum(self.has_sum) - 1
        self.summaries = np.frombuffer(row["summaries"], dtype=np.uint8).reshape(-1, width)
        self.most = self.vectors.max(axis=0).astype(np.int64)
        self.unit = _summary_unit(self.most).astype(np.int64)
        self.scored = self.skipped = self.blocks = 0  # documents scored, blocks skipped and met

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
        """The ``k`` best (score, place), fewer where scores are 0 or below ``floor``."""
        reach = weights * self.most[terms]
        order = np.argsort(-reach, kind="stable")
        left = np.cumsum(reach[order][::-1])[::-1]  # what all lists from here on can give together
        seen = np.zeros(len(self.doc_ids), dtype=bool)
        top_score, top_doc = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        threshold = max(1, floor)
        for step, t in enumerate(terms[order].tolist()):
            if left[step] < threshold:
                break
            blocks = np.arange(self.list_first[t], self.list_first[t + 1])
            self.blocks += len(blocks)
            bound = np.full(len(blocks), left[step])
            if len(blocks) and self.has_sum[blocks[0]]:
                bound = self.summaries[self.sum_row[blocks]][:, terms].astype(np.int64) @ (self.unit[terms] * weights)
                falling = np.argsort(-bound, kind="stable")
                blocks, bound = blocks[falling], bound[falling]
            at, stride = 0, 1
            while at < len(blocks) and bound[at] >= threshold:  # a block, two, four ..., the threshold rising between
                docs = np.concatenate([self.block_docs[self.block_ptr[b]:self.block_ptr[b + 1]]
                                       for b in blocks[at:at + stride][bound[at:at + stride] >= threshold]])
                at, stride = at + stride, 2 * stride
                docs = docs[~seen[docs]]
                seen[docs] = True
                self.scored += len(docs)
                score = self.vectors[docs][:, terms].astype(np.int64) @ weights
                high = score >= threshold
                top_score, top_doc = np.concatenate([top_score, score[high]]), np.concatenate([top_doc, docs[high]])
                if len(top_doc) >= k:
                    first = np.lexsort((self.by_id[top_doc], -top_score))[:k]
                    top_score, top_doc = top_score[first], top_doc[first]
                    threshold = max(threshold, int(top_score[-1]))
            self.skipped += max(0, len(blocks) - at)
        return list(zip(top_score.tolist(), top_doc.tolist(), strict=True))


def _local_best(index: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], width: int, k: int,
                floors: list[int]) -> DataFrame:
    """(query, doc_id, score): the best of each shard."""
    given = index.sparkSession.sparkContext.broadcast((queries, floors))  # one block of queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, floors = given.value
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.slice(i, 1).to_pylist()[0], width)
                found = [(q, shard.doc_ids[d], s) for q, (terms, weights) in enumerate(queries)
                         for s, d in shard.best(terms, weights, k, floors[q])]
                columns = zip(*found, strict=True) if found else ([], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()),
                                                                                 strict=True)], names=["query", "doc_id", "score"])

    return index.mapInArrow(run, "query int, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)  # limited before the shuffle


def search_block(docs: DataFrame, queries: list[list[bytes]], k: int = TOP, shard_docs: int = SHARD_DOCS,
                 block: int = BLOCK) -> DataFrame:
    """(query, rank, doc_id, score) for one block of queries, each a list of terms."""
    terms = sorted({t for q in queries for t in q})
    places = {t: i for i, t in enumerate(terms)}
    vectors = materialize(term_vectors(docs, terms), "term-vectors")
    corpus = corpus_of(vectors, len(terms))
    weights = corpus.weights()
    asked = []
    for q in queries:
        n = Counter(places[t] for t in q)
        at = np.array(sorted(n), dtype=np.int64)
        asked.append((at, np.array([n[i] for i in at.tolist()], dtype=np.int64) * weights[at]))
    index = build_index(vectors, corpus, shard_docs, block)
    probe = index.where(F.col("shard") % F.lit(PROBE << 32) == 0)
    floors = [0] * len(queries)
    for r in _ranked(_local_best(probe, asked, len(terms), k, floors), k).where(F.col("rank") == k).collect():  # a row per query
        floors[r["query"]] = r.score
    return _ranked(_local_best(index, asked, len(terms), k, floors), k).select("query", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, shard_docs: int = SHARD_DOCS, block: int = BLOCK) -> DataFrame:
    """The ``k`` best documents (doc_id, text) of every item (item_id, text): item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    asked = materialize(items.select("item_id", "text").distinct(), "queries")
    n_blocks = max(1, -(-asked.count() // QUERIES))
    out = []
    for b in range(n_blocks):
        part = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b)
        rows = part.select("item_id", F.col("text").cast("binary").alias("text")).collect()  # one block of queries
        rows = [r for r in rows if terms_of(r.text and bytes(r.text))]
        if not rows:
            continue
        found = search_block(docs, [terms_of(bytes(r.text)) for r in rows], k, shard_docs, block)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)],
                                      f"query int, item_id {items.schema['item_id'].dataType.simpleString()}")
        out.append(found.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"))  # one block of names
    if not out:
        kind = items.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.union, out)
