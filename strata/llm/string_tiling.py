"""Benchmark decontamination by greedy string tiling.

1. Seeds: every run of ``min_match`` words of a benchmark item.  A bitmap of fixed
   size over the seed hashes goes to the executors; document windows that pass
   it are joined with the seeds, which gives pairs (document, item) that share
   runs.  A pair stays if the shared item positions can reach the threshold.
2. Each pair is tiled: running Karp-Rabin hashes find the matches, the longest
   match of words that are not yet marked becomes a tile, its words are marked
   on both sides, and so on until no match of ``min_match`` words is left.
3. Coverage is the share of the item's words in tiles.  Tiles may lie anywhere,
   so reordered passages count; a document is contaminated by an item from
   ``threshold`` on.

Words are lower-cased (A-Z) and cut at white space and ASCII punctuation.  Items
with fewer words than ``min_match`` are one seed.  Null or empty texts and items
match nothing; rows without a ``doc_id`` or ``item_id`` count with null there;
repeated rows give one pair.  Empty tables give no rows; other columns are not
read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.words import ASCII_LOWER, ngram_hashes, word_hashes
from strata.session import materialize

MIN_MATCH = 5
THRESHOLD_PERCENT = 50
BITMAP_BITS = 22  # the bitmap of seeds has 2**BITMAP_BITS bits, however large the benchmark is
_PUNCTUATION = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
_NORMAL = bytes(c if c not in _PUNCTUATION else 32 for c in ASCII_LOWER)


def tokens(raw: bytes | None) -> np.ndarray:
    return word_hashes(raw.translate(_NORMAL).split()) if raw else np.empty(0, dtype=np.uint64)


def _runs(words: np.ndarray, min_match: int) -> np.ndarray:
    """Hashes of the word runs that serve as seeds."""
    return ngram_hashes(words, min(min_match, len(words))) if len(words) else words


def tile(item: np.ndarray, doc: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in item, start in doc, length), longest match first, no word twice.

    Matches are found from the hashed runs of ``min_match`` words and extended to
    both sides; a match that a longer tile has cut into goes back as the parts
    left over.  Ties go to the earliest in the item, then in the document.
    """
    k = min(min_match, len(item))
    if k == 0 or len(doc) < k:
        return []
    at: dict[int, list[int]] = {}
    for i, h in enumerate(ngram_hashes(item, k).tolist()):
        at.setdefault(h, []).append(i)
    runs = ngram_hashes(doc, k)
    hits = np.flatnonzero(np.isin(runs, np.fromiter(at, dtype=np.uint64, count=len(at)))).tolist()
    lengths: dict[tuple[int, int], int] = {}
    for j in reversed(hits):  # a match that goes on one word later is one longer
        for i in at[int(runs[j])]:
            lengths[(i, j)] = lengths.get((i + 1, j + 1), k - 1) + 1
    heap = [(-n, i, j) for (i, j), n in lengths.items() if (i - 1, j - 1) not in lengths]
    heapq.heapify(heap)
    used_item, used_doc = np.zeros(len(item), dtype=bool), np.zeros(len(doc), dtype=bool)
    tiles = []
    while heap:
        n, i, j = heapq.heappop(heap)
        n = -n
        taken = used_item[i:i + n] | used_doc[j:j + n]
        if not taken.any():
            used_item[i:i + n] = True
            used_doc[j:j + n] = True
            tiles.append((i, j, n))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]]).astype(np.int8)))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= k:
                heapq.heappush(heap, (-(b - a), i + a, j + a))
    return tiles


def _item_seeds(items: DataFrame, min_match: int) -> DataFrame:
    """(seed, size of the run, item_id, item_words, place)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                w = tokens(raw)
                rows += [(s, min(min_match, len(w)), item, len(w), p)
                         for p, s in enumerate(_runs(w, min_match).view(np.int64).tolist())]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             names=["seed", "size", "item_id", "item_words", "place"])

    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("binary")).distinct()
    return rows.mapInArrow(scan, "seed long, size int, item_id long, item_words int, place int")


def _bitmap(seeds: DataFrame, bits: int) -> np.ndarray:
    """A bitmap with the bit of every seed set: its size does not follow the benchmark's."""
    shift = 64 - bits
    places = seeds.select(F.expr(f"shiftrightunsigned(seed, {shift})").alias("bit")) \
        .groupBy(F.expr("bit div 4096").cast("int").alias("chunk")) \
        .agg(F.collect_set(F.expr("cast(bit % 4096 as smallint)")).alias("bits"))  # at most 4096 per chunk
    out = np.zeros(1 << bits, dtype=bool)
    for row in places.toLocalIterator():
        out[row.chunk * 4096 + np.array(row.bits, dtype=np.int64)] = True
    return np.packbits(out, bitorder="little")


def _candidates(docs: DataFrame, bitmap, sizes: list[int], bits: int, min_match: int) -> DataFrame:
    """(doc_id, text_hash, raw, seeds) of the documents with a window that passes the bitmap."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bitmap.value
        shift = np.uint64(64 - bits)
        for batch in batches:
            keep, found = [], []
            for i, raw in enumerate(batch.column(2).to_pylist()):
                w = tokens(raw)
                hits = [np.empty(0, dtype=np.uint64)]
                for size in sizes:
                    runs = ngram_hashes(w, size)
                    bit = (runs >> shift).astype(np.int64)
                    hits.append(runs[(table[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1])
                hits = np.unique(np.concatenate(hits))
                if len(hits):
                    keep.append(i)
                    found.append(hits.view(np.int64).tolist())
            rows = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found, pa.list_(pa.int64()))],
                                             names=["doc_id", "text_hash", "raw", "seeds"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), F.col("text").cast("binary"))
    return rows.mapInArrow(scan, "doc_id long, text_hash long, raw binary, seeds array<long>")


def contaminated(docs: DataFrame, items: DataFrame, min_match: int = MIN_MATCH,
                 threshold_percent: int = THRESHOLD_PERCENT, bits: int = BITMAP_BITS) -> DataFrame:
    """Per contaminated (document, item): doc_id, text_hash, item_id, item_words, covered_words, n_tiles, longest_tile."""
    spark = docs.sparkSession
    seeds = materialize(_item_seeds(items, min_match), "seeds")
    sizes = sorted(r.size for r in seeds.select("size").distinct().collect())  # min_match values at most
    bitmap = spark.sparkContext.broadcast(_bitmap(seeds, bits))  # of fixed size
    found = materialize(_candidates(docs, bitmap, sizes, bits, min_match), "candidates")

    hits = found.select("doc_id", "text_hash", F.explode("seeds").alias("seed"))
    shared = hits.join(seeds, "seed").groupBy("doc_id", "text_hash", "item_id", "item_words").agg(
        F.count(F.lit(1)).alias("places"), F.min("size").alias("size"))
    # a tile of n words holds n - size + 1 places of seeds, so c covered words need at least c / size of them
    enough = 100 * F.col("places") * F.col("size") >= threshold_percent * F.col("item_words")
    pairs = materialize(shared.filter(enough).select("doc_id", "text_hash", "item_id"), "tiling-pairs")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, item, raw, passage in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = tokens(passage)
                tiles = tile(words, tokens(raw), min_match)
                covered = sum(n for _, _, n in tiles)
                if tiles and 100 * covered >= threshold_percent * len(words):
                    rows.append((doc, text, item, len(words), covered, len(tiles), tiles[0][2]))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             names=["doc_id", "text_hash", "item_id", "item_words", "covered_words",
                                                    "n_tiles", "longest_tile"])

    texts = found.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "raw").dropDuplicates(["d", "h"])
    passages = items.select(F.col("item_id").cast("long").alias("p"), F.col("text").cast("binary").alias("passage"))
    return (pairs.join(texts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")))
            .join(passages.distinct(), F.col("item_id").eqNullSafe(F.col("p")))
            .select("doc_id", "text_hash", "item_id", "raw", "passage")
            .mapInArrow(scan, "doc_id long, text_hash long, item_id long, item_words long, covered_words long, "
                              "n_tiles long, longest_tile long"))


def leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per contaminated document and item (once): doc_id, item_id, item_words, covered_words, n_tiles, longest_tile."""
    best = F.max(F.struct("covered_words", "item_words", "longest_tile", "n_tiles")).alias("b")
    return (contaminated(docs, items, **options).groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", "b.item_words", "b.covered_words", "b.n_tiles", "b.longest_tile"))


def drop_contaminated(docs: DataFrame, items: DataFrame, min_match: int = MIN_MATCH, **options) -> DataFrame:
    """The rows of ``docs`` (all columns) that no benchmark item of ``min_match`` words or more contaminates.

    Shorter items are reported by ``leaks``, but a word or two that anyone may write remove no document.
    """
    found = contaminated(docs, items, min_match, **options).filter(F.col("item_words") >= min_match)
    bad = materialize(found.select("doc_id", "text_hash").distinct(), "contaminated")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # one struct, so its columns may have any names
    rows = docs.select(row.alias("row"), F.xxhash64("text").alias("hash"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(bad["doc_id"]) & (F.col("hash") == bad["text_hash"])
    return rows.join(bad, same, "left_anti").select("row.*")
