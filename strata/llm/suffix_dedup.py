"""Removal of repeated passages with prefix-partitioned suffix trees.

A window is ``window`` consecutive words of one text.  Every word inside a window
whose words also start anywhere else, in the same text or another, is removed;
windows are judged on the input.

1. Sparse suffixes: of the 8-word prefixes inside a window the one with the least
   hash is its *anchor*.  Equal windows have equal anchors at equal places, so
   only anchors (about one word in 14) have to be compared across the corpus.
   The windows of one anchor are consecutive: they are a *run* of words.
2. Suffixes are partitioned by their 8-word prefix.  A prefix that occurs once is
   a leaf and goes; a prefix whose runs are all equal is a single edge of the
   tree, and all its windows are repeated.
3. For the other prefixes each distinct run is taken once, with its count.  Up to
   ``GROUP_RUNS`` distinct runs, one task builds the subtree of the prefix: its
   sorted suffixes with the lengths of their common prefixes.  Internal nodes of
   depth ``window`` or more are the maximal repeats.  A prefix with more runs is
   lengthened, step by step, to the whole window: a run's windows are halved and
   halved again, each part goes by the words that all its windows share, and only
   parts that may hold repeated and other windows are cut further.  Parts are
   compared by aggregates, so no group outgrows a task.
4. The verdicts go back to the documents, which cut out the covered words.

Null, empty and short texts lose nothing; repeated rows repeat each other's
windows and so lose theirs; rows without a ``doc_id`` count like others; an empty
table gives no rows; other columns are not read.  Words are told apart by 64-bit
hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.words import flat_word_hashes, ngram_hashes, slices, sums_from
from strata.session import materialize

WINDOW = 35
PREFIX = 8
GROUP_RUNS = 2000  # distinct runs of a prefix that one subtree may hold
SLICE_BYTES = 1 << 17  # of texts whose words are hashed at a time: arrays that fit the caches


def runs_of(hashes: np.ndarray, counts: np.ndarray, window: int = WINDOW, prefix: int = PREFIX) -> tuple[np.ndarray, ...]:
    """(text, prefix hash, run hash, first window, windows) of every run of the texts whose words stand in a row."""
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(text[:max(len(text) - window + 1, 0)] == text[window - 1:])  # windows within a text
    if not len(at):
        return tuple(np.empty(0, dtype=t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64))
    grams = ngram_hashes(hashes, prefix)
    span = window - prefix + 1
    best, width = np.arange(len(grams)), 1
    while width < span:  # least hash, leftmost, of wider and wider stretches
        step = min(width, span - width)
        left, right = best[:-step], best[step:]
        best = np.where(grams[left] <= grams[right], left, right)
        width += step
    anchor = best[at]
    begins = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    windows = np.diff(np.append(begins, len(at)))
    first, anchor = at[begins], anchor[begins]
    sums, scale = sums_from(hashes)
    whole = (sums[first + windows + window - 1] - sums[first]) * scale[first]
    whole ^= (windows.astype(np.uint64) << np.uint64(32)) + (anchor - first).astype(np.uint64)
    whole ^= whole >> np.uint64(31)
    whole *= np.uint64(0x94D049BB133111EB)
    owner = text[first]
    return owner, grams[anchor], whole, first - (np.cumsum(counts) - counts)[owner], windows


def deep_nodes(suffixes: list[bytes], depth: int, unit: int = 8) -> list[tuple[int, list[int]]]:
    """Internal nodes at ``depth`` words or more of the tree of ``suffixes``: (depth, suffixes below).

    The sorted suffixes with the lengths of their common prefixes are the tree: a node
    is a widest stretch of neighbours that share so many words.
    """
    order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    nodes, at = [], 0
    while at < len(order):
        end, shared = at + 1, None
        while end < len(order):
            common = _common(suffixes[order[end - 1]], suffixes[order[end]]) // unit
            if common < depth:
                break
            shared = common if shared is None else min(shared, common)
            end += 1
        if shared is not None:
            nodes.append((shared, order[at:end]))
        at = end
    return nodes


def _common(a: bytes, b: bytes) -> int:
    k = min(len(a), len(b))
    if a[:k] == b[:k]:
        return k
    differ = int.from_bytes(a[:k], "big") ^ int.from_bytes(b[:k], "big")
    return k - (differ.bit_length() + 7) // 8


def _rows(found: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*found, strict=True)) if found else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields, strict=True)],
                                      names=[f for f, _ in fields])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("raw"))


def _run_rows(docs: DataFrame, window: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "raw", SLICE_BYTES):
            owner, key, run, first, windows = runs_of(*flat_word_hashes(batch.column(2).to_pylist()), window)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), batch.column(1).take(pa.array(owner)),
                 pa.array(key.view(np.int64)), pa.array(run.view(np.int64)),
                 pa.array(first.astype(np.int32)), pa.array(windows.astype(np.int32))],
                names=["doc_id", "text_hash", "prefix", "run", "first", "windows"])

    rows = _texts(docs).filter("raw is not null").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(scan, "doc_id long, text_hash long, prefix long, run long, first int, windows int")


def _kept(words: list[bytes], spans: list[tuple[int, int]]) -> tuple[int, str, bytes]:
    """(removed words, hex digest and text of what is left)."""
    left, at = [], 0
    for a, b in sorted(spans):
        if a > at:
            left += words[at:a]
        at = max(at, b)
    if spans:
        left += words[at:]
    else:
        left = words
    text = b" ".join(left)
    return len(words) - len(left), hashlib.sha256(text).hexdigest(), text


_DONE = [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
         ("kept_sha256", pa.string()), ("raw", pa.binary()), ("spans", pa.list_(pa.int32())),
         ("open_runs", pa.list_(pa.struct([("prefix", pa.int64()), ("run", pa.int64()), ("first", pa.int32()),
                                           ("windows", pa.int32())]))), ("kept", pa.binary())]
_DONE_DDL = ("doc_id long, text_hash long, n_words long, n_removed long, kept_sha256 string, raw binary, "
             "spans array<int>, open_runs array<struct<prefix: long, run: long, first: int, windows: int>>, kept binary")


_RUN_FIELDS = [("prefix", pa.int64()), ("run", pa.int64()), ("first", pa.int32()), ("windows", pa.int32())]


def _listed(lists: pa.ListArray) -> tuple[np.ndarray, pa.StructArray]:
    """(row of each entry, entries) of a column of lists."""
    return pa.compute.list_parent_indices(lists).to_numpy(), lists.flatten()


def _numbers(entries: pa.StructArray, name: str) -> np.ndarray:
    return entries.field(name).to_numpy(zero_copy_only=False)


def _first_verdicts(docs: DataFrame, repeats: DataFrame, window: int, keep_text: bool) -> DataFrame:
    """Per document: the result where all its repeated runs are settled, else its text, settled spans and open runs."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "raw"):
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                row, runs = _listed(part.column(3))
                mixed, first = _numbers(runs, "mixed").astype(bool), _numbers(runs, "first")
                end = first + _numbers(runs, "windows") + window - 1
                settled = [[] for _ in range(part.num_rows)]
                for i, x, y in zip(row[~mixed].tolist(), first[~mixed].tolist(), end[~mixed].tolist(), strict=True):
                    settled[i].append((x, y))
                left = np.bincount(row[mixed], minlength=part.num_rows)
                rows = []
                for doc, text, raw, spans, open_runs in zip(*(c.to_pylist() for c in part.columns[:3]), settled, left.tolist(),
                                                            strict=True):
                    words = raw.split() if raw else []
                    if open_runs:
                        rows.append((doc, text, len(words), None, None, raw, [x for s in spans for x in s], None))
                    else:
                        removed, digest, kept = _kept(words, spans)
                        rows.append((doc, text, len(words), removed, digest, None, None, kept if keep_text else None))
                done = _rows(rows, [f for f in _DONE if f[0] != "open_runs"])
                of = pa.array(np.flatnonzero(mixed))
                open_runs = pa.StructArray.from_arrays([runs.field(f).take(of) for f, _ in _RUN_FIELDS],
                                                       names=[f for f, _ in _RUN_FIELDS])
                offsets = pa.array(np.concatenate([[0], np.cumsum(left)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, open_runs, mask=pa.array(left == 0))
                yield pa.RecordBatch.from_arrays([lists if f == "open_runs" else done.column(f) for f, _ in _DONE],
                                                 names=[f for f, _ in _DONE])

    found = repeats.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("prefix", "run", "first", "windows", "mixed")).alias("runs"))  # of one text, however often the row repeats
    found = found.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("of_text"), "runs")
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_text"))
    rows = _texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.join(found, same, "left").select("doc_id", "text_hash", "raw", "runs").mapInArrow(scan, _DONE_DDL)


def _open_run_words(waiting: DataFrame, window: int) -> DataFrame:
    """(prefix, run, words, n): the distinct open runs, as 8-byte word hashes, with their counts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "raw", SLICE_BYTES):
            hashes, counts = flat_word_hashes(batch.column(0).to_pylist())
            row, runs = _listed(batch.column(1))
            begin = (np.cumsum(counts) - counts)[row] + _numbers(runs, "first")
            ends = np.cumsum(_numbers(runs, "windows").astype(np.int64) + window - 1)
            sizes = np.diff(ends, prepend=0)
            picked = hashes[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + sizes, sizes)]
            words = pa.Array.from_buffers(pa.binary(), len(sizes), [
                None, pa.py_buffer(np.concatenate([[0], 8 * ends]).astype(np.int32)), pa.py_buffer(picked.astype(">u8"))])
            yield pa.RecordBatch.from_arrays([runs.field("prefix"), runs.field("run"), words], names=["prefix", "run", "words"])

    return (waiting.select("raw", "open_runs").mapInArrow(scan, "prefix long, run long, words binary")
            .groupBy("prefix", "run").agg(F.max("words").alias("words"), F.count(F.lit(1)).alias("n")))


def _subtrees(runs: DataFrame, window: int) -> DataFrame:
    """(prefix, run, words, n) by prefix -> (prefix, run, at): the windows below a node of depth ``window``."""

    def settle(prefix, members):
        suffixes, owner = [], []
        for k, (_, words, n) in enumerate(members):
            for t in range(len(words) // 8 - window + 1):
                suffixes.append(words[8 * t:8 * (t + window)])
                owner.append((k, t))
        hit: dict[int, list[int]] = {}
        for _, below in deep_nodes(suffixes, window):
            for x in below:
                hit.setdefault(owner[x][0], []).append(owner[x][1])
        for k, (run, words, n) in enumerate(members):
            if n > 1:
                yield prefix, run, list(range(len(words) // 8 - window + 1))
            elif k in hit:
                yield prefix, run, hit[k]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("prefix", pa.int64()), ("run", pa.int64()), ("at", pa.list_(pa.int32()))]
        now, members = None, []
        for batch in batches:
            found = []
            for prefix, run, words, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if prefix != now:
                    found += settle(now, members) if len(members) > 1 or (members and members[0][2] > 1) else []
                    now, members = prefix, []
                members.append((run, words, n))
            yield _rows(found, fields)
        if members:
            yield _rows(list(settle(now, members)), fields)

    return (runs.repartition("prefix").sortWithinPartitions("prefix", "run").select("prefix", "run", "words", "n")
            .mapInArrow(scan, "prefix long, run long, at array<int>"))


_PART_DDL = "prefix long, shared long, part long, run long, t int, before int, windows int, words binary, weight long"
_PART_FIELDS = [("prefix", pa.int64()), ("shared", pa.int64()), ("part", pa.int64()), ("run", pa.int64()), ("t", pa.int32()),
                ("before", pa.int32()), ("windows", pa.int32()), ("words", pa.binary()), ("weight", pa.int64())]


def _parts(rows: DataFrame, window: int, size: int) -> DataFrame:
    """Rows of consecutive windows of one anchor, cut where the number of words before the anchor is a multiple of ``size``.

    ``shared`` stands for the words that all windows of a part with so many words before
    the anchor share, ``part`` for the words and windows of the part itself.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for prefix, run, t, before, words, weight in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                last = before - (len(words) // 8 - window)  # words before the anchor in the last window
                top = before
                while top >= last:
                    low = max(top - top % size, last)
                    a, low_cell = before - top, top - top % size
                    shared = words[8 * (before - low_cell):8 * (before - low_cell - size + 1 + window)]
                    part = words[8 * a:8 * (before - low + window)]
                    found.append((prefix, _digest(shared, low_cell), _digest(part, top), run, None if t is None else t + a, top,
                                  top - low + 1, part, weight))
                    top = low - 1
            yield _rows(found, _PART_FIELDS)

    return rows.select("prefix", "run", "t", "before", "words", "weight").mapInArrow(scan, _PART_DDL)


def _digest(words: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(words, seed) - (1 << 63)


def _placed(runs: DataFrame, window: int) -> DataFrame:
    """Runs as rows of windows to settle, with the number of words before the anchor (the least prefix of a window)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            grams = [ngram_hashes(np.frombuffer(w, dtype=">u8", count=window).astype(np.uint64), PREFIX) for w in texts]
            before = pa.array([int(g.argmin()) for g in grams], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, before], names=["prefix", "run", "words", "weight", "before"])

    return (runs.select("prefix", "run", "words", F.col("n").alias("weight"))
            .mapInArrow(scan, "prefix long, run long, words binary, weight long, before int")
            .withColumn("t", F.lit(0)))


def _longer_prefixes(runs: DataFrame, window: int) -> DataFrame:
    """The same verdicts for prefixes with too many runs: the prefix is lengthened step by step, to the whole window.

    Windows are equal only where as many words stand before their anchors.  A part of a
    run that occurs again is settled with all its windows, one that shares its words with
    no other part is a leaf and goes; the others are cut into smaller parts.  A repeated
    part goes on once, without its run, so that others are compared with it.
    """
    key = ["prefix", "shared", "part"]
    settled = runs.where("n > 1").select("prefix", "run", F.lit(0).alias("t"),
                                         (F.length("words") / 8 - window + 1).cast("int").alias("windows"))
    rows = _placed(runs, window).withColumn("run", F.when(F.col("weight") == 1, F.col("run")))
    size = window - PREFIX + 1
    while size > 1:
        size = -(-size // 4)
        parts = materialize(_parts(rows, window, size), "run-parts")
        seen = materialize(parts.groupBy(*key).agg(F.sum("weight").alias("weight"), *[
            F.max(c).alias(c) for c in ("run", "t", "before", "words")]), "distinct-parts")
        again = seen.where("weight > 1").select(*[F.col(c).alias(f"of_{c}") for c in key])
        same = [F.col(c) == F.col(f"of_{c}") for c in key]
        settled = settled.union(parts.where("run is not null").join(again, same).select("prefix", "run", "t", "windows"))
        open_groups = seen.groupBy("prefix", "shared").agg(F.min("weight").alias("least"), F.sum("weight").alias("all")).where(
            "least = 1 and all > 1").select(F.col("prefix").alias("p"), F.col("shared").alias("s"))
        once = F.col("weight") == 1
        rows = seen.join(open_groups, (F.col("prefix") == F.col("p")) & (F.col("shared") == F.col("s")), "left_semi").select(
            "prefix", F.when(once, F.col("run")).alias("run"), F.when(once, F.col("t")).alias("t"), "before", "words", "weight")
    spans = settled.withColumn("at", F.sequence("t", F.col("t") + F.col("windows") - 1))
    return spans.groupBy("prefix", "run").agg(F.flatten(F.collect_list("at")).alias("at"))  # windows of one run


def remove_repeats(docs: DataFrame, window: int = WINDOW, group_runs: int = GROUP_RUNS,
                   keep_text: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 and, on demand, kept (what is left, as binary)."""
    prefixes = _run_rows(docs, window).groupBy("prefix").agg(
        F.count(F.lit(1)).alias("n"), F.min("run").alias("low"), F.max("run").alias("high")).filter("n > 1")
    prefixes = materialize(prefixes.select(F.col("prefix").alias("p"), (F.col("low") != F.col("high")).alias("mixed")),
                           "prefixes")
    repeats = _run_rows(docs, window).join(prefixes, F.col("prefix") == F.col("p")).drop("p")
    first = materialize(_first_verdicts(docs, repeats, window, keep_text), "first-verdicts")
    done = first.filter("raw is null")
    waiting = first.filter("raw is not null")

    runs = materialize(_open_run_words(waiting, window), "open-runs")
    large = materialize(runs.groupBy("prefix").count().filter(F.col("count") > group_runs)
                        .select(F.col("prefix").alias("p")), "large-prefixes")
    in_large = F.col("prefix") == F.col("p")
    verdicts = _subtrees(runs.join(large, in_large, "left_anti"), window)
    if not large.isEmpty():
        verdicts = verdicts.union(_longer_prefixes(runs.join(large, in_large, "left_semi"), window))
    verdicts = verdicts.select(F.col("prefix").alias("p"), F.col("run").alias("r"), "at")

    hits = waiting.select("doc_id", "text_hash", F.explode("open_runs").alias("o"))
    hits = hits.select("doc_id", "text_hash", "o.*").join(
        verdicts, (F.col("prefix") == F.col("p")) & (F.col("run") == F.col("r")))
    hits = hits.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first", "at")).alias("hits")).select(
        F.col("doc_id").alias("of"), F.col("text_hash").alias("of_text"), "hits")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [f for f in _DONE if f[0] in ("doc_id", "n_words", "n_removed", "kept_sha256", "kept")]
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                rows = []
                for doc, raw, spans, found in zip(*(c.to_pylist() for c in batch.slice(a, 500).columns), strict=True):
                    words = raw.split()
                    cut = list(zip(spans[::2], spans[1::2], strict=True))
                    cut += [(h["first"] + t, h["first"] + t + window) for h in found or [] for t in h["at"]]
                    removed, digest, kept = _kept(words, cut)
                    rows.append((doc, len(words), removed, digest, kept if keep_text else None))
                yield _rows(rows, fields)

    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_text"))
    rest = (waiting.join(hits, same, "left").select("doc_id", "raw", "spans", "hits")
            .mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary"))
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept"] if keep_text else [])]
    return done.select(*columns).union(rest.select(*columns))
