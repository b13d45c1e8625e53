"""Reversible line dedup: exact reference counts of line keys, and sharded cuckoo filters of the repeated ones.

A text is split at ``\\n``; a line's key is the line without white space
(``[\\x20\\x09-\\x0D]``) at its ends and with A-Z lower-cased, told apart by its
MD5 digest.  The *count table* holds, for every key that some document has, the
number of documents that hold it.  A key with ``min_docs`` documents or more is
*repeated*; each shard of the key space has a cuckoo filter of its repeated keys.

``insert`` and ``delete`` add or subtract documents.  Only keys whose count
crosses ``min_docs`` touch their shard's filter, by one insertion or one
removal of a fingerprint, so deleting what was inserted restores counts and
membership.  Each call writes a new version of the state (a folder of the
shared store) and leaves the old one, so a failed or repeated job does no harm.

``clean`` tests the keys of each document against the filters (sent to the
tasks while they are below ``FILTER_BYTES``, else every key passes), asks the
count table about what passed, by an equi-join on the key, and drops the lines
whose key really is repeated.  The filters only spare lookups; the counts decide.

A state is sharded so that one filter serves about ``SHARD_KEYS`` repeated keys:
when there are more, all filters are built again over twice the shards (or
more), and a filter that cannot take a key is built again with twice the room.

Null or empty text: one empty line, which no rule drops.  A row is a document:
repeated rows and null ids count as often as they occur.  An empty table
changes nothing.  Deleting documents that were never inserted raises.  Other
columns may have any names; ``clean`` keeps them.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.words import ASCII_LOWER, slices
from strata.session import scratch_path

MIN_DOCS = 10
SHARD_KEYS = 1 << 16      # repeated keys a filter is made for
LEAST_SHARDS = 16
MOST_SHARDS = 1 << 16     # a shard is a range of the key's first 16 bits
SLOTS, KICKS, LOAD = 4, 500, 0.85
FILTER_BYTES = 32 << 20   # filters beyond this size are not sent to the tasks
BROADCAST_KEYS = 200_000  # repeated keys (16 bytes each) that a join may broadcast
SALTS = 32

BLANK = " \t\n\x0b\x0c\r"
_BLANK = BLANK.encode()
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FILTER_SCHEMA = "shard int, n_keys long, buckets int, payload binary"


# ------------------------------------------------------------ line keys

def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """16-byte key of a line, null for a blank one."""
    key = F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER)
    return F.when(F.length(key) >= 1, F.unhex(F.md5(key)))


def document_keys(text: bytes | None) -> set[bytes]:
    """The distinct lines of a text that are not blank, stripped and lower-cased (``line_key`` before its digest)."""
    return {k for line in (text or b"").split(b"\n") if (k := line.strip(_BLANK).translate(ASCII_LOWER))}


def _digests(keys: Iterable[bytes]) -> list[bytes]:
    return [hashlib.md5(k, usedforsecurity=False).digest() for k in keys]


def _counted(docs: DataFrame) -> DataFrame:
    """(key, n): documents per key, added up within a batch first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n = Counter()
            for text in batch.column(0).to_pylist():
                n.update(document_keys(text))
            yield pa.RecordBatch.from_arrays([pa.array(_digests(n), pa.binary()), pa.array(n.values(), pa.int64())],
                                             names=["key", "n"])

    counts = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "key binary, n long")
    return counts.groupBy("key").agg(F.sum("n").alias("n"))


def _head(key: Column) -> Column:
    return F.conv(F.hex(F.substring(key, 1, 2)), 16, 10).cast("int")


def _shard(key: Column, shards: int) -> Column:
    return F.shiftright(_head(key), 16 - (shards.bit_length() - 1))


# -------------------------------------------------------- cuckoo filters

def _numbers(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16-byte keys (n x 16 bytes) -> their first 16 bits and their last 64 bits."""
    head = keys[:, 0].astype(np.int64) << 8 | keys[:, 1]
    return head, np.ascontiguousarray(keys[:, 8:]).view("<u8").reshape(-1)


def _as_bytes(keys) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype=np.uint8).reshape(-1, 16)


def _fingerprint(low: np.ndarray) -> np.ndarray:
    return np.maximum(low & np.uint64(0xFFFF), np.uint64(1))


def _jump(fingerprint: np.ndarray) -> np.ndarray:
    """Distance (by exclusive or) between a fingerprint's two buckets."""
    return (fingerprint * np.uint64(0x9E3779B1)) >> np.uint64(7)


class CuckooFilter:
    """16-bit fingerprints in buckets of four; a key's second bucket follows from the first and its fingerprint."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, keys) / (SLOTS * LOAD)))))
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    @classmethod
    def of_bytes(cls, payload: bytes) -> CuckooFilter:
        return cls(np.frombuffer(payload, dtype="<u2").reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def _places(self, low: int) -> tuple[int, int, int]:
        f = max(low & 0xFFFF, 1)
        mask = len(self.table) - 1
        first = (low >> 16) & mask
        return f, first, first ^ (((f * 0x9E3779B1) >> 7) & mask)

    def insert(self, low: int) -> bool:
        """Add a key; False (and the filter is to be built again) if no room was found."""
        f, a, b = self._places(low)
        mask = len(self.table) - 1
        for at in (a, b):
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = f
                return True
        at = a
        for kick in range(KICKS):
            slot = (kick + f) % SLOTS
            f, self.table[at, slot] = int(self.table[at, slot]), f
            at ^= ((f * 0x9E3779B1) >> 7) & mask
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = f
                return True
        return False

    def remove(self, low: int) -> bool:
        f, a, b = self._places(low)
        for at in (a, b):
            held = np.flatnonzero(self.table[at] == f)
            if len(held):
                self.table[at, held[0]] = 0
                return True
        return False


class FilterBank:
    """All shards' filters in one table, tested for many keys at once."""

    def __init__(self, shards: int, rows: list):
        self.shift = 16 - (shards.bit_length() - 1)
        self.first = np.zeros(shards, dtype=np.int64)
        self.mask = np.zeros(shards, dtype=np.int64)  # shards without a filter share an empty bucket
        tables, at = [np.zeros((1, SLOTS), dtype=np.uint16)], 1
        for shard, payload in rows:
            t = np.frombuffer(payload, dtype="<u2").reshape(-1, SLOTS)
            self.first[shard], self.mask[shard] = at, len(t) - 1
            tables.append(t)
            at += len(t)
        self.table = np.concatenate(tables)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        head, low = _numbers(keys)
        shard = head >> self.shift
        first, mask = self.first[shard], self.mask[shard]
        f = _fingerprint(low)
        a = (low >> np.uint64(16)).astype(np.int64) & mask
        b = a ^ (_jump(f).astype(np.int64) & mask)
        f = f.astype(np.uint16)[:, None]
        return (self.table[first + a] == f).any(axis=1) | (self.table[first + b] == f).any(axis=1)


def _filled(lows: np.ndarray) -> CuckooFilter:
    room = len(lows)
    while True:
        made = CuckooFilter.sized(room)
        if all(made.insert(x) for x in lows.tolist()):
            return made
        room = 2 * max(room, len(made.table) * SLOTS)


def _filter_row(shard: int, n: int, made: CuckooFilter | None) -> pd.DataFrame:
    return pd.DataFrame({"shard": [shard], "n_keys": [n], "buckets": [len(made.table) if made else 0],
                         "payload": [made.to_bytes() if made else None]})


def _build(keys: DataFrame) -> DataFrame:
    """(shard, key) -> a filter per shard."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        lows = _numbers(_as_bytes(pdf["key"]))[1]
        return _filter_row(int(pdf["shard"].iloc[0]), len(lows), _filled(lows))

    return keys.select("shard", "key").groupBy("shard").applyInPandas(build, FILTER_SCHEMA)


def _change(filters: DataFrame, crossed: DataFrame) -> DataFrame:
    """Filters after the crossings (shard, key, up); a filter that is too full has no payload."""
    def change(key, old: pd.DataFrame, crossing: pd.DataFrame) -> pd.DataFrame:
        shard = int(key[0])
        n = int(old["n_keys"].iloc[0]) if len(old) else 0
        if not len(crossing):
            return old
        up = crossing["up"].to_numpy(dtype=bool)
        lows = _numbers(_as_bytes(crossing["key"]))[1]
        made = CuckooFilter.of_bytes(old["payload"].iloc[0]) if len(old) else CuckooFilter.sized(int(up.sum()))
        for low in lows[~up].tolist():
            if not made.remove(low):
                raise ValueError(f"shard {shard}: a repeated key is not in its filter")
        n += int(up.sum()) - int((~up).sum())
        fits = n <= LOAD * made.table.size and all(made.insert(x) for x in lows[up].tolist())
        return _filter_row(shard, n, made if fits else None)

    return filters.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(change, FILTER_SCHEMA)


# ------------------------------------------------------------- the state

@dataclass(frozen=True)
class LineState:
    """One version: ``counts`` (key, n_docs, n_before) and ``filters`` under ``path`` (none: the empty state)."""

    path: str | None
    min_docs: int
    shards: int
    repeated: int      # repeated keys
    filter_bytes: int

    def counts(self, spark: SparkSession) -> DataFrame:
        """(key, n_docs) of every key that a document has."""
        if self.path is None:
            return spark.createDataFrame([], "key binary, n_docs long")
        return spark.read.parquet(f"{self.path}/counts").where("n_docs > 0").select("key", "n_docs")

    def filters(self, spark: SparkSession) -> DataFrame:
        if self.path is None:
            return spark.createDataFrame([], FILTER_SCHEMA)
        return spark.read.parquet(f"{self.path}/filters")


def empty_state(min_docs: int = MIN_DOCS) -> LineState:
    return LineState(None, min_docs, LEAST_SHARDS, 0, 0)


def insert(state: LineState, docs: DataFrame, path: str | None = None) -> LineState:
    """The state with the documents' lines counted in."""
    return _update(state, docs, 1, path)


def delete(state: LineState, docs: DataFrame, path: str | None = None) -> LineState:
    """The state with the documents (their texts as inserted) taken out."""
    return _update(state, docs, -1, path)


def _update(state: LineState, docs: DataFrame, sign: int, path: str | None) -> LineState:
    spark = docs.sparkSession
    path = path or scratch_path(spark, "line-state")
    delta = _counted(docs).select("key", (F.col("n") * F.lit(sign)).alias("n"))
    if state.path is None:
        counts = delta.select("key", F.col("n").alias("n_docs"), F.lit(0).cast("long").alias("n_before"))
    else:
        both = (state.counts(spark).select("key", F.col("n_docs").alias("n"), F.col("n_docs").alias("was"))
                .union(delta.select("key", "n", F.lit(0).cast("long"))))
        counts = both.groupBy("key").agg(F.sum("n").alias("n_docs"), F.sum("was").alias("n_before"))
    counts.write.mode("errorifexists").parquet(f"{path}/counts")
    counts = spark.read.parquet(f"{path}/counts")
    now, before = F.col("n_docs") >= state.min_docs, F.col("n_before") >= state.min_docs
    least, repeated = counts.agg(F.min("n_docs"), F.count_if(now)).first()  # one row
    if (least or 0) < 0:
        raise ValueError("documents to delete that were never inserted")

    shards = state.shards
    while shards < MOST_SHARDS and repeated > shards * SHARD_KEYS:
        shards *= 2
    held = counts.where(now).select(_shard(F.col("key"), shards).alias("shard"), "key")
    if state.path is None or shards != state.shards:
        filters = _build(held)
    else:
        crossed = counts.where(now != before).select(_shard(F.col("key"), shards).alias("shard"), "key", now.alias("up"))
        filters = _change(state.filters(spark), crossed)
    filters.write.mode("errorifexists").parquet(f"{path}/changed")
    filters = spark.read.parquet(f"{path}/changed")
    full = filters.where("payload IS NULL").select("shard")
    again = _build(held.join(full, "shard", "left_semi"))
    filters.where("payload IS NOT NULL").union(again).write.mode("errorifexists").parquet(f"{path}/filters")
    size = spark.read.parquet(f"{path}/filters").agg(F.sum(F.octet_length("payload"))).first()[0]  # one row
    return LineState(path, state.min_docs, shards, repeated, size or 0)


# ---------------------------------------------------------------- cleaning

def _asked(state: LineState, docs: DataFrame) -> DataFrame:
    """(bucket, key): the keys of each document that may be repeated, by the filters."""
    spark = docs.sparkSession
    bank = None
    if state.filter_bytes <= FILTER_BYTES:
        rows = [(r.shard, bytes(r.payload)) for r in state.filters(spark).select("shard", "payload").collect()]  # <= FILTER_BYTES
        bank = spark.sparkContext.broadcast(FilterBank(state.shards, rows))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys, sizes = [], []
            for text in batch.column(1).to_pylist():
                own = _digests(document_keys(text))
                keys += own
                sizes.append(len(own))
            hit = bank.value.contains(_as_bytes(keys)) if bank else np.ones(len(keys), dtype=bool)
            bucket = np.repeat(batch.column(0).to_numpy(), sizes)[hit]
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(keys, pa.binary()).filter(pa.array(hit))],
                                             names=["bucket", "key"])

    rows = docs.select(_bucket().alias("bucket"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(test, "bucket long, key binary")


def _repeated_keys(state: LineState, docs: DataFrame) -> DataFrame:
    """(bucket, hits): the repeated keys of the documents of a bucket (a hash of id and text)."""
    spark = docs.sparkSession
    asked = _asked(state, docs)
    known = state.counts(spark).where(F.col("n_docs") >= state.min_docs).select("key")
    if state.repeated <= BROADCAST_KEYS:
        met = asked.join(F.broadcast(known), "key")
    else:  # a key that a third of the documents hold is dealt over the salts
        salted = known.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
        met = asked.withColumn("salt", F.pmod("bucket", F.lit(SALTS))).join(salted, ["key", "salt"])
    return met.groupBy("bucket").agg(F.collect_set("key").alias("hits"))  # no more than the lines of one text


def _bucket() -> Column:
    """Documents of one bucket share their answers: a repeated key is one for all of them, whoever asked."""
    return F.xxhash64("doc_id", "text")


def _cleaned(state: LineState, docs: DataFrame) -> DataFrame:
    """(row, lines, kept): the input row, its lines, and the lines that stay."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _bucket().alias("bucket"))
    met = rows.join(_repeated_keys(state, docs), "bucket", "left")
    lines = lines_of(F.col("row.text"))
    stays = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col("hits"), line_key(x)), F.lit(False)))
    return met.select("row", lines.alias("lines"), F.when(F.col("hits").isNull(), lines).otherwise(stays).alias("kept"))


def clean(state: LineState, docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated lines gone from ``text`` (null text becomes empty)."""
    out = _cleaned(state, docs)
    return out.select(*[F.array_join("kept", "\n").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c)
                        for c in docs.columns])


def line_report(state: LineState, docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped and the cleaned text."""
    n, kept = F.size("lines").cast("long"), F.size("kept").cast("long")
    return _cleaned(state, docs.select("doc_id", "text")).select(
        F.col("row.doc_id").alias("doc_id"), n.alias("n_lines"), (n - kept).alias("n_dropped"),
        F.array_join("kept", "\n").alias("text"))
