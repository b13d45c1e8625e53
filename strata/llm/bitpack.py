"""Token ids in fixed-width bit packing, written as block files and read back.

File format: a Parquet folder with one row per block.  A block holds the ids of
whole documents in order, each id in the least number of bits that the
vocabulary needs (least significant bit first, without gaps): ``shard`` (file
order), ``block`` (order in the shard), ``start`` (ids of the shard before the
block), ``n_ids``, ``width``, ``payload``, and for its documents ``doc_ids``,
``offsets`` (first id within the block) and ``lengths``.  ``width`` and the
offsets make the bit position of any id known, so a block or a single document
is unpacked by numpy without reading what precedes it.

Null text counts as empty (just the end id), a null ``doc_id`` sorts first,
repeated ids stay in the order of their texts, an empty table writes no block.
Other columns of the input are not read.  A very long text is one large block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm import words
from strata.llm.encoder import encoder

BLOCK_IDS = 1 << 16  # a block is closed once it holds so many ids
SLICE_BYTES = 1 << 20  # of texts that are encoded at a time
BLOCK_SCHEMA = ("shard int, block int, start long, n_ids long, width int, payload binary, "
                "doc_ids array<long>, offsets array<long>, lengths array<long>")
BLOCK_FIELDS = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
                          ("width", pa.int32()), ("payload", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
                          ("offsets", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))])


def bit_width(vocabulary: int) -> int:
    """Bits of the largest id of a vocabulary of that size."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def unpack(payload: bytes, width: int, count: int, first: int = 0) -> np.ndarray:
    """``count`` ids from id number ``first`` on."""
    if count <= 0:
        return np.empty(0, dtype="<u4")
    if width in (8, 16, 32):
        return np.frombuffer(payload, dtype=f"<u{width // 8}", count=count, offset=first * width // 8).astype("<u4")
    low, high = first * width // 8, -(-(first + count) * width // 8)
    bits = np.unpackbits(np.frombuffer(payload[low:high], dtype=np.uint8), bitorder="little")
    bits = bits[first * width - low * 8:][:count * width].reshape(count, width)
    wide = np.zeros((count, 32), dtype=np.uint8)
    wide[:, :width] = bits
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1)


def write_packed(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2,
                 order: Sequence[str] = ("doc_id",), block_ids: int = BLOCK_IDS) -> None:
    """Encode ``docs`` (doc_id, text and the columns ``order``) and write block files in ascending ``order``."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.forget()  # what an earlier stage's tasks left in this worker
        enc = encoder(tokenizer_path)
        width = bit_width(max(enc.size, end_id + 1))
        shard = TaskContext.get().partitionId()
        held, ids, at, block, start = [], [], 0, 0, 0

        def close():
            lengths = [len(x) for x in held]
            offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]]).tolist()
            return pa.RecordBatch.from_arrays([
                pa.array([v], type=f.type) for f, v in zip(BLOCK_FIELDS, (
                    shard, block, start, at, width, pack(np.concatenate(held), width), ids, offsets, lengths),
                    strict=True)], schema=BLOCK_FIELDS)

        try:
            for batch in words.slices(batches, "text", SLICE_BYTES):
                coded = enc.encode_many([text or "" for text in batch.column(1).to_pylist()])
                for key, found in zip(batch.column(0).to_pylist(), coded, strict=True):
                    held.append(np.append(found, np.uint32(end_id)))
                    ids.append(key)
                    at += len(held[-1])
                    if at >= block_ids:
                        yield close()
                        start, block = start + at, block + 1
                        held, ids, at = [], [], 0
            if held:
                yield close()
        finally:
            enc.forget()

    keys = [f"packing_order_{i}" for i in range(len(order))]
    rows = docs.select("doc_id", "text", *[F.col(c).alias(k) for c, k in zip(order, keys, strict=True)])
    (rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "doc_id", "text")
         .select("doc_id", "text").mapInArrow(blocks, BLOCK_SCHEMA)
         .write.mode("errorifexists").option("compression", "uncompressed").parquet(path))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32 (all decoded from the payload)."""
    files = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    # one row per file: the prefix sums over files are small
    bases = shards.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("base"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"], row["width"], row["n_ids"])
                crcs = [zlib.crc32(ids[o:o + n].tobytes()) for o, n in zip(row["offsets"], row["lengths"], strict=True)]
                n = len(crcs)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["shard"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                    pa.array([row["start"] + o for o in row["offsets"]], pa.int64()),
                    pa.array(row["lengths"], pa.int64()), pa.array(crcs, pa.int64())],
                    names=["shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    decoded = files.mapInArrow(check, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return (decoded.join(bases, "shard")
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def document_ids(spark: SparkSession, path: str, doc_id: int) -> list[int]:
    """Random access: the ids of one document, from its own block only."""
    row = (spark.read.schema(BLOCK_SCHEMA).parquet(path).filter(F.array_contains("doc_ids", doc_id))
           .select("payload", "width", "doc_ids", "offsets", "lengths").first())
    if row is None:
        return []
    k = row.doc_ids.index(doc_id)
    return unpack(row.payload, row.width, row.lengths[k], row.offsets[k]).tolist()
