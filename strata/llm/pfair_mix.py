"""Mixing sources to target weights by Pfair scheduling.

Each source's rows are numbered and cut into blocks.  The target is a fluid in
which every source that still has rows gets its exact weight's share of each slot
and, when one has run out, the others share its part.  A block's release time is
the slot in which the fluid begins it, its deadline the one in which the fluid
ends it; in every slot the released block with the earliest deadline goes out.  So
after any number of slots, run-outs included, each source has had its target to
within less than one block.  No row is dropped or repeated.

The driver sees one count per source, however many there are, and schedules the
blocks (8 bytes a block, and the jobs of ``CHUNK`` slots and one of each source at
a time); rows are numbered and placed by the executors.

Within a source the order is by a hash bucket of the row, then doc_id.  Rows
without a source are a source of their own; sources without a given weight get
the default one.  Rows with equal keys get neighbouring places, empty tables an
empty result; texts are passed on unread, other columns too.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.session import materialize

BLOCK_ROWS = 32
CHUNK = 200_000        # slots whose blocks are scheduled together
TEMPERATURE = 0.5      # default target weight of a source: its row count to this power
ROWS_PER_BUCKET = 20_000


def exact_slots(blocks: np.ndarray, weights: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Slots of all blocks, source after source: sources of ``blocks`` (1 at least) by unrounded ``weights``."""
    n, total = len(blocks), int(blocks.sum())
    weights = np.maximum(weights, 1e-9 * weights.max() if weights.max() > 0 else 1.0)  # of weight 0: after the others
    first = np.cumsum(blocks) - blocks
    ends = blocks / weights  # on the fluid's clock, a source gets its weight a unit until its end
    order = np.argsort(ends, kind="stable")
    clock = np.concatenate([[0.0], ends[order]])
    gone = np.concatenate([[0], np.cumsum(blocks[order])])
    rate = np.concatenate([np.cumsum(weights[order][::-1])[::-1], [0.0]])

    def fluid(time: np.ndarray) -> np.ndarray:
        k = np.searchsorted(clock[1:], time, side="right")
        return gone[k] + time * rate[k]

    slots = np.empty(total, dtype=np.int64)
    at, made, ready, t = fluid(clock), np.zeros(n, dtype=np.int64), [], 0
    while t < total:
        end = min(total, t + chunk)
        until = np.ceil(np.interp(end, at, clock) * weights).astype(np.int64)
        upto = blocks if end == total else np.clip(until, made, blocks)  # blocks that the fluid begins before the end
        count = upto - made
        s = np.repeat(np.arange(n), count)
        i = np.arange(len(s)) - np.repeat(np.cumsum(count) - count - made, count)
        begun, ended = fluid(i / weights[s]), fluid((i + 1) / weights[s])
        release = np.floor(begun + 1e-9 + 1e-13 * begun).astype(np.int64)  # whole numbers despite their last bits
        due = np.ceil(ended - 1e-9 - 1e-13 * ended).astype(np.int64)
        by = np.lexsort((first[s] + i, release))
        jobs = list(zip(release[by].tolist(), due[by].tolist(), (first[s] + i)[by].tolist(), strict=True))
        made, k = upto, 0
        while t < end:
            while k < len(jobs) and (jobs[k][0] <= t or not ready):
                heapq.heappush(ready, jobs[k][1:])
                k += 1
            slots[heapq.heappop(ready)[1]] = t
            t += 1
        for job in jobs[k:]:
            heapq.heappush(ready, job[1:])
    return slots


def _free_names(columns: list[str], names: list[str]) -> list[str]:
    """``names``, with underscores behind those that a table has already."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def _placed(docs: DataFrame, source: str, weights: Mapping | None, block_rows: int) -> tuple[DataFrame, str]:
    """``docs`` with one more column, a struct of block, slot and position, and that column's name."""
    origin, bucket, s, b, start, number, placed = _free_names(
        docs.columns, ["mix_source", "mix_bucket", "mix_s", "mix_b", "mix_start", "mix_number", "mix_place"])
    given = docs.withColumn(origin, F.col(f"`{source}`").cast("string"))
    counts = {r[0]: r[1] for r in given.groupBy(origin).count().collect()}
    names = sorted(counts, key=lambda name: (name is not None, name or ""))
    place_of = {name: k for k, name in enumerate(names)}
    rows_of = np.array([counts[name] for name in names], dtype=np.int64)
    blocks = -(-rows_of // block_rows)
    target = np.array([float((weights or {}).get(name, counts[name] ** TEMPERATURE)) for name in names])
    slots = exact_slots(blocks, target) if names else np.empty(0, dtype=np.int64)
    last = slots[np.cumsum(blocks) - 1]
    by = np.argsort(last)
    missing = np.concatenate([[0], np.cumsum((blocks * block_rows - rows_of)[by])]).astype(np.int64)
    plan = docs.sparkSession.sparkContext.broadcast((place_of, np.cumsum(blocks) - blocks, slots, last[by], missing))

    buckets = max(1, sum(counts.values()) // ROWS_PER_BUCKET)
    rows = given.withColumn(bucket, F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)))
    sizes = materialize(rows.groupBy(origin, bucket).agg(F.count(F.lit(1)).alias("rows")), "mix-sizes")
    before = Window.partitionBy(origin).orderBy(bucket)  # as many rows as buckets
    starts = sizes.select(F.col(origin).alias(s), F.col(bucket).alias(b), (F.sum("rows").over(before) - F.col("rows")).alias(start))
    inside = Window.partitionBy(origin, bucket).orderBy("doc_id", F.xxhash64("text"))
    ranked = rows.withColumn(number, F.row_number().over(inside) - 1)
    ranked = ranked.join(starts, F.col(origin).eqNullSafe(F.col(s)) & (F.col(bucket) == F.col(b)))

    def place(ranks: pd.Series, names: pd.Series) -> pd.DataFrame:
        known, first, slots, short_at, gaps = plan.value
        value = ranks.to_numpy(dtype=np.int64)
        codes, uniques = pd.factorize(names, use_na_sentinel=False)
        own = np.array([known[None if pd.isna(name) else name] for name in uniques], dtype=np.int64)
        slot = slots[first[own[codes]] + value // block_rows]
        position = slot * block_rows + value % block_rows - gaps[np.searchsorted(short_at, slot)]
        return pd.DataFrame({"block": value // block_rows, "slot": slot, "position": position})

    places = F.pandas_udf(place, "block long, slot long, position long")
    ranked = ranked.withColumn(placed, places(F.col(start) + F.col(number), F.col(origin)))
    return ranked.select(*[F.col(f"`{c}`") for c in docs.columns], placed), placed


def mixed(docs: DataFrame, source: str = "source", weights: Mapping | None = None,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with mix_block (number in its source), mix_slot and mix_position (0, 1, ... over all rows).

    Columns of these names that the input has already are replaced.
    """
    new = {"mix_block": "block", "mix_slot": "slot", "mix_position": "position"}
    rows, place = _placed(docs, source, weights, block_rows)
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new],
                       *[F.col(place)[field].alias(name) for name, field in new.items()])


def in_mixed_order(docs: DataFrame, source: str = "source", weights: Mapping | None = None,
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows of ``docs`` (its columns only), in files and rows by mixed position."""
    rows, place = _placed(docs, source, weights, block_rows)
    position = F.col(place)["position"]
    return rows.repartitionByRange(position).sortWithinPartitions(position).drop(place)
