"""MERGE and DML as change-producing DataFrame operators.

Each operator returns a :class:`MergeResult`: the new table state and the
change rows (``insert`` / ``update_preimage`` / ``update_postimage`` /
``delete``) that a commit of this step appends to the change log.  Both are
lazy and come from one join, so Catalyst plans a single shuffle per side
(or a broadcast when AQE measures a side as small; nothing is forced).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources.changelog import CHANGE_TYPE, META_COLUMNS, VERSION, latest_per_key, type_rank

UPSERT_TYPES = ("insert", "update_postimage")


@dataclass
class MergeResult:
    table: DataFrame
    changes: DataFrame

    def counts(self) -> DataFrame:
        return merge_counts(self.changes)


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _join_cond(keys, left_prefix, right_prefix, null_safe: bool) -> Column:
    parts = []
    for k in keys:
        lc, rc = _q(left_prefix + k), _q(right_prefix + k)
        parts.append(lc.eqNullSafe(rc) if null_safe else lc == rc)
    return reduce(lambda a, b: a & b, parts)


def collapse_changes(changes: DataFrame, key, order: Sequence[str] = (VERSION,), null_safe: bool = False) -> DataFrame:
    """Keep the last change per key (preimages dropped).

    A batch may hold insert + update + delete of one key; MERGE needs one
    source row per target row.  Rows with a NULL key never match anything
    under ``=``, so they pass through untouched; under ``<=>`` NULL is one key
    and collapses like any other (so the join never pairs NULL rows).
    """
    keys = _keys(key)
    df = changes.where(F.col(CHANGE_TYPE) != "update_preimage")
    if null_safe:
        present = [c for c in order if c in df.columns]
        return latest_per_key(df, keys, F.struct(*[_q(c) for c in present], type_rank()))
    has_null = reduce(lambda a, b: a | b, [_q(k).isNull() for k in keys])
    present = [c for c in order if c in df.columns]
    ordering = F.struct(*[_q(c) for c in present], type_rank())
    last = latest_per_key(df.where(~has_null), keys, ordering)
    return last.unionByName(df.where(has_null))


def apply_changes(target: DataFrame, changes: DataFrame, key, columns: Sequence[str] | None = None,
                  upsert_types: Sequence[str] = UPSERT_TYPES, null_safe: bool = False,
                  collapse: bool = True) -> MergeResult:
    """Apply a change feed to a table the way the CDF merge sink does.

    matched + delete -> DELETE; matched + upsert type -> UPDATE; unmatched +
    upsert type -> INSERT; unmatched deletes and preimages are ignored.
    ``columns`` limits what is copied; other target columns keep their value
    on update and are NULL on insert.  Without ``columns`` every target column
    the source also has is copied, so feed metadata never lands in the target.
    """
    keys = _keys(key)
    tcols = target.columns
    # Only columns both sides have are copied: target-only columns keep their values.
    copy = [c for c in (columns if columns is not None else tcols) if c in tcols and c in changes.columns]
    src = collapse_changes(changes, keys, null_safe=null_safe) if collapse else changes
    src = src.where(F.col(CHANGE_TYPE).isin(*upsert_types, "delete"))
    s_cols = list(dict.fromkeys(keys + copy))
    s = src.select(*[_q(c).alias("__s_" + c) for c in s_cols],
                   F.col(CHANGE_TYPE).alias("__s_ct"), F.lit(True).alias("__s_here"))
    t = target.select(*[_q(c).alias("__t_" + c) for c in tcols], F.lit(True).alias("__t_here"))
    j = t.join(s, _join_cond(keys, "__t_", "__s_", null_safe), "full_outer")

    t_here = F.coalesce(F.col("__t_here"), F.lit(False))
    s_here = F.coalesce(F.col("__s_here"), F.lit(False))
    matched = t_here & s_here
    is_del = F.col("__s_ct") == "delete"
    is_up = F.col("__s_ct").isin(*upsert_types)
    ins = ~t_here & s_here & is_up

    def new_value(c: str) -> Column:
        tv = _q("__t_" + c)
        if c not in copy:
            return F.when(ins, F.lit(None).cast(target.schema[c].dataType)).otherwise(tv)
        sv = _q("__s_" + c)
        return F.when((matched & is_up) | ins, sv).otherwise(tv)

    new_row = [new_value(c).alias(c) for c in tcols]
    old_row = [_q("__t_" + c).alias(c) for c in tcols]
    keep = (t_here & ~(matched & is_del)) | ins
    table = j.where(keep).select(*new_row)

    pre = F.when(matched & (is_up | is_del),
                 F.struct(*old_row, F.when(is_del, "delete").otherwise("update_preimage").alias(CHANGE_TYPE)))
    post = F.when((matched & is_up) | ins,
                  F.struct(*new_row, F.when(matched, "update_postimage").otherwise("insert").alias(CHANGE_TYPE)))
    out = j.where(s_here).select(F.explode(F.filter(F.array(pre, post), lambda x: x.isNotNull())).alias("c"))
    return MergeResult(table, out.select("c.*"))


def content_hash(df: DataFrame, key: str, exclude: Sequence[str] = ()) -> Column:
    """sha256 of the JSON of (key, other columns sorted by name).

    ``to_json`` drops NULL fields, so a NULL value and an absent column hash alike.
    """
    skip = set(exclude) | {"_synced_at", key, "_content_hash", "_last_processed_at", "_last_updated_at"}
    others = sorted(c for c in df.columns if c not in skip)
    return F.sha2(F.to_json(F.struct(_q(key), *[_q(c) for c in others])), 256)


def upsert_by_hash(target: DataFrame | None, source: DataFrame, key: str, exclude: Sequence[str] = (),
                   as_of=None) -> MergeResult:
    """Additive content-hash upsert, nothing deleted.

    One source row per key (the one with the smallest hash, so reruns agree);
    keys compare null-safe; a changed hash replaces the row and both audit
    columns, an equal hash only refreshes ``_last_processed_at``; new keys are
    inserted; new source columns are added to the table.
    """
    from strata.functions.schema import void_to_string

    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    src = void_to_string(source)
    src = src.withColumn("_content_hash", content_hash(src, key, exclude))
    src = _one_per_key(src, key)
    src = src.withColumn("_last_processed_at", now).withColumn("_last_updated_at", now)
    if target is None:
        return MergeResult(src, src.withColumn(CHANGE_TYPE, F.lit("insert")))

    tcols = target.columns
    scols = src.columns
    all_cols = tcols + [c for c in scols if c not in tcols]
    s = src.select(*[_q(c).alias("__s_" + c) for c in scols], F.lit(True).alias("__s_here"))
    t = target.select(*[_q(c).alias("__t_" + c) for c in tcols], F.lit(True).alias("__t_here"))
    j = t.join(s, _q("__t_" + key).eqNullSafe(_q("__s_" + key)), "full_outer")
    t_here = F.coalesce(F.col("__t_here"), F.lit(False))
    s_here = F.coalesce(F.col("__s_here"), F.lit(False))
    matched = t_here & s_here
    changed = matched & ~_q("__t__content_hash").eqNullSafe(_q("__s__content_hash"))
    ins = ~t_here & s_here

    def typ(c):
        if c in tcols:
            return target.schema[c].dataType
        return src.schema[c].dataType

    def value(c: str) -> Column:
        tv = _q("__t_" + c) if c in tcols else F.lit(None).cast(typ(c))
        if c not in scols:
            return F.when(ins, F.lit(None).cast(typ(c))).otherwise(tv)
        sv = _q("__s_" + c)
        if c == "_last_processed_at":
            return F.when(s_here, sv).otherwise(tv)
        return F.when(changed | ins, sv.cast(typ(c))).otherwise(tv)

    new_row = [value(c).alias(c) for c in all_cols]
    old_row = [(_q("__t_" + c) if c in tcols else F.lit(None).cast(typ(c))).alias(c) for c in all_cols]
    table = j.select(*new_row)
    pre = F.when(matched, F.struct(*old_row, F.lit("update_preimage").alias(CHANGE_TYPE)))
    post = F.when(s_here, F.struct(*new_row, F.when(matched, "update_postimage")
                                   .otherwise("insert").alias(CHANGE_TYPE)))
    out = j.where(s_here).select(
        F.explode(F.filter(F.array(pre, post), lambda x: x.isNotNull())).alias("c")).select("c.*")
    return MergeResult(table, out)


def _one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest content hash wins (deterministic survivor)."""
    return dedupe_by_key(df, key, F.col("_content_hash"))


def dedupe_by_key(df: DataFrame, key, order: Column) -> DataFrame:
    """One row per key, the row with the smallest ``order`` (total order => deterministic)."""
    keys = _keys(key)
    return df.groupBy(*[_q(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.min_by(F.struct(*[_q(c) for c in df.columns]), order).alias("__r")).select("__r.*")


def merge_update(target: DataFrame, updates: DataFrame, key, columns: Sequence[str]) -> MergeResult:
    """Update-only merge; only ``columns`` are set, unmatched update rows dropped."""
    keys = _keys(key)
    # Duplicate keys: rows with more values win, then a content hash decides (total order).
    from pyspark.sql.types import MapType

    def hashable(c):  # maps cannot be hashed directly; their JSON text can
        return F.to_json(_q(c)) if isinstance(updates.schema[c].dataType, MapType) else _q(c)

    upd = dedupe_by_key(updates.select(*keys, *columns), keys,
                        F.struct(*[_q(c).isNull() for c in columns], F.xxhash64(*[hashable(c) for c in columns])))
    u = upd.select(*[_q(c).alias("__u_" + c) for c in keys + list(columns)], F.lit(True).alias("__u_here"))
    tcols = target.columns
    t = target.select(*[_q(c).alias("__t_" + c) for c in tcols])
    j = t.join(u, _join_cond(keys, "__t_", "__u_", False), "left")
    hit = F.coalesce(F.col("__u_here"), F.lit(False))
    new_row = [(F.when(hit, _q("__u_" + c)).otherwise(_q("__t_" + c)) if c in columns
                else _q("__t_" + c)).alias(c) for c in tcols]
    old_row = [_q("__t_" + c).alias(c) for c in tcols]
    table = j.select(*new_row)
    out = j.where(hit).select(F.explode(F.array(
        F.struct(*old_row, F.lit("update_preimage").alias(CHANGE_TYPE)),
        F.struct(*new_row, F.lit("update_postimage").alias(CHANGE_TYPE)))).alias("c")).select("c.*")
    return MergeResult(table, out)


def update_where(target: DataFrame, condition: Column, assignments: dict[str, Column]) -> MergeResult:
    """``UPDATE t SET ... WHERE ...``; a pre and a post image per hit row."""
    hit = F.coalesce(condition, F.lit(False))
    flagged = target.withColumn("__hit", hit)
    new_row = [(F.when(F.col("__hit"), assignments[c].cast(target.schema[c].dataType))
                .otherwise(_q(c)) if c in assignments else _q(c)).alias(c) for c in target.columns]
    old_row = [_q(c).alias(c) for c in target.columns]
    table = flagged.select(*new_row)
    out = flagged.where("__hit").select(F.explode(F.array(
        F.struct(*old_row, F.lit("update_preimage").alias(CHANGE_TYPE)),
        F.struct(*new_row, F.lit("update_postimage").alias(CHANGE_TYPE)))).alias("c")).select("c.*")
    return MergeResult(table, out)


def snapshot_diff(before: DataFrame, after: DataFrame, key) -> DataFrame:
    """Change rows that turn ``before`` into ``after`` (null-safe compare)."""
    keys = _keys(key)
    cols = [c for c in after.columns if c not in META_COLUMNS]
    b = before.select(*[_q(c).alias("__b_" + c) for c in cols], F.lit(True).alias("__b_here"))
    a = after.select(*[_q(c).alias("__a_" + c) for c in cols], F.lit(True).alias("__a_here"))
    j = b.join(a, _join_cond(keys, "__b_", "__a_", True), "full_outer")
    bh = F.coalesce(F.col("__b_here"), F.lit(False))
    ah = F.coalesce(F.col("__a_here"), F.lit(False))
    same = reduce(lambda x, y: x & y, [_q("__b_" + c).eqNullSafe(_q("__a_" + c)) for c in cols])
    changed = bh & ah & ~same
    old_row = [_q("__b_" + c).alias(c) for c in cols]
    new_row = [_q("__a_" + c).alias(c) for c in cols]
    pre = F.when(changed | (bh & ~ah), F.struct(*old_row, F.when(ah, "update_preimage")
                                                .otherwise("delete").alias(CHANGE_TYPE)))
    post = F.when(changed | (ah & ~bh), F.struct(*new_row, F.when(bh, "update_postimage")
                                                 .otherwise("insert").alias(CHANGE_TYPE)))
    return j.where(~(bh & ah & same)).select(
        F.explode(F.filter(F.array(pre, post), lambda x: x.isNotNull())).alias("c")).select("c.*")


def merge_counts(changes: DataFrame) -> DataFrame:
    """Inserted / updated / deleted rows of one merge, in one aggregate."""
    ct = F.col(CHANGE_TYPE)
    return changes.agg(
        F.sum(F.when(ct == "insert", 1).otherwise(0)).cast("bigint").alias("num_inserted_rows"),
        F.sum(F.when(ct == "update_postimage", 1).otherwise(0)).cast("bigint").alias("num_updated_rows"),
        F.sum(F.when(ct == "delete", 1).otherwise(0)).cast("bigint").alias("num_deleted_rows"),
    ).select(*[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in
               ("num_inserted_rows", "num_updated_rows", "num_deleted_rows")])
