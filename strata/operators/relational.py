"""Filters, joins and aggregates the jobs and dashboards use."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strata.sources.changelog import CHANGE_TYPE, CHANGE_TYPES


def change_type_filter(df: DataFrame, types: Sequence[str]) -> DataFrame:
    """Keep the listed change types; a list that is empty or names others is refused up front."""
    wanted = set(types)
    if not wanted or not wanted.issubset(CHANGE_TYPES):
        raise ValueError(f"change types must be some of {', '.join(CHANGE_TYPES)}; got {sorted(wanted)}")
    return df.where(F.col(CHANGE_TYPE).isin(sorted(wanted)))


def required_predicate(df: DataFrame, columns: Sequence[str]) -> Column:
    """Every column non-null; string columns must also hold more than spaces."""
    if not columns:
        raise ValueError("required columns: none given")
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"required columns not in the table: {missing}")
    filled = [F.length(F.trim(F.col(f"`{c}`"))) > 0 if c in text else F.col(f"`{c}`").isNotNull() for c in columns]
    return F.coalesce(reduce(Column.__and__, filled), F.lit(False))


def required_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Deletes always pass; other change rows need every required column."""
    return df.where((F.col(CHANGE_TYPE) == "delete") | required_predicate(df, columns))


def anti_join_known(items: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Items whose key is not in ``known`` (a join, never a driver-side set)."""
    return items.join(known.select(key).distinct(), key, "left_anti")


def semi_join(items: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Items whose key appears in ``keys``."""
    return items.join(keys.select(key), key, "left_semi")


def most_common(df: DataFrame, group: Sequence[str], value: str, position: str) -> DataFrame:
    """Per group the most frequent value; a tie goes to the value seen first.

    Counting is a partial aggregate on (group, value); the pick is a second
    aggregate on the counted pairs, so no group is ever sorted whole.
    """
    counted = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("first"))
    return counted.groupBy(*group).agg(
        F.max_by(F.col(value), F.struct(F.col("n"), -F.col("first"))).alias(value),
        F.max("n").alias("count"))


def numbered(df: DataFrame, *order) -> DataFrame:
    """``df`` with __slice and __place: rows range-partitioned and sorted by ``order``, numbered within each slice.

    Written once, so the numbers are fixed.  No key and no group meets in one
    task: a slice is a range of the whole order.
    """
    from strata.session import materialize

    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "__id", F.monotonically_increasing_id())  # the number of the partition, and of the row in it
    ranged = ranged.withColumn("__slice", F.shiftright("__id", 33)).withColumn(
        "__place", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
    return materialize(ranged.drop("__id"), "numbered")


def top_rows(df: DataFrame, order: Sequence[str], n: int | None) -> DataFrame:
    """The first ``n`` rows by the columns ``order`` (ascending, nulls first); 0/None means no limit.

    Only the order columns are numbered and written: the counts of the slices give
    the n-th row's place, and its key is the bound that ``df`` is filtered by, so
    the wide rows are neither sorted nor written.  Rows that equal the bound are
    taken up to ``n``.
    """
    if not n:
        return df
    keys = [f"__o{i}" for i in range(len(order))]
    ranked = numbered(df.select(*[F.col(c).alias(k) for c, k in zip(order, keys, strict=True)]), *keys)
    sizes = ranked.groupBy("__slice").agg(F.count(F.lit(1)).alias("__n"))  # one row per slice
    before = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__slice", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), "__n")
    holder = starts.where((F.col("__before") < n) & (F.col("__before") + F.col("__n") >= n)).first()
    if holder is None:  # no more than n rows
        return df
    first = (ranked.where(F.col("__slice") == holder["__slice"])
             .where(F.col("__place") == n - 1 - holder["__before"]).select(*keys).first())  # the n-th key

    def compared(columns: Sequence[str]) -> tuple[Column, Column]:
        less, same = F.lit(False), F.lit(True)
        for c, k in zip(columns, keys, strict=True):
            value = F.lit(first[k]).cast(ranked.schema[k].dataType)
            below = F.lit(False) if first[k] is None else F.col(f"`{c}`").isNull() | (F.col(f"`{c}`") < value)
            less, same = less | (same & F.coalesce(below, F.lit(False))), same & F.col(f"`{c}`").eqNullSafe(value)
        return less, same

    rest = n - ranked.where(compared(keys)[0]).count()
    less, same = compared(order)
    return df.where(less).unionByName(df.where(same).limit(rest))


def position_within(df: DataFrame, group: Sequence[str], order: str, name: str = "pos",
                    tiebreak: Sequence[str] = ()) -> DataFrame:
    """0-based position of each row inside its group, ordered by ``order``, and the group's row count.

    Skew-safe ``row_number``: rows are numbered inside slices of the whole
    (group, order) range, and a small aggregate per (group, slice) gives what
    precedes; a group holding a third of the table spreads over many slices,
    whatever its values of ``order`` are.
    """
    ranked = numbered(df, *group, order, *tiebreak)
    parts = ranked.groupBy(*group, "__slice").agg(F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))) \
        .withColumn("__total", F.sum("__n").over(Window.partitionBy(*group)))
    mine = parts.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("__slice").alias("__s"),
                        "__first", "__before", "__total")
    same = reduce(Column.__and__, [ranked[g].eqNullSafe(mine[f"__g{i}"]) for i, g in enumerate(group)],
                  ranked["__slice"] == mine["__s"])
    return ranked.join(mine, same).select(
        *[ranked[c] for c in df.columns], (F.col("__before") + F.col("__place") - F.col("__first")).alias(name),
        F.col("__total").alias(f"{name}_count"))
