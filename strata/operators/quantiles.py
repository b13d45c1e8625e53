"""Exact quantiles of all groups at once, by narrowing each group's value range.

A sketch per group (partial aggregates) gives two values around the wanted rank.
One more pass counts exactly what lies below the lower one and gathers the
values between them with their counts; where the counts show that the wanted
ranks are not between them, the group is taken again with a wider range, at last
the whole one.  The few values left are ranked over slices of their order, so
neither a group nor a value ever has to fit into one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.relational import numbered
from strata.session import materialize

ACCURACY = 10_000             # of the sketch: its ranks are off by one in so many rows at most
MARGINS = (1 / 2000, 1 / 50)  # part of the rows on either side; then the whole range


def _met(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``a`` joined with ``b`` on ``keys``, nulls alike; the keys once."""
    other = b.select(*[F.col(c).alias(f"r_{c}" if c in keys else c) for c in b.columns])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in keys], F.lit(True))
    return a.join(other, same, how).drop(*[f"r_{k}" for k in keys])


def _between(rows: DataFrame, keys: Sequence[str], q: float, margin: float | None) -> DataFrame:
    """Per group: its values in the range with their counts (``c``), and one row without value for all below."""
    if margin is None:
        bounds = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumns({"low": F.lit(float("-inf")), "high": F.lit(float("inf"))})
    else:
        around = F.percentile_approx("v", [max(q - margin, 0.0), min(q + margin, 1.0)], ACCURACY)
        bounds = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), around.alias("b")).select(
            *keys, "n", F.col("b")[0].alias("low"), F.col("b")[1].alias("high"))
    met = _met(rows, bounds, keys).where(F.col("v") <= F.col("high")).select(*keys, "n", F.when(F.col("v") >= F.col("low"), F.col("v")).alias("v"))
    return met.groupBy(*keys, "n", "v").agg(F.count(F.lit(1)).alias("c"))


def exact_quantile(samples: DataFrame, q: float, by: Sequence[str], value: str = "value") -> DataFrame:
    """(by..., n, quantile): the ``q`` quantile of each group, linear between the two nearest values.

    Null and NaN values do not count; a group without others has no row.
    """
    if not 0 <= q <= 1:
        raise ValueError(f"quantile {q} is not between 0 and 1")
    keys = [f"k{i}" for i in range(len(by))]
    todo = samples.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(
        *[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(value).cast("double").alias("v"))
    position = F.lit(q) * (F.col("n") - 1)
    first, last = F.floor(position), F.ceil(position)
    settled = []
    for margin in (*MARGINS, None):
        counted = materialize(_between(todo, keys, q, margin), "quantile-range")
        below = F.sum(F.when(F.col("v").isNull(), F.col("c")).otherwise(0))
        state = counted.groupBy(*keys, "n").agg(below.alias("below"), F.sum("c").alias("upto"))
        right = (F.col("below") <= first) & (F.col("upto") > last)
        state = materialize(state.withColumn("right", right), "quantile-state")  # a row per group
        fine = state.where("right")
        settled.append(_met(counted.where(F.col("v").isNotNull()), fine.select(*keys, "below"), keys).select(
            *keys, "n", "v", "c", "below"))
        again = state.where(~F.col("right")).select(*keys)
        if again.isEmpty():
            break
        todo = _met(todo, again, keys, "left_semi")
    ranked = numbered(reduce(DataFrame.union, settled), *keys, "v")
    sums = ranked.groupBy(*keys, "__slice").agg(F.sum("c").alias("s"))
    order = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)  # a row per slice
    sums = sums.select(*keys, "__slice", F.coalesce(F.sum("s").over(order), F.lit(0)).alias("before"))
    within = Window.partitionBy(*keys, "__slice").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("here", F.coalesce(F.sum("c").over(within), F.lit(0)))
    met = _met(ranked, sums, [*keys, "__slice"]).select(
        *keys, "n", "v", "c", (F.col("below") + F.col("before") + F.col("here")).alias("start"))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("start") <= rank) & (rank < F.col("start") + F.col("c")), F.col("v")))

    out = met.groupBy(*keys, "n").agg(at(first).alias("low"), at(last).alias("high"))
    answer = F.col("low") + (F.col("high") - F.col("low")) * (position - first)
    return out.select(*[F.col(k).alias(c) for c, k in zip(by, keys, strict=True)], "n", answer.alias("quantile"))
