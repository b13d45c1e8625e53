"""Counter increases as an associative merge of segments, over tumbling windows and sliding ranges.

A *segment* is what a run of samples of one series tells: first and last value,
increase (a sample below its predecessor restarted from 0) and number of samples.
Joining two neighbours adds the step from the left one's last to the right one's
first value; the merge is associative, so a run may be cut anywhere.

Samples are dealt over slices of their whole order (series, then time), which
hold about the same number of rows whatever a series or an hour holds; each slice
gives a segment per series and step, and a step's segments are merged in the order
of the slices.  A range of several steps merges its steps' segments: bounded by
the steps of a range, not by the samples of a series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT = ("first", "last", "increase", "n")


def _step_up(previous: Column, value: Column) -> Column:
    """Increase from one sample to the next; a smaller value counts from 0."""
    return F.when(value >= previous, value - previous).otherwise(value)


def merged(parts: Column) -> Column:
    """Fold of an array of segments that is in the order of time."""
    def join(a: Column, b: Column) -> Column:
        up = a["increase"] + _step_up(a["last"], b["first"]) + b["increase"]
        return F.struct(a["first"].alias("first"), b["last"].alias("last"), up.alias("increase"), (a["n"] + b["n"]).alias("n"))

    return F.aggregate(F.slice(parts, 2, F.size(parts)), parts[0], join)


def segments(samples: DataFrame, series: Sequence[str], step: Column, order: Sequence[str] = ("ts",)) -> DataFrame:
    """(series..., step, seg): one segment per series and value of ``step``, which must rise with ``order``.

    Null values do not count.  ``order`` must tell the samples of a series apart.
    """
    x = samples.where(F.col("value").isNotNull()).select(
        *series, *order, F.col("value").cast("double").alias("value"), step.alias("step"))
    x = x.repartitionByRange(*series, *order).withColumn("slice", F.spark_partition_id())
    key = [*series, "step", "slice"]
    at = F.struct(*order)
    before = F.lag("value").over(Window.partitionBy(*key).orderBy(*order))  # no more rows than a slice has
    x = x.withColumn("up", F.when(before.isNull(), F.lit(0.0)).otherwise(_step_up(before, F.col("value"))))
    parts = x.groupBy(*key).agg(F.min_by("value", at).alias("first"), F.max_by("value", at).alias("last"),
                                F.sum("up").alias("increase"), F.count(F.lit(1)).alias("n"))
    # a step of a series has no more parts than there are slices
    parts = parts.groupBy(*series, "step").agg(F.array_sort(F.collect_list(F.struct("slice", F.struct(*SEGMENT).alias("seg")))).alias("p"))
    return parts.select(*series, "step", merged(F.transform("p", lambda p: p["seg"])).alias("seg"))


def step_number(ts: Column, step_seconds: int) -> Column:
    """Number of the step that ends at or after ``ts``: steps are open on the left, as ranges are."""
    us, width = F.unix_micros(ts.cast("timestamp")), step_seconds * 1_000_000
    rest = F.pmod(us, F.lit(width))
    return ((us - rest) / F.lit(width)).cast("long") + F.when(rest > 0, 1).otherwise(0)


def sliding_increase(samples: DataFrame, by: Sequence[str], series: Sequence[str], range_seconds: int, step_seconds: int,
                     order: Sequence[str] = ("ts",)) -> DataFrame:
    """``sum by (by) (increase(counter[range]))`` evaluated at every step: (by..., step_end, increase).

    A range covers the samples after ``step_end - range`` up to ``step_end``; a series counts
    where it has two samples or more.  Only steps between samples count (no
    extrapolation to the edges of the range).  Steps are multiples of
    ``step_seconds`` since the epoch, from a series' first sample on to the last
    range that holds one.
    """
    if range_seconds % step_seconds:
        raise ValueError("the range must be a whole number of steps")
    steps = range_seconds // step_seconds
    seg = segments(samples, series, step_number(F.col("ts"), step_seconds), order)
    seen = seg.select(*series, "step", "seg", F.explode(F.sequence(F.col("step"), F.col("step") + (steps - 1))).alias("step_end"))
    ranges = seen.groupBy(*series, "step_end").agg(F.array_sort(F.collect_list(F.struct("step", "seg"))).alias("p"))  # <= steps
    ranges = ranges.select(*series, "step_end", merged(F.transform("p", lambda p: p["seg"])).alias("seg")).where("seg.n >= 2")
    end = F.timestamp_seconds(F.col("step_end") * step_seconds).cast("timestamp_ntz")
    return ranges.groupBy(*by, "step_end").agg(F.sum("seg.increase").alias("increase")).withColumn("step_end", end)


def sliding_rate(samples: DataFrame, by: Sequence[str], series: Sequence[str], range_seconds: int, step_seconds: int,
                 order: Sequence[str] = ("ts",)) -> DataFrame:
    """``sum by (by) (rate(counter[range]))`` at every step: the increase per second of the range."""
    inc = sliding_increase(samples, by, series, range_seconds, step_seconds, order)
    return inc.select(*by, "step_end", (F.col("increase") / F.lit(float(range_seconds))).alias("rate"))
