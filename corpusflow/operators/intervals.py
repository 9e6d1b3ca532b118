"""Sets of row ranges: what several ranges cover together, and what they leave uncovered.

Ranges are half open, [start, end), and may overlap, touch, repeat or reach beyond the rows that there are; empty ones and those with
a null bound cover nothing. Each set is gone through once, in the order of its starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def covered(ranges: DataFrame, keys: list[str], start: str = "row_start", end: str = "row_end") -> DataFrame:
    """(keys, start, end) of the fewest ranges that cover the same rows; ranges that touch become one."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    held = ranges.where(F.col(start) < F.col(end)).select(*keys, start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col(start) > reach, F.lit(True))
    runs = held.withColumn("_opens", opens).withColumn("_run", F.sum(F.col("_opens").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*keys, "_run").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_run")


def uncovered(wholes: DataFrame, ranges: DataFrame, keys: list[str], first: str = "first", last: str = "last", start: str = "row_start", end: str = "row_end") -> DataFrame:
    """(keys, start, end) of the gaps: the rows of each whole, [first, last), in none of its ranges."""
    inside = wholes.select(*keys, F.col(first).alias("_first"), F.col(last).alias("_last"))
    clipped = covered(ranges, keys, start, end).join(inside, keys)
    clipped = clipped.select(*keys, F.greatest(start, "_first").alias(start), F.least(end, "_last").alias(end)).where(F.col(start) < F.col(end))
    # each range ends a gap before it; a range past the last row ends the last gap
    ends = clipped.union(inside.select(*keys, F.col("_last"), F.col("_last")))
    w = Window.partitionBy(*keys).orderBy(start, end)
    gaps = ends.join(inside, keys).withColumn("_from", F.coalesce(F.lag(end).over(w), F.col("_first")))
    return gaps.select(*keys, F.col("_from").alias(start), F.col(start).alias(end)).where(F.col(start) < F.col(end))
