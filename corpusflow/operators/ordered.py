"""Ordered scans as windows: fills, islands, chains, first occurrences, spaced and stratified samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def owned_by_anchor(rows: DataFrame, partition: list[str], order: list[str], anchor: Column, value: Column) -> DataFrame:
    """rows with owner: the value at the nearest anchor at or before the row; null before the first."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("owner", F.last(F.when(anchor, value), ignorenulls=True).over(w))


def islands(rows: DataFrame, partition: list[str], order: list[str], key: Column, name: str = "island") -> DataFrame:
    """rows with the number of their run of equal keys."""
    w = Window.partitionBy(*partition).orderBy(*order)
    out = rows.withColumn("_key", key)
    changed = ~F.col("_key").eqNullSafe(F.lag("_key").over(w)) | (F.row_number().over(w) == 1)
    out = out.withColumn("_changed", changed.cast("int"))
    return out.withColumn(name, F.sum("_changed").over(w)).drop("_key", "_changed")


def chains(rows: DataFrame, partition: list[str], order: list[str], link: str, source: str, name: str = "chain") -> DataFrame:
    """rows with the number of their chain: a row whose link is the source of the row before continues its chain."""
    w = Window.partitionBy(*partition).orderBy(*order)
    opens = (~F.coalesce(F.col(link) == F.lag(source).over(w), F.lit(False))).cast("int")
    return rows.withColumn("_open", opens).withColumn(name, F.sum("_open").over(w)).drop("_open")


def keep_first(rows: DataFrame, partition: list[str], order: list[str], signature: Column) -> DataFrame:
    """Rows whose signature is new in the partition; rows of a blank signature all stay."""
    out = rows.withColumn("_sig", signature)
    first = F.row_number().over(Window.partitionBy(*partition, "_sig").orderBy(*order))
    return out.withColumn("_nth", first).where("_nth = 1 or _sig = ''").drop("_sig", "_nth")


def absorbing_state(rows: DataFrame, partition: list[str], order: list[str], label: Column, absorbing: tuple[str, ...]) -> DataFrame:
    """rows with state: the last label seen, where once an absorbing label is met only absorbing ones count."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumn("_label", label)
    held = F.last(F.when(F.col("_label").isin(*absorbing), F.col("_label")), ignorenulls=True).over(w)
    return out.withColumn("state", F.coalesce(held, F.last("_label", ignorenulls=True).over(w))).drop("_label")


def first_occurrence(rows: DataFrame, partition: list[str], order: list[str], key: Column) -> DataFrame:
    """Distinct values in the order of their first appearance."""
    return keep_first(rows.withColumn("_blank", F.lit(1)), partition, order, F.concat(F.lit("="), key)).drop("_blank")


def even_indices(n: Column, k: int) -> Column:
    """Places (from 0) of k evenly spaced entries of n, halves rounded up: all if k <= 0 or n <= k, the first if k = 1."""
    if k == 1:
        spaced = F.array(F.lit(0))
    else:
        spaced = F.transform(F.sequence(F.lit(0), F.lit(max(k, 2) - 1)), lambda i: F.floor(i * (n - 1) / (max(k, 2) - 1) + 0.5).cast("int"))
    return F.when((F.lit(k) <= 0) | (n <= k), F.sequence(F.lit(0), n - 1)).otherwise(F.array_distinct(spaced))


def even_sample(rows: DataFrame, partition: list[str], order: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*partition)
    out = rows.withColumns({"_at": F.row_number().over(w.orderBy(*order)) - 1, "_n": F.count("*").over(w)})
    return out.where(F.array_contains(even_indices(F.col("_n").cast("int"), k), F.col("_at"))).drop("_at", "_n")


def seeded_order(seed: int, namespace: Column, key: Column) -> Column:
    """A hash that orders candidates alike on every engine."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), namespace, key).cast("binary"), 256)


def stratified_sample(rows: DataFrame, strata: list[str], key: Column, target: Column, seed: int) -> DataFrame:
    """The first `target` rows of each stratum in seeded order."""
    out = rows.withColumn("_order", seeded_order(seed, F.concat_ws(":", *strata), key))
    w = Window.partitionBy(*strata).orderBy("_order")
    return out.withColumn("pick", F.row_number().over(w)).where(F.col("pick") <= target).drop("_order")


def review_places(rows: DataFrame, partition: list[str], order: str, classes: str, most: int = 24, start: Column | None = None, issue: Column | None = None) -> DataFrame:
    """Places to review: the first three, the last, the first two of each class, those with an issue, and quartiles, `most` at most.

    Quartiles are of the section starts, the first and last start among them, where starts are given, else of all places."""
    w = Window.partitionBy(*partition).orderBy(order)
    whole = Window.partitionBy(*partition)
    two = F.col(classes).isNotNull() & (F.row_number().over(Window.partitionBy(*partition, classes).orderBy(order)) <= 2)
    out = rows.withColumns({"_at": F.row_number().over(w), "_n": F.count("*").over(whole), "_two": two, "_issue": F.coalesce(issue, F.lit(False)) if issue is not None else F.lit(False)})
    n, at = F.col("_n"), F.col("_at")
    quartile = (at == F.floor(n / 4) + 1) | (at == F.floor(n / 2) + 1) | (at == F.floor(3 * n / 4) + 1)
    if start is not None:
        out = out.withColumn("_start", F.coalesce(start, F.lit(False)).cast("int"))
        out = out.withColumns({"_k": F.sum("_start").over(w) - 1, "_m": F.sum("_start").over(whole)})
        m, k = F.col("_m"), F.col("_k")
        quartile = (F.col("_start") == 1) & ((k == 0) | (k == m - 1) | (k == F.floor(m / 4)) | (k == F.floor(m / 2)) | (k == F.floor(3 * m / 4)))
    out = out.where((at <= 3) | (at == n) | quartile | F.col("_two") | F.col("_issue")).drop("_start", "_k", "_m")
    return out.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= most).drop("_at", "_n", "_two", "_issue", "_k")
