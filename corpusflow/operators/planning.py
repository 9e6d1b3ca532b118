"""Plans of pages, their batches, and what a checkpoint leaves to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def plan_pages(claims: DataFrame, document: str, page: str, section: str | None = None) -> DataFrame:
    """Each page once, with the sorted set of sections that claim it."""
    if section is None:
        return claims.select(document, page).distinct()
    return claims.groupBy(document, page).agg(F.sort_array(F.collect_set(section)).alias("candidate_sections"))


def plan_batches(pages: DataFrame, document: str, page: str, most: int = 1, start: str | None = None) -> DataFrame:
    """pages with island and batch_id: a batch ends with its document, at a gap, before a section start, or when full."""
    w = Window.partitionBy(document).orderBy(page)
    opens = F.coalesce(F.col(page) - F.lag(page).over(w) != 1, F.lit(True))
    if start:
        opens = opens | F.col(start)
    out = pages.withColumn("_open", opens.cast("int")).withColumn("island", F.sum("_open").over(w))
    inside = Window.partitionBy(document, "island").orderBy(page)
    return out.withColumn("slice", F.floor((F.row_number().over(inside) - 1) / most).cast("int")).drop("_open")


def batch_table(batched: DataFrame, document: str, page: str) -> DataFrame:
    """One row per batch: document, batch_id (within the document, from 1), pdf_pages."""
    per = batched.groupBy(document, "island", "slice").agg(F.sort_array(F.collect_list(page)).alias("pdf_pages"))
    w = Window.partitionBy(document).orderBy("island", "slice")
    return per.select(document, F.row_number().over(w).alias("batch_id"), "pdf_pages")


def limit_plan(batched: DataFrame, order: list[str], most: int | None = None, keys: DataFrame | None = None, on: list[str] | None = None) -> DataFrame:
    """The plan's pages among `keys`, the first `most` in order; batch ids stay as they were."""
    if keys is not None:
        batched = batched.join(keys.select(*on).distinct(), on, "left_semi")
    return batched.orderBy(*order).limit(most) if most is not None else batched.orderBy(*order)


def same_identity(left: dict[str, Column], right: dict[str, Column]) -> Column:
    """All identity columns equal, nulls like values."""
    out = F.lit(True)
    for name, column in left.items():
        out = out & column.eqNullSafe(right[name])
    return out


def pending(plan: DataFrame, state: DataFrame, keys: list[str], identity: list[str], status: str | None = None, done: tuple[str, ...] = ("done",)) -> DataFrame:
    """Plan rows without a checkpoint row of their key and whole identity."""
    if status:
        state = state.where(F.col(status).isin(*done))
    s = state.select(*[F.col(c).alias(f"_{c}") for c in [*keys, *identity]])
    match = F.lit(True)
    for k in keys:
        match = match & (plan[k] == s[f"_{k}"])
    for c in identity:
        match = match & plan[c].eqNullSafe(s[f"_{c}"])
    return plan.join(s, match, "left_anti")


def single_identity(plan: DataFrame, state: DataFrame, keys: list[str], identity: list[str]) -> DataFrame:
    """One row: the identity that all planned pages share, or nulls when pages are missing or identities differ."""
    met = plan.select(*keys).join(state.select(*keys, F.struct(*identity).alias("identity")), keys, "left")
    one = (F.count(F.when(F.col("identity").isNull(), 1)) == 0) & (F.count_distinct("identity") == 1)
    return met.agg(F.when(one, F.first("identity")).alias("identity"))


def coverage_status(failed_now: Column, has_result: Column) -> Column:
    """failed only for a failure of the current source, else completed where there is a result, else missing."""
    return F.when(failed_now, "failed").when(has_result, "completed").otherwise("missing")


def coverage(pages: DataFrame, group: list[str], status: str = "status") -> DataFrame:
    """Counts by status for each group and in total (null group)."""
    count = lambda s: F.count(F.when(F.col(status) == s, 1)).alias(s)
    return pages.rollup(*group).agg(F.count("*").alias("pages"), count("completed"), count("failed"), count("missing"))


def latest_state(log: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """The last row of each key in an append-only log."""
    return log.groupBy(*keys).agg(F.max(F.struct(*order, *values)).alias("_last")).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in [*order, *values]])


def fingerprint(*columns: str) -> Column:
    """Identity of a stage's input: a digest of the named columns as JSON; leave out times and transport settings."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
