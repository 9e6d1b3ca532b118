"""A ledger of recognition jobs: what was submitted for each batch, under which conditions, and when to ask again.

A job runs elsewhere, for minutes. The ledger is a log of rows by batch and identity (source and settings), each a version that
goes on from the one before; a batch's state is its last version. So a run that starts anew takes up the jobs that an earlier one
submitted, instead of submitting them again, unless their result is of no use (a page of it came out empty). Two runs that write
one version of a batch agree on one of them, by the name of the writer, and the other is dropped when it is read.

Nobody sleeps: a version says when its batch is due, later with each attempt, and a pass does what is due at a given time. The
provider is called in the executors, a partition of batches at a time; its transport is its own.

Cases: a batch without pages is never due; a failed job is submitted again until it had `most` attempts; jobs of another identity count
for nothing; times are seconds since the epoch, as a column, so that a pass can be repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.sources.writers import exists

KEYS = ["document_id", "batch_id", "identity"]
LEDGER = "document_id string, batch_id int, identity string, version int, status string, job_id string, attempts int, asked int, due double, error string, result string, writer string"
#: Statuses of a job that is under way, seconds to the first and the longest wait, attempts.
UNDER_WAY, FIRST_WAIT, LONGEST_WAIT, MOST_ATTEMPTS = ("submitted", "running"), 5.0, 300.0, 3


class JobProvider(Protocol):
    """Submits batches and asks for their jobs; serialisable, as it runs in the executors."""

    def submit(self, document_id: str, pdf_pages: list[int]) -> str: ...

    def ask(self, job_id: str) -> tuple[str, str | None]:
        """(running | done | failed, the result or the error)."""
        ...


def wait(times: Column, first: float = FIRST_WAIT, longest: float = LONGEST_WAIT) -> Column:
    """Seconds to wait after so many tries: twice as long each time, up to the longest."""
    return F.least(F.lit(longest), F.lit(first) * F.pow(F.lit(2.0), F.least(F.greatest(times - 1, F.lit(0)), F.lit(60))))


def latest(ledger: DataFrame) -> DataFrame:
    """The last version of each batch and identity; of several rows of one version the first writer's.

    A writer that lost a version reads the one that was kept before it writes its next."""
    one = Window.partitionBy(*KEYS, "version").orderBy("writer")
    kept = ledger.withColumn("_nth", F.row_number().over(one)).where("_nth = 1").drop("_nth")
    return kept.withColumn("_last", F.row_number().over(Window.partitionBy(*KEYS).orderBy(F.desc("version")))).where("_last = 1").drop("_last")


def actions(batches: DataFrame, ledger: DataFrame, now: Column, empty: DataFrame | None = None, most: int = MOST_ATTEMPTS) -> DataFrame:
    """batches (document_id, batch_id, identity, pdf_pages) with the state of their jobs and action: submit, ask, wait, done or failed.

    empty: document_id, pdf_page of pages that came out empty, whose batches are submitted again."""
    state = latest(ledger).drop("writer")
    out = batches.join(state, KEYS, "left")
    redo = F.lit(False)
    if empty is not None:
        bare = batches.select(*KEYS, F.explode("pdf_pages").alias("pdf_page")).join(empty.select("document_id", "pdf_page"), ["document_id", "pdf_page"], "left_semi").select(*KEYS).distinct().withColumn("_redo", F.lit(True))
        out = out.join(bare, KEYS, "left")
        redo = F.coalesce("_redo", F.lit(False))
    due, left = F.col("due") <= now, F.coalesce("attempts", F.lit(0)) < most
    action = (
        F.when(F.size("pdf_pages") <= 0, "done").when(F.col("status").isNull(), "submit").when(F.col("status").isin(*UNDER_WAY), F.when(due, "ask").otherwise("wait"))
        .when(F.col("status") == "done", F.when(redo & left, "submit").otherwise("done")).when(left, F.when(due, "submit").otherwise("wait")).otherwise("failed")
    )
    return out.withColumn("action", action).drop("_redo")


def perform(wanted: DataFrame, provider: JobProvider, now: float, writer: str) -> DataFrame:
    """The new versions (LEDGER) of the batches that are to be submitted or asked for. What a provider raises is the job's error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                version, attempts, asked = (0 if pd.isna(x) else int(x) for x in (r.version, r.attempts, r.asked))
                job, status, told = (None if r.job_id is None or pd.isna(r.job_id) else r.job_id), "failed", None
                if r.action == "submit":
                    attempts, asked, job = attempts + 1, 0, None
                try:
                    if r.action == "submit":
                        job, status = provider.submit(r.document_id, [int(p) for p in r.pdf_pages]), "submitted"
                    else:
                        asked, (status, told) = asked + 1, provider.ask(job)
                except Exception as error:  # noqa: BLE001  (the job fails, not the run)
                    told = f"{type(error).__name__}: {error}"
                rows.append((r.document_id, int(r.batch_id), r.identity, version + 1, status, job, attempts, asked, now, told if status == "failed" else None, told if status == "done" else None, writer))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in LEDGER.split(", ")])

    todo = wanted.where("action in ('submit', 'ask')").select(*KEYS, "pdf_pages", "version", "attempts", "asked", "job_id", "action")
    made = todo.mapInPandas(run, LEDGER)
    tries = F.when(F.col("status").isin(*UNDER_WAY), F.col("asked") + 1).otherwise(F.col("attempts"))
    return made.withColumn("due", F.col("due") + wait(tries))


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path) if exists(spark, path) else spark.createDataFrame([], LEDGER)


def run_pass(spark: SparkSession, batches: DataFrame, provider: JobProvider, path: str, now: float, writer: str, empty: DataFrame | None = None) -> dict[str, int]:
    """Does what is due at `now` and adds it to the ledger; the batches by what is left to do with them.

    The calls of a pass are added together: a run that breaks off within one has lost what that pass submitted, and no more."""
    wanted = actions(batches, read(spark, path), F.lit(now), empty)
    perform(wanted, provider, now, writer).write.mode("append").parquet(path)
    left = actions(batches, read(spark, path), F.lit(now)).groupBy("action").count().collect()  # five kinds at most
    return {r["action"]: r["count"] for r in left}
