"""The ledger of recognition jobs, with a provider that keeps its jobs in files and breaks where it is told to."""

import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusflow.plans import ledger

BATCHES = "document_id string, batch_id int, identity string, pdf_pages array<int>"


class Files:
    """Jobs as files: running when first asked, then done. fails: pages whose jobs fail so many times."""

    def __init__(self, folder, fails=None, refuses=()):
        self.folder, self.fails, self.refuses = str(folder), dict(fails or {}), set(refuses)

    def put(self, job, *what):
        """Written beside its place and moved there, as other tasks read it."""
        beside = Path(self.folder, f".{uuid.uuid4().hex}")
        beside.write_text(json.dumps(what))
        beside.rename(Path(self.folder, job))

    def submit(self, document_id, pdf_pages):
        if pdf_pages[0] in self.refuses:
            raise ConnectionError("no answer")
        job = uuid.uuid4().hex
        self.put(job, document_id, pdf_pages, 0)
        return job

    def jobs(self):
        return [json.loads(p.read_text()) for p in Path(self.folder).iterdir() if not p.name.startswith(".")]

    def ask(self, job_id):
        document_id, pages, asked = json.loads(Path(self.folder, job_id).read_text())
        self.put(job_id, document_id, pages, asked + 1)
        before = sum(p == pages for _, p, _ in self.jobs())
        if before <= self.fails.get(pages[0], 0):
            return "failed", "bad page"
        return ("done", f"result of {pages}") if asked else ("running", None)


@pytest.fixture
def batches(spark):
    return spark.createDataFrame([("d", b, "i1", [2 * b, 2 * b + 1]) for b in range(1, 5)] + [("d", 9, "i1", [])], BATCHES)


def test_a_later_run_takes_up_the_jobs_of_an_earlier_one(spark, batches, tmp_path):
    (tmp_path / "jobs").mkdir()
    provider, path = Files(tmp_path / "jobs"), str(tmp_path / "ledger")
    assert ledger.run_pass(spark, batches, provider, path, 0.0, "a") == {"wait": 4, "done": 1}
    assert ledger.run_pass(spark, batches, provider, path, 1.0, "b") == {"wait": 4, "done": 1}  # nothing is due, nor submitted again
    assert ledger.run_pass(spark, batches, provider, path, 6.0, "b") == {"wait": 4, "done": 1} and len(provider.jobs()) == 4
    assert ledger.run_pass(spark, batches, provider, path, 16.0, "c") == {"done": 5} and len(provider.jobs()) == 4
    held = ledger.latest(ledger.read(spark, path)).orderBy("batch_id").collect()
    assert [(r["status"], r["version"], r["attempts"], r["asked"], r["result"]) for r in held] == [("done", 3, 1, 2, f"result of {[2 * b, 2 * b + 1]}") for b in range(1, 5)]
    # other settings are other jobs, and a page that came out empty has its batch submitted again
    other = batches.withColumn("identity", F.lit("i2")).where("batch_id = 1")
    assert ledger.run_pass(spark, other, provider, path, 17.0, "c") == {"wait": 1} and len(provider.jobs()) == 5
    empty = spark.createDataFrame([("d", 5), ("x", 2)], "document_id string, pdf_page int")
    assert ledger.run_pass(spark, batches, provider, path, 20.0, "d", empty) == {"wait": 1, "done": 4} and len(provider.jobs()) == 6


def test_failures_wait_longer_and_end(spark, batches, tmp_path):
    (tmp_path / "jobs").mkdir()
    path, one = str(tmp_path / "ledger"), batches.where("batch_id in (1, 2)")
    provider = Files(tmp_path / "jobs", fails={2: 9}, refuses={4})
    now, seen = 0.0, []
    for _ in range(40):
        seen.append((now, ledger.run_pass(spark, one, provider, path, now, "a")))
        if "wait" not in seen[-1][1] and "submit" not in seen[-1][1]:
            break
        now = ledger.latest(ledger.read(spark, path)).where("status != 'done'").agg(F.min(F.when(F.col("due") > now, F.col("due")))).first()[0] or now + 1
    assert seen[-1][1] == {"failed": 2}
    rows = {r["batch_id"]: r for r in ledger.latest(ledger.read(spark, path)).collect()}
    assert (rows[1]["attempts"], rows[1]["error"]) == (3, "bad page") and (rows[2]["attempts"], rows[2]["error"], rows[2]["job_id"]) == (3, "ConnectionError: no answer", None)
    tries = ledger.read(spark, path).where("batch_id = 2").orderBy("version").collect()
    gaps = [b["due"] - a["due"] for a, b in zip(tries, tries[1:])]
    assert len(tries) == 3 and gaps[1] > gaps[0] > 5


def test_two_writers_of_one_version_agree(spark):
    rows = [("d", 1, "i", 1, "submitted", "ja", 1, 0, 5.0, None, None, "b"), ("d", 1, "i", 1, "submitted", "jb", 1, 0, 5.0, None, None, "a"), ("d", 1, "i", 2, "done", "jb", 1, 1, 9.0, None, "r", "a"), ("d", 2, "i", 1, "submitted", "jc", 1, 0, 5.0, None, None, "a")]
    held = ledger.latest(spark.createDataFrame(rows, ledger.LEDGER)).orderBy("batch_id").collect()
    assert [(r["job_id"], r["status"]) for r in held] == [("jb", "done"), ("jc", "submitted")]
    waits = spark.range(0, 12).select(ledger.wait(F.col("id").cast("int")).alias("w")).collect()
    assert [r["w"] for r in waits[:5]] == [5, 5, 10, 20, 40] and waits[-1]["w"] == 300
