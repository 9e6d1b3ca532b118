"""What a person should look at in finished builds: findings in entries, and a matrix of documents over releases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators import ordered, quality
from corpusflow.sources import writers

KEYS = ["document_id", "section_id"]
#: What has to be the same for a review to be taken over from a baseline.
IDENTITY = ("source_sha256", "pages", "labelled", "issue_codes")


def detect(spark: SparkSession, build: str, out: str) -> DataFrame:
    """Findings of each entry of a build (written to out/findings) and their summary beside its statuses and issues (out/summary)."""
    read = spark.read.parquet
    entries, fields, blocks = read(f"{build}/entries"), read(f"{build}/fields"), read(f"{build}/blocks")
    values = fields.select(*KEYS, F.explode("fields").alias("f")).select(*KEYS, F.col("f.variable").alias("value")).where("value is not null")
    shown = blocks.where("bucket = 'card_summary'").select(*KEYS, F.col("detail").alias("label"), F.lit(True).alias("summary"), F.lit(False).alias("definition"))
    both = shown.union(fields.select(*KEYS, "label", F.lit(False), F.lit(True)))
    cards = both.groupBy(*KEYS, "label").agg(F.max("summary").alias("summary"), F.max("definition").alias("definition")).withColumn("redundant", F.lit(False))
    findings = quality.entry_findings(entries.select(*KEYS, "markdown"), values, cards, KEYS).drop("markdown")
    writers.write_table(findings, f"{out}/findings", None)
    summary = quality.detection_summary(entries.select("status"), read(f"{build}/issues").select("code"), read(f"{out}/findings"))
    writers.write_table(summary, f"{out}/summary", None)
    return read(f"{out}/summary")


def documents(spark: SparkSession, release: str, build: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with their measures, issues, pages to review) of one build, by release and document."""
    read, here = spark.read.parquet, F.lit(release).alias("release")
    state = read(f"{build}/state").groupBy("document_id").agg(F.max_by("source_sha256", "stage").alias("source_sha256"))
    issues = read(f"{build}/issues").where("document_id is not null")
    measured = read(f"{build}/navigation/gates").join(state, "document_id", "left").select(here, "document_id", "source_sha256", "pages", "labelled", "coverage", "passes")
    starts = read(f"{build}/navigation/sections").select("document_id", F.col("start_page").alias("pdf_page"))
    if writers.exists(spark, f"{build}/navigation/theory_sections"):
        starts = starts.union(read(f"{build}/navigation/theory_sections").select("document_id", F.col("start_page").alias("pdf_page")))
    at = ["document_id", "pdf_page"]
    pages = read(f"{build}/navigation/all_pages").join(starts.distinct().withColumn("_start", F.lit(True)), at, "left")
    pages = pages.join(issues.where("pdf_page is not null").select(*at).distinct().withColumn("_issue", F.lit(True)), at, "left")
    places = ordered.review_places(pages.withColumnsRenamed({"_start": "starts", "_issue": "has_issue"}), ["document_id"], "pdf_page", "evidence", start=F.col("starts"), issue=F.col("has_issue"))
    return measured, issues.select(here, "document_id", "code"), places.select(here, "document_id", "pdf_page")


def regression(spark: SparkSession, builds: dict[str, str], out: str, baseline: DataFrame | None = None) -> tuple[int, int]:
    """The matrix of documents over builds by release, written to out/matrix; (gates not passed, reviews to do).

    baseline: an earlier matrix with its reviews. A review stays where source, pages, labels and issues are what they were."""
    parts = [documents(spark, release, build) for release, build in builds.items()]
    measured, issues, places = (reduce(DataFrame.union, [p[k] for p in parts]) for k in range(3))
    codes = issues.groupBy("release", "document_id", "code").agg(F.count("*").alias("n")).groupBy("release", "document_id").agg(F.to_json(F.sort_array(F.collect_list(F.struct("code", "n")))).alias("issue_codes"))
    known = measured.join(codes, ["release", "document_id"], "left")
    matrix = quality.regression_matrix(known.drop("issue_codes"), issues, places).drop("review", "issue_codes").join(codes, ["release", "document_id"], "left")
    matrix = matrix.withColumn("review", F.lit("pending")) if baseline is None else quality.review_status(matrix, baseline, ["release", "document_id"], list(IDENTITY))
    writers.write_table(matrix, f"{out}/matrix", None)
    total = quality.matrix_summary(spark.read.parquet(f"{out}/matrix")).first()
    return total["failed_gates"], total["pending_reviews"]
