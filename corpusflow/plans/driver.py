"""A build from page texts to a corpus: every stage written before the next one reads it, so that a run goes on where the last one stopped."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.operators import navigation, planning, quality
from corpusflow.plans import build, checks, theory
from corpusflow.sources import readers, writers

STATE = "document_id string, pdf_page int, status string, provider string, model string, source_sha256 string, semantic_config_hash string, error string, empty_parse_attempts int, adapter string, raw_stage int, stage int, updated_at timestamp"
KEYS = ["document_id", "pdf_page"]


@dataclass
class Progress:
    """Events of a build: a stage's name, what it has done of how much, its rate and the seconds left."""

    report: Callable[[str], None] = print
    began: dict[str, float] = field(default_factory=dict)

    def __call__(self, stage: str, done: int | None = None, total: int | None = None) -> None:
        start = self.began.setdefault(stage, time.monotonic())
        if done is None or not total:
            self.report(stage)
            return
        took = max(time.monotonic() - start, 1e-9)
        left = (total - done) * took / done if done else None
        self.report(f"{stage}: {done} of {total}, {done / took:.1f} a second" + (f", {left:.0f} s left" if left is not None else ""))


class Aborted(RuntimeError):
    """The recogniser refuses to work for this user; what it had done is stored."""


@dataclass(frozen=True)
class Result:
    status: str
    entries: int
    failed: int
    paused: int
    gate: bool | None = None

    @property
    def exit_code(self) -> int:
        return build.EXIT_CODES[self.status]


def state_of(spark: SparkSession, path: str) -> DataFrame:
    """The latest row of each page in the state log; none where there is no log yet."""
    if not writers.exists(spark, path):
        return spark.createDataFrame([], STATE)
    values = [c.split()[0] for c in STATE.split(", ")]
    return planning.latest_state(spark.read.schema(STATE).parquet(path), KEYS, ["stage", "updated_at"], [c for c in values if c not in (*KEYS, "stage", "updated_at")])


def log_state(rows: DataFrame, path: str, stage: int) -> None:
    names = [c.split()[0] for c in STATE.split(", ")]
    kinds = dict(c.split() for c in STATE.split(", "))
    full = rows.withColumns({c: F.lit(None).cast(kinds[c]) for c in names if c not in rows.columns} | {"stage": F.lit(stage), "updated_at": F.current_timestamp()})
    full.select(names).write.mode("append").parquet(path)


def fold_state(spark: SparkSession, path: str, most_files: int = 64) -> bool:
    """Fold a log of more than most_files files to the latest row of each page; whether it was.

    The folded rows are added first, as a stage of their own, and the files before them go then: a run that breaks off in between
    leaves rows that say the same twice."""
    if not writers.exists(spark, path):
        return False
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")]
    if len(before) <= most_files:
        return False
    kept = state_of(spark, path).checkpoint()
    log_state(kept.drop("stage", "updated_at").coalesce(1 + len(before) // 1024), path, next_stage(spark, path))
    for f in before:
        fs.delete(f, False)
    spark.catalog.refreshByPath(path)
    return True


def next_stage(spark: SparkSession, path: str) -> int:
    return 1 + (spark.read.schema(STATE).parquet(path).agg(F.max("stage")).first()[0] or 0) if writers.exists(spark, path) else 1


def recognise(spark: SparkSession, plan: DataFrame, page_text: DataFrame, provider: build.Provider, out: str, progress: Progress, blanks: DataFrame | None = None, adapter: build.ByDocument | None = None) -> None:
    """One pass of recognition over what the state leaves to do, then of adapting over the planned pages that are recognised and not
    adapted, or adapted by another adapter, be it by this pass or by one that broke off. Each result is written once and read again for the states that it gives."""
    log = f"{out}/state"
    stage, before = next_stage(spark, log), state_of(spark, log)
    raw, rows = build.raw_stage(plan, before, provider)
    if not rows.isEmpty():
        raw.withColumn("stage", F.lit(stage)).write.mode("append").partitionBy("stage").parquet(f"{out}/raw")
        log_state(rows.withColumn("raw_stage", F.lit(stage)).join(before.select(*KEYS, "empty_parse_attempts"), KEYS, "left"), log, stage)
        refused = rows.where(F.startswith("error", F.lit("auth"))).select("error").first()
        if refused:
            raise Aborted(refused["error"])
    adapter = adapter or build.ByDocument()
    held = state_of(spark, log).withColumns({"raw_stage": F.coalesce("raw_stage", "stage"), "_adapter": adapter.identity_of()})
    known = held.where("status = 'raw_done' or status = 'done' and not adapter <=> _adapter").join(plan.select(*KEYS), KEYS, "left_semi")
    if known.isEmpty():
        return
    stage = next_stage(spark, log)

    def store(name: str, parsed: DataFrame) -> DataFrame:
        kept = parsed.select(*KEYS, "blocks", "issues", "status", "code", "empty_parse_attempts").withColumn("stage", F.lit(stage))
        kept.write.mode("append").partitionBy("stage").parquet(f"{out}/{name}")
        return spark.read.schema(kept.schema).parquet(f"{out}/{name}").where(F.col("stage") == stage).drop("stage")

    raws = spark.read.schema("document_id string, pdf_page int, layout_result string, stage int").parquet(f"{out}/raw")
    now = planning.latest_state(raws.join(known.select(*KEYS, F.col("raw_stage").alias("stage")), [*KEYS, "stage"], "left_semi"), KEYS, ["stage"], ["layout_result"]).drop("stage")
    _, parsed = build.page_stage(now, page_text, known, store, blanks, adapter)
    identity = known.drop("status", "empty_parse_attempts", "error", "stage", "updated_at", "adapter").withColumnRenamed("_adapter", "adapter")
    log_state(parsed.withColumnRenamed("code", "error").join(identity, KEYS), log, stage)
    progress("pages", parsed.where("status = 'done'").count(), plan.count())


def run_parsing(spark: SparkSession, plan: DataFrame, page_text: DataFrame, provider: build.Provider, out: str, progress: Progress, blanks: DataFrame | None = None, adapter: build.ByDocument | None = None) -> DataFrame:
    """Recognise what is planned, and once more the pages that came out empty though their source is not; the pages' states."""
    recognise(spark, plan, page_text, provider, out, progress, blanks, adapter)
    empty = state_of(spark, f"{out}/state").where("status = 'parse_empty'").select(*KEYS)
    # written out: Spark takes two reads of a growing log for one where a plan holds both, as recognise's would
    again = plan.join(empty, KEYS, "left_semi").checkpoint()
    if not again.isEmpty():
        recognise(spark, again, page_text, provider, out, progress, blanks, adapter)
    return state_of(spark, f"{out}/state")


def inspection_issues(starts: DataFrame) -> DataFrame:
    found = starts.where("code is not null")
    return found.select("document_id", "section_id", F.col("start_page").alias("pdf_page"), F.lit("warning").alias("severity"), "code", F.concat_ws(" ", F.lit("contents entry"), "name", F.lit("at"), "manual_page").alias("message"))


def run_build(spark: SparkSession, config: readers.BuildConfig, page_text: DataFrame, sources: DataFrame, provider: build.Provider, out: str, baseline: DataFrame | None = None, progress: Progress | None = None, blanks: DataFrame | None = None, adapter: build.ByDocument | None = None) -> Result:
    """From page texts (document_id, pdf_page, text) and sources (document_id, source_sha256) to out/corpus.

    blanks: document_id, pdf_page and blank of pages whose PDF was looked at (readers.document_pages), so that an empty page that shows
    nothing is no failure. paused if the recogniser's quota ended (a later run goes on), failed if an entry has no content or the gate is not passed, warning if
    entries have issues or pages are not recognised, else success. The gate's report is written whatever it says.
    """
    progress = progress or Progress(lambda line: None)
    progress("inspect")
    store, theory_text = writers.stored(spark, f"{out}/navigation"), page_text.where(theory.is_theory(F.col("document_id")))
    found = navigation.inspect_pages(page_text.where(~theory.is_theory(F.col("document_id"))), store=store)
    numbered = theory.inspect(theory_text, store) if not theory_text.isEmpty() else None
    both = lambda name, *columns: found[name].select(*columns) if numbered is None else found[name].select(*columns).union(numbered[name].select(*columns))
    lines = page_text.select(F.explode(X.logical_lines(F.col("text"))).alias("line"))
    writers.write_table(navigation.invert_aliases(navigation.alias_map(lines).groupBy("alias").agg(F.collect_set("keyword_id").alias("ids"))), f"{out}/navigation/aliases", None)
    sections = found["sections"]
    ranges = both("sections", "document_id", "section_id", "kind", "parent_section_id", "start_page", "end_page")
    starts = both("starts", "document_id", "section_id", "start_page", "name", "manual_page", "code")
    pagemap = store("all_pages", both("pagemap", "document_id", "pdf_page", "manual_page", "evidence"))
    claims = ranges.select("document_id", "section_id", F.explode(F.sequence("start_page", "end_page")).alias("pdf_page"))
    contract = store("contract", checks.contract_issues(ranges, pagemap, claims))
    gates = store("gates", checks.inspection_gates(pagemap, starts, inspection_issues(starts)))
    plan = build.plan(ranges, config.max_batch_pages).join(sources, "document_id")
    state = run_parsing(spark, plan, page_text, provider, out, progress, blanks, adapter)
    progress("reconstruct")
    page_ir = planning.latest_state(spark.read.parquet(f"{out}/page_ir").where("status = 'done'"), KEYS, ["stage"], ["blocks", "issues"]) if writers.exists(spark, f"{out}/page_ir") else None
    if page_ir is None:
        page_ir = spark.createDataFrame([], f"document_id string, pdf_page int, blocks {build.PAGE_BLOCKS}, issues array<struct<severity:string,code:string>>")
    table = writers.stored(spark, out)
    layers = table("text_layers", checks.text_layers(page_text, page_ir, config.text_layer_min_tokens, config.text_layer_min_recall)) if config.text_layer_enabled else None
    made = build.reconstruct(sections, page_ir, table)
    chosen = made["blocks"].where("bucket = 'option'").groupBy("document_id", "section_id", F.col("detail").alias("_o")).agg(F.min(F.struct("pdf_page", "block_index")).alias("_at"))
    chosen = chosen.groupBy("document_id", "section_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_o"))), lambda x: x["_o"]).alias("options"))
    columns = ["document_id", "section_id", "name", "kind", "parent_section_id", "start_page", "end_page", "markdown", "status"]
    whole = build.documents(made["entries"].select(*columns), pagemap, config.release, chosen, spark.read.parquet(f"{out}/navigation/aliases"))
    later = made["issues"]
    if numbered is not None:
        theirs = theory.reconstruct(numbered["sections"], page_ir, table)
        whole = whole.unionByName(build.documents(theirs["entries"].select(*columns, "section_number", "title"), pagemap, config.release))
        later = later.select("document_id", "section_id", "pdf_page", "issue").union(theirs["issues"].select("document_id", "section_id", "pdf_page", "issue"))
    writers.write_table(whole, f"{out}/entries", None)
    entries = spark.read.parquet(f"{out}/entries")
    failures = state.where("status in ('failed', 'paused_quota', 'parse_empty')").select(*KEYS, F.lit("error").alias("severity"), F.lit("PAGE_PARSE_FAILED").alias("code"), F.coalesce("error", "status").alias("message"))
    level = F.when(F.col("code").isin(*build.INFO_CODES), "info").otherwise("warning").alias("severity")
    in_sections = later.select(*KEYS, "section_id", F.col("issue").alias("code")).select("*", level)
    pages = quality.page_ir_issues(page_ir).select(*KEYS, F.lit("error").alias("severity"), "code")
    gate_failed = gates.where("not passes").select("document_id", F.lit(None).cast("int").alias("pdf_page"), F.lit("warning").alias("severity"), F.lit("INSPECTION_GATE_FAILED").alias("code"), F.concat_ws(" ", F.lit("coverage"), F.round("coverage", 3).cast("string"), F.lit("of"), F.col("least").cast("string")).alias("message"))
    broken = contract.select("document_id", "section_id", F.lit(None).cast("int").alias("pdf_page"), F.lit("warning").alias("severity"), "code")
    diverging = [layers.where("code is not null and code != 'TEXT_LAYER_COMPARISON_SKIPPED'").select(*KEYS, F.lit("warning").alias("severity"), "code", F.concat_ws(" ", F.lit("recall"), F.round("recall", 3).cast("string")).alias("message"))] if layers is not None else []
    writers.write_table(quality.issue_inventory(inspection_issues(starts), failures, in_sections, pages, gate_failed, broken, *diverging), f"{out}/issues", None)
    issues = spark.read.parquet(f"{out}/issues")
    writers.write_corpus(spark, entries, issues, pagemap, config, provider, f"{out}/corpus")
    counts = entries.agg(F.count("*").alias("n"), F.count(F.when(F.col("status") == "failed", 1)).alias("failed"), F.count(F.when(F.col("status") != "success", 1)).alias("marked")).first()
    held = state.agg(F.count(F.when(F.col("status") == "paused_quota", 1)).alias("paused"), F.count(F.when(F.col("status") != "done", 1)).alias("undone")).first()
    gate = None
    if baseline is not None:
        gate = writers.write_acceptance(quality.acceptance(quality.corpus_measures(entries, issues), baseline, [c for c in baseline.columns if c != "schema_version"]), f"{out}/corpus")
    status = "paused" if held["paused"] else "failed" if counts["failed"] or not counts["n"] or gate is False else "warning" if counts["marked"] or held["undone"] else "success"
    fold_state(spark, f"{out}/state")
    progress(status)
    return Result(status, counts["n"], counts["failed"], held["paused"], gate)
