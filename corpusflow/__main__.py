"""python -m corpusflow doctor | inspect | plan | adapt | reconstruct | sample | build | detect | regression: stages over Parquet tables, or all of them."""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.operators import adapting, sampling
from corpusflow.plans import build, driver, review
from corpusflow.sources import readers, writers


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corpusflow", description=__doc__)
    stages = p.add_subparsers(dest="stage", required=True)
    for name, inputs in (("doctor", ("config",)), ("inspect", ("pages", "out")), ("plan", ("sections", "out")), ("adapt", ("raw", "out")), ("reconstruct", ("sections", "page-ir", "out")), ("sample", ("sections", "out")), ("build", ("config", "pages", "sources", "provider", "out")), ("detect", ("build", "out")), ("regression", ("out",))):
        s = stages.add_parser(name)
        for i in inputs:
            s.add_argument(f"--{i}", required=True)
        if name == "plan":
            s.add_argument("--max-batch-pages", type=int, default=1)
        if name == "build":
            s.add_argument("--baseline")
            s.add_argument("--pdf", help="folder of the documents' PDF files, which tell blank pages")
        if name == "regression":
            s.add_argument("--build", action="append", required=True, help="release=folder of a finished build; several")
            s.add_argument("--baseline", help="an earlier matrix, whose reviews are taken over")
        if name == "sample":
            s.add_argument("--seed", type=int, default=sampling.SEED)
    return p


def sample(sections: DataFrame, seed: int) -> DataFrame:
    pages = sections.withColumn("page_count", F.col("end_page") - F.col("start_page") + 1)
    return sampling.section_sample(sampling.bucketed(pages, "page_count"), "document_id", "bucket", F.col("section_id"), seed)


def plug_in(name: str):
    """The object that `module:attribute` names, called if it is a class."""
    module, _, attribute = name.partition(":")
    found = getattr(importlib.import_module(module), attribute)
    return found() if isinstance(found, type) else found


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Runs a stage; 0 for success, 1 for warnings, 2 for a failure, 3 for a build that is paused."""
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("corpusflow").getOrCreate()
    read = spark.read.parquet
    if a.stage == "doctor":
        checks = build.preflight(spark, readers.BuildConfig.load(a.config))
        for check, status, detail in checks:
            print(f"{status:8} {check}: {detail}")
        return build.EXIT_CODES["failed" if any(c[1] == "failed" for c in checks) else "warning" if any(c[1] == "warning" for c in checks) else "success"]
    if a.stage == "build":
        baseline = read(a.baseline) if a.baseline else None
        config = readers.BuildConfig.load(a.config)
        blanks = readers.document_pages(spark, a.pdf, config.file_prefix) if a.pdf else None
        return driver.run_build(spark, config, read(a.pages), read(a.sources), plug_in(a.provider), a.out, baseline, driver.Progress(), blanks).exit_code
    if a.stage == "detect":
        review.detect(spark, a.build, a.out)
        return build.EXIT_CODES["success"]
    if a.stage == "regression":
        failed, pending = review.regression(spark, dict(b.split("=", 1) for b in a.build), a.out, read(a.baseline) if a.baseline else None)
        return build.EXIT_CODES["failed" if failed else "warning" if pending else "success"]
    if a.stage == "inspect":
        build.inspect(read(a.pages), writers.stored(spark, a.out, "document_id"))
    elif a.stage == "plan":
        writers.write_table(build.plan(read(a.sections), a.max_batch_pages), a.out)
    elif a.stage == "adapt":
        writers.write_table(adapting.page_blocks(read(a.raw)), a.out)
    elif a.stage == "sample":
        writers.write_table(sample(read(a.sections), a.seed), a.out)
    else:
        out = build.reconstruct(read(a.sections), read(a.page_ir), writers.stored(spark, a.out, "document_id"))
        for name in ("entries", "issues"):
            writers.write_table(out[name], f"{a.out}/{name}")
        entries = read(f"{a.out}/entries")
        path = X.safe_component(F.col("section_id"))  # bodies alone, as no page map is at hand
        writers.write_markdown(entries.withColumn("markdown_path", F.concat_ws("/", "document_id", F.concat(path, F.lit(".md")))), f"{a.out}/markdown")
        total = build.build_status(entries).where("document_id is null").first()
        return build.EXIT_CODES[total["status"] if total else "failed"]
    return build.EXIT_CODES["success"]


if __name__ == "__main__":
    sys.exit(main())
