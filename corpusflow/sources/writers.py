"""Sinks: tables as Parquet, contracts as JSON, entries as Markdown texts. Executors write; nothing passes the driver."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow import schemas as S


def write_table(df: DataFrame, path: str, partition: str | None = "document_id", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).option("compression", "zstd")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def stored(spark: SparkSession, folder: str, partition: str | None = None) -> Callable[[str, DataFrame], DataFrame]:
    """A function that writes a table to its name in the folder and reads it there: what comes after does not make it again."""

    def store(name: str, df: DataFrame) -> DataFrame:
        write_table(df, f"{folder}/{name}", partition)
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}").select(df.columns)

    return store


def as_is(name: str, df: DataFrame) -> DataFrame:
    """In the place of stored: leaves a table as the plan that it is."""
    return df


def settled(df: DataFrame) -> DataFrame:
    """df, made once and kept in the folder of spark.checkpoint.dir, for results that are read many times over.

    Where that is unset, a session in one process (master local) gets a folder of its own; on any other master that is an error."""
    context, named = df.sparkSession.sparkContext, df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None and named:
        context.setCheckpointDir(named)
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="corpusflow-"))
    return df.checkpoint()


def append_state(rows: DataFrame, path: str) -> None:
    """One append for a stage; readers take the latest row of each key."""
    rows.withColumn("updated_at", F.current_timestamp()).write.mode("append").parquet(path)


def write_json(df: DataFrame, path: str, order: list[str] | None = None, null_fields: bool = False) -> None:
    """Lines of JSON, in a total order over the parts by name where one is given."""
    out = df.orderBy(*order) if order else df
    out.write.mode("overwrite").option("ignoreNullFields", not null_fields).json(path)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def write_files(files: DataFrame, folder: str) -> int:
    """files (path, value) as one file each under folder, written by the executors; the number of files.

    A path that is absolute or leads out of the folder raises. A file is written beside its place and moved there, so that
    a task that runs again leaves no half a file. folder is any address that pyarrow reads, without a scheme a shared local path.
    """
    address = folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}"

    def run(frames):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(address)
        for frame in frames:
            for path, value in zip(frame["path"], frame["value"]):
                p = PurePosixPath(path)
                if p.is_absolute() or ".." in p.parts or not p.parts:
                    raise ValueError(f"no path inside the folder: {path!r}")
                store.create_dir(f"{root}/{p.parent}", recursive=True)
                beside = f"{root}/{p}.{uuid.uuid4().hex}.part"
                with store.open_output_stream(beside) as out:
                    out.write(value.encode())
                store.move(beside, f"{root}/{p}")
            yield pd.DataFrame({"n": [len(frame)]})

    return files.select("path", "value").mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def navigation_documents(pagemap: DataFrame, sections: DataFrame, release: str) -> tuple[DataFrame, DataFrame]:
    """Page maps and section maps, one row (one JSON object) per document, in the readers' form."""
    head = [F.lit(S.NAVIGATION_VERSION).alias("schema_version"), F.struct("document_id", F.lit(release).alias("release")).alias("document")]
    maps = pagemap.groupBy("document_id").agg(F.sort_array(F.collect_list(F.struct("pdf_page", "manual_page", "evidence"))).alias("pages"))
    row = F.struct("ord", "section_id", "keyword_id", "name", "volume", "kind", "parent_section_id", "section_number", F.col("pages.pdf_page").alias("pdf_pages"), F.col("pages.manual_page").alias("manual_pages"))
    lists = sections.groupBy("document_id").agg(F.transform(F.sort_array(F.collect_list(row)), lambda s: s.dropFields("ord")).alias("sections"))
    return maps.select("document_id", *head, "pages"), lists.select("document_id", *head, "sections")


def page_documents(pages: DataFrame) -> DataFrame:
    """(path, value): the JSON of each page table; fields that are null are left out."""
    body = F.to_json(F.struct(F.lit(S.PAGEIR_VERSIONS[-1]).alias("schema_version"), "document_id", "pdf_page", "manual_page", "blocks", "issues"))
    return pages.select(F.concat_ws("/", "document_id", F.concat(F.lit("page-"), F.lpad(F.col("pdf_page").cast("string"), 5, "0"), F.lit(".json"))).alias("path"), body.alias("value"))


def bundle_mismatch(layouts: DataFrame, batches: DataFrame) -> DataFrame:
    """Batches whose number of layouts is not their number of pages."""
    got = layouts.groupBy("document_id", "batch_id").agg(F.count("*").alias("layouts"))
    return batches.join(got, ["document_id", "batch_id"], "left").where(F.coalesce("layouts", F.lit(0)) != F.size("pdf_pages"))


def raw_pages(layouts: DataFrame, batches: DataFrame) -> DataFrame:
    """Layouts with the page they are of: the n-th layout of a batch is its n-th page."""
    page = F.get("pdf_pages", F.col("layout_index"))
    return layouts.join(batches.select("document_id", "batch_id", "pdf_pages"), ["document_id", "batch_id"]).withColumn("pdf_page", page).where("pdf_page is not null").drop("pdf_pages")


def manifest(entries: DataFrame) -> DataFrame:
    """Manifest rows in order: document, first page, and the first identifier there is. A failed entry has no path."""
    name = F.coalesce("keyword_id", "section_id", "name", "title", F.lit(""))
    path = F.when(F.col("status") != "failed", F.col("markdown_path"))
    return entries.withColumn("markdown_path", path).orderBy("document_id", F.get("source_pages", F.lit(0))["pdf_page"], name)


def write_markdown(entries: DataFrame, path: str) -> int:
    """Entries (markdown_path, markdown) as files at their paths; entries without content make none. The number of files."""
    return write_files(entries.where("markdown is not null").select(F.col("markdown_path").alias("path"), F.col("markdown").alias("value")), path)


def write_corpus(spark: SparkSession, entries: DataFrame, issues: DataFrame, pagemap: DataFrame, config, provider, folder: str) -> None:
    """Markdown files, manifest and issue lines in order, a summary and a header; all rows are written by the executors."""
    write_markdown(entries, folder)
    listed = entries.withColumn("markdown_path", F.when(F.col("markdown").isNotNull(), F.col("markdown_path")))
    write_json(listed.drop("markdown"), f"{folder}/manifest", ["document_id", "start_page", "section_id"], True)
    write_json(issues, f"{folder}/issues", ["document_id", "pdf_page", "code"])
    counts = entries.groupBy("status").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("status", "n")))).alias("entries"))
    codes = issues.groupBy("code").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("code", "n")))).alias("issues"))
    pages = pagemap.agg(F.count("*").alias("pages"), F.count_distinct("document_id").alias("documents"))
    all_of = counts.unionByName(codes, allowMissingColumns=True).unionByName(pages, allowMissingColumns=True)  # one row each
    one = all_of.agg(*[F.first(c, True).alias(c) for c in ("entries", "issues", "pages", "documents")])
    header = F.lit(f'schema_version: "{S.CORPUS_VERSION}"\nrelease: "{config.release}"\nparser:\n  provider: "{provider.name}"\n  model: "{provider.model}"\n')
    summary = one.select(F.explode(F.array(F.struct(F.lit("summary.json").alias("path"), F.to_json(F.struct("documents", "pages", "entries", "issues")).alias("value")), F.struct(F.lit("corpus.yaml").alias("path"), header.alias("value")))).alias("f"))
    write_files(summary.select("f.*"), folder)


def write_acceptance(report: DataFrame, folder: str) -> bool:
    """The gate's report as acceptance.json, whether it passes or not; whether it does."""
    row = report.first()  # one row
    kept = report.sparkSession.createDataFrame([row], report.schema)
    write_files(kept.select(F.lit("acceptance.json").alias("path"), F.to_json(F.struct(*kept.columns)).alias("value")), folder)
    return bool(row["passes"])


def write_sample(sample: DataFrame, report: DataFrame, folder: str) -> None:
    """A sample's manifest lines and its detection report."""
    write_json(sample, f"{folder}/sample", sample.columns[:2], True)
    write_json(report, f"{folder}/report", ["kind", "name"])
