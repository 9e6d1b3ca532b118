"""Scans: source files, page texts, navigation, page tables, checkpoints, issue logs, samples and baselines.

Versions and identities are checked inside the plan: a row of an unknown version raises when it is read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field, fields
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow import schemas as S
from corpusflow.sources import pdf

#: Volumes by roman numeral, and the order of documents in outputs (fixed values).
VOLUMES = {"i": 1, "ii": 2, "iii": 3}
DOCUMENT_ORDER = ("keyword-volume-1", "keyword-volume-2", "keyword-volume-3", "theory")


class ConfigError(ValueError):
    pass


class DiscoveryError(ValueError):
    pass


#: Settings by group and name as files have them, and the fields that hold them (fixed values).
GROUPS = {
    "manual": {"release": "release", "manuals_dir": "input_dir", "documents": "documents"},
    "parser": {"provider": "provider", "model": "model", "max_batch_pages": "max_batch_pages", "batch_size": "batch_size", "max_retries": "max_retries", "timeout_seconds": "timeout_seconds", "poll_interval_seconds": "poll_interval_seconds", "local": "local", "api_key": "api_key", "job_url": "job_url", "quota_exhausted_codes": "quota_exhausted_codes"},
    "output": {"corpus_dir": "output_dir"},
    "options": {"start_page": "start_page", "end_page": "end_page", "concurrency": "concurrency"},
    "validation": {"text_layer_enabled": "text_layer_enabled", "text_layer_sample_pages": "text_layer_pages", "text_layer_min_tokens": "text_layer_min_tokens", "text_layer_min_visual_recall": "text_layer_min_recall"},
    "quality_gate": {"baseline": "baseline"},
}


@dataclass(frozen=True)
class BuildConfig:
    """Settings of a build. from_dict rejects unknown keys, and renames batch_size unless both are given; settings may come
    flat or in the groups of GROUPS. provider settings of its own (local, job_url and so on) are kept for the provider."""

    release: str | None = None
    input_dir: str = "manuals"
    output_dir: str = "corpus"
    file_prefix: str = "manual"
    provider: str = "remote"
    model: str = ""
    max_batch_pages: int = 1
    text_layer_pages: int = 3
    text_layer_min_tokens: int = 8
    text_layer_min_recall: float = 0.65
    seed: int = 20260817
    documents: tuple | None = None
    text_layer_enabled: bool = True
    start_page: int = 1
    end_page: int | None = None
    concurrency: int = 4
    baseline: str | None = None
    max_retries: int = 2
    timeout_seconds: int = 1800
    poll_interval_seconds: int = 5
    api_key: str | None = field(default=None, repr=False)
    job_url: str | None = None
    quota_exhausted_codes: tuple = ()
    local: dict | None = None

    def __post_init__(self):
        if self.release is not None:
            release = str(self.release).strip().upper()
            if not release.startswith("R"):
                raise ConfigError(f"a release starts with R: {self.release!r}")
            object.__setattr__(self, "release", release)
        if self.max_batch_pages < 1:
            raise ConfigError("max_batch_pages is at least 1")
        if self.provider.endswith("local"):  # such a provider takes a page a request
            object.__setattr__(self, "max_batch_pages", 1)
        if self.documents is not None:
            if not self.documents:
                raise ConfigError("documents, where they are given, are some")
            object.__setattr__(self, "documents", tuple(explicit_document(d) for d in self.documents))
        if self.timeout_seconds <= 0 or self.poll_interval_seconds <= 0 or self.max_retries < 0 or self.text_layer_pages < 0:
            raise ConfigError("times are positive, retries and sample pages not negative")
        if not 0 <= self.text_layer_min_recall <= 1 or self.text_layer_min_tokens < 0:
            raise ConfigError("text layer bounds: recall from 0 to 1, tokens not negative")

    @classmethod
    def from_dict(cls, values: dict) -> BuildConfig:
        flat = {k: v for k, v in values.items() if k not in GROUPS}
        for group in set(values) & set(GROUPS):
            inner = values[group] or {}
            if not isinstance(inner, dict) or (unknown := set(inner) - set(GROUPS[group])):
                raise ConfigError(f"unknown settings of {group}: {sorted(unknown) if isinstance(inner, dict) else inner!r}")
            flat |= {GROUPS[group][k]: v for k, v in inner.items()}
        values = flat
        if "batch_size" in values:
            if "max_batch_pages" in values:
                raise ConfigError("batch_size is the former name of max_batch_pages; give one")
            values["max_batch_pages"] = values.pop("batch_size")
        if unknown := set(values) - {f.name for f in fields(cls)}:
            raise ConfigError(f"unknown settings: {sorted(unknown)}")
        return cls(**values)

    @classmethod
    def load(cls, path: str) -> BuildConfig:
        """From a YAML file, where a YAML reader is installed, or JSON, which is YAML too."""
        with open(path, encoding="utf-8") as f:
            text = f.read()
        try:
            import yaml
        except ImportError:
            import json

            return cls.from_dict(json.loads(text))
        return cls.from_dict(yaml.safe_load(text))


@dataclass(frozen=True)
class ExplicitDocument:
    path: str
    manual_type: str | None = None
    volume: int | None = None


def explicit_document(value: dict | ExplicitDocument) -> ExplicitDocument:
    """A document named in the settings; a keyword document has a volume from 1 to 3, and no other has one."""
    if isinstance(value, ExplicitDocument):
        return value
    if unknown := set(value) - {"path", "manual_type", "volume"}:
        raise ConfigError(f"unknown settings of a document: {sorted(unknown)}")
    d = ExplicitDocument(str(value["path"]), value.get("manual_type"), value.get("volume"))
    if d.manual_type not in (None, "keyword", "theory") or (d.manual_type == "keyword") != (d.volume is not None) or d.volume not in (None, *VOLUMES.values()):
        raise ConfigError(f"keyword documents have a volume from 1 to 3, others none: {value}")
    return d


def explicit_documents(spark: SparkSession, config: BuildConfig, prefix: str | None = None) -> DataFrame:
    """(path, document_id, manual_type, volume, release) of the documents that the settings name, in document order.

    What a file's name says comes first; settings that contradict it, several files of one document or releases that differ raise.
    The documents are the few that a person has listed."""
    rows = [(d.path, d.manual_type, d.volume) for d in config.documents or ()]
    named = spark.createDataFrame(rows, "path string, _type string, _volume int").withColumn("_id", file_identity(F.element_at(F.split("path", "/"), -1), prefix or config.file_prefix))
    given = F.when(F.col("_type") == "theory", "theory").when(F.col("_type") == "keyword", F.concat(F.lit("keyword-volume-"), F.col("_volume").cast("string")))
    out = named.select("path", "_type", "_volume", F.coalesce("_id.document_id", given).alias("document_id"), F.coalesce("_id.manual_type", "_type").alias("manual_type"), F.coalesce("_id.volume", "_volume").alias("volume"), F.coalesce("_id.release", F.lit(config.release)).alias("release"))
    seen: set[str] = set()
    for r in out.collect():
        if r["document_id"] is None or r["release"] is None:
            raise ConfigError(f"neither name nor settings say what {r['path']} is")
        if (r["_type"] or r["manual_type"]) != r["manual_type"] or (r["_volume"] or r["volume"]) != r["volume"]:
            raise ConfigError(f"the settings of {r['path']} contradict its name")
        if r["document_id"] in seen:
            raise ConfigError(f"several files for {r['document_id']}")
        seen.add(r["document_id"])
    if len({r["release"] for r in out.select("release").distinct().collect()} | ({config.release} if config.release else set())) > 1:
        raise ConfigError("documents of several releases")
    return out.drop("_type", "_volume").orderBy(F.array_position(F.array(*map(F.lit, DOCUMENT_ORDER)), F.col("document_id")))


def file_identity(name: Column, prefix: str = "manual") -> Column:
    """struct(document_id, manual_type, volume, release) of a source file's name, null if it is none."""
    volume = rf"(?i)^{prefix}_(?:volume|vol)_(i{{1,3}})_r(\d+(?:\.\d+)?)\.pdf$"
    theory = rf"(?i)^{prefix}_theory_r(\d+(?:\.\d+)?)\.pdf$"
    number = F.length(F.regexp_extract(name, volume, 1))
    release = lambda p, k: F.concat(F.lit("R"), F.regexp_extract(name, p, k)).alias("release")
    keyword = F.struct(F.concat(F.lit("keyword-volume-"), number.cast("string")).alias("document_id"), F.lit("keyword").alias("manual_type"), number.alias("volume"), release(volume, 2))
    other = F.struct(F.lit("theory").alias("document_id"), F.lit("theory").alias("manual_type"), F.lit(None).cast("int").alias("volume"), release(theory, 1))
    return F.when(name.rlike(volume), keyword).when(name.rlike(theory), other)


def discover(files: DataFrame, release: str | None = None, prefix: str = "manual") -> DataFrame:
    """Documents among files (path): identity, and one file per document of one release, in document order.

    The few files of a directory are counted on the driver to fail early."""
    named = files.withColumn("_id", file_identity(F.element_at(F.split("path", "/"), -1), prefix)).where("_id is not null").select("*", "_id.*").drop("_id")
    if release:
        named = named.where(F.col("release") == release)
    counts = named.groupBy("release", "document_id").count().collect()
    if not counts:
        raise DiscoveryError(f"no source file of release {release or 'any'}")
    if len({r["release"] for r in counts}) > 1:
        raise DiscoveryError(f"several releases: {sorted({r['release'] for r in counts})}")
    if several := [r["document_id"] for r in counts if r["count"] > 1]:
        raise DiscoveryError(f"several files for {several}")
    return named.orderBy(F.array_position(F.array(*map(F.lit, DOCUMENT_ORDER)), F.col("document_id")))


def source_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, size and SHA-256 of the PDF files of a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").load(folder)
    return files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("source_sha256"))


#: Operators of a page's content that show something (fixed values of the format).
VISIBLE = frozenset((b"Tj", b"TJ", b"'", b'"', b"Do", b"S", b"s", b"f", b"F", b"f*", b"B", b"B*", b"b", b"b*", b"sh"))
def pdf_summary(content: bytes) -> tuple[int, bool]:
    """(pages, encrypted) of a PDF's bytes: the pages of its page tree, as last written, and whether it has an Encrypt entry."""
    file = pdf.Pdf(content)
    return len(file.pages()), file.encrypted


def pdf_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A row per page of the folder's PDF files (see pdf.PdfPages), with blank: nothing shown and no annotation."""
    spark.dataSource.register(pdf.PdfPages)
    pages = spark.read.format("pdf_pages").load(folder)
    # a content that can't be read is not known to be blank
    return blank_pages(pages).withColumn("blank", F.col("blank") & F.col("content").isNotNull())


def document_pages(spark: SparkSession, folder: str, prefix: str = "manual") -> DataFrame:
    """pdf_pages of the folder's documents, by the identity that their names give."""
    pages = pdf_pages(spark, folder).withColumn("_id", file_identity(F.element_at(F.split("path", "/"), -1), prefix))
    return pages.where("_id is not null").select(F.col("_id.document_id").alias("document_id"), "pdf_page", "page_count", "rotate", "annotations", "blank")


def pages_of(files: DataFrame, keys: list[str], content: str = "content") -> DataFrame:
    """(keys, pdf_page, page_count, rotate, content, annotations) of the pages of PDF files that stand in a column as bytes."""
    kinds = ", ".join(f"{k} {files.schema[k].dataType.simpleString()}" for k in keys)
    names = [*keys, "pdf_page", "page_count", "rotate", "content", "annotations"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for row in frame.itertuples(index=False):
                file = pdf.Pdf(bytes(row[-1] or b""))
                pages = file.pages()
                for n, (_, page) in enumerate(pages, 1):
                    turn = file.get(page.get("Rotate"))
                    rows.append((*row[:-1], n, len(pages), turn if isinstance(turn, int) else 0, file.content(page), len(file.annotations(page))))
            yield pd.DataFrame(rows, columns=names)

    return files.select(*keys, content).mapInPandas(run, f"{kinds}, pdf_page int, page_count int, rotate int, content binary, annotations int")


def sliced(files: DataFrame, numbers: str = "pages", content: str = "content") -> DataFrame:
    """files with slice: a PDF of the pages whose numbers (array<int>, from 1) stand in a row, for a recogniser that takes files."""

    @F.pandas_udf("binary")
    def cut(c: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or k is None else pdf.slice_pages(bytes(x), [int(i) for i in k]) for x, k in zip(c, n)])

    return files.withColumn("slice", cut(content, numbers))


def pdf_files(spark: SparkSession, folder: str) -> DataFrame:
    """source_files with page_count; a row of an encrypted file raises when it is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").load(folder)

    @F.pandas_udf("pages int, encrypted boolean")
    def summary(content: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([pdf_summary(bytes(c)) for c in content], columns=["pages", "encrypted"])

    out = files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("source_sha256"), summary("content").alias("_s"))
    return checked(out.select("path", "size", "source_sha256", F.col("_s.pages").alias("page_count"), "_s.encrypted"), ~F.col("encrypted"), "an encrypted file").drop("encrypted")


def shows_nothing(stream: bytes) -> bool:
    """Whether a page's content stream has no operator that shows anything; what stands in strings is none."""
    bare = re.sub(rb"\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<[0-9A-Fa-f\s]*>|%[^\r\n]*", b" ", stream, flags=re.S)
    return not VISIBLE & set(re.findall(rb"[^\s\[\]<>/()]+", bare))


def blank_pages(pages: DataFrame, stream: str = "content", annotations: str = "annotations") -> DataFrame:
    """pages (a content stream and a number of annotations) with blank: no annotation and nothing shown; without a stream a page is blank."""

    @F.pandas_udf("boolean")
    def nothing(s: pd.Series) -> pd.Series:
        return s.map(lambda x: True if x is None else shows_nothing(bytes(x)))

    return pages.withColumn("blank", (F.coalesce(annotations, F.lit(0)) == 0) & nothing(stream))


class Extractor(Protocol):
    """A reader of text layers: a file's bytes to one text a page. It runs in the executors, so it is serialisable."""

    def extract(self, content: bytes) -> list[str]: ...


def extract_pages(files: DataFrame, extractor: Extractor, document: str = "document_id", content: str = "content") -> DataFrame:
    """(document, pdf_page, text) of files' text layers by an extractor."""
    kind = files.schema[document].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for d, c in zip(f[document], f[content]):
                texts = extractor.extract(bytes(c))
                yield pd.DataFrame({document: [d] * len(texts), "pdf_page": range(1, len(texts) + 1), "text": texts})

    return files.select(document, content).mapInPandas(run, f"{document} {kind}, pdf_page int, text string")


def signed_addresses(text: Column) -> Column:
    """Web addresses without their query, where signatures stand."""
    return F.regexp_replace(text, r"(https?://[^\s?\"'<>]+)\?[^\s\"'<>]*", "$1")


def form_feed_pages(texts: DataFrame, document: str = "document_id", text: str = "text") -> DataFrame:
    """Page texts of a text layer whose pages end with form feeds; one empty page at the end is none."""
    pages = F.split(F.col(text), "\f")
    kept = F.when((F.size(pages) > 1) & (F.element_at(pages, -1) == ""), F.slice(pages, F.lit(1), F.size(pages) - 1)).otherwise(pages)
    return texts.select(document, F.posexplode(kept).alias("at", "text")).select(document, (F.col("at") + 1).alias("pdf_page"), "text")


def is_blank(text: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s", "")) == 0


def checked(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """df, whose first row that breaks the condition raises when it is read."""
    return df.where(F.coalesce(condition, F.lit(False)) | F.raise_error(F.lit(message)).cast("boolean"))


def read_navigation(spark: SparkSession, folder: str, release: str) -> tuple[DataFrame, DataFrame]:
    """(pagemap, sections) of the navigation files under folder/<document>/."""
    head = "schema_version string, document struct<document_id:string,release:string>"
    entry = "array<struct<pdf_page:int,manual_page:string,evidence:string>>"
    section = "array<struct<section_id:string,keyword_id:string,name:string,volume:int,kind:string,parent_section_id:string,section_number:string,pdf_pages:array<int>,manual_pages:array<string>>>"
    good = (F.col("schema_version") == S.NAVIGATION_VERSION) & (F.col("document.release") == release)
    pages = checked(spark.read.schema(f"{head}, pages {entry}").option("multiLine", True).json(f"{folder}/*/pagemap.json"), good, "page map of another version or release")
    maps = checked(spark.read.schema(f"{head}, sections {section}").option("multiLine", True).json(f"{folder}/*/sectionmap.json"), good, "section map of another version or release")
    pagemap = pages.select(F.col("document.document_id").alias("document_id"), F.inline("pages"))
    sections = maps.select(F.col("document.document_id").alias("document_id"), F.posexplode("sections").alias("ord", "s")).select("document_id", "ord", "s.*")
    both = F.arrays_zip(F.col("pdf_pages").alias("pdf_page"), F.col("manual_pages").alias("manual_page")).cast("array<struct<pdf_page:int,manual_page:string>>")
    return pagemap, sections.withColumn("pages", both).drop("pdf_pages", "manual_pages")


def fresh_pages(pages: DataFrame, state: DataFrame, sources: DataFrame) -> DataFrame:
    """Page tables without a checkpoint row, or whose row is done, points at this file and has the current source."""
    s = state.select("document_id", "pdf_page", F.col("status").alias("_status"), F.col("pageir_path").alias("_path"), F.col("source_sha256").alias("_sha"))
    now = sources.select("document_id", F.col("source_sha256").alias("_now"))
    joined = pages.join(s, ["document_id", "pdf_page"], "left").join(now, "document_id", "left")
    good = F.col("_status").isNull() | ((F.col("_status") == "done") & (F.col("_path") == F.col("path")) & (F.col("_sha") == F.col("_now")))
    return joined.where(good).drop("_status", "_path", "_sha", "_now")


def read_page_ir(spark: SparkSession, path: str) -> DataFrame:
    """Page tables from JSON, one page a file; cells of the old version have spans of one."""
    df = spark.read.schema("schema_version string, " + S.PAGEIR).option("multiLine", True).json(path).withColumn("path", F.input_file_name())
    df = checked(df, F.col("schema_version").isin(*S.PAGEIR_VERSIONS), "page table of an unknown version")
    one = lambda c: F.struct(c["text"].alias("text"), c["row"].alias("row"), c["column"].alias("column"), F.coalesce(c["rowspan"], F.lit(1)).alias("rowspan"), F.coalesce(c["colspan"], F.lit(1)).alias("colspan"))
    rows = lambda b: F.transform(b["rows"], lambda r: F.transform(r, one))
    blocks = F.transform("blocks", lambda b: F.struct(b["type"].alias("type"), b["text"].alias("text"), b["bbox"].alias("bbox"), rows(b).alias("rows")))
    return df.withColumn("blocks", blocks)


def read_issues(spark: SparkSession, path: str) -> DataFrame:
    """Issue lines; blank, broken and incomplete ones are skipped, absent columns are null."""
    df = spark.read.schema(S.ISSUES + ", _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    return df.where("_bad is null and severity is not null and code is not null").drop("_bad")


def skipped_issues(spark: SparkSession, path: str) -> DataFrame:
    """(file, skipped): how many lines of each file read_issues leaves out; blank ones do not count."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.trim("value").alias("value")).where("value != ''")
    read = F.from_json("value", "severity string, code string", {"mode": "PERMISSIVE"})
    bad = read.isNull() | read["severity"].isNull() | read["code"].isNull()
    return lines.where(bad).groupBy("file").agg(F.count("*").alias("skipped"))


def layouts(lines: DataFrame, line: str = "value") -> DataFrame:
    """(line_index, layout_index, layout_result) of provider lines that each hold an array of layouts."""
    parsed = F.from_json(F.col(line), "struct<result:struct<layoutParsingResults:array<string>>>")["result"]["layoutParsingResults"]
    keys = [c for c in lines.columns if c != line]
    return lines.select(*keys, F.posexplode(parsed).alias("layout_index", "layout_result"))


def sample_pages(samples: DataFrame) -> DataFrame:
    """Distinct (document_id, pdf_page) of a frozen sample."""
    return samples.select("document_id", F.explode("pdf_pages").alias("pdf_page")).distinct()


def frozen_pages(samples: DataFrame, sources: DataFrame, release: str, kind: str) -> DataFrame:
    """sample_pages of a frozen sample (document_id, kind, release, source_sha256, pdf_pages) of this kind, release and these sources.

    A row of another kind or release, or of a source that is not there any more or has changed, raises when it is read."""
    now = sources.select("document_id", F.col("source_sha256").alias("_now"))
    held = checked(samples.join(now, "document_id", "left"), F.col("kind").eqNullSafe(F.lit(kind)), "a sample of another kind")
    held = checked(held, F.upper("release").eqNullSafe(F.lit(release.upper())), "a sample of another release")
    return sample_pages(checked(held, F.col("source_sha256").eqNullSafe(F.col("_now")) & F.col("_now").isNotNull(), "a sample of another source"))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The append-only checkpoint log."""
    return spark.read.schema(S.PAGE_STATE).parquet(path)


def read_baseline(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return checked(spark.read.schema("schema_version string, " + schema).option("multiLine", True).json(path), F.col("schema_version") == S.CORPUS_VERSION, "baseline of another version")
