"""The stages of a build as functions from tables to tables, and their statuses."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.operators import adapting, assembly, navigation, planning, quality, rendering
from corpusflow.operators import entries as rendering_of
from corpusflow.operators import sections as reading
from corpusflow.schemas import BLOCK
from corpusflow.sources.writers import as_is, settled

#: Writes a named table and gives it back as read, or leaves it as it is (sources.writers.stored, as_is).
Store = Callable[[str, DataFrame], DataFrame]

#: Exit codes of a build by its status, and attempts on an empty page before it fails (fixed values).
EXIT_CODES = {"success": 0, "warning": 1, "failed": 2, "paused": 3}
MOST_EMPTY_ATTEMPTS = 2


class Provider(Protocol):
    """A recogniser: frames of pages in, frames of raw results out (document_id, pdf_page, layout_result, error).

    It runs in the executors, a batch of pages a frame; identity() names all that its output depends on, so
    that a change of it makes checkpoints stale.
    """

    name: str
    model: str

    def identity(self) -> str: ...

    def recognise(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]: ...


class Adapter(Protocol):
    """Makes page tables of a recogniser's raw pages: document_id, pdf_page, layout_result to document_id, pdf_page, blocks, issues.

    identity() names all that its output depends on: pages that another identity has adapted are adapted again, not recognised again."""

    def identity(self) -> str: ...

    def adapt(self, raw: DataFrame) -> DataFrame: ...


class Layouts:
    """The adapter of layout results (operators.adapting.page_blocks)."""

    def identity(self) -> str:
        return "layouts/1"

    def adapt(self, raw: DataFrame) -> DataFrame:
        return adapting.page_blocks(raw)


@dataclass(frozen=True)
class ByDocument:
    """Adapters by the beginning of a document's name, the first that fits; all others' pages go to `rest`."""

    adapters: tuple[tuple[str, Adapter], ...] = ()
    rest: Adapter = field(default_factory=Layouts)

    def dealt(self) -> list[tuple[Column, Adapter]]:
        """Conditions on document_id of which one holds, and their adapters."""
        before, out = F.lit(False), []
        for prefix, adapter in self.adapters:
            fits = F.startswith("document_id", F.lit(prefix))
            out.append((fits & ~before, adapter))
            before = before | fits
        return [*out, (~before, self.rest)]

    def adapt(self, raw: DataFrame) -> DataFrame:
        return reduce(DataFrame.unionByName, [a.adapt(raw.where(c)) for c, a in self.dealt()])

    def identity_of(self) -> Column:
        """The identity of the adapter that a row's document_id goes to."""
        return F.coalesce(*[F.when(c, F.lit(a.identity())) for c, a in self.dealt()])


RAW = "document_id string, pdf_page int, layout_result string, error string"


def raw_stage(plan: DataFrame, state: DataFrame, provider: Provider, source: str = "source_sha256") -> tuple[DataFrame, DataFrame]:
    """(raw pages, state rows) of the planned pages that no checkpoint of this source and provider has done.

    Quota errors leave a page paused_quota, any other failed; both are taken up by a later run. The recogniser's
    answers are written to the folder of spark.checkpoint.dir once, and both results read them there: it is the dearest step,
    and a second run could answer otherwise.
    """
    mine = plan.withColumns({"provider": F.lit(provider.name), "model": F.lit(provider.model), "semantic_config_hash": F.lit(provider.identity())})
    identity = ["provider", "model", source, "semantic_config_hash"]
    todo = planning.pending(mine, state, ["document_id", "pdf_page"], identity, "status", ("raw_done", "done"))
    raw = todo.mapInPandas(provider.recognise, RAW).checkpoint()
    status = F.when(F.col("error").isNull(), "raw_done").when(F.startswith("error", F.lit("quota")), "paused_quota").otherwise("failed")
    rows = raw.join(todo.select("document_id", "pdf_page", *identity), ["document_id", "pdf_page"]).withColumn("status", status)
    return raw.where("error is null").drop("error"), rows.select("document_id", "pdf_page", "status", *identity, "error")


def page_stage(raw: DataFrame, page_text: DataFrame, attempts: DataFrame, store: Store = as_is, blanks: DataFrame | None = None, adapter: Adapter | ByDocument | None = None) -> tuple[DataFrame, DataFrame]:
    """(page tables, state rows): an empty page whose source is not blank is tried again once, then fails.

    blanks: document_id, pdf_page and blank of the pages whose files were looked at; of others blank is what has no text."""
    pages = (adapter or Layouts()).adapt(raw)
    blank = page_text.select("document_id", "pdf_page", (X.strip(F.coalesce("text", F.lit(""))) == "").alias("_blank"))
    if blanks is not None:
        known = blanks.select("document_id", "pdf_page", F.col("blank").alias("_shown"))
        blank = blank.join(known, ["document_id", "pdf_page"], "left").select("document_id", "pdf_page", F.coalesce("_shown", "_blank").alias("_blank"))
    known = pages.join(blank, ["document_id", "pdf_page"], "left").join(attempts.select("document_id", "pdf_page", "empty_parse_attempts"), ["document_id", "pdf_page"], "left")
    empty = F.size("blocks") == 0
    tries = F.coalesce("empty_parse_attempts", F.lit(0)) + (empty & ~F.coalesce("_blank", F.lit(False))).cast("int")
    status = F.when(~empty | F.coalesce("_blank", F.lit(False)), "done").when(tries >= MOST_EMPTY_ATTEMPTS, "failed").otherwise("parse_empty")
    code = F.when(empty & F.coalesce("_blank", F.lit(False)), "SOURCE_BLANK_PAGE").when(status != "done", "PAGE_PARSE_EMPTY")
    out = store("page_ir", known.withColumns({"empty_parse_attempts": tries, "status": status, "code": code}))
    return out.where("status = 'done'").drop("_blank", "status", "code", "empty_parse_attempts"), out.select("document_id", "pdf_page", "status", "empty_parse_attempts", "code")


def inspect(page_text: DataFrame, store: Store = as_is) -> dict[str, DataFrame]:
    return navigation.inspect_pages(page_text, store=store)


def plan(sections: DataFrame, most: int = 1) -> DataFrame:
    """Planned pages with their batches, from sections (document_id, section_id, start_page, end_page)."""
    claims = sections.withColumn("pdf_page", F.explode(F.sequence("start_page", "end_page")))
    starts = claims.groupBy("document_id", "pdf_page").agg(F.max(F.col("start_page") == F.col("pdf_page")).alias("starts"), F.sort_array(F.collect_set("section_id")).alias("candidate_sections"))
    return planning.plan_batches(starts, "document_id", "pdf_page", most, "starts")


#: Issues that are for information only.
INFO_CODES = ("KEYWORD_BOUNDARY_RESOLVED", "THEORY_HIERARCHICAL_PAGE_OVERLAP", "SOURCE_BLANK_PAGE", "VARIABLE_IDENTIFIER_CONFUSABLE_MATCH")
PAGE_BLOCKS = f"array<{BLOCK}>"


def title_ranks(blocks: DataFrame) -> DataFrame:
    """blocks with rank: how well a text or header block's only line is the section's name, null where it is not."""
    text = F.when(F.col("type") != "table", F.col("text"))
    return blocks.withColumn("rank", X.title_rank(X.keyword_key(X.keyword_surface(text)), X.keyword_key(F.col("name"))))


def own_blocks(blocks: DataFrame, claims: DataFrame, store: Store = as_is) -> tuple[DataFrame, DataFrame]:
    """(blocks, issues): of a page that several sections share each keeps its part, cut at confirmed titles, or all keep the whole.

    blocks: document_id, section_id, name, ord, start_page, end_page, pdf_page, block_index, type, text."""
    keys = ["document_id", "section_id"]
    ranked = title_ranks(blocks)
    shared = assembly.shared_pages(claims).select("document_id", "pdf_page")
    on_shared = ranked.join(shared, ["document_id", "pdf_page"], "left_semi")
    anchors = assembly.title_anchors(on_shared.where("type != 'header'"), [*keys, "pdf_page"], ["block_index"]).select(*keys, "pdf_page", F.col("anchor.block_index").alias("anchor"))
    owners = on_shared.groupBy(*keys, "pdf_page", "ord", F.col("start_page").alias("first_page"), F.col("end_page").alias("last_page")).agg((F.max("block_index") + 1).alias("n_blocks"))
    slices = store("boundaries", assembly.boundary_slices(owners.join(anchors, [*keys, "pdf_page"], "left")))
    cut = ranked.join(slices.withColumnRenamed("code", "_code"), [*keys, "pdf_page"], "left")
    kept = cut.where(F.col("_code").isNull() | F.col("block_index").between(F.col("first_block"), F.col("end_block") - 1))
    kept = kept.withColumn("ambiguous", F.coalesce(F.col("_code") == "KEYWORD_BOUNDARY_AMBIGUOUS", F.lit(False))).drop("_code", "first_block", "end_block")
    return kept, slices.select(*keys, "pdf_page", F.col("code").alias("issue"))


def kept(name: str, df: DataFrame) -> DataFrame:
    """In the place of stored, where a table is read many times over: makes it once, in the folder of spark.checkpoint.dir."""
    return settled(df)


def reconstruct(sections: DataFrame, page_ir: DataFrame, store: Store = kept) -> dict[str, DataFrame]:
    """Entries from sections (document_id, section_id, name, start_page, end_page) and page tables.

    Gives blocks (every block of a section with its bucket and what it belongs to), ranges (rows of description tables by variable),
    fields (of cards), variables (descriptions), entries (markdown and status) and issues.
    """
    keys, order = ["document_id", "section_id"], ["pdf_page", "block_index"]
    at = F.col("ord") if "ord" in sections.columns else F.lit(0)
    numbered = sections.withColumn("ord", at)
    claims = numbered.withColumn("pdf_page", F.explode(F.sequence("start_page", "end_page")))
    assembled = assembly.assemble(claims, page_ir)
    blocks = assembled.where("blocks is not null").select(*keys, "name", "ord", "start_page", "end_page", "pdf_page", F.posexplode("blocks").alias("block_index", "block"))
    blocks = blocks.withColumns({"type": F.col("block.type"), "text": F.coalesce("block.text", F.lit(""))})
    owned, cuts = own_blocks(blocks, claims, store)
    ready = settled(owned.withColumn("grid", F.when(F.col("type") == "table", adapting.grid(F.col("block.rows")))))
    found = reading.read(ready, keys, order)
    marked = store("blocks", ready.join(found["blocks"], [*keys, *order]))
    ranges, fields = store("ranges", found["ranges"]), store("fields", found["fields"])
    pieces = rendering_of.parts(marked, ranges, fields, keys, order)
    body = rendering_of.render(pieces, keys)
    on_page = lambda df: df.select(*keys, "pdf_page", F.col("code").alias("issue"))
    accounts = on_page(section_issues(marked, fields, keys))
    issues = store("section_issues", assembled.where("issue is not null").select(*keys, "pdf_page", "issue").union(cuts).union(on_page(found["issues"])).union(accounts))
    counted = issues.where(~F.col("issue").isin(*INFO_CODES)).groupBy(*keys).agg(F.count("*").alias("n_issues"))
    entries = sections.join(body, keys, "left").join(counted, keys, "left").withColumn("status", quality.entry_status(F.col("markdown").isNotNull(), F.coalesce("n_issues", F.lit(0)) > 0))
    return {"blocks": marked, "ranges": ranges, "fields": fields, "entries": entries.drop("n_issues"), "issues": issues}


def section_issues(marked: DataFrame, fields: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pdf_page, code) of what a section should have but lacks: each of its blocks in exactly one bucket, and fields in its cards."""
    per = marked.groupBy(*keys, "pdf_page", "block_index").agg(F.count("*").alias("n"), F.max("part").alias("part"), F.max("bucket").alias("bucket"))
    twice = per.where("n > 1").select(*keys, "pdf_page", F.lit("BLOCK_ACCOUNTED_TWICE").alias("code"))
    lost = per.where("n = 1 and part is null and bucket not in ('ignored', 'title')").select(*keys, "pdf_page", F.lit("BLOCK_NOT_ACCOUNTED").alias("code"))
    bare = fields.where("size(fields) = 0 and size(codes) = 0").select(*keys, "pdf_page", F.lit("CARD_WITHOUT_FIELDS").alias("code"))
    return twice.union(lost).union(bare)


def documents(entries: DataFrame, pagemap: DataFrame, release: str | None, options: DataFrame | None = None, aliases: DataFrame | None = None) -> DataFrame:
    """entries with markdown_path and with markdown as it is written: a YAML header, the title and the body; null stays null.

    options: document_id, section_id and options; aliases: keyword_id and aliases, both where they are known. Keywords lie in the folder of
    their volume (or document, where it has no volume) and family, numbered sections in theory."""
    keys = ["document_id", "section_id"]
    theory = F.startswith("document_id", F.lit("theory"))
    e = entries.withColumns({c: F.lit(None).cast("string") for c in ("section_number", "title", "parent_section_id") if c not in entries.columns})
    pages = e.select(*keys, F.explode(F.sequence("start_page", "end_page")).alias("pdf_page")).join(pagemap.select("document_id", "pdf_page", "manual_page"), ["document_id", "pdf_page"], "left")
    e = e.join(pages.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("pdf_page", "manual_page"))).alias("source_pages")), keys, "left")
    e = e.join(options, keys, "left") if options is not None else e.withColumn("options", F.lit(None).cast("array<string>"))
    named = aliases.select(F.col("keyword_id").alias("section_id"), F.col("aliases").alias("legacy_ids")) if aliases is not None else None
    e = e.join(named, "section_id", "left") if named is not None else e.withColumn("legacy_ids", F.lit(None).cast("array<string>"))
    none = F.array().cast("array<string>")
    volume = F.regexp_extract("document_id", r"volume-(\d+)", 1).try_cast("int")
    shown = F.regexp_replace("name", r"^\*", "")
    of_keyword = F.struct(
        "document_id", F.lit("keyword").alias("manual_type"), F.col("section_id").alias("keyword_id"), F.col("name"), X.family(shown).alias("family"), F.coalesce("legacy_ids", none).alias("legacy_ids"),
        F.coalesce("options", none).alias("options"), F.lit(release).cast("string").alias("manual_release"), volume.alias("volume"), "source_pages",
    )
    of_theory = F.struct("document_id", F.lit("theory").alias("manual_type"), "section_id", "section_number", "title", "parent_section_id", F.lit(release).cast("string").alias("manual_release"), "source_pages")
    as_json = lambda x: F.to_json(x, {"ignoreNullFields": "false"})
    e = e.withColumn("_head", F.when(theory, as_json(of_theory)).otherwise(as_json(of_keyword)))
    title = F.when(theory, F.concat_ws(" ", "section_number", "title")).otherwise(F.col("name"))
    text = F.concat(rendering.front_matter(F.col("_head")), F.lit("\n# "), title, F.lit("\n"), F.when(F.col("markdown") != "", F.concat(F.lit("\n"), F.col("markdown"), F.lit("\n"))).otherwise(""))
    kind = F.when(theory, "theory").otherwise("keyword")
    path = rendering.markdown_path(kind, volume, F.when(theory, F.col("section_id")).otherwise(shown))
    path = F.when(theory | volume.isNotNull(), path).otherwise(F.concat_ws("/", X.safe_component(F.col("document_id")), path))
    return e.withColumns({"markdown_path": path, "volume": volume, "markdown": F.when(F.col("markdown").isNotNull(), text)}).drop("_head")


def build_status(entries: DataFrame) -> DataFrame:
    """Statuses by document and in total (null), the worst first: failed, warning, success."""
    rank = F.when(F.col("status") == "failed", 3).when(F.col("status") == "warning", 2).otherwise(1)
    total = entries.rollup("document_id").agg(F.max(rank).alias("k"), F.count("*").alias("entries"))
    return total.select("document_id", "entries", F.when(F.col("k") == 3, "failed").when(F.col("k") == 2, "warning").otherwise("success").alias("status"))


def theory_entries(sections: DataFrame, blocks: DataFrame) -> DataFrame:
    """Blocks by the numbered sections that own them, with anchored.

    A section whose title stands on one of its pages, its number before it in the block or in one of its own, owns the blocks from there to
    the next title of any section, up to its last page; one whose title does not keeps all blocks of its pages, and its rows are not anchored."""
    keys, order = ["document_id", "section_id"], ["pdf_page", "block_index"]
    pages = sections.select(*keys, "section_number", "title", F.explode(F.sequence("start_page", "end_page")).alias("pdf_page"))
    on_page = Window.partitionBy("document_id", "pdf_page").orderBy("block_index")
    keyed = blocks.select("document_id", *order, "type", "text", X.theory_title_key(F.col("text")).alias("_key"))
    keyed = keyed.withColumns({"_next": F.lead("_key").over(on_page), "_before": F.lag("_key").over(on_page)})
    names = pages.withColumns({"_number": X.theory_title_key(F.col("section_number")), "_title": X.theory_title_key(F.col("title"))})
    match = keyed.join(names, ["document_id", "pdf_page"])
    whole = F.col("_key") == F.concat_ws(" ", "_number", "_title")
    parted = (F.col("_key") == F.col("_number")) & F.coalesce(F.col("_next") == F.col("_title"), F.lit(False))
    alone = (F.col("_key") == F.col("_title")) & ~F.coalesce(F.col("_before") == F.col("_number"), F.lit(False))
    anchors = assembly.title_anchors(match.withColumn("rank", F.when(whole, 2).when(parted | alone, 1)), keys, order)
    marks = anchors.select(*keys, "anchor.*")
    owned = assembly.theory_ownership(blocks, marks, "document_id", order)
    ends = sections.select(*keys, "end_page")
    cut = owned.join(ends, keys).where(F.col("pdf_page") <= F.col("end_page")).drop("end_page").withColumn("anchored", F.lit(True))
    bare = pages.join(marks.select(*keys), keys, "left_anti").select(*keys, "pdf_page")
    whole = blocks.join(bare, ["document_id", "pdf_page"]).withColumn("anchored", F.lit(False))
    return cut.unionByName(whole)


def theory_issues(owned: DataFrame) -> DataFrame:
    """(document_id, section_id, code): whether a section's bounds are its titles' or all its pages'."""
    per = owned.groupBy("document_id", "section_id").agg(F.max("anchored").alias("anchored"))
    return per.select("document_id", "section_id", F.when(F.col("anchored"), "THEORY_BOUNDARY_RESOLVED").otherwise("THEORY_TITLE_ANCHOR_MISSING").alias("code"))


def preflight(spark, config) -> list[tuple[str, str, str]]:
    """(check, ok | warning | failed, detail), run on the driver before a build: settings, documents, folders, provider, baseline."""
    from corpusflow.sources import readers
    from corpusflow.sources.writers import exists

    out = [("release", "ok", config.release) if config.release else ("release", "warning", "no release is set")]
    last = config.end_page
    out.append(("pages", "ok" if config.start_page >= 1 and (last is None or last >= config.start_page) else "failed", f"{config.start_page} to {last or 'the end'}"))
    there = exists(spark, config.input_dir)
    out.append(("input", "ok" if there else "failed", config.input_dir))
    lacking = "failed" if config.documents else "warning"  # a folder may be filled later, a list of documents may not
    try:
        found = readers.explicit_documents(spark, config) if config.documents else readers.discover(readers.source_files(spark, config.input_dir), config.release, config.file_prefix) if there else None
        n = found.count() if found is not None else 0
        out.append(("documents", "ok" if n else lacking, f"{n} documents"))
    except Exception as error:  # noqa: BLE001  (whatever is wrong with them is what the check is for)
        out.append(("documents", lacking, str(error).split("\n")[0][:200]))
    parent = config.output_dir.rstrip("/").rsplit("/", 1)[0] if "/" in config.output_dir.rstrip("/") else "."
    out.append(("output", "ok" if exists(spark, config.output_dir) or exists(spark, parent or "/") else "failed", config.output_dir))
    if config.provider == "remote":
        out.append(("credentials", "ok" if (config.api_key or "").strip() else "warning", "an API key is set" if (config.api_key or "").strip() else "no API key is set"))
        out.append(("jobs", "ok" if config.job_url else "warning", config.job_url or "no address for jobs is set"))
    if config.baseline:
        out.append(("baseline", "ok" if exists(spark, config.baseline) else "failed", config.baseline))
    shared = spark.conf.get("spark.checkpoint.dir", None)
    out.append(("checkpoint", "ok" if shared else "warning", shared or "spark.checkpoint.dir is not set"))
    return out


def first_pages(pages: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("document_id").orderBy("pdf_page")
    return pages.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= k).drop("_k")
