"""Measures, reconciliations, constraints and gates over corpus tables."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import runs as R
from corpusflow.functions import text as X
from corpusflow.schemas import SEVERITIES


def token_table(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, token, n, first): the multiset of each text's tokens, with the place of the first appearance.

    Outer, as of an inner explode Spark asks first whether there is anything, and makes all tokens for that once more."""
    exploded = rows.select(*keys, F.posexplode_outer(X.tokens(F.col(text))).alias("at", "token")).where("token is not null")
    return exploded.groupBy(*keys, "token").agg(F.count("*").alias("n"), F.min("at").alias("first"))


def token_runs(rows: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, run): the distinct runs of `size` tokens of each text, made once (an inner explode, or a filter by length, would make them again)."""
    listed = rows.select(key, X.tokens(F.col(text)).alias("_t"))
    runs = F.transform(F.sequence(F.lit(1), F.size("_t") - size + 1), lambda i: F.array_join(F.slice("_t", i, F.lit(size)), " "))
    return listed.select(key, F.explode_outer(F.when(F.size("_t") >= size, F.array_distinct(runs))).alias("run")).where("run is not null")


#: Bits of the map of a table's runs by hash, whatever the table's size: 8 MB.
RUN_BITS = 1 << 26


def run_map(rows: DataFrame, text: str, size: int) -> np.ndarray:
    """A map with the bit of each run of `size` tokens set. Of few runs it lets few others pass, of many more, never one less."""

    def spots(batches):
        for batch in batches:
            for _, held in R.pieces(batch.column(0).to_pylist()):
                yield pa.record_batch({"bit": np.unique(R.runs(held, size)[-1] >> np.uint64(64 - RUN_BITS.bit_length() + 1)).astype(np.int64) + 1})  # from 1: a 0 would be in a bucket 0

    bit = rows.select(F.col(text).cast("binary").alias("text")).mapInArrow(spots, "bit long")
    maps = bit.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    bits = np.zeros(RUN_BITS // 8 + 4096, dtype=np.uint8)
    for r in maps:  # at most RUN_BITS / 32768 rows of 4 KB; bucket k holds the bits from (k - 1) * 32768 + 1
        start = (r["bucket"] - 1) * 4096
        bits[start : start + len(r["bits"])] |= np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return bits


def mapped_runs(rows: DataFrame, key: str, text: str, size: int, bits: np.ndarray) -> DataFrame:
    """(key, run): of the distinct runs of each text, those that a map lets pass."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def found(batches):
        bits = shared.value
        for batch in batches:
            keys = batch.column(0)
            for at, held in R.pieces(batch.column(1).to_pylist()):
                whole, starts, ends, first, of, h = R.runs(held, size)
                spot = (h >> np.uint64(64 - RUN_BITS.bit_length() + 1)).astype(np.int64)
                met = np.flatnonzero(bits[spot >> 3] >> (spot & 7).astype(np.uint8) & 1)
                places = zip(of[met].tolist(), starts[first[met, None] + np.arange(size)].tolist(), ends[first[met, None] + np.arange(size)].tolist())
                runs = list({(at[i], b" ".join([whole[s:e] for s, e in zip(a, z)])): None for i, a, z in places})
                if runs:
                    yield pa.record_batch({key: keys.take(pa.array([i for i, _ in runs])), "run": pa.array([r.decode() for _, r in runs])})

    return rows.select(key, F.col(text).cast("binary").alias("_text")).mapInArrow(found, f"`{key}` {rows.schema[key].dataType.simpleString()}, run string")


def shared_runs(a: DataFrame, b: DataFrame, a_key: str, b_key: str, text: str, size: int) -> DataFrame:
    """(a_key, b_key): pairs of texts that share a run of `size` tokens.

    b is the larger table: only those of its runs become rows that a map of a's runs lets pass; these are then compared as they are."""
    return token_runs(a, a_key, text, size).join(mapped_runs(b, b_key, text, size, run_map(a, text, size)), "run").select(a_key, b_key).distinct()


def token_recall(a: DataFrame, b: DataFrame, pairs: DataFrame, a_key: str, b_key: str) -> DataFrame:
    """For pairs of texts: token counts, overlap (sum of the lesser counts) and recall on both sides."""
    size = lambda t, k, name: t.groupBy(k).agg(F.sum("n").alias(name))
    left = pairs.join(a.select(a_key, "token", F.col("n").alias("a_n")), a_key)
    met = left.join(b.select(b_key, "token", F.col("n").alias("b_n")), [b_key, "token"])
    overlap = met.groupBy(a_key, b_key).agg(F.sum(F.least("a_n", "b_n")).alias("overlap"))
    out = pairs.join(overlap, [a_key, b_key], "left").join(size(a, a_key, "a_tokens"), a_key, "left").join(size(b, b_key, "b_tokens"), b_key, "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    out = out.withColumns({c: zero(F.col(c)) for c in ("overlap", "a_tokens", "b_tokens")})
    return out.withColumns({"a_recall": F.col("overlap") / F.nullif("a_tokens", F.lit(0)), "b_recall": F.col("overlap") / F.nullif("b_tokens", F.lit(0))})


def missing_tokens(a: DataFrame, b: DataFrame, pairs: DataFrame, a_key: str, b_key: str, most: int = 20) -> DataFrame:
    """The `most` most frequent tokens of a text that its partner has fewer of; ties by first appearance."""
    left = pairs.join(a.select(a_key, "token", "n", "first"), a_key)
    met = left.join(b.select(b_key, "token", F.col("n").alias("b_n")), [b_key, "token"], "left")
    short = met.withColumn("missing", F.col("n") - F.coalesce("b_n", F.lit(0))).where("missing > 0")
    w = Window.partitionBy(a_key, b_key).orderBy(F.desc("missing"), "first")
    return short.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most).select(a_key, b_key, "rank", "token", "missing")


def text_layer_verdict(total: Column, prose_total: Column, recall: Column, prose_recall: Column, least_tokens: int = 8, least_recall: float = 0.65) -> Column:
    """Issue code of a page's comparison with its text layer, or null."""
    formulas = (prose_total < total) & ((prose_total < least_tokens) | (prose_recall >= least_recall))
    return (
        F.when(total < least_tokens, "TEXT_LAYER_COMPARISON_SKIPPED")
        .when(recall >= least_recall, F.lit(None).cast("string"))
        .when(formulas, "TEXT_LAYER_FORMULA_REPRESENTATION_DIVERGENCE")
        .otherwise("TEXT_LAYER_DIVERGENCE")
    )


def confusable_groups(values: DataFrame, value: str, partition: list[str] | None = None) -> DataFrame:
    """Spellings that differ only in case or in o and 0, where there are several."""
    keys = partition or []
    groups = values.groupBy(*keys, X.fold_confusable(F.col(value)).alias("folded")).agg(F.sort_array(F.collect_set(value)).alias("spellings"))
    return groups.where(F.size("spellings") > 1)


#: Findings of an entry and the flags that they raise, in order (fixed values).
FINDINGS = (
    ("dual_cards", "card_summary_definition_dual_render_candidate"), ("confusable", "confusable_identifier_candidate"),
    ("literal_newlines", "literal_backslash_n_candidate"), ("fallback", "source_material_fallback_candidate"),
)


def entry_findings(entries: DataFrame, values: DataFrame, cards: DataFrame, keys: list[str]) -> DataFrame:
    """entries (keys, markdown) with what a review should look at, and flags.

    confusable: groups of identifiers (values: keys, value) that differ in case or o and 0 only; dual_cards: labels of cards (cards: keys,
    label, summary, definition, redundant) shown by a summary that says more than the definition; literal_newlines: backslashes with
    an n that stand for line ends; fallback: whether source material is shown as it is.
    """
    groups = confusable_groups(values.where(F.col("value") != ""), "value", keys).groupBy(*keys).agg(F.sort_array(F.collect_list("spellings")).alias("confusable"))
    dual = cards.where("summary and definition and not redundant").groupBy(*keys).agg(F.sort_array(F.collect_set("label")).alias("dual_cards"))
    text = F.coalesce("markdown", F.lit(""))
    out = entries.join(groups, keys, "left").join(dual, keys, "left")
    out = out.withColumns({"confusable": F.coalesce("confusable", F.array().cast("array<array<string>>")), "dual_cards": F.coalesce("dual_cards", F.array().cast("array<string>"))})
    out = out.withColumns({"literal_newlines": X.literal_newlines(text), "fallback": F.contains(text, F.lit("## Source Material"))})
    raised = {"dual_cards": F.size("dual_cards") > 0, "confusable": F.size("confusable") > 0, "literal_newlines": F.col("literal_newlines") > 0, "fallback": F.col("fallback")}
    return out.withColumn("flags", F.filter(F.array(*[F.when(raised[name], F.lit(flag)) for name, flag in FINDINGS]), lambda x: x.isNotNull()))


def detection_summary(statuses: DataFrame, issues: DataFrame, findings: DataFrame) -> DataFrame:
    """(kind, name, n): entries by status, issues by code (text layer's among them) and entries by flag."""
    by = lambda df, kind, name: df.groupBy(F.lit(kind).alias("kind"), F.col(name).alias("name")).agg(F.count("*").alias("n"))
    return by(statuses, "status", "status").union(by(issues, "issue", "code")).union(by(findings.select(F.explode("flags").alias("flag")), "flag", "flag"))


def severity_rank(severity: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), severity)


def worst(rank: Column) -> Column:
    """The severity of a rank; null for a null one (element_at of a plain array counts as never null, and then reads a null place as one)."""
    return F.try_element_at(F.array(*[F.lit(s) for s in SEVERITIES]), rank.cast("int"))


def issue_inventory(*sources: DataFrame) -> DataFrame:
    """All issues of several stages as one table; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def issue_counts(issues: DataFrame, levels: tuple[str, ...] = ("severity", "code")) -> DataFrame:
    """Counts by all levels together, by the first alone, and in total."""
    return issues.rollup(*levels).agg(F.count("*").alias("issues"))


def entry_status(has_content: Column, has_issue: Column) -> Column:
    return F.when(~has_content, "failed").when(has_issue, "warning").otherwise("success")


DIGEST_RANGE = 1_000


def ordered_digest(rows: DataFrame, keys: list[str], path: str, content: str, range_rows: int = DIGEST_RANGE) -> DataFrame:
    """A digest of each key's members (path and content) that moves with any byte of any of them.

    A member's line is its path, a tab, the SHA-256 of its content and a newline. Members are numbered in path order, the
    lines of each `range_rows` neighbours are digested together, and so are the digests of these ranges: no row or task
    holds more than a range, or one digest a range. It is no digest of the bytes laid end to end, which one task would have to read."""
    line = F.concat(F.col(path).cast("string"), F.lit("\t"), F.sha2(F.col(content).cast("binary"), 256), F.lit("\n"))
    w = Window.partitionBy(*keys).orderBy(path, "_line")
    placed = rows.select(*keys, F.col(path).alias(path), line.alias("_line")).withColumn("_range", F.floor((F.row_number().over(w) - 1) / range_rows))
    joined = lambda c, sep="": F.sha2(F.array_join(F.transform(c, lambda x: x["d"]), sep).cast("binary"), 256)
    ranges = placed.groupBy(*keys, "_range").agg(F.count("*").alias("_n"), F.sort_array(F.collect_list(F.struct(F.col(path).alias("p"), F.col("_line").alias("d")))).alias("_lines"))
    ranges = ranges.select(*keys, "_range", "_n", joined(F.col("_lines")).alias("d"))
    return ranges.groupBy(*keys).agg(F.sum("_n").alias("members"), F.sort_array(F.collect_list(F.struct("_range", "d"))).alias("_ranges")).select(*keys, "members", joined(F.col("_ranges")).alias("digest"))


def reconcile(listed: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """(key, finding): missing (listed but not present), unlisted, and duplicate (listed more than once)."""
    a, b = listed.select(key), present.select(key)
    tag = lambda df, name: df.select(key, F.lit(name).alias("finding"))
    repeated = a.groupBy(key).count().where("count > 1")
    return tag(a.join(b, key, "left_anti").distinct(), "missing").union(tag(b.join(a, key, "left_anti").distinct(), "unlisted")).union(tag(repeated, "duplicate"))


def accounting(owned: DataFrame, accounted: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks owned but not accounted for (lost), accounted for but not owned (foreign), or assigned several times (multiple).

    One union and one grouping: each side is counted by its own column."""
    both = owned.select(*keys, F.lit(1).alias("_a"), F.lit(0).alias("_b")).union(accounted.select(*keys, F.lit(0), F.lit(1)))
    counts = both.groupBy(*keys).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    found = F.array(F.when(F.col("_a") > F.col("_b"), "lost"), F.when((F.col("_a") == 0) & (F.col("_b") > 0), "foreign"), F.when(F.col("_b") > 1, "multiple"))
    return counts.select(*keys, F.explode(F.filter(found, lambda x: x.isNotNull())).alias("finding"))


def required_evidence(rows: DataFrame, requirements: DataFrame, selectors: dict[str, str]) -> DataFrame:
    """requirements (minimum and a column per selector, null for any) with found and met.

    selectors: requirement column -> column of rows. The rows are counted for each subset of the selectors, a subset's
    missing columns being any, so that a requirement meets its count by equal keys.
    """
    counted = rows.cube(*selectors.values()).agg(F.grouping_id(*selectors.values()).alias("_any"), F.count("*").alias("_n"))
    size = len(selectors)
    mask = reduce(lambda a, b: a + b, [F.when(requirements[r].isNull(), 1 << (size - 1 - i)).otherwise(0) for i, r in enumerate(selectors)]).cast("long")
    wanted = requirements.withColumn("_mask", mask)
    match = reduce(lambda a, b: a & b, [wanted[r].eqNullSafe(counted[c]) for r, c in selectors.items()], wanted["_mask"] == counted["_any"])
    met = wanted.join(counted, match, "left").select(*[wanted[c] for c in requirements.columns], F.coalesce("_n", F.lit(0)).alias("found"))
    return met.withColumn("met", F.col("found") >= F.col("minimum"))


def review_status(current: DataFrame, baseline: DataFrame, keys: list[str], identity: list[str], status: str = "review") -> DataFrame:
    """current with review: the baseline's where all identity columns are equal (nulls too), else pending."""
    base = baseline.select(*keys, *[F.col(c).alias(f"_{c}") for c in identity], F.col(status).alias("_status"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in identity])
    out = current.join(base, keys, "left").withColumn(status, F.when(same & F.col("_status").isNotNull(), F.col("_status")).otherwise("pending"))
    return out.drop("_status", *[f"_{c}" for c in identity])


def acceptance(measured: DataFrame, expected: DataFrame, measures: list[str], keys: list[str] | None = None) -> DataFrame:
    """For each key, or the one row there is: passes, and a message for each measure that is not as expected."""
    keys = keys or []
    e = expected.select(*keys, *[F.col(c).alias(f"_{c}") for c in measures])
    both = measured.select(*keys, *measures).join(e, keys, "left") if keys else measured.select(*measures).join(e, F.lit(True))  # without keys one row each
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    message = [F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.concat(F.lit(f"{c}: "), text(c), F.lit(" instead of "), text(f"_{c}"))) for c in measures]
    failures = F.filter(F.array(*message), lambda x: x.isNotNull())
    return both.select(*keys, (F.size(failures) == 0).alias("passes"), failures.alias("failures"))


def corpus_measures(entries: DataFrame, issues: DataFrame) -> DataFrame:
    """One row of measures of a corpus: entries, entries by status, issues by severity, and a digest of all Markdown."""
    by = lambda name, value: F.count(F.when(F.col(name) == value, 1)).alias(f"{value}_{'entries' if name == 'status' else 'issues'}")
    counts = entries.agg(F.count("*").alias("entries"), *[by("status", v) for v in ("success", "warning", "failed")])
    found = issues.agg(F.count("*").alias("issues"), *[by("severity", v) for v in SEVERITIES])
    digest = ordered_digest(entries.select(F.lit(1).alias("_all"), F.concat_ws("/", "document_id", "section_id").alias("path"), F.coalesce("markdown", F.lit("")).alias("markdown")), ["_all"], "path", "markdown").select("digest")
    all_of = counts.unionByName(found, allowMissingColumns=True).unionByName(digest, allowMissingColumns=True)  # one row each
    return all_of.agg(*[F.first(c, True).alias(c) for c in all_of.columns])


def page_ir_issues(pages: DataFrame) -> DataFrame:
    """(document_id, pdf_page, code) of the constraints that a page table (blocks with cells) breaks."""
    blocks = pages.select("document_id", "pdf_page", F.posexplode("blocks").alias("block", "b"))
    bad_page = pages.where("pdf_page < 1").select("document_id", "pdf_page", F.lit("PAGEIR_INVALID_PDF_PAGE").alias("code"))
    box = F.col("b.bbox")
    bad_box = blocks.where(box.isNotNull() & ((F.size(box) != 4) | F.exists(box, lambda x: x.isNull() | F.isnan(x)))).select("document_id", "pdf_page", F.lit("PAGEIR_INVALID_BBOX").alias("code"))
    rows = blocks.where("b.type = 'table'").select("document_id", "pdf_page", "block", F.size("b.rows").alias("n_rows"), F.posexplode("b.rows").alias("row_at", "cells"))
    cells = rows.select("document_id", "pdf_page", "block", "n_rows", "row_at", F.explode("cells").alias("c")).select("document_id", "pdf_page", "block", "n_rows", "row_at", "c.row", "c.column", "c.rowspan", "c.colspan")
    name = lambda cond, code: F.when(cond, F.lit(code))
    codes = F.array(
        name(F.col("row") != F.col("row_at"), "PAGEIR_INVALID_TABLE_ROW"), name(F.col("column") < 0, "PAGEIR_INVALID_TABLE_COLUMN"),
        name((F.col("rowspan") < 1) | (F.col("colspan") < 1), "PAGEIR_INVALID_TABLE_SPAN"), name(F.col("row") + F.col("rowspan") > F.col("n_rows"), "PAGEIR_TABLE_SPAN_OUT_OF_BOUNDS"),
    )
    bad_cells = cells.select("document_id", "pdf_page", F.explode(F.filter(codes, lambda x: x.isNotNull())).alias("code"))
    covered = cells.where("rowspan > 0 and colspan > 0 and column >= 0").where("row < n_rows").withColumn("r", F.explode(F.expr("sequence(row, least(row + rowspan, n_rows) - 1)"))).withColumn("k", F.explode(F.expr("sequence(column, column + colspan - 1)")))
    overlap = covered.groupBy("document_id", "pdf_page", "block", "r", "k").count().where("count > 1").select("document_id", "pdf_page", F.lit("PAGEIR_TABLE_SPAN_OVERLAP").alias("code"))
    severity = pages.select("document_id", "pdf_page", F.explode("issues").alias("i")).where(~F.col("i.severity").isin(*SEVERITIES)).select("document_id", "pdf_page", F.lit("PAGEIR_INVALID_ISSUE_SEVERITY").alias("code"))
    return reduce(DataFrame.union, [bad_page, bad_box, bad_cells, overlap, severity]).distinct()


def dealt(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """df dealt by its keys to so many tasks, which adaptive execution leaves as they are; without a number as it is."""
    return df.repartition(tasks, *keys) if tasks else df


def sequence_issues(pages: DataFrame, partition: list[str], page: str = "pdf_page") -> DataFrame:
    """Documents whose pages are not 1..n."""
    per = pages.groupBy(*partition).agg(F.min(page).alias("lo"), F.max(page).alias("hi"), F.count("*").alias("n"), F.count_distinct(page).alias("d"))
    return per.where("lo != 1 or hi != n or d != n").select(*partition, F.lit("PAGEMAP_PDF_SEQUENCE_INVALID").alias("code"))


def section_issues(sections: DataFrame, partition: list[str], ident: str = "section_id", parent: str = "parent_section_id", pages: str = "pages", tasks: int | None = None) -> DataFrame:
    """(partition, section, code): ids that repeat, parents that are missing, pages not sorted and distinct.

    tasks: to how many tasks each step is dealt, where the session's number of shuffle partitions is too low for the sections."""
    tag = lambda df, code: df.select(*partition, ident, F.lit(code).alias("code"))
    ids = dealt(sections.select(*partition, ident), tasks, *partition, ident).groupBy(*partition, ident).count()
    named = dealt(sections.where(F.col(parent).isNotNull()).select(*partition, ident, parent), tasks, *partition, parent)
    orphan = named.join(ids.select(*partition, F.col(ident).alias(parent)), [*partition, parent], "left_anti")
    ragged = sections.where(~F.sort_array(F.array_distinct(pages)).eqNullSafe(F.col(pages)) | (F.size(pages) == 0))
    found = tag(ids.where("count > 1"), "SECTION_ID_DUPLICATE").union(tag(orphan, "SECTION_PARENT_MISSING")).union(tag(ragged, "SECTION_PAGE_RANGE_INVALID"))
    return dealt(found, tasks, *partition, ident).distinct()


def pagemap_issues(pagemap: DataFrame, partition: list[str]) -> DataFrame:
    """Documents where a page has a printed number without evidence, or evidence without a number."""
    odd = pagemap.where(F.col("manual_page").isNull() != F.col("evidence").isNull())
    return odd.select(*partition).distinct().select(*partition, F.lit("PAGEMAP_EVIDENCE_INVALID").alias("code"))


def navigation_issues(sections: DataFrame, documents: DataFrame, document: str = "document_id", tasks: int | None = None) -> DataFrame:
    """(document, section_id, code) of what sections (pdf_pages, manual_pages, kind, keyword_id, volume, parent_section_id) break.

    documents: document, volume and pages, one row each; what section_issues finds is included, and pages beyond the document's end."""
    known = dealt(sections, tasks, document).join(documents.select(document, F.col("volume").alias("_volume"), F.col("pages").alias("_pages")), document, "left")
    identity = F.when(F.col("kind") == "keyword", F.col("keyword_id").eqNullSafe(F.col("section_id"))).otherwise(F.col("keyword_id").isNull())
    codes = F.array(
        F.when(~F.col("volume").eqNullSafe(F.col("_volume")), "SECTION_VOLUME_MISMATCH"),
        F.when(F.exists("pdf_pages", lambda p: (p < 1) | (p > F.col("_pages"))), "SECTION_PAGE_RANGE_INVALID"),
        F.when(F.size("pdf_pages") != F.size("manual_pages"), "SECTION_PAGE_LABEL_COUNT_MISMATCH"),
        F.when(~identity, "SECTION_KEYWORD_ID_INVALID"),
    )
    own = known.select(document, "section_id", F.explode(F.filter(codes, lambda c: c.isNotNull())).alias("code"))
    return dealt(own.union(section_issues(sections, [document], pages="pdf_pages", tasks=tasks).select(document, "section_id", "code")), tasks, document, "section_id").distinct()


def regression_matrix(documents: DataFrame, issues: DataFrame, review: DataFrame, baseline: DataFrame | None = None, keys: tuple[str, ...] = ("release", "document_id"), identity: tuple[str, ...] = ()) -> DataFrame:
    """documents (keys, measures, passes) with the counts of their issue codes, their pages to review and the review's status.

    issues: keys and code; review: keys and pdf_page. A review is taken over from the baseline where all of `identity` is the same."""
    keys = list(keys)
    codes = issues.groupBy(*keys, "code").agg(F.count("*").alias("n")).groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("code", "n")))).alias("issue_codes"))
    pages = review.groupBy(*keys).agg(F.sort_array(F.collect_set("pdf_page")).alias("review_pages"))
    out = documents.join(codes, keys, "left").join(pages, keys, "left")
    return out.withColumn("review", F.lit("pending")) if baseline is None else review_status(out, baseline, keys, list(identity))


def matrix_summary(matrix: DataFrame) -> DataFrame:
    """One row: documents, gates not passed, reviews to do."""
    return matrix.agg(F.count("*").alias("documents"), F.count(F.when(~F.col("passes"), 1)).alias("failed_gates"), F.count(F.when(F.col("review") == "pending", 1)).alias("pending_reviews"))


def backfill(issues: DataFrame, pages: DataFrame, keys: list[str]) -> DataFrame:
    """issues with a missing pdf_page taken from their owner page, and its printed label where the pages agree."""
    p = pages.select(*keys, F.col("pdf_page").alias("_page"), F.col("manual_page").alias("_label"))
    joined = issues.join(p, keys, "left")
    page = F.coalesce("pdf_page", "_page")
    return joined.withColumns({"pdf_page": page, "manual_page": F.coalesce("manual_page", F.when(page == F.col("_page"), F.col("_label")))}).drop("_page", "_label")
