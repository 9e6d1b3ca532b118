"""Mixing sources to target weights, with DataFrame operations only.

Each document gets a hash-random key. The keys of a source are dealt into ranges of about
RANGE_ROWS documents, sizes are summed per range, prefix sums over the (few) ranges give each
range its start, and a window inside each range gives each document its place in its source.
A source takes whole epochs while its budget lasts and cuts the last one at the exact word.

Cases: null texts have size 0; a null source is a source of its own, the last; repeated rows and
equal keys are ordered by (key, doc_id, size), and rows equal in all three are exchangeable; a very long text is cut
like any other, within its one row; an empty table gives no rows; other columns of the input are ignored by mix_plan and
handed on by mix, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import n_words, packed, save

RANGE_ROWS = 2_048


def source_targets(sized: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Per source: its size, its target (water-filled under most * size), its whole epochs and the rest.

    Sources sorted by most * size / weight are capped from the front as long as the level
    reached by sharing what is left among the others lies above them. One row per source.
    """
    per = sized.groupBy("src").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("n"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    per = per.withColumn("w", F.element_at(cycle, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    per = per.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    per = per.withColumn("ratio", F.col("cap") / F.col("w"))
    order = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.lit(float(share)) * F.sum("source_size").over(whole)
    per = per.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest))
    level = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "level"))).over(whole)["level"]
    per = per.withColumn("target", F.least(F.col("cap"), F.coalesce(level * F.col("w"), F.col("cap"))))
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(0)
    return per.select(
        "src", "source_size", "target", epochs.cast("long").alias("epochs"),
        (budget - epochs * F.col("source_size")).cast("long").alias("rest"),
        F.ceil(F.col("n") / RANGE_ROWS).cast("long").alias("n_ranges"),
    )


def random_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix:") -> DataFrame:
    """Rows of docs (doc_id, text, source) with what the mix takes of them.

    Returns doc_id, source, size, source_size, target, epochs (whole copies), part (words of one
    more copy) and taken = epochs * size + part.
    """
    src = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    sized = save(docs.select("doc_id", "source", src.alias("src"), random_key(F.col("doc_id"), seed).alias("key"), n_words(F.col("text")).alias("size")), "mix-sized")
    per = save(source_targets(sized, weights, share, most), "mix-sources")
    unit = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
    keyed = sized.join(per, "src").withColumn("range", F.floor(unit * F.col("n_ranges")))
    ranges = keyed.groupBy("src", "range").agg(F.sum("size").alias("in_range"))
    upto = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("src", "range", F.coalesce(F.sum("in_range").over(upto), F.lit(0)).alias("start"))
    inside = Window.partitionBy("src", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.join(starts, ["src", "range"]).withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before"))).cast("long")
    return placed.select("doc_id", "source", "size", "source_size", "target", "epochs", part.alias("part"), (F.col("epochs") * F.col("size") + part).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: docs repeated for each whole epoch, and cut after `part` words for the last.

    Rows that repeat an id with the same size and source are numbered, and each takes a share of the plan of its own.
    Returns the columns of docs; n_chars, where there is one, follows the cut texts.
    """
    named = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    plan = mix_plan(docs, **options).select(F.col("doc_id").alias("_pid"), named.alias("_psrc"), F.col("size").alias("_psize"), "epochs", "part")
    turn = Window.partitionBy("_pid", "_psrc", "_psize").orderBy(F.desc("epochs"), F.desc("part"))
    plan = plan.select("_pid", "_psrc", "_psize", F.col("epochs").alias("_epochs"), F.col("part").alias("_part"), F.row_number().over(turn).alias("_pturn"))
    keyed = docs.select(packed(docs), named.alias("_src"), n_words(F.col("text")).alias("_size"), F.col("doc_id").alias("_id"))
    keyed = keyed.withColumn("_turn", F.row_number().over(Window.partitionBy("_id", "_src", "_size").orderBy("row.text")))
    both = keyed.join(plan, F.col("_id").eqNullSafe(F.col("_pid")) & (F.col("_src") == F.col("_psrc")) & (F.col("_size") == F.col("_psize")) & (F.col("_turn") == F.col("_pturn")))
    copies = F.concat(F.array_repeat(F.col("_size"), F.col("_epochs").cast("int")), F.when(F.col("_part") > 0, F.array(F.col("_part"))).otherwise(F.array().cast("array<bigint>")))
    out = both.withColumn("_words", F.explode(copies))
    cut = F.array_join(F.slice(F.regexp_extract_all("row.text", F.lit(r"[^\x20\x09-\x0D]+"), 0), 1, F.col("_words").cast("int")), " ")
    text = F.when(F.col("_words") < F.col("_size"), cut).otherwise(F.col("row.text"))
    out = out.select(F.col("row").withField("text", text).alias("row")).select("row.*")
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS INT)] AS w, 2.0::DOUBLE * source_size AS cap FROM per),
levels AS (SELECT *, cap / w AS ratio,
   (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
   / sum(w) OVER (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
target AS (SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, ratio) FROM levels WHERE ratio >= level) * w, cap)) AS target FROM levels),
budget AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS b, CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS epochs FROM target),
placed AS (SELECT s.doc_id, s.size, t.source_size, t.target, t.epochs, t.b - t.epochs * t.source_size AS rest,
   coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY key, doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
   FROM sized s JOIN budget t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM placed
"""
