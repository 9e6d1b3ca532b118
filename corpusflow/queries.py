"""The registered queries: each applies operators to the test tables, with its SQL twin beside it.

The tables hold no manuals, so events, orders and line items stand for pages of documents, texts for page
texts, web pages for layouts, and conversations for ordered blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.operators import adapting, assembly, navigation, ordered, planning, quality, rendering, sampling, semantics
from corpusflow.sources import writers

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = lambda spark, sf_dir: function(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


def big(c):
    return F.col(c).cast("long") if isinstance(c, str) else c.cast("long")


#: Bytes of a table, as the optimizer estimates them, that spread() deals to a task at most.
SPREAD_BYTES = 4 << 20


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by its keys to as many tasks as a shuffle has, and one for every SPREAD_BYTES at least, for work that is long for its bytes:
    a file of a few MB is one task else, however many rows it has. Groups by these keys need no other shuffle."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(n, size // SPREAD_BYTES if size < 1 << 50 else 0), *keys)  # beyond, nothing is known of the size


#: Rows of a table that tasks_for() reckons a task with at most.
TASK_ROWS = 1 << 18


def tasks_for(table: DataFrame) -> int:
    """Tasks for work that holds a task's rows in memory: as many as a shuffle has, and one for every TASK_ROWS at least. A table's rows are
    counted by its footers; shuffled bytes say little of them, as keys in a row compress well."""
    n = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(n, -(-table.count() // TASK_ROWS))


def manual_pages(t) -> DataFrame:
    """events as documents (user_id) of pages, some with a printed number."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    page = big(F.row_number().over(w))
    e = t("events").select("user_id", "event_id", "ts", "event_type", "value", page.alias("page"))
    known = F.when((F.col("event_type") == "purchase") | (F.col("event_id") % 3 == 0), F.col("page") + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0))
    return e.withColumns({"known": known, "is_start": F.col("event_type") == "signup"})


MANUAL = """
mp AS (SELECT user_id, event_id, ts, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS page FROM events),
manual AS (SELECT *, CASE WHEN event_type = 'purchase' OR event_id % 3 = 0 THEN page + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END END AS known, event_type = 'signup' AS is_start FROM mp)"""
FILLED = (
    MANUAL
    + """,
near AS (SELECT *, last_value(CASE WHEN known IS NOT NULL THEN page END IGNORE NULLS) OVER b AS pp, last_value(known IGNORE NULLS) OVER b AS pk,
  first_value(CASE WHEN known IS NOT NULL THEN page END IGNORE NULLS) OVER a AS np, first_value(known IGNORE NULLS) OVER a AS nk FROM manual
  WINDOW b AS (PARTITION BY user_id ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY user_id ORDER BY page ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (SELECT *, CASE WHEN known IS NOT NULL THEN known WHEN np - pp = nk - pk THEN pk + page - pp END AS filled,
  CASE WHEN known IS NOT NULL THEN 'footer' WHEN np - pp = nk - pk THEN 'interpolated' END AS evidence FROM near)"""
)


@query("""WITH l AS (SELECT doc_id, regexp_replace(x, '\\s+$', '') AS x FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents) WHERE regexp_matches(x, '\\S'))
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(length(x)) AS BIGINT) AS n_chars FROM l GROUP BY doc_id""")
def q01_page_lines(t):
    lines = navigation.page_lines(t("documents").select("doc_id", "text"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), big(F.sum(F.length("line"))).alias("n_chars"))


@query("""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '\\s+$', '')), lambda x: x <> '') AS ls FROM documents),
e AS (SELECT doc_id, CASE WHEN regexp_matches(ls[-1], '^[A-Z][a-z]+ [a-z]') THEN ls[-1] WHEN regexp_matches(ls[-2], '^[A-Z][a-z]+ [a-z]') THEN ls[-2] END AS line FROM l)
SELECT doc_id, regexp_extract(line, '^[A-Z][a-z]+') AS first_word, CAST(length(line) AS BIGINT) AS n_chars FROM e WHERE line IS NOT NULL""")
def q02_edge_line_scan(t):
    pattern = "^[A-Z][a-z]+ [a-z]"
    d = t("documents").select("doc_id", navigation.edge_match(X.logical_lines(F.col("text")), pattern).alias("line"))
    return d.where("line is not null").select("doc_id", F.regexp_extract("line", "^[A-Z][a-z]+", 0).alias("first_word"), big(F.length("line")).alias("n_chars"))


@query(f"WITH {FILLED} SELECT user_id, page, filled, evidence FROM filled")
def q03_pagemap_interpolate(t):
    return navigation.interpolate(manual_pages(t), ["user_id"], "page").select("user_id", "page", "filled", "evidence")


@query(f"""WITH {FILLED}, s AS (SELECT user_id, page, filled, is_start, lag(page) OVER w AS previous_page, lag(filled) OVER w AS previous_label, lag(is_start) OVER w AS ps FROM filled WHERE filled IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY page))
SELECT user_id, page, filled, previous_page, previous_label FROM s WHERE previous_label >= filled AND NOT is_start AND NOT ps""")
def q04_monotone_check(t):
    pages = navigation.interpolate(manual_pages(t), ["user_id"], "page")
    return navigation.monotone_breaks(pages, ["user_id"], "page").select("user_id", "page", "filled", "previous_page", "previous_label")


def section_starts(t) -> DataFrame:
    """orders of a customer as pages; a section starts where the status changes."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = t("orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", big(F.row_number().over(w)).alias("page"), big(F.count("*").over(Window.partitionBy("o_custkey"))).alias("pages"))
    changed = ~F.col("o_orderstatus").eqNullSafe(F.lag("o_orderstatus").over(Window.partitionBy("o_custkey").orderBy("page")))
    return o.withColumn("starts", changed | (F.col("page") == 1))


STARTS = """
o AS (SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, row_number() OVER w AS page, count(*) OVER (PARTITION BY o_custkey) AS pages, lag(o_orderstatus) OVER w AS before FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
ranges AS (SELECT o_custkey, o_orderstatus, page AS start_page, greatest(page, coalesce(lead(page) OVER (PARTITION BY o_custkey ORDER BY page), pages)) AS end_page FROM o WHERE page = 1 OR before IS DISTINCT FROM o_orderstatus)"""


def ranges(t) -> DataFrame:
    s = section_starts(t).where("starts").withColumnRenamed("page", "start_page")
    return navigation.section_ranges(s, ["o_custkey"], ["start_page"], "start_page", "pages").select("o_custkey", "o_orderstatus", "start_page", "end_page")


@query(f"WITH {STARTS} SELECT o_custkey, o_orderstatus, start_page, end_page FROM ranges")
def q05_section_ranges(t):
    return ranges(t)


@query(f"""WITH {STARTS}, p AS (SELECT o_custkey, start_page, unnest(range(start_page, end_page + 1)) AS page FROM ranges)
SELECT o_custkey, page, CAST(count(*) AS BIGINT) AS n_owners, min(start_page) AS first_owner FROM p GROUP BY o_custkey, page HAVING count(*) > 1""")
def q06_shared_pages(t):
    claims = ranges(t).withColumn("page", F.explode(F.sequence("start_page", "end_page")))
    shared = assembly.shared_pages(claims, "o_custkey", "page", "start_page")
    return shared.select("o_custkey", "page", big(F.size("owners")).alias("n_owners"), F.get("owners", F.lit(0)).alias("first_owner"))


BATCHES = """
p AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem),
i AS (SELECT *, CASE WHEN l_linenumber - lag(l_linenumber) OVER w = 1 THEN 0 ELSE 1 END AS o FROM p WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)),
s AS (SELECT l_orderkey, l_linenumber, sum(o) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS island FROM i),
b AS (SELECT l_orderkey, l_linenumber, CAST(island AS BIGINT) AS island, CAST((row_number() OVER (PARTITION BY l_orderkey, island ORDER BY l_linenumber) - 1) // 2 AS INT) AS slice FROM s)"""


def batches(t) -> DataFrame:
    pages = planning.plan_pages(t("lineitem"), "l_orderkey", "l_linenumber")
    return planning.plan_batches(pages, "l_orderkey", "l_linenumber", most=2).withColumn("island", big("island"))


@query(f"WITH {BATCHES} SELECT l_orderkey, island, slice, CAST(count(*) AS BIGINT) AS pages, min(l_linenumber) AS first_page, max(l_linenumber) AS last_page FROM b GROUP BY ALL")
def q07_plan_batches(t):
    return batches(t).groupBy("l_orderkey", "island", "slice").agg(F.count("*").alias("pages"), F.min("l_linenumber").alias("first_page"), F.max("l_linenumber").alias("last_page"))


@query(f"WITH {BATCHES} SELECT l_orderkey, l_linenumber, island, slice FROM b WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') ORDER BY l_orderkey, l_linenumber LIMIT 100")
def q08_plan_limit(t):
    keys = t("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return planning.limit_plan(batches(t), ["l_orderkey", "l_linenumber"], 100, keys, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "island", "slice")


@query("""SELECT o_orderkey, o_orderstatus FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_linestatus IS NOT DISTINCT FROM o.o_orderstatus)""")
def q09_cache_pending(t):
    state = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus"))
    return planning.pending(t("orders").select("o_orderkey", "o_orderstatus"), state, ["o_orderkey"], ["o_orderstatus"])


@query("""WITH l AS (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r FROM lineitem GROUP BY 1),
s AS (SELECT o_orderpriority, CASE WHEN r = 1 THEN 'failed' WHEN l_orderkey IS NOT NULL THEN 'completed' ELSE 'missing' END AS status FROM orders LEFT JOIN l ON l_orderkey = o_orderkey)
SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS pages, CAST(count(*) FILTER (status = 'completed') AS BIGINT) AS completed, CAST(count(*) FILTER (status = 'failed') AS BIGINT) AS failed, CAST(count(*) FILTER (status = 'missing') AS BIGINT) AS missing FROM s GROUP BY ROLLUP (o_orderpriority)""")
def q10_coverage_rollup(t):
    lines = t("lineitem").groupBy("l_orderkey").agg(F.max(F.col("l_returnflag") == "R").alias("returned"))
    o = t("orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    status = planning.coverage_status(F.coalesce("returned", F.lit(False)), F.col("l_orderkey").isNotNull())
    return planning.coverage(o.select("o_orderpriority", status.alias("status")), ["o_orderpriority"])


ISSUES = """
issues AS (SELECT CASE event_type WHEN 'error' THEN 'error' ELSE 'info' END AS severity, upper(event_type) AS code FROM events WHERE event_type IN ('error', 'click')
UNION ALL SELECT 'warning', 'ORDER_' || o_orderstatus FROM orders WHERE o_orderstatus <> 'O'
UNION ALL SELECT 'warning', 'RETURNED' FROM lineitem WHERE l_returnflag = 'R')"""


@query(f"WITH {ISSUES} SELECT severity, code, CAST(count(*) AS BIGINT) AS issues FROM issues GROUP BY ROLLUP (severity, code)")
def q11_issue_inventory(t):
    a = t("events").where("event_type in ('error', 'click')").select(F.when(F.col("event_type") == "error", "error").otherwise("info").alias("severity"), F.upper("event_type").alias("code"))
    b = t("orders").where("o_orderstatus != 'O'").select(F.lit("warning").alias("severity"), F.concat(F.lit("ORDER_"), "o_orderstatus").alias("code"))
    c = t("lineitem").where("l_returnflag = 'R'").select(F.lit("RETURNED").alias("code"), F.lit("warning").alias("severity"))
    return quality.issue_counts(quality.issue_inventory(a, b, c))


@query("""WITH r AS (SELECT o_custkey, max(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE 3 END) AS k FROM orders GROUP BY 1)
SELECT c_custkey, CASE k WHEN 1 THEN 'info' WHEN 2 THEN 'warning' WHEN 3 THEN 'error' END AS worst, CASE WHEN k IS NULL THEN 'failed' WHEN k > 1 THEN 'warning' ELSE 'success' END AS status FROM customer LEFT JOIN r ON o_custkey = c_custkey""")
def q12_status_rollup(t):
    severity = F.when(F.col("o_orderstatus") == "O", "info").when(F.col("o_orderstatus") == "P", "warning").otherwise("error")
    per = t("orders").groupBy("o_custkey").agg(F.max(quality.severity_rank(severity)).alias("k"))
    c = t("customer").select("c_custkey").join(per, F.col("o_custkey") == F.col("c_custkey"), "left")
    return c.select("c_custkey", quality.worst(F.col("k")).alias("worst"), quality.entry_status(F.col("k").isNotNull(), F.col("k") > 1).alias("status"))


#: Tokens in a row that make an item and a document a pair to compare.
SHARED_RUN = 8
RECALL = """
bl AS (SELECT item_id, regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[a-z0-9]+(?:[._-][a-z0-9]+)*') AS ts FROM benchmark),
dl AS (SELECT doc_id, regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[a-z0-9]+(?:[._-][a-z0-9]+)*') AS ts FROM documents),
bt AS (SELECT item_id, unnest(ts) AS token, unnest(range(len(ts))) AS pos FROM bl), dt AS (SELECT doc_id, unnest(ts) AS token FROM dl),
b AS (SELECT item_id, token, count(*) AS n, min(pos) AS first FROM bt GROUP BY ALL), d AS (SELECT doc_id, token, count(*) AS n FROM dt GROUP BY ALL),
br AS (SELECT DISTINCT item_id, array_to_string(ts[i:i + 7], ' ') AS run FROM (SELECT item_id, ts, unnest(range(1, len(ts) - 6)) AS i FROM bl)),
dr AS (SELECT DISTINCT doc_id, array_to_string(ts[i:i + 7], ' ') AS run FROM (SELECT doc_id, ts, unnest(range(1, len(ts) - 6)) AS i FROM dl)),
pairs AS (SELECT DISTINCT item_id, doc_id FROM br JOIN dr USING (run))"""


def recall_parts(t):
    """The pairs that share a run of SHARED_RUN tokens, however many share it, and token tables of their items and documents.

    The pairs are looked for once and kept, as they say whose tokens are wanted."""
    pairs = writers.settled(quality.shared_runs(t("benchmark"), t("documents"), "item_id", "doc_id", "text", SHARED_RUN))
    met = lambda name, key: quality.token_table(t(name).join(pairs.select(key).distinct(), key, "left_semi"), [key], "text")
    return met("benchmark", "item_id"), met("documents", "doc_id"), pairs


@query(f"""WITH {RECALL}, o AS (SELECT item_id, doc_id, sum(least(b.n, d.n)) AS overlap FROM pairs JOIN b USING (item_id) JOIN d USING (doc_id, token) GROUP BY ALL),
bs AS (SELECT item_id, sum(n) AS n FROM b GROUP BY 1), ds AS (SELECT doc_id, sum(n) AS n FROM d GROUP BY 1)
SELECT item_id, doc_id, CAST(overlap AS BIGINT) AS overlap, round(overlap / bs.n, 6) AS item_recall, round(overlap / ds.n, 6) AS doc_recall FROM o JOIN bs USING (item_id) JOIN ds USING (doc_id)""")
def q13_token_recall(t):
    out = quality.token_recall(*recall_parts(t), "item_id", "doc_id")
    return out.select("item_id", "doc_id", big("overlap"), F.round("a_recall", 6).alias("item_recall"), F.round("b_recall", 6).alias("doc_recall"))


@query(f"""WITH {RECALL}, m AS (SELECT pairs.item_id, pairs.doc_id, b.token, b.first, b.n - coalesce(d.n, 0) AS missing FROM pairs JOIN b ON b.item_id = pairs.item_id LEFT JOIN d ON d.doc_id = pairs.doc_id AND d.token = b.token),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id, doc_id ORDER BY missing DESC, first) AS rank FROM m WHERE missing > 0)
SELECT item_id, doc_id, CAST(rank AS INT) AS rank, token, CAST(missing AS BIGINT) AS missing FROM r WHERE rank <= 20""")
def q14_missing_tokens(t):
    return quality.missing_tokens(*recall_parts(t), "item_id", "doc_id")


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
s AS (SELECT doc_id, pos, trim(regexp_replace(x, '\\s+', ' ', 'g')) AS sig FROM l), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, sig ORDER BY pos) AS k FROM s)
SELECT doc_id, CAST(count(*) AS BIGINT) AS kept, CAST(sum(pos) AS BIGINT) AS places FROM r WHERE k = 1 OR sig = '' GROUP BY doc_id""")
def q15_dedupe_keep_first(t):
    lines = t("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    kept = ordered.keep_first(lines, ["doc_id"], ["at"], X.collapse(F.col("line")))
    return kept.groupBy("doc_id").agg(F.count("*").alias("kept"), big(F.sum("at")).alias("places"))


@query("""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z0-9]+')) AS w FROM documents), g AS (SELECT replace(lower(w), 'o', '0') AS folded, count(*) AS n, min(w) AS least, max(w) AS greatest FROM w GROUP BY 1)
SELECT folded, CAST(n AS BIGINT) AS spellings, least, greatest FROM g WHERE n > 1""")
def q16_confusable(t):
    words = t("documents").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z0-9]+"), 0)).alias("w")).distinct()
    g = quality.confusable_groups(words, "w")
    return g.select("folded", big(F.size("spellings")).alias("spellings"), F.array_min("spellings").alias("least"), F.array_max("spellings").alias("greatest"))


CATALOG = "c AS (SELECT DISTINCT upper(replace(p_type, ' ', '_')) || '_' || p_size AS name FROM part), t AS (SELECT p_partkey, regexp_replace(upper(replace(p_type, ' ', '_')) || '_' || p_size, 'O', '0') AS title FROM part)"


@query(f"""WITH {CATALOG}, n AS (SELECT DISTINCT title, name, title = name AS same FROM (SELECT DISTINCT title FROM t) JOIN c ON replace(title, 'O', '0') = replace(name, 'O', '0') WHERE levenshtein(title, name) <= 1),
g AS (SELECT title, bool_or(same) AS has, count(*) AS n, min(CASE WHEN NOT same THEN name END) AS other FROM n GROUP BY 1)
SELECT p_partkey, t.title, CASE WHEN has THEN t.title WHEN n = 1 THEN other END AS matched, CASE WHEN has THEN 'exact' WHEN n = 1 THEN 'confusable' END AS how FROM t LEFT JOIN g ON g.title = t.title""")
def q17_o0_unique_match(t):
    name = F.concat(F.upper(F.replace("p_type", F.lit(" "), F.lit("_"))), F.lit("_"), F.col("p_size").cast("string"))
    p = t("part").select("p_partkey", name.alias("name"))
    titles = p.select("p_partkey", F.concat(F.substring_index("name", "O", 1), F.when(F.contains("name", F.lit("O")), F.concat(F.lit("0"), F.substring(F.col("name"), F.length(F.substring_index("name", "O", 1)) + 2, F.length("name")))).otherwise("")).alias("title"))
    return semantics.match_variables(titles, p.select("name"), "title", "name").select("p_partkey", "title", "matched", "how")


@query("""WITH c AS (SELECT DISTINCT p_brand AS member, regexp_extract(p_brand, '^(.*?)(\\d+)$', 1) AS prefix, TRY_CAST(regexp_extract(p_brand, '^(.*?)(\\d+)$', 2) AS INT) AS no FROM part)
SELECT prefix, CAST(count(*) AS BIGINT) AS n_members, string_agg(member, ',' ORDER BY no, member) AS members FROM c WHERE no IS NOT NULL GROUP BY prefix""")
def q18_family_expand(t):
    brands = t("part").select("p_brand")
    labels = brands.select(F.regexp_extract("p_brand", r"^(.*?)(\d+)$", 1).alias("prefix")).distinct()
    out = semantics.numbered_family(labels, brands, "prefix", "p_brand")
    return out.select("prefix", big(F.size("members")).alias("n_members"), F.array_join("members", ",").alias("members"))


@query("""SELECT l_returnflag AS flag, 'QTY' AS variable, 'GE.' AS operator, CAST(CAST(l_quantity AS INT) AS VARCHAR) || '|' || l_linenumber AS operands, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY ALL
UNION ALL SELECT l_returnflag, 'TAX', '=', l_linestatus, CAST(count(*) AS BIGINT) FROM lineitem GROUP BY ALL""")
def q19_conditions(t):
    text = F.concat(F.lit("if QTY GE."), F.col("l_quantity").cast("int").cast("string"), F.lit(" or "), F.col("l_linenumber").cast("string"), F.lit(", and TAX = "), "l_linestatus", F.lit("."))
    c = t("lineitem").select(F.col("l_returnflag").alias("flag"), F.explode(X.conditions(text)).alias("c"))
    return c.groupBy("flag", "c.variable", F.upper("c.operator").alias("operator"), F.array_join("c.values", "|").alias("operands")).agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT doc_id, len(regexp_extract_all(text, '(?i)the')) AS cards, len(regexp_extract_all(text, '[0-9]+')) AS conditions, length(text) - length(replace(text, '=', '')) AS formulas, len(regexp_extract_all(text, chr(10))) + 1 AS lines FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))
SELECT doc_id, CAST(cards AS BIGINT) AS cards, CAST(conditions AS BIGINT) AS conditions, CAST(formulas AS BIGINT) AS formulas,
concat_ws(',', CASE WHEN cards > 1 THEN 'cards' END, CASE WHEN conditions > 0 THEN 'conditions' END, CASE WHEN formulas > 0 THEN 'formulas' END) AS flags, CASE WHEN lines <= 2 THEN 'short' WHEN lines <= 6 THEN 'medium' ELSE 'long' END AS bucket FROM s""")
def q20_feature_flags(t):
    count = lambda p: F.regexp_count("text", F.lit(p))
    d = t("documents").withColumn("text", F.coalesce("text", F.lit(""))).select("doc_id", count("(?i)the").alias("cards"), count("[0-9]+").alias("conditions"), sampling.signals(F.col("text"))["formulas"].alias("formulas"), (count("\n") + 1).alias("lines"))
    named = sampling.flags({"cards": F.col("cards") > 1, "conditions": F.col("conditions") > 0, "formulas": F.col("formulas") > 0})
    return d.select("doc_id", big("cards"), big("conditions"), big("formulas"), F.array_join(named, ",").alias("flags"), X.length_bucket(F.col("lines")).alias("bucket"))


def stratified(t, seed: int) -> DataFrame:
    d = t("documents").select("doc_id", F.coalesce("lang", F.lit("none")).alias("lang"), X.length_bucket(F.col("n_chars"), 800, 2400).alias("bucket"))
    return sampling.section_sample(d, "lang", "bucket", F.col("doc_id").cast("string"), seed)


def strata_sql(name: str, seed: int) -> str:
    return f"""{name} AS (SELECT * FROM (SELECT doc_id, lang, bucket, row_number() OVER (PARTITION BY lang, bucket ORDER BY sha256('{seed}:' || lang || ':' || bucket || ':' || doc_id)) AS pick
FROM (SELECT doc_id, coalesce(lang, 'none') AS lang, CASE WHEN n_chars <= 800 THEN 'short' WHEN n_chars <= 2400 THEN 'medium' ELSE 'long' END AS bucket FROM documents)) WHERE pick <= CASE bucket WHEN 'medium' THEN 4 ELSE 3 END)"""


@query(f"WITH {strata_sql('s', sampling.SEED)} SELECT doc_id, lang, bucket, CAST(pick AS INT) AS pick FROM s")
def q21_stratified_sample(t):
    return stratified(t, sampling.SEED).select("doc_id", "lang", "bucket", "pick")


@query(f"WITH {strata_sql('a', sampling.SEED)}, {strata_sql('b', sampling.HOLDOUT_SEED)} SELECT doc_id, lang, bucket FROM b WHERE doc_id NOT IN (SELECT doc_id FROM a)")
def q22_holdout(t):
    return sampling.holdout(stratified(t, sampling.HOLDOUT_SEED), stratified(t, sampling.SEED), ["doc_id"]).select("doc_id", "lang", "bucket")


@query("""WITH c AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS pos, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
SELECT conv_id, turn FROM c WHERE n <= 3 OR pos IN (0, CAST(floor((n - 1) / 2.0 + 0.5) AS BIGINT), n - 1)""")
def q23_even_sample(t):
    return ordered.even_sample(t("conversations"), ["conv_id"], ["turn", "role", "text"], 3).select("conv_id", "turn")


@query(f"""WITH {MANUAL}, p AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n, row_number() OVER (PARTITION BY user_id, event_type ORDER BY page) AS k FROM manual),
c AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY page) AS r FROM p WHERE page <= 3 OR page = n OR page IN (n // 4 + 1, n // 2 + 1, 3 * n // 4 + 1) OR k <= 2)
SELECT user_id, page, event_type FROM c WHERE r <= 24""")
def q24_review_pages(t):
    return ordered.review_places(manual_pages(t), ["user_id"], "page", "event_type").select("user_id", "page", "event_type")


@query("""SELECT doc_id, 'missing' AS finding FROM (SELECT DISTINCT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))
UNION ALL SELECT doc_id, 'unlisted' FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
UNION ALL SELECT doc_id, 'duplicate' FROM labels GROUP BY doc_id HAVING count(*) > 1""")
def q25_reconcile(t):
    return quality.reconcile(t("labels"), t("documents"), "doc_id")


@query("""WITH p AS (SELECT source, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS path, coalesce(text, '') AS text FROM documents),
r AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY path) - 1) // 20 AS range FROM p), d AS (SELECT source, range, count(*) AS n, sha256(string_agg(path || chr(9) || sha256(text) || chr(10), '' ORDER BY path)) AS d FROM r GROUP BY source, range)
SELECT source, CAST(sum(n) AS BIGINT) AS members, sha256(string_agg(d, '' ORDER BY range)) AS digest FROM d GROUP BY source""")
def q26_tree_digest(t):
    d = t("documents").select("source", F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"), F.coalesce("text", F.lit("")).alias("text"))
    return quality.ordered_digest(d, ["source"], "path", "text", 20)


REQUIREMENTS = [("error", None, 1), ("click", 3, 1), ("purchase", 5, 100000), (None, 7, 2), ("none", None, 1)]


@query("""WITH r(event_type, day, minimum) AS (VALUES ('error', NULL, 1), ('click', 3, 1), ('purchase', 5, 100000), (NULL, 7, 2), ('none', NULL, 1)),
e AS (SELECT event_type, CAST(user_id % 10 AS INT) AS day FROM events)
SELECT r.event_type, CAST(r.day AS INT) AS day, CAST(r.minimum AS INT) AS minimum, CAST(count(e.event_type) AS BIGINT) AS found, count(e.event_type) >= r.minimum AS met FROM r LEFT JOIN e ON (r.event_type IS NULL OR r.event_type = e.event_type) AND (r.day IS NULL OR r.day = e.day) GROUP BY r.event_type, r.day, r.minimum""")
def q27_required_evidence(t):
    e = t("events").select(F.col("event_type").alias("e_type"), (F.col("user_id") % 10).cast("int").alias("e_day"))
    r = e.sparkSession.createDataFrame(REQUIREMENTS, "event_type string, day int, minimum int")
    return quality.required_evidence(e, r, {"event_type": "e_type", "day": "e_day"})


@query("""WITH m AS (SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n, max(o_orderkey) AS latest FROM orders GROUP BY ALL),
b AS (SELECT o_orderstatus, o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN n + 1 ELSE n END AS n, latest FROM m WHERE o_orderpriority <> '5-LOW')
SELECT m.o_orderstatus, m.o_orderpriority, m.n, m.latest, CASE WHEN m.n IS NOT DISTINCT FROM b.n AND m.latest IS NOT DISTINCT FROM b.latest AND b.o_orderstatus IS NOT NULL THEN 'reviewed' ELSE 'pending' END AS review FROM m LEFT JOIN b USING (o_orderstatus, o_orderpriority)""")
def q28_baseline_identity(t):
    m = t("orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("latest"))
    b = m.where("o_orderpriority != '5-LOW'").withColumns({"n": F.when(F.col("o_orderstatus") == "P", F.col("n") + 1).otherwise(F.col("n")), "review": F.lit("reviewed")})
    return quality.review_status(m, b, ["o_orderstatus", "o_orderpriority"], ["n", "latest"])


@query("""SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS owner FROM conversations""")
def q29_ownership_fill(t):
    c = ordered.owned_by_anchor(t("conversations"), ["conv_id"], ["turn", "role", "text"], F.col("role") == "user", F.col("turn"))
    return c.select("conv_id", "turn", "role", "owner")


@query(f"""WITH {MANUAL}, c AS (SELECT *, CASE WHEN lag(event_type) OVER w IS DISTINCT FROM event_type OR page = 1 THEN 1 ELSE 0 END AS c FROM manual WINDOW w AS (PARTITION BY user_id ORDER BY page)),
i AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY page) AS island FROM c)
SELECT user_id, CAST(island AS BIGINT) AS island, event_type, min(page) AS anchor, CAST(count(*) AS BIGINT) AS run FROM i GROUP BY ALL""")
def q30_contiguous_anchor(t):
    i = ordered.islands(manual_pages(t), ["user_id"], ["page"], F.col("event_type"))
    return i.groupBy("user_id", big("island").alias("island"), "event_type").agg(F.min("page").alias("anchor"), F.count("*").alias("run"))


@query("""WITH l AS (SELECT conv_id, turn, role, text, CASE WHEN length(text) % 11 = 0 THEN 'remarks' WHEN length(text) % 13 = 0 THEN 'references' WHEN length(text) % 3 = 0 THEN 'cards' WHEN length(text) % 5 = 0 THEN 'purpose' END AS label FROM conversations)
SELECT conv_id, turn, role, coalesce(last_value(CASE WHEN label IN ('references', 'remarks') THEN label END IGNORE NULLS) OVER w, last_value(label IGNORE NULLS) OVER w) AS state FROM l
WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q31_region_state(t):
    n = F.length("text")
    label = F.when(n % 11 == 0, "remarks").when(n % 13 == 0, "references").when(n % 3 == 0, "cards").when(n % 5 == 0, "purpose")
    return ordered.absorbing_state(t("conversations"), ["conv_id"], ["turn", "role", "text"], label, semantics.ABSORBING).select("conv_id", "turn", "role", "state")


NUMBERED_LINES = """f AS (SELECT l_orderkey, l_returnflag, CAST(l_quantity AS INT) AS q, l_linestatus, 1 AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS l_linenumber FROM lineitem)"""


def numbered_lines(t) -> DataFrame:
    """All lines, numbered anew in each order, as numbers repeat there."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    return t("lineitem").withColumn("l_linenumber", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order)))


@query(f"WITH {NUMBERED_LINES} SELECT l_orderkey, l_linenumber AS slot, l_returnflag AS variable, l_linestatus AS field_type, CAST(q AS VARCHAR) AS default_value FROM f WHERE k = 1")
def q32_unpivot_slots(t):
    f = numbered_lines(t).select("l_orderkey", F.col("l_linenumber").alias("slot"), F.col("l_returnflag").alias("variable"), F.col("l_linestatus").alias("type"), F.col("l_quantity").cast("int").cast("string").alias("default"))
    cells = f.unpivot(["l_orderkey", "slot"], ["variable", "type", "default"], "label", "value")
    return semantics.slot_fields(cells, ["l_orderkey"]).select("l_orderkey", "slot", "variable", "field_type", F.col("default").alias("default_value"))


@query(f"""WITH {NUMBERED_LINES}, a AS (SELECT l_orderkey, l_linenumber, CASE WHEN q % 3 > 0 THEN l_returnflag END AS variable, CASE WHEN q % 2 = 0 THEN q END AS size FROM f WHERE k = 1 AND l_linenumber % 3 <> 0),
b AS (SELECT l_orderkey, l_linenumber, l_linestatus AS variable, q + 1000 AS size FROM f WHERE k = 1 AND l_linenumber % 2 = 1)
SELECT l_orderkey, l_linenumber, coalesce(a.variable, b.variable) AS variable, CAST(coalesce(a.size, b.size) AS INT) AS size, a.variable IS NULL AND b.variable IS NOT NULL AS variable_added FROM a FULL JOIN b USING (l_orderkey, l_linenumber)""")
def q33_coalesce_merge(t):
    f = numbered_lines(t).withColumn("q", F.col("l_quantity").cast("int"))
    a = f.where("l_linenumber % 3 != 0").select("l_orderkey", "l_linenumber", F.when(F.col("q") % 3 > 0, F.col("l_returnflag")).alias("variable"), F.when(F.col("q") % 2 == 0, F.col("q")).alias("size"))
    b = f.where("l_linenumber % 2 = 1").select("l_orderkey", "l_linenumber", F.col("l_linestatus").alias("variable"), (F.col("q") + 1000).alias("size"))
    return semantics.merge_fields(a, b, ["l_orderkey", "l_linenumber"], ["variable", "size"]).drop("size_added")


@query(f"""WITH {MANUAL}, l AS (SELECT user_id, page, CASE WHEN event_id % 2 = 0 THEN page - 1 ELSE page - 2 END AS link FROM manual),
o AS (SELECT *, CASE WHEN link = lag(page) OVER (PARTITION BY user_id ORDER BY page) THEN 0 ELSE 1 END AS o FROM l),
c AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY page) AS chain FROM o)
SELECT user_id, CAST(chain AS BIGINT) AS chain, CAST(count(*) AS BIGINT) AS parts, min(page) AS first_page FROM c GROUP BY ALL""")
def q34_continuation_chain(t):
    p = manual_pages(t).withColumn("link", F.when(F.col("event_id") % 2 == 0, F.col("page") - 1).otherwise(F.col("page") - 2))
    c = ordered.chains(p, ["user_id"], ["page"], "link", "page")
    return c.groupBy("user_id", big("chain").alias("chain")).agg(F.count("*").alias("parts"), F.min("page").alias("first_page"))


@query()
def q35_html_blocks(t):
    """Blocks of web pages by type; HTML has no SQL twin."""
    b = t("pages").select("page_id", F.explode(adapting.page_tags(F.col("html"))).alias("b"))
    return b.groupBy("page_id", "b.type").agg(F.count("*").alias("n_blocks"), big(F.sum(F.length("b.text"))).alias("n_chars"))


@query()
def q36_table_span_grid(t):
    """HTML tables made of order lines, with spans: their cells, widths and grids; SQL cannot lay out spans."""
    cell = F.concat(F.lit("<td rowspan='"), (F.col("l_linenumber") % 2 + 1).cast("string"), F.lit("' colspan="), (F.col("l_quantity").cast("int") % 3 + 1).cast("string"), F.lit(">"), "l_returnflag", F.lit("<br>"), F.col("l_linenumber").cast("string"), F.lit("</td>"))
    rows = numbered_lines(t).groupBy("l_orderkey", (F.col("l_linenumber") % 3).alias("r")).agg(F.concat(F.lit("<tr>"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", cell.alias("c")))), lambda x: x["c"]), ""), F.lit("</tr>")).alias("tr"))
    html = rows.groupBy("l_orderkey").agg(F.concat(F.lit("<table>"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "tr"))), lambda x: x["tr"]), ""), F.lit("</table>")).alias("html"))
    parsed = html.select("l_orderkey", adapting.html_table("html").alias("t"))
    grid = adapting.grid(F.col("t.rows"))
    return parsed.select("l_orderkey", F.size(F.flatten("t.rows")).alias("n_cells"), F.array_join(F.transform(adapting.row_widths(F.col("t.rows")), lambda x: x.cast("string")), ",").alias("widths"), F.sha2(F.to_json(grid).cast("binary"), 256).alias("grid_sha256"))


@query("""WITH p AS (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL), d AS (SELECT l_orderkey, min(l_linenumber) AS lo, max(l_linenumber) AS hi, count(*) AS n FROM p GROUP BY 1)
SELECT l_orderkey AS document, CAST(NULL AS BIGINT) AS section, 'PAGEMAP_PDF_SEQUENCE_INVALID' AS code FROM d WHERE lo <> 1 OR hi <> n
UNION ALL SELECT o_custkey, o_orderkey, 'SECTION_PARENT_MISSING' FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders q WHERE q.o_custkey = o.o_custkey AND q.o_orderkey = o.o_orderkey - o.o_orderkey % 10) AND o.o_orderkey % 10 > 0""")
def q37_nav_contract(t):
    pages = quality.dealt(t("lineitem").select("l_orderkey", "l_linenumber"), tasks_for(t("lineitem")), "l_orderkey").distinct()
    a = navigation_sequence(pages)
    o = t("orders").select(F.col("o_custkey").alias("document"), F.col("o_orderkey").alias("section_id"), F.when(F.col("o_orderkey") % 10 > 0, F.col("o_orderkey") - F.col("o_orderkey") % 10).alias("parent_section_id"), F.array(F.lit(1)).alias("pages"))
    return a.union(quality.section_issues(o, ["document"], tasks=tasks_for(t("orders"))).select("document", F.col("section_id").alias("section"), "code"))


def navigation_sequence(pages: DataFrame) -> DataFrame:
    found = quality.sequence_issues(pages, ["l_orderkey"], "l_linenumber")
    return found.select(F.col("l_orderkey").alias("document"), F.lit(None).cast("long").alias("section"), "code")


@query("""SELECT r_name AS region, '| Nation | Key |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || n_name || ' | ' || n_nationkey || ' |', chr(10) ORDER BY n_nationkey) AS markdown FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY r_name""")
def q38_render_markdown(t):
    rows = t("nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("n"))
    cells = F.concat(F.array(F.array(F.lit("Nation"), F.lit("Key"))), F.transform("n", lambda x: F.array(x["n_name"], x["n_nationkey"].cast("string"))))
    joined = rows.join(t("region"), F.col("r_regionkey") == F.col("n_regionkey"))
    return joined.select(F.col("r_name").alias("region"), rendering.pipe_table(cells).alias("markdown"))


@query("""SELECT p_type AS keyword_id, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS aliases FROM part GROUP BY p_type""")
def q39_alias_invert(t):
    by_alias = t("part").groupBy(F.col("p_brand").alias("alias")).agg(F.collect_set("p_type").alias("ids"))
    return navigation.invert_aliases(by_alias).select("keyword_id", F.array_join("aliases", ",").alias("aliases"))


@query("""SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS status FROM events GROUP BY user_id""")
def q40_checkpoint_latest(t):
    return planning.latest_state(t("events"), ["user_id"], ["ts", "event_id"], ["event_type"]).select("user_id", "event_id", F.col("event_type").alias("status"))


@query("""SELECT s_suppkey AS key, upper(trim(regexp_replace(s_name, '[^A-Za-z0-9]+', '_', 'g'), '_')) AS slug, split_part(upper(trim(regexp_replace(s_name, '[^A-Za-z0-9]+', '_', 'g'), '_')), '_', 1) AS family, CAST(NULL AS INT) AS chapter, CAST(NULL AS INT) AS page FROM supplier
UNION ALL SELECT c_custkey, upper(trim(regexp_replace(c_name, '[^A-Za-z0-9]+', '_', 'g'), '_')), split_part(upper(trim(regexp_replace(c_name, '[^A-Za-z0-9]+', '_', 'g'), '_')), '_', 1), c_nationkey, CAST(c_custkey AS INT) FROM customer""")
def q41_slug(t):
    s = t("supplier").select(F.col("s_suppkey").alias("key"), X.slug(F.col("s_name")).alias("slug"), F.lit(None).cast("string").alias("printed"))
    c = t("customer").select("c_custkey", X.slug(F.col("c_name")), F.concat_ws("-", F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string")))
    chapter, page = X.chapter_and_page(F.col("printed"))
    return s.union(c).select("key", "slug", X.family(F.col("slug")).alias("family"), chapter.alias("chapter"), page.alias("page"))


@query("""WITH a AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber < 6), b AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber > 1)
SELECT l_orderkey, l_linenumber, 'lost' AS finding FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT l_orderkey, l_linenumber, 'foreign' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
UNION ALL SELECT l_orderkey, l_linenumber, 'multiple' FROM b GROUP BY ALL HAVING count(*) > 1""")
def q42_accounting(t):
    lines = t("lineitem").select("l_orderkey", "l_linenumber")
    return quality.accounting(lines.where("l_linenumber < 6").distinct(), lines.where("l_linenumber > 1"), ["l_orderkey", "l_linenumber"])


@query("""SELECT event_id, coalesce(CASE WHEN event_id % 3 = 0 THEN user_id END, c_custkey) AS pdf_page, CASE WHEN coalesce(CASE WHEN event_id % 3 = 0 THEN user_id END, c_custkey) = c_custkey THEN c_mktsegment END AS manual_page FROM events LEFT JOIN customer ON c_custkey = user_id % 50""")
def q43_issue_backfill(t):
    e = t("events").select("event_id", (F.col("user_id") % 50).alias("owner"), F.when(F.col("event_id") % 3 == 0, F.col("user_id")).alias("pdf_page"), F.lit(None).cast("string").alias("manual_page"))
    p = t("customer").select(F.col("c_custkey").alias("owner"), F.col("c_custkey").alias("pdf_page"), F.col("c_mktsegment").alias("manual_page"))
    return quality.backfill(e, p, ["owner"]).select("event_id", "pdf_page", "manual_page")


TOC_LINE = "CASE WHEN o_orderkey % 3 = 0 THEN '  Name ' || o_orderstatus || ' ..... ' || (o_orderkey % 90 + 1) || '-' || (o_orderkey % 700 + 1) WHEN o_orderkey % 3 = 1 THEN 'Held ' || o_orderkey ELSE '12 ' || o_orderkey END"


@query(f"""WITH l AS (SELECT o_custkey, o_orderkey, {TOC_LINE} AS line, o_orderkey % 3 AS k, o_orderstatus FROM orders),
d AS (SELECT *, count(*) FILTER (k = 0) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - CASE WHEN k = 0 THEN 1 ELSE 0 END AS entry FROM l),
h AS (SELECT *, last_value(CASE WHEN k = 1 THEN line END IGNORE NULLS) OVER (PARTITION BY o_custkey, entry ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held FROM d)
SELECT o_custkey, o_orderkey, CASE WHEN held IS NULL THEN '' ELSE held || ' ' END || 'Name ' || o_orderstatus AS name, (o_orderkey % 90 + 1) || '-' || (o_orderkey % 700 + 1) AS manual_page, 2 AS indent FROM h WHERE k = 0""")
def q44_toc_wrap(t):
    k = F.col("o_orderkey")
    text = lambda c: c.cast("string")
    dotted = F.concat(F.lit("  Name "), "o_orderstatus", F.lit(" ..... "), text(k % 90 + 1), F.lit("-"), text(k % 700 + 1))
    line = F.when(k % 3 == 0, dotted).when(k % 3 == 1, F.concat(F.lit("Held "), text(k))).otherwise(F.concat(F.lit("12 "), text(k)))
    bare = r"^(\s*)(\*?[A-Za-z][A-Za-z0-9_()/ ]*?)\s*$"
    return navigation.parse_toc(t("orders").select("o_custkey", "o_orderkey", line.alias("line")), ["o_custkey"], ["o_orderkey"], bare=bare).select("o_custkey", "o_orderkey", "name", "manual_page", "indent")


@query(f"""WITH {MANUAL}, s AS (SELECT user_id, page, CASE event_type WHEN 'purchase' THEN '*KEY ' || (event_id % 50) WHEN 'signup' THEN 'Chapter ' || event_id WHEN 'error' THEN '12 ' || event_id ELSE 'Part ' || event_id END AS name,
CASE WHEN event_type IN ('signup', 'error') THEN 0 ELSE 2 END AS indent FROM manual),
i AS (SELECT *, starts_with(name, '*') AS star, upper(trim(regexp_replace(regexp_replace(name, '^\\*', ''), '[^A-Za-z0-9]+', '_', 'g'), '_')) AS sid, regexp_matches(name, '^(?:\\d{{2,}}|R\\d|9\\d)') AS ver FROM s),
f AS (SELECT *, row_number() OVER (PARTITION BY user_id, star, sid, indent = 0 OR star ORDER BY page) = 1 AS first, star OR indent = 0 AS reset FROM i),
r AS (SELECT *, reset AND NOT star AND first AND NOT ver AS opens, max(CASE WHEN reset THEN page END) OVER (PARTITION BY user_id ORDER BY page) AS rp FROM f),
x AS (SELECT r.*, q.sid AS root, q.opens AS root_opens FROM r LEFT JOIN r q ON q.user_id = r.user_id AND q.page = r.rp)
SELECT user_id, page, CASE WHEN NOT reset THEN root || '__' || sid ELSE sid END AS section_id, CASE WHEN star THEN 'keyword' WHEN reset THEN 'document' ELSE 'child' END AS kind, CASE WHEN NOT reset THEN root END AS parent_section_id
FROM x WHERE (star AND first) OR opens OR (NOT reset AND root_opens AND NOT ver)""")
def q45_spec_context(t):
    k = F.col("event_id").cast("string")
    name = F.when(F.col("event_type") == "purchase", F.concat(F.lit("*KEY "), (F.col("event_id") % 50).cast("string"))).when(F.col("event_type") == "signup", F.concat(F.lit("Chapter "), k)).when(F.col("event_type") == "error", F.concat(F.lit("12 "), k)).otherwise(F.concat(F.lit("Part "), k))
    toc = manual_pages(t).select("user_id", "page", name.alias("name"), F.when(F.col("event_type").isin("signup", "error"), 0).otherwise(2).alias("indent"))
    return navigation.select_specs(toc, ["user_id"], "page").select("user_id", "page", "section_id", "kind", "parent_section_id")
