"""What only shows on larger tables: joins whose sides grow, keys without a partner, work a row."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow import queries, unit_queries  # noqa: F401
from corpusflow.operators import adapting, quality
from corpusflow.streaming import completions

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_opening_titles_send_no_entries_to_all_tasks(spark):
    assert "Broadcast" not in plan(queries.QUERIES["q111_opening_titles"](spark, SF))


def test_customers_without_orders_have_no_worst_severity(spark):
    tables = {
        "customer": spark.createDataFrame([(1,), (2,), (3,), (4,)], "c_custkey long"),
        "orders": spark.createDataFrame([(1, "O"), (1, "P"), (2, "F"), (3, "O")], "o_custkey long, o_orderstatus string"),
    }
    got = queries.q12_status_rollup(tables.__getitem__).collect()
    assert sorted(map(tuple, got)) == [(1, "warning", "warning"), (2, "error", "warning"), (3, "info", "success"), (4, None, "failed")]


@pytest.mark.parametrize("name", ["q119_pdf_slices", "q105_feature_flags", "q99_definition_fields"])
def test_long_work_on_a_small_file_is_dealt_to_tasks(spark, name):
    assert queries.QUERIES[name](spark, SF).rdd.getNumPartitions() == 4


def test_runs_of_tokens_are_made_once_a_text(spark):
    texts = spark.createDataFrame([(1, "a b c d"), (2, "a b"), (3, None), (4, "x a b c")], "k long, text string")
    runs = quality.token_runs(texts, "k", "text", 3)
    assert runs._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert sorted(map(tuple, runs.collect())) == [(1, "a b c"), (1, "b c d"), (4, "a b c"), (4, "x a b")]


def test_only_the_smaller_tables_runs_are_all_made_rows(spark):
    a = spark.createDataFrame([(1, "a b c d"), (2, "x.y Z-1 a b c"), (3, None)], "k long, text string")
    b = spark.createDataFrame([(7, "A B\\nc"), (8, "a b"), (9, None), (10, "stra\u00dfe x.y z-1 a"), (11, "a b. c d"), (12, "a"), (13, "b c d b c d e"), (14, "")], "d long, text string")
    pairs = quality.shared_runs(a, b, "k", "d", "text", 3)
    assert pairs._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert sorted(map(tuple, pairs.collect())) == [(1, 7), (1, 11), (1, 13), (2, 7), (2, 10), (2, 11)]


def test_runs_in_batches_are_the_runs_of_tokens(spark):
    rows = spark.range(0x110000).where("id not between 55296 and 57343").select("id", F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    texts = rows.select("id", F.concat(F.lit("Q"), "c", F.lit("w "), "c", F.lit(" ._-"), "c", F.lit("-9")).alias("text"))
    texts = texts.union(spark.createDataFrame([(-1, "a.b..c-_d_e"), (-2, "._-a\\n\\Nb-"), (-3, None), (-4, "Da.\nwa 1-2.3_4 " * 200_000)], texts.schema))
    everything = np.full(quality.RUN_BITS // 8 + 4096, 255, dtype=np.uint8)
    got, want = quality.mapped_runs(texts, "id", "text", 2, everything), quality.token_runs(texts, "id", "text", 2)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and want.where("id = -4").count() == 3


def test_the_map_of_runs_lets_few_others_pass(spark):
    texts = spark.createDataFrame([(i, f"a b {i}") for i in range(5000)], "id long, text string").repartition(4)
    bits = quality.run_map(texts.where("id < 50"), "text", 3)
    assert 45 < np.unpackbits(bits).sum() <= 50
    kept = {r["id"] for r in quality.mapped_runs(texts, "id", "text", 3, bits).collect()}
    assert set(range(50)) <= kept and len(kept) < 60


def test_tokens_are_listed_once_a_text(spark):
    texts = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None)], "k long, text string")
    table = quality.token_table(texts, ["k"], "text")
    assert table._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert sorted(map(tuple, table.collect())) == [(1, "a", 2, 0), (1, "b", 1, 1)]


def test_bytes_of_a_turn_are_listed_without_its_text_a_byte(spark):
    assert "substring(hex(" not in plan(queries.QUERIES["q120_token_streams"](spark, SF)).lower()


@pytest.mark.parametrize("value", [[256], [-1], [True], [1.0], ["1"], [None], 10 * [1 << 70], "ab", None])
def test_bytes_of_a_token_are_whole_numbers_below_256(value):
    with pytest.raises(completions.Refused, match="BYTES_INVALID"):
        completions.octets(value)
    assert completions.octets([0, 255]) == b"\x00\xff" and completions.octets([]) == b""


def test_card_tables_are_grouped_where_their_lines_lie(spark):
    shown = plan(queries.QUERIES["q98_card_regions"](spark, SF))
    assert shown.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in shown


def test_a_grid_is_measured_once(spark):
    rows = spark.createDataFrame([("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>",)], "html string").select(adapting.html_table("html").alias("t")).select("t.rows")
    made = rows.select(adapting.grid(F.col("rows")).alias("g"))
    assert made._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1
    assert made.first()["g"] == [["a", "b"], ["", "c"]]


@pytest.mark.parametrize("name", ["q37_nav_contract", "q107_navigation_contract"])
def test_checks_of_sections_are_dealt_by_their_rows(spark, monkeypatch, name):
    monkeypatch.setattr(queries, "TASK_ROWS", 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = re.findall(r"hashpartitioning\(.*, (\d+)\)", plan(queries.QUERIES[name](spark, SF)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tables = {str(max(4, -(-spark.read.parquet(f"{SF}/{t}.parquet").count() // 100))) for t in ("orders", "lineitem")}
    assert counts and set(counts) <= tables


def test_issues_of_sections_are_the_same_however_dealt(spark):
    rows = [(1, 10, None, [1, 2]), (1, 11, 10, [2, 1]), (1, 11, 10, [3]), (1, 12, 99, [1]), (2, 10, 11, [1]), (2, 13, 10, []), (None, 5, 6, [1]), (None, 6, None, [1]), (2, 14, 10, None)]
    sections = spark.createDataFrame(rows, "document long, section_id long, parent_section_id long, pages array<long>")
    for tasks in (None, 3):
        got = quality.section_issues(sections, ["document"], tasks=tasks).collect()
        assert sorted((tuple(r) for r in got), key=str) == sorted(
            [
                (1, 11, "SECTION_ID_DUPLICATE"), (1, 11, "SECTION_PAGE_RANGE_INVALID"), (1, 12, "SECTION_PARENT_MISSING"),
                (2, 10, "SECTION_PARENT_MISSING"), (2, 13, "SECTION_PAGE_RANGE_INVALID"), (None, 5, "SECTION_PARENT_MISSING"),
            ], key=str,
        )
