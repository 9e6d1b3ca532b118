"""Plans: no query holds each row of one table against each of another, and layouts equal a plain version."""

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusflow import queries, unit_queries  # noqa: F401
from corpusflow.operators import adapting

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_nested_loops(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("NestedLoopJoin|CartesianProduct", plan)


def plain_layout(rows):
    """Places of cells (rows of (text, down, across)) by marking every place that is taken."""
    taken, out = {}, []
    for r, cells in enumerate(rows):
        k = 0
        for text, down, across in cells:
            while any((r, k + i) in taken for i in range(across)):
                k += 1
            for i in range(down):
                for j in range(across):
                    taken[r + i, k + j] = None
            taken[r, k] = text
            out.append((r, k, down, across, text))
            k += across
    return out, taken


def test_layouts_equal_a_plain_one(spark):
    rng = random.Random(5)
    tables = []
    for _ in range(150):
        rows = [[(f"c{rng.randrange(99)}", rng.choice([1, 1, 1, 2, 3]), rng.choice([1, 1, 2, 4])) for _ in range(rng.randrange(5))] for _ in range(rng.randrange(1, 6))]
        tables.append(rows)
    html = lambda rows: "<table>" + "".join("<tr>" + "".join(f"<td rowspan={d} colspan='{a}'>{t}</td>" for t, d, a in r) + "</tr>" for r in rows) + "</table>"
    frame = spark.createDataFrame([(i, html(r)) for i, r in enumerate(tables)], "i int, html string").select("i", adapting.html_table("html").alias("t"))
    for x in frame.select("i", "t", adapting.row_widths(F.col("t.rows")).alias("widths"), adapting.grid(F.col("t.rows")).alias("grid")).collect():
        cells, taken = plain_layout(tables[x["i"]])
        assert [(c["row"], c["column"], c["rowspan"], c["colspan"], c["text"]) for r in x["t"]["rows"] for c in r] == cells
        high = max([len(tables[x["i"]]), *[r + 1 for r, _ in taken]])
        assert x["widths"] == [max([k + 1 for r, k in taken if r == row], default=0) for row in range(high)]
        if any(c[2] > 1 or c[3] > 1 for c in cells):
            wide = max(k + 1 for _, k in taken)
            assert x["grid"] == [[taken.get((r, k)) or "" for k in range(wide)] for r in range(high)]
        else:
            assert x["grid"] == [[t for t, _, _ in r] for r in tables[x["i"]]]


def test_spans_beyond_any_table_are_errors(spark):
    html = "<table><tr><td rowspan=100000 colspan=100000>a<td rowspan=0>b<td colspan='x'>c</tr><tr><td rowspan=65534 colspan=1000>d</tr></table>"
    t = spark.createDataFrame([(html,)], "html string").select(adapting.html_table("html").alias("t")).first()["t"]
    assert len(t["errors"]) == 4 and [(c["rowspan"], c["colspan"]) for c in t["rows"][0]] == [(1, 1)] * 3
    assert (t["rows"][1][0]["rowspan"], t["rows"][1][0]["colspan"]) == (65_534, 1_000)


def test_page_tags_equal_a_plain_scan(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").select("html", adapting.page_tags(F.col("html")).alias("b")).collect()
    kinds = {"nav": "header", "footer": "footer", "h1": "text", "p": "text"}
    for r in rows:
        want = []
        opens = list(re.finditer(r"<(nav|footer|h1|p)\b[^>]*>", r["html"] or "", re.I))
        closes = [m.start() for m in re.finditer(r"</(?:nav|footer|h1|p)>", r["html"] or "", re.I)]
        for k, m in enumerate(opens):
            ends = [x for x in closes if x >= m.end()] + [x.start() for x in opens[k + 1 :]] + [len(r["html"])]
            want.append((kinds[m[1].lower()], " ".join(re.sub(r"<[^>]*>", " ", r["html"][m.end() : min(ends)]).split())))
        assert [(b["type"], b["text"]) for b in r["b"] or []] == want
