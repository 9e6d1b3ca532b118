"""The catalogue index against a plain scan of all names."""

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import catalog

SCOPE = ["s"]


def plain_key(x):
    x = re.sub(r"`|\$|[{}]|\^?\\(?:ast|star)\b|\\(?=_)", "", x)
    return re.sub(r"(?<=[A-Za-z])-(?=[A-Za-z])|_(?=\d)|\s+", "", x).upper()


class Plain:
    """One scope's catalogue: (origin, variable, ambiguous) in order, each text held against every name."""

    def __init__(self, fields):
        self.names, origins = {}, {}
        for origin, v, ambiguous in fields:
            self.names.setdefault(plain_key(v), v)
            if not ambiguous:
                origins[origin] = v
        claims = {}
        for v in origins.values():
            if re.fullmatch(r"[A-Za-z][A-Za-z0-9_]*(?:\s*(?:/|\bor\b)\s*[A-Za-z][A-Za-z0-9_]*)+", v, re.I):
                for a in re.split(r"\s*(?:/|\bor\b)\s*", v, flags=re.I):
                    claims.setdefault(plain_key(a), []).append((a, v))
        self.aliases = {k: c[0] for k, c in claims.items() if len(c) == 1 and k not in self.names}

    def match(self, text):
        k = plain_key(text)
        if k in self.names:
            return self.names[k]
        if k in self.aliases:
            return self.aliases[k][0]
        near = [v for n, v in self.names.items() if len(n) == len(k) and [{a, b} for a, b in zip(n, k) if a != b] == [{"0", "O"}]]
        return near[0] if len(near) == 1 else None

    def family(self, head, tail=""):
        return [v for k, v in self.names.items() if re.fullmatch(re.escape(head) + r"\d+" + re.escape(tail), k)]


def index_of(spark, fields):
    df = spark.createDataFrame([("a", i, *f) for i, f in enumerate(fields)], "s string, i int, origin string, variable string, ambiguous boolean")
    return catalog.build_index(df, SCOPE, ["i"], origin="origin", ambiguous="ambiguous")


def test_lookup_equals_a_scan_of_all_names(spark):
    rng = random.Random(3)
    name = lambda: rng.choice("ABO0") + "".join(rng.choice("O0AB1_") for _ in range(rng.randint(0, 3)))
    fields = []
    for i in range(120):
        v = rng.choice([name, lambda: f"{name()}/{name()}", lambda: f"{name()} or {name()} / {name()}", lambda: f"{name()}, {name()}", lambda: name().lower()])()
        fields.append((f"o{rng.randint(0, 100)}", v, rng.random() < 0.2))
    index, plain = index_of(spark, fields), Plain(fields)
    texts = sorted({name() for _ in range(400)} | {f[1] for f in fields})
    got = catalog.resolve(spark.createDataFrame([("a", t) for t in texts], "s string, t string"), index, SCOPE, ["s", "t"], F.array("t"))
    assert {r.t: r.matched for r in got.collect()} == {t: plain.match(t) for t in texts if plain.match(t)}
    hows = {r.how for r in got.collect()}
    assert hows == {"exact", "alias", "confusable"}


def test_aliases_need_valid_syntax_and_one_origin(spark):
    index = index_of(spark, [("c1", "PID/PSID", False), ("c2", "PID/OTHER", False), ("c3", "BAD or prose value", False), ("c4", "X/Y", True), ("c5", "OTHER", False), ("c6", "A/A", False)])
    rows = spark.createDataFrame([("a", t) for t in ("PID", "PSID", "BAD", "X", "OTHER", "A", "PID/PSID", "PSlD", "psid")], "s string, t string")
    got = {r.t: (r.matched, r.target, r.how) for r in catalog.resolve(rows, index, SCOPE, ["s", "t"], F.array("t")).collect()}
    assert got == {"PSID": ("PSID", "PID/PSID", "alias"), "psid": ("PSID", "PID/PSID", "alias"), "OTHER": ("OTHER", "OTHER", "exact"), "PID/PSID": ("PID/PSID", "PID/PSID", "exact")}


@pytest.mark.parametrize(
    "text,want",
    [
        ("LX, LY  coordinates", ("LX, LY", ["LX", "LY"])),
        ("VEL/AVGVEL/ Velocity and average velocity:\nVORT EQ.0: Is output.\nEQ.1: Is not output.", ("VEL, AVGVEL, VORT", ["VEL", "AVGVEL", "VORT"])),
        ("LX of LY", None),
        ("LX,\n/LY\nLX", ("LX, LY", ["LX", "LY"])),
        ("LX, nothing, LY", None),
        ("LX EQ.1, LY\nVEL", ("LX, VEL", ["LX", "VEL"])),
        ("lx/LY", ("lx, LY", ["LX", "LY"])),
        ("LX, L0\nV0RT, LY", ("LX, V0RT, LY", ["LX", "VORT", "LY"])),
        ("", None),
        (None, None),
    ],
)
def test_groups_at_the_start_of_a_description(spark, text, want):
    index = index_of(spark, [(v, v, False) for v in ("LX", "LY", "VEL", "AVGVEL", "VORT")])
    rows = spark.createDataFrame([("a", 1, text)], "s string, id int, text string")
    got = [(r.label, r.targets) for r in catalog.leading_groups(rows, index, SCOPE, ["s", "id"]).collect()]
    assert got == ([want] if want else [])


def test_families_by_each_rule(spark):
    names = ["P2S", "P1S", "P10S", "Q3", "Q1", "AX", "AY", "AZ", "C11", "C12", "LX", "NO5", "Q1/R1"]
    index, plain = index_of(spark, [(v, v, False) for v in names]), Plain([(v, v, False) for v in names])
    q, p, c = plain.family("Q"), plain.family("P", "S"), plain.family("C")
    want = {
        "P[N]S": (1, p), "p[n]s": (1, p), "A[X,Y]": (2, ["AX", "AY"]), "AX, Y]": (2, ["AX", "AY"]), "A[X, W]": None, "LX, AX": (4, ["LX", "AX"]), "LX, NOPE": None, "Q1, Q3, ...": (4, q), "Q7, Q9, ...": (5, q), "Q1, ..., QN": (6, q),
        "QI": (6, q), "QN": (6, q), "CIJ": (6, c), "QI, CIJ": (6, q + c), "i^th parameter": None, "N05, LX": (4, ["NO5", "LX"]), "": None, "Z[N]": None, "$Q_I$": (6, q),
    }
    rows = spark.createDataFrame([("a", x) for x in want] + [("b", "QI"), ("a", None)], "s string, label string")
    got = {r.label: (r.rule, r.members) for r in catalog.families(rows, index, SCOPE).collect() if r.s == "a"}
    assert got == {k: v for k, v in want.items() if v}
    one = index_of(spark, [(v, v, False) for v in ("W2", "W1", "LX")])
    got = catalog.families(spark.createDataFrame([("a", "The $i^{th}$ parameter"), ("b", "ith parameters")], "s string, label string"), one, SCOPE).collect()
    assert [(r.s, r.rule, r.members) for r in got] == [("a", 3, ["W2", "W1"])]


def test_forms_of_headings_and_first_lines(spark):
    index = index_of(spark, [(v, v, False) for v in ("IDAM", "VS", "PNAK", "SFA2")])
    texts = {
        "VARIABLE\nIDAM": "IDAM", "VARIABLE IDAM": "IDAM", "IDAM: text": "IDAM", "P N A K is it": "PNAK", "$$ V_s $$": None, "$V_s$\nmore": "VS", "IDAM (see remark 1)\nmore": "IDAM", "Variable:\nVS values": "VS",
        "nothing here": None, "SFA_2 x": "SFA2", "": None,
    }
    rows = spark.createDataFrame([("a", t) for t in texts], "s string, t string")
    got = {r.t: r.matched for r in catalog.resolve(rows, index, SCOPE, ["s", "t"], catalog.leading_forms(F.col("t"))).collect()}
    assert got == {k: v for k, v in texts.items() if v}
    head = {r.t: r.matched for r in catalog.resolve(rows, index, SCOPE, ["s", "t"], catalog.heading_forms(F.col("t"))).collect()}
    assert head == {"$$ V_s $$": "VS"}
