"""Archives and URL filters."""

import hashlib
import math
from collections import Counter

import pytest

from corpusflow.llm import urls, warc

PAGES = [(1, "http://a.example/x y", "p" * 1500), (2, None, "p" * 1500), (3, "", "p" * 1500), (4, "https://b.example/", None), (5, "dns:é", "é" * 400), (6, "http://c.example/", "é" * 400), (7, "u", "é" * 500 + "\r\n\r\nWARC/1.1"), (8, "u", "é" * 500 + "\r\n\r\nWARC/1.1"), (9, "u", "q" * 999), (10, "u", "q" * 999), (11, "u", "z" * 300_000)]
SCHEMA = "page_id long, url string, html string, refers_to int"


def rows(spark):
    return spark.createDataFrame([(*p, 0) for p in PAGES], SCHEMA).repartition(3)


@pytest.mark.parametrize("archive_rows", [1, 2, 1000])
def test_pages_come_back_from_archives(spark, monkeypatch, archive_rows):
    monkeypatch.setattr(warc, "ARCHIVE_ROWS", archive_rows)
    got = {int(r["key"]): r for r in warc.read_archives(warc.archive_pages(rows(spark))).collect() if r["record_type"] != "warcinfo"}
    assert sorted(got) == [p[0] for p in PAGES]
    for k, _, html in PAGES:
        raw = (html or "").encode()
        holder = max(p[0] for p in PAGES if (p[2] or "") == (html or ""))
        revisit = len(raw) >= 1000 and holder != k
        r = got[k]
        assert r["payload_bytes"] == len(raw) and r["payload_digest"] == hashlib.sha1(raw).hexdigest()
        assert r["record_type"] == ("revisit" if revisit else "response")
        assert r["refers_to_key"] == (str(holder) if revisit else None)
        assert r["payload"] == (None if revisit else raw)


def test_empty_pages(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert warc.read_archives(warc.archive_pages(empty)).collect() == []


@pytest.mark.parametrize("version", [1, 2])
def test_converter_keeps_every_record(version):
    records = [
        warc.ArcRecord("http://h/", "1.2.3.4", "20010203040506", "text/html", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\n\nmore", "200"),
        warc.ArcRecord("dns:h", "1.2.3.4", "200102030405", "text/dns", b"line", "200"),
        warc.ArcRecord("http://e/", "1.2.3.4", "20010203040506", "no-type", b"", "-"),
    ]
    content = warc.write_arc(records, version, "x.arc")
    back = list(warc.read_arc(content))
    assert [(r.url, r.body) for r in back[1:]] == [(r.url, r.body) for r in records]
    converted = [warc.to_warc(r) for r in back]
    assert [r.headers["WARC-Type"] for r in converted] == ["warcinfo", "response", "resource", "resource"]
    assert converted[2].headers["WARC-Date"] == "2001-02-03T04:05:00Z"
    again = list(warc.read_warc(b"".join(map(warc.warc_bytes, converted))))
    assert [r.headers for r in again] == [r.headers for r in converted] and [r.block for r in again] == [r.block for r in converted]
    assert list(warc.read_arc(content[:-10]))[-2].body == b"line"


def test_damaged_archives():
    r = warc.ArcRecord("http://h/", "1.2.3.4", "20010203040506", "text/html", b"x" * 50)
    cut = list(warc.read_arc(warc.write_arc([r], 1, "x")[:-11]))[-1]
    assert cut.truncated and cut.body == b"x" * 40 and warc.to_warc(cut).headers["WARC-Truncated"] == "length"
    lost = list(warc.read_arc(b"not a header line\n"))
    assert [(x.error, x.body, x.truncated) for x in lost] == [("header line cut short", b"not a header line\n", True)]


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("zipped", [False, True])
def test_archives_cut_at_every_byte(version, zipped):
    import gzip

    r = [warc.ArcRecord(f"http://h/{i}", "1.2.3.4", "20010203040506", "text/html", b"HTTP/1.0 200 OK\r\n\r\n" + bytes([65 + i]) * 9, "200") for i in range(3)]
    plain = warc.write_arc(r, version, "x.arc")
    content = gzip.compress(plain[:200], mtime=0) + gzip.compress(plain[200:], mtime=0) if zipped else plain
    for n in range(len(content) + 1):
        got = list(warc.read_arc(content[:n]))
        whole = [x for x in got if not x.truncated and not x.error]
        assert [x.body for x in whole[1:]] == [x.body for x in r[: max(0, len(whole) - 1)]]
        assert all(x is got[-1] for x in got if x.truncated)
        again = list(warc.read_warc(b"".join(warc.warc_bytes(warc.to_warc(x)) for x in got)))
        assert len(again) == len(got)
    assert len(got) == 4


def test_header_lines_with_blanks_and_junk_between_records():
    content = b"filedesc://x 0.0.0.0 20010203040506 text/plain 9\n1 0 me\nab\nhttp://h/a b c 1.2.3.4 20010203040506 text/html; charset=utf-8 4\nbody\njunk\nmore junk\nhttp://h/2 1.2.3.4 20010203040506 - 2\nok\n"
    got = list(warc.read_arc(content))
    assert [(r.url, r.kind, r.body, r.error) for r in got] == [
        ("filedesc://x", "text/plain", b"1 0 me\nab", ""),
        ("http://h/a b c", "text/html; charset=utf-8", b"body", ""),
        ("", "", b"junk\nmore junk\n", "no header line"),
        ("http://h/2", "-", b"ok", ""),
    ]
    assert [warc.to_warc(r).headers["WARC-Type"] for r in got] == ["warcinfo", "resource", "metadata", "resource"]


def test_unreadable_archives_are_error_rows(spark):
    good = warc.warc_bytes(warc.to_warc(warc.ArcRecord("http://h/", "1.2.3.4", "20010203040506", "text/html", b"x" * 50)))
    rows = [("cut", good + good[:-20]), ("noise", b"noise"), ("null", None), ("zip", b"\x1f\x8bnoise"), ("long", good.replace(b"Content-Length: 50", b"Content-Length: x"))]
    got = warc.read_archives(spark.createDataFrame(rows, "archive string, content binary")).collect()
    assert sorted((r["archive"], r["record_type"]) for r in got) == [("cut", "error"), ("cut", "resource"), ("long", "error"), ("noise", "error")]
    assert all((r["error"] is not None) == (r["record_type"] == "error") for r in got)
    arcs = spark.createDataFrame([("a", b"noise"), ("b", None)], "archive string, content binary")
    assert [(r["archive"], r["record_type"], r["error"]) for r in warc.read_archives(warc.convert_archives(arcs)).collect()] == [("a", "metadata", "header line cut short")]


def test_pages_without_keys(spark):
    same = "same payload " * 100
    rows = [(None, "u", same), (None, "u", same), (None, None, "x"), (4, "u", same), (3, "filedesc:", "y"), (None, "v", "z" * 2000), (None, "v", "z" * 2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = warc.read_archives(warc.archive_pages(pages)).where("record_type != 'warcinfo'").collect()
    assert sorted((str(r["key"]), r["record_type"], str(r["refers_to_key"]), r["payload_bytes"]) for r in got) == sorted(
        [("None", "revisit", "4", 1300), ("None", "revisit", "4", 1300), ("None", "response", "None", 1), ("4", "response", "None", 1300), ("3", "response", "None", 1), *[("None", "response", "None", 2000)] * 2]
    )
    assert len({r["record_id"] for r in got}) == len(got)


def plain_judge(url):
    after = (url or "").partition("://")
    if not after[1]:
        return "", "", None, None
    end = min([i for i in map(after[2].find, "/?#") if i >= 0], default=len(after[2]))
    host = "".join(c.lower() if c.isascii() else c for c in after[2][:end])
    rest = after[2][end:]
    path = rest[: min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))]
    best = (None, None)
    for verdict, rule in sorted(urls.RULES, key=lambda r: len(r[1])):
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            best = (rule, verdict)
    return host, path, *best


URLS = [None, "", "nothing", "http://", "HTTP://EXAMPLE.COM/en/7?x=1", "https://www.example.com/en/8", "http://example.com/fr/", "http://badexample.net/de/8", "http://example.net/de/8#a", "http://a.example.net/de/81/b?c", "http://x.org?y=/es/", "http://x.org/es/é", "http://É.org/es/", "a://b://c.com/en/", "http://net/de/", "http://com/en/x", "http://h\n.com/en/"]


def test_urls_are_judged(spark):
    many = URLS + [f"http://s{i}.example.{t}/{p}/{i}" for i in range(40) for t in ("com", "net", "org") for p in ("en", "de", "es")]
    frame = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(many)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in urls.judge(frame).collect()}
    assert len(got) == len(many)
    for i, u in enumerate(many):
        host, path, rule, verdict = plain_judge(u)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), u
        assert r["verdict"] == verdict if rule else r["verdict"] == ("block" if r["block_score"] > 0 else "allow")
    assert urls.judge(frame.limit(0)).collect() == []


def test_trees_learn_and_columns_equal_them(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.random((500, 2))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = urls.fit_trees(x, y, ["a", "b"], rounds=30)
    frame = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    got = frame.select("y", model.column({"a": frame["a"], "b": frame["b"]}).alias("s")).collect()
    assert np.mean([(r["s"] > 0) == (r["y"] > 0) for r in got]) > 0.95


def test_features_equal_a_plain_count(spark):
    many = [u or "" for u in URLS] + [f"https://a{i}.example.com/x{i}/y?p={i}&q=2#f" for i in range(30)] + ["http://h/" + "long/" * 20_000]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(many)], "page_id long, url string")
    url = frame["url"]
    got = {r["page_id"]: r for r in frame.select("page_id", *[v.alias(k) for k, v in urls.features(url, urls.host_of(url), urls.path_of(url)).items()]).collect()}
    for i, u in enumerate(many):
        host, path, _, _ = plain_judge(u)
        n, query = max(1, len(u)), u.partition("?")[2].partition("#")[0]
        want = {
            "length": len(u), "path_length": len(path), "depth": path.count("/"), "digit_ratio": sum("0" <= c <= "9" for c in u) / n,
            "entropy": -sum(k / n * math.log2(k / n) for k in Counter(u).values()), "params": query.count("="), "labels": host.count("."), "fragment": float("#" in u), "https": float(u.startswith("https:")),
        }
        assert {k: pytest.approx(v) for k, v in want.items()} == {k: got[i][k] for k in want}, u


def test_verdicts_beyond_the_rules_are_the_trees(spark):
    """The trees, walked in plain Python over plain features, say what the compiled column says."""
    labelled = [(f"http://s{i}.example.{t}/p{i % 7}/{'?a=1&b=2' if t == 'bad' else ''}", int(t == "bad")) for i in range(200) for t in ("good", "bad")]
    frame = spark.createDataFrame(labelled, "url string, block int")
    model = urls.train(frame.union(frame), sample_rows=100_000)
    assert set(model.suffixes) == {"good", "bad"} and model.suffixes["bad"] == pytest.approx(math.log(201))
    url = frame["url"]
    rows = frame.select("url", "block", *[v.alias(k) for k, v in urls.features(url, urls.host_of(url), urls.path_of(url)).items()]).collect()
    judged = {r["url"]: r for r in urls.judge(frame, rules=(), model=model).collect()}

    def walk(node, values):
        while isinstance(node, tuple):
            node = node[2] if values[node[0]] <= node[1] else node[3]
        return node

    for r in rows:
        values = r.asDict() | {"suffix_odds": model.suffixes[plain_judge(r["url"])[0].rpartition(".")[2]]}
        score = model.base + sum(walk(t, values) for t in model.trees)
        assert judged[r["url"]]["block_score"] == pytest.approx(score) and judged[r["url"]]["verdict"] == ("block" if r["block"] else "allow")


def test_more_suffixes_than_any_cap(spark):
    frame = spark.createDataFrame([(f"http://h.s{i}/", i % 2) for i in range(700)], "url string, block int")
    assert len(urls.train(frame, sample_rows=100_000).suffixes) == 700
