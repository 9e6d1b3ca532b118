"""Settings, named documents, and what PDF bytes say."""

import zlib

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import sampling
from corpusflow.sources import readers
from corpusflow.sources.readers import BuildConfig, ConfigError


def test_settings_in_groups():
    c = BuildConfig.from_dict({"manual": {"release": "r12", "documents": [{"path": "a/x.pdf", "manual_type": "keyword", "volume": 2}]}, "parser": {"provider": "some-local", "batch_size": 5}, "output": {"corpus_dir": "out"}, "validation": {"text_layer_min_visual_recall": 0.5}, "quality_gate": {"baseline": "b.json"}, "options": {"end_page": 9}})
    assert (c.release, c.max_batch_pages, c.output_dir, c.text_layer_min_recall, c.baseline, c.end_page) == ("R12", 1, "out", 0.5, "b.json", 9)
    assert c.documents == (readers.ExplicitDocument("a/x.pdf", "keyword", 2),)
    for bad in (
        {"manual": {"unknown": 1}}, {"other": {}}, {"parser": {"batch_size": 1, "max_batch_pages": 1}}, {"manual": {"documents": []}}, {"parser": {"max_batch_pages": 0}}, {"parser": {"timeout_seconds": 0}},
        {"manual": {"documents": [{"path": "x", "manual_type": "keyword"}]}}, {"manual": {"documents": [{"path": "x", "volume": 1}]}}, {"manual": {"documents": [{"path": "x", "manual_type": "theory", "volume": 1}]}}, {"manual": {"release": "12"}}, {"manual": 3},
    ):
        with pytest.raises(ConfigError):
            BuildConfig.from_dict(bad)


def test_named_documents(spark):
    docs = lambda *d, release=None: readers.explicit_documents(spark, BuildConfig(release=release, documents=d))
    a, b = {"path": "x/manual_theory_R9.pdf"}, {"path": "y/other.pdf", "manual_type": "keyword", "volume": 2}
    got = docs(a, b, release="R9").collect()
    assert [(r["document_id"], r["volume"], r["release"]) for r in got] == [("keyword-volume-2", 2, "R9"), ("theory", None, "R9")]
    for bad, release in (((b,), None), ((a, {**a, "path": "z/manual_theory_R9.pdf"}), None), ((a,), "R10"), (({"path": "manual_vol_i_R9.pdf", "manual_type": "keyword", "volume": 2},), None), (({"path": "what.pdf"},), "R9")):
        with pytest.raises(ConfigError):
            docs(*bad, release=release)


def pdf(pages: int, compressed: bool = False, encrypted: bool = False) -> bytes:
    objects = b"".join(b"%d 0 obj\n<< /Type /Page /Parent 9 0 R >>\nendobj\n" % (k + 10) for k in range(pages))
    if compressed:
        body = zlib.compress(b"".join(b"<< /Type/Page /Parent 9 0 R >> " for _ in range(pages)))
        objects = b"8 0 obj\n<< /Type /ObjStm /Filter /FlateDecode >>\nstream\n" + body + b"\nendstream\nendobj\n"
    return b"%PDF-1.7\n9 0 obj\n<< /Type /Pages /Count 3 >>\nendobj\n" + objects + (b"trailer << /Encrypt 5 0 R >>\n" if encrypted else b"trailer << >>\n") + b"%%EOF"


def test_pdf_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(pdf(3))
    (tmp_path / "b.PDF").write_bytes(pdf(4, True))
    got = {r["path"][-5:]: r["page_count"] for r in readers.pdf_files(spark, str(tmp_path)).collect()}
    assert got == {"a.pdf": 3, "b.PDF": 4}
    (tmp_path / "c.pdf").write_bytes(pdf(1, encrypted=True))
    with pytest.raises(Exception, match="an encrypted file"):
        readers.pdf_files(spark, str(tmp_path)).collect()


def test_blank_pages(spark):
    rows = [(1, b"q 1 0 0 1 0 0 cm Q", 0), (2, b"BT (Tj) <61> % Do\n ET", None), (3, b"BT (a\\) b) Tj ET", 0), (4, b"/Im1 Do", 0), (5, None, 0), (6, None, 2), (7, b"0 0 m 1 1 l S", 0)]
    got = readers.blank_pages(spark.createDataFrame(rows, "p int, content binary, annotations int")).orderBy("p").collect()
    assert [r["blank"] for r in got] == [True, True, False, False, True, False, False]


class Split:
    def extract(self, content: bytes) -> list[str]:
        return content.decode().split("|")


def test_extractors_and_addresses(spark):
    files = spark.createDataFrame([("d", b"a|b"), ("e", b"")], "document_id string, content binary")
    assert sorted(map(tuple, readers.extract_pages(files, Split()).collect())) == [("d", 1, "a"), ("d", 2, "b"), ("e", 1, "")]
    text = spark.range(1).select(readers.signed_addresses(F.lit("see https://h/a.jsonl?sig=1&x=2 and http://h/b")).alias("t")).first()["t"]
    assert text == "see https://h/a.jsonl and http://h/b"


def test_features_and_anchors(spark):
    rows = [
        ("k", "keyword", None, False, ["Card 1 = = = = = =", "card 1a. if EQ.1", "VARIABLE DESCRIPTION Fig. 1 Figure 2"]),
        ("t", "theory", "p", True, ["the options: OPTION1 for Ai, Bi", "Variable and its description"]),
    ]
    frame = spark.createDataFrame(rows, "id string, kind string, parent string, shared boolean, pages array<string>")
    flags, counts = sampling.feature_flags(F.col("pages"), F.col("kind") == "keyword", F.col("parent").isNotNull(), F.col("shared"))
    got = {r["id"]: r for r in frame.select("id", flags.alias("f"), *[v.alias(k) for k, v in counts.items()]).collect()}
    assert got["k"]["f"] == ["multiple_cards_candidate", "card_conditions_candidate", "variable_description_candidate", "multi_page_card_candidate", "formula_dense_candidate", "figure_rich_candidate"]
    assert got["t"]["f"] == ["non_keyword", "nested_section", "shared_boundary_candidate", "options_candidate", "variable_description_candidate", "variable_family_candidate"]
    assert (got["k"]["cards"], got["k"]["card_pages"], got["k"]["figures"]) == (2, 2, 2)
    sections = spark.createDataFrame([(i,) for i in "abc"], "id string")
    sample, missing = sampling.with_anchors(sections.where("id = 'a'"), sections, spark.createDataFrame([("a",), ("c",), ("z",)], "id string"), ["id"])
    assert sorted(map(tuple, sample.collect())) == [("a", True), ("c", True)] and [r["id"] for r in missing.collect()] == ["z"]


def test_skipped_issue_lines_are_counted(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"severity":"error","code":"X"}\n\n{"code":"Y"}\nnot json\n[1]\n')
    (tmp_path / "b.jsonl").write_text('{"severity":"info","code":"Z"}\n')
    got = {r["file"][-7:]: r["skipped"] for r in readers.skipped_issues(spark, str(tmp_path)).collect()}
    assert got == {"a.jsonl": 3} and readers.read_issues(spark, str(tmp_path)).count() == 2


def test_frozen_samples_are_of_this_kind_release_and_source(spark):
    schema = "document_id string, kind string, release string, source_sha256 string, pdf_pages array<int>"
    good = spark.createDataFrame([("a", "keyword", "r9", "x", [1, 2]), ("a", "keyword", "R9", "x", [2, 3])], schema)
    sources = spark.createDataFrame([("a", "x"), ("b", "y")], "document_id string, source_sha256 string")
    assert sorted(tuple(r) for r in readers.frozen_pages(good, sources, "R9", "keyword").collect()) == [("a", 1), ("a", 2), ("a", 3)]
    for row, message in ((("a", "theory", "R9", "x", [1]), "another kind"), (("a", "keyword", "R8", "x", [1]), "another release"), (("a", "keyword", "R9", "y", [1]), "another source"), (("c", "keyword", "R9", None, [1]), "another source")):
        with pytest.raises(Exception, match=message):
            readers.frozen_pages(good.union(spark.createDataFrame([row], schema)), sources, "R9", "keyword").collect()
