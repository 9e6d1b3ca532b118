"""PDF structure on files written byte by byte."""

import re
import zlib

import pytest

from corpusflow.sources import pdf, readers


def classic(objects: dict[int, bytes], root: int = 1, before: bytes = b"%PDF-1.7\n", prev: int | None = None, extra: bytes = b"") -> bytes:
    """A file, or an update after one, with a cross-reference table."""
    out, places = bytearray(before), {}
    for n, body in objects.items():
        places[n] = len(out)
        out += b"%d 0 obj\n%s\nendobj\n" % (n, body)
    start = len(out)
    out += b"xref\n" + b"".join(b"%d 1\n%010d 00000 n \n" % (n, p) for n, p in sorted(places.items()))
    out += b"trailer\n<< /Size 50 /Root %d 0 R%s%s >>\nstartxref\n%d\n%%%%EOF\n" % (root, b" /Prev %d" % prev if prev is not None else b"", extra, start)
    return bytes(out)


def stream(data: bytes, head: bytes = b"") -> bytes:
    return b"<< /Length %d %s >>\nstream\n%s\nendstream" % (len(data), head, data)


def flat(data: bytes, head: bytes = b"") -> bytes:
    return stream(zlib.compress(data), b"/Filter /FlateDecode " + head)


BASE = {
    1: b"<< /Type /Catalog /Pages 2 0 R >>",
    2: b"<< /Type /Pages /Kids [3 0 R 4 0 R] /Count 3 /MediaBox [0 0 100 200] /Rotate 90 /Resources 9 0 R >>",
    3: b"<< /Type /Page /Parent 2 0 R /Contents [6 0 R 7 0 R] /Annots [<< /Subtype /Link >> << /Subtype /Text /Contents (a \\) b) >>] >>",
    4: b"<< /Type /Pages /Parent 2 0 R /Kids [5 0 R 8 0 R] /Count 2 /Rotate 0 >>",
    5: b"<< /Type /Page /Parent 4 0 R /MediaBox [0 0 7 7.5] >>",
    6: flat(b"q 1 0 0 1 0 0 cm"),
    7: stream(b"Q"),
    8: b"<< /Type /Page /Parent 4 0 R /Contents 10 0 R >>",
    9: b"<< /Font << /F1 << /Type /Font /Parent 8 0 R >> >> >>",
    10: flat(b"BT (hi) Tj ET"),
}


def shown(content: bytes):
    file = pdf.Pdf(content)
    return [(p.get("Rotate"), file.get(p.get("MediaBox")), file.content(p), file.annotations(p)) for _, p in file.pages()]


WANT = [(90, [0, 0, 100, 200], b"q 1 0 0 1 0 0 cm\nQ", ["Link", "Text"]), (0, [0, 0, 7, 7.5], b"", []), (0, [0, 0, 100, 200], b"BT (hi) Tj ET", [])]


def compressed(objects: dict[int, bytes], predictor: bool) -> bytes:
    """The same objects in an object stream, its places in a cross-reference stream."""
    inner = {n: b for n, b in objects.items() if b"stream" not in b}
    text, head = b"", b""
    for n, b in inner.items():
        head += b"%d %d " % (n, len(text))
        text += b + b" "
    out, places = bytearray(b"%PDF-1.7\n"), {}
    for n, b in {**{n: b for n, b in objects.items() if n not in inner}, 20: flat(head + text, b"/Type /ObjStm /N %d /First %d" % (len(inner), len(head)))}.items():
        places[n] = len(out)
        out += b"%d 0 obj\n%s\nendobj\n" % (n, b)
    start, listed = len(out), list(inner)
    rows = [b"\x02" + (20).to_bytes(3, "big") + bytes([listed.index(n)]) if n in inner else b"\x01" + places.get(n, start).to_bytes(3, "big") + b"\x00" for n in range(1, 22)]
    table, more = b"".join(rows), b""
    if predictor:
        table = b"".join(b"\x02" + bytes((a - b) & 255 for a, b in zip(r, above)) for r, above in zip(rows, [bytes(5), *rows]))
        more = b" /DecodeParms << /Predictor 12 /Columns 5 >>"
    out += b"21 0 obj\n" + flat(table, b"/Type /XRef /W [1 3 1] /Index [1 21] /Size 22 /Root 1 0 R" + more) + b"\nendobj\nstartxref\n%d\n%%%%EOF" % start
    return bytes(out)


@pytest.mark.parametrize("content", [classic(BASE), compressed(BASE, False), compressed(BASE, True), classic(BASE).replace(b"startxref", b"startxxxx"), classic(BASE)[:-200], b"junk before\n" + classic(BASE)], ids=["table", "streams", "predicted", "no start", "cut off", "shifted"])
def test_pages_with_what_they_inherit(content):
    assert shown(content) == WANT


def test_updates_count_once_in_their_last_form():
    first = classic(BASE)
    start = int(re.findall(rb"startxref\n(\d+)", first)[-1])
    again = classic({3: BASE[3].replace(b"/Annots", b"/Rotate 180 /Annots")}, before=first, prev=start)
    assert [s[0] for s in shown(again)] == [180, 0, 0] and readers.pdf_summary(again) == (3, False)
    fewer = classic({4: b"<< /Type /Pages /Parent 2 0 R /Kids [8 0 R] /Count 1 >>"}, before=again, prev=int(re.findall(rb"startxref\n(\d+)", again)[-1]))
    assert [s[2] for s in shown(fewer)] == [WANT[0][2], WANT[2][2]]


def test_encrypted_and_odd_files():
    assert readers.pdf_summary(classic(BASE, extra=b" /Encrypt 30 0 R")) == (3, True)
    assert [s[2] for s in shown(classic(BASE, extra=b" /Encrypt << /Filter /Standard >>"))] == [None] * 3
    told = classic({**BASE, 30: b"(a string with /Encrypt and /Type /Page)"})
    assert readers.pdf_summary(told) == (3, False)
    loop = classic({**BASE, 4: b"<< /Type /Pages /Kids [5 0 R 2 0 R 4 0 R 8 0 R] >>"})
    assert len(shown(loop)) == 3
    for odd in (b"", b"no file", b"%PDF-1.7\n", classic({1: b"<< /Type /Catalog >>"}), classic({1: b"<< /Type /Catalog /Pages 1 0 R >>"})):
        assert readers.pdf_summary(odd)[0] in (0, 1)
    unknown = classic({**BASE, 10: stream(b"x", b"/Filter /DCTDecode")})
    assert [s[2] for s in shown(unknown)] == [WANT[0][2], b"", None]


def test_files_cut_or_changed_anywhere_do_not_raise():
    content = compressed(BASE, True)
    for k in range(0, len(content), 7):
        assert 0 <= readers.pdf_summary(content[:k])[0] <= 3
        assert 0 <= readers.pdf_summary(content[:k] + b"<" + content[k + 1 :])[0] <= 6


def test_slices_hold_their_pages_and_nothing_of_the_others():
    for content in (classic(BASE), compressed(BASE, True)):
        cut = pdf.slice_pages(content, [3, 1])
        assert shown(cut) == [WANT[2], WANT[0]] and pdf.slice_pages(cut, [1, 2]) is not None
        only = pdf.Pdf(pdf.slice_pages(content, [2]))
        assert len(only.pages()) == 1 and b"hi" not in b"".join(only.decoded(o) for n in only.places if isinstance(o := only.get(pdf.Ref(n)), pdf.Stream))
        font = only.get(only.get(only.pages()[0][1]["Resources"])["Font"])["F1"]
        assert font == {"Type": "Font", "Parent": None}
        for wrong in ([], [0], [4]):
            with pytest.raises(pdf.Broken):
                pdf.slice_pages(content, wrong)
    with pytest.raises(pdf.Broken, match="encrypted"):
        pdf.slice_pages(classic(BASE, extra=b" /Encrypt 30 0 R"), [1])


def test_a_row_per_page_from_partitions_of_page_ranges(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "a.pdf").write_bytes(classic(BASE))
    (tmp_path / "in/b.PDF").write_bytes(compressed(BASE, False))
    (tmp_path / "c.txt").write_bytes(b"no")
    rows = sorted(readers.pdf_pages(spark, str(tmp_path)).collect(), key=lambda r: (r["path"], r["pdf_page"]))
    assert [(r["path"][-5:], r["pdf_page"], r["page_count"], r["rotate"], r["blank"], r["annotations"]) for r in rows] == [(n, p, 3, t, b, a) for n in ("a.pdf", "b.PDF") for p, t, b, a in ((1, 90, False, 2), (2, 0, True, 0), (3, 0, False, 0))]
    monkeypatch.setattr(pdf, "RANGE_BYTES", 300)
    reader = pdf.PageReader({"path": str(tmp_path / "a.pdf")})
    parts = reader.partitions()
    assert len(parts) > 2 and [r[1] for p in parts for r in reader.read(p)] == [1, 2, 3]
    files = spark.createDataFrame([(1, classic(BASE), [2, 3]), (2, None, [1])], "f int, content binary, pages array<int>")
    got = {r["f"]: r["slice"] for r in readers.sliced(files).collect()}
    assert shown(bytes(got[1])) == WANT[1:] and got[2] is None


def test_pages_of_documents_by_the_names_of_their_files(spark, tmp_path):
    (tmp_path / "manual_vol_ii_R9.pdf").write_bytes(classic(BASE))
    (tmp_path / "notes.pdf").write_bytes(classic(BASE))
    rows = readers.document_pages(spark, str(tmp_path)).orderBy("pdf_page").collect()
    assert [(r["document_id"], r["pdf_page"], r["blank"]) for r in rows] == [("keyword-volume-2", 1, False), ("keyword-volume-2", 2, True), ("keyword-volume-2", 3, False)]
