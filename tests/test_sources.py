"""Extraction, manifests and streams."""

import io
import json
import zipfile

import pytest

from filingspark.sources import extract, manifests, snapshots
from filingspark.streaming import state as streams


def archive(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), data)
    return out.getvalue()


def test_html():
    assert extract.html_text("<p>A &amp; B</p><!-- no --><script>x()</script><style>y</style><div>C  D</div>") == "A & B\nC D"


def test_references_without_semicolons(spark):
    page = "<title>a&&amp;&amp</title><p>&lt;b&gt; &#38; &notit; &copy 1&amp;lt;</p><script>x &amp</script><a href='?a&amp'>AT&T</a>"
    assert extract.html_text(page) == "a&&&\n<b> & ¬it; © 1&lt;\nAT&T"
    want = "a&&&amp\n<b> & &notit; &copy 1&lt;\nAT&T"
    assert extract.html_text(page, closed=True) == want
    assert extract.html_pages(spark.createDataFrame([(1, page), (2, None)], "page_id int, html string"), closed=True).collect() == [(1, want), (2, None)]


def test_files_and_members_without_semicolons(spark):
    page = b"<p>a&amp</p>"
    files = [("a.html", None, page), ("b", "text/html", page), ("c.zip", None, archive(d_dot_htm=page))]
    df = spark.createDataFrame(files, "path string, content_type string, content binary")
    for closed, text in ((False, "a&"), (True, "a&amp")):
        got = {r.path: r.text for r in extract.extract_files(df, closed).collect()}
        assert got == {"a.html": text, "b": text, "c.zip": f"===== FILE: d.htm =====\n{text}"}


def test_docx_and_xlsx():
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    cell = lambda t: f"<w:tc><w:p><w:r><w:t>{t}</w:t></w:r></w:p></w:tc>"
    doc = f"<w:document {w}><w:body><w:p><w:r><w:t>One</w:t></w:r></w:p><w:p/><w:tbl><w:tr>{cell('a')}{cell('b')}</w:tr></w:tbl></w:body></w:document>"
    assert extract.docx_text(archive(word__document_dot_xml=doc)) == "One\na b"
    m, r = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"', 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    book = f'<workbook {m} {r}><sheets><sheet name="Other" r:id="r1"/><sheet name="Balance" r:id="r2"/></sheets></workbook>'
    rels = '<Relationships><Relationship Id="r1" Target="s1.xml"/><Relationship Id="r2" Target="s2.xml"/></Relationships>'
    sheet = lambda cells: f"<worksheet {m}><sheetData><row r='1'>{cells}</row></sheetData></worksheet>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", book)
        z.writestr("xl/_rels/workbook.xml.rels", rels)
        z.writestr("xl/s1.xml", sheet('<c r="B1"><f>1+1</f></c>'))
        z.writestr("xl/s2.xml", sheet('<c r="A1" t="inlineStr"><is><t>Assets</t></is></c><c r="B1"><v>1000</v></c><c r="Z1"/>'))
    assert extract.xlsx_text(out.getvalue()) == "===== SHEET: Balance =====\nSHEET PRIORITY: GENERAL\nROW 1 | Assets | 1000\n\n\n===== SHEET: Other =====\nSHEET PRIORITY: GENERAL\nROW 1 | | [FORMULA_NO_CACHED_VALUE B1: =1+1]"
    assert extract.sheet_priority("1410000", ["laporan", "arus kas"]) == 0 and extract.sheet_priority("Balance Sheet tokens", []) == 3 and extract.sheet_priority("Catatan", ["arus kas"]) == 2
    assert "[TRUNCATED: spreadsheet cell limit" in extract.xlsx_text(out.getvalue(), cap=2)


def test_archives(spark):
    text, method = extract.extract("a.zip", "", archive(a_dot_txt="hello", b_dot_html="<p>x</p>", c_dot_bin="?"))
    assert method == "zip[text+html]" and "hello" in text and "x" in text
    for bad in (archive(**{"..__x_dot_txt": "a"}), archive(x_dot_bin="a"), archive(**{f"m{i}_dot_txt": "a" for i in range(101)})):
        with pytest.raises(ValueError):
            extract.extract("a.zip", "", bad)
    files = spark.createDataFrame([("a.txt", None, bytearray(b"A  b")), ("a.exe", None, bytearray(b"")), ("x", "text/html", bytearray(b"<b>t</b>"))], "path string, content_type string, content binary")
    out = {r.path: (r.text, r.method, r.error) for r in extract.extract_files(files).collect()}
    assert out["a.txt"] == ("A b", "text", None) and out["x"] == ("t", "html", None) and out["a.exe"][2] == "unsupported file type .exe"


def manifest(tmp_path, rows, complete=True):
    path = tmp_path / "manifest.json"
    path.write_text(json.dumps({"schemaVersion": "1", "coverage": {"complete": complete}, "disclosures": rows}))
    return str(path)


def row(i="m1", at="2026-08-05T10:00:00+07:00", path="a.pdf"):
    return {"externalId": i, "ticker": " bbri ", "announcedAt": at, "title": "T", "attachments": [{"path": path}]}


def test_manifests(spark, tmp_path):
    window = ("2026-08-05T09:00:00+07:00", "2026-08-05T11:00:00+07:00")
    path = manifest(tmp_path, [row(), row("m2", "2026-08-05T12:00:00+07:00")])
    found, complete = manifests.read_manifest(spark, path, *window)
    assert [(r.id2, r.ticker) for r in found.collect()] == [("m1", "BBRI")] and not complete
    assert manifests.read_manifest(spark, path, *window, attest=True)[1]
    for rows, why in (([row(at="2026-08-05T10:00:00")], "naive"), ([row(path="../x")], "paths"), ([row(path="/x")], "paths"), ([row(), row()], "repeated")):
        with pytest.raises(ValueError, match=why):
            manifests.read_manifest(spark, manifest(tmp_path, rows), *window)


def test_pages_and_reports(spark, tmp_path):
    reply = lambda i: {"pengumuman": {"Id2": i, "TglPengumuman": "2026-08-05T10:00:00", "Kode_Emiten": "EPAC   ", "JudulPengumuman": " T "}, "attachments": [{"OriginalFilename": "a.pdf", "IsAttachment": True}]}
    (tmp_path / "p1.json").write_text(json.dumps({"ResultCount": 3, "Replies": [reply("a"), reply("b"), reply("a")]}))
    (tmp_path / "p2.json").write_text(json.dumps({"ResultCount": 5, "Replies": [reply("b")]}))
    out = manifests.read_pages(spark, f"{tmp_path}/*.json")
    assert sorted((r.id2, r.ticker, str(r.announced_at)) for r in out.collect()) == [("a", "EPAC", "2026-08-05 03:00:00"), ("b", "EPAC", "2026-08-05 03:00:00")]
    report = {r.shard: r.complete for r in manifests.shard_report(spark.createDataFrame([("x", "a", 2), ("x", "a", 2), ("y", "b", 2)], "shard string, id2 string, reported int")).collect()}
    assert report == {"x": True, "y": False}
    spark.dataSource.register(manifests.PagedSource)
    assert spark.read.format("paged").load(str(tmp_path)).count() == 4
    assert spark.read.format("paged").load(f"file://{tmp_path}").count() == 4


def test_reference_lists(spark):
    texts = ['{"data": [{"code": "bbri"}, {"code": "AB-W"}, {"name": "none"}], "note": "x y z"}', '["abcd", {"Kode_Emiten": "", "symbol": " ef "}, 7, "toolongcode"]', '{"Results": {"items": ["zz"]}}', '{"aa": {"x": 1}, "bb": {"ticker": "cc"}, "n": 2}', "nope", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    out = {}
    for r in snapshots.reference_tickers(rows, "t", "k").collect():
        out.setdefault(r.k, set()).add(r.ticker)
    assert out == {0: {"BBRI", "AB-W"}, 1: {"ABCD", "EF"}, 2: {"ZZ"}, 3: {"AA", "CC"}}


def test_files_are_verified(spark):
    import hashlib

    want = spark.createDataFrame([("a", hashlib.sha256(b"1").hexdigest()), ("b", "0" * 64), ("c", None)], "path string, sha256 string")
    files = spark.createDataFrame([("a", bytearray(b"1")), ("b", bytearray(b"2"))], "path string, content binary")
    assert {r.path: r.status for r in manifests.verify_files(want, files).collect()} == {"a": "ok", "b": "mismatch", "c": "missing"}


def test_streams(spark, tmp_path):
    events = spark.createDataFrame([(i, f"2026-08-05 0{i % 5}:00:00", "k") for i in range(10)], "id long, ts string, k string").selectExpr("id", "cast(ts as timestamp_ntz) as ts", "k")
    source = str(tmp_path / "in")
    events.write.parquet(source)
    events.write.mode("append").parquet(source)
    stream = streams.dedupe_stream(streams.read_events(spark, source, "id long, ts timestamp_ntz, k string"), "id", "ts", "1 day")
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    streams.commit_batches(stream, target, checkpoint).awaitTermination()
    assert spark.read.parquet(target).count() == 10
    streams.commit_batches(stream, target, checkpoint).awaitTermination()
    assert spark.read.parquet(target).count() == 10
    refused = str(tmp_path / "none")
    streams.commit_batches(stream, refused, str(tmp_path / "c2"), whole=lambda b: False).awaitTermination()
    assert not (tmp_path / "none").exists()
    counts = streams.windowed_counts(streams.read_events(spark, source, "id long, ts timestamp_ntz, k string"), "ts", "k")
    q = counts.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("counts").agg({"n": "sum"}).first()[0] == 20
