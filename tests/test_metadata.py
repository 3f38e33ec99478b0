import io
import zipfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from foliospark.operators import metadata
from foliospark.sources import files, parsers

META = "doc_id int, extractor string, key string, value string"


def test_xml(spark):
    rows = [
        (1, '<r xmlns:d="u"><d:title> A </d:title><b><c>x</c>y<c>z</c></b></r>'),
        (2, "<r><a>1</a><a>2</a><a> \n </a><!-- c --><b/></r>"), (3, "<r/>"), (4, "<r a='only'>text</r>"),
        (5, "<!DOCTYPE r [<!ENTITY e 'boom'>]><r><a>&e;</a></r>"), (6, "<r><a></r>"), (7, None),
        (8, '<?xml version="1.0" encoding="UTF-8"?>\n<document>\n  <title>Sample XML</title>\n</document>')]
    parsed = parsers.parse_xml(spark.createDataFrame(rows, "doc_id int, xml string")).cache()
    status = {r.doc_id: r.status for r in parsed.collect()}
    assert status == {1: "ok", 2: "ok", 3: "ok", 4: "ok", 5: "error", 6: "error", 7: "error", 8: "ok"}
    clean = {(r.doc_id, r.key, r.value) for r in metadata.last_of_each_key(parsed).collect()}
    assert clean == {(1, "title", "A"), (1, "b", "xyz"), (2, "a", "2"), (8, "title", "Sample XML")}


def workbook(core: str | None, name: str = "xl/workbook.xml") -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(name, "<workbook/>")
        if core is not None:
            z.writestr("docProps/core.xml", core)
    return out.getvalue()


def test_xlsx(spark):
    fields = ["title", "creator", "subject", "description", "keywords", "lastModifiedBy", "revision", "other"]
    full = "<c xmlns:d='u'>" + "".join(f"<d:{f}> {f} </d:{f}>" for f in fields) + "</c>"
    rows = [(1, workbook(full)), (2, workbook("<c><title> </title></c>")), (3, workbook(None)), (4, b"not a zip"),
            (5, workbook("<c>" + " " * 5_000_000 + "</c>")), (6, workbook(full, "xl/workbook.bin")),
            (7, workbook("<!DOCTYPE c><c/>"))]
    parsed = parsers.read_xlsx_properties(spark.createDataFrame(rows, "doc_id int, content binary")).cache()
    assert {r.doc_id: r.status for r in parsed.collect()} == {
        1: "ok", 2: "ok", 3: "ok", 4: "error", 5: "error", 6: "error", 7: "error"}
    got = {r.key: r.value for r in metadata.xlsx_metadata(parsed).collect()}
    assert got == {"excel.title": "title", "excel.author": "creator", "excel.subject": "subject",
                   "excel.description": "description", "excel.keywords": "keywords",
                   "excel.lastModifiedByUser": "lastModifiedBy", "excel.revision": "revision"}


def eml(text):
    return text.replace("\n", "\r\n").encode()


PART = "--b\nContent-Type: {}\n\n{}\n"


def multi(*parts, head="", end="--b--\n"):
    return eml(head + 'MIME-Version: 1.0\nContent-Type: multipart/mixed; boundary="b"\n\n'
               + "".join(PART.format(k, t) for k, t in parts) + end)


def test_eml(spark):
    rows = [
        (1, eml("From: sender@example.com\nTo: recipient@example.com\nSubject: Sample Email\n"
                "Date: Thu, 01 Jan 2026 12:00:00 +0000\nContent-Type: text/plain\n\nbody line\n")),
        (2, eml("From: A B <a@x.org>\nTo: c@x.org, \"D, E\" <d@x.org>\nSubject: =?utf-8?b?w7xi?=\n =?utf-8?q?er?=\n"
                "Date: Thu, 01 Jan 2026 01:00:00 +0200\n\nx")),
        (3, multi(("text/html", "<p>h</p>"), ("TEXT/Plain; charset=utf-8", "p1"), ("text/plain", "p2"))),
        (4, multi(("text/html", "h1"), ("text/html", "h2"), ("image/png", "zz"))),
        (5, multi(('multipart/alternative; boundary="c"', "--c\nContent-Type: text/plain\n\ndeep\n--c--"))),
        (6, eml("Content-Type: text/html\n\n<b>x</b>")), (7, eml("Content-Type: image/png\n\nxx")), (8, b""), (9, None),
        (10, eml("Subject: s\nDate: not a date\nContent-Type: text/plain; charset=nonsense\n\nx"))]
    docs = spark.createDataFrame(rows, "doc_id int, content binary")
    got = {r.doc_id: r for r in parsers.parse_eml(docs).collect()}
    first = got[1]
    assert (first.subject, first["from"], first.to, first.date, first.body) == (
        "Sample Email", "sender@example.com", "recipient@example.com", "Thu Jan 01 12:00:00 UTC 2026", "body line\r\n")
    assert (got[2].subject, got[2]["from"], got[2].to) == ("über", "A B <a@x.org>", 'c@x.org, "D, E" <d@x.org>')
    assert got[2].date == "Wed Dec 31 23:00:00 UTC 2025"
    assert [got[i].body for i in (3, 4, 5, 6, 7, 8, 9, 10)] == ["p1", "h2", "", "<b>x</b>", "", "", "", "x"]
    assert got[9].status == "error" and got[10].date == ""
    assert all(v is not None for r in got.values() for v in (r.subject, r["from"], r.to, r.date, r.body))
    assert {r.doc_id: r.body for r in parsers.parse_eml(docs, deep=True).collect()}[5] == "deep"


def test_blank_and_trim(spark):
    rows = [(1, "x", "a", "\t v \n"), (1, "x", "b", " \t\r\n"), (1, "x", "c", None), (1, "x", "d", " "), (1, "x", "e", " "),
            (1, "x", "f", "")]
    got = {r.key: r.value for r in metadata.put_if_not_blank(spark.createDataFrame(rows, META)).collect()}
    assert got == {"a": "v", "e": " "}


def test_mapping(spark, tmp_path):
    (tmp_path / "xml.properties").write_text(
        "# c\nnamespace.prefix.cm=urn:cm\n\n! also\ntitle = cm:title\ndescription=cm:description\nsubject=cm:description\nx=no:where\n")
    mapping, ns = metadata.load_mapping(spark, str(tmp_path))
    meta = spark.createDataFrame([
        (1, "xml", "title", "T"), (1, "xml", "subject", "S"), (1, "xml", "description", "D"), (1, "xml", "other", "O"),
        (2, "xml", "subject", "S2"), (2, "ai", "title", "not ours"), (3, "xml", "x", "v")], META)
    mapped = metadata.map_metadata(meta, mapping)

    def resolved(policy):
        return {(r.doc_id, r.property): r.value for r in metadata.resolve_collisions(mapped, policy, "/").collect()}

    base = {(1, "cm:title"): "T", (2, "cm:description"): "S2", (3, "no:where"): "v"}
    assert resolved("first") == {**base, (1, "cm:description"): "D"}
    assert resolved("last") == {**base, (1, "cm:description"): "S"}
    assert resolved("concat") == {**base, (1, "cm:description"): "D/S"}
    with pytest.raises(ValueError):
        resolved("none")
    first = metadata.resolve_collisions(mapped)
    names = {(r.doc_id, r.qname, r.status) for r in metadata.expand_qname(first, ns).collect()}
    assert names == {(1, "{urn:cm}title", "ok"), (1, "{urn:cm}description", "ok"), (2, "{urn:cm}description", "ok"),
                     (3, None, "error")}
    assert {r.doc_id: r.metadata_json for r in metadata.metadata_json(first).collect()}[1] == \
        '{"cm:description":"D","cm:title":"T"}'


def test_two_extractors(spark):
    a = spark.createDataFrame([(1, "ai.title", "T")], "doc_id int, key string, value string")
    b = spark.createDataFrame([(1, "excel.title", "E"), (2, "excel.author", "A")], "doc_id int, key string, value string")
    mapping, ns = metadata.builtin_mapping(spark)
    merged = metadata.merge_metadata(ai=a, excel=b)
    got = {(r.doc_id, r.property): r.value for r in metadata.resolve_collisions(metadata.map_metadata(merged, mapping)).collect()}
    assert got == {(1, "cm:title"): "T", (2, "cm:author"): "A"}
    assert {r.prefix for r in ns.collect()} == {"cm", "pii"}


def test_files(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.HTML").write_bytes(b"<p>x\xff</p>")
    (tmp_path / "in" / "deep" / "b.xyz").write_bytes(b"12345")
    (tmp_path / "in" / "c.pdf").write_bytes(b"%PDF")
    docs = files.read_documents(spark, str(tmp_path / "in"))
    assert {(r.doc_id.rsplit("/", 1)[1], r.source_mime, r.size) for r in docs.collect()} == {
        ("a.HTML", "text/html", 9), ("b.xyz", "application/octet-stream", 5), ("c.pdf", "application/pdf", 4)}
    assert files.read_documents(spark, str(tmp_path / "in"), "text/plain", max_bytes=4).count() == 1
    decoded = {r.doc_id[-5:]: (r.text, r.status) for r in files.decode_text(docs).collect()}
    assert decoded == {".HTML": ("<p>x�</p>", "ok"), "b.xyz": ("12345", "ok"), "c.pdf": (None, "unsupported")}


def test_a_folder_is_listed_and_read_by_tasks(spark, tmp_path):
    """The same rows as Spark's own reader, which keeps all files in the driver."""
    root = tmp_path / "in"
    names = ["a.txt", "empty.txt", ".hidden", "_hidden", "_a=b", "_metadata", "x._COPYING_", "d/_x/q.txt", "d/.y/q.txt",
             "d/_k=1/q.txt", "d/_metadata/q.txt", "d/_metadata/_metadata", "sp ace%41#?.txt", "line\nbreak.txt",
             "\u00fc.txt", "a/b/c/d/e/f.md", "back\\slash.txt", "st*r.txt", "large.bin", "larger.bin"]
    names += [f"many/{i}/{j}/{k}.txt" for i in range(8) for j in range(8) for k in range(3)]
    for name in names:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"" if "empty" in name else b"0" * (files.FLUSH + 1) if "large" in name else name.encode())
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "o.txt").write_bytes(b"linked")
    for name, target in {"link.txt": "a.txt", "links": tmp_path / "other", "nothing": "none", "self": "self"}.items():
        (root / name).symlink_to(target)
    for path in (str(root), f"file://{root}/a", f"{root}//d/./_x/../"):
        expected = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        docs = files.read_documents(spark, path)
        assert docs.inputFiles() == [] and docs.dtypes == [
            ("doc_id", "string"), ("source_mime", "string"), ("content", "binary"), ("size", "bigint")]
        assert sorted((r.doc_id, r.size, r.content) for r in docs.collect()) == sorted(
            (r.path, r.length, r.content) for r in expected.collect())
    assert files.read_documents(spark, str(root)).count() == 206
    assert files.read_documents(spark, str(root / "a.txt")).count() == 1
    assert files.read_documents(spark, str(root / "many" / "[01]")).count() == 48
    (tmp_path / "nothing").mkdir()
    assert files.read_documents(spark, str(tmp_path / "nothing")).count() == 0
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_documents(spark, str(tmp_path / "missing"))


def test_contents_are_read_where_asked_for(spark, tmp_path):
    for i in range(20):
        (tmp_path / f"{i}.txt").write_bytes(b"x" * (i + 1))
    docs = files.read_documents(spark, str(tmp_path))

    def evaluations(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython")

    assert evaluations(docs.select("doc_id", "source_mime", "size")) == 0
    assert evaluations(files.decode_text(docs)) == evaluations(docs) == 1
    # a file that a filter leaves out is not opened, one that is asked for and is too large is an error
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "10")
    try:
        docs = files.read_documents(spark, str(tmp_path))
        assert docs.count() == 20 and len(docs.where("size <= 10").collect()) == 10
        assert len(files.read_documents(spark, str(tmp_path), max_bytes=10).collect()) == 10
        with pytest.raises(Exception, match="more than the 10 that may be read"):
            docs.collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_checksums_beside_files_are_held(spark, tmp_path):
    spark.range(2000).selectExpr("string(id)").coalesce(1).write.text(str(tmp_path / "in"))
    docs = files.read_documents(spark, str(tmp_path / "in"))
    written, = (tmp_path / "in").glob("part-*")
    assert [bytes(r.content) for r in docs.collect()] == [written.read_bytes()]
    written.write_bytes(written.read_bytes()[:-3] + b"x\n\n")
    with pytest.raises(Exception, match="Checksum error"):
        docs.collect()
    (tmp_path / "in" / f".{written.name}.crc").write_bytes(b"no sums")
    assert docs.first().content.endswith(b"x\n\n")


def test_export_keeps_equal_names_apart(spark, tmp_path):
    results = spark.createDataFrame(
        [("file:/x/a", "text/plain", b"1"), ("file:/y/a", "text/plain", b"2"), ("/../../up", "image/png", b"3")],
        "doc_id string, target_mime string, content binary")
    done = files.export_files(results, f"file://{tmp_path}").collect()
    assert {r.status for r in done} == {"ok"}
    found = {str(p.relative_to(tmp_path)): p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()}
    assert found == {"txt/x/a.txt": b"1", "txt/y/a.txt": b"2", "png/_/_/up.png": b"3"}


def test_embed(spark):
    docs = spark.createDataFrame([(1, "a/b", b"\x00\xff")], "doc_id int, source_mime string, content binary")
    assert bytes(metadata.embed_passthrough(docs).first().content) == b"\x00\xff"
    assert docs.select(F.lit(1)).count() == 1


def test_every_document_has_a_result(spark):
    from foliospark import values
    from foliospark.plans import transforms
    rows = [(1, b"<r><price>3</price></r>"), (2, b"<r/>"), (3, b"<r><title>T</title></r>"), (4, b"<r>")]
    docs = spark.createDataFrame([(i, values.METADATA, c) for i, c in rows], "doc_id long, target_mime string, content binary")
    got = {r.doc_id: (bytes(r.content).decode() if r.content else None, r.status) for r in transforms.xmlextract(docs).collect()}
    assert got[1] == got[2] == ("{}", "ok") and "T" in got[3][0] and got[4][1] == "error" and len(got) == 4


def test_long_prefixes_stay_whole(spark):
    from foliospark.operators import metadata
    name = "p" * 2000
    texts = spark.createDataFrame([("x", f"namespace.prefix.{name}=uri")], "extractor string, text string")
    assert metadata.parse_mapping(texts)[1].first().prefix == name


def test_xml_in_its_declared_encoding_and_words_that_are_no_doctype(spark):
    text = '<?xml version="1.0" encoding="ISO-8859-1"?><r><!-- <!DOCTYPE x> --><title>Caf\xe9 <![CDATA[<!DOCTYPE html>]]></title></r>'
    rows = [(1, text.encode("latin-1")), (2, text.replace("ISO-8859-1", "UTF-16").encode("utf-16")),
            (3, b"<!DOCTYPE r [<!ENTITY a 'b'>]><r><title>&a;</title></r>"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, content binary")
    got = {r.doc_id: (r.value, r.status) for r in parsers.parse_xml(docs, "content").collect()}
    assert got[1] == got[2] == ("Caf\xe9 <!DOCTYPE html>", "ok")
    assert got[3] == (None, "error") and got[4] == (None, "error")
    texts = docs.filter("doc_id in (1, 3)").selectExpr("doc_id", "decode(content, 'ISO-8859-1') AS xml")
    assert {r.doc_id: r.status for r in metadata.guard_doctype(texts).collect()} == {1: "ok", 3: "error"}
