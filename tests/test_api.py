from pyspark.sql import functions as F

from foliospark import values
from foliospark.api import Toolbox, register_pii_spans
from foliospark.plans import transforms

REQUEST = "doc_id int, source_mime string, target_mime string, size bigint, options map<string,string>, content binary"


def requests(spark):
    return spark.createDataFrame([
        (1, values.HTML, values.MARKDOWN, 5, {}, b"<h1>x</h1>"), (2, "a/b", "c/d", 5, {"level": "1"}, b"abc"),
        (3, "a/b", "c/d", 500, {}, b"abc"), (4, "a/b", "c/d", 5, {"zz": "1"}, b"abc"), (5, values.PDF, values.DOCX, 5, {}, b"%PDF"),
        (6, "no/type", "c/d", 5, {}, b"")], REQUEST)


def test_own_transformer(spark, tmp_path):
    box = Toolbox(spark, transforms={"html2md": transforms.html2md})
    box.register_transformer("reverse", [("a/b", "c/d", 100)], ["level"], lambda d: d.select(
        "doc_id", "target_mime", F.encode(F.reverse(F.decode("content", "UTF-8")), "UTF-8").alias("content"),
        F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error")))
    expected = {1: ("ok", b"# x"), 2: ("ok", b"cba"), 3: ("too_large", None), 4: ("bad_option", None),
                5: ("unsupported", None), 6: ("unsupported", None)}
    for staging in (None, str(tmp_path / "staged")):
        got = box.transform(requests(spark), staging).collect()
        assert {r.doc_id: (r.status, r.content and bytes(r.content)) for r in got} == expected
        assert len(got) == 6
    assert box.registry.count() == 43


def test_own_extractor(spark):
    box = Toolbox(spark)
    box.register_extractor("a", lambda d: d.select("doc_id", F.lit("x").alias("key"), F.lit(" v ").alias("value")), "x=cm:title\n")
    box.register_extractor("b", lambda d: d.select("doc_id", F.lit("y").alias("key"), F.lit("w").alias("value")), "y=cm:title\n")
    got = {tuple(r) for r in box.extract(requests(spark).limit(1)).collect()}
    assert got == {(1, "cm:title", "v")}
    assert {r.value for r in box.extract(requests(spark).limit(1), "last").collect()} == {"w"}


def test_pii_table_function(spark):
    register_pii_spans(spark)
    rows = spark.sql("SELECT s.* FROM VALUES ('a@b.co 4111111111111112'), (NULL) t(text), LATERAL pii_spans(text) s").collect()
    assert [tuple(r) for r in rows] == [("EMAIL_ADDRESS", 0, 6, "a@b.co", 1.0)]
