import pathlib
import random
from datetime import timedelta

from pyspark.sql import functions as F

from foliospark import values
from foliospark.operators import metadata, pii, routing
from foliospark.plans import transforms
from foliospark.streaming import jobs


def request(docs):
    target = (F.when(F.col("source_mime") == values.HTML, values.MARKDOWN)
               .when(F.col("source_mime") == values.MARKDOWN, values.HTML).otherwise(values.METADATA))
    return docs.withColumn("target_mime", target).withColumn("options", F.from_json(F.lit("{}"), "map<string,string>"))


def test_stream_transform_and_restart(spark, tmp_path):
    inbox, out, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "cp"
    inbox.mkdir()
    (inbox / "a.html").write_text("<h1>A</h1>")
    (inbox / "b.md").write_text("# B")
    (inbox / "c.xml").write_text("<r><title>C</title></r>")
    (inbox / "d.zzz").write_text("?")
    ops = {"html2md": transforms.html2md, "md2html": transforms.md2html, "xmlextract": transforms.xmlextract}

    def run():
        jobs.stream_transform(spark, str(inbox), str(out), str(checkpoint), routing.builtin_registry(spark), ops,
                              request).awaitTermination()
        rows = spark.read.option("basePath", str(out)).parquet(*[str(p) for p in pathlib.Path(out).glob("queue=*/transformer=*/batch=*")])
        return {(r.queue, r.doc_id.rsplit("/", 1)[1], r.status) for r in rows.collect()}, rows

    first, rows = run()
    assert first == {("html2md-engine-queue", "a.html", "ok"), ("md2html-engine-queue", "b.md", "ok"), ("xml-engine-queue", "c.xml", "ok")}
    assert bytes(rows.filter("transformer = 'html2md'").first().content) == b"# A"
    assert bytes(rows.filter("transformer = 'xmlextract'").first().content) == b'{"cm:title":"C"}'
    rejected = spark.read.parquet(str(out / "rejected")).collect()
    assert [(r.doc_id.rsplit("/", 1)[1], r.status) for r in rejected] == [("d.zzz", "unsupported")]
    assert run()[0] == first
    (inbox / "e.html").write_text("<p>E")
    assert run()[0] == first | {("html2md-engine-queue", "e.html", "ok")}
    assert run()[1].count() == 4


def test_stream_equals_batch(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    stream = spark.readStream.schema(docs.schema).parquet(f"{sf}/documents[.]parquet")
    jobs.run_once(jobs.stream_redact(stream, "\n"), str(tmp_path / "out"), str(tmp_path / "cp"))
    batch = {tuple(r) for r in pii.redact_documents(docs, "\n").collect()}
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == batch


def test_stream_metadata(spark, tmp_path):
    rows = spark.createDataFrame([(1, "xml", "title", " T "), (2, "xml", "title", " "), (3, "xml", "zz", "v")],
                                 "doc_id int, extractor string, key string, value string")
    rows.write.parquet(str(tmp_path / "in"))
    mapping, _ = metadata.builtin_mapping(spark)
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    jobs.run_once(jobs.stream_metadata(stream, mapping), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert [tuple(r)[:4] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(1, "xml", "cm:title", "T")]


SCHEMA = "request_id bigint, ts timestamp_ntz, note string"


def deliver(spark, folder, *rows):
    """rows: (request, day, hour)"""
    spark.sql("SELECT * FROM VALUES " + ", ".join(
        f"({'NULL' if i is None else f'{i}L'}, timestamp_ntz'2024-01-{day:02d} {hour:02d}:00:00', '{n}')" for n, (i, day, hour) in enumerate(rows))
        + " t(request_id, ts, note)").coalesce(1).write.mode("append").parquet(str(folder / "in"))


def firsts(spark, folder, within=timedelta(hours=1), per_batch=1):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_batch).parquet(str(folder / "in"))
    jobs.run_deduped(stream, str(folder / "out"), str(folder / "cp"), within)
    return sorted((r.request_id or 0, r.ts.day, str(r.late) == "true") for r in spark.read.parquet(str(folder / "out")).collect())


def test_no_first_delivery_is_lost_in_batches_out_of_order(spark, tmp_path):
    deliver(spark, tmp_path, (1, 20, 1), (2, 20, 2), (2, 20, 3), (3, 20, 1), (None, 20, 1))
    assert firsts(spark, tmp_path) == [(0, 20, False), (1, 20, False), (2, 20, False), (3, 20, False)]
    deliver(spark, tmp_path, (4, 2, 1), (1, 20, 2), (3, 1, 1), (5, 20, 2))      # 4 is long behind
    expected = [(0, 20, False), (1, 20, False), (2, 20, False), (3, 20, False), (4, 2, True), (5, 20, False)]
    assert firsts(spark, tmp_path) == expected
    deliver(spark, tmp_path, (4, 2, 2), (6, 10, 1))
    deliver(spark, tmp_path, (2, 20, 2), (7, 25, 1), (6, 10, 1))
    deliver(spark, tmp_path, (8, 24, 1))
    assert firsts(spark, tmp_path) == sorted([*expected, (6, 10, True), (7, 25, False), (8, 24, True)])
    assert {p.name for p in (tmp_path / "out").glob("batch=*/late=*")} == {"late=false", "late=true"}


def test_all_firsts_of_many_batches(spark, tmp_path):
    """Every request is in two of twelve files of random order and time."""
    rng = random.Random(3)
    files = [[] for _ in range(12)]
    for request in range(200):
        for file in rng.sample(range(12), 2):
            files[file].append((request + 1, rng.randint(1, 28), rng.randint(0, 23)))
    for rows in files:
        deliver(spark, tmp_path, *rows)
    assert [x[0] for x in firsts(spark, tmp_path, per_batch=3)] == list(range(1, 201))


def test_a_batch_of_many_small_files_takes_few_tasks(spark, tmp_path):
    """Each task sends a result to the driver: neither looking up the files of a batch nor reading them takes one a file."""
    (tmp_path / "in").mkdir()
    for k in range(80):
        (tmp_path / "in" / f"{k}.html").write_text(f"<p>{k}")
    query = jobs.stream_transform(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), routing.builtin_registry(spark),
                                  {"html2md": transforms.html2md}, request)
    query.awaitTermination()
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(str(query.runId)) for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)) < 40
    rows = spark.read.parquet(str(tmp_path / "out" / "queue=html2md-engine-queue")).collect()
    assert {bytes(r.content).decode() for r in rows} == {str(k) for k in range(80)}
