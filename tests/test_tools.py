import glob
import os
import tempfile
import time

from pyspark.sql import functions as F

from foliospark import values
from foliospark.operators import routing, tools
from foliospark.plans import transforms

DOCS = "doc_id int, content binary"


def test_run_tool(spark):
    docs = spark.createDataFrame([(i, f"doc {i}".encode()) for i in range(6)] + [(6, b"")], DOCS)
    sh = {0: ["cp", "{input}", "{output}"], 1: ["false"], 2: ["true"], 3: ["touch", "{output}"],
          4: ["sleep", "30"], 5: ["/no/such/tool"], 6: ["sh", "-c", "echo out; echo err >&2; exit 3"]}
    command = None
    for i, args in sh.items():
        array = F.array(*[F.lit(a) for a in args])
        command = F.when(F.col("doc_id") == i, array) if command is None else command.when(F.col("doc_id") == i, array)
    started = time.time()
    got = {r.doc_id: r for r in tools.run_tool(docs, command, ".txt", "out.txt", timeout=2).collect()}
    assert time.time() - started < 25
    assert bytes(got[0].content) == b"doc 0" and got[0].status == "ok"
    assert (got[1].status, got[1].exit_code) == ("error", 1)
    assert got[2].status == got[3].status == "error" and "no output" in got[2].log
    assert got[4].status == "timeout" and got[5].status == "error"
    assert (got[6].exit_code, got[6].log) == (3, "out\nerr\n")
    assert not glob.glob(os.path.join(tempfile.gettempdir(), "tool-*"))


def test_timeout_ends_children_too(spark):
    docs = spark.createDataFrame([(1, b"x")], DOCS)
    started = time.time()
    got = tools.run_tool(docs, ["sh", "-c", "sleep 60 & wait"], timeout=1).first()
    assert got.status == "timeout" and time.time() - started < 20


def test_pattern_output_prefers_the_stem(spark):
    docs = spark.createDataFrame([(1, b"x"), (2, b"y")], DOCS)
    script = F.when(F.col("doc_id") == 1, "echo a > {dir}/a.txt; echo i > {dir}/input.txt").otherwise(
        "echo b > {dir}/b.txt; echo c > {dir}/c.txt")
    got = tools.run_tool(docs, F.array(F.lit("sh"), F.lit("-c"), script), ".mp3", "*.txt").collect()
    assert {r.doc_id: bytes(r.content) for r in got} == {1: b"i\n", 2: b"b\n"}


def test_pick_output(spark):
    rows = [(1, "a.b.mp3", "z.txt"), (1, "a.b.mp3", "a.b.txt"), (2, ".mp3", "x.txt"), (2, ".mp3", ".mp3.txt"), (3, "a.mp3", "a.json")]
    files = spark.createDataFrame(rows, "doc_id int, input_name string, file_name string")
    assert {tuple(r) for r in tools.pick_output(files).collect()} == {
        (1, "a.b.txt", "ok"), (2, ".mp3.txt", "ok"), (3, None, "error")}


def test_commands(spark):
    rows = [(values.PDF, {"tocEnabled": "true", "tocDepth": "2", "language": " DE ", "timeOffset": "61", "model": "small"}),
            (values.DOCX, {})]
    df = routing.resolve_options(spark.createDataFrame(rows, "target_mime string, options map<string,string>"))

    def built(tool, **paths):
        return [r[0] for r in df.select(F.array_join(tools.build_command(tool, **paths), " ")).collect()]

    assert built("md2doc", lua_filter="/l", reference_doc="/d") == [
        "pandoc {input} -o {output} --standalone --toc --toc-depth=2 --pdf-engine=xelatex -V geometry:margin=2.5cm --lua-filter=/l",
        "pandoc {input} -o {output} --standalone --reference-doc=/d"]
    assert built("ocr") == ["ocrmypdf --skip-text -l deu {input} {output}", "ocrmypdf --skip-text -l eng {input} {output}"]
    assert built("videothumb")[0] == "ffmpeg -ss 00:01:01 -i {input} -vframes 1 -f image2 {output}"
    assert built("whisper")[0] == "whisper {input} --model small --output_format txt --output_dir {dir}"
    assert built("heic")[0] == "heif-convert {input} {output}"
    assert built("html2md")[0] == "pandoc -f html -t gfm {input} -o {output}"
    assert built("md2html")[0] == "pandoc -f markdown -t html5 --standalone {input} -o {output}"
    assert built("msg")[0] == "pandoc {input} -o {output} --pdf-engine=xelatex"
    assert built("pii", script="/r.py")[1] == ("python3 /r.py --input {input} --output {output} "
                                               "--entities PERSON,PHONE_NUMBER,EMAIL_ADDRESS --threshold 0.5 --label [REDACTED]")


def test_every_registered_transform_answers(spark):
    """Also where no converter is installed each document gets its row."""
    rows = [(f"{name}-{s}-{t}", s, t, b"x", {}) for name, _e, _o, groups in values.TRANSFORMERS
            for ss, ts, _l in groups for s in ss for t in ts]
    docs = spark.createDataFrame(rows, "doc_id string, source_mime string, target_mime string, content binary, options map<string,string>")
    scripts = {"pdf2docx": "/no/a.py", "convert2md": "/no/b.py", "pii": "/no/c.py"}
    table = transforms.builtin_transforms(scripts)
    assert set(table) == {t[0] for t in values.TRANSFORMERS}
    for name in ("heic", "whisper", "pdf-pii-redaction", "msg", "pdf-pii-metadata", "ai-metadata", "excelextract", "xmlextract"):
        mine = docs.filter(F.startswith("doc_id", F.lit(name + "-")))
        got = table[name](mine).collect()
        assert {r.doc_id for r in got} == {r.doc_id for r in mine.collect()}, name
        assert all((r.status == "ok") == (r.content is not None) for r in got), name


def test_tools_in_parallel_fill_the_cores(spark):
    docs = spark.createDataFrame([(i, f"doc {i}".encode(), [str(i)]) for i in range(30)], DOCS + ", tags array<string>")
    done = tools.run_tool(docs, ["cp", "{input}", "{output}"], parallel=3, keep=("tags",))
    assert done.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan       # a frame for each document took longer than its program
    assert sorted((r.doc_id, bytes(r.content).decode(), r.tags, r.status, r.exit_code, r.log) for r in done.collect()) == [
        (i, f"doc {i}", [str(i)], "ok", 0, "") for i in range(30)]
