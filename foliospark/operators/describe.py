"""Title, description, tags and language, by a model or from the corpus itself."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from foliospark import values
from foliospark.functions.arrays import let
from foliospark.functions.text import WORD_BREAK, csv_items, first_words, squeeze, trim_control, truncate_text, words
from foliospark.operators.tables import union_by

# A word that occurs in more than 1/HOT_WORDS of all (document, word) rows is
# hot. There are fewer than HOT_WORDS such words in any corpus, whatever its
# size, so their table is always small enough to broadcast.
HOT_WORDS = 10_000
SENTENCE_BREAK = r"[.!?]\s+"
MIN_LETTERS = 4


def select_fields(csv: Column) -> Column:
    """Known field names of a comma list, in order; null means all of them."""
    known = F.array(*[F.lit(f) for f in values.AI_FIELDS])
    return F.when(csv.isNull(), known).otherwise(
        F.array_distinct(F.filter(csv_items(csv), lambda f: F.array_contains(known, f))))


def unknown_fields(csv: Column) -> Column:
    """Names in the list that no field has, as a comma list (for a warning)."""
    return F.coalesce(F.array_join(F.filter(csv_items(csv), lambda f: ~f.isin(values.AI_FIELDS)), ","), F.lit(""))


def build_requests(docs: DataFrame, fields: Column | None = None, model: str = values.AI_MODEL) -> DataFrame:
    """One chat request per document and field, as a JSON body."""
    wanted = select_fields(F.lit(None).cast("string") if fields is None else fields)
    prompts = F.create_map(*[F.lit(x) for pair in values.AI_PROMPTS.items() for x in pair])

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    body = F.to_json(F.struct(
        F.lit(model).alias("model"),
        F.array(message("system", prompts[F.col("field")]), message("user", F.col("_text"))).alias("messages"),
        F.lit(values.AI_TEMPERATURE).alias("temperature"),
        F.lit(values.AI_MAX_TOKENS).alias("max_tokens")))
    return docs.select("doc_id", truncate_text(F.col("text")).alias("_text"), F.explode(wanted).alias("field")).select(
        "doc_id", "field", body.alias("body"))


def call_model(requests: DataFrame, make_caller: Callable[[], Callable[[str], tuple[int, str]]],
               parallel: int | None = None, retries: int = 0, concurrency: int = 16, pause: float = 0.5) -> DataFrame:
    """Send every request; ``make_caller`` is called once for each thread and gives a function from request body to
    (status code, response body).

    A task has ``concurrency`` calls open at a time and hands the answers on in the order of its requests. A failing
    call is tried again after ``pause`` seconds, twice as long each time and varied by chance, so that those who failed
    together do not come again together; when it still fails it is a row with its error, never a failing job.
    """
    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor
        from random import uniform
        from threading import local
        from time import sleep

        own = local()

        def answer(body: str) -> tuple:
            if not hasattr(own, "caller"):
                own.caller = make_caller()
            for attempt in range(retries + 1):
                if attempt:
                    sleep(pause * 2 ** (attempt - 1) * uniform(0.5, 1.5))
                try:
                    code, text = own.caller(body)
                    error = None if code == 200 else f"HTTP {code}"
                except Exception as problem:
                    code, text, error = None, None, f"{type(problem).__name__}: {problem}"
                if error is None:
                    break
            return code, text, error

        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                answers = list(pool.map(answer, batch["body"]))
                out = batch[["doc_id", "field"]].copy()
                out["status_code"] = pd.array([a[0] for a in answers], dtype="Int32")
                out["response"] = [a[1] for a in answers]
                out["error"] = [a[2] for a in answers]
                yield out

    spread = requests if parallel is None else requests.repartition(parallel)
    key = requests.schema["doc_id"].dataType.simpleString()
    return spread.mapInPandas(
        ask, f"doc_id {key}, field string, status_code int, response string, error string")


def parse_responses(answers: DataFrame) -> DataFrame:
    """The answer text of each response; a response without one is an error row."""
    content = trim_control(F.get_json_object("response", "$.choices[0].message.content"))
    good = (F.col("status_code") == 200) & content.isNotNull()
    return answers.select(
        "doc_id", "field",
        F.when(good, content).alias("value"),
        F.when(good, "ok").otherwise("error").alias("status"),
        F.when(good, F.lit(None).cast("string")).otherwise(
            F.coalesce("error", F.when(F.col("status_code") != 200, F.concat(F.lit("HTTP "), F.col("status_code").cast("string"))),
                       F.lit("response without content"))).alias("error"))


def pivot_fields(parsed: DataFrame) -> DataFrame:
    """One row per document with a column per field; the locale is lower case."""
    names = {values.AI_KEYS[f].replace(".", "_"): f for f in values.AI_FIELDS}
    wide = parsed.groupBy("doc_id").pivot("field", values.AI_FIELDS).agg(F.first("value", ignorenulls=True))
    return wide.select("doc_id", *[
        (trim_control(F.lower(F.col(field))) if field == "language" else F.col(field)).alias(name)
        for name, field in names.items()])


def explode_tags(described: DataFrame, column: str = "tags") -> DataFrame:
    """One row per document and tag: trimmed, lower case, no blanks, no repeats."""
    return described.select("doc_id", F.explode(F.array_distinct(csv_items(F.lower(column)))).alias("tag"))


def check_ai_contract(described: DataFrame) -> DataFrame:
    """Does each answer keep to its format? (columns title, description, tags, language)"""
    def size_between(column: str, pattern: str) -> Column:
        parts = F.filter(F.split(column, pattern), lambda x: trim_control(x) != "")
        return F.coalesce(F.size(parts).between(5, 10), F.lit(False))

    return described.select(
        "doc_id",
        size_between("title", r"\s+").alias("title_ok"),
        size_between("tags", ",").alias("tags_ok"),
        F.coalesce(F.regexp_like("language", F.lit("^[a-z]{2}$")), F.lit(False)).alias("language_ok"),
        F.coalesce((F.trim("description") != "") & ~F.regexp_like("description", F.lit(r"\n\s*\n")), F.lit(False))
         .alias("description_ok"))


def offline_title(docs: DataFrame, n: int = 10) -> DataFrame:
    return docs.select("doc_id", first_words(F.col("text"), n).alias("title"))


def offline_language(docs: DataFrame, stopwords: dict[str, list[str]] | None = None) -> DataFrame:
    """Language with the most stop words, ties by code, null without any; counted inside the row."""
    lists = values.STOPWORDS if stopwords is None else stopwords

    def hits(tokens: Column, lang: str) -> Column:
        return F.size(F.filter(tokens, lambda w: w.isin(lists[lang])))

    def guess(tokens: Column) -> Column:
        return F.array_min(F.array(*[
            F.struct((-hits(tokens, lang)).alias("minus"), F.lit(lang).alias("lang")) for lang in sorted(lists)]))

    best = docs.select("doc_id", let(words(F.col("text")), guess).alias("best"))
    return best.select("doc_id", F.when(F.col("best.minus") < 0, F.col("best.lang")).alias("language"),
                       (-F.col("best.minus")).alias("hits"))


def _word_counts(text: Column) -> Column:
    """``array<struct<word, tf, places>>`` of one text: words that count, how often, and the sentence of each time."""
    sentences = F.split(F.lower(text), SENTENCE_BREAK)
    placed = F.flatten(F.transform(sentences, lambda sentence, pos: F.transform(
        F.filter(F.split(sentence, WORD_BREAK), lambda w: F.length(w) >= MIN_LETTERS),
        lambda w: F.struct(w.alias("word"), pos.alias("pos")))))

    def lasts(words: Column) -> Column:
        """Of each stretch of equal words in sorted order the last index."""
        ends = F.transform(words, lambda x, i: F.struct(
            x["word"].alias("word"), i.alias("i"), F.get(words, i + 1)["word"].alias("next")))
        return F.filter(ends, lambda x: x["next"].isNull() | (x["next"] != x["word"]))

    def stretch(words: Column, ends: Column) -> Column:
        def row(x: Column, k: Column) -> Column:
            before = F.coalesce(F.get(ends, k - 1)["i"], F.lit(-1))
            tf = x["i"] - before
            places = F.transform(F.slice(words, before + 2, tf), lambda w: w["pos"])
            return F.struct(x["word"].alias("word"), tf.cast("bigint").alias("tf"), places.alias("places"))
        return F.transform(ends, row)

    return let(F.sort_array(placed), lambda words: let(lasts(words), lambda ends: stretch(words, ends)))


def word_scores(docs: DataFrame, places: bool = False) -> DataFrame:
    """TF-IDF of each (document, word); ``places`` adds the sentences the word stands in, once for each time.

    Words are counted inside the document's row; only the document counts of words are grouped. Counts of
    hot words come by broadcast (see ``HOT_WORDS``), and their rows are dealt by document in the join of
    all others, so no word sends more than 1/HOT_WORDS of the rows to one task.
    """
    columns = ["word", "tf", "places"] if places else ["word", "tf"]
    per_doc = docs.select("doc_id", F.inline(_word_counts(F.col("text")))).select("doc_id", *columns)
    counts = per_doc.groupBy("word").agg(F.count("*").alias("df"))
    n_docs = docs.select(F.count("*").alias("n")).scalar()
    share = counts.select((F.sum("df") / HOT_WORDS).alias("share")).scalar()
    hot = counts.filter(F.col("df") > share).withColumnRenamed("df", "hot_df")
    cold = counts.filter(F.col("df") <= share).withColumnsRenamed({"word": "key"})
    marked = per_doc.join(F.broadcast(hot), "word", "left")
    # A blank is in no word, so the key of a hot row meets none of the others.
    key = F.when(F.col("hot_df").isNull(), F.col("word")).otherwise(F.concat(F.lit(" "), F.col("doc_id").cast("string")))
    scored = marked.withColumn("key", key).join(cold, "key", "left")
    df = F.coalesce("hot_df", "df")
    return scored.select("doc_id", *columns, df.alias("df"),
                         F.round(F.col("tf") * F.log((n_docs + 1) / (df + 1)), 6).alias("score"))


def offline_tags(docs: DataFrame, k: int = 10) -> DataFrame:
    """The k words with the highest TF-IDF of each document, ties by word."""
    w = Window.partitionBy("doc_id").orderBy(F.desc("score"), "word")
    return word_scores(docs).select("doc_id", "word", "tf", "score").withColumn(
        "rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def offline_description(docs: DataFrame, n: int = 3) -> DataFrame:
    """The n sentences with the highest mean TF-IDF, in text order; null for a text without words that count."""
    by_sentence = word_scores(docs, places=True).select("doc_id", F.explode("places").alias("pos"), "score").groupBy(
        "doc_id", "pos").agg(F.round(F.avg("score"), 6).alias("score"))
    w = Window.partitionBy("doc_id").orderBy(F.desc("score"), "pos")
    best = by_sentence.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    chosen = best.groupBy("doc_id").agg(F.array_sort(F.collect_list("pos")).alias("chosen"))
    parts = F.split("text", SENTENCE_BREAK)
    text = let(parts, lambda s: F.array_join(F.transform(F.col("chosen"), lambda p: squeeze(F.get(s, p))), ". "))
    return docs.join(chosen, "doc_id", "left").select("doc_id", text.alias("description"))
