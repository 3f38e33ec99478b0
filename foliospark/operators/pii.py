"""Personal data in text: find, filter, summarise, redact.

Everything about one page is computed inside its row. Documents are never
shuffled to be analysed or redacted; only the long span table is grouped, and
there with map-side aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foliospark import values
from foliospark.functions import spans as S
from foliospark.functions.arrays import let
from foliospark.functions.text import csv_items
from foliospark.operators.tables import split_by_keys

RECOGNIZER_SCHEMA = ("entity_type string, pattern string, run string, needle string, score double, "
                     "validator string")
WORD = r"[\p{L}'’-]+"


def recognizers(spark: SparkSession) -> DataFrame:
    """The catalogue of patterns as a table, to be extended by ``unionByName``."""
    return spark.createDataFrame(values.RECOGNIZERS, RECOGNIZER_SCHEMA)


def _catalogue(table: DataFrame | None) -> list[tuple]:
    """Rows of the catalogue; each becomes one expression, so it is read on the driver."""
    if table is None:
        return values.RECOGNIZERS
    rows = table.select("entity_type", "pattern", "run", "needle", "score", "validator").collect()
    return [tuple(row) for row in rows]


def page_spans(text: Column, catalogue: list[tuple] | None = None) -> Column:
    """All spans of one page as an array, for every recognizer in the catalogue."""
    rows = values.RECOGNIZERS if catalogue is None else catalogue
    rules = F.array(*[F.struct(
        F.lit(entity).alias("entity_type"), F.lit(S.bounded(pattern, run)).alias("pattern"),
        F.lit(needle).cast("string").alias("needle"), F.lit(float(score)).alias("score"),
        F.lit(validator).cast("string").alias("validator"),
    ) for entity, pattern, run, needle, score, validator in rows])
    return F.when(_anything(text, rows), F.flatten(F.transform(rules, lambda rule: S.find(text, rule)))).otherwise(
        S.nothing())


def _narrowed(catalogue: list[tuple], entities: str | None, threshold: float | None) -> list[tuple]:
    """The recognizers whose spans can pass: others are not even searched for."""
    names = None if entities is None else {name.strip() for name in entities.split(",")}
    return [row for row in catalogue
            if (names is None or row[0] in names) and (threshold is None or row[4] >= threshold)]


def _anything(text: Column, catalogue: list[tuple]) -> Column:
    return reduce(lambda a, b: a | b, [S.occurs(text, S.bounded(row[1], row[2]), row[3]) for row in catalogue])


def wanted(spans: Column, entities: Column | None, threshold: Column | float | None) -> Column:
    """Spans of the listed types (csv) with at least the given score."""
    if entities is not None:
        spans = let(csv_items(entities),
                    lambda names: F.filter(spans, lambda s: F.array_contains(names, s["entity_type"])))
    if threshold is not None:
        level = F.lit(threshold) if isinstance(threshold, (int, float)) else threshold
        spans = F.filter(spans, lambda s: s["score"] >= level)
    return spans


def split_pages(docs: DataFrame, sep: str = "\f", text: str = "text") -> DataFrame:
    """One row per page; ``page_no`` counts from 0. No match can cross a page."""
    keys = [c for c in docs.columns if c != text]
    return docs.select(*keys, F.posexplode(F.split(text, _literal(sep))).alias("page_no", "text"))


def _literal(sep: str) -> str:
    return rf"\Q{sep}\E"


def detect_pii(pages: DataFrame, table: DataFrame | None = None, entities: str | None = None,
               threshold: float | None = None) -> DataFrame:
    """Pages to span rows with 0-based ``start`` and exclusive ``end``."""
    catalogue = _narrowed(_catalogue(table), entities, threshold)
    if not catalogue:
        return pages.select("doc_id", "page_no", F.inline(S.nothing()))
    return pages.filter(_anything(F.col("text"), catalogue)).select(
        "doc_id", "page_no", F.inline(page_spans(F.col("text"), catalogue)))


def filter_entities(spans: DataFrame, csv: str = values.DEFAULT_ENTITIES) -> DataFrame:
    return spans.filter(F.array_contains(csv_items(F.lit(csv)), F.col("entity_type")))


def filter_score(spans: DataFrame, threshold: float = values.DEFAULT_THRESHOLD) -> DataFrame:
    return spans.filter(F.col("score") >= threshold)


def pii_summary(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Per document: hasPII, entities, scoreMax, scoreAvg, count (from a span table)."""
    found = spans.groupBy("doc_id").agg(
        F.array_join(F.array_sort(F.collect_set("entity_type")), ",").alias("entities"),
        F.max("score").alias("scoreMax"),
        F.avg("score").alias("scoreAvg"),
        F.count("*").alias("count"))
    return docs.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id",
        F.col("count").isNotNull().alias("hasPII"),
        F.coalesce("entities", F.lit("")).alias("entities"),
        F.coalesce("scoreMax", F.lit(0.0)).alias("scoreMax"),
        F.coalesce("scoreAvg", F.lit(0.0)).alias("scoreAvg"),
        F.coalesce("count", F.lit(0)).alias("count"))


def summarise_documents(docs: DataFrame, sep: str = "\f", table: DataFrame | None = None) -> DataFrame:
    """The same summary straight from the texts: one narrow stage, nothing is shuffled."""
    catalogue = _catalogue(table)
    found = F.when(_anything(F.col("text"), catalogue), F.flatten(F.transform(
        F.split("text", _literal(sep)), lambda page: page_spans(page, catalogue)))
    ).otherwise(S.nothing())
    small = docs.select("doc_id", let(found, lambda s: F.struct(
        F.size(s).cast("bigint").alias("count"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(s, lambda x: x["entity_type"]))), ",").alias("entities"),
        F.array_max(F.transform(s, lambda x: x["score"])).alias("top"),
        F.aggregate(s, F.lit(0.0), lambda acc, x: acc + x["score"]).alias("total"))).alias("s"))
    return small.select(
        "doc_id",
        (F.col("s.count") > 0).alias("hasPII"),
        F.col("s.entities").alias("entities"),
        F.coalesce("s.top", F.lit(0.0)).alias("scoreMax"),
        F.coalesce(F.try_divide("s.total", "s.count"), F.lit(0.0)).alias("scoreAvg"),
        F.col("s.count").alias("count"))


def pii_metadata(summary: DataFrame) -> DataFrame:
    """Summary to long metadata rows; scores are left out. A null hasPII gives no rows."""
    return summary.filter(F.col("hasPII").isNotNull()).select(
        "doc_id",
        F.stack(F.lit(2),
                F.lit("pii.hasPII"), F.col("hasPII").cast("string"),
                F.lit("pii.entities"), F.col("entities")).alias("key", "value"))


def redact_spans(pages: DataFrame, spans: DataFrame, label: str = values.DEFAULT_LABEL) -> DataFrame:
    """Replace the spans of a span table by ``label`` (overlaps are merged first).

    Positions are gathered per page; only pages that may have a span are shuffled to meet them, the others pass by.
    For spans that come from the pattern catalogue ``redact_documents`` does the same without a join.
    """
    places = spans.groupBy("doc_id", "page_no").agg(
        F.collect_list(F.struct("start", "end")).alias("_places"))
    merged = places.select("doc_id", "page_no", S.merge(F.col("_places")).alias("_merged"))
    clear, met = split_by_keys(pages, spans, ["doc_id", "page_no"])
    hidden = met.join(merged, ["doc_id", "page_no"], "left").withColumn(
        "text", F.when(F.col("_merged").isNull(), F.col("text"))
                 .otherwise(S.replace(F.col("text"), F.col("_merged"), F.lit(label))))
    return clear.unionByName(hidden.select(pages.columns))


def redact_text(text: Column, catalogue: list[tuple] | None = None, entities: Column | None = None,
                threshold: Column | float | None = None, label: Column | str = values.DEFAULT_LABEL,
                everywhere: bool = False, ignore_case: bool = False) -> Column:
    """Redact one page as a column expression; options may differ from row to row.

    With ``everywhere`` each found string is hidden wherever it stands on the
    page, not only where it was found.
    """
    mark = F.lit(label) if isinstance(label, str) else label
    found = wanted(page_spans(text, catalogue), entities, threshold)

    def hide(t: Column, spans: Column) -> Column:
        if everywhere:
            spans = S.occurrences(t, F.transform(spans, lambda s: s["matched"]), ignore_case)
        return S.replace(t, S.merge(spans), mark)

    return let(text, lambda t: let(found, lambda h: F.when(F.size(h) == 0, t).otherwise(hide(t, h))))


def redact_documents(docs: DataFrame, sep: str = "\f", table: DataFrame | None = None,
                     entities: str | None = None, threshold: float | None = None,
                     label: str = values.DEFAULT_LABEL, everywhere: bool = False, ignore_case: bool = False,
                     out: str = "text") -> DataFrame:
    """Whole documents redacted page by page and put together again inside their rows."""
    catalogue = _narrowed(_catalogue(table), entities, threshold)
    if not catalogue:
        return docs.withColumn(out, F.col("text"))
    pages = F.transform(F.split("text", _literal(sep)), lambda page: redact_text(
        page, catalogue, label=label, everywhere=everywhere, ignore_case=ignore_case))
    return docs.withColumn(out, F.when(_anything(F.col("text"), catalogue), F.array_join(pages, sep))
                                 .otherwise(F.col("text")))


def redact_occurrences(pages: DataFrame, spans: DataFrame, label: str = values.DEFAULT_LABEL,
                       ignore_case: bool = False) -> DataFrame:
    """Hide every place on the page where a found string stands, not only the found place.

    Only pages that may have a found string are shuffled.
    """
    found = spans.groupBy("doc_id", "page_no").agg(F.collect_set("matched").alias("_found"))
    merged = S.merge(S.occurrences(F.col("text"), F.col("_found"), ignore_case))
    clear, met = split_by_keys(pages, spans, ["doc_id", "page_no"])
    hidden = met.join(found, ["doc_id", "page_no"], "left").withColumn(
        "text", F.when(F.col("_found").isNull(), F.col("text"))
                 .otherwise(S.replace(F.col("text"), merged, F.lit(label))))
    return clear.unionByName(hidden.select(pages.columns))


def join_pages(pages: DataFrame, sep: str = "\f") -> DataFrame:
    """Pages back to one text per document; a group is one document, never more."""
    ordered = F.array_sort(F.collect_list(F.struct("page_no", "text")))
    return pages.groupBy("doc_id").agg(
        F.array_join(F.transform(ordered, lambda p: p["text"]), sep).alias("text"))


# Words of a name that every word of a page is followed by; longer names are looked for where these stand.
NEAR_WORDS = 4


def detect_names(pages: DataFrame, names: DataFrame, score: float = values.PERSON_SCORE) -> DataFrame:
    """PERSON spans by dictionary, ``names(name)``; a name is one word or any number of words parted by single blanks.

    Each word of a page first meets the first words of all names, and where one may begin, the runs of up to
    ``NEAR_WORDS`` words meet all names of that length: both in bitmaps of a fixed size, inside the page's task. Only
    runs that may be a name go on to be looked up whole. Where the first words of a longer name stand, the
    page itself is asked for the rest; other pages are not touched by long names. Catalyst broadcasts the name tables
    while they are small and joins by shuffle beyond that, where adaptive execution splits skewed words. What is shuffled
    then grows with the names found, not with the words of all pages. Other entries of ``names`` match nothing.
    """
    known = names.select(F.col("name").alias("matched")).filter(
        F.regexp_like("matched", F.lit(rf"^{WORD}(?: {WORD})*+$"))).distinct().withColumn("n", F.size(F.split("matched", " ")))
    long = known.where(F.col("n") > NEAR_WORDS).withColumn("head", F.substring_index("matched", " ", NEAR_WORDS))
    asked = known.where(F.col("n") <= NEAR_WORDS).select("matched", "n", F.lit(False).alias("goes_on"))
    asked = asked.unionByName(long.select(F.col("head").alias("matched"), F.lit(NEAR_WORDS).alias("n"), F.lit(True).alias("goes_on")).distinct())
    starts = _word_starts(pages)
    at = starts.select("doc_id", "page_no", "t", F.posexplode("t.starts").alias("i", "start"))
    runs = at.select("doc_id", "page_no", "i", "start", F.get("t.words", F.col("i")).alias("first"), _run(F.lit(NEAR_WORDS)).alias("run"))
    _, begun = split_by_keys(runs, asked.select(F.substring_index("matched", " ", 1).alias("first")), ["first"])
    grams = begun.select("doc_id", "page_no", "i", "start", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("run")), lambda n: F.array_join(F.slice("run", F.lit(1), n), " "))).alias("matched"))
    _, grams = split_by_keys(grams, asked, ["matched"])
    met = grams.join(asked.drop("n"), "matched")
    found = met.where("NOT goes_on").select("doc_id", "page_no", "start", "matched")
    if not long.isEmpty():
        found = found.unionByName(_long_names(pages, met.where("goes_on"), long))
    return found.select(
        "doc_id", "page_no",
        F.lit("PERSON").alias("entity_type"),
        "start",
        (F.col("start") + F.length("matched")).alias("end"),
        "matched",
        F.lit(score).alias("score"))


def _word_starts(pages: DataFrame) -> DataFrame:
    """``t``: the words of each page, whether a single blank stands before each (and behind the last), and where they start."""
    return pages.select("doc_id", "page_no", let(F.col("text"), lambda t: let(
        F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), lambda w: F.struct(
            w.alias("words"), F.transform(F.split(t, WORD), lambda gap: gap == " ").alias("blank"),
            S.positions(t, F.lit(WORD), w).alias("starts")))).alias("t"))


def _run(most: Column) -> Column:
    """Words from ``i`` on, at most so many, up to the first gap that is not a single blank."""
    broken = F.array_position(F.slice("t.blank", F.col("i") + 2, most - 1), F.lit(False)).cast("int")
    return F.slice("t.words", F.col("i") + 1, F.when(broken == 0, most).otherwise(broken))


def _long_names(pages: DataFrame, heads: DataFrame, long: DataFrame) -> DataFrame:
    """Names of more than ``NEAR_WORDS`` words at the places where their first words stand."""
    sizes = long.groupBy("head").agg(F.collect_set("n").alias("sizes"))
    places = heads.join(sizes, heads["matched"] == sizes["head"]).select("doc_id", "page_no", "i", "start", "sizes")
    by_page = places.groupBy("doc_id", "page_no").agg(F.collect_list(F.struct("i", "start", "sizes")).alias("places"))
    _, met = split_by_keys(pages.select("doc_id", "page_no", "text"), places, ["doc_id", "page_no"])
    rows = _word_starts(met).join(by_page, ["doc_id", "page_no"]).select("doc_id", "page_no", "t", F.inline("places"))
    runs = rows.select("doc_id", "page_no", "start", "sizes", _run(F.array_max("sizes")).alias("run"))
    grams = runs.select("doc_id", "page_no", "start", "run", F.explode("sizes").alias("n")).filter(F.col("n") <= F.size("run")).select(
        "doc_id", "page_no", "start", F.array_join(F.slice("run", F.lit(1), F.col("n")), " ").alias("matched"))
    return grams.join(long.select("matched"), "matched").select("doc_id", "page_no", "start", "matched")
