"""Finding, merging and replacing spans of text inside one row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from foliospark.functions.arrays import let, max_before, sums_before

SPAN = "array<struct<entity_type:string,start:int,end:int,matched:string,score:double>>"


def bounded(pattern: str, run: str | None) -> str:
    """``pattern`` that is not tried inside a run of ``run`` characters.

    A match found from the middle of such a run would also be found from its
    first character (or from the end of the match before), so nothing is lost,
    and a long unbroken run (base64, hashes) costs one try, not one per character.
    """
    return pattern if run is None else rf"(?:(?<![{run}])|\G)(?:{pattern})"


def luhn_valid(digits: Column) -> Column:
    """Check digit test; doubled digits count from the second-last place."""
    def place(digit: Column, i: Column) -> Column:
        value = digit.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(value > 9, value - 9).otherwise(value)

    values = F.transform(F.split(F.reverse(digits), ""), place)
    return F.aggregate(values, F.lit(0), lambda acc, x: acc + F.coalesce(x, F.lit(0))) % 10 == 0


VALIDATORS = {"luhn": luhn_valid}


def positions(text: Column, pattern: Column, matches: Column) -> Column:
    """0-based start of each match: gap and match lengths summed up."""
    gaps = F.transform(F.split(text, pattern), lambda g: F.length(g))

    def starts(g: Column, m: Column) -> Column:
        head = F.slice(g, F.lit(1), F.size(m))
        return F.zip_with(sums_before(F.zip_with(head, m, lambda a, b: a + F.length(b))), head,
                          lambda before, gap: before + gap)

    return let(gaps, lambda g: starts(g, matches))


def occurs(text: Column, pattern: str, needle: str | None = None) -> Column:
    """Does ``pattern`` match anywhere? Texts without ``needle`` are not searched."""
    found = F.regexp_like(text, F.lit(pattern))
    return found if needle is None else F.contains(text, F.lit(needle)) & found


def nothing() -> Column:
    return F.from_json(F.lit("[]"), SPAN)


def find(text: Column, rule: Column) -> Column:
    """All matches in ``text`` of one rule as an array of spans.

    ``rule`` is a struct (entity_type, pattern, needle, score, validator), so
    that one expression serves a whole list of rules.
    """
    pattern = rule["pattern"]

    def spans(t: Column) -> Column:
        found = let(F.regexp_extract_all(t, pattern, F.lit(0)), lambda m: F.zip_with(
            positions(t, pattern, m), m, lambda start, hit: F.struct(
                rule["entity_type"].alias("entity_type"),
                start.alias("start"),
                (start + F.length(hit)).alias("end"),
                hit.alias("matched"),
                rule["score"].alias("score"))))
        return F.filter(found, lambda s: F.coalesce(
            *[F.when(rule["validator"] == name, check(s["matched"])) for name, check in VALIDATORS.items()],
            F.lit(True)))

    present = F.contains(text, F.coalesce(rule["needle"], F.lit(""))) & F.regexp_like(text, pattern)
    return F.when(present, let(text, spans)).otherwise(nothing())


def occurrences(text: Column, needles: Column, ignore_case: bool = False) -> Column:
    """Every place where one of the strings ``needles`` stands, as ``array<struct<start, end>>``."""
    prefix = "(?iu)" if ignore_case else ""

    def places(needle: Column) -> Column:
        pattern = F.concat(F.lit(prefix + r"\Q"), F.replace(needle, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
        return let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.zip_with(
            positions(text, pattern, m), m,
            lambda start, hit: F.struct(start.alias("start"), (start + F.length(hit)).alias("end"))))

    return F.flatten(F.transform(F.array_distinct(needles), places))


def merge(spans: Column) -> Column:
    """Union of overlapping or touching spans as sorted ``array<struct<start, end>>``."""
    ordered = F.array_sort(F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    def unite(s: Column, furthest: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.get(s, i)["start"] > F.get(furthest, i))
        last = F.array_max(F.transform(s, lambda x: x["end"]))
        return let(first, lambda opens: F.transform(opens, lambda i, g: F.struct(
            F.get(s, i)["start"].alias("start"),
            F.coalesce(F.get(furthest, F.get(opens, g + 1)), last).alias("end"))))

    return let(ordered, lambda s: F.when(F.size(s) == 0, s).otherwise(
        let(max_before(F.transform(s, lambda x: x["end"])), lambda furthest: unite(s, furthest))))


def replace(text: Column, merged: Column, label: Column) -> Column:
    """``text`` with each merged span replaced by ``label``."""
    def pieces(m: Column) -> Column:
        end_before = F.transform(m, lambda x, i: F.coalesce(F.get(m, i - 1)["end"], F.lit(0)))
        kept = F.zip_with(m, end_before, lambda x, before: F.concat(
            F.substring(text, before + 1, x["start"] - before), label))
        tail = F.substring(text, F.element_at(m, -1)["end"] + 1, F.length(text))
        return F.concat(F.array_join(kept, ""), tail)

    return F.when(F.size(merged) > 0, let(merged, pieces)).otherwise(text)
