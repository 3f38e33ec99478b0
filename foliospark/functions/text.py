"""Text clean-up and tokenising."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from foliospark import values
from foliospark.functions.arrays import let

WORD_BREAK = r"[^\p{L}]+"


def decode_utf8(content: Column) -> Column:
    """Bytes as text; malformed bytes become U+FFFD, nothing raises."""
    return F.make_valid_utf8(content.cast("string"))


def trim_control(text: Column) -> Column:
    """Cut every character up to U+0020 from both ends (``trim`` cuts spaces only)."""
    return F.regexp_replace(F.regexp_replace(text, r"^[\x00-\x20]+", ""), r"[\x00-\x20]+$", "")


def squeeze(text: Column) -> Column:
    """Runs of white space become one space, ends are cut."""
    return F.trim(F.regexp_replace(text, r"[\s\x{a0}]+", " "))


def words(text: Column) -> Column:
    """Lower-case letter runs, in text order (empty strings removed)."""
    return F.array_remove(F.split(F.lower(text), WORD_BREAK), "")


def first_words(text: Column, n: int) -> Column:
    return F.array_join(F.slice(F.split(squeeze(text), " "), 1, n), " ")


def truncate_text(text: Column, n: int = values.AI_MAX_CHARS) -> Column:
    """The first n characters."""
    return F.left(text, F.lit(n))


def csv_items(text: Column) -> Column:
    """Comma list as trimmed, non-empty items in order."""
    return F.filter(F.transform(F.split(text, ","), lambda x: trim_control(x)), lambda x: x != "")


def replace_each(text: Column, pattern: str, replacement: Callable[[Column], Column]) -> Column:
    """Replace every match by what ``replacement`` makes of its first group.

    One pass for any number of different replacements.
    """
    def weave(t: Column) -> Column:
        new = F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(1)), replacement)
        return F.array_join(F.zip_with(
            F.split(t, pattern), new, lambda gap, x: F.concat(gap, F.coalesce(x, F.lit("")))), "")

    return let(text, weave)
