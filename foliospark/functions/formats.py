"""Small value formats: extensions, queues, languages, times, addresses, dates."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from foliospark import values
from foliospark.functions.text import trim_control


def lookup(table: dict[str, str], key: Column) -> Column:
    """Literal map lookup, null when the key is absent."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])[key]


def is_metadata(mime: Column) -> Column:
    return F.endswith(mime, F.lit(values.METADATA))


def mime_extension(mime: Column, family: str) -> Column:
    """File extension for a media type; ``family`` is a key of ``values.EXTENSIONS``."""
    table, default = values.EXTENSIONS[family]
    known = F.coalesce(lookup(table, mime), F.lit(default))
    if family != "result":
        return known
    return (F.when(is_metadata(mime), table[values.METADATA])
             .when(F.startswith(mime, F.lit(values.XLS)), table[values.XLS])
             .otherwise(known))


def extension_mime(path: Column) -> Column:
    """Media type for a file name, by its extension."""
    extension = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    return F.coalesce(lookup(values.SOURCE_TYPES, extension), F.lit("application/octet-stream"))


def engine_of(transformer: Column) -> Column:
    return F.coalesce(lookup({t[0]: t[1] for t in values.TRANSFORMERS}, transformer), transformer)


def queue_of(transformer: Column) -> Column:
    return F.concat(engine_of(transformer), F.lit(values.QUEUE_SUFFIX))


def ocr_language(language: Column, default: str = "eng") -> Column:
    """Two-letter code to OCR code; blank gives the default, anything else passes unchanged."""
    trimmed = trim_control(language)
    return (F.when(F.coalesce(trimmed, F.lit("")) == "", F.lit(default))
             .otherwise(F.coalesce(lookup(values.OCR_LANGUAGES, F.lower(trimmed)), trimmed)))


def whole_number(text: Column) -> Column:
    """Decimal integer with optional sign, null for anything else."""
    trimmed = trim_control(text)
    return F.when(trimmed.rlike(r"^[+-]?[0-9]+$"), trimmed.try_cast("int"))


def hhmmss(offset: Column, default: int = 1) -> Column:
    """Seconds (as text) to HH:MM:SS; blank or not a number gives the default."""
    n = F.coalesce(whole_number(offset), F.lit(default))

    def part(value: Column) -> Column:
        return F.format_string("%02d", value.cast("int"))

    return F.concat_ws(
        ":", part((n - n % 3600) / 3600), part((n % 3600 - n % 60) / 60), part(n % 60)
    )


def format_addresses(addresses: Column) -> Column:
    return F.coalesce(F.array_join(addresses, ", "), F.lit(""))


def format_date(ts: Column) -> Column:
    """``Thu Jan 01 12:00:00 UTC 2026`` in the session time zone; null gives an empty string."""
    return F.coalesce(F.date_format(ts, "EEE MMM dd HH:mm:ss zzz yyyy"), F.lit(""))
