"""URL filter: host and path rules, and a weighted vocabulary found by an Aho-Corasick automaton.

A rule's verdict stands. For other URLs the automaton counts terms that stand between characters other than
letters and digits: one strict term, or ``soft_limit`` distinct soft terms, block the URL.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Verdict, host, path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
STRICT = ("porn", "porno", "xxx", "hentai", "escort", "escorts", "casino", "viagra", "cialis", "warez", "torrent",
          "keygen", "malware", "phishing", "spam", "spammer", "gambling", "betting", "camgirl", "nsfw")
SOFT = ("adult", "sex", "sexy", "nude", "free", "win", "winner", "bonus", "cheap", "pills", "loan", "loans", "click",
        "farm", "prize", "jackpot", "poker", "slots", "bet", "dating", "hot", "promo", "ads", "ref", "utm", "feed",
        "coupon", "discount", "hack", "crack", "download")
SOFT_LIMIT = 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/ ? #``, A to Z lower-cased; empty without one."""
    host = F.regexp_extract(_after(url), r"^([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    """The part behind the first ``://``, empty for null or without one."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def rule_for(host: Column, path: Column, rules=None) -> Column:
    """The longest rule that fits as a struct of ``rule`` and ``verdict``, null without one."""
    rules = sorted(RULES if rules is None else rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = [F.when(((host == rh) | host.endswith("." + rh)) & path.startswith(rp),
                   F.struct(F.lit(rh + rp).alias("rule"), F.lit(verdict).alias("verdict"))) for verdict, rh, rp in rules]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


class Vocabulary:
    def __init__(self, strict=STRICT, soft=SOFT):
        import ahocorasick
        self.strict, self.automaton = frozenset(strict), ahocorasick.Automaton()
        for term in {*strict, *soft}:
            self.automaton.add_word(term, term)
        if len(self.automaton):
            self.automaton.make_automaton()

    def counts(self, url: str | None) -> tuple[int, int]:
        """Strict hits, and distinct soft terms."""
        text = (url or "").translate(_FOLD)
        strict, soft = 0, set()
        if not text or not len(self.automaton):
            return 0, 0
        for end, term in self.automaton.iter(text):
            start = end - len(term)
            if (start >= 0 and text[start] in _INSIDE) or (end + 1 < len(text) and text[end + 1] in _INSIDE):
                continue
            if term in self.strict:
                strict += 1
            else:
                soft.add(term)
        return strict, len(soft)


_FOLD = str.maketrans(_UPPER, _LOWER)
_INSIDE = frozenset(_LOWER + "0123456789")


def judge(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", rules=None, strict=STRICT,
          soft=SOFT, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """``page_id, host, path, rule, verdict, strict_hits, soft_terms`` for every row.

    A null URL or one without ``://`` has an empty host and path, no rule, and is judged by its terms (a null
    one has none and is allowed). Repeated rows are judged each, an empty table gives an empty one, other
    columns are not read. One narrow stage, no shuffle.
    """
    def run(batches):
        vocabulary = Vocabulary(strict, soft)
        for batch in batches:
            found = [vocabulary.counts(u.as_py()) for u in batch.column(1)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([s for s, _ in found], pa.int64()),
                                   pa.array([s for _, s in found], pa.int64())],
                                  ["page_id", "url", "strict_hits", "soft_terms"])

    selected = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("url"))
    kind = selected.schema["page_id"].dataType.simpleString()
    counted = selected.mapInArrow(run, f"page_id {kind}, url string, strict_hits long, soft_terms long")
    by_terms = F.when((F.col("strict_hits") > 0) | (F.col("soft_terms") >= soft_limit), "block").otherwise("allow")
    return (counted.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
            .withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
            .select("page_id", "host", "path", F.col("found.rule").alias("rule"),
                    F.coalesce(F.col("found.verdict"), by_terms).alias("verdict"), "strict_hits", "soft_terms"))
