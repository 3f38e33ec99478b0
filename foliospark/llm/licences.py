"""Licence scan: an Aho-Corasick automaton over words, and licence expressions by a shunting-yard parser.

Letters A to Z are lower-cased; a word is a run of digits, letters a to z and characters beyond ASCII. The
automaton runs over the words joined by single blanks, so a phrase is found wherever its words stand
consecutively. Where the words of an identifier tag are found, the expression behind it is read from the
text up to the end of its line and evaluated.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm import shared

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notice phrases: label, and how surely the phrase alone marks a licensed text.
NOTICES = {
    "gnu lesser general public license": ("lgpl", 0.9),
    "gnu affero general public license": ("agpl", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "eclipse public license": ("epl", 0.9),
    "bsd license": ("bsd", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "permission is hereby granted free of charge": ("mit", 0.9),
    "permission to use copy modify and or distribute this software": ("isc", 0.9),
    "isc license": ("isc", 0.9),
    "boost software license": ("bsl", 0.9),
    "the unlicense": ("unlicense", 0.8),
    "creative commons zero": ("cc0", 0.9),
    "cc0": ("cc0", 0.8),
    "creative commons attribution": ("cc-by", 0.9),
    "creative commons": ("creative-commons", 0.7),
    "cc by sa": ("cc-by-sa", 0.8),
    "cc by nc": ("cc-by-nc", 0.8),
    "cc by nd": ("cc-by-nd", 0.8),
    "public domain": ("public-domain", 0.5),
    "all rights reserved": ("all-rights-reserved", 0.6),
    "licensed under the": ("licensed", 0.5),
    "licensed under": ("licensed", 0.4),
    "released under the": ("licensed", 0.3),
}
TAGS = ("spdx license identifier", "license identifier")
BASE_SCORE, TAG_SCORE = 0.9, 1.0

# How much a licence asks of those who use the text, from nothing (0) to everything (4).
STRENGTH = {
    **dict.fromkeys(("cc0", "unlicense", "0bsd", "wtfpl", "mit-0", "pddl"), 0),
    **dict.fromkeys(("mit", "isc", "bsd", "apache", "bsl", "zlib", "cc-by", "afl", "beerware", "blueoak", "bzip2", "curl", "fsfap", "ftl", "hpnd", "icu",
                     "ijg", "json", "libpng", "ms-pl", "ncsa", "ntp", "odc-by", "openssl", "php", "postgresql", "psf", "python", "ruby", "sleepycat",
                     "tcl", "unicode", "upl", "vim", "w3c", "x11", "zpl"), 1),
    **dict.fromkeys(("artistic", "mpl", "epl", "cddl", "lgpl", "cpl", "ipl", "ms-rl", "ofl", "apsl"), 2),
    **dict.fromkeys(("gpl", "cc-by-sa", "gfdl", "eupl", "odbl", "osl", "cecill"), 3),
    **dict.fromkeys(("agpl", "cc-by-nc", "cc-by-nd", "sspl", "busl"), 4),
}
KINDS = ("public", "permissive", "weak-copyleft", "copyleft", "restricted")
UNKNOWN = 4

_TOKEN = re.compile(rb"[()]|[A-Za-z0-9][A-Za-z0-9.+:_-]*")
_LINE_END = re.compile(rb"[\r\n]")
_RANK = {"or": 1, "and": 2, "with": 3}


class ExpressionError(ValueError):
    pass


def to_postfix(text: str | bytes, start: int = 0, end: int | None = None) -> list[str]:
    """Shunting-yard: identifiers and operators in evaluation order; ``with`` binds tightest, then ``and``.

    Reads no further than the expression goes. Behind an operator a name that is no licence known here is an operand
    too, unless it is outside of parentheses and more words of a sentence follow or it is in small letters alone, as
    licences have no such names ("MIT and Others may", "MIT and others").
    """
    raw = text.encode() if isinstance(text, str) else text
    tokens = (m.group().decode() for m in _TOKEN.finditer(raw, start, len(raw) if end is None else end))
    out: list[str] = []
    waiting: list[str] = []
    operand, opened = True, 0
    token = next(tokens, None)
    while token is not None:
        name, following = token.lower(), None
        if name in _RANK:
            if operand:
                raise ExpressionError(f"operand missing before {token}")
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[name]:
                out.append(waiting.pop())
            waiting.append(name)
            operand = True
        elif token == "(":
            if not operand:
                raise ExpressionError("operator missing before (")
            waiting.append(token)
            opened += 1
        elif token == ")":
            if operand:
                raise ExpressionError("operand missing before )")
            if not opened:
                raise ExpressionError("( missing")
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
            opened -= 1
        elif not operand:
            break              # words behind a complete expression are not part of it
        else:
            following = next(tokens, "")
            goes_on = following and following.lower() not in _RANK and following not in "()"
            if waiting and not opened and not _is_identifier(token) and (goes_on or token.isalpha() and token.islower()):
                waiting.pop()  # the sentence goes on, the expression does not
                operand = False
                break
            out.append(token)
            operand = False
        token = next(tokens, None) if following is None else following or None
    if operand or opened:
        raise ExpressionError("expression not complete")
    return out + waiting[::-1]


def family(identifier: str) -> str:
    """``GPL-2.0-or-later`` to ``gpl``: the longest known name that the identifier begins with."""
    name = identifier.lower()
    known = [k for k in STRENGTH if name == k or name.startswith((k + "-", k + "+"))]
    return max(known, key=len, default=name)


def _is_identifier(token: str) -> bool:
    return family(token) in STRENGTH or "-" in token


def evaluate(postfix: list[str]) -> tuple[int, set[str]]:
    """Strength of the whole expression and the licence families in it.

    ``or`` leaves the choice, so the lesser strength counts; ``and`` binds to both; an exception behind
    ``with`` takes one degree off a copyleft licence.
    """
    stack: list[tuple[int, set[str]]] = []
    for token in postfix:
        if token not in _RANK:
            stack.append((STRENGTH.get(family(token), UNKNOWN), {family(token)}))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            stack.append((left[0] - (left[0] in (2, 3)), left[1]))
        else:
            stack.append(((min if token == "or" else max)(left[0], right[0]), left[1] | right[1]))
    return stack[-1]


def evaluate_text(text: str | bytes, start: int = 0, end: int | None = None) -> tuple[int, set[str]] | None:
    """Strength and families of an expression, None where it is not one."""
    try:
        return evaluate(to_postfix(text, start, end))
    except ExpressionError:
        return None


_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class Scanner:
    """The automaton; built once for each Python worker."""

    def __init__(self, phrases: dict[str, str] | None = None):
        import ahocorasick
        self.base = BASE if phrases is None else phrases
        self.automaton = ahocorasick.Automaton()
        for phrase in {*self.base, *NOTICES, *TAGS}:
            self.automaton.add_word(f" {phrase} ", (phrase, phrase.count(" ") + 1))
        self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score, kind of the expressions."""
        raw = (text or "").encode()
        words = _WORD.findall(raw.lower())
        line = (b" " + b" ".join(words) + b" ").decode("latin-1")
        places, base, labels, score, kinds = [], set(), set(), 0.0, set()
        behind: dict[int, None] = {}       # numbers of words that end a tag, in order, each once
        at = seen = 0
        for end, (phrase, length) in self.automaton.iter(line):
            seen, at = seen + line.count(" ", at, end + 1), end + 1
            start = seen - 1 - length          # words that end before the phrase begins
            if phrase in self.base:
                places.append(start)
                base.add(self.base[phrase])
                score = max(score, BASE_SCORE)
            if phrase in NOTICES:
                labels.add(NOTICES[phrase][0])
                score = max(score, NOTICES[phrase][1])
            if phrase in TAGS:
                behind[start + length] = None
        for found in self._expressions(raw, list(behind)):
            kinds.add(KINDS[found[0]])
            labels |= found[1]
            score = TAG_SCORE
        first, last = (min(places), max(places)) if places else (None, None)
        return (len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(base | labels)), score,
                ",".join(sorted(kinds)))

    @staticmethod
    def _expressions(raw: bytes, counts: list[int]):
        """What the expressions say that stand behind so many words, each up to the end of its line."""
        if not counts:
            return
        ends = [m.end() for m in _WORD.finditer(raw.lower())]
        stop = -1
        for count in counts:
            place = ends[count - 1]
            if place > stop:
                found = _LINE_END.search(raw, place)
                stop = found.start() if found else len(raw)
            result = evaluate_text(raw, place, stop)
            if result:
                yield result


SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, expression_kinds string")


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
         phrases: dict[str, str] | None = None) -> DataFrame:
    """``doc_id`` and the columns of ``SCHEMA`` for every row.

    ``n_base`` counts all places of base phrases, ``first_word`` and ``last_word`` are their smallest and
    largest start (null without one), ``labels`` has the base labels and those of notices and expressions,
    ``score`` is 0 without any find. A null or empty text has no words, empty labels and score 0. Repeated
    rows are scanned each, an empty table gives an empty one, other columns are not read. One narrow stage.
    """
    shared.bytes_per_batch(docs.sparkSession)

    def run(batches):
        scanner = Scanner(phrases)
        fields = [f.split() for f in SCHEMA.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
        for batch in batches:
            columns = zip(*(scanner.scan(t.as_py()) for t in batch.column(1)), strict=True) if batch.num_rows \
                else [[]] * len(fields)
            yield pa.record_batch([batch.column(0), *(pa.array(list(c), kinds[k]) for c, (_, k) in
                                                      zip(columns, fields, strict=True))],
                                  ["doc_id", *(n for n, _ in fields)])

    selected = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = selected.schema["doc_id"].dataType.simpleString()
    return selected.mapInArrow(run, f"doc_id {kind}, {SCHEMA}")
