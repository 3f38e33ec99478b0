"""Markdown lines, HTML and tables of contents as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from foliospark.functions.arrays import fold_text, let, max_before, sums_before
from foliospark.functions.text import replace_each

FENCE, INFO, ENTITY, ID = "\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3"

_FENCED = (r"(?sm)^ {0,3}(`{3,}|~{3,})([^\n]*)(?:\n|\z)(.*?)"
           r"(?:^ {0,3}\1[`~]*[ \t]*(?:\n|\z)|\z)")
HEADING = r"^ {0,3}(#{1,6})(?:[ \t]+|\z)"
LIST_ITEM = r"^[ \t]*(?:[-*+]|[0-9]{1,9}[.)])[ \t]+"
RULE_LINE = r"^ {0,3}(?:-{3,}|\*{3,}|_{3,})[ \t]*\z"
# A line of text and its underline; the line is no item, heading, quotation or rule.
_UNDERLINED = (r"(?m)^(?! {{0,3}}#{{1,6}}(?:[ \t]|$))(?![ \t]*(?:[-*+]|[0-9]{{1,9}}[.)])[ \t])(?! {{0,3}}(?:-{{3,}}|\*{{3,}}|_{{3,}})[ \t]*$)"
               r" {{0,3}}([^\s>][^\n]*)\n {{0,3}}{}+[ \t]*$")
DEFINITION = r"""(?m)^ {0,3}\[([^\]\n]+)\]:[ \t]*<?([^\s<>]+)>?(?:[ \t]+["'(][^\n]*["')])?[ \t]*$\n?"""
DELIMITER = r"^ {0,3}(?=[^|\n]*\|)\|?[ \t]*:?-+:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)*+\|?[ \t]*\z"


def unify_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def fence_parts(markdown: Column) -> Column:
    """Pieces of the text; odd positions are the insides of code fences (info, mark, code)."""
    marked = F.regexp_replace(F.regexp_replace(unify_newlines(markdown), "[\ufdd0-\ufdef]", ""),
                              _FENCED, f"{FENCE}$2{INFO}$3{FENCE}")
    return F.split(marked, FENCE)


def underlined(part: Column) -> Column:
    """Headings that are a line with a line of ``=`` or ``-`` below it, written with ``#`` signs.

    Only the line right above the underline is the heading; lines before it are a paragraph.
    """
    first = F.regexp_replace(part, _UNDERLINED.format("="), "# $1")
    return F.regexp_replace(first, _UNDERLINED.format("-"), "## $1")


def definitions(parts: Column) -> Column:
    """Link definitions outside of fences as a map from label to address; of equal labels the first counts."""
    texts = F.array_join(F.transform(parts, lambda s, i: F.when(i % 2 == 0, s).otherwise("")), "\n")
    found = let(texts, lambda t: F.transform(
        F.arrays_zip(F.regexp_extract_all(t, F.lit(DEFINITION), F.lit(1)).alias("label"), F.regexp_extract_all(t, F.lit(DEFINITION), F.lit(2)).alias("url")),
        lambda d, i: F.struct(label_of(d["label"]).alias("label"), i.alias("i"), d["url"].alias("url"))))
    first = let(F.array_sort(found), lambda ds: F.filter(
        ds, lambda d, i: (i == 0) | (F.get(ds, i - 1)["label"] != d["label"])))
    return F.map_from_entries(F.transform(first, lambda d: F.struct(d["label"], d["url"])))


def label_of(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def line_kind(line: Column) -> Column:
    return (F.when(F.regexp_like(line, F.lit(HEADING)), "heading")
             .when(F.regexp_like(line, F.lit(RULE_LINE)), "rule")
             .when(F.regexp_like(line, F.lit(LIST_ITEM)), "item")
             .when(F.regexp_like(line, F.lit(r"^\s*\z")), "blank")
             .otherwise("text"))


def heading_level(line: Column) -> Column:
    return F.length(F.regexp_extract(line, HEADING, 1))


def heading_text(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(line, HEADING, ""), r"(?:^|[ \t]+)#*[ \t]*\z", ""))


def slug(text: Column) -> Column:
    """Anchor for a heading: lower case, letters, digits, ``_ - .`` kept, spaces to hyphens."""
    bare = F.regexp_replace(text, r"<[^>]*>|&[a-z]+;|[*`]", "")
    kept = F.regexp_replace(F.lower(bare), r"[^\p{L}\p{N}_\-. ]+", "")
    return F.regexp_replace(F.regexp_replace(kept, r"[ ]+", "-"), r"^[^\p{L}]+", "")


def lines(markdown: Column) -> Column:
    """All lines as ``array<struct<pos, kind, level, text>>``; fence lines themselves are left out.

    Fences are found before lines are cut, so no running state over lines is
    needed and the text never leaves its row.
    """
    empty = F.struct(F.lit("").alias("kind"), F.lit(0).alias("level"), F.lit("").alias("text"))

    def part_lines(part: Column, i: Column) -> Column:
        code = F.transform(
            F.split(F.regexp_replace(F.substring_index(part, INFO, -1), r"\n\z", ""), "\n"),
            lambda x: F.struct(F.lit("code").alias("kind"), F.lit(0).alias("level"), x.alias("text")))
        plain = F.transform(
            F.split(F.regexp_replace(underlined(part), r"\n\z", ""), "\n"),
            lambda x: F.struct(
                line_kind(x).alias("kind"),
                F.when(F.regexp_like(x, F.lit(HEADING)), heading_level(x)).otherwise(0).alias("level"),
                F.when(F.regexp_like(x, F.lit(HEADING)), heading_text(x))
                 .when(F.regexp_like(x, F.lit(RULE_LINE)), F.lit(""))
                 .otherwise(F.regexp_replace(x, LIST_ITEM, "")).alias("text")))
        nothing = (part == "") | ((i % 2 == 1) & F.endswith(part, F.lit(INFO)))
        return F.when(nothing, F.slice(F.array(empty), 1, 0)).when(i % 2 == 1, code).otherwise(plain)

    flat = F.flatten(F.transform(fence_parts(markdown), part_lines))
    return F.transform(flat, lambda x, i: F.struct(
        i.cast("int").alias("pos"), x["kind"].alias("kind"), x["level"].alias("level"), x["text"].alias("text")))


def _escape(text: Column) -> Column:
    """``&`` and ``<`` as references unless they start a reference or a tag."""
    kept = F.regexp_replace(text, r"&([a-zA-Z][a-zA-Z0-9]*|#[0-9]+|#[xX][0-9a-fA-F]+);", f"{ENTITY}$1;")
    no_amp = F.replace(F.replace(kept, F.lit("&"), F.lit("&amp;")), F.lit(ENTITY), F.lit("&"))
    return F.regexp_replace(no_amp, r"<([^a-zA-Z/!]|\z)", "&lt;$1")


def _code_text(text: Column) -> Column:
    for char, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(reference))
    return text


def _inline(text: Column) -> Column:
    for pattern, replacement in (
        (r"!\[([^\]\n]*)\]\(([^)\s]+)\)", '<img src="$2" alt="$1" />'),
        (r"\[([^\]\n]*)\]\(([^)\s]+)\)", '<a href="$2">$1</a>'),
        (r"\*\*([^*\s]|[^*\s][^*\n]*[^*\s])\*\*", "<strong>$1</strong>"),
        (r"\*([^*\s]|[^*\s][^*\n]*[^*\s])\*", "<em>$1</em>"),
        (r"\b__([^_\n]+)__\b", "<strong>$1</strong>"),
        (r"\b_([^_\n]+)_\b", "<em>$1</em>"),
        (r"(?m) {2,}$", "<br />"),
    ):
        text = F.regexp_replace(text, pattern, replacement)
    return text


def _with(function, value):
    """``function`` of one column; a second parameter would be taken for a place in the array."""
    return lambda x: function(x, value)


def _referred(text: Column, known: Column) -> Column:
    """``![a][label]``, ``[text][label]``, ``[label][]`` and ``[label]`` whose label is defined; others stay as written."""
    def link(inner: Column, image: bool) -> Column:
        name = F.substring_index(inner, "][", 1)
        label = F.when(F.contains(inner, F.lit("][")), F.substring_index(inner, "][", -1)).otherwise("")
        url = known[label_of(F.when(label == "", name).otherwise(label))]
        made = (F.concat(F.lit('<img src="'), url, F.lit('" alt="'), name, F.lit('" />')) if image
                else F.concat(F.lit('<a href="'), url, F.lit('">'), name, F.lit("</a>")))
        return F.coalesce(made, F.concat(F.lit("![" if image else "["), inner, F.lit("]")))

    for pattern, image in ((r"!\[([^\[\]\n]*\]\[[^\[\]\n]*)\]", True), (r"(?<!!)\[([^\[\]\n]*\]\[[^\[\]\n]*)\]", False),
                           (r"(?<![!\]])\[([^\[\]\n]+)\](?![\[(:])", False)):
        text = replace_each(text, pattern, _with(link, image))
    return text


def spans(text: Column, known: Column) -> Column:
    """Inline mark-up outside code spans, code spans untouched."""
    def plain(s: Column) -> Column:
        return let(_inline(_escape(s)), lambda t: F.when((F.size(known) > 0) & F.contains(t, F.lit("[")), _referred(t, known)).otherwise(t))

    marked = F.split(F.regexp_replace(text, r"`([^`\n]+)`", f"{FENCE}$1{FENCE}"), FENCE)
    return F.array_join(F.transform(marked, lambda s, i: F.when(
        i % 2 == 1, F.concat(F.lit("<code>"), _code_text(s), F.lit("</code>"))
    ).otherwise(plain(s))), "")


def _wrap(before: str, body: Column, after: str) -> Column:
    return F.concat(F.lit(before), body, F.lit(after))


def _block(line: Column) -> Column:
    """One line as a block of its own; neighbours are merged afterwards."""
    item = F.regexp_replace(line, LIST_ITEM, "")
    level = heading_level(line).cast("string")
    title = heading_text(line)
    heading = F.concat(F.lit("<h"), level, F.lit(f' id="{ID}'), slug(title), F.lit(f'{ID}">'), title, F.lit("</h"),
                       level, F.lit(">"))
    return (F.when(F.regexp_like(line, F.lit(HEADING)), heading)
             .when(F.regexp_like(line, F.lit(RULE_LINE)), F.lit("<hr />"))
             .when(F.regexp_like(line, F.lit(r"^[ \t]*[-*+][ \t]+")), _wrap("<ul>\n<li>", item, "</li>\n</ul>"))
             .when(F.regexp_like(line, F.lit(LIST_ITEM)), _wrap("<ol>\n<li>", item, "</li>\n</ol>"))
             .when(F.regexp_like(line, F.lit(r"^ {0,3}>")),
                   _wrap("<blockquote>\n<p>", F.regexp_replace(line, r"^ {0,3}> ?", ""), "</p>\n</blockquote>"))
             .when(F.regexp_like(line, F.lit(r"^\s*\z")), F.lit(""))
             .otherwise(_wrap("<p>", F.regexp_replace(line, r"^ +", ""), "</p>")))


def _cells(line: Column) -> Column:
    inner = F.regexp_replace(F.regexp_replace(F.trim(line), r"^\|", ""), r"(?<!\\)\|\z", "")
    return F.transform(F.split(inner, r"(?<!\\)\|"), lambda c: F.replace(F.trim(c), F.lit("\\|"), F.lit("|")))


def _row(tag: str, line: Column, delimiter: Column) -> Column:
    """Cells as many as the delimiter has, with its alignments."""
    def cell(mark: Column, text: Column) -> Column:
        left, right = F.startswith(mark, F.lit(":")), F.endswith(mark, F.lit(":"))
        align = (F.when(left & right, ' align="center"').when(left, ' align="left"').when(right, ' align="right"').otherwise(""))
        return F.concat(F.lit(f"<{tag}"), align, F.lit(">"), F.coalesce(text, F.lit("")), F.lit(f"</{tag}>"))

    cells = let(_cells(delimiter), lambda marks: F.zip_with(marks, F.slice(_cells(line), F.lit(1), F.size(marks)), cell))
    return F.concat(F.lit("<tr>\n"), F.array_join(cells, "\n"), F.lit("\n</tr>"))


def _with_tables(rows: Column) -> Column:
    """``struct<line, block>`` rows whose tables are tables. A table needs a header, a delimiter with as many cells right
    below it, and a ``|`` in each of its rows; its delimiter has no block."""
    def tables(rs: Column) -> Column:
        starts = F.transform(rs, lambda r, i: F.when(
            F.regexp_like(r["line"], F.lit(DELIMITER)) & (i > 0) & F.contains(F.get(rs, i - 1)["line"], F.lit("|"))
            & (F.size(_cells(F.get(rs, i - 1)["line"])) == F.size(_cells(r["line"]))), i.cast("int")).otherwise(F.lit(-1)))
        breaks = F.transform(rs, lambda r, i: F.when(F.contains(r["line"], F.lit("|")), F.lit(-1)).otherwise(i.cast("int")))
        return let(F.arrays_zip(rs.alias("r"), starts.alias("start"), max_before(starts).alias("begun"), max_before(breaks).alias("broken")),
                   lambda all_rows: F.filter(F.transform(all_rows, lambda r, i: _table_line(r, F.get(all_rows, i + 1)["start"], rs)),
                                             lambda r: r["block"].isNotNull()))

    return tables(rows)


def _table_line(r: Column, next_start: Column, rs: Column) -> Column:
    line, heads = r["r"]["line"], next_start >= 0
    within = F.contains(line, F.lit("|")) & (r["begun"] >= 0) & (r["begun"] > r["broken"])
    marks = F.get(rs, F.when(heads & ~within, next_start).otherwise(r["begun"]))["line"]
    block = (F.when(heads & ~within, _wrap("<table>\n<thead>\n", _row("th", line, marks), "\n</thead>\n</table>"))
             .when((r["start"] >= 0) & ~within, F.lit(None))
             .when(within, _wrap("<table>\n<tbody>\n", _row("td", line, marks), "\n</tbody>\n</table>"))
             .otherwise(r["r"]["block"]))
    return F.struct(F.when(heads | within, F.lit("|")).otherwise(line).alias("line"), block.alias("block"))


# --- nested lists ----------------------------------------------------------------

_LEVEL = "struct<content:int,tag:string>"


def _list_line(r: Column) -> Column:
    line, block = r["line"], r["block"]
    marker = F.regexp_extract(line, LIST_ITEM, 0)
    indent = F.length(F.replace(F.regexp_extract(line, r"^[ \t]*", 0), F.lit("\t"), F.lit("    ")))
    item = F.regexp_like(line, F.lit(LIST_ITEM)) & ~F.regexp_like(line, F.lit(RULE_LINE))
    return F.struct(
        item.alias("item"), indent.alias("indent"), (indent + F.length(F.trim(marker)) + 1).alias("content"),
        F.when(F.regexp_like(line, F.lit(r"^[ \t]*[0-9]")), "ol").otherwise("ul").alias("tag"),
        F.regexp_like(line, F.lit(r"^\s*\z")).alias("blank"),
        F.when(item, F.regexp_replace(line, LIST_ITEM, "")).when(indent >= 2, F.trim(line)).otherwise(block).alias("text"), block.alias("block"))


def _closing(levels: Column) -> Column:
    """Ends of open lists, the innermost first."""
    return F.array_join(F.transform(F.reverse(levels), lambda x: _wrap("</li>\n</", x["tag"], ">\n")), "")


def _list_step(state: Column, x: Column) -> Column:
    """``open``: the lists a line may continue; ``blanks``: blank lines since; ``out``: what has been written."""
    levels = state["open"]

    def item(outer: Column) -> Column:                   # lists whose items' text begins at or before this marker
        depth = F.size(outer)
        sibling = F.get(levels, depth)
        same = sibling["tag"] == x["tag"]
        opened = _wrap("<", x["tag"], ">\n<li>")
        before = F.slice(levels, depth + 2, F.size(levels))
        text = (F.when(sibling.isNull(), F.concat(F.when(depth > 0, "\n").otherwise(""), opened))
                 .when(same, F.concat(_inner(before), F.lit("</li>\n<li>")))
                 .otherwise(F.concat(_inner(before), _wrap("</li>\n</", sibling["tag"], ">\n"), opened)))
        level = F.struct(x["content"].alias("content"), x["tag"].alias("tag")).cast(_LEVEL)
        return _list_state(F.concat(outer, F.array(level)), F.lit(0), F.concat(state["out"], text, x["text"]))

    ended = F.concat(state["out"], _closing(levels))
    nothing = F.array().cast(f"array<{_LEVEL}>")
    outer = F.when(state["blanks"] > 1, nothing).otherwise(F.filter(levels, lambda y: y["content"] <= x["indent"]))
    continues = (F.size(levels) > 0) & (x["indent"] >= 2) & (state["blanks"] == 0)
    return (F.when(x["item"] & (state["blanks"] > 1), let(_list_state(nothing, F.lit(0), F.concat(ended, _wrap("<", x["tag"], ">\n<li>"), x["text"])),
                                                         lambda st: st.withField("open", F.array(F.struct(x["content"].alias("content"), x["tag"].alias("tag")).cast(_LEVEL)))))
             .when(x["item"], let(outer, item))
             .when(x["blank"], _list_state(levels, state["blanks"] + 1, F.when(F.size(levels) > 0, state["out"]).otherwise(F.concat(state["out"], F.lit("\n")))))
             .when(continues, _list_state(levels, F.lit(0), F.concat(state["out"], F.lit("\n"), x["text"])))
             .otherwise(_list_state(nothing, F.lit(0), F.concat(
                 ended, F.when((F.size(levels) > 0) & (state["blanks"] > 0), "\n").otherwise(""), x["block"], F.lit("\n")))))


def _inner(levels: Column) -> Column:
    """Ends of lists inside an item that is still open."""
    return F.when(F.size(levels) > 0, F.concat(F.lit(""), _closing(levels))).otherwise("")


def _list_state(levels: Column, blanks: Column, out: Column) -> Column:
    return F.struct(levels.cast(f"array<{_LEVEL}>").alias("open"), blanks.cast("int").alias("blanks"), out.cast("string").alias("out"))


def _nested(rows: Column) -> Column:
    """Lists inside lists: a stack of open lists carried over the lines."""
    return fold_text(rows, _list_state(F.array(), F.lit(0), F.lit("")), _list_step, lambda state: _closing(state["open"]))


NESTED = r"(?m)^(?:\t| {2,})[ \t]*(?:[-*+]|[0-9]{1,9}[.)])[ \t]"


def _flow(part: Column, known: Column) -> Column:
    def joined(text: Column) -> Column:
        table = F.regexp_like(text, F.lit("(?m)" + DELIMITER.replace(r"\z", "$")))

        def with_rows(rows: Column) -> Column:
            rows = F.when(table, _with_tables(rows)).otherwise(rows)         # used in one of two branches
            return F.when(F.regexp_like(text, F.lit(NESTED)), _nested(F.transform(rows, _list_line))).otherwise(
                F.array_join(F.transform(rows, lambda r: r["block"]), "\n"))

        return let(F.transform(F.split(text, "\n"), lambda x: F.struct(x.alias("line"), _block(x).alias("block"))), with_rows)

    without = F.when(F.size(known) > 0, F.regexp_replace(part, DEFINITION, "")).otherwise(part)
    html = let(spans(underlined(without), known), joined)
    for old, new in (
        ("</blockquote>\n<blockquote>\n", ""), ("</p>\n<p>", "\n"),
        ("</ul>\n<ul>\n", ""), ("</ul>\n\n<ul>\n", ""), ("</ol>\n<ol>\n", ""), ("</ol>\n\n<ol>\n", ""),
        ("</thead>\n</table>\n<table>\n<tbody>", "</thead>\n<tbody>"), ("\n</tbody>\n</table>\n<table>\n<tbody>", ""),
    ):
        html = F.replace(html, F.lit(old), F.lit(new))
    return F.regexp_replace(F.regexp_replace(html, r"\n{2,}", "\n"), r"^\n+|\n+\z", "")


def _code_block(part: Column) -> Column:
    info = F.regexp_extract(F.substring_index(part, INFO, 1), r"^\s*([\w+#.-]*)", 1)
    start = F.when(info == "", F.lit("<pre><code>")).otherwise(
        F.concat(F.lit('<pre class="'), info, F.lit('"><code>')))
    body = F.regexp_replace(F.substring_index(part, INFO, -1), r"\n\z", "")
    return F.concat(start, _code_text(body), F.lit("</code></pre>"))


# The analyzer takes some passes for each lambda inside another one; its usual limit is 100.
_PASSES = "spark.sql.analyzer.maxIterations"


def allow_nesting(spark: SparkSession | None) -> None:
    """Room for ``to_html`` in a session; a streaming batch has one of its own."""
    if spark is not None and int(spark.conf.get(_PASSES)) < 300:
        spark.conf.set(_PASSES, "300")


def to_html(markdown: Column) -> Column:
    """Markdown to an HTML5 fragment: headings, paragraphs, quotations, lists in lists, tables, fenced code, rules, links and
    references, emphasis. Ids of headings are unique."""
    allow_nesting(SparkSession.getActiveSession())
    def whole(parts: Column, known: Column) -> Column:
        done = F.transform(parts, lambda s, i: F.when(i % 2 == 1, _code_block(s)).otherwise(_flow(s, known)))
        return F.array_join(F.filter(done, lambda s: s != ""), "\n")

    return let(fence_parts(markdown), lambda parts: let(definitions(parts), lambda known: _with_ids(whole(parts, known))))


def seen_before(names: Column) -> Column:
    """For each element of an array, how many equal ones are before it; by sorting."""
    def numbered(rows: Column) -> Column:
        starts = F.transform(rows, lambda x, k: F.when((k == 0) | (F.get(rows, k - 1)["name"] != x["name"]), k.cast("int")).otherwise(F.lit(-1)))
        return F.transform(F.array_sort(let(F.zip_with(starts, max_before(starts), lambda own, before: F.greatest(own, before)), lambda first: F.transform(
            rows, lambda x, k: F.struct(x["i"].alias("i"), (k - F.get(first, k)).cast("int").alias("n"))))), lambda x: x["n"])

    return let(F.array_sort(F.transform(names, lambda x, i: F.struct(x.alias("name"), i.alias("i")))), numbered)


def unique(name: Column, before: Column) -> Column:
    """An anchor that comes again gets a number."""
    return F.when(before == 0, name).otherwise(F.concat_ws("-", name, before.cast("string")))


def _with_ids(html: Column) -> Column:
    """Anchors between ``ID`` marks made unique."""
    def woven(pieces: Column) -> Column:
        names = F.filter(pieces, lambda _, i: i % 2 == 1)
        return let(seen_before(names), lambda n: F.array_join(F.transform(
            pieces, lambda s, i: F.when(i % 2 == 1, unique(s, F.get(n, ((i - 1) / 2).cast("int")))).otherwise(s)), ""))

    return let(html, lambda h: F.when(F.contains(h, F.lit(ID)), let(F.split(h, ID), woven)).otherwise(h))


def since_above(heads: Column, level: int) -> Column:
    """For each heading, how many of a level there are up to it and behind the last one above that level."""
    own = F.transform(heads, lambda x: (x["level"] == level).cast("int"))
    above = F.transform(heads, lambda x, i: F.when(x["level"] < level, i.cast("int")).otherwise(F.lit(-1)))

    def from_last(sums: Column) -> Column:
        upto = F.zip_with(sums, own, lambda a, b: a + b)
        return F.zip_with(max_before(above), upto, lambda at, n: n - F.when(at >= 0, F.get(sums, at)).otherwise(0))

    return let(sums_before(own), from_last)


def standalone(fragment: Column, title: Column) -> Column:
    return F.concat(
        F.lit('<!DOCTYPE html>\n<html>\n<head>\n<meta charset="utf-8" />\n<title>'),
        _code_text(title), F.lit("</title>\n</head>\n<body>\n"), fragment, F.lit("\n</body>\n</html>\n"))
