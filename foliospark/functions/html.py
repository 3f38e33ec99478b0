"""HTML to text, blocks, links and Markdown as column expressions.

Marks are Unicode noncharacters (U+FDD0 and up), which never occur in valid
text, so that mark-up can be decided before literal text is escaped. Every
pattern runs in one pass over the text even when tags stay unclosed.
"""

from __future__ import annotations

import json
from html.entities import html5
from itertools import count

from pyspark.sql import Column, functions as F

from foliospark.functions.arrays import fold_text, let
from foliospark.functions.formats import lookup
from foliospark.functions.text import replace_each, squeeze

_codes = count(0xFDD0)
(BREAK, LINE, PARA, RULE, ITEM, NUMBER, HEAD, HEAD_END, BOLD, BOLD_END, ITALIC, ITALIC_END, CODE,
 LINK, LINK_MID, LINK_END, QUOTE, QUOTE_END, ROW, FIRST_ROW, CELL, PIPE, CUT, LESS, GREATER,
 HREF, HREF_END, ANCHOR_END, IMAGE, PAD) = (chr(next(_codes)) for _ in range(30))
MARKS = "[\ufdd0-\ufdef]"

BLOCK_TAGS = ("address|article|aside|body|center|dd|details|div|dl|dt|fieldset|figcaption|figure|footer|form|"
              "header|html|main|nav|ol|p|section|summary|table|tbody|tfoot|thead|ul")
# Up to the next tag at most: a tag that is never closed is not searched to the end of the page.
_ATTRS = r"(?:\s[^<>]*)?"

# The usual character references, tried before all others.
ENTITIES = {
    "nbsp": "\u00a0", "lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'",
    "copy": "©", "reg": "®", "trade": "™", "middot": "·", "bull": "•", "hellip": "…",
    "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”",
    "laquo": "«", "raquo": "»", "euro": "€", "deg": "°",
}


def _sub(text: Column, *pairs: tuple[str, str]) -> Column:
    for pattern, replacement in pairs:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def _swap(text: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _drop(tag: str) -> tuple[str, str]:
    return rf"(?is)<{tag}{_ATTRS}>.*?(?:</{tag}\s*>|\z)", " "


def _glyph(name: Column) -> Column:
    """The character behind a reference (name, #decimal or #xhex); unknown ones stay as written."""
    hexadecimal = F.lower(F.substring(name, 2, 1)) == "x"
    digits = F.regexp_replace(name, "^#[xX]?0*", "")
    number = F.when(F.length(digits) > 7, F.lit(None)).when(hexadecimal, F.conv(digits, 16, 10)).otherwise(
        digits).try_cast("bigint")
    valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    numeric = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
    return F.when(F.startswith(name, F.lit("#")), numeric).otherwise(
        F.coalesce(lookup(ENTITIES, name), _all_entities()[name], F.concat(F.lit("&"), name, F.lit(";"))))


def _all_entities() -> Column:
    """Every name of the HTML standard; one literal, folded to a map before the query runs."""
    names = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def decode_entities(text: Column) -> Column:
    pattern = r"&(#[xX][0-9A-Fa-f]+|#[0-9]+|[a-zA-Z][a-zA-Z0-9]{1,31});"
    return let(text, lambda t: F.when(F.contains(t, F.lit("&")), replace_each(t, pattern, _glyph)).otherwise(t))


def without_code(html: Column) -> Column:
    """Drop scripts, styles and comments with their content."""
    return _sub(html, _drop("script"), _drop("style"), (r"(?s)<!--.*?(?:-->|\z)", " "))


# A tag with its quoted values, closed or not: what is matched is never scanned again.
_QUOTING_TAG = r"""(?s)<([a-zA-Z](?:[^<>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)"""


def _mask(html: Column) -> Column:
    """Angle brackets inside quoted attribute values as marks, so that they do not end tags."""
    angled = F.regexp_like(html, F.lit(r"""(?s)=\s*+(?:"[^"<>]*+[<>]|'[^'<>]*+[<>])"""))
    return F.when(angled, replace_each(html, _QUOTING_TAG, lambda tag: F.concat(
        F.lit("<"), _swap(tag, ("<", LESS), (">", GREATER))))).otherwise(html)


def _unmask(text: Column) -> Column:
    return _swap(text, (LESS, "<"), (GREATER, ">"))


def plain_text(html: Column) -> Column:
    masked = _mask(without_code(html))
    return squeeze(decode_entities(_unmask(_sub(masked, (r"<[a-zA-Z/!?][^<>]*>", " ")))))


def title_of(html: Column) -> Column:
    raw = F.regexp_extract(html, r"(?is)<title(?:\s[^>]*)?>([^<]*)", 1)
    return squeeze(decode_entities(raw))


def block_pieces(html: Column) -> Column:
    """Headings, paragraphs and list items as ``array<struct<tag, html>>`` in text order.

    An unclosed block ends where the next block-level tag begins.
    """
    opened = F.regexp_replace(
        _mask(without_code(html)), rf"(?i)<(h[1-6]|p|li){_ATTRS}>", f"{CUT}$1{LINE}")
    end = rf"(?is)</?(?:h[1-6]|li|{BLOCK_TAGS}){_ATTRS}>.*\z"

    def block(piece: Column) -> Column:
        body = F.substring_index(piece, LINE, -1)
        return F.struct(
            F.lower(F.substring_index(piece, LINE, 1)).alias("tag"),
            squeeze(_unmask(F.regexp_replace(body, end, ""))).alias("html"),
        )

    pieces = F.split(opened, CUT)
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), block)


def _attribute(attributes: Column, name: str) -> Column:
    """The value of an attribute, quoted or bare; empty if there is none."""
    quoted = F.regexp_extract(attributes, rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'[^']*')""", 1)
    single = F.regexp_extract(attributes, rf"""(?is)\s{name}\s*=\s*'([^']*)'""", 1)
    bare = F.regexp_extract(attributes, rf"""(?is)\s{name}\s*=\s*([^\s"']\S*)""", 1)
    return F.concat(quoted, single, bare)


def link_pieces(html: Column) -> Column:
    """Links as ``array<struct<href, text>>`` in text order; anchors without href are left out."""
    opened = F.regexp_replace(_mask(without_code(html)), r"(?i)<a(\s[^<>]*)>", f"{CUT}$1{LINE}")

    def link(piece: Column) -> Column:
        attributes = F.substring_index(piece, LINE, 1)
        inner = F.regexp_replace(F.substring_index(piece, LINE, -1), r"(?is)</a\s*>.*\z", "")
        return F.struct(
            decode_entities(_unmask(_attribute(attributes, "href"))).alias("href"),
            squeeze(decode_entities(_unmask(_sub(inner, (r"<[^<>]*>", " "))))).alias("text"),
            F.regexp_like(attributes, F.lit(r"(?is)\shref\s*=\s*\S")).alias("linked"),
        )

    pieces = F.split(opened, CUT)
    links = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), link)
    return F.filter(links, lambda x: x["linked"])


# --- Markdown ------------------------------------------------------------------


def _tables(html: Column) -> Column:
    """Rows as marked lines; the first row gives the header line and its rule."""
    marked = _sub(
        html,
        (rf"(?i)<table{_ATTRS}>(?:\s*<(?:thead|tbody){_ATTRS}>)*\s*<tr{_ATTRS}>", PARA + FIRST_ROW),
        (rf"(?i)<tr{_ATTRS}>", ROW),
        (rf"(?i)</?(?:thead|tbody|tfoot){_ATTRS}>", ""),
    )

    def line(cells: Column) -> Column:
        return F.concat(F.lit(CELL + " "), F.array_join(cells, f" {CELL} "), F.lit(" " + CELL))

    def row(piece: Column) -> Column:
        first = F.startswith(piece, F.lit(FIRST_ROW))
        inner = F.regexp_replace(piece, r"(?is)</tr\s*>.*\z", "")
        rest = F.coalesce(F.get(F.split(piece, r"(?i)</tr\s*>", 2), F.lit(1)), F.lit(""))
        parts = F.split(inner, rf"(?i)<t[hd]{_ATTRS}>")
        cells = F.transform(
            F.slice(parts, F.lit(2), F.size(parts)),
            lambda c: _swap(squeeze(_sub(c, (r"(?i)</t[hd]\s*>", ""),
                                         (rf"(?i)</?(?:br|li|{BLOCK_TAGS}){_ATTRS}/?>", " "))),
                            ("|", PIPE)))

        def lay_out(c: Column) -> Column:
            rule = line(F.transform(c, lambda _: F.lit("---")))
            blank = line(F.transform(c, lambda _: F.lit("")))
            headed = F.regexp_like(inner, F.lit(r"(?i)<th[\s>]"))
            return F.concat(F.when(first & headed, F.concat_ws(LINE, line(c), rule))
                             .when(first, F.concat_ws(LINE, blank, rule, line(c)))
                             .otherwise(line(c)), rest)

        marked_row = F.startswith(piece, F.lit(FIRST_ROW)) | F.startswith(piece, F.lit(ROW))
        return F.when(marked_row, F.concat(F.lit(LINE), let(cells, lay_out))).otherwise(piece)

    return F.array_join(F.transform(F.split(marked, f"(?=[{ROW}{FIRST_ROW}])"), row), "")


def _inside(text: Column, boundary: str, body) -> Column:
    """Apply ``body`` to every second piece between boundaries (open, close, open, ...)."""
    return F.array_join(
        F.transform(F.split(text, boundary), lambda s, i: F.when(i % 2 == 1, body(s)).otherwise(s)), "")


def _quotes(markdown: Column) -> Column:
    """Prefix the lines of quoted parts with ``> ``."""
    def quoted(piece: Column, i: Column) -> Column:
        parts = F.split(piece, QUOTE_END)
        inside = F.concat(F.lit("> "), _swap(_sub(parts[0], (r"^\s+|\s+\z", "")), ("\n", "\n> ")))
        after = F.array_join(F.slice(parts, F.lit(2), F.size(parts)), "")
        return F.when(i == 0, piece).otherwise(F.concat(inside, after))

    return F.array_join(F.transform(F.split(markdown, QUOTE), quoted), "")


def _escape(text: Column) -> Column:
    """Backslash before characters that Markdown would read as mark-up."""
    blocks = f"{LINE}{PARA}{ITEM}{NUMBER}{BREAK}{HEAD_END}{QUOTE}"
    return _sub(
        text,
        (r"([\\`*\[\]<])", r"\\$1"),
        (rf"([{blocks}] ?)([#>+-]+)( |\z)", r"$1\\$2$3"),
        (rf"([{blocks}] ?)([0-9]{{1,9}})([.)])( |\z)", r"$1$2\\$3$4"),
        (f"!({LINK})", r"\\!$1"),
    )


def _inline(html: Column) -> Column:
    """Paired inline tags as marks, the innermost first; unpaired ones are left to be dropped."""
    strong = (rf"(?i)<(?:b|strong){_ATTRS}>([^<]*)</(?:b|strong)\s*>", f"{BOLD}$1{BOLD_END}")
    emphasis = (rf"(?i)<(?:i|em){_ATTRS}>([^<]*)</(?:i|em)\s*>", f"{ITALIC}$1{ITALIC_END}")
    code = (rf"(?i)<code{_ATTRS}>([^<]*)</code\s*>", f"{CODE}$1{CODE}")
    broken = F.regexp_replace(html, r"(?i)<br\s*/?\s*>", BREAK)

    def styled(h: Column) -> Column:
        return F.when(F.regexp_like(h, F.lit(r"(?i)</(?:b|strong|i|em|code)\s*>")),
                      _sub(h, code, strong, emphasis, strong, strong, emphasis)).otherwise(h)

    marked = let(broken, lambda h: F.when(F.regexp_like(h, F.lit(r"(?i)<(?:a|img)\s")), _links(h)).otherwise(h))
    return let(marked, styled)


def _links(html: Column) -> Column:
    """Links and images as marks, whatever tags a link is around; blocks at its edges are put around it."""
    def opened(attributes: Column) -> Column:
        return F.when(F.regexp_like(attributes, F.lit(r"(?i)\shref\s*=")), F.concat(F.lit(HREF), _address(attributes, "href"), F.lit(HREF_END))).otherwise("")

    def image(attributes: Column) -> Column:
        source = _address(attributes, "src")
        return F.when(source != "", F.concat(F.lit(IMAGE), squeeze(_attribute(attributes, "alt")), F.lit(LINK_MID), source, F.lit(LINK_END))).otherwise("")

    def turned(found: Column) -> Column:
        address, inner = F.substring_index(found, HREF_END, 1), F.substring_index(found, HREF_END, -1)
        edges = rf"(?is)^((?:\s*<(?:{BLOCK_TAGS}|h[1-6]){_ATTRS}>)*+\s*)(.*?)(\s*(?:</(?:{BLOCK_TAGS}|h[1-6])\s*>\s*)*)\z"
        text = F.regexp_replace(F.regexp_extract(inner, edges, 2), rf"(?i)</?(?:{BLOCK_TAGS}|h[1-6]|li){_ATTRS}/?>", " ")
        return F.concat(F.regexp_extract(inner, edges, 1), F.lit(LINK), text, F.lit(LINK_MID), address, F.lit(LINK_END), F.regexp_extract(inner, edges, 3))

    marked = replace_each(replace_each(html, r"(?i)<a(\s[^<>]*)>", opened), r"(?i)<img(\s[^<>]*)>", image)
    closed = F.regexp_replace(marked, r"(?i)</a\s*>", ANCHOR_END)
    whole = replace_each(closed, f"{HREF}([^{HREF}{HREF_END}]*{HREF_END}[^{HREF}{ANCHOR_END}]*){ANCHOR_END}", turned)
    return _sub(whole, (f"{HREF}[^{HREF_END}]*{HREF_END}|{ANCHOR_END}", ""))


def _address(attributes: Column, name: str) -> Column:
    return F.replace(F.trim(F.regexp_replace(_attribute(attributes, name), r"/?\z", "") if name == "src" else _attribute(attributes, name)), F.lit(" "), F.lit("%20"))


def _lists(html: Column) -> Column:
    """Items with their marker and indent: the lists around them are a stack carried over the list tags."""
    def piece(p: Column) -> Column:
        tag = F.lower(F.regexp_extract(p, r"^<(/?[a-zA-Z]+)", 1))
        known = tag.isin("ul", "ol", "/ul", "/ol", "li")
        return F.struct(F.when(known, tag).otherwise("").alias("tag"),
                        F.when(known, F.regexp_replace(p, r"^<[^<>]*>", "")).otherwise(p).alias("body"))

    def indent(lists: Column) -> Column:
        width = F.aggregate(lists, F.lit(0), lambda n, x: n + F.when(x == "ol", 3).otherwise(2))
        return F.repeat(F.lit(PAD), width)

    def state(lists: Column, out: Column) -> Column:
        return F.struct(lists.cast("array<string>").alias("lists"), out.cast("string").alias("out"))

    def step(st: Column, p: Column) -> Column:
        lists, inside = st["lists"], F.size(st["lists"]) > 0
        outer = F.slice(lists, F.lit(1), F.greatest(F.size(lists) - 1, F.lit(0)))
        marker = F.when(F.element_at(F.concat(F.array(F.lit("ul")), lists), -1) == "ol", NUMBER).otherwise(ITEM)
        return (F.when(p["tag"].isin("ul", "ol"), state(F.array_append(lists, p["tag"]), F.concat(
                    st["out"], F.when(inside, LINE).otherwise(PARA), p["body"])))
                 .when(p["tag"].isin("/ul", "/ol"), state(outer, F.concat(
                    st["out"], F.when(F.size(outer) > 0, F.concat(F.lit(LINE), indent(outer))).otherwise(F.lit(PARA)), p["body"])))
                 .when(p["tag"] == "li", state(lists, F.concat(st["out"], F.lit(LINE), indent(outer), marker, p["body"])))
                 .otherwise(state(lists, F.concat(st["out"], p["body"]))))

    pieces = F.transform(F.split(html, r"(?i)(?=<(?:/?[uo]l|li)[\s>/])"), piece)
    return fold_text(pieces, state(F.array(), F.lit("")), step, lambda _: F.lit(""))


# Mark for each tag that lays out text; every other tag is dropped.
_TAG_MARKS = {
    **{tag: PARA for name in BLOCK_TAGS.split("|") for tag in (name, "/" + name)},
    **{f"h{n}": f"{PARA}{HEAD}{n}{HEAD_END}" for n in range(1, 7)},
    **{f"/h{n}": PARA for n in range(1, 7)},
    "li": LINE + ITEM, "hr": PARA + RULE + PARA, "blockquote": PARA + QUOTE, "/blockquote": QUOTE_END + PARA,
}

_MARKDOWN = {
    PARA: "\n\n", LINE: "\n", BREAK: "  \n", ITEM: "- ", NUMBER: "1. ", RULE: "---",
    BOLD: "**", BOLD_END: "**", ITALIC: "*", ITALIC_END: "*", LINK: "[", LINK_MID: "](", LINK_END: ")",
    IMAGE: "![", PAD: " ", CELL: "|", PIPE: "\\|", LESS: "<", GREATER: ">", QUOTE: QUOTE, QUOTE_END: QUOTE_END,
    **{f"{HEAD}{n}{HEAD_END}": "#" * n + " " for n in range(1, 7)},
}


def _flow(html: Column) -> Column:
    """Markdown for a stretch of HTML outside ``pre``."""
    with_tables = F.when(F.regexp_like(html, F.lit(r"(?i)<tr[\s>]")), let(html, _tables)).otherwise(html)
    with_lists = let(with_tables, lambda h: F.when(F.regexp_like(h, F.lit(r"(?i)<[uo]l[\s>]")), _lists(h)).otherwise(h))
    tags = replace_each(_inline(with_lists), rf"<([!?/]?[a-zA-Z][a-zA-Z0-9]*){_ATTRS}/?>",
                        lambda name: lookup(_TAG_MARKS, F.lower(name)))
    marked = F.concat(F.lit(PARA), _sub(tags, (r"\s+", " ")))
    code_parts = F.split(decode_entities(marked), CODE)
    escaped = F.array_join(
        F.transform(code_parts, lambda s, i: F.when(i % 2 == 0, _escape(s)).otherwise(s)), "`")
    spaced = let(escaped, lambda m: F.when(
        F.contains(m, F.lit(BOLD)) | F.contains(m, F.lit(ITALIC)),
        _swap(m, (BOLD + " ", " " + BOLD), (" " + BOLD_END, BOLD_END + " "),
              (ITALIC + " ", " " + ITALIC), (" " + ITALIC_END, ITALIC_END + " "),
              (BOLD + BOLD_END, ""), (ITALIC + ITALIC_END, ""))).otherwise(m))
    merged = _sub(
        spaced,
        (f" *([{BREAK}{LINE}{PARA}{PAD}]) *", "$1"),
        (f"{PAD}+(?=[{BREAK}{LINE}{PARA}]|\\z)", ""),
        (f"([{ITEM}{NUMBER}{QUOTE}{HEAD_END}]) *[{BREAK}{LINE}{PARA}]+", "$1"),
        (f"[{BREAK}{LINE}{PARA}]*{PARA}[{BREAK}{LINE}{PARA}]*", PARA),
        (f"[{BREAK}{LINE}]*{LINE}[{BREAK}{LINE}]*", LINE),
        (f"^[ {BREAK}{LINE}{PARA}]+|[ {BREAK}{LINE}{PARA}]+\\z", ""),
    )
    final = replace_each(merged, f"({HEAD}[1-6]{HEAD_END}|{MARKS})", lambda mark: lookup(_MARKDOWN, mark))
    return let(final, lambda f: F.when(F.contains(f, F.lit(QUOTE)), _quotes(f)).otherwise(f))


def _preformatted(html: Column) -> Column:
    text = decode_entities(_unmask(_sub(html, (r"<[a-zA-Z/!?][^<>]*>", ""))))
    return F.concat(F.lit("```\n"), _sub(text, (r"^\n|\n+\z", "")), F.lit("\n```"))


def to_markdown(html: Column) -> Column:
    """HTML to GitHub-flavoured Markdown."""
    clean = _sub(_sub(html, (MARKS, "")), _drop("head"), _drop("script"), _drop("style"),
                 (r"(?s)<!--.*?(?:-->|\z)", " "))
    parts = F.transform(
        F.split(_mask(clean), rf"(?i)</?pre{_ATTRS}>"),
        lambda s, i: F.when(i % 2 == 1, _preformatted(s)).otherwise(_flow(s)))
    return F.array_join(F.filter(parts, lambda s: s != ""), "\n\n")
