"""The queries of the catalog as DuckDB SQL, written relationally where Spark works inside rows."""

from __future__ import annotations

from foliospark import values
from foliospark.plans import catalog

NL, CR, TAB = "chr(10)", "chr(13)", "chr(9)"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rows(items) -> str:
    def cell(x) -> str:
        if x is None:
            return "NULL"
        if isinstance(x, bool):
            return str(x).lower()
        if isinstance(x, (int, float)):
            return str(x)
        if isinstance(x, list):
            return "[" + ", ".join(cell(y) for y in x) + "]::VARCHAR[]"
        return q(x)
    return "(VALUES " + ", ".join("(" + ", ".join(cell(x) for x in item) + ")" for item in items) + ")"


def pick(items, index) -> str:
    return f"([{', '.join(q(x) for x in items)}])[({index}) + 1]"


def sub(text: str, *pairs) -> str:
    for pattern, replacement in pairs:
        text = f"regexp_replace({text}, {q(pattern)}, {q(replacement)}, 'g')"
    return text


def swap(text: str, *pairs) -> str:
    for old, new in pairs:
        text = f"replace({text}, {q(old)}, {q(new)})"
    return text


TRIM = r"[\x00-\x20]+"


def trim(text: str) -> str:
    return sub(text, (rf"^{TRIM}", ""), (rf"{TRIM}$", ""))


def squeeze(text: str) -> str:
    return f"trim({sub(text, (r'[\s\x0b\x{a0}]+', ' '))})"


# --- shared inputs ---------------------------------------------------------------

PAGES = """pages_ AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1)::INTEGER - 1 AS page_no,
         unnest(string_split(text, chr(10))) AS text
  FROM documents)"""


def _found(entity, pattern, score, validator) -> str:
    digits = ("list_sum(list_transform(range(1, length(matched) + 1), lambda i: CASE WHEN i % 2 = 0 THEN "
              "(matched[-i]::INT * 2) % 10 + (matched[-i]::INT * 2) // 10 ELSE matched[-i]::INT END)) % 10 = 0")
    check = f"WHERE {digits}" if validator else ""
    return f"""
  SELECT doc_id, page_no, {q(entity)} AS entity_type, (till - length(matched))::INTEGER AS "start",
         till::INTEGER AS "end", matched, {score}::DOUBLE AS score
  FROM (SELECT *, sum(length(gap) + length(matched)) OVER (PARTITION BY doc_id, page_no ORDER BY i) AS till
        FROM (SELECT doc_id, page_no, generate_subscripts(ms, 1) AS i, unnest(ms) AS matched,
                     unnest(gs[1:len(ms)]) AS gap
              FROM (SELECT doc_id, page_no, regexp_extract_all(text, {q(pattern)}) AS ms,
                           regexp_split_to_array(text, {q(pattern)}) AS gs
                    FROM pages_ WHERE regexp_matches(text, {q(pattern)})))) {check}"""


SPANS = "spans AS (" + " UNION ALL ".join(_found(e, p, s, v) for e, p, _r, _n, s, v in values.RECOGNIZERS) + ")"
WITH_SPANS = f"WITH {PAGES}, {SPANS}"

REGISTRY = "registry AS (SELECT * REPLACE (max_bytes::BIGINT AS max_bytes) FROM " + rows(
    (name, s, t, limit, options) for name, _e, options, groups in values.TRANSFORMERS
    for ss, ts, limit in groups for s in ss for t in ts
) + " r(transformer, source_mime, target_mime, max_bytes, options))"
ENGINES = "engines AS (SELECT * FROM " + rows((t[0], t[1]) for t in values.TRANSFORMERS) + " e(transformer, engine))"

N = len(catalog.SOURCES)
ASKED = [sorted(o) for o in catalog.OPTION_SETS]
REQUESTS = f"""requests AS (
  SELECT doc_id AS request_id, {pick(catalog.SOURCES, f'doc_id % {N}')} AS source_mime,
         {pick(catalog.TARGETS, f'(doc_id // {N}) % {len(catalog.TARGETS)}')} AS target_mime,
         n_chars * 4000 AS size, doc_id % 7 AS option_set,
         CASE doc_id % 7 {' '.join(f"WHEN {i} THEN [{', '.join(q(x) for x in o)}]::VARCHAR[]" for i, o in enumerate(ASKED))} END AS asked
  FROM documents)"""
ROUTED = f"""{REQUESTS}, {REGISTRY},
pairs AS (SELECT DISTINCT source_mime, target_mime FROM registry),
fits AS (SELECT q.request_id, q.asked, r.transformer, r.options FROM requests q JOIN registry r USING (source_mime, target_mime)
         WHERE r.max_bytes IS NULL OR q.size <= r.max_bytes),
best AS (SELECT request_id, transformer FROM (
           SELECT request_id, transformer, row_number() OVER (
             PARTITION BY request_id ORDER BY len(options) - len(asked), transformer) AS n
           FROM fits WHERE list_has_all(options, asked)) WHERE n = 1),
routed AS (SELECT q.*, b.transformer, CASE
             WHEN (source_mime, target_mime) NOT IN (SELECT (source_mime, target_mime) FROM pairs) THEN 'unsupported'
             WHEN request_id NOT IN (SELECT request_id FROM fits) THEN 'too_large'
             WHEN b.transformer IS NULL THEN 'bad_option' ELSE 'ok' END AS status
           FROM requests q LEFT JOIN best b USING (request_id))"""


def _option(name: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {q(o[name])}" for i, o in enumerate(catalog.OPTION_SETS) if name in o)
    return f"(CASE option_set {cases} ELSE NULL END)" if cases else "NULL::VARCHAR"


_MATCHING = """[^\t-\r\x1c-\x20  -  -    　]"""
PAGE_META = f"""page_meta AS (
  SELECT page_id AS doc_id, 'xml' AS extractor, unnest(['title', 'author', 'description', 'subject', 'keywords', 'length']) AS key,
         unnest([chr(9) || regexp_extract(html, '<title>([^<]*)</title>', 1) || ' ' || chr(10),
                 regexp_extract(url, '^https?://([^/]*)', 1),
                 CASE WHEN page_id % 3 > 0 THEN regexp_extract(html, '<h1>([^<]*)</h1>', 1) END,
                 CASE WHEN page_id % 2 > 0 THEN regexp_extract(html, 'lang="([a-z]+)"', 1) ELSE ' ' || chr(9) || ' ' END,
                 regexp_extract(url, '[?](.*)$', 1), length(html)::VARCHAR]) AS value
  FROM pages),
clean AS (SELECT doc_id, extractor, key, {trim('value')} AS value FROM page_meta
          WHERE regexp_matches(value, {q(_MATCHING)}))"""
EVENT_META = """event_meta AS (
  SELECT event_id AS doc_id, 'excel' AS extractor,
         unnest(['excel.keywords', 'excel.title', 'excel.subject']) AS key,
         unnest([json_extract_string(props, '$.k'), event_type,
                 CASE WHEN event_id % 4 = 0 THEN user_id::VARCHAR END]) AS value
  FROM events)"""
MAPPING = "mapping AS (SELECT * FROM " + rows(
    (extractor, *line.split("="), i) for extractor, lines in values.MAPPINGS.items()
    for i, line in enumerate(lines.strip().split("\n"))
) + " m(extractor, key, property, priority))"
MAPPED = f"""{PAGE_META}, {MAPPING},
mapped AS (SELECT doc_id, extractor, property, value, priority::INTEGER AS priority FROM clean JOIN mapping USING (extractor, key)),
resolved AS (SELECT doc_id, property, arg_min(value, priority) AS value FROM mapped GROUP BY doc_id, property)"""

SLOTS = "slots AS (SELECT * FROM " + rows(
    (i, *row) for i, row in enumerate(catalog.registry_list())) + " s(slot, engine, transformer, source_mime, target_mime))"
RESULTS = f"""{SLOTS},
results AS (SELECT doc_id, engine, transformer, source_mime, target_mime,
  CASE WHEN doc_id % 11 = 0 THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN doc_id % 11 = 0 THEN 'exit code ' || (doc_id % 3) END AS error,
  CASE WHEN doc_id % 13 = 0 THEN 0 ELSE n_chars END AS out_len,
  CASE WHEN doc_id % 5 = 0 THEN '{{}}' WHEN doc_id % 7 = 0 THEN 'no json' ELSE '{{"cm:title":"' || lang || '"}}' END AS metadata_json,
  n_chars * 3 AS bytes_in, n_chars AS bytes_out, n_chars / 1000 AS seconds
  FROM documents JOIN slots ON slot = doc_id % {len(catalog.registry_list())}),
checked AS (SELECT *, CASE
    WHEN status <> 'ok' THEN error
    WHEN target_mime = {q(values.METADATA)} AND NOT json_valid(metadata_json) THEN 'invalid JSON response'
    WHEN target_mime = {q(values.METADATA)} AND metadata_json = '{{}}' THEN 'empty metadata: no properties extracted'
    WHEN target_mime <> {q(values.METADATA)} AND out_len = 0 THEN 'empty response body' END AS reason FROM results)"""

WORDS = """words AS (
  SELECT doc_id, word, count(*) AS tf FROM (
    SELECT doc_id, unnest(string_split_regex(lower(text), '[^\\p{L}]+')) AS word FROM documents)
  WHERE length(word) >= 4 GROUP BY doc_id, word),
freq AS (SELECT word, count(*) AS df FROM words GROUP BY word),
scored AS (SELECT doc_id, word, tf, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS score
           FROM words JOIN freq USING (word))"""

# --- HTML and Markdown ------------------------------------------------------------

_ENT = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"),
        ("&middot;", "·"), ("&amp;", "&")]
NO_CODE = sub("html", (r"(?is)<script(?:\s[^>]*)?>.*?</script\s*>", " "), (r"(?is)<style(?:\s[^>]*)?>.*?</style\s*>", " "),
              (r"(?s)<!--.*?-->", " "))
BLOCK = ("address|article|aside|body|center|dd|details|div|dl|dt|fieldset|figcaption|figure|footer|form|"
         "header|html|main|nav|ol|p|section|summary|table|tbody|tfoot|thead|ul")


def _html_markdown() -> str:
    """The pages hold headings, paragraphs, lists, links, line breaks and unclosed bold only."""
    br, li, para, head, end, lo, lm, le = "①②③④⑤⑥⑦⑧"
    text = sub(
        NO_CODE, (r"(?is)<head(?:\s[^>]*)?>.*?</head\s*>", " "), (r"(?i)<br\s*/?\s*>", br),
        (r'(?i)<a(?:\s[^>]*)?\shref\s*=\s*"([^">]*)"[^>]*>([^<]*)</a\s*>', rf"{lo}\2{lm}\1{le}"),
        (r"(?i)<h([1-6])(?:\s[^>]*)?>", rf"{para}{head}\1{end}"), (r"(?i)<li(?:\s[^>]*)?>", li),
        (rf"(?i)</h[1-6]\s*>|</?(?:{BLOCK})(?:\s[^>]*)?>", para), (r"<[a-zA-Z/!?][^<>]*>", ""), (r"\s+", " "))
    text = sub(
        swap(text, *_ENT), (r"([\\`*\[\]<])", r"\\\1"),
        (rf"(^|[{br}{li}{para}{end}] ?)([#>+-]+)( |\z)", r"\1\\\2\3"),
        (rf"(^|[{br}{li}{para}{end}] ?)([0-9]{{1,9}})([.)])( |\z)", r"\1\2\\\3\4"),
        (f" *([{br}{li}{para}]) *", r"\1"), (f"({end}) *[{br}{para}]+", r"\1"), (f"({li}) *[{br}{para}]+", r"\1"),
        (f"[{br}{para}]*{para}[{br}{para}]*", para), (f"^[{br}{para}]+|[{br}{para}]+$", ""),
        (f"^{li}", "- "), (f"({para}){li}", r"\1- "), (li, "\n- "), (para, "\n\n"), (br, "  \n"))
    return swap(text, *[(f"{head}{n}{end}", "#" * n + " ") for n in range(1, 7)], (lo, "["), (lm, "]("), (le, ")"))


BOUND = "①"
BLOCKS = f"""
  SELECT page_id, (generate_subscripts(pieces, 1) - 1)::INTEGER AS pos, unnest(pieces) AS piece
  FROM (SELECT page_id, string_split({sub(NO_CODE, (r'(?i)<(h[1-6]|p|li)(?:\s[^>]*)?>', BOUND + r'\1>'))}, {q(BOUND)})[2:] AS pieces FROM pages)"""
LINKS = f"""
  SELECT page_id, (generate_subscripts(ms, 1) - 1)::INTEGER AS pos, unnest(ms) AS link
  FROM (SELECT page_id, regexp_extract_all({NO_CODE}, '(?is)<a\\s[^>]*href="[^"]*"[^>]*>[^<]*</a>') AS ms FROM pages)"""

_K = "((i - 1 + length(line)) % 12)"
MD_LINES = f"""marked AS (
  SELECT doc_id, i, CASE {_K} WHEN 0 THEN '# ' || line WHEN 1 THEN '## ' || line WHEN 2 THEN '### ' || line || ' ##'
    WHEN 3 THEN '- ' || line WHEN 4 THEN '- ' || line WHEN 5 THEN '1. ' || line WHEN 6 THEN '```' WHEN 7 THEN '---' WHEN 8 THEN ''
    WHEN 9 THEN '**bold** ' || line || ' [link](http://x.org/a) & `c*d`' ELSE line END AS line
  FROM (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line FROM documents)),
fenced AS (SELECT *, line = '```' AS fence, sum(CASE WHEN line = '```' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS fences,
             count(*) OVER (PARTITION BY doc_id) AS n FROM marked),
kept AS (SELECT *, fences % 2 = 1 AS code FROM fenced WHERE NOT fence),
-- an empty last line is the end of the line before it, not a line
kinds AS (
  SELECT doc_id, i, n, fences, line,
    CASE WHEN code THEN 'code' WHEN regexp_matches(line, '^ {{0,3}}#{{1,6}}(?:[ \t]+|$)') THEN 'heading'
      WHEN regexp_matches(line, '^ {{0,3}}(?:-{{3,}}|\\*{{3,}}|_{{3,}})[ \t]*$') THEN 'rule'
      WHEN regexp_matches(line, '^[ \t]*(?:[-*+]|[0-9]{{1,9}}[.)])[ \t]+') THEN 'item'
      WHEN regexp_matches(line, '^\\s*$') THEN 'blank' ELSE 'text' END AS kind
  FROM kept WHERE NOT (line = '' AND i = n)),
-- a line of hyphens right below a line of text makes it a heading
under AS (SELECT *, coalesce(regexp_matches(line, '^ {{0,3}}-+[ \t]*$') AND kind <> 'code' AND lag(kind) OVER w = 'text' AND lag(fences) OVER w = fences
    AND lag(i) OVER w = i - 1 AND regexp_matches(lag(line) OVER w, '^ {{0,3}}[^ \t>]'), false) AS is_under FROM kinds WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
headed AS (SELECT *, coalesce(lead(is_under) OVER (PARTITION BY doc_id ORDER BY i), false) AS heads FROM under),
lines AS (
  SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INTEGER AS pos, i, fences,
    CASE WHEN heads THEN '## ' || line ELSE line END AS line, CASE WHEN heads THEN 'heading' ELSE kind END AS kind
  FROM headed WHERE NOT is_under)"""
_HEAD_TEXT = sub("line", (r"^ {0,3}#{1,6}(?:[ \t]+|$)", ""), (r"(?:^|[ \t]+)#*[ \t]*$", ""))
MD_BLOCKS = f"""{MD_LINES},
blocks AS (SELECT doc_id, pos, kind,
    CASE WHEN kind = 'heading' THEN length(regexp_extract(line, '^ {{0,3}}(#+)', 1)) ELSE 0 END::INTEGER AS level,
    CASE WHEN kind = 'heading' THEN trim({_HEAD_TEXT}) WHEN kind = 'rule' THEN '' WHEN kind = 'code' THEN line
      ELSE {sub('line', (r'^[ \t]*(?:[-*+]|[0-9]{1,9}[.)])[ \t]+', ''))} END AS text, i, fences FROM lines)"""
_SLUG = sub("lower(" + sub("text", (r"<[^>]*>|&[a-z]+;|[*`]", "")) + ")", (r"[^\p{L}\p{N}_\-. ]+", ""), (r"[ ]+", "-"),
            (r"^[^\p{L}]+", ""))


def _slug_of(text: str) -> str:
    return _SLUG.replace("regexp_replace(text,", f"regexp_replace({text},")


def _md_inline() -> str:
    inline = sub("text", (r"&([a-zA-Z][a-zA-Z0-9]*|#[0-9]+|#[xX][0-9a-fA-F]+);", "①\\1;"))
    inline = swap(inline, ("&", "&amp;"), ("①", "&"))
    inline = sub(inline, (r"<([^a-zA-Z/!]|\z)", r"&lt;\1"), (r"\[link\]\(([^)\s]+)\)", r'<a href="\1">link</a>'),
                 (r"\*\*bold\*\*", "<strong>bold</strong>"), (r"`c\*d`", "<code>c*d</code>"))
    return inline


def _md_html() -> str:
    """Blocks become tags line by line; neighbours of one kind are grouped by window functions."""
    inline, code = _md_inline(), swap("text", ("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"))
    return f"""WITH {MD_BLOCKS},
again AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id, slug ORDER BY pos) - 1 AS again
          FROM (SELECT doc_id, pos, {_slug_of('html')} AS slug FROM (SELECT doc_id, pos, {inline} AS html FROM blocks WHERE kind = 'heading'))),
typed AS (SELECT b.doc_id, b.pos, b.i, b.fences, b.level, b.kind, CASE WHEN b.kind = 'item' AND regexp_matches(l.line, '^[ \t]*[0-9]') THEN 'ol'
            WHEN b.kind = 'item' THEN 'ul' WHEN b.kind = 'text' THEN 'p' WHEN b.kind = 'code' THEN 'code' ELSE b.kind END AS tag,
            CASE WHEN b.kind = 'code' THEN {code} ELSE {inline} END AS html
            , CASE WHEN again > 0 THEN '-' || again ELSE '' END AS suffix
          FROM blocks b JOIN lines l USING (doc_id, pos) LEFT JOIN again USING (doc_id, pos)),
-- blank lines end a paragraph, but do not part two lists of one kind when single
seen AS (SELECT *, lag(tag) OVER w AS before1, lag(i) OVER w AS i1, lag(fences) OVER w AS fences1, lag(tag, 2) OVER w AS before2,
           lag(fences, 2) OVER w AS fences2 FROM typed WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
grouped AS (SELECT *, sum(CASE WHEN fences IS NOT DISTINCT FROM fences1 AND tag = before1 AND tag IN ('p', 'ul', 'ol', 'code') THEN 0
     WHEN fences IS NOT DISTINCT FROM fences2 AND before1 = 'blank' AND tag = before2 AND tag IN ('ul', 'ol') THEN 0 ELSE 1 END)
     OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM (SELECT * FROM (
        SELECT *, tag = 'blank' AND before1 IN ('ul', 'ol') AND lead(tag) OVER w = before1 AND lead(fences) OVER w = fences
          AND fences = fences1 AS inner_blank FROM seen WINDOW w AS (PARTITION BY doc_id ORDER BY pos)) WHERE NOT inner_blank)),
parts AS (SELECT doc_id, g, any_value(tag) AS tag, CASE any_value(tag)
     WHEN 'heading' THEN any_value('<h' || level || ' id="' || {_slug_of('html')} || suffix || '">' || html || '</h' || level || '>')
     WHEN 'rule' THEN '<hr />'
     WHEN 'p' THEN '<p>' || string_agg({sub('html', (r'^ +', ''))}, chr(10) ORDER BY pos) || '</p>'
     WHEN 'code' THEN '<pre><code>' || string_agg(html, chr(10) ORDER BY pos) || '</code></pre>'
     ELSE '<' || any_value(tag) || '>' || chr(10) || string_agg('<li>' || html || '</li>', chr(10) ORDER BY pos) || chr(10) || '</' || any_value(tag) || '>'
     END AS html FROM grouped WHERE tag <> 'blank' GROUP BY doc_id, g),
empty_code AS (SELECT doc_id, min(i) AS i FROM fenced WHERE fences % 2 = 1 GROUP BY doc_id, fences
               HAVING count(*) = 1 OR (count(*) = 2 AND max(CASE WHEN i = n THEN line END) = ''))
SELECT d.doc_id, '<!DOCTYPE html>' || chr(10) || '<html>' || chr(10) || '<head>' || chr(10) || '<meta charset="utf-8" />' || chr(10)
   || '<title>' || d.doc_id || '</title>' || chr(10) || '</head>' || chr(10) || '<body>' || chr(10) || coalesce(body, '') || chr(10)
   || '</body>' || chr(10) || '</html>' || chr(10) AS html
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(html, chr(10) ORDER BY first_line) AS body FROM (
    SELECT doc_id, min(i) AS first_line, any_value(p.html) AS html FROM parts p JOIN grouped USING (doc_id, g) GROUP BY doc_id, g
    UNION ALL SELECT doc_id, i, '<pre><code></code></pre>' FROM empty_code) GROUP BY doc_id) USING (doc_id)"""


_NAME = r"[\p{L}\x27\x{2019}-]+"
_GRAMS = f"""{PAGES},
tokens AS (SELECT doc_id, page_no, i, word, (till - length(word))::INTEGER AS "start", gap
  FROM (SELECT *, sum(length(gap) + length(word)) OVER (PARTITION BY doc_id, page_no ORDER BY i) AS till FROM (
    SELECT doc_id, page_no, generate_subscripts(ws, 1) AS i, unnest(ws) AS word, unnest(gs[1:len(ws)]) AS gap
    FROM (SELECT doc_id, page_no, regexp_extract_all(text, {q(_NAME)}) AS ws, regexp_split_to_array(text, {q(_NAME)}) AS gs
          FROM pages_ WHERE regexp_matches(text, {q(_NAME)}))))),
grams AS (
  SELECT doc_id, page_no, "start", word AS matched FROM tokens
  UNION ALL SELECT a.doc_id, a.page_no, a."start", a.word || ' ' || b.word FROM tokens a JOIN tokens b
    ON a.doc_id = b.doc_id AND a.page_no = b.page_no AND b.i = a.i + 1 AND b.gap = ' '),
names AS (SELECT DISTINCT unnest([regexp_extract(text, '^(\\p{{L}}+ \\p{{L}}+)', 1), regexp_extract(text, '^(\\p{{L}}+)', 1)]) AS name FROM conversations)"""

_TURN = "conv_id || '-' || turn"
_EML_DATE = "'Thu Jan 01 10:00:' || lpad((turn % 60)::VARCHAR, 2, '0') || ' UTC 2026'"
_MD_EMAIL = ("'# ' || {s} || chr(10) || chr(10) || '**From:** ' || {f} || chr(10) || chr(10) || '**To:** ' || {t} || chr(10) || chr(10) "
             "|| '**Date:** ' || {d} || chr(10) || chr(10) || '---' || chr(10) || chr(10) || {b} || chr(10)")

_FIELD_CASES = """
  SELECT doc_id, lang, text, string_split({squeezed}, ' ') AS w FROM documents"""
FIELDS = f"""fields AS (SELECT doc_id, array_to_string(w[1:doc_id % 12 + 1], ' ') AS title, text AS description,
    array_to_string(w[2:doc_id % 13 + 1], ' , ') AS tags,
    lower(lang) || CASE WHEN doc_id % 9 = 0 THEN 'x' ELSE '' END AS "language"
  FROM ({_FIELD_CASES.format(squeezed=squeeze('text'))}))"""

_BODY = """'{"model":"' || MODEL || '","messages":[{"role":"system","content":' || to_json(prompt) || '},{"role":"user","content":'
  || to_json(left(text, 4000)) || '}],"temperature":0.3,"max_tokens":500}'"""


def _asked() -> str:
    prompts = rows(values.AI_PROMPTS.items())
    return f"documents, {prompts} p(field, prompt)"


def _redacted(by: str) -> str:
    """Pages with the union of their spans replaced, built from pieces."""
    return f"""
open_ AS (SELECT *, CASE WHEN "start" > coalesce(max("end") OVER (PARTITION BY doc_id, page_no ORDER BY "start", "end"
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) THEN 1 ELSE 0 END AS o FROM {by}),
grp AS (SELECT *, sum(o) OVER (PARTITION BY doc_id, page_no ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS g FROM open_),
merged AS (SELECT doc_id, page_no, g, min("start") AS s, max("end") AS e FROM grp GROUP BY ALL),
pieces AS (SELECT m.*, p.text, substring(p.text, (lag(e, 1, 0) OVER w + 1)::BIGINT, (s - lag(e, 1, 0) OVER w)::BIGINT) || '[REDACTED]' AS piece
           FROM merged m JOIN pages_ p USING (doc_id, page_no) WINDOW w AS (PARTITION BY m.doc_id, m.page_no ORDER BY s)),
hidden AS (SELECT doc_id, page_no, string_agg(piece, '' ORDER BY s) || substring(any_value(text), (max(e) + 1)::BIGINT) AS text
           FROM pieces GROUP BY doc_id, page_no),
redacted AS (SELECT p.doc_id, p.page_no, coalesce(h.text, p.text) AS text FROM pages_ p LEFT JOIN hidden h USING (doc_id, page_no))"""


WHOLE_REDACTED = f"""{WITH_SPANS}, {_redacted('spans')}
SELECT doc_id, string_agg(text, chr(10) ORDER BY page_no) AS text FROM redacted GROUP BY doc_id"""


def _statements() -> dict[str, str]:
    s: dict[str, str] = {}
    s["s1_read_documents"] = ("SELECT doc_id || '.txt' AS file_name, 'text/plain' AS source_mime, "
                              "strlen(text) AS size, md5(text) AS digest FROM documents")
    s["s2_decode_text"] = f"""SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN {q(values.PDF)} ELSE 'text/plain' END AS source_mime,
      CASE WHEN doc_id % 10 > 0 THEN text || CASE WHEN doc_id % 3 = 0 THEN chr(65533) ELSE '' END END AS text,
      CASE WHEN doc_id % 10 = 0 THEN 'unsupported' ELSE 'ok' END AS status,
      CASE WHEN doc_id % 10 = 0 THEN 'text of PDF needs an external tool' END AS error FROM documents"""
    s["s3_parse_eml"] = f"""SELECT {_TURN} AS doc_id, 'Conversation ' || conv_id || ' turn ' || turn AS subject,
      role || ' <' || role || '@example.com>' AS "from", 'a@example.com, b@example.com' AS "to", {_EML_DATE} AS date,
      text AS body, 'ok' AS status, NULL::VARCHAR AS error FROM conversations"""
    s["s4_parse_xml"] = f"""SELECT doc_id, pos, key, value, 'ok' AS status FROM (
      SELECT {_TURN} AS doc_id, unnest([0, 1, 2, 3, 4, 5]) AS pos, unnest(['title', 'author', 'author', 'author', 'keywords', 'body']) AS key,
        unnest([' ' || role, 'first', role, ' ' || chr(10), '', text || 'end']) AS value FROM conversations WHERE conv_id % 10 > 0)
      UNION ALL SELECT {_TURN}, NULL, NULL, NULL, 'error' FROM conversations WHERE conv_id % 10 = 0"""
    s["s5_read_xlsx_properties"] = """SELECT doc_id,
      unnest(['excel.title', 'excel.author', 'excel.description', 'excel.keywords', 'excel.revision']) AS key,
      unnest([' ', source, text, ' ' || lang || ' ', '7']) AS value, 'ok' AS status FROM documents"""
    ext = {**values.EXTENSIONS["result"][0]}
    targets = catalog.TARGETS
    s["s6_write_results"] = f"""SELECT doc_id, target_mime, out_text, doc_id || '.' || target AS file_name, target FROM (
      SELECT doc_id, {pick(targets, f'doc_id % {len(targets)}')} AS target_mime, text AS out_text,
        {pick([ext[t] for t in targets], f'doc_id % {len(targets)}')} AS target FROM documents)"""
    s["s7_metadata_json"] = f"""WITH {MAPPED} SELECT doc_id,
      CAST(to_json(map_from_entries(list((property, value) ORDER BY property))) AS VARCHAR) AS metadata_json FROM resolved GROUP BY doc_id"""

    s["r1_registry"] = f"""WITH {REQUESTS}, {REGISTRY} SELECT transformer, r.source_mime, r.target_mime, max_bytes,
      array_to_string(list_sort(options), ',') AS options, n AS requests FROM registry r
      JOIN (SELECT source_mime, target_mime, count(*) AS n FROM requests GROUP BY ALL) USING (source_mime, target_mime)"""
    own = f"""SELECT event_type || '-' || user_id % 10 AS transformer, 'x/s' || user_id % 3 AS source_mime,
      CASE WHEN user_id % 7 = 0 THEN {q(values.METADATA)} ELSE 'y/t' || user_id % 7 END AS target_mime,
      CASE WHEN max(event_id) % 5 > 0 THEN max(event_id) END AS max_bytes,
      CASE user_id % 10 % 3 WHEN 0 THEN event_type || ',all,label' WHEN 1 THEN 'label' ELSE '' END AS options
      FROM events WHERE user_id % 2 = {{}} GROUP BY event_type, user_id % 10, user_id % 3, user_id % 7"""
    s["r1_load_registry"] = own.format(0)
    s["r2_merge_registries"] = f"""WITH {REGISTRY} SELECT source_mime, target_mime, count(DISTINCT transformer) AS n,
        string_agg(DISTINCT transformer, ',' ORDER BY transformer) AS transformers
      FROM (SELECT transformer, source_mime, target_mime FROM registry UNION ALL SELECT transformer, source_mime, target_mime FROM ({own.format(0)})
        UNION ALL SELECT transformer, source_mime, target_mime FROM ({own.format(1)})) GROUP BY ALL HAVING n > 1"""
    s["r2_ambiguous_pairs"] = f"""WITH {REQUESTS}, {REGISTRY} SELECT * FROM (
        SELECT source_mime, target_mime, count(DISTINCT transformer) AS n, string_agg(DISTINCT transformer, ',' ORDER BY transformer) AS transformers
        FROM registry GROUP BY ALL HAVING n > 1)
      JOIN (SELECT source_mime, target_mime, count(*) AS requests FROM requests GROUP BY ALL) USING (source_mime, target_mime)"""
    s["r3_route"] = f"WITH {ROUTED} SELECT request_id, source_mime, target_mime, size, transformer, status FROM routed"
    s["r4_unsupported"] = f"WITH {ROUTED} SELECT request_id, source_mime, target_mime, size FROM routed WHERE status = 'unsupported'"
    s["r5_oversized"] = f"""WITH {ROUTED} SELECT request_id, source_mime, target_mime, size, max(max_bytes) AS limit_bytes
      FROM routed JOIN registry USING (source_mime, target_mime) WHERE status = 'too_large' GROUP BY ALL"""
    d = values.OPTION_DEFAULTS

    def text_option(name: str) -> str:
        return f"coalesce({_option(name)}, {q(d[name][1])}) AS {q(name)[1:-1]}"

    s["r6_resolve_options"] = f"""WITH {REQUESTS} SELECT request_id,
      {text_option('language')}, {text_option('entities')},
      coalesce(TRY_CAST({_option('scoreThreshold')} AS DOUBLE), 0.5) AS "scoreThreshold", {text_option('label')},
      coalesce(lower(trim({_option('tocEnabled')})) = 'true', false) AS "tocEnabled",
      coalesce(TRY_CAST({_option('tocDepth')} AS INTEGER), 3) AS "tocDepth", {text_option('model')},
      coalesce(TRY_CAST({_option('timeOffset')} AS INTEGER), 1) AS "timeOffset", {text_option('aiFields')},
      CASE WHEN {_option('tocDepth')} = 'x' THEN 'tocDepth' ELSE '' END AS warnings FROM requests"""
    cases = {}
    for family, (names, default) in values.EXTENSIONS.items():
        column = "target_mime" if family == "result" else "source_mime"
        whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in names.items())
        cases[family] = f"CASE {column} {whens} ELSE {q(default)} END AS {family}"
    s["r7_mime_extension"] = f"WITH {REQUESTS} SELECT request_id, {', '.join(cases.values())} FROM requests"
    s["r8_queue_of"] = f"""WITH {ROUTED}, {ENGINES} SELECT engine || '-engine-queue' AS queue, count(*) AS requests
      FROM routed JOIN engines USING (transformer) WHERE status = 'ok' GROUP BY ALL"""

    catalogue = rows((e, p, sc, v or "") for e, p, _r, _n, sc, v in values.RECOGNIZERS)
    s["p1_recognizers"] = f"""{WITH_SPANS} SELECT entity_type, pattern, c.score::DOUBLE AS score, validator, coalesce(n, 0) AS found
      FROM {catalogue} c(entity_type, pattern, score, validator) LEFT JOIN (SELECT entity_type, count(*) AS n FROM spans GROUP BY 1) USING (entity_type)"""
    s["p2_split_pages"] = f"WITH {PAGES} SELECT * FROM pages_"
    s["p3_detect_pii"] = f"{WITH_SPANS} SELECT * FROM spans"
    s["p4_filter_entities"] = s["p3_detect_pii"] + " WHERE entity_type IN ('PERSON', 'PHONE_NUMBER', 'EMAIL_ADDRESS')"
    s["p5_filter_score"] = s["p3_detect_pii"] + " WHERE score >= 0.7"
    s["p6_pii_summary"] = f"""{WITH_SPANS} SELECT d.doc_id, n IS NOT NULL AS "hasPII", coalesce(entities, '') AS entities,
        coalesce(top, 0.0) AS "scoreMax", coalesce(mean, 0.0) AS "scoreAvg", coalesce(n, 0) AS "count"
      FROM documents d LEFT JOIN (SELECT doc_id, string_agg(DISTINCT entity_type, ',' ORDER BY entity_type) AS entities, max(score) AS top,
        round(avg(score), 6) AS mean, count(*) AS n FROM spans GROUP BY doc_id) USING (doc_id)"""
    s["p6_pii_summary_inline"] = s["p6_pii_summary"]
    s["p7_pii_metadata"] = f"""{WITH_SPANS} SELECT d.doc_id, unnest(['pii.hasPII', 'pii.entities']) AS key,
        unnest([(n IS NOT NULL)::VARCHAR, coalesce(entities, '')]) AS value
      FROM documents d LEFT JOIN (SELECT doc_id, string_agg(DISTINCT entity_type, ',' ORDER BY entity_type) AS entities, count(*) AS n
        FROM spans GROUP BY doc_id) USING (doc_id)"""
    wider = """wider AS (SELECT doc_id, page_no, "start", "end" FROM spans UNION ALL
      SELECT doc_id, page_no, greatest("start" - 3, 0), "end" FROM spans WHERE entity_type = 'IP_ADDRESS')"""
    s["p8_redact_spans"] = f"{WITH_SPANS}, {wider}, {_redacted('wider')} SELECT * FROM redacted"
    s["p8_redact_documents"] = WHOLE_REDACTED
    s["p9_redact_occurrences"] = f"""{WITH_SPANS},
      needles AS (SELECT DISTINCT doc_id, matched FROM spans),
      whole AS (SELECT doc_id, 0 AS page_no, text FROM documents),
      found AS (SELECT doc_id, 0 AS page_no, (till - length(matched))::INTEGER AS "start", till::INTEGER AS "end" FROM (
        SELECT doc_id, matched, sum(length(gap) + length(matched)) OVER (PARTITION BY doc_id, matched ORDER BY i) AS till FROM (
          SELECT doc_id, matched, generate_subscripts(gs, 1) AS i, len(gs) AS n, unnest(gs) AS gap
          FROM (SELECT doc_id, matched, string_split(text, matched) AS gs FROM needles JOIN documents USING (doc_id))) WHERE i < n)),
      {_redacted('found').replace('pages_', 'whole')} SELECT * FROM redacted"""
    s["p9_redact_documents_everywhere"] = f"""{WITH_SPANS},
      needles AS (SELECT DISTINCT doc_id, page_no, matched FROM spans),
      found AS (SELECT doc_id, page_no, (till - length(matched))::INTEGER AS "start", till::INTEGER AS "end" FROM (
        SELECT *, sum(length(gap) + length(matched)) OVER (PARTITION BY doc_id, page_no, matched ORDER BY i) AS till FROM (
          SELECT doc_id, page_no, matched, generate_subscripts(gs, 1) AS i, len(gs) AS n, unnest(gs) AS gap
          FROM (SELECT doc_id, page_no, matched, string_split(text, matched) AS gs FROM needles JOIN pages_ USING (doc_id, page_no))) WHERE i < n)),
      {_redacted('found')} SELECT doc_id, string_agg(text, chr(10) ORDER BY page_no) AS text FROM redacted GROUP BY doc_id"""
    s["p10_join_pages"] = "SELECT doc_id, text FROM documents"
    s["p11_detect_names"] = f"""WITH {_GRAMS} SELECT doc_id, page_no, 'PERSON' AS entity_type, "start",
      ("start" + length(matched))::INTEGER AS "end", matched, 0.85::DOUBLE AS score FROM grams JOIN names ON name = matched"""

    known = "[" + ", ".join(q(f) for f in values.AI_FIELDS) + "]"
    s["a1_select_fields"] = f"""SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'title,description,tags,language' ELSE array_to_string(list_filter([
        CASE WHEN doc_id % 2 = 0 THEN 'tags' END, CASE WHEN doc_id % 3 = 0 THEN 'title' END,
        CASE WHEN doc_id % 5 = 0 AND doc_id % 2 > 0 THEN 'tags' END, CASE WHEN doc_id % 4 = 0 THEN 'language' END], lambda x: x IS NOT NULL), ',') END AS fields,
      CASE WHEN doc_id % 6 = 0 OR list_contains({known}, lang) THEN '' ELSE lang END AS unknown FROM documents"""
    s["a2_truncate_text"] = "SELECT doc_id, left(text, 4000) AS text FROM documents"
    s["a3_build_requests"] = f"SELECT doc_id, field, {_BODY.replace('MODEL', q(values.AI_MODEL))} AS body FROM {_asked()}"
    length = "least(length(text), 4000)"
    s["a4_call_model"] = f"""SELECT doc_id, field, CASE WHEN {length} % 10 = 7 THEN 500 ELSE 200 END AS status_code,
      CASE WHEN {length} % 10 = 7 THEN 'HTTP 500' END AS error FROM {_asked()}"""
    s["a5_parse_responses"] = f"""SELECT doc_id, field, CASE WHEN {length} % 10 <> 7 THEN '"' || {length} || '" chars' END AS value,
      CASE WHEN {length} % 10 = 7 THEN 'error' ELSE 'ok' END AS status, CASE WHEN {length} % 10 = 7 THEN 'HTTP 500' END AS error FROM {_asked()}"""
    s["a6_pivot_fields"] = f"""WITH {FIELDS} SELECT doc_id, title AS ai_title, description AS ai_description, tags AS ai_taggable,
      "language" AS ai_locale FROM fields"""
    s["a7_explode_tags"] = f"""WITH {FIELDS} SELECT DISTINCT doc_id, tag FROM (
      SELECT doc_id, {trim("unnest(string_split(lower(tags), ','))")} AS tag FROM fields) WHERE tag <> ''"""
    s["a8_check_ai_contract"] = f"""WITH {FIELDS} SELECT doc_id,
      len(list_filter(string_split_regex(title, '\\s+'), lambda x: x <> '')) BETWEEN 5 AND 10 AS title_ok,
      len(list_filter(string_split(tags, ','), lambda x: trim(x) <> '')) BETWEEN 5 AND 10 AS tags_ok,
      regexp_full_match("language", '[a-z]{{2}}') AS language_ok,
      trim(description) <> '' AND NOT regexp_matches(description, '\\n\\s*\\n') AS description_ok FROM fields"""
    s["a9_offline_title"] = f"SELECT doc_id, array_to_string(string_split({squeeze('text')}, ' ')[1:10], ' ') AS title FROM documents"
    s["a10_offline_tags"] = f"""WITH {WORDS} SELECT * FROM (SELECT doc_id, word, tf, score,
      row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, word)::INTEGER AS rank FROM scored) WHERE rank <= 10"""
    stop = rows((lang, w) for lang, ws in values.STOPWORDS.items() for w in ws)
    s["a11_offline_language"] = f"""WITH hits AS (SELECT doc_id, lang AS code, count(*) AS n FROM (
        SELECT doc_id, unnest(string_split_regex(lower(text), '[^\\p{{L}}]+')) AS word FROM documents)
        JOIN {stop} s(lang, word) USING (word) GROUP BY ALL)
      SELECT d.doc_id, code AS "language", coalesce(n, 0)::INTEGER AS hits FROM documents d LEFT JOIN (
        SELECT doc_id, code, n, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, code) AS r FROM hits) h
      ON h.doc_id = d.doc_id AND r = 1"""
    s["a12_offline_description"] = f"""WITH {WORDS},
      sentences AS (SELECT doc_id, generate_subscripts(ss, 1) - 1 AS pos, unnest(ss) AS sentence FROM (
        SELECT doc_id, string_split_regex(text, '[.!?]\\s+') AS ss FROM documents)),
      tokens AS (SELECT doc_id, pos, unnest(string_split_regex(lower(sentence), '[^\\p{{L}}]+')) AS word FROM sentences),
      seen AS (SELECT DISTINCT doc_id, pos, word FROM tokens WHERE length(word) >= 4),
      means AS (SELECT t.doc_id, t.pos, round(avg(score), 6) AS score FROM tokens t JOIN scored USING (doc_id, word) GROUP BY ALL),
      best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS r FROM means) WHERE r <= 3)
      SELECT d.doc_id, description FROM documents d LEFT JOIN (SELECT doc_id, string_agg({squeeze('sentence')}, '. ' ORDER BY pos) AS description
        FROM best JOIN sentences USING (doc_id, pos) GROUP BY doc_id) USING (doc_id)"""

    s["m1_xml_top_level"] = f"""SELECT {_TURN} AS doc_id, unnest(['title', 'author', 'body']) AS key,
      unnest([role, role, {trim("text || 'end'")}]) AS value FROM conversations WHERE conv_id % 10 > 0"""
    s["s7_one_row_per_document"] = f"""SELECT {_TURN} AS doc_id, 'ok' AS status,
      CASE turn % 3 WHEN 0 THEN '{{"cm:title":"' || role || '"}}' ELSE '{{}}' END AS metadata_json FROM conversations"""
    s["m2_guard_doctype"] = f"""SELECT {_TURN} AS doc_id, CASE WHEN conv_id % 10 = 0 THEN 'error' ELSE 'ok' END AS status,
      CASE WHEN conv_id % 10 = 0 THEN 'DOCTYPE is not allowed' END AS error FROM conversations"""
    s["m3_xlsx_metadata"] = f"""SELECT doc_id, unnest(['excel.author', 'excel.description', 'excel.keywords', 'excel.revision']) AS key,
      unnest([source, {trim('text')}, lang, '7']) AS value FROM documents"""
    s["m4_put_if_not_blank"] = f"WITH {PAGE_META} SELECT * FROM clean"
    s["m5_map_metadata"] = f"""WITH {PAGE_META}, {EVENT_META}, {MAPPING} SELECT doc_id, extractor, property, value, priority::INTEGER AS priority
      FROM (SELECT * FROM clean UNION ALL SELECT * FROM event_meta WHERE value IS NOT NULL) JOIN mapping USING (extractor, key)"""
    s["m6_resolve_collisions"] = f"WITH {MAPPED} SELECT * FROM resolved"
    s["m6_resolve_collisions_concat"] = f"""WITH {MAPPED} SELECT doc_id, property, string_agg(value, ' | ' ORDER BY priority) AS value
      FROM mapped GROUP BY doc_id, property"""
    uri = values.NAMESPACES["cm"]
    s["m7_expand_qname"] = f"""WITH {MAPPED} SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN replace(property, 'cm:', 'zz:') ELSE property END AS property,
      CASE WHEN doc_id % 4 > 0 THEN replace(property, 'cm:', '{{{uri}}}') END AS qname, value,
      CASE WHEN doc_id % 4 = 0 THEN 'error' ELSE 'ok' END AS status, CASE WHEN doc_id % 4 = 0 THEN 'unknown prefix zz' END AS error FROM resolved"""
    s["m8_merge_metadata"] = f"""SELECT doc_id, replace(key, 'pii.', 'pii:') AS property, value FROM ({s['p7_pii_metadata']})
      UNION ALL SELECT doc_id, 'cm:title', title FROM ({s['a9_offline_title']})"""
    s["m9_load_mapping"] = """WITH t AS (SELECT event_type, user_id % 50 AS part, min(event_id) AS least FROM events GROUP BY ALL)
      SELECT 'ev' AS prefix, event_type || '-' || part AS extractor, unnest(['raw.' || least, 'last']) AS raw_key,
        unnest(['p' || least, 'last']) AS "local", unnest([3, 4]) AS priority,
        (SELECT count(DISTINCT event_type) FROM events) AS uris FROM t"""

    s["m9_mapping_files"] = """WITH t AS (SELECT event_type, user_id % 20 AS part, min(event_id) AS least FROM events GROUP BY ALL)
      SELECT 'f' || part AS prefix, event_type || '-' || part AS extractor, unnest(['raw.' || least, 'last']) AS raw_key,
        unnest(['p', 'last']) AS "local", unnest([2, 4]) AS priority,
        string_agg('http://f.org/' || event_type, ',' ORDER BY event_type) OVER (PARTITION BY part ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS uris
      FROM t"""

    plain = f"{squeeze(swap(sub(NO_CODE, (r'<[a-zA-Z/!?][^<>]*>', ' ')), *_ENT))}"
    s["c1_html_text"] = f"SELECT page_id, {plain} AS text FROM pages"
    s["c2_html_to_markdown"] = f"SELECT page_id, {_html_markdown()} AS markdown FROM pages"
    cut = (rf"(?is)</?(?:h[1-6]|li|{BLOCK})(?:\s[^>]*)?>.*\z", "")
    s["c3_html_blocks"] = f"""SELECT page_id, pos, lower(regexp_extract(piece, '^([^>]*)>', 1)) AS tag,
      {squeeze(sub(sub('piece', ('^[^>]*>', '')), cut))} AS html FROM ({BLOCKS})"""
    href = swap("regexp_extract(link, 'href=\"([^\"]*)\"', 1)", *_ENT)
    s["c4_html_links"] = f"""SELECT page_id, pos, {href} AS href,
      {squeeze(swap(sub('link', ('^<[^>]*>|</[aA]>$', '')), *_ENT))} AS text FROM ({LINKS})"""
    # what the paragraph before each page gives, and the page itself
    s["c1_quoted_brackets"] = f"SELECT page_id, rtrim('q text ' || text) AS text FROM ({s['c1_html_text']})"
    s["c2_quoted_brackets"] = f"""SELECT page_id, 'q [text](/x?n=' || page_id || ') ![<p>](i' || page_id || '.png)' ||
      CASE WHEN markdown = '' THEN '' ELSE chr(10) || chr(10) || markdown END AS markdown FROM ({s['c2_html_to_markdown']})"""
    s["c3_quoted_brackets"] = f"""SELECT page_id, 0 AS pos, 'p' AS tag, 'q <a title="a < b" href=/x?n=' || page_id || '><span>text</span></a> <img alt=''<p>'' src="i'
      || page_id || '.png">' AS html FROM pages UNION ALL SELECT page_id, pos + 1, tag, html FROM ({s['c3_html_blocks']})"""
    s["c4_quoted_brackets"] = f"""SELECT page_id, 0 AS pos, '/x?n=' || page_id AS href, 'text' AS text FROM pages
      UNION ALL SELECT page_id, pos + 1, href, text FROM ({s['c4_html_links']})"""
    v = [f"regexp_extract_all(text, '[A-Za-z]+')[{k}]" for k in range(1, 8)]
    s["c2_lists_and_links"] = f"""SELECT doc_id AS page_id, replace('## [' || {v[0]} || ' *' || {v[1]} || '*](/' || source || ')||1. ' || {v[2]} || '|   - '
      || {v[3]} || '|   - [**' || {v[4]} || '**](http://x.org/' || doc_id || ')|     1. ' || {v[5]} || '|   then|1. ![' || {v[6]} || '](a.png)||' || lang,
      '|', chr(10)) AS markdown FROM documents WHERE len(regexp_extract_all(text, '[A-Za-z]+')) > 6"""
    s["c5_markdown_to_html"] = _md_html()
    w = [f"regexp_extract_all(text, '[A-Za-z]+')[{k}]" for k in range(1, 10)]
    s["c5_markdown_structures"] = f"""SELECT doc_id, replace('<h1 id="' || lower({w[0]}) || '">' || {w[0]} || '</h1>|<table>|<thead>|<tr>|<th>' || {w[1]}
      || '</th>|<th align="right">n</th>|</tr>|</thead>|<tbody>|<tr>|<td><strong>' || {w[2]} || '</strong></td>|<td align="right">' || n_chars
      || '</td>|</tr>|<tr>|<td>' || {w[3]} || '</td>|<td align="right"></td>|</tr>|</tbody>|</table>|<ul>|<li>' || {w[4]} || '|<ol>|<li>' || {w[5]}
      || '</li>|<li>' || {w[6]} || '|<ul>|<li>' || lang || '</li>|</ul>|</li>|</ol>|</li>|<li><a href="http://x.org/' || source || '">' || {w[7]}
      || '</a></li>|</ul>|<h2 id="' || CASE WHEN lower({w[8]}) = lower({w[0]}) THEN lower({w[0]}) || '-1' ELSE lower({w[8]}) END || '">' || {w[8]}
      || '</h2>|<p>' || '<a href="http://y.org/' || doc_id || '">' || lang || '</a></p>', '|', chr(10)) AS html
      FROM documents WHERE len(regexp_extract_all(text, '[A-Za-z]+')) > 8"""
    s["c6_markdown_blocks"] = f"WITH {MD_BLOCKS} SELECT doc_id, pos, kind, level, text FROM blocks"
    s["c7_markdown_toc"] = f"""WITH {MD_BLOCKS},
      heads AS (SELECT *, {_slug_of(_md_inline())} AS slug, count(*) FILTER (WHERE level = 1) OVER (PARTITION BY doc_id ORDER BY pos) AS n1
                FROM blocks WHERE kind = 'heading' AND level <= 3),   -- deeper ones do not occur
      heads2 AS (SELECT *, count(*) FILTER (WHERE level = 2) OVER (PARTITION BY doc_id, n1 ORDER BY pos) AS n2 FROM heads),
      heads3 AS (SELECT *, count(*) FILTER (WHERE level = 3) OVER (PARTITION BY doc_id, n1, n2 ORDER BY pos) AS n3,
                   row_number() OVER (PARTITION BY doc_id, slug ORDER BY pos) - 1 AS again FROM heads2)
      SELECT doc_id, pos, level, n1 || CASE WHEN level > 1 THEN '.' || n2 ELSE '' END || CASE WHEN level > 2 THEN '.' || n3 ELSE '' END AS number,
        text, slug || CASE WHEN again > 0 THEN '-' || again ELSE '' END AS anchor FROM heads3"""
    kind = pick(["TEXT/Plain; charset=utf-8", "text/html", "image/png", "multipart/mixed"], "(conv_id * 7 + turn * 5) % 4")
    s["c8_email_body"] = f"""WITH parts AS (SELECT conv_id AS doc_id, turn, lower({kind}) AS kind, text FROM conversations)
      SELECT doc_id, coalesce(CASE WHEN count(*) = 1 THEN max(CASE WHEN kind LIKE 'text/%' THEN text END) END,
        arg_min(text, turn) FILTER (WHERE kind LIKE 'text/plain%'), arg_max(text, turn) FILTER (WHERE kind LIKE 'text/html%'), '') AS body
      FROM parts GROUP BY doc_id"""
    eml = _MD_EMAIL.format(s="'Conversation ' || conv_id || ' turn ' || turn", f="role || ' <' || role || '@example.com>'",
                           t="'a@example.com, b@example.com'", d=_EML_DATE, b="text")
    s["c9_email_to_markdown"] = f"SELECT {_TURN} AS doc_id, {eml} AS markdown FROM conversations"
    plain_eml = _MD_EMAIL.format(s="role", f="'a@example.com'", t="CASE WHEN turn > 0 THEN role ELSE '' END", d="''", b="text")
    s["c9_email_to_markdown_columns"] = f"SELECT {_TURN} AS doc_id, {plain_eml} AS markdown FROM conversations"
    s["c10_format_addresses"] = f"""SELECT {_TURN} AS doc_id, CASE turn % 3 WHEN 0 THEN '' WHEN 1 THEN role || '@example.com'
      ELSE role || '@example.com, ' || role || '@example.com' END AS addresses FROM conversations"""
    s["c11_format_date"] = """SELECT event_id, CASE WHEN event_id % 10 > 0 THEN strftime(ts, '%a %b %d %H:%M:%S UTC %Y') ELSE '' END AS date FROM events"""

    upper = "translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"
    s["x1_run_tool"] = f"""SELECT doc_id, CASE WHEN doc_id % 10 > 0 THEN {upper} END AS text,
      CASE WHEN doc_id % 10 = 0 THEN 'error' ELSE 'ok' END AS status, CASE WHEN doc_id % 10 = 0 THEN 1 ELSE 0 END AS exit_code FROM documents"""
    codes = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in values.OCR_LANGUAGES.items())
    given = pick(["", " ", "de", " FR ", "fra+eng", "Klingon", "zh"], "doc_id % 7")
    s["x2_ocr_language"] = f"""SELECT doc_id, CASE WHEN coalesce(g, '') = '' THEN 'eng' ELSE CASE lower(g) {codes} ELSE g END END AS "language"
      FROM (SELECT doc_id, trim(CASE WHEN doc_id % 4 = 0 THEN lang WHEN doc_id % 9 > 0 THEN {given} END) AS g FROM documents)"""
    s["x3_hhmmss"] = """SELECT doc_id, lpad((n // 3600)::VARCHAR, 2, '0') || ':' || lpad((n % 3600 // 60)::VARCHAR, 2, '0') || ':' || lpad((n % 60)::VARCHAR, 2, '0') AS time
      FROM (SELECT doc_id, CASE WHEN doc_id % 8 = 0 OR doc_id % 9 = 0 OR doc_id % 10 = 0 THEN 1 ELSE n_chars END AS n FROM documents)"""
    name = pick(["input.txt", "a.txt", "b.txt", "log.json"], "(conv_id * 3 + turn * 7) % 4")
    s["x4_pick_output"] = f"""WITH f AS (SELECT conv_id AS doc_id, {name} AS name FROM conversations)
      SELECT doc_id, file_name, CASE WHEN file_name IS NULL THEN 'error' ELSE 'ok' END AS status FROM (
        SELECT doc_id, coalesce(max(CASE WHEN name = 'input.txt' THEN name END), min(CASE WHEN name LIKE '%.txt' THEN name END)) AS file_name
        FROM f GROUP BY doc_id)"""
    s["x5_build_command"] = f"""WITH {REQUESTS} SELECT request_id,
      'pandoc {{input}} -o {{output}} --standalone' || CASE WHEN option_set = 2 THEN ' --toc --toc-depth=3' ELSE '' END
        || CASE WHEN request_id % 2 = 0 THEN ' --pdf-engine=xelatex -V geometry:margin=2.5cm' ELSE '' END AS md2doc,
      'pandoc {{input}} -o {{output}} --standalone --pdf-engine=xelatex -V geometry:margin=2.5cm' AS markdown,
      'ocrmypdf --skip-text -l ' || CASE WHEN option_set = 1 THEN 'deu' ELSE 'eng' END || ' {{input}} {{output}}' AS ocr,
      'ffmpeg -ss ' || CASE WHEN option_set = 4 THEN '01:02:05' ELSE '00:00:01' END || ' -i {{input}} -vframes 1 -f image2 {{output}}' AS videothumb,
      'whisper {{input}} --model base --output_format txt --output_dir {{dir}}' AS whisper FROM requests"""

    s["q1_conformance"] = f"""WITH {RESULTS} SELECT doc_id, engine, CASE WHEN reason IS NULL THEN 'PASS' ELSE 'FAIL' END AS result, reason FROM checked"""
    s["q2_conformance_summary"] = f"""WITH {RESULTS} SELECT engine, count(*) FILTER (WHERE reason IS NULL) AS passed,
      count(*) FILTER (WHERE reason IS NOT NULL) AS failed, count(*) AS total FROM checked GROUP BY ROLLUP (engine)"""
    s["q2_failures"] = f"""WITH {RESULTS} SELECT engine, '[' || engine || '] ' || source_mime || ' -> ' || target_mime || ' (' || reason || ')' AS failure,
      count(*) AS n FROM checked WHERE reason IS NOT NULL GROUP BY ALL"""
    s["q3_untested_pairs"] = f"""WITH {ROUTED}, {ENGINES} SELECT engine, source_mime, target_mime FROM registry JOIN engines USING (transformer)
      EXCEPT SELECT engine, source_mime, target_mime FROM routed JOIN engines USING (transformer) WHERE status = 'ok'"""
    probes = rows((e, *p) for e, p in values.PROBES.items())
    s["q4_probe_check"] = f"""WITH {RESULTS} SELECT doc_id, engine, out_len, expected::BIGINT AS expected, tolerance::BIGINT AS tolerance,
      abs(out_len - expected) <= tolerance AS in_range FROM results JOIN {probes} p(engine, expected, tolerance) USING (engine)"""
    s["q5_run_stats"] = f"""WITH {RESULTS} SELECT transformer, count(*) AS documents, count(*) FILTER (WHERE status <> 'ok') AS failed,
      sum(bytes_in)::BIGINT AS bytes_in, sum(bytes_out)::BIGINT AS bytes_out,
      quantile_disc(seconds, 0.5) AS p50_seconds, quantile_disc(seconds, 0.95) AS p95_seconds FROM results GROUP BY transformer"""

    s["t1_stream_transform"] = f"SELECT page_id, markdown, 'ok' AS status FROM ({s['c2_html_to_markdown']})"
    s["t2_stream_redact"] = WHOLE_REDACTED
    s["t2_stream_metadata"] = s["m5_map_metadata"]
    s["t3_dedupe_requests"] = "SELECT DISTINCT event_id // 2 AS request_id FROM events"
    allowed = "(doc_id % 7 IN (0, 1, 6))"
    s["u1_register_transformer"] = f"""SELECT doc_id, CASE WHEN n_chars * 4 <= 40000 AND {allowed} THEN lower(text) END AS text,
      CASE WHEN n_chars * 4 > 40000 THEN 'too_large' WHEN {allowed} THEN 'ok' ELSE 'bad_option' END AS status FROM documents"""
    s["u2_register_extractor"] = """SELECT doc_id, unnest(['cm:size', 'cm:source']) AS property, unnest([n_chars::VARCHAR, source]) AS value FROM documents"""
    s["u3_embed_passthrough"] = "SELECT doc_id, 'text/plain' AS source_mime, md5(text) AS digest, 'ok' AS status FROM documents"
    s["u4_pii_spans"] = s["p3_detect_pii"]
    return s


def statements() -> dict[str, str]:
    return {name: sql for name, sql in _statements().items() if name in catalog.QUERIES}
