"""Names, lists, formats and limits that results depend on.

Everything in this module is data that has to have exactly these values; the
logic that uses it lives in ``functions`` and ``operators``.
"""

from __future__ import annotations

# --- media types -----------------------------------------------------------

PDF = "application/pdf"
DOCX = "application/vnd.openxmlformats-officedocument.wordprocessingml.document"
XLS = "application/vnd.ms-excel"
XLSX = "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"
XLSM = "application/vnd.ms-excel.sheet.macroenabled.12"
XLSB = "application/vnd.ms-excel.sheet.binary.macroenabled.12"
MARKDOWN = "text/markdown"
X_MARKDOWN = "text/x-markdown"
HTML = "text/html"
XHTML = "application/xhtml+xml"
TEXT = "text/plain"
EML = "message/rfc822"
MSG = "application/vnd.ms-outlook"

# A result that is a metadata map instead of a file. Registries written for
# another platform may use a prefixed spelling; anything that ends in this
# suffix is treated as the metadata target.
METADATA = "metadata-extract"

MIB = 1024 * 1024
LIMIT_TEXT = 10 * MIB
LIMIT_FILE = 50 * MIB
LIMIT_VIDEO = 500 * MIB

# --- registry: (transformer, engine, options, [(sources, targets, max bytes)]) ---

TRANSFORMERS = [
    ("convert2md", "convert2md", ["language", "image"], [([PDF], [MARKDOWN], LIMIT_FILE)]),
    ("md2doc", "md2doc", ["tocEnabled", "tocDepth"], [([MARKDOWN, X_MARKDOWN], [DOCX, PDF], None)]),
    ("markdown", "markdown", [], [([MARKDOWN, X_MARKDOWN], [PDF], None)]),
    ("html2md", "html2md", [], [([HTML, XHTML], [MARKDOWN], None)]),
    ("md2html", "md2html", [], [([MARKDOWN, X_MARKDOWN], [HTML], None)]),
    ("msg", "msg", [], [([EML, MSG], [PDF], LIMIT_FILE)]),
    ("ocr", "ocr", ["language"], [([PDF], [PDF], LIMIT_FILE)]),
    ("pdf-pii-redaction", "pii", ["entities", "scoreThreshold", "label"], [([PDF], [PDF], LIMIT_FILE)]),
    ("pdf-pii-metadata", "pii", ["entities", "scoreThreshold", "label"], [([PDF], [METADATA], LIMIT_FILE)]),
    ("pdf2docx", "pdf2docx", [], [([PDF], [DOCX], LIMIT_FILE)]),
    ("whisper", "whisper", ["model"], [
        (["audio/mpeg", "audio/wav", "audio/ogg", "audio/flac"], [TEXT], None),
        (["video/mp4", "video/quicktime", "video/x-msvideo", "video/x-matroska"], [TEXT], LIMIT_VIDEO),
    ]),
    ("videothumb", "videothumb", ["timeOffset"], [
        (["video/mp4", "video/quicktime", "video/x-msvideo", "video/x-matroska", "video/webm"],
         ["image/jpeg"], LIMIT_VIDEO),
    ]),
    ("heic", "heic", [], [(["image/heic", "image/heif"], ["image/jpeg", "image/png"], None)]),
    ("excelextract", "excel", [], [([XLS, XLSX, XLSM, XLSB], [METADATA], None)]),
    ("xmlextract", "xml", [], [(["application/xml", "text/xml"], [METADATA], None)]),
    ("ai-metadata", "ai", ["aiFields"], [([TEXT], [METADATA], LIMIT_TEXT), ([PDF], [METADATA], LIMIT_FILE)]),
]

QUEUE_SUFFIX = "-engine-queue"

# --- option defaults: option -> (type, default) ------------------------------

OPTION_DEFAULTS = {
    "language": ("string", "eng"),
    "entities": ("string", "PERSON,PHONE_NUMBER,EMAIL_ADDRESS"),
    "scoreThreshold": ("double", 0.5),
    "label": ("string", "[REDACTED]"),
    "tocEnabled": ("boolean", False),
    "tocDepth": ("int", 3),
    "model": ("string", "base"),
    "timeOffset": ("int", 1),
    "aiFields": ("string", "title,description,tags,language"),
}

# --- file extensions by media type, per family: (table, default) -------------

EXTENSIONS = {
    "whisper": ({
        "audio/mpeg": ".mp3", "audio/wav": ".wav", "audio/ogg": ".ogg", "audio/flac": ".flac",
        "video/mp4": ".mp4", "video/quicktime": ".mov", "video/x-msvideo": ".avi",
        "video/x-matroska": ".mkv",
    }, ".audio"),
    "video": ({
        "video/mp4": ".mp4", "video/quicktime": ".mov", "video/x-msvideo": ".avi",
        "video/x-matroska": ".mkv", "video/webm": ".webm",
    }, ".mp4"),
    "image": ({"image/jpeg": ".jpg", "image/png": ".png"}, ".jpg"),
    "mail": ({MSG: ".msg"}, ".eml"),
    "result": ({
        PDF: "pdf", TEXT: "txt", HTML: "html", MARKDOWN: "md", "image/jpeg": "jpg",
        "image/png": "png", DOCX: "docx", XLS: "xls", XLSM: "xls", XLSB: "xls", METADATA: "json",
    }, "bin"),
}

# Media type by file extension, for files that arrive without a type.
SOURCE_TYPES = {
    "pdf": PDF, "md": MARKDOWN, "markdown": X_MARKDOWN, "html": HTML, "htm": HTML,
    "xhtml": XHTML, "txt": TEXT, "eml": EML, "msg": MSG, "xml": "application/xml",
    "xls": XLS, "xlsx": XLSX, "xlsm": XLSM, "xlsb": XLSB, "docx": DOCX,
    "mp3": "audio/mpeg", "wav": "audio/wav", "ogg": "audio/ogg", "flac": "audio/flac",
    "mp4": "video/mp4", "mov": "video/quicktime", "avi": "video/x-msvideo",
    "mkv": "video/x-matroska", "webm": "video/webm", "heic": "image/heic", "heif": "image/heif",
    "jpg": "image/jpeg", "png": "image/png", "json": METADATA,
}

# --- OCR language codes -------------------------------------------------------

OCR_LANGUAGES = {
    "en": "eng", "de": "deu", "fr": "fra", "es": "spa", "it": "ita", "pt": "por", "nl": "nld",
    "pl": "pol", "ru": "rus", "zh": "chi", "ja": "jpn", "ko": "kor", "ar": "ara", "hi": "hin",
    "tr": "tur",
}

# --- metadata mappings: extractor -> property lines (raw=prefix:name) ---------

NAMESPACES = {"cm": "urn:model:content:1.0", "pii": "urn:model:pii:1.0"}

MAPPINGS = {
    "ai": """\
ai.title=cm:title
ai.description=cm:description
ai.taggable=cm:taggable
ai.locale=cm:locale
""",
    "excel": """\
excel.title=cm:title
excel.author=cm:author
excel.subject=cm:description
excel.description=cm:description
excel.keywords=cm:description
""",
    "pii": """\
pii.hasPII=pii:hasPII
pii.entities=pii:entities
""",
    "xml": """\
title=cm:title
author=cm:author
description=cm:description
subject=cm:description
keywords=cm:description
""",
}

# --- personal data ------------------------------------------------------------

# (entity, pattern, run, needle, score, validator)
# run: characters a match may not start in the middle of. It keeps long unbroken
# runs linear: a match that could start inside one could start at its first character.
# needle: a string every match contains, for a cheap first look.
RECOGNIZERS = [
    ("EMAIL_ADDRESS", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "A-Za-z0-9._%+-", "@", 1.0, None),
    ("PHONE_NUMBER", r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}", None, "(", 0.7, None),
    ("IP_ADDRESS", r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b", None, ".", 0.6, None),
    ("CREDIT_CARD", r"\b[0-9]{16}\b", None, None, 1.0, "luhn"),
]
PERSON_SCORE = 0.85
DEFAULT_ENTITIES = "PERSON,PHONE_NUMBER,EMAIL_ADDRESS"
DEFAULT_THRESHOLD = 0.5
DEFAULT_LABEL = "[REDACTED]"

# --- descriptive metadata -----------------------------------------------------

AI_FIELDS = ["title", "description", "tags", "language"]
AI_KEYS = {
    "title": "ai.title", "description": "ai.description", "tags": "ai.taggable", "language": "ai.locale",
}
AI_MODEL = "ai/bartowski/Llama-3.2-3B-Instruct-GGUF"
AI_TEMPERATURE = 0.3
AI_MAX_TOKENS = 500
AI_MAX_CHARS = 4000
AI_PROMPTS = {
    "title": "Write a title for the document, five to ten words long. Answer with the title alone.",
    "description": "Sum up the document in one paragraph of plain prose. Answer with the paragraph alone.",
    "tags": "List five to ten keywords for the document, separated by commas. Answer with the list alone.",
    "language": "Name the language of the document as a two-letter ISO 639-1 code. Answer with the code alone.",
}

STOPWORDS = {
    "de": ["der", "die", "und", "das", "ist", "nicht", "ein", "eine", "mit", "für", "auf", "den"],
    "en": ["the", "and", "of", "to", "in", "is", "that", "with", "for", "was", "this", "are"],
    "es": ["el", "los", "las", "y", "que", "una", "por", "con", "para", "del", "como", "está"],
    "fr": ["le", "les", "des", "et", "dans", "une", "pour", "avec", "est", "sur", "pas", "qui"],
}

# --- self-test sizes per engine: (expected bytes, tolerance) -------------------

PROBES = {
    "html2md": (30, 8), "md2html": (30, 8), "xml": (30, 8), "excel": (30, 8),
    "md2doc": (60, 16), "markdown": (60, 16), "msg": (60, 8), "ocr": (120, 16),
    "pii": (120, 16), "pdf2docx": (120, 16), "convert2md": (300, 16), "whisper": (120, 8),
    "videothumb": (60, 8), "heic": (60, 8), "ai": (60, 150),
}

# --- conformance matrix: (engine, source, target, extra option) ----------------

def _matrix():
    rows = []
    for transformer, engine, _options, groups in TRANSFORMERS:
        for sources, targets, _limit in groups:
            for source in sources:
                for target in targets:
                    if (transformer, source) != ("ai-metadata", PDF):
                        rows.append((engine, source, target, None))
    rows += [("ai", TEXT, METADATA, f"aiFields={field}") for field in AI_FIELDS]
    return rows


MATRIX = _matrix()
