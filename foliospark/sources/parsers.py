"""Readers for whole files that no expression can parse: e-mail, XML, XLSX.

The per-file helpers are nested in the table functions, so that they travel to
the workers by value. Every file gives a row, also a broken one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from foliospark.operators.metadata import guard_doctype

EMAIL = "subject string, `from` string, `to` string, date string, body string, status string, error string"
LONG = "pos int, key string, value string, status string, error string"


def _key_type(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()


def parse_eml(docs: DataFrame, column: str = "content", deep: bool = False) -> DataFrame:
    """RFC 822 messages to subject, from, to, date, body; none of them is ever null.

    Body: content of a single text part; of a multipart the first text/plain
    part, else the last text/html part, else empty. Only top-level parts count
    unless ``deep``. Dates are given in UTC.
    """
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import email
        from email import policy
        from email.header import decode_header, make_header
        from email.utils import formataddr, getaddresses, parsedate_to_datetime
        from datetime import timezone

        def text_of(part) -> str:
            payload = part.get_payload(decode=True) or b""
            try:
                return payload.decode(part.get_content_charset() or "ascii", "replace")
            except LookupError:
                return payload.decode("utf-8", "replace")

        def header(message, name: str) -> str:
            value = message.get(name)
            return "" if value is None else str(value).replace("\r", "").replace("\n", "")

        def addresses(message, name: str) -> str:
            found = getaddresses([str(v) for v in message.get_all(name, [])])
            return ", ".join(formataddr(pair) for pair in found if pair[1] or pair[0])

        def date(message) -> str:
            try:
                moment = parsedate_to_datetime(message["Date"])
            except (TypeError, ValueError):
                return ""
            if moment.tzinfo is not None:
                moment = moment.astimezone(timezone.utc)
            return moment.strftime("%a %b %d %H:%M:%S UTC %Y")

        def body(message) -> str:
            if not message.is_multipart():
                return text_of(message) if message.get_content_maintype() == "text" else ""
            parts = message.walk() if deep else message.get_payload()
            html = None
            for part in parts:
                kind = part.get_content_type()
                if kind.startswith("text/plain"):
                    return text_of(part)
                if kind.startswith("text/html"):
                    html = text_of(part)
            return html or ""

        def row(content) -> tuple:
            try:
                raw = content.encode("utf-8") if isinstance(content, str) else bytes(content)
                message = email.message_from_bytes(raw, policy=policy.compat32)
                try:
                    subject = str(make_header(decode_header(header(message, "Subject"))))
                except (LookupError, ValueError):
                    subject = header(message, "Subject")
                return (subject, addresses(message, "From"), addresses(message, "To"), date(message),
                        body(message), "ok", None)
            except Exception as problem:
                return "", "", "", "", "", "error", f"{type(problem).__name__}: {problem}"

        for batch in batches:
            out = pd.DataFrame([row(c) for c in batch["content"]],
                               columns=["subject", "from", "to", "date", "body", "status", "error"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    slim = docs.select("doc_id", F.col(column).alias("content"))
    return slim.mapInPandas(parse, f"doc_id {_key_type(docs)}, {EMAIL}")


def parse_xml(docs: DataFrame, column: str = "xml") -> DataFrame:
    """Children of the root element as long rows: local name and all text below, untrimmed.

    Binary files are read in the encoding they declare. A text with a DOCTYPE is refused before it is parsed; refused and broken
    texts keep one row with status error.
    """
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xml.etree.ElementTree as tree

        class Guarded(tree.TreeBuilder):
            def doctype(self, *_):
                raise ValueError("DOCTYPE is not allowed")

        def rows(doc_id, text, status, error):
            if status != "ok":
                return [(doc_id, None, None, None, status, error)]
            try:
                root = tree.fromstring(text, tree.XMLParser(target=Guarded()))
                found = [(doc_id, i, child.tag.rpartition("}")[2], "".join(child.itertext()), "ok", None)
                         for i, child in enumerate(c for c in root if isinstance(c.tag, str))]
                return found or [(doc_id, None, None, None, "ok", None)]
            except (tree.ParseError, ValueError, TypeError) as problem:
                return [(doc_id, None, None, None, "error", str(problem))]

        for batch in batches:
            found = [r for args in zip(batch["doc_id"], batch["xml"], batch["status"], batch["error"])
                     for r in rows(*args)]
            out = pd.DataFrame(found, columns=["doc_id", "pos", "key", "value", "status", "error"])
            out["pos"] = out["pos"].astype("Int32")
            yield out

    slim = docs.select("doc_id", F.col(column).alias("xml"))
    if slim.schema["xml"].dataType.simpleString() == "binary":
        guarded = slim.withColumns({"status": F.lit("ok"), "error": F.lit(None).cast("string")})
    else:
        guarded = guard_doctype(slim)
    checked = guarded.withColumn("xml", F.when(F.col("status") == "ok", F.col("xml")))
    return checked.mapInPandas(parse, f"doc_id {_key_type(docs)}, {LONG}")


def read_xlsx_properties(docs: DataFrame, min_inflate_ratio: float = 0.001) -> DataFrame:
    """Core properties of XLSX and XLSM files as long rows.

    Files that are no such workbook, and parts that would inflate beyond the
    ratio, give status error.
    """
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import xml.etree.ElementTree as tree
        import zipfile

        # Element names in the core properties part and their keys.
        keys = {
            "title": "excel.title", "creator": "excel.author", "subject": "excel.subject",
            "description": "excel.description", "keywords": "excel.keywords",
            "lastModifiedBy": "excel.lastModifiedByUser", "revision": "excel.revision",
        }

        class Guarded(tree.TreeBuilder):
            def doctype(self, *_):
                raise ValueError("DOCTYPE is not allowed")

        def part(archive, name):
            info = archive.getinfo(name)
            if info.file_size and info.compress_size / info.file_size < min_inflate_ratio:
                raise ValueError("compression ratio beyond the limit")
            return tree.fromstring(archive.read(info), tree.XMLParser(target=Guarded()))

        def core_part(archive, names):
            """The package relationship says which part holds the core properties."""
            if "_rels/.rels" in names:
                for link in part(archive, "_rels/.rels"):
                    if link.get("Type", "").endswith("/metadata/core-properties"):
                        return link.get("Target", "").lstrip("/")
            return "docProps/core.xml"

        def properties(content):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                names = set(archive.namelist())
                if "xl/workbook.xml" not in names:
                    raise ValueError("not an XLSX or XLSM workbook")
                core = core_part(archive, names)
                if core not in names:
                    return []
                root = part(archive, core)
            return [(keys[name], "".join(child.itertext())) for child in root
                    if (name := child.tag.rpartition("}")[2]) in keys]

        def rows(doc_id, content):
            try:
                found = [(doc_id, i, k, v, "ok", None) for i, (k, v) in enumerate(properties(bytes(content)))]
                return found or [(doc_id, None, None, None, "ok", None)]
            except Exception as problem:
                return [(doc_id, None, None, None, "error", f"{type(problem).__name__}: {problem}")]

        for batch in batches:
            found = [r for args in zip(batch["doc_id"], batch["content"]) for r in rows(*args)]
            out = pd.DataFrame(found, columns=["doc_id", "pos", "key", "value", "status", "error"])
            out["pos"] = out["pos"].astype("Int32")
            yield out

    return docs.select("doc_id", "content").mapInPandas(parse, f"doc_id {_key_type(docs)}, {LONG}")
