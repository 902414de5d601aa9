"""Texts of bodies: HTML by a parser, Word by the standard library, PDF where pypdf is."""

from __future__ import annotations

import html
import io
import re
import zipfile
from collections.abc import Callable
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: elements whose text is dropped, and elements that end a line
_HIDDEN = ("style", "script", "head")
_BLOCKS = {"p", "div", "br", "tr", "li", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "section", "article"}
# signs that no text has stand for tags: of a line's beginning, of its end, of neither
_BEGIN, _END, _INLINE = "\ufdd0", "\ufdd1", "\ufdd2"
_UNSEEN = re.compile(rf"(?is)<!--.*?(?:-->|\Z)|<({'|'.join(_HIDDEN)})\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>|[{_BEGIN}{_END}{_INLINE}]")
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)[^>]*?(/?)>")
_NO_BREAK = re.compile(rf"(?:\A|(?<=[{_BEGIN}{_END}])){_BEGIN}+")
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
#: First bytes of the older Word format, of which the standard library reads nothing.
_OLD_WORD = bytes.fromhex("d0cf11e0")


def _sign(tag: re.Match) -> str:
    closing, name, alone = tag.groups()
    if name.lower() not in _BLOCKS:
        return _INLINE
    return _END if closing else _BEGIN + _END if alone else _BEGIN


def html_text(body: str | None) -> str:
    """Plain text of an HTML body, '' for nothing.

    Tags become signs, the text between two signs has its white space as single spaces, and
    only then signs become line breaks: one for every end of a block, one for a beginning
    that does not follow a break. Lines apart by blank ones are one blank line apart.
    """
    if not body:
        return ""
    signed = html.unescape(_TAG.sub(_sign, _UNSEEN.sub("", body)))
    signed = re.sub(r"\s+", " ", signed).replace(_INLINE, "")
    lines = re.sub(f"[{_BEGIN}{_END}]", "\n", _NO_BREAK.sub("", signed))
    return re.sub(r"\n[ \t]*\n\s*", "\n\n", html.unescape(lines)).strip()


def word_text(content: bytes) -> str:
    """Paragraphs of a .docx file."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        tree = ElementTree.fromstring(z.read("word/document.xml"))
    return "\n".join("".join(t.text or "" for t in p.iter(f"{_W}t")) for p in tree.iter(f"{_W}p")).strip()


def pdf_text(content: bytes) -> str:
    from pypdf import PdfReader  # not everywhere

    pages = (p.extract_text() or "" for p in PdfReader(io.BytesIO(content)).pages)
    return "\n\n".join(p.strip() for p in pages if p.strip())


def extract(content: bytes | None, ocr: Callable[[bytes], str] | None = None) -> tuple[str | None, str]:
    """(text, status) of a file by its first bytes.

    status is text, empty, error (also of the older Word format), pypdf-error, pypdf-empty,
    or ocr-failed. ocr, if given, reads the pages of a PDF that holds no text.
    """
    if not content:
        return None, "empty"
    if content[:4] == _OLD_WORD:
        return None, "error"
    try:
        if content[:2] == b"PK":
            text = word_text(content)
        elif content[:5] == b"%PDF-":
            text = pdf_text(content)
        else:
            text = html_text(content.decode("utf-8", "replace"))
    except ImportError:
        return None, "pypdf-error"
    except Exception:
        return None, "pypdf-error" if content[:5] == b"%PDF-" else "error"
    if text or content[:5] != b"%PDF-":
        return (text, "text") if text else (None, "empty")
    if ocr is None:
        return None, "pypdf-empty"
    try:
        text = ocr(content).strip()
    except Exception:
        text = ""
    return (text, "text") if text else (None, "ocr-failed")


def parsed_html(body: Column) -> Column:
    """Text of an HTML body by the parser, in Arrow batches; null stays null."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda b: None if b is None else html_text(b))

    return run(body)


def extracted(content: Column, ocr: Callable[[bytes], str] | None = None) -> Column:
    """struct<text, status> of binary files, in Arrow batches."""

    @F.pandas_udf("text string, status string")
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([extract(c, ocr) for c in s], columns=["text", "status"])

    return run(content)
