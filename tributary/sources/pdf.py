"""Texts of PDF files: native, as tables, by character recognition, and the chain of these.

The libraries that read PDF and images are optional and given by the caller or found when they are installed: `pages` opens a file's
bytes as pages with extract_text and extract_tables, `images` renders pages, `recognize` reads an image. `readers.texts` runs the
chain over files.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterable
from typing import Any

# Texts shorter than FEW count as none, with ENOUGH they are taken as they are, and a layout text must have MORE to be preferred; how images are read.
FEW, ENOUGH, MORE = 50, 300, 100
DPI, OCR = 300, "--psm 6"


def _pages(raw: bytes, password: str | None = None) -> Iterable[Any]:
    import pdfplumber  # optional

    return pdfplumber.open(io.BytesIO(raw), password=password or "").pages


def _first_image(raw: bytes) -> Any:
    import pypdfium2  # optional

    return pypdfium2.PdfDocument(raw)[0].render(scale=DPI / 72).to_pil()


def _recognize(image: Any) -> str:
    import pytesseract  # optional

    return pytesseract.image_to_string(image, lang="por", config=OCR)


def native(raw: bytes, passwords: Iterable[str] = (), pages: Callable[..., Iterable[Any]] = _pages) -> str:
    """The text of all pages; under ENOUGH characters the layout text instead, if it is MORE longer. Empty under FEW.

    Passwords are tried in their order, after none.
    """
    for word in (None, *passwords):
        try:
            found = list(pages(raw, word))
            simple = "\n".join(p.extract_text() or "" for p in found).strip()
        except Exception:  # noqa: BLE001 - a wrong password raises what its library likes
            continue
        if len(simple) >= ENOUGH:
            return simple
        layout = "\n".join(p.extract_text(layout=True) or "" for p in found).strip()
        best = layout if len(layout) > len(simple) + MORE else simple
        return best if len(best) >= FEW else ""
    return ""


def tables(raw: bytes, pages: Callable[..., Iterable[Any]] = _pages) -> str:
    """The text of all pages, and a line `header: value` for each cell of each table's rows."""
    out: list[str] = []
    for p in pages(raw):
        out.append(p.extract_text() or "")
        for table in p.extract_tables():
            head, *rows = [[(c or "").strip() for c in r] for r in table] or [[]]
            out += [f"{h}: {c}" for r in rows for h, c in zip(head, r, strict=False) if h and c]
    text = "\n".join(x for x in out if x).strip()
    return text if len(text) >= FEW else ""


def recognized(raw: bytes, image: Callable[[bytes], Any] = _first_image, recognize: Callable[[Any], str] = _recognize) -> str:
    """What character recognition reads on the first page."""
    return recognize(image(raw)).strip()


def chain(passwords: Iterable[str] = (), **tools: Callable) -> list[tuple[str, Callable[[bytes], str | None]]]:
    """The strategies for readers.texts, in their order. tools: pages, image, recognize."""
    page = {"pages": tools["pages"]} if "pages" in tools else {}
    seen = {k: tools[k] for k in ("image", "recognize") if k in tools}
    return [("native", lambda raw: native(raw, passwords, **page)), ("table", lambda raw: tables(raw, **page)), ("ocr", lambda raw: recognized(raw, **seen))]


def completed(text: str, raw: bytes, incomplete: Callable[[str], bool], **tools: Callable) -> str:
    """The text, with what character recognition reads after it where it looks as if something were missing."""
    if not incomplete(text):
        return text
    more = recognized(raw, **tools)
    return f"{text}\n{more}" if more else text
