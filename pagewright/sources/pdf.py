"""Plug-ins for `files.read_pdfs`: what PyMuPDF and a layout parser give, where they are installed.

Each takes (path, bytes) and yields rows for one schema; ids are hashes of the path.  Nothing here runs without
the library it names, and everything downstream starts from the rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

OUTLINE = "doc_id long, ord int, outline_level int, title string, page int"
SIGNALS = "doc_id long, page_num int, char_count int, image_count int, image_coverage double, drawing_count int"
BLOCKS = "doc_id long, page_num int, idx int, bbox struct<x0:double,y0:double,x1:double,y1:double>, text string, size double"
TABLES = "doc_id long, page_num int, bbox struct<x0:double,y0:double,x1:double,y1:double>, rows array<array<string>>"
RASTERS = "doc_id long, page_num int, image binary"
LAYOUTS = "doc_id long, file string, layout string"


def doc_id(path: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(path) >> 1


def _pages(content: bytes):
    import fitz

    with fitz.open(stream=content, filetype="pdf") as pdf:
        yield from enumerate(pdf, 1)


def _box(rect) -> dict:
    return dict(zip(("x0", "y0", "x1", "y1"), map(float, rect), strict=True))


def outline(path: str, content: bytes) -> Iterator[dict]:
    """Bookmarks in order."""
    import fitz

    with fitz.open(stream=content, filetype="pdf") as pdf:
        for i, (level, title, page) in enumerate(pdf.get_toc(simple=True)):
            yield {"doc_id": doc_id(path), "ord": i, "outline_level": level, "title": title, "page": page}


def signals(path: str, content: bytes) -> Iterator[dict]:
    """What routing looks at; a page whose drawings cannot be read has none."""
    for number, page in _pages(content):
        shown = [r for r in (page.rect & i["bbox"] for i in page.get_image_info() if i.get("bbox")) if not r.is_empty]
        try:
            drawings = len(page.get_drawings())
        except Exception:  # a damaged page is still a page
            drawings = 0
        area = max(1.0, page.rect.width * page.rect.height)
        yield {"doc_id": doc_id(path), "page_num": number, "char_count": len(page.get_text().strip()), "image_count": len(page.get_images()), "image_coverage": round(min(1.0, sum(r.width * r.height for r in shown) / area), 4), "drawing_count": drawings}


def blocks(path: str, content: bytes) -> Iterator[dict]:
    """Text blocks with their largest font size, spans put together without separators; blank ones are left out."""
    for number, page in _pages(content):
        for i, block in enumerate(b for b in page.get_text("dict")["blocks"] if b["type"] == 0):
            spans = [s for line in block["lines"] for s in line["spans"]]
            text = "".join(s["text"] for s in spans)
            if text.strip():
                yield {"doc_id": doc_id(path), "page_num": number, "idx": i, "bbox": _box(block["bbox"]), "text": text, "size": round(max(s["size"] for s in spans), 1)}


def tables(path: str, content: bytes) -> Iterator[dict]:
    """Tables that the finder sees; a page it fails on has none, a table it cannot read has no rows."""
    for number, page in _pages(content):
        try:
            found = page.find_tables().tables
        except Exception:  # the finder fails on some pages
            continue
        for table in found:
            try:
                rows = table.extract()
            except Exception:  # likewise on some tables
                rows = []
            yield {"doc_id": doc_id(path), "page_num": number, "bbox": _box(table.bbox), "rows": rows}


def rasters(dpi: int = 160):
    """A plug-in that yields every page as PNG."""

    def run(path: str, content: bytes) -> Iterator[dict]:
        import fitz

        for number, page in _pages(content):
            yield {"doc_id": doc_id(path), "page_num": number, "image": page.get_pixmap(matrix=fitz.Matrix(dpi / 72, dpi / 72), alpha=False).tobytes("png")}

    return run


_CONVERTERS: dict = {}


def layouts(ocr: bool = False, table_structure: bool = True):
    """A plug-in that yields the layout document of a PDF; the converter, with its models, is made once a worker."""

    def run(path: str, content: bytes) -> Iterator[dict]:
        from io import BytesIO

        from docling.datamodel.base_models import DocumentStream, InputFormat
        from docling.datamodel.pipeline_options import PdfPipelineOptions
        from docling.document_converter import DocumentConverter, PdfFormatOption

        if (ocr, table_structure) not in _CONVERTERS:
            chosen = PdfPipelineOptions(do_ocr=ocr, do_table_structure=table_structure)
            _CONVERTERS[ocr, table_structure] = DocumentConverter(format_options={InputFormat.PDF: PdfFormatOption(pipeline_options=chosen)})
        found = _CONVERTERS[ocr, table_structure].convert(DocumentStream(name=path.rsplit("/", 1)[-1], stream=BytesIO(content)))
        yield {"doc_id": doc_id(path), "file": path.rsplit("/", 1)[-1], "layout": json.dumps(found.document.export_to_dict())}

    return run
