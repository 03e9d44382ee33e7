"""Layout documents to elements in reading order.

A layout document is one row (doc_id, file, layout), layout being JSON with body, texts, tables, pictures and
groups whose items refer to each other by name.  A whole document is one row, so its tree is walked in the
worker that holds it, without a shuffle; what is not a walk stays in column functions.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Element types by layout label; any other label is "text".
LABEL_TYPES = {"section_header": "heading", "list_item": "list_item", "caption": "caption", "text": "paragraph"}
ELEMENT = (
    "doc_id long, file string, element_id string, source_ref string, type string, page_num int, bbox array<double>, bbox_coord_origin string, `order` int, source_parser string, source_label string, docling_level int, "
    "text string, raw_text string, marker string, enumerated boolean, caption_refs array<string>, captions array<string>, rows array<array<string>>, row_count int, col_count int"
)
_STRINGS = pa.list_(pa.string())
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("file", pa.string()), ("element_id", pa.string()), ("source_ref", pa.string()), ("type", pa.string()), ("page_num", pa.int32()), ("bbox", pa.list_(pa.float64())), ("bbox_coord_origin", pa.string()), ("order", pa.int32()), ("source_parser", pa.string()),
        ("source_label", pa.string()), ("docling_level", pa.int32()), ("text", pa.string()), ("raw_text", pa.string()), ("marker", pa.string()), ("enumerated", pa.bool_()), ("caption_refs", _STRINGS), ("captions", _STRINGS), ("rows", pa.list_(_STRINGS)), ("row_count", pa.int32()), ("col_count", pa.int32()),
    ]
)
# What only the walk and an item's own fields give; the other columns need its texts.  A batch of elements ends once their layouts hold so many characters.
_PLACED = frozenset(("doc_id", "file", "element_id", "source_ref", "page_num", "bbox", "bbox_coord_origin", "order", "source_parser", "source_label", "docling_level"))
BATCH_CHARS = 4_000_000
_NUMBER = re.compile(r"(\d+\.)\s+")


def _flat(value: str | None) -> str:
    return " ".join((value or "").split())


def _name(ref) -> str | None:
    return ref.get("$ref") if isinstance(ref, dict) else ref


class _Layout:
    """One layout document: items by name, and the elements of a walk over them."""

    def __init__(self, layout: dict):
        self.items = {item["self_ref"]: item for part in ("texts", "tables", "pictures", "groups") for item in layout.get(part) or [] if item.get("self_ref")}
        self.roots = [_name(c) for c in (layout.get("body") or {}).get("children") or []]

    def reading_order(self) -> list[str]:
        """Names of what becomes an element: the body's tree depth first, groups opened, captions before their table, each once; then texts and tables that the body does not reach, by name."""
        seen: set[str] = set()
        out: list[str] = []
        for names in (self.roots, sorted(n for n in self.items if n.startswith(("#/texts/", "#/tables/")))):
            todo = [(n, False) for n in reversed(names)]
            while todo:
                name, is_open = todo.pop()
                if is_open:
                    out.append(name)
                elif name in self.items and name not in seen:
                    seen.add(name)
                    kind, item = name.split("/")[1], self.items[name]
                    if kind != "groups":
                        todo.append((name, True))
                    inner = item.get("children" if kind == "groups" else "captions") if kind in ("groups", "tables") else None
                    todo += [(_name(c), False) for c in reversed(inner or []) if _name(c)]
        return out

    def marker(self, item: dict) -> str:
        found = _flat(item.get("marker"))
        number = _NUMBER.match(_flat(item.get("orig") or item.get("text")))
        return found or (number[1] if number else "")

    def text(self, item: dict, marker: str | None = None) -> str:
        text = _flat(item.get("text"))
        marker = self.marker(item) if marker is None else marker
        return text if text.startswith(marker) else f"{marker} {text}".strip()

    def kind(self, item: dict, marker: str) -> str:
        parent = self.items.get(_name(item.get("parent")) or "", {})
        if item.get("label") == "section_header" and marker and "list" in (parent.get("label"), parent.get("name")):
            return "list_item"
        return LABEL_TYPES.get(item.get("label"), "text")

    def element(self, name: str, order: int, texts: bool = True) -> dict:
        """The columns of an element; without `texts` only those of _PLACED."""
        item = self.items[name]
        place = (item.get("prov") or [None])[0] or {}
        box, part = place.get("bbox"), name.split("/")[1]
        row = {
            "element_id": f"p{int(place.get('page_no') or 0):04d}_e{order:05d}", "source_ref": name, "page_num": place.get("page_no"), "order": order, "source_parser": "docling", "source_label": item.get("label"), "docling_level": item.get("level"),
            "bbox": [float(box[c]) for c in "ltrb"] if box else None, "bbox_coord_origin": box.get("coord_origin") if box else None,
        }
        if not texts:
            return row
        if part == "texts":
            marker = self.marker(item)
            row |= {"type": self.kind(item, marker), "text": self.text(item, marker), "raw_text": item.get("orig") or item.get("text") or "", "marker": marker or None, "enumerated": item.get("enumerated")}
        elif part == "tables":
            refs = [n for n in map(_name, item.get("captions") or []) if n]
            captions = [self.text(self.items[n]) for n in refs if n in self.items]
            rows = [[_flat(cell.get("text")) for cell in r] for r in (item.get("data") or {}).get("grid") or []]
            row |= {"type": "table", "text": _flat(" ".join(captions)), "caption_refs": refs, "captions": captions, "rows": rows, "row_count": len(rows), "col_count": max(map(len, rows), default=0)}
        else:
            row |= {"type": "picture", "text": ""}
        return row


def flatten_layouts(layouts: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Elements of layout documents (doc_id, file, layout JSON), numbered from 1 within each file; all columns of ELEMENT, or those named.

    Unknown names are skipped; a null layout gives no element.  Every element is made whatever the columns, but what
    is not asked for leaves no worker.
    """
    wanted = [c for c in _ARROW.names if columns is None or c in columns]
    if columns is not None and set(columns) - set(wanted):
        raise ValueError(f"no such columns: {sorted(set(columns) - set(wanted))}")
    texts, kinds = not _PLACED.issuperset(wanted), {c: _ARROW.field(c).type for c in wanted}

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], kind) for c, kind in kinds.items()], names=wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for doc_id, file, text in zip(*batch.columns, strict=True):
                if (text := text.as_py()) is not None:
                    layout, own = _Layout(json.loads(text)), {"doc_id": doc_id.as_py(), "file": file.as_py()}
                    rows += [own | layout.element(name, i, texts) for i, name in enumerate(layout.reading_order(), 1)]
                    held += len(text)
                    if held >= BATCH_CHARS:
                        yield batch_of(rows)
                        rows, held = [], 0
        if rows:
            yield batch_of(rows)

    schema = ", ".join(part for part in ELEMENT.split(", ") if part.split()[0].strip("`") in kinds)
    return layouts.select("doc_id", "file", "layout").mapInArrow(run, schema)


def reading_order(elements: DataFrame, accepted: DataFrame | None = None) -> DataFrame:
    """Adds seq, the place of each element in its document: by page, missing first; then order, missing first; then file and id.

    With accepted (doc_id, page_num, source_parser) only the elements of each page's accepted parser stay.
    """
    if accepted is not None:
        elements = elements.join(accepted, ["doc_id", "page_num", "source_parser"], "left_semi")
    place = Window.partitionBy("doc_id").orderBy(F.coalesce("page_num", F.lit(0)), F.coalesce("order", F.lit(0)), F.col("file").asc_nulls_first(), "element_id")
    return elements.withColumn("seq", F.row_number().over(place))
