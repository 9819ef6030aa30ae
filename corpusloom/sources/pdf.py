"""PDF files through an optional backend; without one every file becomes a row with an error."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import schemas as S
from corpusloom.operators.fulltext import _map_rows
from corpusloom.operators.sections import title_of_blocks


def _plumber(content: bytes) -> dict:
    import pdfplumber

    with pdfplumber.open(io.BytesIO(content)) as pdf:
        pages = [
            {"page_num": i, "text": p.extract_text() or "", "blocks": [], "tables": p.extract_tables() or [], "images": []} for i, p in enumerate(pdf.pages, 1)
        ]
        return {"pages": pages, "metadata": {str(k): str(v) for k, v in (pdf.metadata or {}).items()}}


def _mupdf(content: bytes) -> dict:
    import fitz

    with fitz.open(stream=content, filetype="pdf") as pdf:
        pages = []
        for i, page in enumerate(pdf, 1):
            blocks = []
            for b in page.get_text("dict")["blocks"]:
                if b["type"] == 0:
                    text = "\n".join(" ".join(s["text"] for s in line["spans"]) for line in b["lines"])
                    blocks.append({"type": "text", "bbox": list(b["bbox"]), "text": text, "size": None})
                else:
                    blocks.append({"type": "image", "bbox": list(b["bbox"]), "text": None, "size": b.get("size")})
            pages.append({"page_num": i, "text": page.get_text(), "blocks": blocks, "tables": [], "images": []})
        return {"pages": pages, "metadata": {k: str(v) for k, v in (pdf.metadata or {}).items() if v}}


ENGINES: dict[str, tuple[Callable[[bytes], dict], ...]] = {"pymupdf": (_mupdf,), "pdfplumber": (_plumber,), "hybrid": (_mupdf, _plumber)}


def parse_pdfs(files: DataFrame, engine: str = "hybrid") -> DataFrame:
    """``path, content`` to parsed documents; ``hybrid`` falls back to the second engine."""

    def one(row: dict) -> Iterator[dict]:
        errors = []
        for parse in ENGINES[engine]:
            try:
                found = parse(bytes(row["content"] or b""))
                if not found["pages"]:
                    raise ValueError("PDF has no pages")
                text = "\n\n".join(p["text"] for p in found["pages"])
                yield {"file_path": row["path"], "full_text": text, "pages": found["pages"], "metadata": list(found["metadata"].items()), "sections": [], "parse_errors": []}
                return
            except Exception as e:  # noqa: BLE001  backends raise their own types
                errors.append(f"{parse.__name__}: {e}")
        yield {"file_path": row["path"], "full_text": None, "pages": [], "metadata": [], "sections": [], "parse_errors": errors}

    parsed = _map_rows(files.select("path", "content"), S.PARSED, one)
    first = F.get("pages", F.lit(0))
    return parsed.withColumn("title", F.coalesce(F.try_element_at("metadata", F.lit("title")), title_of_blocks(first["blocks"], first["text"])))
