"""Sinks: CSV reports, JSON lines, JSON documents and a review workbook."""

from __future__ import annotations

import zipfile
from pathlib import Path
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROL = r"[\x00-\x08\x0B-\x1F]"
NESTED = ("array", "struct", "map")


def csv_report(rows: DataFrame, path: str, single: bool = False) -> None:
    """CSV with a header; single puts a small report into one part."""
    (rows.coalesce(1) if single else rows).write.mode("overwrite").option("header", True).csv(path)


def jsonl(rows: DataFrame, path: str) -> None:
    """JSON lines with null fields written."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def json_documents(rows: DataFrame, path: str) -> None:
    """One JSON text for each row."""
    rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def review_cells(rows: DataFrame) -> DataFrame:
    """All columns as text a workbook can hold: nested values as JSON, control characters gone."""
    as_text = lambda c, t: F.to_json(c) if t.startswith(NESTED) else F.col(c).cast("string")
    return rows.select(*[F.regexp_replace(as_text(c, t), CONTROL, "").alias(c) for c, t in rows.dtypes])


def workbook(sheets: dict[str, DataFrame], path: str, most_rows: int = 100_000) -> None:
    """A review workbook with a sheet for each table, names cut to 31 characters.

    A workbook is a file on the driver for people to read; a table of more than ``most_rows`` rows raises an error.
    """
    xml = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    names = [n[:31] for n in sheets]
    cell = lambda v: "<c/>" if v is None else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'
    with zipfile.ZipFile(Path(path), "w", zipfile.ZIP_DEFLATED) as z:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(names) + 1))
        z.writestr("[Content_Types].xml", f'{xml}<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        z.writestr("_rels/.rels", f'{xml}<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{xml}<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(names, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'{xml}<Relationships xmlns="{package}/relationships">' + "".join(f'<Relationship Id="r{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1)) + "</Relationships>")
        for i, rows in enumerate(sheets.values(), 1):
            found = review_cells(rows).limit(most_rows + 1).collect()
            if len(found) > most_rows:
                raise ValueError(f"more than {most_rows} rows for a sheet")
            lines = "".join("<row>" + "".join(map(cell, r)) + "</row>" for r in [rows.columns, *found])
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'{xml}<worksheet xmlns="{main}"><sheetData>{lines}</sheetData></worksheet>')
