"""Tables, images and workbooks inside docx files, with the standard library only."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Callable, Iterator
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions.text import TABLE_MARK
from gridloom.sources.files import _emit

CHART_MARK = "תרשים"
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
BLOCKS = "path string, pos int, kind string, text string, cells array<array<string>>"


def _text(node: ET.Element) -> str:
    parts = []
    for x in node.iter():
        if x.tag == f"{W}t":
            parts.append(x.text or "")
        elif x.tag in (f"{W}tab", f"{W}br", f"{W}cr"):
            parts.append("\t" if x.tag.endswith("tab") else "\n")
    return "".join(parts)


def _cell_text(cell: ET.Element) -> str:
    return "\n".join(_text(p) for p in cell.findall(f"{W}p")).strip()


def _rows(table: ET.Element) -> list[list[str]]:
    """Cell texts; a merged cell's text stands in every place that it covers."""
    out: list[list[str]] = []
    for tr in table.findall(f"{W}tr"):
        row: list[str] = []
        for tc in tr.findall(f"{W}tc"):
            props = tc.find(f"{W}tcPr")
            span = props.find(f"{W}gridSpan") if props is not None else None
            merge = props.find(f"{W}vMerge") if props is not None else None
            width = int(span.get(f"{W}val", "1")) if span is not None else 1
            goes_on = merge is not None and merge.get(f"{W}val", "continue") == "continue"
            above = out[-1][len(row)] if goes_on and out and len(row) < len(out[-1]) else None
            row += [above if above is not None else _cell_text(tc)] * width
        out.append(row)
    return out


def _blocks(path: str, data: bytes) -> Iterator[tuple]:
    body = ET.fromstring(zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml")).find(f"{W}body")
    for pos, node in enumerate(body if body is not None else ()):
        if node.tag == f"{W}p":
            yield path, pos, "paragraph", _text(node), None
        elif node.tag == f"{W}tbl":
            yield path, pos, "table", None, _rows(node)


def _per_file(files: DataFrame, make: Callable[[str, bytes], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows of every file. A file that is no document, or a broken one, gives none; the others of the job are not lost."""

    def rows(path: str, data: bytes) -> list[tuple]:
        try:
            return list(make(path, data or b""))
        except (zipfile.BadZipFile, KeyError, IndexError, AttributeError, ValueError, EOFError, zlib.error, ET.ParseError):
            return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _emit((row for b in batches for p, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for row in rows(p, d)), schema)

    return files.select("path", "content").mapInArrow(run, schema)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.docx").load(folder).select("path", "content")


def blocks(files: DataFrame) -> DataFrame:
    """Paragraphs and tables of documents in their order."""
    return _per_file(files, _blocks, BLOCKS)


def _collapsed(cells: str):
    return F.concat_ws(" ", F.filter(cells, lambda x, i: (i == 0) | ~x.eqNullSafe(F.get(cells, i - 1))))


def marked_tables(found: DataFrame) -> DataFrame:
    """Tables of several rows with the table mark, not the chart mark, in a cell of the first row: serial, header, names, cells."""
    first = F.get("cells", F.lit(0))
    ok = (F.col("kind") == "table") & (F.size("cells") > 1) & F.exists(first, lambda c: c.contains(TABLE_MARK) & ~c.contains(CHART_MARK))
    kept = found.filter(ok).withColumn("serial", F.row_number().over(Window.partitionBy("path").orderBy("pos"))).withColumn("_first", first)
    one, two = F.get("cells", F.lit(1)), F.get("cells", F.lit(2))
    names = F.when(F.size("cells") > 2, F.transform(F.arrays_zip(one.alias("a"), two.alias("b")), lambda x: F.trim(F.concat_ws(" ", x["a"], x["b"])))).otherwise(one)
    return kept.select("path", "serial", _collapsed("_first").alias("header"), names.alias("column_names"), "cells")


def ordered_tables(found: DataFrame, mark: str = TABLE_MARK) -> DataFrame:
    """Tables of several rows with a header from around them: serial, header and the rows below the first, padded.

    The header is the first cell; without the mark the latest of the last three paragraphs that has it; then a cell of
    the last one-row table; then a cell of the first two rows (the lower row counts). Else the table is unnamed. Charts
    and tables without content are left out.
    """
    before = Window.partitionBy("path").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    paragraph = F.when((F.col("kind") == "paragraph") & (F.trim("text") != ""), F.trim("text"))
    said = found.withColumn("_p", paragraph)
    said = said.withColumn("_n", F.count("_p").over(before)).withColumn("_m", F.last(F.when(F.contains("_p", F.lit(mark)), F.struct(F.col("_n").alias("n"), F.col("_p").alias("t"))), ignorenulls=True).over(before))
    said = said.withColumn("_single", F.last(F.when((F.col("kind") == "table") & (F.size("cells") == 1), F.get("cells", F.lit(0))), ignorenulls=True).over(before))
    has = lambda c: F.coalesce(F.contains(c, F.lit(mark)), F.lit(False))
    pick = lambda cells, m=mark: F.get(F.filter(cells, lambda c: F.contains(c, F.lit(m))), F.lit(0))
    row = lambda i: F.get("cells", F.lit(i))
    corner = F.get(row(0), F.lit(0))
    near = F.when(F.col("_n") - F.col("_m.n") <= 3, F.col("_m.t"))
    header = F.when(has(corner), corner).otherwise(F.coalesce(near, pick(F.col("_single"), f" {mark}"), pick(row(1)), pick(row(0)), corner, F.lit("")))
    content = F.slice("cells", 2, F.size("cells"))
    filled = F.exists(content, lambda r: F.exists(r, lambda c: c != ""))
    kept = said.filter((F.col("kind") == "table") & (F.size("cells") > 1)).withColumn("header", header).filter(filled & ~F.contains("header", F.lit(CHART_MARK)))
    width = F.array_max(F.transform("cells", F.size))
    padded = F.transform(content, lambda r: F.slice(F.concat(r, F.array_repeat(F.lit(""), F.col("_w"))), F.lit(1), F.col("_w")))
    kept = kept.withColumn("_w", width).withColumn("serial", F.row_number().over(Window.partitionBy("path").orderBy("pos")))
    return kept.select("path", "serial", F.when(has(F.col("header")), F.col("header")).otherwise("unnamed").alias("header"), padded.alias("cells"))


def table_cells(tables: DataFrame) -> DataFrame:
    """path, serial, row_index, col_index and cell_value of nested rows."""
    rows = tables.select("path", "serial", F.posexplode("cells").alias("row_index", "r"))
    return rows.select("path", "serial", "row_index", F.posexplode("r").alias("col_index", "cell_value"))


def flat_text(found: DataFrame) -> DataFrame:
    """The whole document as text for a model: paragraphs, and table rows with cells between bars."""
    rows = F.concat_ws("\n", F.transform("cells", lambda r: F.array_join(r, " | ")))
    line = F.when(F.col("kind") == "table", rows).otherwise(F.trim("text"))
    return found.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("pos", line.alias("t")))).alias("x")).select("path", F.concat_ws("\n", F.filter(F.transform("x", lambda v: v["t"]), lambda t: t != "")).alias("text"))


MODEL_TABLES = "array<struct<table_id:string,table_name:string,full_header:string,is_continuation:boolean,base_table_id:string,column_names:array<string>,data:array<array<string>>>>"


def tables_from_model(texts: DataFrame, ask: Callable[[str], str]) -> DataFrame:
    """Tables that a model's reply holds; continuation rows go behind their base table's. ask: text -> reply, given by the user."""
    from gridloom.functions.text import json_array

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([ask(t or "") for t in b.column(1).to_pylist()], pa.string())], names=["path", "reply"])

    replies = texts.select("path", "text").mapInArrow(run, "path string, reply string")
    one = replies.select("path", F.posexplode(F.from_json(json_array(F.col("reply")), MODEL_TABLES)).alias("place", "t")).select("path", "place", "t.*")
    base = F.when(F.coalesce("is_continuation", F.lit(False)), F.coalesce("base_table_id", "table_id")).otherwise(F.col("table_id"))
    grouped = one.groupBy("path", base.alias("table_id")).agg(F.min_by("table_name", "place").alias("table_name"), F.min_by("column_names", "place").alias("column_names"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "data"))), lambda x: x["data"])).alias("data"))
    return grouped


_IMAGE = re.compile(r"word/media/.*\.(png|jpe?g|gif|bmp|wmf|emf)$", re.I)


def _chart_images(path: str, data: bytes) -> Iterator[tuple]:
    """The first picture of each table that carries the chart mark."""
    z = zipfile.ZipFile(io.BytesIO(data))
    names = set(z.namelist())
    body = ET.fromstring(z.read("word/document.xml")).find(f"{W}body")
    links = {}
    if "word/_rels/document.xml.rels" in names:
        links = {r.get("Id"): "word/" + r.get("Target", "").lstrip("/").removeprefix("word/") for r in ET.fromstring(z.read("word/_rels/document.xml.rels"))}
    n = 0
    for table in body.iter(f"{W}tbl"):
        title = next((t for row in _rows(table) for t in row if CHART_MARK in t), None)
        ids = [v for x in table.iter() for k, v in x.attrib.items() if k.endswith(("}embed", "}id")) and v in links and _IMAGE.match(links[v])]
        if title and ids and links[ids[0]] in names:
            n += 1
            yield path, n, title, links[ids[0]], z.read(links[ids[0]])


def chart_images(files: DataFrame) -> DataFrame:
    return _per_file(files, _chart_images, "path string, serial int, title string, member string, image binary")


def _workbooks(path: str, data: bytes) -> Iterator[tuple]:
    z = zipfile.ZipFile(io.BytesIO(data))
    for name in sorted(z.namelist()):
        if name.startswith("word/embeddings/") and name.endswith(".xlsx"):
            yield path, name, z.read(name)


def embedded_workbooks(files: DataFrame) -> DataFrame:
    """path, member and content of workbooks inside documents."""
    return _per_file(files, _workbooks, "path string, member string, content binary")


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]*", ref)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def _sheets(path: str, data: bytes) -> Iterator[tuple]:
    z = zipfile.ZipFile(io.BytesIO(data))
    names = set(z.namelist())
    shared = ["".join(t.text or "" for t in si.iter(f"{S}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall(f"{S}si")] if "xl/sharedStrings.xml" in names else []
    sheets = sorted((n for n in names if re.match(r"xl/worksheets/sheet\d+\.xml$", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
    for s, name in enumerate(sheets):
        for r, row in enumerate(ET.fromstring(z.read(name)).iter(f"{S}row")):
            for c, cell in enumerate(row.findall(f"{S}c")):
                kind, value = cell.get("t"), cell.findtext(f"{S}v")
                text = "".join(t.text or "" for t in cell.iter(f"{S}t")) if kind == "inlineStr" else shared[int(value)] if kind == "s" and value else value
                yield path, s, int(row.get("r", r + 1)) - 1, _column(cell.get("r", "")) if cell.get("r") else c, text


def workbook_cells(files: DataFrame) -> DataFrame:
    """path, sheet, row_index, col_index and cell_value of every sheet of every workbook (path, content)."""
    return _per_file(files, _sheets, "path string, sheet int, row_index int, col_index int, cell_value string")


def join_sheets(cells: DataFrame) -> DataFrame:
    """path, row_index, column_name and cell_value: sheets below each other by the names in their first row."""
    first = F.min("row_index").over(Window.partitionBy("path", "sheet"))
    at = cells.withColumn("_f", first)
    names = at.filter("row_index = _f").select("path", "sheet", "col_index", F.coalesce("cell_value", F.concat(F.lit("Column_"), F.col("col_index").cast("string"))).alias("column_name"))
    rows = F.dense_rank().over(Window.partitionBy("path").orderBy("sheet", "row_index")) - 1
    return at.filter("row_index > _f").join(names, ["path", "sheet", "col_index"]).select("path", rows.alias("row_index"), "column_name", "cell_value")
