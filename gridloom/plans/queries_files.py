"""Queries that write tables as files and read them back, and readers of documents and workbooks."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions import text as X
from gridloom.operators import stats as T
from gridloom.plans.queries_cells import PART_CELLS, event_cells, part_cells, read
from gridloom.plans.queries_chains import NATION, nation_links
from gridloom.sources import files as R
from gridloom.sources import office as O
from gridloom.sources import sinks as W
from gridloom.staging import shared_folder, stage

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def folder(spark: SparkSession, name: str) -> str:
    """A folder for one query's files; it goes when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


NUMBERED = f"{PART_CELLS}, numbered AS (SELECT table_id, CAST(dense_rank() OVER (PARTITION BY table_id ORDER BY row_index) - 1 AS INTEGER) AS row_index, col_index, cell_value FROM cells)"


def grids(spark, d) -> DataFrame:
    """A grid a brand, with a year and a chapter."""
    cells = part_cells(spark, d)
    row = F.dense_rank().over(Window.partitionBy("table_id").orderBy("row_index")) - 1
    number = F.regexp_extract("table_id", "([0-9]+)$", 1).cast("int")
    return cells.withColumn("row_index", row).withColumn("year", 2001 + number % 24).withColumn("chapter", number % 15)


@query(f"WITH {NUMBERED} SELECT table_id, CAST(2001 + CAST(regexp_extract(table_id, '([0-9]+)$', 1) AS INTEGER) % 24 AS INTEGER) AS year, row_index, col_index, replace(cell_value, '*', '') AS cell_value FROM numbered")
def file_csv_grids(spark, d):
    path = folder(spark, "grids")
    W.write_grids(grids(spark, d), path, 5)
    return R.read_csv_grids(spark, path, header_before=None)


@query(f"WITH {NUMBERED} SELECT table_id, CAST(2001 + CAST(regexp_extract(table_id, '([0-9]+)$', 1) AS INTEGER) % 24 AS INTEGER) AS year, CAST(CASE WHEN CAST(regexp_extract(table_id, '([0-9]+)$', 1) AS INTEGER) % 24 + 2001 < 2017 THEN row_index - 1 ELSE row_index END AS INTEGER) AS row_index, col_index, cell_value FROM numbered WHERE row_index > 0 OR CAST(regexp_extract(table_id, '([0-9]+)$', 1) AS INTEGER) % 24 + 2001 >= 2017")
def file_csv_label_line(spark, d):
    """Grids of early years begin with a line of labels, which goes."""
    path = folder(spark, "labelled")
    W.write_grids(grids(spark, d), path, 5)
    return R.read_csv_grids(spark, path)


@query("SELECT 'csv' AS extension, count(DISTINCT p_brand) AS files, array_to_string(list_sort(list(DISTINCT CAST(2001 + CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) % 24 AS VARCHAR))), ',') AS years FROM part")
def file_listing(spark, d):
    path = folder(spark, "listed")
    W.write_grids(grids(spark, d), path, 5)
    found = R.listing(spark, path, "*.csv").withColumn("path", F.regexp_replace("path", "year=", ""))
    return R.file_summary(found).withColumn("years", F.concat_ws(",", "years"))


DICTIONARY = "ids AS (SELECT o_orderkey || '_' || (o_custkey % 15) || '_' || CAST(year(o_orderdate) AS INTEGER) AS id, o_orderpriority AS header, CAST(o_orderkey AS INTEGER) AS serial, CAST(o_custkey % 15 AS INTEGER) AS chapter, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)"


def dictionary(spark, d) -> DataFrame:
    chapter = (F.col("o_custkey") % 15).cast("int")
    return read(spark, d, "orders").select(F.concat_ws("_", "o_orderkey", chapter, F.year("o_orderdate")).alias("id"), F.col("o_orderpriority").alias("header"), chapter.alias("chapter"))


@query(f"WITH {DICTIONARY} SELECT * FROM ids")
def file_dictionary(spark, d):
    path = folder(spark, "names")
    W.write_names(dictionary(spark, d), path)
    return R.read_dictionary(spark, path)


@query(f"WITH {DICTIONARY}, t AS (SELECT o_orderkey || '_' || (o_custkey % 16) || '_' || CAST(year(o_orderdate) AS INTEGER) AS table_id FROM orders) SELECT table_id, coalesce(header, table_id) AS table_name FROM t LEFT JOIN ids ON id = table_id")
def names_or_ids(spark, d):
    tables = read(spark, d, "orders").select(F.concat_ws("_", "o_orderkey", F.col("o_custkey") % 16, F.year("o_orderdate")).alias("table_id"))
    return R.names_or_ids(tables, dictionary(spark, d))


@query("SELECT n_name AS table_id, n_name AS table_name FROM nation")
def names_missing_file(spark, d):
    """A dictionary that is not there gives no names."""
    nothing = R.read_dictionary(spark, folder(spark, "absent"))
    return R.names_or_ids(read(spark, d, "nation").select(F.col("n_name").alias("table_id")), nothing)


@query("SELECT n_name AS table_id FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900)")
def skip_existing(spark, d):
    nations = read(spark, d, "nation").select(F.col("n_name").alias("table_id"), "n_nationkey")
    done = read(spark, d, "customer").filter("c_acctbal > 9900").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("table_id")
    return R.skip_existing(nations, done).select("table_id")


@query(f"""WITH {NATION}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY chain_id ORDER BY year) - 1 AS INTEGER) AS seq FROM whole)
SELECT chapter_id, 'ch' || chapter_id || '_' || chain_id AS chain_id, seq, year, CAST(table_id AS VARCHAR) AS table_id, 'h' || year AS header, CASE WHEN seq > 0 THEN 'm' || table_id END AS mask_reference FROM r""")
def file_chains(spark, d):
    """Chains as JSON by chapter, read back as links."""
    at = F.array_sort(F.collect_list(F.struct("year", F.col("table_id").cast("string").alias("table_id"))))
    chains = nation_links(spark, d).groupBy("chapter_id", F.col("chain_id").cast("string").alias("chain_id")).agg(at.alias("x"))
    masks = F.transform("x", lambda v, i: F.when(i > 0, F.concat(F.lit("m"), v["table_id"])))
    chains = chains.select(
        "chapter_id", "chain_id", F.transform("x", lambda v: v["table_id"]).alias("tables"), F.transform("x", lambda v: v["year"]).alias("years"),
        F.transform("x", lambda v: F.concat(F.lit("h"), v["year"].cast("string"))).alias("headers"), masks.alias("mask_references"), F.lit("active").alias("status"),
    )
    path = folder(spark, "chains")
    W.write_chains(chains, path)
    return R.chain_links(R.read_chains(spark, path)).select("chapter_id", "chain_id", "seq", "year", "table_id", "header", "mask_reference")


@query(f"""WITH {NATION}, c AS (SELECT chapter_id, chain_id, CAST(count(*) AS INTEGER) AS table_count, list(year ORDER BY year) AS ys FROM whole GROUP BY 1, 2)
SELECT chapter_id, n_name AS chapter_name, chain_id, table_count, array_to_string(ys, ',') AS years, array_to_string(list_filter(range(list_min(ys), list_max(ys) + 1), lambda y: NOT list_contains(ys, y)), ',') AS gaps FROM c JOIN nation ON n_nationkey = chapter_id""")
def chain_metadata(spark, d):
    chapters = read(spark, d, "nation").select(F.col("n_nationkey").alias("chapter_id"), F.col("n_name").alias("chapter_name"))
    text = lambda c: F.concat_ws(",", F.col(c).cast("array<string>")).alias(c)
    return W.chain_metadata(nation_links(spark, d), chapters).select("chapter_id", "chapter_name", "chain_id", "table_count", text("years"), text("gaps"))


TITLED = """SELECT p_brand AS table_id, 0 AS row_index, 0 AS col_index, 'Table ' || p_brand AS cell_value FROM part GROUP BY p_brand
UNION ALL SELECT DISTINCT p_brand, 1, unnest([0, 1]), unnest(['name', 'size']) FROM part
UNION ALL SELECT p_brand, r, unnest([0, 1]), unnest([p_name, CAST(p_size AS VARCHAR)]) FROM (SELECT *, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) + 1 AS INTEGER) AS r FROM part)"""


@query(TITLED)
def titled_tables(spark, d):
    part = read(spark, d, "part")
    ids = part.select(F.col("p_brand").alias("table_id")).distinct()
    titles = ids.select("table_id", F.concat(F.lit("Table "), "table_id").alias("title"))
    names = ids.select("table_id", F.posexplode(F.array(F.lit("name"), F.lit("size"))).alias("col_index", "name"))
    row = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")) - 1
    cells = part.withColumn("row_index", row).select(F.col("p_brand").alias("table_id"), "row_index", F.posexplode(F.array("p_name", F.col("p_size").cast("string"))).alias("col_index", "cell_value"))
    return W.titled_rows(titles, names, cells)


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS k, unnest([0, 0, 1, 1]) AS row_index, unnest([0, 1, 0, 1]) AS col_index, unnest(['name', 'a,b', o_orderstatus || '*', '']) AS cell_value FROM orders WHERE o_orderpriority NOT LIKE '1%' AND o_orderpriority NOT LIKE '2%'""")
def model_csv_text(spark, d):
    """Replies of a model: a ragged table with stars, one column only, or nothing."""
    reply = F.when(F.col("o_orderpriority").like("1%"), F.lit("null")).when(F.col("o_orderpriority").like("2%"), F.lit("one\ncolumn")).otherwise(F.concat(F.lit('name*,"a,b**"\n'), "o_orderstatus", F.lit("*\n")))
    return R.clean_csv_text(read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), reply.alias("reply")), "k", "reply")


@query("""WITH s AS (SELECT n_name AS chain_id, CASE WHEN n_nationkey < 10 THEN 'completed' WHEN n_nationkey < 15 THEN 'failed' ELSE 'pending' END AS status FROM nation) SELECT * FROM s""")
def chain_status(spark, d):
    """Ten chains known, all seeded as pending, some done, some failed (and one of those done after all)."""
    n = read(spark, d, "nation").select(F.col("n_name").alias("chain_id"), "n_nationkey")
    known = n.filter("n_nationkey >= 15").select("chain_id", F.lit("pending").alias("status"))
    return W.finish_status(W.seed_status(n, known), n.filter("n_nationkey < 10"), n.filter("n_nationkey between 10 and 14"))


LONG = "SELECT l_returnflag AS chain_id, CAST(year(l_shipdate) AS INTEGER) AS meta_year, l_linenumber AS row_index, unnest(['quantity', 'price']) AS column_name, unnest([CAST(count(*) AS VARCHAR), CAST(max(l_extendedprice) AS VARCHAR)]) AS cell_value FROM lineitem GROUP BY 1, 2, 3"


def long_table(spark, d) -> DataFrame:
    g = read(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("chain_id"), F.year("l_shipdate").alias("meta_year"), F.col("l_linenumber").alias("row_index"))
    one = g.agg(F.count("*").cast("string").alias("q"), F.max("l_extendedprice").cast("string").alias("p"))
    x = F.explode(F.array(F.struct(F.lit("quantity").alias("column_name"), F.col("q").alias("cell_value")), F.struct(F.lit("price").alias("column_name"), F.col("p").alias("cell_value")))).alias("x")
    return one.select("chain_id", "meta_year", "row_index", x).select("chain_id", "meta_year", "row_index", "x.*")


@query(f"WITH l AS ({LONG}) SELECT chain_id, meta_year, row_index, column_name, CASE WHEN chain_id = 'R' THEN 'new' ELSE cell_value END AS cell_value FROM l")
def file_replace_chains(spark, d):
    """All chains written, then one replaced; the others stay."""
    path = folder(spark, "merged")
    rows = stage(long_table(spark, d), "long")
    W.replace_chains(rows, path)
    W.replace_chains(rows.filter("chain_id = 'R'").withColumn("cell_value", F.lit("new")), path)
    return spark.read.parquet(path).select("chain_id", "meta_year", "row_index", "column_name", "cell_value")


@query(f"WITH l AS ({LONG}) SELECT chain_id, meta_year, row_index, max(CASE WHEN column_name = 'quantity' THEN cell_value END) AS quantity, max(CASE WHEN column_name = 'price' THEN cell_value END) AS price FROM l GROUP BY 1, 2, 3")
def merged_wide(spark, d):
    return W.wide(long_table(spark, d), ["quantity", "price"])


@query(f"WITH l AS ({LONG}) SELECT chain_id || ': ' || count(DISTINCT (meta_year, row_index)) || ' rows, 2 columns, ' || count(DISTINCT meta_year) || ' years, ok' AS value FROM l GROUP BY chain_id")
def file_text_report(spark, d):
    path = folder(spark, "report")
    W.write_lines(W.report_lines(T.validate(long_table(spark, d))), path)
    return spark.read.text(path)


@query("SELECT n_name AS name FROM nation WHERE n_nationkey % 4 <> 1")
def kept_file_list(spark, d):
    n = read(spark, d, "nation").select(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 4 == 1, "YES").otherwise("NO").alias("redundant"))
    return W.kept_files(n.select("name"), n).select("name")


@query("""SELECT event_id, regexp_extract('masks/' || event_id || '_' || user_id % 15 || '_2004.csv', '([0-9]+_[0-9]+_[0-9]+)\\.csv', 1) AS table_id FROM events""")
def mask_ids(spark, d):
    e = read(spark, d, "events")
    path = F.concat(F.lit("masks/"), F.concat_ws("_", "event_id", F.col("user_id") % 15, F.lit("2004")), F.lit(".csv"))
    return e.select("event_id", R.mask_table_id(path).alias("table_id"))


# Documents and workbooks: one a region, made of its nations ---------------------------------------------------------

_WORD = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
_SHEET = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def _zip(members: dict[str, str | bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


def _paragraph(text: str) -> str:
    return f"<w:p><w:r><w:t>{escape(text)}</w:t></w:r></w:p>"


def _document(name: str, nations: list[str]) -> bytes:
    cell = lambda t, span=1: f'<w:tc><w:tcPr><w:gridSpan w:val="{span}"/></w:tcPr>{_paragraph(t)}</w:tc>'
    row = lambda *cells: f"<w:tr>{''.join(cells)}</w:tr>"
    title = f"{X.TABLE_MARK} 1.1 {name}"
    table = row(cell(title, 2)) + row(cell("nation"), cell("place")) + row(cell("name"), cell("number")) + "".join(row(cell(n), cell(str(i))) for i, n in enumerate(nations))
    sheet = lambda rows: f"<worksheet {_SHEET}><sheetData>{''.join(rows)}</sheetData></worksheet>"
    line = lambda r, *cs: f'<row r="{r}">' + "".join(f'<c r="{chr(65 + i)}{r}" t="inlineStr"><is><t>{escape(c)}</t></is></c>' for i, c in enumerate(cs)) + "</row>"
    book = _zip({"xl/worksheets/sheet1.xml": sheet([line(1, "nation", "place")] + [line(i + 2, n, str(i)) for i, n in enumerate(nations)])})
    body = _paragraph(f"About {name}") + f"<w:tbl>{table}</w:tbl>"
    return _zip({"word/document.xml": f"<w:document {_WORD}><w:body>{body}</w:body></w:document>", "word/embeddings/book1.xlsx": book})


def documents(spark, d) -> DataFrame:
    """path and content: a document a region, and one that is broken."""
    n = read(spark, d, "nation").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    regions = n.groupBy("r_name").agg(F.sort_array(F.collect_list("n_name")).alias("nations"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [_document(name, nations) for name, nations in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.binary())], names=["path", "content"])

    broken = spark.createDataFrame([("broken", bytearray(b"PK no document"))], "path string, content binary")
    return stage(regions.mapInArrow(run, "path string, content binary").union(broken), "documents")


NATIONS = "x AS (SELECT r_name AS path, n_name, CAST(row_number() OVER (PARTITION BY r_name ORDER BY n_name) - 1 AS INTEGER) AS i FROM nation JOIN region ON n_regionkey = r_regionkey)"


@query(f"WITH {NATIONS} SELECT path, 0 AS pos, 'paragraph' AS kind, 'About ' || path AS text, CAST(NULL AS INTEGER) AS n_rows FROM x GROUP BY path UNION ALL SELECT path, 1, 'table', NULL, CAST(count(*) + 3 AS INTEGER) FROM x GROUP BY path")
def document_blocks(spark, d):
    return O.blocks(documents(spark, d)).select("path", "pos", "kind", "text", F.when(F.col("kind") == "table", F.size("cells")).alias("n_rows"))


@query(f"WITH {NATIONS} SELECT path, 1 AS serial, 'לוח 1.1 ' || path AS header, 'nation name|place number' AS names, CAST(count(*) + 3 AS INTEGER) AS n_rows FROM x GROUP BY path")
def document_marked_tables(spark, d):
    t = O.marked_tables(O.blocks(documents(spark, d)))
    return t.select("path", "serial", "header", F.concat_ws("|", "column_names").alias("names"), F.size("cells").alias("n_rows"))


@query(f"""WITH {NATIONS}, h(row_index, a, b) AS (VALUES (0, 'nation', 'place'), (1, 'name', 'number')), g AS (SELECT path, i + 2 AS row_index, n_name AS a, CAST(i AS VARCHAR) AS b FROM x UNION ALL SELECT path, row_index, a, b FROM h, (SELECT DISTINCT path FROM x))
SELECT path, 1 AS serial, CAST(row_index AS INTEGER) AS row_index, unnest([0, 1]) AS col_index, unnest([a, b]) AS cell_value FROM g""")
def document_ordered_cells(spark, d):
    return O.table_cells(O.ordered_tables(O.blocks(documents(spark, d))))


@query(f"WITH {NATIONS} SELECT path, 'About ' || path || chr(10) || 'לוח 1.1 ' || path || ' | ' || 'לוח 1.1 ' || path || chr(10) || 'nation | place' || chr(10) || 'name | number' || chr(10) || string_agg(n_name || ' | ' || i, chr(10) ORDER BY i) AS text FROM x GROUP BY path")
def document_text(spark, d):
    return O.flat_text(O.blocks(documents(spark, d)))


def _ask(text: str) -> str:
    """A stand-in for a model: the second line's words as a table, and its continuation."""
    import json

    line = text.split("\n")[0]
    tables = [{"table_id": "1", "table_name": line, "full_header": line, "is_continuation": False, "column_names": ["a"], "data": [["x"]]}, {"table_id": "1b", "is_continuation": True, "base_table_id": "1", "column_names": ["a"], "data": [[line]]}]
    return f"Sure:\n```json\n{json.dumps(tables)}\n```"


@query("SELECT r_name AS path, '1' AS table_id, 'About ' || r_name AS table_name, 'a' AS names, 'x|About ' || r_name AS cells FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation)")
def document_model_tables(spark, d):
    t = O.tables_from_model(O.flat_text(O.blocks(documents(spark, d))), _ask)
    return t.select("path", "table_id", "table_name", F.concat_ws("|", "column_names").alias("names"), F.concat_ws("|", F.flatten("data")).alias("cells"))


@query(f"WITH {NATIONS}, g AS (SELECT path, i + 1 AS row_index, n_name AS a, CAST(i AS VARCHAR) AS b FROM x UNION ALL SELECT DISTINCT path, 0, 'nation', 'place' FROM x) SELECT path, 0 AS sheet, CAST(row_index AS INTEGER) AS row_index, unnest([0, 1]) AS col_index, unnest([a, b]) AS cell_value FROM g")
def workbook_cells(spark, d):
    books = O.embedded_workbooks(documents(spark, d))
    return O.workbook_cells(books.select("path", "content"))


@query(f"WITH {NATIONS} SELECT path, i AS row_index, unnest(['nation', 'place']) AS column_name, unnest([n_name, CAST(i AS VARCHAR)]) AS cell_value FROM x")
def workbook_joined(spark, d):
    return O.join_sheets(O.workbook_cells(O.embedded_workbooks(documents(spark, d)).select("path", "content")))
