import io
import json
import zipfile

from pyspark.sql import functions as F

from gridloom.sources import files, office, sinks
from gridloom.streaming.increments import append_new

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
MARK, CHART = office.TABLE_MARK, office.CHART_MARK


def para(t):
    return f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>"


def cell(t, span=0, merge=None):
    props = (f'<w:gridSpan w:val="{span}"/>' if span else "") + (f'<w:vMerge w:val="{merge}"/>' if merge else "")
    return f"<w:tc><w:tcPr>{props}</w:tcPr>{para(t)}</w:tc>"


def grid(*rows):
    return "<w:tbl>" + "".join("<w:tr>" + "".join(c if c.startswith("<") else cell(c) for c in r) + "</w:tr>" for r in rows) + "</w:tbl>"


def docx(*blocks, extra=()):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{''.join(blocks)}</w:body></w:document>")
        for name, data in extra:
            z.writestr(name, data)
    return out.getvalue()


def xlsx(*sheets):
    s = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {s}><si><t>name</t></si><si><t>n</t></si></sst>")
        for i, rows in enumerate(sheets, 1):
            body = "".join(f'<row r="{r}">' + "".join(f'<c r="{"ABC"[c]}{r}" t="{"s" if isinstance(v, int) else "inlineStr"}">' + (f"<v>{v}</v>" if isinstance(v, int) else f"<is><t>{v}</t></is>") + "</c>" for c, v in enumerate(row)) + "</row>" for r, row in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {s}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


def test_csv_grids_keep_positions(spark, tmp_path):
    (tmp_path / "2010" / "01").mkdir(parents=True)
    (tmp_path / "2010/01/1_1_2010.csv").write_text('0,1\n"a*\nb",2\n,x\n', encoding="utf-8-sig")
    (tmp_path / "2_1_2019.csv").write_text("p,q,r\ns\n", encoding="utf-8")
    got = {(r.table_id, r.year, r.row_index, r.col_index): r.cell_value for r in files.read_csv_grids(spark, str(tmp_path)).collect()}
    assert got == {
        ("1_1_2010", 2010, 0, 0): "a\nb", ("1_1_2010", 2010, 0, 1): "2", ("1_1_2010", 2010, 1, 0): "", ("1_1_2010", 2010, 1, 1): "x",
        ("2_1_2019", 2019, 0, 0): "p", ("2_1_2019", 2019, 0, 1): "q", ("2_1_2019", 2019, 0, 2): "r", ("2_1_2019", 2019, 1, 0): "s",
    }
    found = files.listing(spark, str(tmp_path))
    assert {r.extension: r.files for r in files.file_summary(found).collect()} == {"csv": 2}
    assert files.by_year_and_chapter(found, [2010], [1]).count() == 0


def test_dictionaries_and_chains(spark, tmp_path):
    (tmp_path / "tables.json").write_text(json.dumps({"3_2_2015": "a", "bad": "x", "1_2_2016": "b"}))
    got = {(r.id, r.header, r.serial, r.chapter, r.year) for r in files.read_dictionary(spark, str(tmp_path / "tables.json")).collect()}
    assert got == {("3_2_2015", "a", 3, 2, 2015), ("1_2_2016", "b", 1, 2, 2016)}
    named = files.names_or_ids(spark.createDataFrame([("3_2_2015",), ("z",)], "table_id string"), files.read_dictionary(spark, str(tmp_path / "tables.json")))
    assert {(r.table_id, r.table_name) for r in named.collect()} == {("3_2_2015", "a"), ("z", "z")}
    chain = {"c": {"id": "c", "tables": ["t1", "t2"], "years": [2001, 2003], "headers": ["h", "i"], "mask_references": ["m", "n"], "status": "active", "gaps": [2002]}}
    (tmp_path / "chains_chapter_7.json").write_text(json.dumps(chain))
    links = files.chain_links(files.read_chains(spark, str(tmp_path / "chains_chapter_*.json"))).collect()
    assert [(r.chapter_id, r.chain_id, r.seq, r.year, r.table_id) for r in links] == [(7, "ch7_c", 0, 2001, "t1"), (7, "ch7_c", 1, 2003, "t2")]


def test_documents(spark, tmp_path):
    book = xlsx([[0, 1], ["a", "1"]], [[1, 0], ["2", "b"]])
    a = docx(
        para(f"{MARK} 1 about"), grid(["x", "y"], ["1", "2"]), grid(["one row"]),
        grid([cell(f"{MARK} 2", span=2), "k"], [cell("v", merge="restart"), "b", "c"], [cell("", merge="continue"), "e", "f"]),
        grid([f"{MARK} {CHART}"], ["z"]), grid(["q", "r"], ["", ""]), para("p"), para("p"), para("p"), grid(["m", "n"], ["o"]), extra=[("word/embeddings/w.xlsx", book)],
    )
    (tmp_path / "a.docx").write_bytes(a)
    (tmp_path / "broken.docx").write_bytes(b"no zip")
    found = office.blocks(office.documents(spark, str(tmp_path))).cache()
    marked = office.marked_tables(found).collect()
    assert [(r.serial, r.header, r.column_names) for r in marked] == [(1, f"{MARK} 2 k", ["v v", "b e", "c f"])]
    tables = sorted(office.ordered_tables(found).collect(), key=lambda r: r.serial)
    assert [(r.header, r.cells) for r in tables] == [(f"{MARK} 1 about", [["1", "2"]]), (f"{MARK} 2", [["v", "b", "c"], ["v", "e", "f"]]), ("unnamed", [["o", ""]])]
    assert office.table_cells(office.ordered_tables(found)).count() == 10
    assert MARK in office.flat_text(found).first().text
    books = office.embedded_workbooks(office.documents(spark, str(tmp_path)))
    cells = office.workbook_cells(books.select(F.col("member").alias("path"), "content"))
    assert {(r.row_index, r.column_name, r.cell_value) for r in office.join_sheets(cells).collect()} == {(0, "name", "a"), (0, "n", "1"), (1, "n", "2"), (1, "name", "b")}
    reply = 'Sure: [{"table_id": "1", "table_name": "t", "column_names": ["c"], "data": [["1"]]}, {"table_id": "2", "is_continuation": true, "base_table_id": "1", "data": [["2"]]}] done'
    model = office.tables_from_model(office.flat_text(found), lambda text: reply).collect()
    assert [(r.table_id, r.data) for r in model] == [("1", [["1"], ["2"]])]


def test_model_csv(spark):
    df = spark.createDataFrame([("a", "h*,i**\n1\n"), ("b", "null"), ("c", "one\ntwo"), ("d", None)], "k string, t string")
    got = {(r.k, r.row_index, r.col_index): r.cell_value for r in files.clean_csv_text(df, "k", "t").collect()}
    assert got == {("a", 0, 0): "h", ("a", 0, 1): "i", ("a", 1, 0): "1", ("a", 1, 1): ""}


def test_sinks(spark, tmp_path):
    out = str(tmp_path / "long")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "chain_id string, v int")
    sinks.replace_chains(rows, out)
    sinks.replace_chains(spark.createDataFrame([("b", 3), ("c", 4)], "chain_id string, v int"), out)
    assert {(r.chain_id, r.v) for r in spark.read.parquet(out).collect()} == {("a", 1), ("b", 3), ("c", 4)}
    status = sinks.seed_status(rows, spark.createDataFrame([("a", "completed")], "chain_id string, status string"))
    after = sinks.finish_status(status, rows.filter("v = 2"), rows.filter("v = 9"))
    assert {(r.chain_id, r.status) for r in after.collect()} == {("a", "completed"), ("b", "completed")}
    cells = spark.createDataFrame([("t", 2001, 1, 0, 0, "x"), ("t", 2001, 1, 1, 1, "y")], "table_id string, year int, chapter int, row_index int, col_index int, cell_value string")
    sinks.write_grids(cells, str(tmp_path / "grids"), 2)
    assert sorted(map(tuple, spark.read.csv(str(tmp_path / "grids")).select("_c0", "_c1").collect()), key=str) == sorted([("x", None), (None, "y")], key=str)
    titled = sinks.titled_rows(spark.createDataFrame([("t", "T")], "table_id string, title string"), spark.createDataFrame([("t", 0, "n")], "table_id string, col_index int, name string"), cells)
    assert titled.count() == 4
    sinks.write_dictionary(spark.createDataFrame([("1", "h")], "i string, v string"), str(tmp_path / "dict"), "i", "v")
    assert json.loads(spark.read.text(str(tmp_path / "dict")).first().value) == {"id": "1", "header": "h"}


def test_stream_reads_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1_1_2020.csv").write_text("a,b\n")
    go = lambda: append_new(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    go()
    (tmp_path / "in/2_1_2021.csv").write_text("c\n")
    go()
    assert sorted(r.cell_value for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def test_broken_files_lose_only_themselves(spark):
    book = xlsx([[0, 1], ["a", "1"]])
    rels = '<Relationships><Relationship Id="r1" Target="media/image1.png"/></Relationships>'
    picture = '<w:tbl><w:tr><w:tc>' + para(f"{CHART} of births") + '</w:tc></w:tr><w:tr><w:tc><w:p><a:blip xmlns:a="urn:a" xmlns:r="urn:r" r:embed="r1"/></w:p></w:tc></w:tr></w:tbl>'
    whole = docx(picture, extra=[("word/embeddings/b.xlsx", book), ("word/_rels/document.xml.rels", rels), ("word/media/image1.png", b"png")])
    rows = [("good", bytearray(whole)), ("text", bytearray(b"no zip")), ("cut", bytearray(whole[: len(whole) // 2])), ("empty", bytearray(docx())), ("null", None)]
    docs = spark.createDataFrame(rows, "path string, content binary")
    assert [(r.path, r.title, r.member, bytes(r.image)) for r in office.chart_images(docs).collect()] == [("good", f"{CHART} of births", "word/media/image1.png", b"png")]
    books = office.embedded_workbooks(docs)
    assert [(r.path, r.member) for r in books.collect()] == [("good", "word/embeddings/b.xlsx")]
    sheets = books.select("path", "content").union(spark.createDataFrame([("x", bytearray(b"PK"))], "path string, content binary"))
    assert {(r.row_index, r.col_index, r.cell_value) for r in office.workbook_cells(sheets).collect()} == {(0, 0, "name"), (0, 1, "n"), (1, 0, "a"), (1, 1, "1")}
    assert {r.path for r in office.blocks(docs).collect()} == {"good"}


def test_tables_of_the_catalog(spark, tmp_path):
    (tmp_path / "my file-1.csv").write_text("a,b\n1,x\n2,y\n")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sinks LOCATION '{tmp_path}/db'")
    spark.sql("USE sinks")
    try:
        assert sinks.csv_to_tables(spark, [str(tmp_path / "my file-1.csv")], "t_") == ["t_my_file_1"]
        assert [(r.a, r.b) for r in spark.table("t_my_file_1").orderBy("a").collect()] == [(1, "x"), (2, "y")]
        for _ in range(2):
            sinks.create_if_absent(spark, "long", "chain_id STRING, v INT, year INT", "year")
        sinks.append_rows(spark.createDataFrame([(2001, 5, "c")], "year int, v int, chain_id string"), "long")
        assert [(r.chain_id, r.v, r.year) for r in spark.table("long").collect()] == [("c", 5, 2001)]
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE sinks CASCADE")


def test_written_sets_of_tables(spark, tmp_path):
    merged = spark.createDataFrame([("a", 2001, 0, "n", "1")], "chain_id string, meta_year int, row_index int, column_name string, cell_value string")
    sinks.write_merged(merged, spark.createDataFrame([("a", True)], "chain_id string, valid boolean"), str(tmp_path / "out"))
    assert spark.read.parquet(f"{tmp_path}/out/long").count() == 1 and spark.read.json(f"{tmp_path}/out/report").first().valid
    pairs = spark.createDataFrame([("1", "old"), ("2", "old")], "id string, header string")
    pairs.write.parquet(str(tmp_path / "x_names"))
    sinks.upsert_dictionary(spark, spark.createDataFrame([("2", "new"), ("3", "new")], pairs.schema), str(tmp_path / "x_names"), str(tmp_path / "y_names"), ("id",))
    assert {(r.id, r.header) for r in spark.read.parquet(str(tmp_path / "y_names")).collect()} == {("1", "old"), ("2", "new"), ("3", "new")}
    both = sinks.union_by_suffix(spark, str(tmp_path), "_names")
    assert both.count() == 5 and "source_file" in both.columns
    from gridloom.operators.grid import side_by_side

    left = spark.createDataFrame([("t", 0, 0, "a")], "table_id string, row_index int, col_index int, cell_value string")
    assert {(r.col_index, r.cell_value) for r in side_by_side(left, left, 3).collect()} == {(0, "a"), (3, "a")}


def test_names_and_chains_come_back(spark, tmp_path):
    names = spark.createDataFrame([("1_2_2015", 'a "b"', 2), ("2_3_2016", "c", 3)], "id string, header string, chapter int")
    sinks.write_names(names, str(tmp_path / "names"))
    assert {(r.id, r.header, r.chapter) for r in files.read_dictionary(spark, str(tmp_path / "names")).collect()} == {tuple(r) for r in names.collect()}
    assert files.read_dictionary(spark, str(tmp_path / "nothing")).count() == 0
    (tmp_path / "bad.json").write_text("no json")
    assert files.read_dictionary(spark, str(tmp_path / "bad.json")).count() == 0
