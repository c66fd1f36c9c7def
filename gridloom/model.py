"""The long-form data model: one row a cell, a link, a chain or a merged cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Schemas are DDL text, as readers and createDataFrame take it.
CELL = "chapter_id INT, chain_id STRING, table_id STRING, table_name STRING, year INT, row_index INT, col_index INT, cell_value STRING"
MASK = "chapter_id INT, chain_id STRING, table_id STRING, mask_name STRING, row_index INT, col_index INT, is_feature BOOLEAN, mask_class STRING"
CHAIN = "chapter_id INT, chapter_name STRING, chain_id STRING, chain_name STRING, table_count INT, years ARRAY<INT>, gaps ARRAY<INT>"
LINK = "chapter_id INT, chain_id STRING, seq INT, year INT, table_id STRING, header STRING, mask_reference STRING, similarity DOUBLE, api_validated BOOLEAN"
MERGED = "chain_id STRING NOT NULL, chapter_id INT, meta_year INT, row_index INT, column_name STRING, cell_value STRING, merge_timestamp TIMESTAMP, merge_status STRING"

FEATURE, DATA, NONE, UNDECIDED = "feature", "data-point", "None", "undecided"

#: serial_chapter_year
IDENTIFIER = r"([0-9]+)_([0-9]+)_([0-9]{4})"


def parse_identifier(text: Column) -> Column:
    """struct<serial, chapter, year> of an identifier anywhere in text; null if there is none."""
    part = lambda i: F.regexp_extract(text, IDENTIFIER, i).cast("int")
    return F.when(text.rlike(IDENTIFIER), F.struct(part(1).alias("serial"), part(2).alias("chapter"), part(3).alias("year")))


def build_identifier(serial: Column, chapter: Column, year: Column) -> Column:
    return F.concat_ws("_", serial.cast("string"), chapter.cast("string"), year.cast("string"))
