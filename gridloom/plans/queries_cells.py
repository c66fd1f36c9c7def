"""Queries on grids, classes of cells and table structure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import text as X
from gridloom.operators import grid as G
from gridloom.operators import mask as M
from gridloom.operators import normalize as N
from gridloom.operators import stats as S
from gridloom.staging import stage

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


PART = ("p_name", "p_brand", "p_type", "p_size", "p_retailprice")


def part_cells(spark, d):
    wide = read(spark, d, "part").select(F.col("p_brand").alias("table_id"), F.col("p_partkey").alias("row_index"), *PART)
    return G.unpivot(wide, ("table_id", "row_index"), PART)


PART_CELLS = """cells AS (SELECT p_brand AS table_id, p_partkey AS row_index, unnest([0,1,2,3,4]) AS col_index,
  unnest([p_name, p_brand, p_type, CAST(p_size AS VARCHAR), CAST(p_retailprice AS VARCHAR)]) AS cell_value FROM part)"""


def event_cells(spark, d):
    """A table a user: kind, value, kind again or nothing after an error, a note."""
    e = read(spark, d, "events")
    from pyspark.sql import Window

    row = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    kind = F.col("event_type")
    wide = e.select(
        F.col("user_id").cast("string").alias("table_id"),
        row.alias("row_index"),
        kind.alias("c0"),
        F.when(kind == "view", kind).otherwise(F.get_json_object("props", "$.k")).alias("c1"),
        F.when(kind != "error", kind).alias("c2"),
        F.when(kind == "click", F.lit("N/A")).when(F.col("event_id") % 3 == 0, F.lit("--")).when(kind == "error", F.concat(F.lit("see (המשך) "), kind)).otherwise(kind).alias("c3"),
    )
    return G.unpivot(wide, ("table_id", "row_index"), ("c0", "c1", "c2", "c3"))


EVENT_CELLS = """wide AS (SELECT CAST(user_id AS VARCHAR) AS table_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INTEGER) AS row_index,
   event_type AS c0, CASE WHEN event_type = 'view' THEN event_type ELSE json_extract_string(props, '$.k') END AS c1,
   CASE WHEN event_type <> 'error' THEN event_type END AS c2,
   CASE WHEN event_type = 'click' THEN 'N/A' WHEN event_id % 3 = 0 THEN '--' WHEN event_type = 'error' THEN 'see (המשך) ' || event_type ELSE event_type END AS c3 FROM events),
cells AS (SELECT table_id, row_index, unnest([0,1,2,3]) AS col_index, unnest([c0,c1,c2,c3]) AS cell_value FROM wide)"""
MISSING = "(cell_value IS NULL OR trim(cell_value) = '' OR lower(trim(cell_value)) IN ('n/a','na','null','nan','none','missing','unknown'))"
NUMERIC = """(regexp_matches(v, '^[0-9]+\\.[0-9]+') OR regexp_matches(v, '^[0-9]{1,3}(,[0-9]{3})+') OR v IN ('-','--','---')
  OR coalesce(regexp_full_match(v, '[0-9]+') AND NOT (try_cast(v AS HUGEINT) BETWEEN 0 AND 9 OR try_cast(v AS HUGEINT) BETWEEN 1900 AND 2030), false))"""
MASK = f"""valued AS (SELECT *, CASE WHEN NOT {MISSING} THEN trim(cell_value) END AS v FROM cells),
counted AS (SELECT *, count(v) OVER (PARTITION BY table_id, row_index, v) AS same, count(v) OVER (PARTITION BY table_id, row_index) AS n FROM valued),
alike AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN same END) OVER (PARTITION BY table_id, row_index) AS top FROM counted),
ruled AS (SELECT *, CASE WHEN v IS NULL THEN 'None' WHEN n >= 2 AND top / n >= 0.8 THEN 'feature' WHEN {NUMERIC} THEN 'data-point' ELSE 'undecided' END AS m FROM alike),
tally AS (SELECT *, count_if(m = 'feature') OVER (PARTITION BY table_id, row_index) AS f, count_if(m = 'data-point') OVER (PARTITION BY table_id, row_index) AS p FROM ruled),
masked AS (SELECT table_id, row_index, col_index, cell_value, CASE WHEN m = 'None' THEN m WHEN f > p AND f / n >= 0.3 THEN 'feature' WHEN p > f AND p / n >= 0.3 THEN 'data-point' ELSE m END AS mask FROM tally)"""


@query(f"WITH {PART_CELLS} SELECT * FROM cells")
def cells_unpivot(spark, d):
    return part_cells(spark, d)


@query("SELECT p_brand AS table_id, p_partkey AS row_index, p_name AS c0, p_brand AS c1, p_type AS c2, CAST(p_size AS VARCHAR) AS c3, CAST(p_retailprice AS VARCHAR) AS c4 FROM part")
def cells_pivot_roundtrip(spark, d):
    return G.pivot(part_cells(spark, d), 5)


@query("""SELECT s_suppkey AS row_index, 's_name' AS column_name, s_name AS cell_value FROM supplier
UNION ALL SELECT s_suppkey, 's_nationkey', CAST(s_nationkey AS VARCHAR) FROM supplier""")
def cells_unpivot_named(spark, d):
    wide = read(spark, d, "supplier").withColumnRenamed("s_suppkey", "row_index")
    return G.unpivot_named(wide, ("row_index",), ("s_name", "s_nationkey"))


@query(f"WITH {EVENT_CELLS} SELECT table_id, row_index, col_index, {MISSING} AS missing FROM cells")
def scalar_missing(spark, d):
    return event_cells(spark, d).select("table_id", "row_index", "col_index", X.is_missing(F.col("cell_value")).alias("missing"))


@query(f"WITH {EVENT_CELLS}, t AS (SELECT *, trim(cell_value) AS v FROM cells) SELECT table_id, row_index, col_index, coalesce({NUMERIC}, false) AS num FROM t")
def scalar_numeric(spark, d):
    return event_cells(spark, d).select("table_id", "row_index", "col_index", X.is_numeric(F.col("cell_value")).alias("num"))


@query(f"WITH {PART_CELLS}, {MASK} SELECT table_id, col_index, mask, count(*) AS n, CAST(sum(row_index) AS BIGINT) AS keys FROM masked GROUP BY ALL")
def mask_hard_rules(spark, d):
    return M.hard_rules(part_cells(spark, d)).groupBy("table_id", "col_index", "mask").agg(F.count("*").alias("n"), F.sum("row_index").alias("keys"))


@query(f"WITH {EVENT_CELLS}, {MASK} SELECT * FROM masked")
def mask_cells(spark, d):
    return M.hard_rules(event_cells(spark, d))


@query(f"WITH {EVENT_CELLS}, {MASK} SELECT table_id, row_index, CAST(count_if(mask = 'feature') AS BIGINT) AS features, CAST(count_if(mask = 'data-point') AS BIGINT) AS points, CAST(count_if(mask = 'undecided') AS BIGINT) AS undecided FROM masked GROUP BY ALL")
def mask_counts(spark, d):
    n = lambda k, a: F.count_if(F.col("mask") == k).alias(a)
    return M.hard_rules(event_cells(spark, d)).groupBy("table_id", "row_index").agg(n("feature", "features"), n("data-point", "points"), n("undecided", "undecided"))


@query(f"WITH {EVENT_CELLS}, {MASK}, stored AS (SELECT *, mask = 'feature' AS is_feature FROM masked) SELECT c.* FROM cells c JOIN stored s USING (table_id, row_index, col_index) WHERE NOT s.is_feature")
def mask_data_only(spark, d):
    cells = event_cells(spark, d)
    return M.data_cells(cells, M.as_stored(M.hard_rules(cells)))


@query(f"WITH {EVENT_CELLS}, {MASK} SELECT table_id, row_index, col_index, CASE WHEN mask = 'feature' THEN 'feature' ELSE 'data-point' END AS mask FROM masked")
def mask_from_stored(spark, d):
    return M.from_stored(M.as_stored(M.hard_rules(event_cells(spark, d))))


@query(f"""WITH {EVENT_CELLS}, {MASK} SELECT table_id, row_index, col_index, cell_value,
 CASE WHEN mask = 'undecided' AND CAST(table_id AS BIGINT) % 5 <> 0 THEN CASE (row_index + col_index) % 3 WHEN 0 THEN 'feature' WHEN 1 THEN 'data-point' ELSE 'undecided' END ELSE mask END AS mask FROM masked""")
def mask_judge_merge(spark, d):
    """A judge by parity; it leaves out a cell of every fifth table, so its reply there has the wrong shape."""
    masked = M.hard_rules(event_cells(spark, d))
    at = (F.col("row_index") + F.col("col_index")) % 3
    reply = masked.filter((F.col("table_id").cast("long") % 5 != 0) | (F.col("col_index") > 0) | (F.col("row_index") > 0))
    reply = reply.select("table_id", "row_index", "col_index", F.when(at == 0, "feature").when(at == 1, "data-point").otherwise("None").alias("judged"))
    return M.merge_judgement(masked, reply)


@query(f"WITH {EVENT_CELLS}, {MASK} SELECT DISTINCT table_id FROM masked WHERE mask = 'undecided'")
def mask_open_tables(spark, d):
    return M.open_tables(M.hard_rules(event_cells(spark, d)))


@query(f"""WITH {EVENT_CELLS}, {MASK} SELECT DISTINCT table_id, row_index, 'data' AS kind FROM masked WHERE mask IN ('data-point', 'undecided')
UNION ALL SELECT DISTINCT table_id, row_index, 'feature' FROM masked WHERE mask = 'feature'""")
def mask_rows_by_class(spark, d):
    masked = staged_mask(spark, d)
    return G.rows_of_class(masked, "data").withColumn("kind", F.lit("data")).union(G.rows_of_class(masked, "feature").withColumn("kind", F.lit("feature")))


@query(f"""WITH {EVENT_CELLS}, sized AS (SELECT *, max(row_index) OVER (PARTITION BY table_id) + 1 AS n FROM cells)
SELECT table_id, CAST(dense_rank() OVER (PARTITION BY table_id ORDER BY row_index) - 1 AS INTEGER) AS row_index, col_index, cell_value FROM sized
WHERE NOT (CAST(table_id AS BIGINT) % 30 + 2001 < 2017 AND n > 2) OR row_index >= 2""")
def rows_skip_titles(spark, d):
    return G.skip_title_rows(event_cells(spark, d), F.col("table_id").cast("long") % 30 + 2001)


@query(f"""WITH {EVENT_CELLS}, ragged AS (SELECT * FROM cells WHERE cell_value IS NOT NULL), w AS (SELECT table_id, max(col_index) AS w FROM ragged GROUP BY 1),
rws AS (SELECT DISTINCT table_id, row_index FROM ragged), grid AS (SELECT table_id, row_index, unnest(range(0, w + 1)) AS col_index FROM rws JOIN w USING (table_id))
SELECT table_id, row_index, CAST(g.col_index AS INTEGER) AS col_index, r.cell_value FROM grid g LEFT JOIN ragged r USING (table_id, row_index, col_index)""")
def rows_pad(spark, d):
    return G.pad_rows(event_cells(spark, d).filter("cell_value is not null"))


@query("""WITH t AS (SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations)
SELECT conv_id, string_agg(role, ' ' ORDER BY turn) FILTER (WHERE before IS DISTINCT FROM role) AS joined FROM t GROUP BY 1""")
def adjacent_dedupe(spark, d):
    return G.collapse_runs(read(spark, d, "conversations"), ("conv_id",), "turn", "role")


@query(f"""WITH {EVENT_CELLS} SELECT a.table_id, a.col_index, trim(coalesce(a.cell_value, '') || ' ' || coalesce(b.cell_value, '')) AS name
FROM cells a LEFT JOIN cells b ON a.table_id = b.table_id AND a.col_index = b.col_index AND b.row_index = 1 WHERE a.row_index = 0""")
def two_row_names(spark, d):
    return G.two_row_names(event_cells(spark, d))


def staged_mask(spark, d):
    """Cells with their mask, written once: what follows reads them several times."""
    return stage(M.hard_rules(event_cells(spark, d)), "masked")


FEATURE_ROWS = "frows AS (SELECT DISTINCT table_id, row_index FROM masked WHERE mask = 'feature')"
HEADERS = f"""{FEATURE_ROWS}, heads AS (SELECT c.table_id, c.col_index, coalesce(nullif(string_agg(nullif(trim(cell_value), ''), ' | ' ORDER BY row_index), ''), 'Column_' || c.col_index) AS name
 FROM cells c JOIN frows USING (table_id, row_index) GROUP BY 1, 2)"""


@query(f"WITH {EVENT_CELLS}, {MASK}, {HEADERS} SELECT * FROM heads")
def header_join(spark, d):
    masked = staged_mask(spark, d)
    return G.build_headers(masked, G.rows_of_class(masked, "feature"))


@query("""WITH t AS (SELECT user_id AS table_id, CAST(event_id AS INTEGER) AS col_index, event_type AS name, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events)
SELECT table_id, col_index, CASE WHEN n > 1 THEN name || '__' || n ELSE name END AS name FROM t""")
def dedupe_names(spark, d):
    return G.unique_names(read(spark, d, "events").select(F.col("user_id").alias("table_id"), F.col("event_id").cast("int").alias("col_index"), F.col("event_type").alias("name")))


@query("""SELECT user_id AS chapter, year(ts) AS year, event_id AS serial, CAST(row_number() OVER (PARTITION BY user_id, year(ts) ORDER BY event_id) AS INTEGER) AS new_serial FROM events""")
def renumber(spark, d):
    e = read(spark, d, "events")
    return G.renumber(e.select(F.col("user_id").alias("chapter"), F.year("ts").alias("year"), F.col("event_id").alias("serial")))


@query(f"""WITH {EVENT_CELLS}, bad AS (SELECT DISTINCT table_id, row_index FROM cells WHERE cell_value LIKE '%המשך%')
SELECT table_id, CAST(dense_rank() OVER (PARTITION BY table_id ORDER BY row_index) - 1 AS INTEGER) AS row_index, col_index, cell_value FROM cells ANTI JOIN bad USING (table_id, row_index)""")
def rows_drop_marked(spark, d):
    return G.drop_marked_rows(event_cells(spark, d))


@query(f"""WITH {EVENT_CELLS} SELECT table_id, bool_and(coalesce(trim(cell_value), '') = '') AS all_blank, coalesce(bool_or(contains(cell_value, 'purch')), false) AS has_marker FROM cells GROUP BY 1""")
def table_flags(spark, d):
    return G.table_flags(event_cells(spark, d), "purch")


STRUCTURE = """filled AS (SELECT table_id, row_index, count(cell_value) AS n, bool_or(coalesce(contains(cell_value, 'המשך'), false)) AS mark FROM cells GROUP BY 1, 2),
frows0 AS (SELECT DISTINCT table_id, row_index FROM masked WHERE mask = 'feature'),
gaps AS (SELECT table_id, bool_or(row_index - prev > 1) AS gap FROM (SELECT *, lag(row_index) OVER (PARTITION BY table_id ORDER BY row_index) AS prev FROM frows0) GROUP BY 1),
flags AS (SELECT table_id, count(DISTINCT n) > 1 AS uneven, bool_or(mark) AS mark FROM filled GROUP BY 1),
shapes AS (SELECT table_id, CASE WHEN uneven THEN 'DISTORTED' WHEN mark THEN 'HAMSHECH' WHEN coalesce(gap, false) THEN 'TABLE_GOES_DOWN' ELSE 'STANDARD' END AS structure FROM flags LEFT JOIN gaps USING (table_id))"""


@query(f"WITH {EVENT_CELLS}, {MASK}, {STRUCTURE} SELECT * FROM shapes")
def structure_detect(spark, d):
    masked = staged_mask(spark, d)
    return N.structure(masked, masked)


BATCHES = f"""{FEATURE_ROWS}, rws AS (SELECT DISTINCT table_id, row_index FROM cells),
flagged AS (SELECT r.table_id, r.row_index, r.row_index = 0 OR f.row_index IS NOT NULL AS feat FROM rws r LEFT JOIN frows f USING (table_id, row_index)),
stepped AS (SELECT *, feat AND NOT coalesce(lag(feat) OVER (PARTITION BY table_id ORDER BY row_index), false) AS begins FROM flagged),
batches AS (SELECT table_id, row_index, feat, CAST(sum(CAST(begins AS INTEGER)) OVER (PARTITION BY table_id ORDER BY row_index) AS BIGINT) AS batch FROM stepped)"""


@query(f"WITH {EVENT_CELLS}, {MASK}, {BATCHES} SELECT * FROM batches")
def feature_batches(spark, d):
    masked = staged_mask(spark, d)
    return N.batches(masked, masked, F.lit(2020))


@query(f"""WITH {EVENT_CELLS}, {MASK}, {BATCHES} SELECT table_id, batch, row_index, CAST(row_number() OVER (PARTITION BY table_id, batch ORDER BY row_index) - 1 AS INTEGER) AS place FROM batches WHERE NOT feat""")
def data_segments(spark, d):
    masked = staged_mask(spark, d)
    return N.segments(N.batches(masked, masked, F.lit(2020)))


@query(f"""WITH {EVENT_CELLS}, {MASK}, {HEADERS}, numbered AS (SELECT *, row_number() OVER (PARTITION BY table_id, name ORDER BY col_index) AS k FROM heads),
drows AS (SELECT DISTINCT table_id, row_index FROM masked WHERE mask IN ('data-point', 'undecided'))
SELECT c.table_id, c.row_index, c.col_index, CASE WHEN k > 1 THEN name || '__' || k ELSE name END AS column_name, c.cell_value
FROM cells c JOIN drows USING (table_id, row_index) JOIN numbered h ON h.table_id = c.table_id AND h.col_index = c.col_index""")
def normalize_standard(spark, d):
    masked = staged_mask(spark, d)
    return N.standard(masked.drop("mask"), masked)


def varied_cells(spark, d):
    """Tables of every structure: a third with uneven rows, a third with continuation marks, a third with neither."""
    from pyspark.sql import Window

    e = read(spark, d, "events").withColumn("k", F.col("user_id") % 3)
    row = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    kind = F.col("event_type")
    wide = e.select(
        F.col("user_id").cast("string").alias("table_id"),
        row.alias("row_index"),
        kind.alias("c0"),
        F.when(kind == "view", kind).otherwise(F.get_json_object("props", "$.k")).alias("c1"),
        F.when((kind != "error") | (F.col("k") > 0), kind).alias("c2"),
        F.when(kind == "click", F.lit("N/A")).when(F.col("event_id") % 3 == 0, F.lit("--")).when((kind == "error") & (F.col("k") < 2), F.lit("see (המשך)")).otherwise(kind).alias("c3"),
    )
    return G.unpivot(wide, ("table_id", "row_index"), ("c0", "c1", "c2", "c3"))


VARIED = """wide AS (SELECT CAST(user_id AS VARCHAR) AS table_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INTEGER) AS row_index,
   event_type AS c0, CASE WHEN event_type = 'view' THEN event_type ELSE json_extract_string(props, '$.k') END AS c1, CASE WHEN event_type <> 'error' OR user_id % 3 > 0 THEN event_type END AS c2,
   CASE WHEN event_type = 'click' THEN 'N/A' WHEN event_id % 3 = 0 THEN '--' WHEN event_type = 'error' AND user_id % 3 < 2 THEN 'see (המשך)' ELSE event_type END AS c3 FROM events),
cells AS (SELECT table_id, row_index, unnest([0,1,2,3]) AS col_index, unnest([c0,c1,c2,c3]) AS cell_value FROM wide)"""


def _shapes(source, name):
    return f"""{name} AS (SELECT table_id, CASE WHEN uneven THEN 'DISTORTED' WHEN mark THEN 'HAMSHECH' WHEN coalesce(gap, false) THEN 'TABLE_GOES_DOWN' ELSE 'STANDARD' END AS structure
 FROM (SELECT table_id, count(DISTINCT n) > 1 AS uneven, bool_or(mark) AS mark FROM (SELECT table_id, row_index, count(cell_value) AS n, bool_or(coalesce(contains(cell_value, 'המשך'), false)) AS mark FROM {source} GROUP BY 1, 2) GROUP BY 1)
 LEFT JOIN (SELECT table_id, bool_or(row_index - prev > 1) AS gap FROM (SELECT *, lag(row_index) OVER (PARTITION BY table_id ORDER BY row_index) AS prev FROM (SELECT DISTINCT table_id, row_index FROM {source} WHERE mask = 'feature')) GROUP BY 1) USING (table_id))"""


NORMALIZED = f"""{_shapes('masked', 'kinds')},
marked AS (SELECT DISTINCT table_id, row_index FROM masked WHERE contains(cell_value, 'המשך')),
whole AS (SELECT m.table_id, CAST(dense_rank() OVER (PARTITION BY m.table_id ORDER BY m.row_index) - 1 AS INTEGER) AS row_index, col_index, cell_value, mask
 FROM masked m JOIN kinds USING (table_id) ANTI JOIN (SELECT marked.* FROM marked JOIN kinds USING (table_id) WHERE structure = 'HAMSHECH') g ON m.table_id = g.table_id AND m.row_index = g.row_index),
{_shapes('whole', 'again')},
down AS (SELECT table_id FROM again JOIN kinds k USING (table_id) WHERE again.structure = 'TABLE_GOES_DOWN' AND k.structure IN ('TABLE_GOES_DOWN', 'HAMSHECH')),
a AS (SELECT * FROM whole SEMI JOIN down USING (table_id)), b AS (SELECT * FROM whole ANTI JOIN down USING (table_id)),
flagged AS (SELECT table_id, row_index, row_index = 0 OR bool_or(mask = 'feature') AS feat FROM a GROUP BY 1, 2),
batched AS (SELECT *, sum(CAST(begins AS INTEGER)) OVER (PARTITION BY table_id ORDER BY row_index) AS batch FROM (SELECT *, feat AND NOT coalesce(lag(feat) OVER (PARTITION BY table_id ORDER BY row_index), false) AS begins FROM flagged)),
heads AS (SELECT a.table_id, batch, col_index, coalesce(nullif(string_agg(nullif(trim(cell_value), ''), ' | ' ORDER BY row_index), ''), 'Column_' || col_index) AS name FROM a JOIN batched USING (table_id, row_index) WHERE feat GROUP BY 1, 2, 3),
shifted AS (SELECT table_id, col_index + (batch - 1) * (max(col_index) OVER (PARTITION BY table_id) + 1) AS col_index, name FROM heads),
named AS (SELECT table_id, col_index, CASE WHEN k > 1 THEN name || '__' || k ELSE name END AS column_name FROM (SELECT *, row_number() OVER (PARTITION BY table_id, name ORDER BY col_index) AS k FROM shifted)),
placed AS (SELECT table_id, batch, row_index, row_number() OVER (PARTITION BY table_id, batch ORDER BY row_index) - 1 AS place FROM batched WHERE NOT feat),
data AS (SELECT a.table_id, place AS row_index, col_index + (batch - 1) * (max(col_index) OVER (PARTITION BY a.table_id) + 1) AS col_index, cell_value FROM a JOIN placed USING (table_id, row_index)),
{FEATURE_ROWS.replace('masked', 'b')}, plain AS (SELECT b.table_id, col_index, coalesce(nullif(string_agg(nullif(trim(cell_value), ''), ' | ' ORDER BY row_index), ''), 'Column_' || col_index) AS name FROM b JOIN frows USING (table_id, row_index) GROUP BY 1, 2),
numbered AS (SELECT table_id, col_index, CASE WHEN k > 1 THEN name || '__' || k ELSE name END AS column_name FROM (SELECT *, row_number() OVER (PARTITION BY table_id, name ORDER BY col_index) AS k FROM plain)),
drows AS (SELECT DISTINCT table_id, row_index FROM b WHERE mask IN ('data-point', 'undecided')),
done AS (SELECT table_id, row_index, col_index, column_name, cell_value FROM data JOIN named USING (table_id, col_index) UNION ALL SELECT table_id, row_index, col_index, column_name, cell_value FROM b JOIN drows USING (table_id, row_index) JOIN numbered USING (table_id, col_index))
SELECT table_id, CAST(row_index AS INTEGER) AS row_index, CAST(col_index AS BIGINT) AS col_index, column_name, cell_value FROM done
UNION ALL SELECT table_id, row_index, col_index, 'Column_' || col_index, cell_value FROM whole WHERE table_id NOT IN (SELECT table_id FROM done)"""


@query(f"WITH {VARIED}, {MASK}, {NORMALIZED}")
def normalize_all(spark, d):
    return N.normalize(stage(M.hard_rules(varied_cells(spark, d)), "masked"), F.lit(2020)).withColumn("col_index", F.col("col_index").cast("long"))


@query(f"WITH {VARIED}, {MASK}, {_shapes('masked', 'kinds')} SELECT * FROM kinds")
def structure_kinds(spark, d):
    masked = stage(M.hard_rules(varied_cells(spark, d)), "masked")
    return N.structure(masked, masked)


@query(f"""WITH {EVENT_CELLS} SELECT table_id, col_index, CASE WHEN count(cell_value) > 0 AND bool_and(try_cast(cell_value AS DOUBLE) IS NOT NULL) FILTER (WHERE cell_value IS NOT NULL) THEN 'numeric' ELSE 'text' END AS kind FROM cells GROUP BY 1, 2""")
def type_inference(spark, d):
    return S.infer_types(event_cells(spark, d), ("table_id", "col_index"))


@query(f"WITH {EVENT_CELLS} SELECT table_id, round(100.0 * count(cell_value) / count(*), 6) AS completeness FROM cells GROUP BY 1")
def completeness(spark, d):
    return S.completeness(event_cells(spark, d), ("table_id",)).withColumn("completeness", F.round("completeness", 6))


@query(f"""WITH {EVENT_CELLS}, c AS (SELECT CAST(table_id AS BIGINT) % 7 AS chain_id, 2001 + CAST(table_id AS BIGINT) % 4 AS meta_year, table_id || ':' || row_index AS r, 'c' || col_index AS column_name, cell_value FROM cells)
SELECT chain_id, count(DISTINCT (meta_year, r)) AS n_rows, count(DISTINCT column_name) AS n_columns, count(DISTINCT meta_year) AS n_years, round(100.0 * count(cell_value) / count(*), 6) AS completeness,
CASE WHEN 100.0 * count(cell_value) / count(*) < 90 THEN 'low completeness' ELSE '' END AS issues, 100.0 * count(cell_value) / count(*) >= 90 AS valid FROM c GROUP BY 1""")
def validate_outputs(spark, d):
    c = event_cells(spark, d)
    merged = c.select(
        (F.col("table_id").cast("long") % 7).alias("chain_id"), (2001 + F.col("table_id").cast("long") % 4).alias("meta_year"),
        F.concat_ws(":", "table_id", F.col("row_index").cast("string")).alias("row_index"), F.concat(F.lit("c"), F.col("col_index").cast("string")).alias("column_name"), "cell_value",
    )
    return S.validate(merged, least=90.0)


@query(f"WITH {EVENT_CELLS} SELECT table_id, row_index, cell_value FROM cells WHERE row_index = 5 AND col_index = 2 AND cell_value LIKE '%i%'")
def cell_trace(spark, d):
    """One position followed over tables."""
    return G.cell_at(event_cells(spark, d), 5, 2, "%i%").orderBy("table_id")


@query(f"""WITH {EVENT_CELLS}, {MASK}, place AS (SELECT table_id, row_index, dense_rank() OVER (PARTITION BY table_id ORDER BY row_index) AS p, col_index, mask FROM masked WHERE row_index > 0)
SELECT c.table_id, c.row_index, c.col_index, c.cell_value, p.mask FROM (SELECT *, row_index + 1 AS p FROM cells) c JOIN place p ON c.table_id = p.table_id AND c.p = p.p AND c.col_index = p.col_index""")
def mask_by_position(spark, d):
    """The mask lacks each table's first row, so places are off by one and the last row is cut."""
    cells = event_cells(spark, d)
    return M.align_by_position(cells, M.hard_rules(cells).filter("row_index > 0"))


def _refuses(cells, classes):
    raise ConnectionError("a service that does not answer")


def _short(cells, classes):
    return classes[:-1]


def _by_place(cells, classes):
    import json

    return "Here it is: " + json.dumps([["feature" if (i + j) % 2 == 0 else "None" for j in range(len(r))] for i, r in enumerate(cells)])


@query(f"""WITH {EVENT_CELLS}, {MASK}, n AS (SELECT *, max(row_index) OVER (PARTITION BY table_id) + 1 AS n, bool_or(mask = 'undecided') OVER (PARTITION BY table_id) AS open FROM masked)
SELECT table_id, row_index, col_index, cell_value, CASE WHEN mask = 'undecided' AND n <= 60 AND (row_index + col_index) % 2 = 0 THEN 'feature' ELSE mask END AS mask, CASE WHEN open AND n <= 60 THEN 'by_place' END AS judged_by FROM n""")
def mask_judges_in_order(spark, d):
    """Small tables: a judge that fails, one of the wrong shape, one that answers. Large ones: none answers."""
    judges = {"refuses": _refuses, "short": _short, "by_place": _by_place}
    return M.judge_in_order(M.hard_rules(event_cells(spark, d)), judges, ("refuses", "short", "by_place"), ("short", "refuses"), limit=60)


REPAIR = """raw AS (SELECT o_orderkey, unnest([0, 1, 1, 1]) AS row_index, unnest([0, 0, 1, 2]) AS col_index, unnest(['לוח 1', CASE WHEN o_orderkey % 4 > 0 THEN 'לוח ' || o_custkey || chr(10) || 'x' END, o_orderpriority, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE o_orderpriority END]) AS v FROM orders)"""


@query(f"""WITH {REPAIR}, r AS (SELECT o_orderkey, max(CASE WHEN contains(v, 'לוח') THEN v END) AS m, count(DISTINCT CASE WHEN NOT contains(v, 'לוח') THEN v END) AS n, min(CASE WHEN NOT contains(v, 'לוח') THEN v END) AS o FROM raw WHERE row_index = 1 GROUP BY 1)
SELECT o_orderkey AS table_id, CASE WHEN m IS NOT NULL AND n <= 1 THEN replace(m, chr(10), ' ') || ' ' || o ELSE 'old' END AS header FROM r""")
def header_repair(spark, d):
    o = read(spark, d, "orders")
    at = lambda r, c, v: F.struct(F.lit(r).alias("row_index"), F.lit(c).alias("col_index"), v.cast("string").alias("cell_value"))
    marked = F.when(F.col("o_orderkey") % 4 > 0, F.concat(F.lit("לוח "), F.col("o_custkey").cast("string"), F.lit("\nx")))
    other = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).otherwise(F.col("o_orderpriority"))
    rows = F.explode(F.array(at(0, 0, F.lit("לוח 1")), at(1, 0, marked), at(1, 1, F.col("o_orderpriority")), at(1, 2, other)))
    cells = o.select(F.col("o_orderkey").alias("table_id"), rows.alias("x")).select("table_id", "x.*")
    return G.repair_headers(cells, o.select(F.col("o_orderkey").alias("table_id"), F.lit("old").alias("header")))


@query(f"WITH {EVENT_CELLS} SELECT table_id, row_index, c0, c1, c2, c3 FROM wide WHERE table_id = '7'")
def table_load(spark, d):
    return G.load_table(event_cells(spark, d), "7", 4)
