"""Queries on table metadata, counts and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import text as X
from gridloom.model import build_identifier, parse_identifier
from gridloom.operators import grid as G
from gridloom.operators import stats as S
from gridloom.operators import tables as T
from gridloom.plans.queries_cells import read

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


MARKED = """raw AS (SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'לוח: ' || o_custkey || '.2 שׁיעור ' WHEN 1 THEN 'ושיעור  בְּנֵי־ברק ' WHEN 2 THEN 'ממוצע ' || year(o_orderdate) || ' תושבים (המשך) ' WHEN 3 THEN 'סוף ' || year(o_orderdate) || chr(9)
 WHEN 4 THEN 'cafe' || chr(769) || ' ' WHEN 5 THEN 'לוח ' || o_custkey || ' ' ELSE 'לוח ' || o_custkey || '.' || o_custkey || ' 1999-2003' END || o_orderpriority || ' ' || year(o_orderdate) || CASE WHEN o_orderkey % 5 = 0 THEN ' "(ab)" 2001-2005*' ELSE '' END AS h FROM orders)"""


def marked_headers(spark, d):
    """A header for every order, of seven kinds that meet all rules."""
    key, cust, year = F.col("o_orderkey"), F.col("o_custkey").cast("string"), F.year("o_orderdate").cast("string")
    kinds = [
        ("לוח: ", cust, ".2 שׁיעור "), ("ושיעור  בְּנֵי־ברק ",), ("ממוצע ", year, " תושבים (המשך) "), ("סוף ", year, "\t"), ("cafe\u0301 ",), ("לוח ", cust, " "), ("לוח ", cust, ".", cust, " 1999-2003"),
    ]
    head = F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in kinds[-1]])
    for i, parts in reversed(list(enumerate(kinds[:-1]))):
        head = F.when(key % 7 == i, F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in parts])).otherwise(head)
    tail = F.when(key % 5 == 0, F.lit(' "(ab)" 2001-2005*')).otherwise("")
    return read(spark, d, "orders").select(key, F.concat(head, "o_orderpriority", F.lit(" "), year, tail).alias("h"))


@query(f"""WITH {MARKED}, a AS (SELECT o_orderkey, regexp_replace(nfc_normalize(h), '[\u0591-\u05C7]', '', 'g') AS h FROM raw),
b AS (SELECT o_orderkey, replace(regexp_replace(replace(h, 'ושיעור', 'ואחוז'), '\\s+', ' ', 'g'), '־', '-') AS h FROM a),
c AS (SELECT o_orderkey, regexp_replace(regexp_replace(regexp_replace(h, 'ממוצע [0-9]{{4}}', '', 'g'), 'סוף [0-9]{{4}}', '', 'g'), '[0-9]{{4}}', '', 'g') AS h FROM b),
e AS (SELECT o_orderkey, regexp_replace(replace(h, '(המשך)', ''), 'לוח:\\s*[0-9]+\\.[0-9]+', '', 'g') AS h FROM c)
SELECT o_orderkey, trim(regexp_replace(h, '\\s+', ' ', 'g')) AS header FROM e""")
def header_clean(spark, d):
    return marked_headers(spark, d).select("o_orderkey", X.clean_header(F.col("h")).alias("header"))


@query(f"""WITH {MARKED}, a AS (SELECT o_orderkey, regexp_replace(regexp_replace(h, '[0-9]{{4}}-[0-9]{{4}}', '', 'g'), 'לוח\\s+[0-9]+\\.?[0-9]*', '', 'g') AS h FROM raw)
SELECT o_orderkey, coalesce(nullif(substr(trim(regexp_replace(h, '\\s+', ' ', 'g')), 1, 200), ''), 'unnamed') AS name FROM a""")
def text_clean(spark, d):
    return marked_headers(spark, d).select("o_orderkey", X.clean_text(F.col("h")).alias("name"))


@query("""SELECT doc_id, coalesce(nullif(substr(trim(regexp_replace(regexp_replace(text, '[0-9]{4}-[0-9]{4}', '', 'g'), '\\s+', ' ', 'g')), 1, 200), ''), 'unnamed') AS name FROM documents""")
def text_clean_long(spark, d):
    return read(spark, d, "documents").select("doc_id", X.clean_text(F.col("text")).alias("name"))


@query(f"""WITH {MARKED} SELECT o_orderkey, trim(regexp_replace(regexp_replace(h, '[״"׳''*()-]', '', 'g'), '\\s+', ' ', 'g')) AS name FROM raw""")
def text_plain(spark, d):
    return marked_headers(spark, d).select("o_orderkey", X.plain_text(F.col("h")).alias("name"))


@query("SELECT doc_id, length(text) > 200 AND contains(substr(text, 51), substr(text, 1, 50)) AS repetitive FROM documents")
def text_repetitive(spark, d):
    return read(spark, d, "documents").select("doc_id", X.looks_repetitive(F.col("text")).alias("repetitive"))


@query("SELECT doc_id, md5(text) AS key FROM documents")
def text_key(spark, d):
    return read(spark, d, "documents").select("doc_id", X.text_key(F.col("text")).alias("key"))


@query("""SELECT p_partkey, replace(p_name || '**x*', '*', '') AS plain, regexp_replace(p_name || '**x*', '\\*+$', '') AS ended, translate(p_brand || ' a-b', '- ', '__') AS safe,
CASE WHEN length(p_name) > 9 THEN substr(p_name, 1, 6) || '...' ELSE p_name END AS short, 'mask - ' || p_name AS mask_name FROM part""")
def text_small_rules(spark, d):
    name = F.col("p_name")
    stars = F.concat(name, F.lit("**x*"))
    return read(spark, d, "part").select(
        "p_partkey", X.strip_stars(stars).alias("plain"), X.strip_stars(stars, True).alias("ended"), X.sanitize_name(F.concat("p_brand", F.lit(" a-b"))).alias("safe"),
        X.truncate(name, 9).alias("short"), F.concat(F.lit("mask - "), X.clean_text(name)).alias("mask_name"),
    )


@query("""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS ls, text FROM documents),
u AS (SELECT doc_id, text, list_filter(ls, lambda x, i: list_position(ls, x) = i) AS us FROM l)
SELECT doc_id, CASE WHEN len(us) > 0 THEN array_to_string(us[1:3], ' | ') ELSE substr(text, 1, 200) END AS header FROM u""")
def representative_header(spark, d):
    header = X.representative_header(F.col("text"), F.lit(None).cast("string"))
    return read(spark, d, "documents").select("doc_id", F.when(F.col("text").isNotNull(), header).alias("header"))


@query("""WITH i AS (SELECT o_orderkey, o_custkey % 15 + 1 AS chapter, CAST(1998 + o_custkey % 29 AS INTEGER) AS year, CAST(o_orderkey AS INTEGER) AS serial FROM orders)
SELECT *, CASE WHEN year IN (2017, 2018, 2020) THEN 'by_model' WHEN year BETWEEN 2001 AND 2016 THEN 'marked_tables' WHEN year BETWEEN 2019 AND 2024 THEN 'block_order' ELSE 'invalid' END AS route, year BETWEEN 2001 AND 2024 AS known FROM i""")
def id_parse_route(spark, d):
    o = read(spark, d, "orders")
    ident = build_identifier(F.col("o_orderkey"), F.col("o_custkey") % 15 + 1, 1998 + F.col("o_custkey") % 29)
    got = o.select("o_orderkey", parse_identifier(F.concat(F.lit("dir/"), ident, F.lit(".csv"))).alias("i"))
    return got.select("o_orderkey", F.col("i.chapter").cast("long").alias("chapter"), F.col("i.year").alias("year"), F.col("i.serial").alias("serial"), X.year_route(F.col("i.year")).alias("route"), X.known_year(F.col("i.year")).alias("known"))


@query("SELECT event_id, event_id || '_' || (user_id % 15) || '_' || 2023 AS key FROM events")
def filename_keys(spark, d):
    name = F.concat(F.lit("2023_0"), (F.col("user_id") % 15).cast("string"), F.lit("__0"), F.col("event_id").cast("string"), F.lit(".png"))
    return read(spark, d, "events").select("event_id", X.filename_key(name).alias("key"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, '[1, {"a": [2]}]' AS list FROM events""")
def json_from_noise(spark, d):
    noisy = F.concat(F.lit("Sure! ```json "), "props", F.lit(" ``` done [1, {\"a\": [2]}] bye"))
    obj = F.from_json(X.json_object(F.regexp_extract(noisy, r"(?s)```json(.*)```", 1)), "k INT")
    return read(spark, d, "events").select("event_id", obj["k"].alias("k"), X.json_array(noisy).alias("list"))


@query("""SELECT n_regionkey AS chapter, count(DISTINCT c_nationkey) AS chains, count(DISTINCT c_custkey) AS tables, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def summary_by_chapter(spark, d):
    both = read(spark, d, "customer").join(read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return S.summary_by(both.withColumnRenamed("n_regionkey", "chapter"), "chapter", chains="c_nationkey", tables="c_custkey")


@query("""SELECT o_custkey % 15 AS chapter, count(DISTINCT o_custkey) AS chains, count_if(o_orderstatus = 'F')::BIGINT AS completed, count_if(o_orderstatus = 'P')::BIGINT AS pending FROM orders GROUP BY 1""")
def status_by_chapter(spark, d):
    return S.status_by(read(spark, d, "orders").withColumn("chapter", F.col("o_custkey") % 15), "chapter", "o_custkey", "o_orderstatus", completed="F", pending="P")


@query("SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders WHERE o_orderpriority LIKE '%HIGH%' GROUP BY ALL")
def status_groups(spark, d):
    return S.grouped_counts(read(spark, d, "orders"), "o_custkey", "o_orderstatus", where=F.col("o_orderpriority").like("%HIGH%"))


@query("SELECT count(*) AS n FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber = 3")
def filtered_count(spark, d):
    return S.grouped_counts(read(spark, d, "lineitem"), where=F.expr("l_returnflag = 'A' AND l_linenumber = 3"))


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS status, count(*) AS n, count_if(o_orderpriority = '1-URGENT')::BIGINT AS urgent FROM orders GROUP BY ROLLUP (year(o_orderdate), o_orderstatus)")
def rollup_counts(spark, d):
    o = read(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("status"), "o_orderpriority")
    return S.rollup_counts(o, ("year", "status"), urgent=F.col("o_orderpriority") == "1-URGENT")


@query("""SELECT lang, source, count(*) AS n, count_if(toxic = 1)::BIGINT AS yes, round(100.0 * count_if(toxic = 1) / count(*), 2) AS percent FROM labels JOIN documents USING (doc_id) GROUP BY ROLLUP (lang, source)""")
def yes_no_rollup(spark, d):
    both = read(spark, d, "labels").join(read(spark, d, "documents").select("doc_id", "lang", "source"), "doc_id")
    out = S.rollup_counts(both, ("lang", "source"), yes=F.col("toxic") == 1)
    return out.withColumn("percent", F.round(S.percent(F.col("yes"), F.col("n")), 2))


@query("SELECT lang, source, count(*) AS n, count_if(lower(text) LIKE '%are%')::BIGINT AS unnamed FROM documents GROUP BY ROLLUP (lang, source)")
def unnamed_counts(spark, d):
    return S.rollup_counts(read(spark, d, "documents"), ("lang", "source"), unnamed=F.lower("text").like("%are%"))


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, round(avg(o_totalprice), 4) AS mean, round(median(o_totalprice), 4) AS median, round(stddev_pop(o_totalprice), 4) AS std, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY 1""")
def year_distribution(spark, d):
    out = S.distribution(read(spark, d, "orders").withColumn("year", F.year("o_orderdate")), ("year",), "o_totalprice")
    return out.select("year", *[F.round(c, 4).alias(c) for c in ("mean", "median", "std")], "low", "high")


@query("""WITH y AS (SELECT year(o_orderdate) AS y, o_custkey AS c, count(*) AS n, count_if(o_orderstatus = 'F') AS f FROM orders GROUP BY 1, 2),
r AS (SELECT y, sum(f) / sum(n) AS rate FROM y GROUP BY 1), l AS (SELECT c, count(*) AS len FROM y GROUP BY 1)
SELECT round((SELECT avg(rate) FROM r), 6) AS mean_rate, round(avg(len), 6) AS mean_length, max(len) AS longest, min(len) AS shortest FROM l""")
def match_rates(spark, d):
    from gridloom.operators import chains as C

    o = read(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("chain_id"), (F.col("o_orderstatus") == "F").alias("matched"))
    return C.match_report(o)


@query("""WITH s AS (SELECT source, count(*) AS n, count_if(quality = 1) AS k FROM labels JOIN documents USING (doc_id) GROUP BY 1), p AS (SELECT *, k / n AS p FROM s),
w AS (SELECT *, (p + 1.96 * 1.96 / (2 * n)) / (1 + 1.96 * 1.96 / n) AS mid, 1.96 * sqrt(p * (1 - p) / n + 1.96 * 1.96 / (4 * n * n)) / (1 + 1.96 * 1.96 / n) AS half FROM p)
SELECT source, n, k::BIGINT AS clean, round(p, 6) AS rate, round(sqrt(p * (1 - p) / n), 6) AS error, round(greatest(mid - half, 0), 6) AS low, round(least(mid + half, 1), 6) AS high FROM w""")
def wilson_interval(spark, d):
    both = read(spark, d, "labels").join(read(spark, d, "documents").select("doc_id", "source"), "doc_id")
    g = both.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("clean")).withColumn("w", S.wilson(F.col("clean"), F.col("n")))
    return g.select("source", "n", "clean", *[F.round(f"w.{c}", 6).alias(c) for c in ("rate", "error", "low", "high")])


@query("""SELECT role AS model, count(*) AS calls, sum(length(text))::BIGINT AS tokens, round(sum(length(text)) * 0.000003, 6) AS cost, round(avg(length(text)), 4) AS mean_tokens, round(100.0 * count_if(turn < 4) / count(*), 4) AS success FROM conversations GROUP BY 1""")
def cost_accounting(spark, d):
    return S.calls_by(read(spark, d, "conversations").withColumnRenamed("role", "model"), "model", F.length("text"), 0.000003, F.col("turn") < 4).orderBy(F.desc("calls"))


@query("""SELECT event_id, user_id, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS grp FROM events""")
def continuation_groups(spark, d):
    e = read(spark, d, "events").select("event_id", "user_id", "event_type")
    return T.continuation_groups(e, ("event_id",), F.col("event_type") == "error", ("user_id",)).drop("event_type")


@query("""SELECT event_id, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (ORDER BY event_id)::BIGINT AS grp FROM events""")
def continuation_groups_strict(spark, d):
    return T.continuation_groups(read(spark, d, "events").select("event_id", "event_type"), ("event_id",), F.col("event_type") == "error").drop("event_type")


@query("""WITH g AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS grp FROM events)
SELECT user_id, grp, event_id, event_type, CAST(row_number() OVER (PARTITION BY user_id, grp ORDER BY event_id) - 1 AS INTEGER) AS new_row FROM g""")
def continuation_union(spark, d):
    e = read(spark, d, "events").select("event_id", "user_id", "event_type")
    return T.union_continuations(T.continuation_groups(e, ("event_id",), F.col("event_type") == "error", ("user_id",)), ("user_id", "grp"), ("event_id",)).select("user_id", "grp", "event_id", "event_type", "new_row")


@query("SELECT text AS name, min(doc_id) AS first_id, count(*) AS n FROM documents GROUP BY 1")
def same_name_groups(spark, d):
    return T.same_name_groups(read(spark, d, "documents").select(F.col("text").alias("name"), "doc_id"), "name", "doc_id")


@query("SELECT text, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY 1")
def dedup_first(spark, d):
    return T.keep_first(read(spark, d, "documents").select("text", "doc_id", "source"), ("text",), ("doc_id",))


@query("""SELECT coalesce(n.doc_id, o.doc_id) AS doc_id, CASE WHEN n.doc_id IS NOT NULL THEN n.v ELSE o.v END AS v FROM (SELECT doc_id, 'old' || quality AS v FROM labels) o
FULL OUTER JOIN (SELECT 2 * doc_id AS doc_id, CASE WHEN doc_id % 3 > 0 THEN 'new' || source END AS v FROM documents) n ON o.doc_id = n.doc_id""")
def dict_upsert(spark, d):
    old = read(spark, d, "labels").select("doc_id", F.concat(F.lit("old"), F.col("quality").cast("string")).alias("v"))
    new = read(spark, d, "documents").select((2 * F.col("doc_id")).alias("doc_id"), F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("new"), "source")).alias("v"))
    return T.upsert(old, new, ("doc_id",))


@query("SELECT DISTINCT doc_id, 'pending' AS status FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_seed(spark, d):
    return T.seed_pending(read(spark, d, "documents"), read(spark, d, "labels"), "doc_id")


@query("SELECT d.doc_id, d.source FROM documents d LEFT JOIN labels l USING (doc_id) WHERE coalesce(l.toxic, 0) = 0")
def keep_unflagged(spark, d):
    flags = read(spark, d, "labels").select("doc_id", F.when(F.col("toxic") == 1, "YES").otherwise("NO").alias("flag"))
    return T.keep_unflagged(read(spark, d, "documents").select("doc_id", "source"), flags, "doc_id", "flag")


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN length(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS header_length FROM conversations""")
def lookback_header(spark, d):
    c = read(spark, d, "conversations")
    return c.select("conv_id", "turn", T.look_back(c, ("conv_id",), "turn", F.when(F.col("role") == "user", F.length("text").cast("long"))).alias("header_length"))


@query("SELECT p_brand, p_size FROM (SELECT DISTINCT p_brand FROM part) CROSS JOIN (SELECT DISTINCT p_size FROM part) EXCEPT SELECT p_brand, p_size FROM part")
def missing_combos(spark, d):
    p = read(spark, d, "part").select("p_brand", "p_size")
    return G.missing_pairs(p, p.select("p_brand").distinct(), p.select("p_size").distinct())


@query("SELECT doc_id, source FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42'), doc_id LIMIT 40")
def sample_hash(spark, d):
    return T.hash_sample(read(spark, d, "documents").select("doc_id", "source"), "doc_id", 40)


@query("""WITH s AS (SELECT doc_id, md5(CAST(doc_id AS VARCHAR) || ':42') AS h FROM documents ORDER BY h, doc_id LIMIT 40)
SELECT doc_id, CAST(row_number() OVER (ORDER BY h, doc_id) - 1 AS INTEGER) AS slot, ['a','b','c','d'][CAST((row_number() OVER (ORDER BY h, doc_id) - 1) % 4 + 1 AS INTEGER)] AS person FROM s""")
def sample_assigned(spark, d):
    return T.assign_in_turn(T.hash_sample(read(spark, d, "documents").select("doc_id"), "doc_id", 40), "abcd", "doc_id")


@query("SELECT DISTINCT user_id AS table_id, CAST(day(ts) AS INTEGER) AS year FROM events")
def distinct_tables(spark, d):
    return T.distinct_keys(read(spark, d, "events"), table_id=F.col("user_id"), year=F.dayofmonth("ts"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P' ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def first_rows(spark, d):
    return T.first_by(read(spark, d, "orders").filter("o_orderstatus = 'P'"), ("o_orderkey", "o_totalprice"), (F.desc("o_totalprice"), "o_orderkey"), 10)


@query("SELECT label, vec_id, round((vec_id - min(vec_id) OVER w) / (max(vec_id) OVER w - min(vec_id) OVER w), 6) AS scaled FROM embeddings WINDOW w AS (PARTITION BY label)")
def scaled_scores(spark, d):
    return S.normalise_scores(read(spark, d, "embeddings").select("label", "vec_id"), ("label",), "vec_id").withColumn("scaled", F.round("scaled", 6))


@query("SELECT n_regionkey AS chapter, string_agg(n_name, ',' ORDER BY n_name) AS ids FROM nation GROUP BY 1")
def grouped_lists(spark, d):
    return S.listed(read(spark, d, "nation").withColumnRenamed("n_regionkey", "chapter"), "chapter", "n_name").select("chapter", F.concat_ws(",", "ids").alias("ids"))


@query("SELECT n_nationkey, n_name FROM nation WHERE contains(n_name, '_1') OR contains(n_name, '_2')")
def chain_id_substring(spark, d):
    return T.with_text(read(spark, d, "nation"), "n_name", ("_1", "_2")).select("n_nationkey", "n_name")


@query("SELECT p_partkey, p_size FROM part WHERE p_size * p_size >= 200 AND p_type IN ('SMALL', 'ECONOMY')")
def size_filter(spark, d):
    return read(spark, d, "part").filter((F.col("p_size") * F.col("p_size") >= 200) & F.col("p_type").isin("SMALL", "ECONOMY")).select("p_partkey", "p_size")


@query("SELECT p_brand AS id, bool_or(lower(p_name) LIKE '%hot%') AS flagged, collate_n AS n FROM (SELECT p_brand, p_name, count(*) OVER (PARTITION BY p_brand) AS collate_n FROM part) GROUP BY 1, 3")
def any_cell_contains(spark, d):
    return S.any_contains(read(spark, d, "part").withColumnRenamed("p_brand", "id"), "id", "p_name", "hot")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey IN (3, 7, 24)")
def chain_id_filter(spark, d):
    return T.with_keys(read(spark, d, "nation"), "n_nationkey", (3, 7, 24)).select("n_nationkey", "n_name")


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def label_filter(spark, d):
    return T.with_label(read(spark, d, "documents").select("doc_id", "source"), read(spark, d, "labels"), "doc_id", "toxic", 1)


@query("SELECT doc_id, lang FROM documents ANTI JOIN labels USING (doc_id)")
def drop_continuations(spark, d):
    return T.without_keys(read(spark, d, "documents").select("doc_id", "lang"), read(spark, d, "labels"), "doc_id")


@query("""WITH r AS (SELECT n_nationkey, row_number() OVER (ORDER BY md5(CAST(n_nationkey AS VARCHAR) || ':42'), n_nationkey) - 1 AS r FROM nation)
SELECT n_nationkey, CAST(slot AS INTEGER) AS slot FROM range(0, 60) t(slot) JOIN r ON r = slot % (SELECT count(*) FROM nation)""")
def sample_repeated(spark, d):
    return T.sample_or_repeat(read(spark, d, "nation").select("n_nationkey"), "n_nationkey", 60)


@query("""SELECT source, CAST(CASE WHEN count(*) > 30 THEN 'large' ELSE 'small' END AS VARCHAR) AS first_model, printf('%.1f%%', round(100.0 * count_if(lang = 'en') / count(*), 1)) AS english FROM documents GROUP BY 1""")
def model_orders(spark, d):
    g = read(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("lang") == "en").alias("k"))
    return g.select("source", X.model_order(F.col("n")).alias("first_model"), X.percent_text(F.round(S.percent(F.col("k"), F.col("n")), 1)).alias("english"))
