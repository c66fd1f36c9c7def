"""Queries on similarity, chains, merging and stacking."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import text as X
from gridloom.operators import assign as A
from gridloom.operators import chains as C
from gridloom.operators import merge as R
from gridloom.operators import reports as P
from gridloom.operators import similarity as S
from gridloom.operators import stack as K
from gridloom.plans.queries_cells import read

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def two_sides(spark, d, a="embedding", b="embedding"):
    """All vectors, on two sides: chains are the even ones of a label, tables the odd ones. Identifiers are strings."""
    e = read(spark, d, "embeddings").withColumn("side", F.col("vec_id") % 2)
    one = lambda side, ident, v: e.filter(F.col("side") == side).select("label", F.concat(F.lit(ident[0]), F.col("vec_id").cast("string")).alias(ident), F.col("embedding").alias(v))
    return one(0, "chain", a), one(1, "tab", b)


def scored(spark, d, least=None):
    a, b = two_sides(spark, d, "a", "b")
    a, b = S.with_norm(a, "a", "na"), S.with_norm(b, "b", "nb")
    return S.block_pairs(a, b, ["label"], F.round((1 + S.cosine_by_norms("a", "b", "na", "nb")) / 2, 6), least).select("label", "chain", "tab", "similarity")


DOT = "list_sum(list_transform(list_zip({0}, {1}), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE)))"


def _cos(a, b):
    return f"({DOT.format(a, b)} / (sqrt({DOT.format(a, a)}) * sqrt({DOT.format(b, b)})))"


SCORED = f"""scored AS (SELECT x.label, 'c' || x.vec_id AS chain, 't' || y.vec_id AS tab, round((1 + {_cos('x.embedding', 'y.embedding')}) / 2, 6) AS similarity
 FROM embeddings x JOIN embeddings y ON x.label = y.label AND x.vec_id % 2 = 0 AND y.vec_id % 2 = 1)"""


@query(f"WITH {SCORED} SELECT * FROM scored")
def sim_matrix(spark, d):
    return scored(spark, d)


@query(f"WITH {SCORED} SELECT chain, arg_min(tab, (-similarity, tab)) AS tab, max(similarity) AS similarity FROM scored GROUP BY 1")
def sim_top(spark, d):
    return S.top_match(scored(spark, d), "chain", "tab")


@query(f"WITH {SCORED}, t AS (SELECT chain, max(similarity) AS similarity FROM scored GROUP BY 1) SELECT chain, similarity, similarity >= 0.62 AS judged, CASE WHEN similarity >= 0.62 THEN 'to judge' ELSE 'similarity below threshold' END AS reason FROM t")
def sim_gate(spark, d):
    return S.gate(S.top_match(scored(spark, d), "chain", "tab"), 0.62).select("chain", "similarity", "judged", "reason")


CONFLICTS = "c AS (SELECT tab, count(*) AS n, string_agg(chain, ',' ORDER BY chain) AS chains, arg_min(chain, (-similarity, chain)) AS winner FROM scored WHERE similarity >= 0.6 GROUP BY 1 HAVING count(*) > 1)"


@query(f"WITH {SCORED}, {CONFLICTS} SELECT * FROM c")
def sim_conflicts(spark, d):
    return S.conflicts(scored(spark, d), "chain", "tab", 0.6).withColumn("chains", F.concat_ws(",", F.col("chains").cast("array<string>")))


@query(f"WITH {SCORED} SELECT chain, count(*) AS n, string_agg(tab, ',' ORDER BY tab) AS tables, CASE WHEN count(*) = 2 THEN 'even_split' ELSE 'fragmentation' END AS kind FROM scored WHERE similarity >= 0.6 GROUP BY 1 HAVING count(*) > 1")
def sim_splits(spark, d):
    s = S.splits(scored(spark, d), "chain", "tab", 0.6)
    return s.withColumn("kind", X.split_kind(F.col("n"))).withColumn("tables", F.concat_ws(",", F.col("tables").cast("array<string>")))


@query(f"WITH {SCORED} SELECT tab, count(*) AS n, string_agg(chain, ',' ORDER BY chain) AS tables FROM scored WHERE similarity >= 0.6 GROUP BY 1 HAVING count(*) > 1")
def sim_merges(spark, d):
    return S.splits(scored(spark, d), "tab", "chain", 0.6).withColumn("tables", F.concat_ws(",", F.col("tables").cast("array<string>")))


@query(f"""WITH {SCORED}, hit AS (SELECT * FROM scored WHERE similarity >= 0.6), s AS (SELECT chain FROM hit GROUP BY 1 HAVING count(*) > 1), t AS (SELECT tab FROM hit GROUP BY 1 HAVING count(*) > 1)
SELECT h.chain, h.tab AS shared, (SELECT string_agg(tab, ',' ORDER BY tab) FROM hit z WHERE z.chain = h.chain) AS tables, (SELECT string_agg(chain, ',' ORDER BY chain) FROM hit z WHERE z.tab = h.tab) AS chains, CAST(0.7 AS DOUBLE) AS confidence
FROM hit h SEMI JOIN s USING (chain) SEMI JOIN t USING (tab)""")
def sim_many_to_many(spark, d):
    return S.many_to_many_vectors(*two_sides(spark, d), "label", "chain", "tab", "embedding", 0.6)


@query("""WITH n AS (SELECT DISTINCT p_type, p_name AS name FROM part)
SELECT a.p_type, a.name AS old, b.name AS new, round(CASE WHEN a.name = b.name THEN 1.0 ELSE 1 - levenshtein(a.name, b.name) / greatest(length(a.name), length(b.name)) END, 6) AS similarity FROM n a JOIN n b ON a.p_type = b.p_type""")
def column_similarity(spark, d):
    n = read(spark, d, "part").select("p_type", "p_name").distinct()
    pairs = S.block_pairs(n.withColumnRenamed("p_name", "old"), n.withColumnRenamed("p_name", "new"), ["p_type"], F.round(S.name_similarity(F.col("old"), F.col("new")), 6))
    return pairs


@query(f"""WITH {SCORED}, s AS (SELECT chain, tab, 0.5 + (similarity - 0.4) * 2 AS s FROM scored), j AS (SELECT *, CASE WHEN s >= 0.92 THEN 'accept' WHEN s >= 0.88 THEN 'uncertain' ELSE 'reject' END AS decision, CAST(CASE WHEN s >= 0.92 THEN 0.9 WHEN s >= 0.88 THEN 0.6 ELSE 0.8 END AS DOUBLE) AS confidence FROM s)
SELECT chain, tab, CASE WHEN s >= 0.97 THEN 'green' WHEN s >= 0.9 THEN 'amber' WHEN s >= 0.85 THEN 'orange' ELSE 'red' END AS colour, CASE WHEN s >= 0.97 THEN 'confident' ELSE 'uncertain' END AS sure,
CASE WHEN s >= 0.85 THEN 'high' WHEN s >= 0.5 THEN 'medium' END AS class, decision, confidence, CASE WHEN decision = 'uncertain' THEN 'manual' ELSE decision END AS action,
CASE WHEN s >= 0.97 THEN 'accept' WHEN s >= 0.85 THEN CASE WHEN s >= 0.92 THEN 'accept' ELSE 'reject' END ELSE 'reject' END AS ladder FROM j""")
def judge_ladder(spark, d):
    s = F.col("s")
    p = scored(spark, d).select("chain", "tab", (0.5 + (F.col("similarity") - 0.4) * 2).alias("s")).withColumn("j", X.default_judge(s))
    ladder = F.when(s >= 0.97, "accept").when((s >= 0.85) & (F.col("j.decision") == "accept"), "accept").otherwise("reject")
    return p.select(
        "chain", "tab", X.similarity_colour(s).alias("colour"), X.confidence(s).alias("sure"), X.match_class(s).alias("class"), F.col("j.decision").alias("decision"), F.col("j.confidence").alias("confidence"),
        X.judge_action(F.col("j.decision"), F.col("j.confidence")).alias("action"), ladder.alias("ladder"),
    )


def year_links(spark, d):
    """A chain a customer, a link a year with orders."""
    o = read(spark, d, "orders")
    return o.groupBy(F.col("o_custkey").alias("chain_id"), F.year("o_orderdate").alias("year")).agg(F.min("o_orderkey").alias("table_id"))


LINKS = "links AS (SELECT o_custkey AS chain_id, CAST(year(o_orderdate) AS INTEGER) AS year, min(o_orderkey) AS table_id FROM orders GROUP BY 1, 2)"


@query(f"""WITH {LINKS}, c AS (SELECT chain_id, min(year) AS first, max(year) AS last, list(year ORDER BY year) AS ys FROM links GROUP BY 1)
SELECT chain_id, first, last, array_to_string(ys, ',') AS years, array_to_string(list_filter(range(first, last + 1), lambda y: NOT list_contains(ys, y)), ',') AS gaps, round(len(ys) / (last - first + 1), 6) AS completeness FROM c""")
def year_coverage(spark, d):
    text = lambda c: F.concat_ws(",", F.col(c).cast("array<string>"))
    c = C.coverage(year_links(spark, d))
    return c.select("chain_id", "first", "last", text("years").alias("years"), text("gaps").alias("gaps"), F.round("completeness", 6).alias("completeness"))


@query(f"WITH {LINKS} SELECT * FROM (SELECT chain_id, lag(table_id) OVER (PARTITION BY chain_id ORDER BY year) AS source, table_id AS target, year FROM links) WHERE source IS NOT NULL")
def chain_edges(spark, d):
    return C.edges(year_links(spark, d))


@query(f"WITH {LINKS} SELECT count(*) AS nodes, count(*) - count(DISTINCT chain_id) AS edges, count(DISTINCT chain_id) AS components, round(2 * (count(*) - count(DISTINCT chain_id)) / count(*), 6) AS mean_degree FROM links")
def graph_stats(spark, d):
    return C.graph_stats(year_links(spark, d)).withColumn("mean_degree", F.round("mean_degree", 6))


@query(f"""WITH {LINKS}, b AS (SELECT chain_id, min(year) AS start FROM links GROUP BY 1), grid AS (SELECT chain_id, unnest(range(start, 2002)) AS year FROM b),
s AS (SELECT g.chain_id, CAST(g.year AS INTEGER) AS year, g.year - max(l.year) OVER (PARTITION BY g.chain_id ORDER BY g.year) AS gap FROM grid g LEFT JOIN links l ON l.chain_id = g.chain_id AND l.year = g.year)
SELECT chain_id, year, CASE WHEN gap = 0 THEN 'active' WHEN gap > 1 THEN 'ended' ELSE 'dormant' END AS state, gap = 1 AS turned_dormant FROM s""")
def chain_states(spark, d):
    return C.transitions(year_links(spark, d), 1990, 2001, max_gap=1)


@query(f"""WITH {LINKS}, b AS (SELECT chain_id, min(year) AS start FROM links GROUP BY 1), grid AS (SELECT chain_id, unnest(range(start, 2002)) AS year FROM b),
s AS (SELECT CAST(g.year AS INTEGER) AS year, g.year - max(l.year) OVER (PARTITION BY g.chain_id ORDER BY g.year) AS gap FROM grid g LEFT JOIN links l ON l.chain_id = g.chain_id AND l.year = g.year)
SELECT year, count_if(gap = 0)::BIGINT AS active, count_if(gap = 1)::BIGINT AS dormant, count_if(gap > 1)::BIGINT AS ended FROM s GROUP BY 1""")
def chain_status_counts(spark, d):
    return C.status_counts(C.transitions(year_links(spark, d), 1990, 2001, max_gap=1))


@query(f"WITH {LINKS} SELECT chain_id, CAST(row_number() OVER (PARTITION BY chain_id ORDER BY year) - 1 AS INTEGER) AS seq, year, table_id FROM links")
def chain_zip(spark, d):
    ordered = F.array_sort(F.collect_list(F.struct("year", "table_id")))
    lists = year_links(spark, d).groupBy("chain_id").agg(ordered.alias("x")).select("chain_id", F.transform("x", lambda v: v["year"]).alias("year"), F.transform("x", lambda v: v["table_id"]).alias("table_id"))
    return C.zip_links(lists, "year", "table_id")


@query(f"WITH {LINKS} SELECT chain_id, string_agg(CAST(table_id AS VARCHAR), ',' ORDER BY year) AS tables FROM links WHERE year IN (1996, 1998) GROUP BY 1")
def chain_filter_years(spark, d):
    chains = year_links(spark, d).groupBy("chain_id").agg(F.array_sort(F.collect_list(F.struct("year", "table_id"))).alias("links"))
    out = C.filter_years(chains, [1996, 1998])
    return out.select("chain_id", F.concat_ws(",", F.transform("links", lambda x: x["table_id"].cast("string"))).alias("tables"))


def nation_links(spark, d):
    """Links of all chains, by nation."""
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("chain_id"), F.col("c_nationkey").alias("chapter_id"))
    return year_links(spark, d).join(c, "chain_id")


NATION = f"{LINKS}, whole AS (SELECT l.chain_id, year, table_id, c_nationkey AS chapter_id FROM links l JOIN customer ON c_custkey = chain_id)"


@query(f"""WITH {NATION}, s AS (SELECT chapter_id, chain_id, list(year) AS ys FROM whole GROUP BY 1, 2), p AS (SELECT a.chapter_id, a.chain_id AS chain1, b.chain_id AS chain2, len(list_distinct(a.ys || b.ys)) AS covered, greatest(len(a.ys), len(b.ys)) AS most
FROM s a JOIN s b ON a.chapter_id = b.chapter_id AND a.chain_id < b.chain_id)
SELECT chapter_id, chain1, chain2, CAST(covered - most AS INTEGER) AS improvement, CAST(covered AS INTEGER) AS covered FROM p WHERE covered > most""")
def merge_candidates(spark, d):
    return R.complementary_pairs(R.year_sets(nation_links(spark, d), keep=("chapter_id",)), "chapter_id")


FIRST_WINS = """a AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, min(o_orderkey) AS table_id FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
b AS (SELECT CAST(year(o_orderdate) AS INTEGER) + 3 AS year, min(o_orderkey) AS table_id FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)"""


def two_chains(spark, d):
    """Finished orders are one chain, the others another, three years later, so the two overlap in part."""
    o = read(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    one = lambda c, later: o.filter(c).groupBy((F.col("year") + later).alias("year")).agg(F.min("o_orderkey").alias("table_id"))
    return one(F.col("o_orderstatus") == "F", 0), one(F.col("o_orderstatus") != "F", 3)


@query(f"WITH {FIRST_WINS} SELECT coalesce(a.year, b.year) AS year, coalesce(a.table_id, b.table_id) AS table_id FROM a FULL OUTER JOIN b ON a.year = b.year")
def chain_merge_first_wins(spark, d):
    return R.merge_first_wins(*two_chains(spark, d))


@query(f"""WITH {FIRST_WINS}, s AS (SELECT (SELECT list(year) FROM a) AS x, (SELECT list(year) FROM b) AS y), k AS (SELECT x, y, list_sort(list_distinct(x || y)) AS u FROM s)
SELECT array_to_string(u, ',') AS united, array_to_string(list_filter(u, lambda v: list_contains(x, v) AND list_contains(y, v)), ',') AS common,
array_to_string(list_filter(u, lambda v: NOT list_contains(y, v)), ',') AS first_only, array_to_string(list_filter(u, lambda v: NOT list_contains(x, v)), ',') AS second_only FROM k""")
def year_set_relations(spark, d):
    a, b = (R.year_sets(c.withColumn("chain_id", F.lit(1))).select("chain_id", F.col("years").alias(n)) for c, n in zip(two_chains(spark, d), "xy", strict=True))
    r = a.join(b, "chain_id").select(R.set_relations(F.col("x"), F.col("y")).alias("r")).select("r.*")
    return r.select(*[F.concat_ws(",", F.col(c).cast("array<string>")).alias(c) for c in r.columns])


@query()
def chain_merge_fixpoint(spark, d):
    links = nation_links(spark, d).withColumn("chain_id", F.col("chain_id").cast("string"))
    return R.merge_all(links)


@query()
def merge_report(spark, d):
    from gridloom.staging import stage

    links = stage(nation_links(spark, d).withColumn("chain_id", F.col("chain_id").cast("string")), "links")
    return R.merge_report(links, stage(R.merge_all(links), "merged"))


@query()
def assign_optimal(spark, d):
    return A.assign_vectors(*two_sides(spark, d), "label", "chain", "tab", "embedding", 0.5)


@query(f"""WITH RECURSIVE {SCORED}, ranked AS (SELECT label, chain, tab, similarity, row_number() OVER (PARTITION BY label ORDER BY similarity DESC, chain, tab) AS r FROM scored WHERE similarity >= 0.5),
walk AS (SELECT DISTINCT label, CAST(0 AS BIGINT) AS r, CAST([] AS VARCHAR[]) AS used, false AS took FROM ranked
 UNION ALL SELECT w.label, p.r, CASE WHEN list_contains(used, chain) OR list_contains(used, tab) THEN used ELSE used || [chain, tab] END, NOT (list_contains(used, chain) OR list_contains(used, tab)) FROM walk w JOIN ranked p ON p.label = w.label AND p.r = w.r + 1)
SELECT label, chain, tab, similarity FROM walk JOIN ranked USING (label, r) WHERE took""")
def assign_greedy(spark, d):
    return A.assign_vectors(*two_sides(spark, d), "label", "chain", "tab", "embedding", 0.5, greedy=True)


@query()
def chain_machine(spark, d):
    e = read(spark, d, "embeddings").select(F.col("label").alias("chapter_id"), (2001 + F.col("vec_id") % 8).cast("int").alias("year"), F.col("vec_id").cast("string").alias("table_id"), "embedding")
    return C.build_chains(e, C.MatchRules(threshold=0.5, accept=0.66, judged=0.6), judge=lambda s: s >= 0.62)


def yearly_headers(spark, d):
    """A chain a market segment; names change with the year."""
    y = read(spark, d, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    chains = read(spark, d, "customer").select(F.col("c_mktsegment").alias("chain_id")).distinct()
    names = F.array(F.concat(F.lit("Total orders "), (F.col("year") % 3).cast("string")), F.lit("Mean price"), F.when(F.col("year") % 2 == 0, "Share of urgent").otherwise("Share urgent"), F.concat(F.lit("x"), F.col("year").cast("string")))
    return y.join(F.broadcast(chains)).select("chain_id", "year", F.posexplode(names).alias("col_index", "name"))


#: What matching must find in `yearly_headers`: names of one place belong together, but x1999 and x2000 share no digit.
HEADERS = """y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders), c AS (SELECT DISTINCT c_mktsegment AS chain_id FROM customer),
named AS (SELECT chain_id, year, unnest([0, 1, 2, 3]) AS col_index, unnest(['Total orders ' || year % 3, 'Mean price', CASE WHEN year % 2 = 0 THEN 'Share of urgent' ELSE 'Share urgent' END, 'x' || year]) AS name FROM y CROSS JOIN c),
grouped AS (SELECT *, CASE WHEN col_index = 3 THEN year // 10 ELSE 0 END AS part FROM named),
ends AS (SELECT *, min(year) OVER w AS began, arg_min(name, year) OVER w AS first_name, arg_max(name, year) OVER w AS final_name FROM grouped WINDOW w AS (PARTITION BY chain_id, col_index, part))"""


@query(f"""WITH {HEADERS} SELECT chain_id, year, col_index, name, substr(md5(chain_id || ':' || began || ':' || col_index || ':' || first_name), 1, 12) AS col_id, final_name,
CASE WHEN year = began THEN 'new' WHEN name = first_name OR 1 - levenshtein(name, first_name) / greatest(length(name), length(first_name)) >= 0.85 THEN 'high' ELSE 'medium' END AS match FROM ends""")
def stack_schema(spark, d):
    return K.evolve_schema(yearly_headers(spark, d))


@query(f"""WITH {HEADERS}, g AS (SELECT c_mktsegment AS chain_id, CAST(year(o_orderdate) AS INTEGER) AS year, c_nationkey AS row_index, count(*) AS a, max(o_totalprice) AS b, count_if(o_orderpriority = '1-URGENT') AS c
 FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3), cells AS (SELECT chain_id, year, row_index, unnest([0, 1, 2]) AS col_index, unnest([CAST(a AS VARCHAR), CAST(b AS VARCHAR), CAST(c AS VARCHAR)]) AS cell_value FROM g),
stacked AS (SELECT chain_id, year AS meta_year, row_index, final_name AS column_name, cell_value FROM cells JOIN ends USING (chain_id, year, col_index))
SELECT * FROM stacked UNION ALL SELECT DISTINCT chain_id, year, 0, NULL, NULL FROM ends WHERE (chain_id, year) NOT IN (SELECT (chain_id, meta_year) FROM stacked)""")
def stack_long(spark, d):
    from gridloom.operators.grid import unpivot
    from gridloom.staging import stage

    o = read(spark, d, "orders").join(read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    g = o.groupBy(F.col("c_mktsegment").alias("chain_id"), F.year("o_orderdate").alias("year"), F.col("c_nationkey").alias("row_index"))
    wide = g.agg(F.count("*").alias("a"), F.max("o_totalprice").alias("b"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("c"))
    return K.stack(unpivot(stage(wide, "yearly"), ("chain_id", "year", "row_index"), ("a", "b", "c")), stage(K.evolve_schema(yearly_headers(spark, d)), "schema"))


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS meta_year, o_orderstatus AS k, CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS VARCHAR) END AS price, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS clerk FROM orders""")
def stack_years(spark, d):
    o = read(spark, d, "orders").withColumn("meta_year", F.year("o_orderdate")).withColumn("k", F.col("o_orderstatus"))
    a = o.filter("k = 'F'").select("k", F.col("o_totalprice").cast("string").alias("price"), "meta_year")
    b = o.filter("k <> 'F'").select("meta_year", F.col("o_orderpriority").alias("clerk"), "k")
    return K.stack_wide([a, b])


@query("""SELECT user_id AS chain_id, event_type AS col_id, arg_min(CAST(event_id AS VARCHAR), event_id) AS first_name, arg_max(CAST(event_id AS VARCHAR), event_id) AS last_name, count(DISTINCT event_id) AS n FROM events GROUP BY 1, 2""")
def name_history(spark, d):
    e = read(spark, d, "events").select(F.col("user_id").alias("chain_id"), F.col("event_type").alias("col_id"), F.col("event_id").cast("string").alias("name"), F.col("event_id").alias("year"))
    return K.name_history(e).select("chain_id", "col_id", "first_name", "last_name", F.size("years").cast("long").alias("n"))


@query()
def fallback_embeddings(spark, d):
    return S.embed_distinct(read(spark, d, "part").select("p_partkey", "p_name"), "p_name", S.fallback_embedding())


@query("""SELECT count(*) AS total, count_if(quality = 1)::BIGINT AS successful, count_if(quality <> 1)::BIGINT AS failed, round(avg(CASE WHEN quality = 1 THEN n_chars END), 4) AS mean_n_chars FROM labels JOIN documents USING (doc_id)""")
def run_summary(spark, d):
    both = read(spark, d, "labels").join(read(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return P.run_summary(both, F.col("quality") == 1, "n_chars").withColumn("mean_n_chars", F.round("mean_n_chars", 4))


@query("""SELECT event_id, CASE WHEN length(h) > 20 THEN substr(h, 1, 17) || '...' ELSE h END AS header FROM (SELECT event_id, coalesce(CASE WHEN event_type = 'view' THEN event_type END, CASE WHEN event_id % 2 = 0 THEN 'a long header of event ' || event_id END, 'none') AS h FROM events)""")
def section_display(spark, d):
    e = read(spark, d, "events").select("event_id", F.when(F.col("event_type") == "view", F.col("event_type")).otherwise(" ").alias("a"), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("a long header of event "), F.col("event_id").cast("string"))).alias("b"), F.lit("none").alias("c"))
    return e.select("event_id", X.truncate(P.first_filled("a", "b", "c"), 20).alias("header"))


FLOW = f"{LINKS}, f AS (SELECT *, lag(table_id) OVER (PARTITION BY chain_id ORDER BY year) AS source, 0.8 + (table_id % 20) / 100.0 AS s FROM links)"


@query(f"""WITH {FLOW} SELECT chain_id, source, table_id AS target, year, CASE WHEN table_id % 3 = 0 THEN 'dark ' ELSE '' END || CASE WHEN table_id % 20 >= 17 THEN 'green' WHEN table_id % 20 >= 10 THEN 'amber' WHEN table_id % 20 >= 5 THEN 'orange' ELSE 'red' END AS colour FROM f WHERE source IS NOT NULL""")
def flow_edges(spark, d):
    links = year_links(spark, d).withColumn("similarity", F.round(0.8 + (F.col("table_id") % 20) / 100, 2)).withColumn("api_validated", F.col("table_id") % 3 == 0)
    return P.flow_edges(links)


@query(f"""WITH {LINKS} SELECT chain_id, '{{"nodes":[' || string_agg('{{"year":' || year || ',"table_id":' || table_id || '}}', ',' ORDER BY year) || '],"n":' || count(*) || '}}' AS json FROM links GROUP BY 1""")
def graph_json(spark, d):
    return P.graph_json(year_links(spark, d))


@query("""WITH m AS (SELECT n_nationkey AS key, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE [n_regionkey, n_nationkey % 7] END AS vs FROM nation), x AS (SELECT key, unnest([0, 1]) AS place, unnest(vs) AS value FROM m WHERE vs IS NOT NULL)
SELECT m.key, (SELECT arg_max(r_name, place) FROM x JOIN region ON r_regionkey = value WHERE x.key = m.key) AS name FROM m""")
def mapped_names(spark, d):
    m = read(spark, d, "nation").select(F.col("n_nationkey").alias("key"), F.when(F.col("n_nationkey") % 4 != 0, F.array("n_regionkey", F.col("n_nationkey") % 7)).alias("values"))
    return P.mapped_names(m, read(spark, d, "region").select(F.col("r_regionkey").alias("value"), F.col("r_name").alias("name")))


@query(f"WITH {SCORED} SELECT tab, arg_min(chain, (-similarity, chain)) AS chain, max(similarity) AS similarity FROM scored WHERE similarity >= 0.6 GROUP BY 1")
def best_revival(spark, d):
    return P.best_revival(scored(spark, d), "chain", "tab", 0.6)


@query(f"""WITH {SCORED}, t AS (SELECT unnest([0.45, 0.5, 0.55, 0.6])::DOUBLE AS threshold), c AS (SELECT threshold, count_if(similarity >= threshold AND (substr(chain, 2)::BIGINT + substr(tab, 2)::BIGINT) % 3 = 0)::BIGINT AS tp, count_if(similarity >= threshold AND (substr(chain, 2)::BIGINT + substr(tab, 2)::BIGINT) % 3 <> 0)::BIGINT AS fp, count_if(similarity < threshold AND (substr(chain, 2)::BIGINT + substr(tab, 2)::BIGINT) % 3 = 0)::BIGINT AS fn FROM scored, t GROUP BY 1)
SELECT *, round(2 * tp / greatest(2 * tp + fp + fn, 1), 6) AS f1 FROM c""")
def threshold_search(spark, d):
    return P.grid_search(scored(spark, d), (0.45, 0.5, 0.55, 0.6), "similarity", (F.substring("chain", 2, 20).cast("long") + F.substring("tab", 2, 20).cast("long")) % 3 == 0)


@query("""WITH c AS (SELECT l_orderkey AS table_id, unnest([CAST(1890 + l_linenumber * 30 AS VARCHAR), l_returnflag, CASE WHEN l_linestatus = 'F' THEN '%' ELSE 'לוח' END]) AS v FROM lineitem),
k AS (SELECT table_id, CASE WHEN v = '%' THEN 'x percentage' WHEN v = 'לוח' OR try_cast(v AS DOUBLE) BETWEEN 1900 AND 2024 THEN v END AS v FROM c)
SELECT table_id, coalesce(string_agg(DISTINCT v, '|' ORDER BY v), '') AS features FROM k GROUP BY 1""")
def text_features(spark, d):
    cells = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("table_id"), F.explode(F.array((1890 + F.col("l_linenumber") * 30).cast("string"), "l_returnflag", F.when(F.col("l_linestatus") == "F", "%").otherwise(X.TABLE_MARK))).alias("cell_value"))
    return P.text_features(cells).select("table_id", F.concat_ws("|", "features").alias("features"))
