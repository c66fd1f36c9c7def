import itertools
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.functions import text as X
from gridloom.model import build_identifier, parse_identifier
from gridloom.operators import assign, chains, grid, mask, merge, normalize, reports, similarity, stack, stats, tables, vectors


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "numeric"),
    [("12.5%", True), ("15%", False), ("1,234x", True), ("1,234.56", True), ("7", False), ("10", True), ("1899", True), ("1900", False), ("2030", False), ("2031", True), ("007", False), ("--", True), ("----", False), ("N/A", False), ("", False), (None, False), (" 42 ", True)],
)
def test_numeric(spark, text, numeric):
    assert one(spark, X.is_numeric(F.col("v")), text) is numeric


@pytest.mark.parametrize(("text", "missing"), [(None, True), ("", True), ("  \n", True), ("N/A", True), (" None ", True), ("Unknown", True), ("0", False), ("-", False)])
def test_missing(spark, text, missing):
    assert one(spark, X.is_missing(F.col("v")), text) is missing


def test_headers(spark):
    mark, more = X.TABLE_MARK, X.CONTINUATION
    assert one(spark, X.clean_header(F.col("v")), f"{mark}: 3.12  שׁיעור 2015 ({more})") == "שיעור"
    assert one(spark, X.clean_header(F.col("v"), nfc=True), "é סוף 2014 x") == "é x"
    assert one(spark, X.clean_text(F.col("v")), f"{mark} 3.1 a  b 2001-2005") == "a b"
    assert one(spark, X.clean_text(F.col("v")), " ") == "unnamed"
    assert one(spark, X.filename_key(F.col("v")), "2023_03__04.png") == "4_3_2023"
    assert one(spark, X.plain_text(F.col("v")), " a-b (c),  d_1 ") == "ab c, d_1"
    assert one(spark, X.clean_text(F.col("v")), f"{mark} 3") == "unnamed"
    assert one(spark, X.clean_header(F.col("v")), "cafe\u0301") == "caf\u00e9"
    assert one(spark, X.is_year(F.col("v")), " 1950 ") is True and one(spark, X.is_year(F.col("v")), "x") is False
    assert one(spark, X.is_hebrew(F.col("v")), "xש") is True
    got = one(spark, parse_identifier(F.concat(F.lit("m/"), build_identifier(F.lit(3), F.lit(2), F.lit(2015)), F.col("v"))), ".csv")
    assert (got.serial, got.chapter, got.year) == (3, 2, 2015)
    assert one(spark, X.json_array(F.col("v")), "no [1, [2]] end") == "[1, [2]]" and one(spark, X.json_array(F.col("v")), "none") is None


GRID = [["R", "R", "R", "R", "x"], ["R", "R", "R", "S", None], ["a", None, None, None, None], ["1.5", "2.5", "b", "c", "d"], ["1.5", "e", "f", "g", "h"], ["2005", "2006", "2007", "2008", "2009"], ["N/A", "", None, "null", " "], ["k", "k", "12", "13", ""]]
WANT = [["feature"] * 5, ["undecided"] * 4 + ["None"], ["undecided"] + ["None"] * 4, ["data-point"] * 5, ["data-point"] + ["undecided"] * 4, ["undecided"] * 5, ["None"] * 5, ["data-point"] * 4 + ["None"]]


def cells_of(spark, rows, table="t"):
    return spark.createDataFrame([(table, r, c, v) for r, row in enumerate(rows) for c, v in enumerate(row)], "table_id string, row_index int, col_index int, cell_value string")


def test_mask_golden_grid(spark):
    got = {(r.row_index, r.col_index): r["mask"] for r in mask.hard_rules(cells_of(spark, GRID)).collect()}
    assert [[got[r, c] for c in range(5)] for r in range(len(GRID))] == WANT


def test_judge_contract(spark):
    masked = mask.hard_rules(cells_of(spark, [["a", "b"], ["1.5", "2.5"]]))
    reply = lambda rows: spark.createDataFrame(rows, "table_id string, row_index int, col_index int, judged string")
    full = [("t", 0, 0, "feature"), ("t", 0, 1, "None"), ("t", 1, 0, "feature"), ("t", 1, 1, "feature")]
    read = lambda df: {(r.row_index, r.col_index): r["mask"] for r in df.collect()}
    assert read(mask.merge_judgement(masked, reply(full))) == {(0, 0): "feature", (0, 1): "undecided", (1, 0): "data-point", (1, 1): "data-point"}
    assert read(mask.merge_judgement(masked, reply(full[:3]))) == read(masked)


def test_pivot_refuses_two_values(spark):
    cells = cells_of(spark, [["a", "b"], ["c"]])
    assert {tuple(r) for r in grid.pivot(cells, 2).collect()} == {("t", 0, "a", "b"), ("t", 1, "c", None)}
    with pytest.raises(Exception, match="two values"):
        grid.pivot(cells.union(cells), 2).collect()
    assert grid.duplicate_cells(cells).count() == 0


def shape(spark, rows, feats):
    cells = cells_of(spark, rows)
    m = cells.withColumn("mask", F.when(F.col("row_index").isin(*feats), "feature").otherwise("data-point"))
    return cells, m, normalize.structure(cells, m).first().structure


def test_structures(spark):
    assert shape(spark, [["h", "i"], ["1", "2"]], [0])[2] == "STANDARD"
    assert shape(spark, [["h", "i"], ["1", None]], [0])[2] == "DISTORTED"
    assert shape(spark, [["h", "i"], ["1", X.CONTINUATION], ["3", "4"]], [0])[2] == "HAMSHECH"
    cells, m, kind = shape(spark, [["h", "i"], ["1", "2"], ["j", "j"], ["3", "4"], ["5", "6"]], [0, 2])
    assert kind == "TABLE_GOES_DOWN"
    got = {(r.row_index, r.column_name): r.cell_value for r in normalize.normalize(m, F.lit(2020)).collect()}
    assert got == {(0, "h"): "1", (0, "i"): "2", (0, "j"): "3", (0, "j__2"): "4", (1, "j"): "5", (1, "j__2"): "6"}
    _, m, _ = shape(spark, [["h", " "], ["1", X.CONTINUATION], ["3", "4"]], [0])
    assert {(r.row_index, r.column_name): r.cell_value for r in normalize.normalize(m, F.lit(2020)).collect()} == {(1, "h"): "3", (1, "Column_1"): "4"}
    _, m, _ = shape(spark, [["1", "2"]], [])
    assert {r.column_name for r in normalize.normalize(m, F.lit(2020)).collect()} == {"Column_0", "Column_1"}


def test_assignment_is_optimal():
    r = np.random.default_rng(1)
    for _ in range(150):
        n, m = r.integers(1, 6, 2)
        cost = r.integers(0, 20, (n, m)).astype(float)
        pairs = assign.best_assignment(cost)
        assert len(pairs) == min(n, m) == len({i for i, _ in pairs}) == len({j for _, j in pairs})
        wide = cost if n <= m else cost.T
        best = min(sum(wide[i, p[i]] for i in range(wide.shape[0])) for p in itertools.permutations(range(wide.shape[1]), wide.shape[0]))
        assert sum(cost[i, j] for i, j in pairs) == best
    assert len(assign.best_assignment(np.array([[1, 2], [3, 4]]))) == 2
    assert assign.greedy_assignment([(0.9, 0, 0), (0.9, 0, 1), (0.8, 1, 0), (0.6, 1, 1), (0.4, 2, 2)]) == [(0, 0, 0.9), (1, 1, 0.6)]


def test_cosine_and_conflicts(spark):
    v = spark.createDataFrame([([1.0, 0.0, 0.0], [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 0.0])], "a array<double>, b array<double>, c array<double>, z array<double>")
    a, b, c, z = map(F.col, "abcz")
    assert tuple(v.select(similarity.cosine(a, b), similarity.cosine(a, c), similarity.cosine_01(a, c), similarity.cosine(a, z), similarity.cosine_eps(a, z)).first()) == (1.0, 0.0, 0.5, 0.0, 0.0)
    pairs = spark.createDataFrame([(0, 0, 0.9), (0, 1, 0.3), (1, 0, 0.88), (1, 1, 0.4)], "chain int, tab int, similarity double")
    assert [(r.tab, r.n, r.winner) for r in similarity.conflicts(pairs, "chain", "tab", 0.85).collect()] == [(0, 2, 0)]


def machine(rows, rules=chains.MatchRules(), judge=chains._default_judge):
    return chains._machine(rules, judge)(pd.DataFrame(rows, columns=["chapter_id", "year", "table_id", "embedding"]))


def at(sim):
    angle = np.arccos(2 * sim - 1)
    return [float(np.cos(angle)), float(np.sin(angle))]


@pytest.mark.parametrize(("sim", "chains_", "judged"), [(0.98, 1, False), (0.93, 1, True), (0.90, 2, None), (0.86, 2, None), (0.80, 2, None), (0.70, 2, None)])
def test_validation_ladder(sim, chains_, judged):
    got = machine([(1, 2001, "a", [1.0, 0.0]), (1, 2002, "b", at(sim))])
    assert got.chain_id.nunique() == chains_ and len(got) == 2
    if judged is not None:
        assert bool(got[got.table_id == "b"].api_validated.iloc[0]) is judged


def test_chain_states_and_flags():
    rows = [(1, 2001, "a", [1.0, 0.0]), (1, 2002, "b", [0.0, 1.0]), (1, 2003, "c", [1.0, 0.0]), (1, 2009, "d", [0.0, 1.0])]
    got = machine(rows)
    assert list(got[got.chain_id == "chain_1_a"].table_id) == ["a", "c"]
    assert got[got.table_id == "d"].chain_id.iloc[0] == "chain_1_d"  # the chain of b had ended
    old = machine(rows, chains.MatchRules(max_gap=10))
    assert old[old.table_id == "d"].chain_id.iloc[0] == "chain_1_b"
    lost = machine([(1, 2001, "a", [1.0, 0.0]), (1, 2002, "b", at(0.6))], chains.MatchRules(compatible=True))
    assert set(lost.table_id) == {"a"}


def test_every_table_is_in_one_chain():
    r = np.random.default_rng(3)
    rows = [(1, int(y), f"{y}_{i}", r.normal(size=3).tolist()) for y in range(2001, 2010) for i in range(5)]
    got = machine(rows)
    assert sorted(got.table_id) == sorted(x[2] for x in rows)
    assert (got.sort_values(["chain_id", "seq"]).groupby("chain_id").year.diff().dropna() > 0).all()


def test_merge_fixpoint(spark):
    rows = [(1, c, y, f"{c}{y}") for c, ys in {"a": [2001, 2002], "b": [2002, 2003], "c": [2001, 2002, 2003], "d": [2009]}.items() for y in ys]
    links = spark.createDataFrame(rows, "chapter_id int, chain_id string, year int, table_id string")
    pairs = {(r.chain1, r.chain2): r.improvement for r in merge.complementary_pairs(merge.year_sets(links, keep=("chapter_id",)), "chapter_id").collect()}
    assert pairs == {("a", "b"): 1, ("a", "d"): 1, ("b", "d"): 1, ("c", "d"): 1}
    got = merge.merge_all(links)
    report = merge.merge_report(links, got).first()
    assert report.years_kept and report.chains_after < report.chains_before
    assert {r.chain_id for r in merge.merge_all(links, judge=lambda p, q: False).collect()} == {"a", "b", "c", "d"}
    first = {r.year: r.table_id for r in merge.merge_first_wins(links.filter("chain_id = 'a'"), links.filter("chain_id = 'b'")).collect()}
    assert first == {2001: "a2001", 2002: "a2002", 2003: "b2003"}


def test_merge_rounds_write_no_pairs_down():
    def plain(names, years):
        """Every pair of a round, sorted."""
        live = dict(zip(names, years, strict=True))
        for _ in range(10):
            pairs = [(p, q, len(live[p] | live[q])) for p, q in itertools.combinations(live, 2)]
            gains = [(p, q, n - max(len(live[p]), len(live[q])), n / (max(live[p] | live[q]) - min(live[p] | live[q]) + 1)) for p, q, n in pairs]
            used = set()
            for p, q, _, _ in sorted((x for x in gains if x[2] > 0), key=lambda x: (-x[2], -x[3])):
                if not {p, q} & used:
                    used |= {p, q}
                    live[f"merged_{p}_{q}"] = live.pop(p) | live.pop(q)
            if not used:
                break
        return list(live)

    r = random.Random(4)
    for _ in range(20):
        years = [frozenset(r.sample(range(2000, 2000 + r.choice([4, 12])), r.randint(1, 4))) for _ in range(r.randint(1, 40))]
        names = [f"c{i:02}" for i in range(len(years))]
        assert [name for _, name, _ in merge.greedy_rounds(names, years, 10)] == plain(names, years)
        asked = merge.greedy_rounds(names, years, 10, lambda p, q: True)
        assert [name for _, name, _ in asked] == plain(names, years)
    years = [frozenset(y for y in range(1992, 1999) if r.random() < 0.6) for _ in range(30_000)]
    tracemalloc.start()
    got = merge.greedy_rounds([str(i) for i in range(30_000)], years, 10)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100e6 and sorted(m for members, _, _ in got for m in members) == list(range(30_000))  # all pairs are 450 million


def test_merge_asks_about_headers_and_keeps_what_belongs_to_a_year(spark):
    head = {"a": "Births\nby region\nBirths", "b": "births by region", "c": "Deaths", "d": None}
    years = {"a": [1950, 2020], "b": [1951, 2020], "c": [2021], "d": [2022]}
    rows = [(1, c, y, f"{c}{y}", f"m{c}{y}", head[c]) for c, ys in years.items() for y in ys]
    links = spark.createDataFrame(rows, "chapter_id int, chain_id string, year int, table_id string, mask_reference string, header string")
    alike = lambda p, q: float(p.split()[0].lower() == q.split()[0].lower())
    got = merge.merge_all(links, similar=alike, judge=lambda p, q: f"Answer: YES, {p} and {q}")
    chains_ = {r.chain_id: r for r in merge.merged_chains(got).collect()}
    assert set(chains_) == {"merged_a_b", "c", "d"}
    one = chains_["merged_a_b"]
    assert (one.years, one.tables, one.mask_references) == ([1950, 1951, 2020], ["a1950", "b1951", "a2020"], ["ma1950", "mb1951", "ma2020"])
    assert one.headers == [head["a"], head["b"], head["a"]] and one.source_chains == ["a", "b"] and one.status == "merged" and len(one.gaps) == 68
    assert {r.chain_id for r in merge.merge_all(links, judge=lambda p, q: "Answer: NO, they differ. YES would be wrong").collect()} == {"a", "b", "c", "d"}
    asked = merge.merge_all(links, judge=lambda p, q: p == "Births | by region" and q == "births by region")
    assert {r.chain_id for r in asked.collect()} == {"merged_a_b", "c", "d"}
    pairs = {(r.chain1, r.chain2): (r.improvement, r.covered) for r in merge.complementary_pairs(merge.year_sets(links, keep=("chapter_id",)), "chapter_id").collect()}
    assert pairs["a", "b"] == (1, 3) and pairs["c", "d"] == (1, 2)


def test_identifiers_of_any_type(spark):
    rows = [("c1", "t1", 0.9), ("c1", "t2", 0.9), ("c2", "t1", 0.9), ("c2", "t2", 0.2), ("c10", "t2", 0.95)]
    pairs = spark.createDataFrame(rows, "chain string, tab string, similarity double")
    assert {(r.chain, r.tab, r.similarity) for r in similarity.top_match(pairs, "chain", "tab").collect()} == {("c1", "t1", 0.9), ("c2", "t1", 0.9), ("c10", "t2", 0.95)}
    assert {(r.tab, r.n, tuple(r.chains), r.winner) for r in similarity.conflicts(pairs, "chain", "tab", 0.85).collect()} == {("t1", 2, ("c1", "c2"), "c1"), ("t2", 2, ("c1", "c10"), "c10")}
    assert {(r.tab, r.chain) for r in reports.best_revival(pairs, "chain", "tab").collect()} == {("t1", "c1"), ("t2", "c10")}


def test_schema_evolution(spark):
    names = {2001: ["Total", "Mean price"], 2002: ["Mean prices", "Total", "New thing"], 2003: ["Total", "Mean price"]}
    rows = [("c", y, i, n) for y, ns in names.items() for i, n in enumerate(ns)]
    got = stack.evolve_schema(spark.createDataFrame(rows, "chain_id string, year int, col_index int, name string"))
    final = {(r.year, r.name): (r.final_name, r.match) for r in got.collect()}
    assert final[2002, "Mean prices"] == ("Mean price", "high") and final[2002, "New thing"][1] == "new" and final[2003, "Total"] == ("Total", "high")
    cells = spark.createDataFrame([("c", 2001, 0, 0, "1"), ("c", 2003, 0, 1, "2")], "chain_id string, year int, row_index int, col_index int, cell_value string")
    rows = {(r.meta_year, r.column_name): r.cell_value for r in stack.stack(cells, got).collect()}
    assert rows == {(2001, "Total"): "1", (2003, "Mean price"): "2", (2002, None): None}


def test_wilson_and_groups(spark):
    w = spark.range(1).select(stats.wilson(F.lit(39), F.lit(40)).alias("w")).first().w
    assert (round(100 * w.low, 2), round(100 * w.high, 2)) == (87.12, 99.56)
    rows = [(2001, 1, 1, "o"), (2001, 1, 2, "c"), (2001, 2, 1, "c"), (2001, 2, 2, "o")]
    df = spark.createDataFrame(rows, "year int, chapter int, serial int, kind string")
    strict = tables.continuation_groups(df, ("year", "chapter", "serial"), F.col("kind") == "c").collect()
    fixed = tables.continuation_groups(df, ("serial",), F.col("kind") == "c", ("year", "chapter")).collect()
    assert [r.grp for r in sorted(strict)] == [1, 1, 1, 2] and [r.grp for r in sorted(fixed)] == [1, 1, 0, 1]
    cov = chains.coverage(spark.createDataFrame([("a", 2001), ("a", 2004)], "chain_id string, year int")).first()
    assert cov.gaps == [2002, 2003] and cov.completeness == 0.5


def test_registry_agrees_with_sql(spark):
    import duckdb

    from gridloom.plans import registry

    d = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings labels conversations pages benchmark".split():
        db.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    for n in sorted(registry.ORACLE_SQL):
        a, b = registry.QUERIES[n](spark, d).toPandas(), db.execute(registry.ORACLE_SQL[n]).fetch_df()
        assert sorted(a.columns) == sorted(b.columns), n
        key = lambda df: sorted(map(str, df[sorted(df.columns)].astype(object).where(df.notna(), None).map(lambda v: None if v is None else float(v) if isinstance(v, (int, float, np.number)) else str(v)).values.tolist()))  # noqa: E731, B023
        assert key(a) == key(b), n


def test_chain_years_filter_can_be_strict(spark):
    rows = spark.createDataFrame([("a", [(2001, "x"), (2002, "y")]), ("b", [(2005, "z")])], "chain_id string, links array<struct<year:int,table_id:string>>")
    assert [r.chain_id for r in chains.filter_years(rows, [2001]).collect()] == ["a"]
    with pytest.raises(Exception, match="none of the years"):
        chains.filter_years(rows, [2001], strict=True).collect()


def test_judges_hand_on(spark):
    rows = [("t", r, c, v, m) for r in range(2) for c, (v, m) in enumerate([("x", "undecided"), ("1", "data-point"), (None, "None")])]
    masked = spark.createDataFrame(rows, "table_id string, row_index int, col_index int, cell_value string, mask string")

    def fails(cells, classes):
        raise ValueError

    every = lambda cells, classes: [["feature"] * 3] * 2
    run = lambda order, judges: {(r.row_index, r.col_index): (r.mask, r.judged_by) for r in mask.judge_in_order(masked, judges, order, ()).collect()}
    got = run(["fails", "empty", "short", "every"], {"fails": fails, "empty": lambda a, b: "", "short": lambda a, b: "[[1]]", "every": every})
    assert got == {(r, c): (m, "every") for r in range(2) for c, m in enumerate(["feature", "data-point", "None"])}
    assert set(run(["empty"], {"empty": lambda a, b: None}).values()) == {("undecided", None), ("data-point", None), ("None", None)}


def test_embeddings_are_cached(spark, tmp_path):
    from pyspark.sql.types import ArrayType, FloatType

    asked = spark.sparkContext.accumulator(0)

    def model():
        @F.pandas_udf(ArrayType(FloatType()))
        def embed(texts: pd.Series) -> pd.Series:
            asked.add(len(texts))
            return texts.map(lambda t: [float(len(t))])

        return embed

    path = str(tmp_path / "cache")
    for words, so_far in ((["a", "bb", "a"], 2), (["bb", "ccc"], 3)):
        df = spark.createDataFrame([(w,) for w in words], "w string")
        got = sorted((r.w, r.embedding) for r in similarity.embed_cached(df, "w", model(), path).collect())
        assert got == sorted((w, [float(len(w))]) for w in words)
        assert asked.value == so_far


def test_settings(spark, tmp_path):
    from gridloom.config import overlay, read_config

    defaults = {"a": 1, "match": {"high": 0.85, "low": 0.5}}
    assert overlay(defaults, {"match": {"low": 0.4}}) == {"a": 1, "match": {"high": 0.85, "low": 0.4}}
    assert overlay(defaults, {"match": {"low": 0.4}}, deep=False) == {"a": 1, "match": {"low": 0.4}}
    (tmp_path / "c.json").write_text('{"a": 2,\n "b": [1]}')
    assert read_config(spark, str(tmp_path / "c.json"), defaults) == defaults | {"a": 2, "b": [1]}


def test_schema_by_vectors_and_global_groups(spark):
    from pyspark.sql.types import ArrayType, FloatType

    @F.pandas_udf(ArrayType(FloatType()))
    def kinds(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [1.0, 0.0] if "people" in t or "population" in t else [0.0, 1.0])

    rows = [("c", 2001, 0, "population"), ("c", 2001, 1, "area"), ("c", 2002, 0, "surface"), ("c", 2002, 1, "number of people")]
    headers = spark.createDataFrame(rows, "chain_id string, year int, col_index int, name string")
    got = {(r.year, r.name): (r.final_name, r.match) for r in stack.evolve_schema(headers, model=kinds).collect()}
    assert got == {(2001, "population"): ("number of people", "new"), (2001, "area"): ("surface", "new"), (2002, "surface"): ("surface", "high"), (2002, "number of people"): ("number of people", "high")}
    df = spark.range(1000).withColumn("more", F.col("id") % 7 > 0).filter("id > 2").repartition(5)
    want = {i: sum(1 for k in range(3, i + 1) if k % 7 == 0) for i in range(3, 1000)}
    assert {r.id: r.grp for r in tables.continuation_groups(df, ("id",), F.col("more")).collect()} == want
    with pytest.raises(Exception, match="the most is 1"):
        pairs = spark.createDataFrame([(1, "a", "x", 0.9), (1, "b", "x", 0.8)], "g int, l string, r string, s double")
        assign.assign_groups(pairs, "g", "l", "r", "s", 0.5, most=1).collect()


def random_sides(spark, n, m, size=6, seed=1):
    r = np.random.default_rng(seed)
    one = [(0, f"c{i}", r.normal(size=size).round(1).tolist()) for i in range(n)]
    two = [(0, f"t{i}", r.normal(size=size).round(1).tolist()) for i in range(m)]
    one[0], one[1], two[0] = (0, "c0", [0.0] * size), (0, "c1", None), (0, "t0", one[2][2])
    return spark.createDataFrame(one, "g int, chain string, v array<float>"), spark.createDataFrame(two, "g int, tab string, v array<float>")


def all_pairs(left, right):
    a, b = similarity.with_norm(left.withColumnRenamed("v", "a"), "a", "na"), similarity.with_norm(right.withColumnRenamed("v", "b"), "b", "nb")
    return similarity.block_pairs(a, b, ["g"], F.round((1 + similarity.cosine_by_norms("a", "b", "na", "nb")) / 2, 6)).select("g", "chain", "tab", "similarity")


def test_scores_of_a_matrix_are_those_of_pairs(spark):
    left, right = random_sides(spark, 40, 60)
    a, b = (vectors.side([r.v for r in df.collect()]) for df in (left, right))
    got = vectors.millionths(a, b)
    for r in all_pairs(left, right).collect():
        assert got[int(r.chain[1:]), int(r.tab[1:])] / 1_000_000 == r.similarity
    tie = vectors.millionths(vectors.side([np.array([1.0, 0.0])]), vectors.side([np.array([1.0, 0.0, 0.0]), np.array([0.0, 1.0]), None]))
    assert tie.tolist() == [[-1, 500_000, 500_000]]
    assert [vectors.least_millionths(x) for x in (0.5, 0.6, 0.61234567, 0.0)] == [500_000, 600_000, 612_346, 0]


def test_greedy_assignment_of_large_groups(spark):
    left, right = random_sides(spark, 90, 70)
    pairs = all_pairs(left, right)
    want = assign.assign_groups(pairs, "g", "chain", "tab", "similarity", 0.5, greedy=True)
    got = assign.assign_vectors(left, right, "g", "chain", "tab", "v", 0.5, greedy=True)
    assert sorted(got.collect()) == sorted(want.collect()) and got.dtypes == want.dtypes
    r = np.random.default_rng(2)
    a, b = (vectors.side(np.vstack([x, x])) for x in (r.normal(size=(150, 5)), r.normal(size=(80, 5))))  # with equal vectors
    scores = vectors.millionths(a, b)
    plain = assign.greedy_assignment(((int(scores[i, j]), i, j) for i in range(300) for j in range(160)), 550_000)
    assert assign.greedy_vectors(a, b, 550_000, top=3, step=7) == [(i, j, s) for i, j, s in plain]
    large = [spark.range(3_200).select(F.lit(1).alias("g"), F.concat(F.lit(x), "id").alias(n), F.array(F.sin("id"), F.cos(F.col("id") * 3), F.sin(F.col("id") * 7)).alias("v")) for x, n in (("c", "chain"), ("t", "tab"))]
    found = assign.assign_vectors(*large, "g", "chain", "tab", "v", 0.5, greedy=True)  # more than assign_groups takes
    assert {(r.chain[1:], r.similarity) for r in found.collect()} == {(str(i), 1.0) for i in range(3_200)}


def test_optimal_assignment_of_large_groups(spark):
    left, right = random_sides(spark, 30, 50)
    want = assign.assign_groups(all_pairs(left, right), "g", "chain", "tab", "similarity", 0.5)
    got = assign.assign_vectors(left, right, "g", "chain", "tab", "v", 0.5)
    assert round(sum(r.similarity for r in got.collect()), 6) == round(sum(r.similarity for r in want.collect()), 6) and got.dtypes == want.dtypes
    r = np.random.default_rng(3)
    for n, m, same in ((1, 1, 1), (3, 1, 1), (5, 9, 1), (60, 60, 1), (40, 90, 1), (12, 12, 6), (20, 60, 20)):
        a, b = (vectors.side(np.tile(r.normal(size=(-(-k // same), 4)), (same, 1))[:k]) for k in (n, m))
        cost = 1_000_000 - vectors.millionths(a, b)
        found = assign.best_vectors(a, b)
        assert sum(s for *_, s in found) == sum(1_000_000 - int(cost[i, j]) for i, j in assign.best_assignment(cost))
        assert len({i for i, _, _ in found}) == len({j for _, j, _ in found}) == min(n, m) and all(1_000_000 - cost[i, j] == s for i, j, s in found)
        assert found == assign.best_vectors(a, b, held=0)
    large = [spark.range(3_200).select(F.lit(1).alias("g"), F.concat(F.lit(x), "id").alias(n), F.array(F.sin("id"), F.cos(F.col("id") * 3), F.sin(F.col("id") * 7)).alias("v")) for x, n in (("c", "chain"), ("t", "tab"))]
    found = assign.assign_vectors(*large, "g", "chain", "tab", "v", 0.5).collect()  # more than assign_groups takes
    assert len(found) == 3_200 and all(r.similarity == 1 for r in found)


def test_many_to_many_shuffles_no_pairs(spark):
    left, right = random_sides(spark, 90, 70)
    pairs = all_pairs(left, right)
    both = similarity.many_to_many(similarity.splits(pairs, "chain", "tab", 0.8), similarity.conflicts(pairs, "chain", "tab", 0.8), "chain", "tab")
    want = both.select("chain", "shared", F.concat_ws(",", "tables").alias("tables"), F.concat_ws(",", "chains").alias("chains"), "confidence")
    got = similarity.many_to_many_vectors(left, right, "g", "chain", "tab", "v", 0.8, step=16)
    assert sorted(got.collect()) == sorted(want.collect()) and got.dtypes == want.dtypes and want.count() > 100
    assert "Join" not in got._jdf.queryExecution().toString() and similarity.many_to_many_vectors(left.limit(0), right, "g", "chain", "tab", "v", 0.8).count() == 0
