"""Chains of tables over years: rows of links, edges, coverage, reports, and the yearly matching machine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.assign import best_assignment


def edges(links: DataFrame, chain: str = "chain_id", order: str = "year", table: str = "table_id") -> DataFrame:
    """One edge from each table of a chain to the next."""
    w = Window.partitionBy(chain).orderBy(order)
    return links.select(chain, F.lag(table).over(w).alias("source"), F.col(table).alias("target"), order).filter("source is not null")


def graph_stats(links: DataFrame, chain: str = "chain_id", table: str = "table_id") -> DataFrame:
    """Nodes, edges, weak components (a chain is a path, so one each) and mean degree."""
    g = links.agg(F.count(table).alias("nodes"), F.countDistinct(chain).alias("components")).withColumn("edges", F.col("nodes") - F.col("components"))
    return g.select("nodes", "edges", "components", (2 * F.col("edges") / F.greatest(F.col("nodes"), F.lit(1))).alias("mean_degree"))


def coverage(links: DataFrame, chain: str = "chain_id", year: str = "year") -> DataFrame:
    """First and last year, years, years between that are missing, and completeness of the span."""
    c = links.groupBy(chain).agg(F.min(year).alias("first"), F.max(year).alias("last"), F.sort_array(F.collect_set(year)).alias("years"))
    return c.withColumn("gaps", F.array_except(F.sequence("first", "last"), "years")).withColumn("completeness", F.size("years") / (F.col("last") - F.col("first") + 1))


def transitions(links: DataFrame, first: int, last: int, max_gap: int = 3) -> DataFrame:
    """chain_id, year and state on a grid of years: active, dormant from the first missing year, ended after max_gap of them."""
    bounds = links.groupBy("chain_id").agg(F.min("year").alias("start"), F.collect_set("year").alias("years"))
    grid = bounds.select("chain_id", "years", F.explode(F.sequence("start", F.lit(last))).alias("year")).filter(F.col("year") >= first)
    w = Window.partitionBy("chain_id").orderBy("year").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = F.array_contains("years", F.col("year"))
    seen = F.max(F.when(here, F.col("year"))).over(w)
    gap = F.col("year") - seen
    state = F.when(gap == 0, "active").when(gap > max_gap, "ended").otherwise("dormant")
    return grid.select("chain_id", "year", state.alias("state"), (gap == 1).alias("turned_dormant"))


def status_counts(states: DataFrame) -> DataFrame:
    return states.groupBy("year").agg(*[F.count_if(F.col("state") == s).alias(s) for s in ("active", "dormant", "ended")])


def match_report(tables: DataFrame) -> DataFrame:
    """tables: year, chain_id, matched. Mean yearly match rate, and chain lengths in years."""
    yearly = tables.groupBy("year", "chain_id").agg(F.count("*").alias("n"), F.count_if("matched").alias("k"))
    rates = yearly.groupBy("year").agg((F.sum("k") / F.sum("n")).alias("rate")).agg(F.avg("rate").alias("r"))
    lengths = yearly.groupBy("chain_id").agg(F.count("*").alias("length")).agg(F.avg("length").alias("m"), F.max("length").alias("longest"), F.min("length").alias("shortest"))
    return rates.crossJoin(lengths).select(F.round("r", 6).alias("mean_rate"), F.round("m", 6).alias("mean_length"), "longest", "shortest")  # one row each


def zip_links(chains: DataFrame, *lists: str) -> DataFrame:
    """Parallel lists of a chain as rows with seq."""
    return chains.select("chain_id", F.posexplode(F.arrays_zip(*lists)).alias("seq", "x")).select("chain_id", "seq", "x.*")


def filter_years(chains: DataFrame, years: list[int], strict: bool = False) -> DataFrame:
    """Keep aligned positions of the wanted years in every list; links is array<struct<year, ...>>.

    A chain of which nothing is left is dropped; strict: it is an error when the row is read.
    """
    wanted = F.array(*[F.lit(y) for y in years])
    kept = chains.withColumn("links", F.filter("links", lambda x: F.array_contains(wanted, x["year"])))
    if not strict:
        return kept.filter(F.size("links") > 0)
    return kept.withColumn("links", F.when(F.size("links") > 0, F.col("links")).otherwise(F.raise_error(F.lit("a chain has none of the years")).cast(kept.schema["links"].dataType)))


@dataclass(frozen=True)
class MatchRules:
    threshold: float = 0.78
    accept: float = 0.97
    judged: float = 0.85
    max_gap: int = 3
    #: Keep two known faults of the original rules: tables assigned below the threshold vanish; chains never end.
    compatible: bool = False


def _default_judge(sim: float) -> bool:
    return sim >= 0.92


def _machine(rules: MatchRules, judge: Callable[[float], bool]):
    def run(tables: pd.DataFrame) -> pd.DataFrame:
        """Tables of one chapter through the years. A chain's vector is its last table's, so years depend on each other."""
        tables = tables.sort_values(["year", "table_id"])
        vectors = np.array(tables["embedding"].tolist(), float) if len(tables) else np.zeros((0, 1))
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        unit = vectors / np.where(norms > 0, norms, 1)
        tables = tables.assign(row=range(len(tables)))
        chains: list[dict] = []
        links = []

        def link(chain: dict, year: int, row: int, ident: str, sim: float, judged: bool) -> None:
            links.append((chain["id"], chain["n"], year, ident, sim, judged))
            chain.update(n=chain["n"] + 1, row=row, year=year, state="active")

        chapter = str(tables["chapter_id"].iloc[0]) if len(tables) else ""
        for year, now in tables.groupby("year", sort=True):
            rows, ids = now["row"].tolist(), now["table_id"].tolist()
            free = dict(zip(rows, ids, strict=True))
            active = [c for c in chains if c["state"] == "active"]
            similarity = lambda c, r: (1 + float(unit[c["row"]] @ unit[r])) / 2
            if active and rows:
                sims = np.array([[similarity(c, r) for r in rows] for c in active])
                for i, j in best_assignment(1 - sims):
                    s = sims[i, j]
                    if s < rules.threshold:
                        if rules.compatible:
                            free.pop(rows[j], None)
                        continue
                    sure = s >= rules.accept
                    if sure or (s >= rules.judged and judge(s)):
                        link(active[i], year, rows[j], free.pop(rows[j]), s, not sure)
            for c in chains:
                if c["state"] == "active" and c["year"] < year:
                    c["state"] = "dormant"
                if c["state"] == "dormant" and not rules.compatible and year - c["year"] > rules.max_gap:
                    c["state"] = "ended"
            for c in chains:  # first fit, chains outside
                if c["state"] != "dormant":
                    continue
                for r in list(free):
                    s = similarity(c, r)
                    if s >= rules.accept or (s >= rules.judged and judge(s)):
                        link(c, year, r, free.pop(r), s, s < rules.accept)
                        break
            for r, ident in free.items():
                c = {"id": f"chain_{chapter}_{ident}", "n": 0}
                chains.append(c)
                link(c, year, r, ident, 1.0, False)
        out = pd.DataFrame(links, columns=["chain_id", "seq", "year", "table_id", "similarity", "api_validated"])
        state = {c["id"]: c["state"] for c in chains}
        return out.assign(chapter_id=int(tables["chapter_id"].iloc[0]), status=out["chain_id"].map(state))[
            ["chapter_id", "chain_id", "seq", "year", "table_id", "similarity", "api_validated", "status"]
        ]

    return run


def build_chains(tables: DataFrame, rules: MatchRules = MatchRules(), judge: Callable[[float], bool] = _default_judge) -> DataFrame:
    """tables: chapter_id, year, table_id, embedding. Chapters run in parallel; the state inside one is its chains."""
    schema = "chapter_id int, chain_id string, seq int, year int, table_id string, similarity double, api_validated boolean, status string"
    return tables.select(F.col("chapter_id").cast("int"), F.col("year").cast("int"), F.col("table_id").cast("string"), "embedding").groupBy("chapter_id").applyInPandas(_machine(rules, judge), schema)
