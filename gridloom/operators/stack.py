"""Stacking a chain's tables over years under an evolving set of columns."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.assign import greedy_assignment
from gridloom.operators.similarity import cosine, embed_distinct, name_similarity


def name_pairs(headers: DataFrame, model=None) -> DataFrame:
    """chain_id, old, new and similarity of all distinct names of a chain, which are few.

    model: text column -> vector column (an embedding UDF); names are then compared by the cosine of their vectors, each
    distinct name embedded once. Without it, by edit distance.
    """
    names = headers.select("chain_id", F.coalesce("name", F.lit("")).alias("name")).distinct()
    if model is not None:
        names = embed_distinct(names, "name", model)
    side = lambda ident, v: names.select("chain_id", F.col("name").alias(ident), *([F.col("embedding").alias(v)] if model is not None else []))
    vectors = cosine(F.col("a"), F.col("b")) if model is not None else None
    return side("old", "a").join(side("new", "b"), "chain_id").select("chain_id", "old", "new", name_similarity(F.col("old"), F.col("new"), vectors).alias("similarity"))


def evolve_schema(headers: DataFrame, high: float = 0.85, medium: float = 0.5, use_latest_name: bool = False, model=None) -> DataFrame:
    """headers: chain_id, year, col_index, name. Adds col_id, final_name and match (new, high or medium) to each.

    Years are taken in order: a year's names are matched one to one to the chain's columns, greedily by score; the rest
    become new columns. Matching uses a column's first name unless use_latest_name. Final names are the latest; two
    columns of one final name are told apart by __2 and so on. Scores come from `name_pairs`, computed before the groups.
    Only headers are grouped, never cells.
    """

    def run(pdf: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["year", "col_index"])
        score = dict(zip(zip(pairs["old"], pairs["new"], strict=True), pairs["similarity"], strict=True))
        columns: list[dict] = []
        rows = []
        for year, now in pdf.groupby("year", sort=True):
            names, places = now["name"].fillna("").tolist(), now["col_index"].tolist()
            key = "last" if use_latest_name else "first"
            scores = [(score[c[key], n], i, j) for i, c in enumerate(columns) for j, n in enumerate(names)]
            found = {j: (i, s) for i, j, s in greedy_assignment(scores, medium)}
            for j, (n, place) in enumerate(zip(names, places, strict=True)):
                if j in found:
                    i, s = found[j]
                    columns[i]["last"] = n
                    kind = "high" if s >= high else "medium"
                else:
                    i, kind = len(columns), "new"
                    ident = hashlib.md5(f"{pdf['chain_id'].iloc[0]}:{year}:{place}:{n}".encode()).hexdigest()[:12]
                    columns.append({"first": n, "last": n, "id": ident})
                rows.append((pdf["chain_id"].iloc[0], year, place, n, i, kind))
        seen: dict[str, int] = {}
        finals = []
        for c in columns:
            seen[c["last"]] = seen.get(c["last"], 0) + 1
            finals.append(c["last"] if seen[c["last"]] == 1 else f"{c['last']}__{seen[c['last']]}")
        out = [(a, b, c, n, columns[i]["id"], finals[i], k) for a, b, c, n, i, k in rows]
        return pd.DataFrame(out, columns=["chain_id", "year", "col_index", "name", "col_id", "final_name", "match"])

    kinds = dict(headers.dtypes)
    schema = f"chain_id {kinds['chain_id']}, year {kinds['year']}, col_index {kinds['col_index']}, name string, col_id string, final_name string, match string"
    rows = headers.select("chain_id", "year", "col_index", "name")
    return rows.groupBy("chain_id").cogroup(name_pairs(rows, model).withColumnRenamed("chain_id", "pair_chain").groupBy("pair_chain")).applyInPandas(run, schema)


def stack(cells: DataFrame, schema: DataFrame) -> DataFrame:
    """chain_id, meta_year, row_index, column_name and cell_value: every year's cells under the chain's final names.

    Stacking is a join on (chain, year, column); the long form needs no column alignment. A year without data rows keeps
    one row without values.
    """
    named = cells.join(schema.select("chain_id", "year", "col_index", F.col("final_name").alias("column_name")), ["chain_id", "year", "col_index"])
    named = named.select("chain_id", F.col("year").alias("meta_year"), "row_index", "column_name", "cell_value")
    years = schema.select("chain_id", F.col("year").alias("meta_year")).distinct()
    empty = years.join(named.select("chain_id", "meta_year").distinct(), ["chain_id", "meta_year"], "left_anti")
    lone = empty.select("chain_id", "meta_year", F.lit(0).cast(named.schema["row_index"].dataType).alias("row_index"), F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("string").alias("cell_value"))
    return named.unionByName(lone)


def stack_wide(tables: list[DataFrame]) -> DataFrame:
    """Wide yearly tables by column name, meta_year first; columns that a year lacks are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out.select("meta_year", *[c for c in out.columns if c != "meta_year"])


def name_history(schema: DataFrame) -> DataFrame:
    """First and last name of each column and the years that have it."""
    return schema.groupBy("chain_id", "col_id").agg(
        F.min_by("name", "year").alias("first_name"), F.max_by("name", "year").alias("last_name"), F.sort_array(F.collect_set("year")).alias("years")
    )
