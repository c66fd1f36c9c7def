import os

import duckdb
import pytest

from gridloom.llm import queries

TABLES = ("documents", "pages", "labels")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, tiny, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(tiny, t)}.parquet')")
    found = db.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    df = queries.QUERIES[name](spark, tiny)
    assert sorted(df.columns) == sorted(names)
    plain = lambda rows: sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in rows)
    assert plain(df.select(*names).collect()) == plain(found.fetchall())
