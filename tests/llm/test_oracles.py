import duckdb
import pytest

from barloom.llm import entries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(entries.oracle_sql()))
def test_query_agrees_with_its_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        duck.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = duck.execute(entries.oracle_sql()[name])
    names = [x[0] for x in want.description]
    df = entries.queries()[name](spark, SF)
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(r[c] for c in names) for r in df.collect()) == sorted(want.fetchall())
