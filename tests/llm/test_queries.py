from __future__ import annotations

import pytest

from matchday.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_equals_sql(spark, duck, name):
    run, sql = QUERIES[name]
    wanted = duck.execute(sql)
    columns = [c[0] for c in wanted.description]
    found = run(spark, SMALL)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted(wanted.fetchall(), key=repr)


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "op11_trie"])
def test_one_row_for_each_of_the_table(spark, name):
    run, _ = QUERIES[name]
    table = {"op3": "embeddings", "op7": "pages"}.get(name.split("_")[0], "documents")
    key = {"embeddings": "vec_id", "pages": "page_id"}.get(table, "doc_id")
    found = [r[0] for r in run(spark, SMALL).select(key).collect()]
    assert sorted(found) == sorted(r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).collect())
