"""The registered queries over the smallest tables, against DuckDB where SQL can express them, and the pipeline."""

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from ledgerspark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    table = "pages" if name == "op8_warc" else "documents"
    if name not in ("op3_packing", "op11_collocations", "op13_spelling_variants"):
        assert len(rows) == spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name in ORACLES:
        con = duckdb.connect()
        for t in ("documents", "pages"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        cur = con.execute(ORACLES[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns)
        assert Counter(tuple(r[c] for c in names) for r in rows) == Counter(cur.fetchall())


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = {r["doc_id"]: r["text"] for r in docs.collect()}
    sizes = [docs.count()]
    for _, stage in C.STAGES[:-1]:
        from ledgerspark.llm.common import stored

        out = stored(stage(spark, docs, SF), "test")
        assert out.columns == docs.columns
        docs = out
        sizes.append(docs.count())
    assert sizes[1] >= sizes[2] >= sizes[3] > 0
    words = {i: len(t.split()) for i, t in given.items()}
    assert all(len(r["text"].split()) <= words[r["doc_id"]] for r in docs.collect())
    pieces = C.run(spark, SF).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in docs.collect()}
    assert len({r["sequence_id"] for r in pieces}) == len(pieces)
