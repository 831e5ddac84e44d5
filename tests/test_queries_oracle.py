"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01); model keys get a non-empty rows check."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
SLOW = {"als_grid_search", "best_params", "grid_has_its_minimum"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return repr(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_oracle_key_is_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(k for k in E.queries() if k not in SLOW))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert len(rows) > 0
        return
    rel = duck.sql(sql)
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, rel.columns)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["userId", "productId"]


def test_oracle_term_hash_equals_hashing_tf(spark):
    """The oracle's SQL term hash puts every term in HashingTF's bucket: all
    tail lengths, multi-byte and 4-byte UTF-8 characters."""
    import pandas as pd
    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    from pickwise.plans.oracle import HASHED
    terms = ["a", "ab", "abc", "abcd", "abcde", "abcdef", "abcdefg", "abcdefgh", "abcdefghi",
             "héllo", "naïve", "日本語", "straße", "emoji😀x", "1998-01-02", "x|y^z"]
    con = duckdb.connect()
    con.register("docs_pdf", pd.DataFrame({"doc_id": range(len(terms)), "text": terms}))
    con.execute("CREATE VIEW documents AS SELECT * FROM docs_pdf")
    got = dict(con.sql("WITH " + HASHED + " SELECT term, bucket FROM tbucket").fetchall())
    sdf = spark.createDataFrame([(t,) for t in terms], "term string").select("term", F.array("term").alias("w"))
    vec = HashingTF(inputCol="w", outputCol="v", numFeatures=200).transform(sdf)
    want = {r["term"]: r["a"].index(1.0) for r in vec.select("term", vector_to_array("v").alias("a")).collect()}
    assert got == want
