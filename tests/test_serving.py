"""Hand cases for the serving compositions."""

import pytest

from pickwise.plans import serving

RATING = "userId int, productId int, score double, timestamp bigint"
PRODUCT = "productId int, name string, imageUrl string, categories string, tags string"
JAN, FEB, MAR = 1706745600 - 86400 * 20, 1706745600 + 86400, 1709251200 + 86400   # 2024-01-12, 02-02, 03-02


@pytest.fixture()
def products(spark):
    return spark.createDataFrame([(1, "red ring", "", "c", "t"), (2, "Ring box", "", "c", "t"),
                                  (3, "blue bolt", "", "c", "t"), (4, "spring", "", "c", "t")], PRODUCT)


def test_hot_products_limit_before_dedup(spark, products):
    rows = ([(u, 1, 5.0, MAR) for u in range(3)] + [(u, 2, 1.0, MAR) for u in range(2)]
            + [(u, 1, 3.0, FEB) for u in range(4)] + [(u, 3, 4.0, JAN) for u in range(9)])
    r = spark.createDataFrame(rows, RATING)
    got = [(x["rank"], x["productId"], x["score"]) for x in
           serving.hot_products(r, products, n=3).orderBy("rank").collect()]
    # (month, product) rows: (03,1) (03,2) (02,1) ... -> limit 3 -> products 1 (rank 1), 2 (rank 2)
    assert [(a, b) for a, b, _ in got] == [(1, 1), (2, 2)]
    assert got[0][2] == pytest.approx((3 * 5.0 + 4 * 3.0) / 7)


def test_most_rated_ties_by_id(spark, products):
    r = spark.createDataFrame([(0, 3, 1.0, JAN), (1, 3, 1.0, JAN), (0, 2, 2.0, JAN), (1, 2, 2.0, JAN),
                               (0, 1, 4.0, JAN)], RATING)
    got = [(x["rank"], x["productId"]) for x in serving.most_rated_products(r, products, n=2).orderBy("rank").collect()]
    assert got == [(1, 2), (2, 3)]


def test_product_info_missing_is_null(spark, products):
    r = spark.createDataFrame([(0, 1, 4.0, JAN)], RATING)
    keys = spark.createDataFrame([(1,), (3,), (999,)], "productId int")
    got = {x["productId"]: x for x in serving.product_info(keys, products, r).collect()}
    assert got[1]["score"] == 4.0 and got[3]["score"] == 0.0
    assert got[999]["name"] is None and got[999]["score"] is None


def test_search_is_unanchored_and_case_sensitive(spark, products):
    r = spark.createDataFrame([(0, 4, 2.0, JAN)], RATING)
    got = {x["productId"]: x["score"] for x in serving.search_products_by_name(products, r, "ring").collect()}
    assert got == {1: 0.0, 4: 2.0}


def test_register_users_and_rate_products(spark):
    users = spark.createDataFrame([(7, "alice")], "userId int, username string")
    req = spark.createDataFrame([("alice",), ("bob",), ("bob",)], "username string")
    new = serving.register_users(req, users, 1700000000).collect()
    assert [(x["username"], x["userId"], x["first"]) for x in new] == [("bob", 97717, True)]
    rates = spark.createDataFrame([("alice", 5, 7.0, 100), ("nobody", 5, 9.0, 101), ("alice", 6, 5.0, 102)],
                                  "username string, productId int, rawScore double, timestamp bigint")
    got = sorted((x["productId"], x["score"], x["value"]) for x in serving.rate_products(rates, users).collect())
    assert got == [(5, 3.5, "PRODUCT_RATING_PREFIX:7|5|3.5|100"), (6, 2.5, "PRODUCT_RATING_PREFIX:7|6|2.5|102")]


def test_unknown_ids_vanish_and_unknown_users_are_empty(spark, products):
    from pickwise.operators import joins
    r = spark.createDataFrame([(0, 1, 4.0, JAN)], RATING)
    recs = spark.createDataFrame([(1, 1), (2, 999), (3, 3)], "rank int, productId int")
    got = sorted((x["rank"], x["productId"]) for x in joins.recs_to_products(recs, products).collect())
    assert got == [(1, 1), (3, 3)]                                   # J6: the unknown id vanishes
    users = spark.createDataFrame([(7, "alice"), (8, "carol")], "userId int, username string")
    table = spark.createDataFrame([(7, [(1, 0.9), (3, 0.5), (2, 0.1)])],
                                  "userId int, recs array<struct<productId:int,score:double>>")
    asked = spark.createDataFrame([("alice",), ("bob",), ("carol",)], "username string")
    out = serving.user_recs_to_products(asked, users, table, products, r)
    assert sorted((x["username"], x["rank"], x["productId"]) for x in out.collect()) == [
        ("alice", 1, 1), ("alice", 2, 3), ("alice", 3, 2)]             # bob unknown, carol empty: no rows
    top2 = serving.user_recs_to_products(asked, users, table, products, r, k=2)
    assert sorted(x["productId"] for x in top2.collect()) == [1, 3]
    nested = {x["username"]: x["recs"] for x in joins.recs_for_username(asked, users, table).collect()}
    assert nested["carol"] == [] and "bob" not in nested
