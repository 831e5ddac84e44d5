"""Hand cases for the online priority (SP)."""

import math

import pytest

from pickwise.operators import priority, ranking

RATING = "userId int, productId int, score double, timestamp bigint, seq bigint"
EDGE = "productId int, simProductId int, score double"


@pytest.fixture()
def case(spark):
    rows = [
        # user 1: two low ratings of p10 (a repeat), one of p11, current event p12 (high)
        (1, 10, 2.0, 1, 1), (1, 11, 1.0, 2, 2), (1, 10, 2.0, 3, 3), (1, 12, 4.0, 4, 4),
        # user 2: current event on a product absent from the matrix
        (2, 99, 5.0, 1, 5),
        # user 3: 22 ratings; only the oldest (22nd newest) one is similar to p30's neighbour
        (3, 30, 5.0, 1, 6),
    ] + [(3, 31, 1.0, 1 + i, 6 + i) for i in range(1, 22)]
    ratings = spark.createDataFrame(rows, RATING)
    edges = spark.createDataFrame([
        (12, 20, 0.9), (12, 21, 0.8), (20, 10, 0.5), (20, 11, 0.6), (21, 12, 0.7),
        (31, 40, 0.9), (40, 30, 0.9), (40, 31, 0.5),
        (12, 22, 0.45), (22, 10, 0.4000000001),
    ], EDGE)
    return ratings, edges


def test_priority_values(spark, case):
    ratings, edges = case
    got = {(r["userId"], r["productId"]): r for r in priority.stream_priority(ratings, edges).collect()}
    # candidate 20: hits p10 twice (0.5 x 2.0) and p11 (0.6 x 1.0): only low recents
    r = got[(1, 20)]
    assert (r["nHigh"], r["nLow"]) == (0, 3)
    assert abs(r["priority"] - ((1.0 + 1.0 + 0.6) / 3 - math.log10(3))) < 1e-12
    # candidate 21: a single high recent -> log10(1) = 0
    r = got[(1, 21)]
    assert (r["nHigh"], r["nLow"]) == (1, 0)
    assert abs(r["priority"] - 0.7 * 4.0) < 1e-12
    # candidate 22 only meets p10 at a similarity just above 0.4
    assert got[(1, 22)]["nLow"] == 2
    # user 2 has no candidates; user 3: the 22nd newest rating does not count
    assert not any(k[0] == 2 for k in got)
    r = got[(3, 40)]
    assert (r["nHigh"], r["nLow"]) == (0, 21)
    assert abs(r["priority"] - (0.5 - math.log10(21))) < 1e-12


def test_table_form_keeps_empty_lists(spark, case):
    ratings, edges = case
    prio = priority.stream_priority(ratings, edges)
    table = {r["userId"]: r["recs"] for r in priority.stream_recs_table(prio, ratings.select("userId")).collect()}
    assert table[2] == []
    assert [e["productId"] for e in table[1]] == [21, 22, 20]
    scores = [e["score"] for e in table[1]]
    assert scores == sorted(scores, reverse=True)


def test_rated_products_never_candidates(spark, case):
    ratings, edges = case
    extra = spark.createDataFrame([(1, 21, 3.0, 0, 0)], RATING)     # user 1 rated p21 long ago
    got = {(r["userId"], r["productId"]) for r in priority.stream_priority(ratings.unionByName(extra), edges)
           .collect()}
    assert (1, 21) not in got and (1, 20) in got


def test_candidate_cap_and_ties(spark):
    ratings = spark.createDataFrame([(1, 0, 4.0, 1, 1)], RATING)
    edges = spark.createDataFrame([(0, q, 0.9 if q % 2 else 0.8) for q in range(1, 31)]
                                  + [(q, 0, 0.5) for q in range(1, 31)], EDGE)
    cur = priority.current_events(ratings)
    cand = priority.top_k_candidates(cur, edges, ratings.select("userId", "productId"))
    ids = [r["productId"] for r in cand.orderBy("candRank").collect()]
    assert ids == list(range(1, 31, 2)) + [2, 4, 6, 8, 10]


def test_latest_event_and_upsert(spark):
    df = spark.createDataFrame([(1, 5, 1.0, 10, 1), (1, 5, 3.0, 10, 2), (1, 6, 2.0, 9, 3)], RATING)
    cur = priority.current_events(df).first()
    assert (cur["productId"], cur["score"], cur["seq"]) == (5, 3.0, 2)
    up = {r["productId"]: (r["score"], r["timestamp"]) for r in ranking.latest_rating_upsert(df).collect()}
    assert up == {5: (3.0, 10), 6: (2.0, 9)}
