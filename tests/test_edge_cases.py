"""Empty and degenerate inputs: every operator returns zero rows, never fails."""

from pickwise.operators import priority, ranking, similarity, stats

RATING = "userId int, productId int, score double, timestamp bigint, seq bigint"


def test_empty_inputs(spark):
    r = spark.createDataFrame([], RATING)
    assert similarity.item_cf_edges(r).count() == 0
    v = spark.createDataFrame([], "productId int, features array<double>")
    assert similarity.cosine_all_pairs(v).count() == 0
    e = spark.createDataFrame([], "productId int, simProductId int, score double")
    assert priority.stream_priority(r, e).count() == 0
    assert stats.rate_more_products(r).count() == 0
    assert ranking.collect_recs_per_key(e).count() == 0
    d = spark.createDataFrame([], "productId int, text string")
    assert similarity.content_features(d).count() == 0


def test_single_item_and_single_user(spark):
    r = spark.createDataFrame([(1, 5, 4.0, 10, 1), (1, 5, 2.0, 11, 2)], RATING)
    assert similarity.item_cf_edges(r).count() == 0          # no pair without a second item
    e = spark.createDataFrame([(5, 6, 0.9)], "productId int, simProductId int, score double")
    # candidate 6 has no similar recent rating (edges only 5 -> 6), so no scored row
    assert priority.stream_priority(r, e).count() == 0
    table = priority.stream_recs_table(priority.stream_priority(r, e), r.select("userId")).collect()
    assert [(x["userId"], x["recs"]) for x in table] == [(1, [])]
