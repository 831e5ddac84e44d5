"""Plan-shape checks: the properties that matter at scale, read from the
physical plans of the registered queries (no execution)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

MODEL_KEYS = {"als_train", "item_factors", "als_predict_pairs", "user_recs", "offline_products", "als_product_recs",
              "als_grid_search", "best_params", "als_normal_equations", "als_factor_ranks", "als_predictions_are_products",
              "user_recs_are_lists", "als_product_recs_are_cosines", "grid_has_its_minimum"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(k for k in E.queries() if k not in MODEL_KEYS))
def test_no_cartesian_or_nested_loop(spark, key):
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scans_are_pruned(spark):
    plan = _plan(E.queries()["rate_more_products"](spark, SF_SMALL))
    # lineitem: only the join key and the rated product are read
    lineitem_scan = [ln for ln in plan.splitlines() if "lineitem" in ln and "FileScan" in ln]
    assert lineitem_scan, plan
    for ln in lineitem_scan:
        assert "l_extendedprice" not in ln and "l_comment" not in ln and "l_tax" not in ln


def test_filters_pushed_to_parquet(spark):
    from pyspark.sql import functions as F
    from pickwise.sources import fixtures as fx
    df = fx.table(spark, SF_SMALL, "events").filter(F.col("user_id") == 3).select("event_id")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,3)]" in plan


@pytest.mark.parametrize("key", ["recent_ratings_k", "top_k_per_user"])
def test_top_k_limits_before_shuffle(spark, key):
    """Top-k is a WindowGroupLimit; where an exchange feeds the window, a
    partial limit runs below it, so a hot key ships only k rows per map task."""
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan
    lines = plan.splitlines()
    final = next(i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln)
    below = lines[final + 1:final + 4]
    if any("Exchange" in ln for ln in below):
        assert any("WindowGroupLimit" in ln and "Partial" in ln for ln in lines[final + 1:])


def test_top_n_is_take_ordered(spark):
    plan = _plan(E.queries()["most_rated_products"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan


@pytest.mark.parametrize("key", ["top_k_candidates", "stream_priority"])
def test_candidates_are_cut_inside_the_row(spark, key):
    """No row per (user, neighbour): the top 20 are cut from the list in the projection of the join itself, so
    neither a window nor an exchange of candidates before the cut is in the plan."""
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    above = plan[:plan.index("array_except")]
    if key == "top_k_candidates":
        assert "Exchange hashpartitioning" not in above and "Window" not in plan
    assert "LeftAnti" not in plan


@pytest.mark.parametrize("key", ["hot_products", "most_rated_products"])
def test_facts_are_read_once(spark, key):
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    assert sum("FileScan" in ln and "lineitem" in ln for ln in plan.splitlines()) == (1 if "Initial Plan" not in plan else 2)


def test_a_line_is_split_once(spark):
    plan = _plan(E.queries()["valid_event_filter"](spark, SF_SMALL))
    assert plan.count("split(") == 1


@pytest.mark.parametrize("key", ["content_based_recs", "content_based_products"])
def test_content_lists_are_not_shuffled(spark, key):
    """The task that scores a product's pairs ranks its list: nothing between it and the result shuffles or sorts them."""
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    above = plan[:plan.index("MapInArrow")]
    assert "Exchange" not in above and "Window" not in plan and "Sort" not in above
