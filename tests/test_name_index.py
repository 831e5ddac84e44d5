"""Name search through the trigram index equals a scan, whatever the pattern."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pickwise.plans import name_index
from pickwise.sources.versions import versions

NAMES = ["Ring", "ring of gold", "gold", "go", "", "colour", "color", "a.b+c", "abde", "abbbde", "x]y", "灯光灯", "ab|cd", None]
PATTERNS = ["ring", "[Rr]ing", "gold|colou?r", "^go", "a\\.b\\+c", "ab*de", "ab+de", "(gol)?d", "灯光灯", "b\\|c", "", "x\\]y"]


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(NAMES)], "productId int, name string")
    root = str(tmp_path_factory.mktemp("names"))
    name_index.publish_name_index(spark, root, df)
    return root


@pytest.mark.parametrize("pattern", PATTERNS)
def test_same_rows_as_a_scan(spark, root, pattern):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, n) for i, n in enumerate(NAMES)], "productId int, name string")
    want = sorted(r["productId"] for r in df.where(F.col("name").rlike(pattern)).collect())
    assert sorted(r["productId"] for r in name_index.search(spark, root, pattern).collect()) == want


def test_plan_reads_postings_not_names(spark, root):
    found = name_index.search(spark, root, "gold")
    files = found.inputFiles()
    assert any("name_grams" in f for f in files)
    grams = [f for f in files if "name_grams" in f]
    assert len({f.split("bucket=")[1].split("/")[0] for f in grams}) <= 64 and len(versions(spark, f"{root}/name_grams")) == 1
    assert name_index.literal_grams("gold") == [{"gol", "old"}] and name_index.literal_grams("g.l") is None


CHARS = st.sampled_from("abc.[]()|?*+{}^$\\1,")


@settings(max_examples=400, deadline=None)
@given(st.text(CHARS, max_size=10), st.lists(st.text(st.sampled_from("abc.[]|1,"), max_size=12), max_size=8))
def test_grams_are_necessary(pattern, names):
    """No name that matches lacks the grams of every alternative."""
    import warnings
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        try:
            compiled = re.compile(pattern)
        except re.error:
            return
    alternatives = name_index.literal_grams(pattern)
    for n in names:
        if alternatives is not None and compiled.search(n):
            assert any(all(g in n for g in grams) for grams in alternatives), (pattern, n)
