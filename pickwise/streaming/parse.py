"""Rating event parsing (P1, P2) — identical in batch and in micro-batches.

A line is split once: the typed fields come out of one generator, so that neither the filter nor
any field repeats the prefix search and the split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.functions import normalise_epoch, strip_rating_prefix

FIELDS = ("userId", "productId", "score", "timestamp")


def typed_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Every line with the typed ``FIELDS`` (null where a number is bad or missing), ``fifth`` (the optional
    fifth field as a long), ``n_fields`` and ``valid`` (four fields or more, all numbers, the score no NaN)."""
    def fields(a: Column) -> Column:
        def field(i: int, t: str) -> Column:
            return F.trim(F.get(a, F.lit(i))).try_cast(t)

        user, product, score, when = field(0, "int"), field(1, "int"), field(2, "double"), field(3, "bigint")
        valid = (F.size(a) >= 4) & user.isNotNull() & product.isNotNull() & score.isNotNull() & ~F.isnan(score) & when.isNotNull()
        return F.struct(user.alias("userId"), product.alias("productId"), score.alias("score"),
                        normalise_epoch(when).alias("timestamp"), field(4, "bigint").alias("fifth"),
                        F.size(a).alias("n_fields"), F.coalesce(valid, F.lit(False)).alias("valid"))

    attr = F.split(strip_rating_prefix(F.col(col).cast("string")), r"\|")
    return lines.select("*", F.inline(F.transform(F.array(attr), fields)))


def parse_rating_events(lines: DataFrame, col: str = "value") -> DataFrame:
    """P1 + P2: strip the optional log prefix, split on '|', keep lines with at
    least 4 fields (extras tolerated) and cast them; a bad number becomes NULL
    (``try_cast``, Q9) instead of failing the batch; millisecond epochs are
    brought to seconds (Q1). Other columns (e.g. an
    arrival ``seq``) are carried."""
    keep = [c for c in lines.columns if c != col]
    return typed_lines(lines, col).where("n_fields >= 4").select(*keep, *FIELDS)


def valid_rating_events(parsed: DataFrame) -> DataFrame:
    """Rows whose four fields all parsed to numbers (a NaN score is none): the exact
    complement of ``rejected_rating_lines``."""
    ok = ~F.isnan("score")
    for c in FIELDS:
        ok = ok & F.col(c).isNotNull()
    return parsed.where(ok)


def rejected_rating_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines that do not give a full rating: too few fields or a bad number (NaN included)."""
    return typed_lines(lines, col).where("not valid").select(*lines.columns)
