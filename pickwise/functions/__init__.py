"""Scalar column expressions (all built-in Spark functions, no Python UDFs)."""

from pickwise.functions.scalar import (  # noqa: F401
    cosine_expr,
    epoch_seconds,
    epoch_to_yearmonth,
    from_document,
    java_string_hash,
    log10_count,
    normalise_epoch,
    now_epoch,
    normalise_rating_score,
    rating_line,
    strip_rating_prefix,
    to_document,
)
