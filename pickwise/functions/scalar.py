"""Built-in expressions for the scalar functions of the pipeline (F1-F16).

Every function returns a ``Column`` so Catalyst can fold, prune and codegen it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pickwise.schemas import RATING_PREFIX



def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts, ntz: bool = True) -> Column:
    """Whole epoch seconds of a timestamp, independent of the session zone.

    ``timestamp_ntz`` values (the test data) are read as UTC wall clock from
    their own fields (date, hour, minute, second), so no zone conversion and
    no DST shift can enter; pass ``ntz=False`` for ``timestamp`` instants."""
    c = _col(ts)
    if not ntz:
        return F.unix_seconds(c)
    days = F.unix_date(F.to_date(c)).cast("bigint")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def now_epoch() -> Column:
    """Epoch seconds of the query's start instant (F14); one value per query."""
    return F.unix_seconds(F.current_timestamp())


def normalise_epoch(ts) -> Column:
    """Epoch values >= 1e11 are milliseconds (server writes) -> seconds (Q1)."""
    c = _col(ts).cast("bigint")
    return F.when(c >= F.lit(100_000_000_000), F.floor(c / 1000)).otherwise(c).cast("bigint")


def epoch_to_yearmonth(ts) -> Column:
    """Epoch seconds -> ``yyyyMM`` as INT, in UTC."""
    d = F.date_from_unix_date(F.floor(_col(ts) / F.lit(86400)).cast("int"))
    return (F.year(d) * 100 + F.month(d)).cast("int")


def normalise_rating_score(raw) -> Column:
    """UI score 1..10 -> half, rounded HALF_UP to 2 digits."""
    return F.round(_col(raw).cast("double") / F.lit(2.0), 2)


def log10_count(n) -> Column:
    """log10(max(n, 1)) as in the priority formula."""
    return F.log10(F.greatest(_col(n), F.lit(1)).cast("double"))


def java_string_hash(s) -> Column:
    """Java ``String.hashCode`` as signed 32-bit INT.

    Folds h = 31*h + unit over the UTF-16 code units (surrogate pairs count
    as two units, as in Java), taken from the UTF-16BE encoding in hex."""
    c = _col(s)
    hx = F.hex(F.encode(c, "UTF-16BE"))
    n_units = (F.length(hx) / 4).cast("int")
    modulus = F.lit(4294967296)

    def step(acc, i):
        unit = F.conv(F.substring(hx, i * 4 + 1, 4), 16, 10).cast("bigint")
        return F.pmod(acc * 31 + unit, modulus)

    folded = F.aggregate(F.sequence(F.lit(0), n_units - 1), F.lit(0).cast("bigint"), step)
    unsigned = F.when(n_units == 0, F.lit(0).cast("bigint")).otherwise(folded)
    signed = F.when(unsigned >= F.lit(2147483648), unsigned - modulus).otherwise(unsigned)
    return F.when(c.isNull(), F.lit(None)).otherwise(signed).cast("int")


def rating_line(user_id, product_id, score, timestamp, prefix: str = RATING_PREFIX) -> Column:
    """``PREFIX:uid|pid|score|epochSec``."""
    body = F.concat_ws("|", _col(user_id).cast("string"), _col(product_id).cast("string"),
                       _col(score).cast("string"), _col(timestamp).cast("string"))
    return F.concat(F.lit(prefix + ":"), body)


def strip_rating_prefix(line, prefix: str = RATING_PREFIX) -> Column:
    """Drop everything up to and including the optional ``PREFIX:`` (Q8)."""
    return F.regexp_replace(_col(line), "^.*" + prefix + ":", "")


def cosine_expr(a, b, norm_a=None, norm_b=None) -> Column:
    """dot(a, b) / (|a| |b|) over two numeric arrays (F9); NaN when a norm is 0."""
    a, b = _col(a), _col(b)

    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")),
                           F.lit(0.0), lambda acc, v: acc + v)

    na = _col(norm_a) if norm_a is not None else F.sqrt(dot(a, a))
    nb = _col(norm_b) if norm_b is not None else F.sqrt(dot(b, b))
    den = na * nb
    return F.when(den > 0, dot(a, b) / den).otherwise(F.lit(float("nan")))


def to_document(*cols) -> Column:
    """Record -> JSON document (F16), keys in column order."""
    return F.to_json(F.struct(*[_col(c) for c in cols]))


def from_document(doc, schema) -> Column:
    """JSON document -> record with an explicit schema (F16); bad documents -> NULL fields."""
    return F.from_json(_col(doc), schema)
