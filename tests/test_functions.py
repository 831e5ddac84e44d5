from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pickwise.functions import (epoch_to_yearmonth, java_string_hash, normalise_epoch, normalise_rating_score,
                                rating_line, strip_rating_prefix)


def java_hash(s: str) -> int:
    """Reference definition of String.hashCode over UTF-16 code units."""
    h = 0
    data = s.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (31 * h + int.from_bytes(data[i:i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def test_java_string_hash_known(spark):
    names = ["abc", "", "Customer#000000001", "héllo wörld", "日本語", "a\U0001F600b", "polygenelubricants"]
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "s string")
    got = {r["s"]: r["h"] for r in df.select("s", java_string_hash("s").alias("h")).collect()}
    assert got["abc"] == 96354
    assert got["polygenelubricants"] == -2147483648
    assert got[None] is None
    for n in names:
        assert got[n] == java_hash(n), n


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=20))
def test_java_string_hash_property(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "s string")
    for r in df.select("s", java_string_hash("s").alias("h")).collect():
        assert r["h"] == java_hash(r["s"])


def test_epoch_to_yearmonth(spark):
    df = spark.createDataFrame([(1500000000,), (0,), (1704067199,), (1704067200,)], "t bigint")
    got = [r[0] for r in df.select(epoch_to_yearmonth("t")).collect()]
    assert got == [201707, 197001, 202312, 202401]


def test_normalise_rating_score_half_up(spark):
    df = spark.createDataFrame([(x,) for x in [1.0, 5.0, 9.0, 10.0, 4.01, 4.03, 0.005]], "x double")
    got = [r[0] for r in df.select(normalise_rating_score("x")).collect()]
    assert got == [0.5, 2.5, 4.5, 5.0, 2.01, 2.02, 0.0]


def test_normalise_epoch(spark):
    df = spark.createDataFrame([(1500000000,), (1500000000123,)], "t bigint")
    assert [r[0] for r in df.select(normalise_epoch("t")).collect()] == [1500000000, 1500000000]


def test_rating_line_roundtrip(spark):
    df = spark.createDataFrame([(31, 77, 5.0, 1500000000)], "u int, p int, s double, t bigint")
    line = df.select(rating_line("u", "p", "s", "t").alias("v")).first()["v"]
    assert line == "PRODUCT_RATING_PREFIX:31|77|5.0|1500000000"
    logged = "2024-01-01 00:00:00,000  INFO --- [x]  Api(line: 146)  :  " + line
    ldf = spark.createDataFrame([(logged,)], "v string")
    assert ldf.select(strip_rating_prefix("v")).first()[0] == "31|77|5.0|1500000000"
    assert F is not None


def test_epoch_seconds_ignores_session_zone(spark):
    import datetime as dt
    from pickwise.functions import epoch_seconds
    rows = [(dt.datetime(2024, 7, 1, 12, 30, 5, 999999),), (dt.datetime(1970, 1, 1, 0, 0, 0),),
            (dt.datetime(1999, 12, 31, 23, 59, 59),)]
    want = [1719837005, 0, 946684799]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame(rows, "ts timestamp_ntz")
            assert [r[0] for r in df.select(epoch_seconds("ts")).collect()] == want, zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_now_epoch_and_default_registration_time(spark):
    import time
    from pickwise.functions import now_epoch
    from pickwise.plans import serving
    t = spark.range(1).select(now_epoch()).first()[0]
    assert abs(t - time.time()) < 120
    users = spark.createDataFrame([], "username string")
    row = serving.register_users(spark.createDataFrame([("zed",)], "username string"), users).first()
    assert abs(row["timestamp"] - time.time()) < 120
