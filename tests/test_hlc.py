import pytest
from pyspark.sql import functions as F

from tidelog.functions import hlc


def parsed(spark, text):
    return spark.range(1).select(hlc.parse(F.lit(text)).alias("c")).select("c.*").first()


@pytest.mark.parametrize("text", ["", ".", "1233", ".1233", "123.123", "-1.0000000000", "1.2.3", "9223372036854775808.0000000000", "1.2147483648"])
def test_malformed(spark, text):
    assert parsed(spark, text).nanos is None


@pytest.mark.parametrize("text, clock", [("0.0000000000", (0, 0)), ("1586019746136571000.0000000001", (1586019746136571000, 1)), ("9223372036854775807.2147483647", (2**63 - 1, 2**31 - 1)), ("1.0", (1, 0)), ("10.0", (10, 0))])
def test_well_formed(spark, text, clock):
    row = parsed(spark, text)
    assert (row.nanos, row.logical) == clock


def test_text_round_trips(spark):
    row = spark.sql("SELECT 1586019746136571000L AS n, 1 AS l").select(hlc.text(F.col("n"), F.col("l")).alias("t")).first()
    assert row.t == "1586019746136571000.0000000001"


def test_neighbours(spark):
    df = spark.createDataFrame([(1, 1), (2, 0)], "nanos long, logical int")
    out = df.select(hlc.before(F.col("nanos"), F.col("logical")).alias("b"), hlc.after(F.col("nanos"), F.col("logical")).alias("a")).collect()
    assert [tuple(r.b) for r in out] == [(1, 0), (1, 2147483647)]
    assert [tuple(r.a) for r in out] == [(1, 2), (2, 1)]


def test_range():
    r = hlc.Range.including((10, 0), (20, 0))
    assert [r.holds(c) for c in ((9, 0), (9, 2147483647), (10, 0), (15, 3), (20, 0), (20, 1))] == [False, False, True, True, True, False]
    assert hlc.Range((10, 0), (20, 1)).with_min((20, 1)).empty
    assert r.last == (20, 0)
    assert hlc.Range((1, 0), (1, 0)).extend((5, 2147483647)).high == (6, 0)


def test_resolved_name(spark):
    row = spark.range(1).select(hlc.resolved_name(F.lit("202004042351304139680000000000000")).alias("c")).select("c.*").first()
    assert (row.nanos, row.logical) == (1586044290413968000, 0)
