import datetime
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry import functions as fn
from basketry.streaming.events import parsed_ratings, rating_messages, unparsed_messages


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def java_hash(text):
    units = text.encode("utf-16-be")
    h = 0
    for i in range(0, len(units), 2):
        h = (h * 31 + units[i] * 256 + units[i + 1]) % 2**32
    return h - 2**32 if h >= 2**31 else h


def test_java_string_hash(spark):
    generator = random.Random(1)
    names = ["", "hello", "a" * 50, "Customer#000000001", "中文名", "𝒳 y"]
    names += ["".join(chr(generator.randrange(32, 0xD000)) for _ in range(12)) for _ in range(40)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.select("n", fn.java_string_hash(F.col("n"))).collect()
    assert {r[0]: r[1] for r in got} == {n: java_hash(n) for n in names}
    assert java_hash("hello") == 99162322


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_year_month_does_not_use_the_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        last = int(datetime.datetime(2019, 4, 30, 23, 59, 59, tzinfo=datetime.timezone.utc).timestamp())
        assert one(spark, fn.year_month(F.lit(last))) == 201904
        assert one(spark, fn.year_month(F.lit(last + 1))) == 201905
        assert one(spark, fn.year_month(F.lit(last), "Asia/Shanghai")) == 201905
        assert one(spark, fn.year_month(F.lit(-1))) == 196912
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_epoch_seconds_takes_both_units(spark):
    assert one(spark, fn.epoch_seconds(F.lit(1556436808))) == 1556436808
    assert one(spark, fn.epoch_seconds(F.lit(1556436808999))) == 1556436808


def test_normalise_score(spark):
    got = [one(spark, fn.normalise_score(F.lit(x))) for x in (1, 9, 10, 7.77)]
    assert got == [0.5, 4.5, 5.0, 3.89]


def test_log_gain(spark):
    assert [one(spark, fn.log_gain(F.lit(n))) for n in (0, 1, 100)] == [0.0, 0.0, 2.0]


def test_entries_and_lists(spark):
    entry = fn.recent_entry(F.lit(3982), F.lit(4.5))
    assert one(spark, entry) == "3982:4.5"
    assert tuple(one(spark, fn.parse_recent_entry(F.lit(" 3982 : 4.5")))) == (3982, 4.5)
    assert tuple(one(spark, fn.parse_recent_entry(F.lit("x")))) == (None, None)
    assert one(spark, fn.split_list(F.lit("a| b 23||c3|"))) == ["a", "b 23", "c3"]


LINES = {
    "INFO x  :  PRODUCT_RATING_PREFIX:96354|57272|5.0|1556436808": (96354, 57272, 5.0, 1556436808),
    "PRODUCT_RATING_PREFIX: 1|2|3.5|4 \t": None,
    "no marker 1|2|3|4": None,
    "PRODUCT_RATING_PREFIX:1|2|3.0|4PRODUCT_RATING_PREFIX:5|6|1.0|8": (1, 2, 3.0, 4),
    "marker last PRODUCT_RATING_PREFIX:": None,
    "PRODUCT_RATING_PREFIX:1|2|3.0": None,
    "PRODUCT_RATING_PREFIX:1|two|3.0|4": None,
    "PRODUCT_RATING_PREFIX:1|2|3.0|4|extra": (1, 2, 3.0, 4),
    "PRODUCT_RATING_PREFIX:9999999999|2|3.0|4": None,
}


def test_log_lines(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    good = rows(parsed_ratings(rating_messages(lines)), "userId", "timestamp")
    bad = {r[0] for r in rows(unparsed_messages(lines))}
    marked = [x for x in LINES if "PRODUCT_RATING_PREFIX:" in x]
    # Spaces around fields are trimmed; a tab is not part of a number for Spark either way.
    expected = [v for v in LINES.values() if v]
    assert [g for g in good if g in expected] == sorted(expected)
    assert len(good) + len(bad) == len(marked)


def test_log_round_trip(spark):
    line = fn.log_line(F.lit(1), F.lit(2), F.lit(0.5), F.lit(1556436808))
    text = one(spark, line)
    assert text == "PRODUCT_RATING_PREFIX:1|2|0.5|1556436808"
    back = parsed_ratings(rating_messages(spark.createDataFrame([("p " + text,)], "value string")))
    assert rows(back) == [(1, 2, 0.5, 1556436808)]
