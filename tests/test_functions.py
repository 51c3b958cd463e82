import hashlib
import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyloom import functions as fn
from tallyloom.functions.labels import LIKE_REST, VIDEO_SECOND_REST


def evaluate(spark, values, ddl, expr):
    """Values of an expression over a one-column frame, in input order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {ddl}")
    return [r.out for r in df.select("i", expr.alias("out")).orderBy("i").collect()]


def test_extract_field(spark):
    blocks = [
        "Date: 2024-01-01 \nTitle:  spaced out\t\r",
        "Title: a b\nTitle: second",
        "Title:    \nDate: x",
        "no label",
        None,
    ]
    got = evaluate(spark, blocks, "string", fn.extract_field("v", "Title"))
    assert got == ["spaced out", "a b", "", None, None]
    labels = evaluate(spark, ["Like(s): 12"], "string", fn.extract_field("v", "Like(s)"))
    assert labels == ["12"]


def test_strip_matches_python(spark):
    texts = [c + "x y" + c for c in map(chr, range(0x3001)) if c.isspace()] + ["\n \t", "a", ""]
    assert evaluate(spark, texts, "string", fn.strip("v")) == [t.strip() for t in texts]


def test_null_handling(spark):
    texts = ["N/A", "", " x ", None, "  "]
    assert evaluate(spark, texts, "string", fn.null_sentinels("v", ["N/A", ""])) == [
        None, None, " x ", None, "  ",
    ]
    assert evaluate(spark, texts, "string", fn.trim_blank("v")) == ["N/A", None, "x", None, None]
    assert evaluate(spark, ["HD", None], "string", fn.lower_norm("v", "None")) == ["hd", "none"]


def test_clean_number(spark):
    texts = ["1,234", "N/A", "7", None, "1,234,567"]
    assert evaluate(spark, texts, "string", fn.clean_number("v")) == [1234, None, 7, None, 1234567]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        evaluate(spark, ["1,234"], "string", fn.to_bigint("v"))
    assert evaluate(spark, ["1,234"], "string", fn.to_bigint("v", "null")) == [None]


def test_coerce_int(spark):
    texts = ["5", "5.9", "-5.9", "x", "", None, "1e3", " 8 ", "5d", "1,000", "NaN", ".5"]
    assert evaluate(spark, texts, "string", fn.coerce_int("v")) == [
        5, 5, -5, 0, 0, 0, 1000, 8, 0, 0, 0, 0,
    ]


def test_iso_duration(spark):
    cases = {
        "PT12M34S": 754, "P1DT2H": 93600, "P1D": None, "": None, None: None, "PT": 0,
        "PT1H": 3600, "PT59S": 59, "P2DT1S": 172801, "xPT5M": None, "PT5Mtail": 300,
        "P1DT2H3M4S": 93784,
    }
    got = evaluate(spark, list(cases), "string", fn.parse_iso_duration("v"))
    assert got == list(cases.values())


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", None), ("", "b|c")], "x string, y string")
    got = [r[0] for r in df.select(fn.surrogate_key("x", "y")).collect()]
    assert got == [hashlib.md5(t.encode()).hexdigest() for t in ("a|", "|b|c")]


def test_json_texts(spark):
    texts = [
        "{'like': 3, 'love': None}", '{"like": 3, "love": 4}', "{}", "5", "broken {", None,
        "{'like': {'a': 1}, 'love': 2}",
    ]
    parsed = fn.json_texts("v", ["like", "love"])
    got = evaluate(spark, texts, "string", F.array(parsed["like"], parsed["love"]))
    assert got == [
        ["3", None], ["3", "4"], [None, None], [None, None], [None, None], [None, None],
        [None, "2"],
    ]


def test_regexp_helpers(spark):
    texts = ["[2024-01-01 x] [2024-01-02 y]", "none", None]
    assert evaluate(spark, texts, "string", fn.count_matches("v", r"\[\d{4}")) == [2, 0, 0]
    assert evaluate(spark, texts, "string", fn.regexp_or_null("v", r"(\d+)")) == [
        "2024", None, None,
    ]


def test_year_week_for_sixteen_years(spark):
    days = [date(2015, 1, 1) + timedelta(n) for n in range(5844)]
    assert evaluate(spark, days, "date", fn.year_week("v")) == [d.strftime("%Y-%W") for d in days]
    assert evaluate(spark, days, "date", fn.iso_day_num("v")) == [d.isoweekday() for d in days]
    assert evaluate(spark, days, "date", fn.day_name("v")) == [d.strftime("%A") for d in days]
    assert evaluate(spark, days, "date", fn.sunday_day_num("v")) == [
        d.isoweekday() % 7 + 1 for d in days
    ]


def test_utc_timestamp(spark):
    got = evaluate(
        spark, ["2024-01-01 10:00:00 UTC", "2024-01-01 10:00:00", None], "string",
        F.date_format(fn.utc_timestamp("v"), "yyyy-MM-dd HH:mm"),
    )
    assert got == ["2024-01-01 10:00", "2024-01-01 10:00", None]


def test_buckets(spark):
    likes = [0, 50, 51, 100, 101, 200, 201, 500, 501, 1000, 1001, 5000, 5001, -1, None]
    assert evaluate(spark, likes, "long", fn.bucket_likes("v")) == [
        "0-50", "0-50", "51-100", "51-100", "101-200", "101-200", "201-500", "201-500",
        "501-1000", "501-1000", "1001-5000", "1001-5000", LIKE_REST, LIKE_REST, "unknown",
    ]
    minutes = [0, 29, 30, 89, 90, None]
    assert evaluate(spark, minutes, "long", fn.bucket_live_duration("v")) == [
        "Short", "Short", "Medium", "Medium", "Long", "Long",
    ]
    seconds = [None, 179, 180, 1799, 1800, 3599, 3600]
    got = evaluate(spark, seconds, "long", fn.bucket_video_duration("v"))
    assert got[0] == "Unknown" and got[-1] == VIDEO_SECOND_REST
    assert got[1][:7] == "YouTube" and got[2] == got[3] and got[4] == got[5] and got[3] != got[4]
    assert "–" in got[4]


def test_categories(spark):
    rules = [("a", ["one", "two"]), ("b", ["TWO", "three"])]
    texts = ["has ONE", "Two three", "three", "four", None]
    assert evaluate(spark, texts, "string", fn.classify_keywords("v", rules, "rest")) == [
        "a", "a", "b", "rest", "rest",
    ]
    mapping = {"x": ["p", "q"], "y": ["r"]}
    assert evaluate(spark, ["p", "r", "s", None], "string", fn.map_category("v", mapping, "o")) == [
        "x", "y", "o", "o",
    ]


def test_event_flags_keep_null(spark):
    flags = fn.event_flags("v", ["like"])[0]
    assert evaluate(spark, ["like", "gift", None], "string", flags) == [True, False, None]


def test_ratios(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (5, 0), (None, 2)], "a long, b long")
    got = [r[0] for r in df.select(fn.ratio_pct("a", "b", 2)).collect()]
    assert got == [33.33, None, None, None]
    assert [r[0] for r in df.select(fn.ratio_pct("a", "b", 2, scale=1)).collect()][0] == 0.33


def test_exact_avg_is_order_free(spark):
    values = [0.1 * n for n in range(1000)]
    one = spark.createDataFrame([(round(v, 2),) for v in values], "v double").coalesce(1)
    many = one.repartition(7)
    a = one.agg(fn.exact_avg("v", 2)).first()[0]
    assert a == many.agg(fn.exact_avg("v", 2)).first()[0]
    assert math.isclose(a, sum(round(v, 2) for v in values) / 1000)
    assert one.where("v < 0").agg(fn.exact_avg("v", 2)).first()[0] is None


def test_gift_value(spark):
    df = spark.createDataFrame([(5, 3), (None, 3), (5, None)], "d long, r long")
    assert [r[0] for r in df.select(fn.gift_value("d", "r")).collect()] == [15, 0, 5]
