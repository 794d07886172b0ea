"""Scalar helpers (R2 R5 R8 R9 R10 R11) on literal inputs."""

from pyspark.sql import functions as F

from roadflow.functions import columns as C
from roadflow.sources.text import parse_flow_lines, split_rejects


def one(spark, col):
    return spark.range(1).select(col.alias("x")).collect()[0].x


def test_five_minute_labels(spark):
    for t, want in [
        ("2018-04-26 10:05:00", "2018-04-26 10:05~2018-04-26 10:10"),
        ("2018-04-26 10:59:59", "2018-04-26 10:55~2018-04-26 11:00"),
        ("2018-04-26 23:57:00", "2018-04-26 23:55~2018-04-26 24:00"),
        ("2018-04-26 09:55:00", "2018-04-26 09:55~2018-04-26 10:00"),
    ]:
        start = C.five_minute_start(F.lit(t).cast("timestamp_ntz")).cast("timestamp_ntz")
        assert one(spark, C.five_minute_label(start)) == want


def test_fixed_width_and_pad(spark):
    assert one(spark, C.fixed_width(F.lit("7"), 5)) == "00007"
    assert one(spark, C.fixed_width(F.lit("123456"), 5)) == "123456"
    assert one(spark, C.pad_single(F.lit("7"))) == "07"
    assert one(spark, C.pad_single(F.lit("123"))) == "123"


def test_trim_comma(spark):
    assert one(spark, C.trim_comma(F.lit(",a,b,"))) == "a,b"
    assert one(spark, C.trim_comma(F.lit(","))) == ""


def test_kv_expand_and_update(spark):
    s = F.lit("a=1|b=|c=1=2|a=3")
    m = one(spark, C.kv_map(s))
    assert m == {"a": "3"}
    assert one(spark, C.kv_field(s, "a")) == "1"
    assert one(spark, C.kv_field(s, "b")) is None
    assert one(spark, C.kv_map(F.lit("x=1=|y=2"))) == {"x": "1", "y": "2"}
    assert one(spark, C.kv_set(s, "a", "9")) == "a=9|b=|c=1=2|a=3"
    assert one(spark, C.kv_set(F.lit("p=1,q=2"), "q", "5", delimiter=",")) == "p=1|q=5"
    assert one(spark, C.kv_set(F.lit("p=1|"), "z", "5")) == "p=1"


def test_java_trim(spark):
    assert one(spark, C.java_trim(F.lit(" \t0005\r"))) == "0005"
    assert one(spark, C.java_trim(F.lit("a b"))) == "a b"


def test_crlf_lines_parse(spark):
    lines = spark.createDataFrame([("2018-04-26\t0005\t26780\t深W61995\t2018-04-26 02:44:08\t154\t47\t02\r",)], "value string")
    good, bad = split_rejects(parse_flow_lines(lines))
    assert good.collect()[0].area_id == "02" and bad.count() == 0


def test_parse_and_reject(spark):
    """The line value itself is parsed (D11); bad lines go to the reject side."""
    lines = spark.createDataFrame(
        [
            ("2018-04-26\t0005\t26780\t深W61995\t2018-04-26 02:44:08\t154\t47\t02",),
            ("2018-04-26\t0005\t26780",),
            ("2018-04-26\t0005\t26780\t深W61995\t2018-04-26 02:44:08\tfast\t47\t02",),
            ("2018-04-26\t0005\t26780\t深W61995\tnot a time\t1\t47\t02",),
            ("2018-04-26\t0005\t26780\t \t2018-04-26 02:44:08\t1\t47\t02",),
        ],
        "value string",
    )
    good, bad = split_rejects(parse_flow_lines(lines))
    g = good.collect()
    assert len(g) == 1 and g[0].speed == 154 and g[0].plate == "深W61995" and str(g[0].action_time) == "2018-04-26 02:44:08"
    assert sorted(r.reject_reason for r in bad.collect()) == ["bad_speed", "bad_time", "empty_key", "short_line"]
