"""R2 R8 R11 helpers against Python models of the reference's rules, on many random inputs."""

import datetime as dt
import random

from pyspark.sql import functions as F

from roadflow.functions import columns as C


def pad1(s):  # one-argument padding: only one-character strings get a leading 0
    return "0" + s if len(s) == 1 else s


def label(ts):  # 5-minute range label, hour+1 on the same date when the range ends on the hour
    date, hour, minute = ts.strftime("%Y-%m-%d"), ts.strftime("%H"), ts.minute
    start = f"{date} {hour}:{pad1(str(minute - minute % 5))}"
    if minute + (5 - minute % 5) == 60:
        return f"{start}~{date} {pad1(str(int(hour) + 1))}:00"
    return f"{start}~{date} {hour}:{pad1(str(minute + (5 - minute % 5)))}"


def padn(n, s):
    return s if len(s) >= n else "0" * (n - len(s)) + s


def trim_comma(s):
    if s.startswith(","):
        s = s[1:]
    if s.endswith(","):
        s = s[:-1]
    return s


def test_five_minute_labels_model(spark):
    rnd = random.Random(3)
    base = dt.datetime(2018, 1, 1)
    times = [base + dt.timedelta(seconds=rnd.randint(0, 400 * 86400)) for _ in range(3000)]
    times += [dt.datetime(2018, 4, 26, h, m, 59) for h in (0, 9, 22, 23) for m in (0, 4, 5, 54, 55, 59)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    got = df.select("t", C.five_minute_label(C.five_minute_start("t").cast("timestamp_ntz")).alias("l")).collect()
    bad = [(r.t, r.l, label(r.t)) for r in got if r.l != label(r.t)]
    assert not bad, bad[:3]


def test_padding_and_comma_models(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("0123456789,") for _ in range(rnd.randint(0, 8))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select("s", C.fixed_width("s", 5).alias("w"), C.pad_single("s").alias("p"), C.trim_comma("s").alias("c")).collect()
    for r in got:
        assert (r.w, r.p, r.c) == (padn(5, r.s), pad1(r.s), trim_comma(r.s)), r.s
