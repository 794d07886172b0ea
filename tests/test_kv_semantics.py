"""Key=value helpers (R9 R10) against a small model of the reference's Java split rules, on random text.
Both the regex fast path ('|') and the general split path (a multi-character delimiter) are checked."""

import random
import re

from pyspark.sql import functions as F

from roadflow.functions import columns as C


def jsplit(s, regex):
    """Java String.split(regex): trailing empty strings removed; "" -> [""]."""
    if s == "":
        return [""]
    parts = re.split(regex, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def model(s, field, regex, value):
    pairs = [kv for kv in (jsplit(e, "=") for e in jsplit(s, regex)) if len(kv) == 2]
    m = {}
    for k, v in pairs:
        m[k] = v
    first = next((v for k, v in pairs if k == field), None)
    fields = jsplit(s, regex)
    for i, e in enumerate(fields):
        if (jsplit(e, "=") or [""])[0] == field:
            fields[i] = f"{field}={value}"
            break
    return m, first, "|".join(fields)


def _check(spark, texts, delim, regex):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    out = df.select(
        "s",
        C.kv_map("s", delim).alias("m"),
        C.kv_field("s", "a", delim).alias("f"),
        C.kv_set("s", "a", F.lit("Z$\\9"), delim).alias("u"),
    ).collect()
    for r in out:
        m, first, updated = model(r.s, "a", regex, "Z$\\9")
        assert (dict(r.m), r.f, r.u) == (m, first, updated), r.s


def test_random_texts_pipe(spark):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice("ab=|x") for _ in range(rnd.randint(0, 14))) for _ in range(1500)]
    texts = [t for t in texts if not any(e.strip("=") == "" and e != "" for e in t.split("|"))]  # '=' only entries throw in Java
    _check(spark, texts + ["a=1|b=|c=1=2|a=3", "|a=1", "a", "a=1=|a=2"], r"\|", r"\|")


def test_random_texts_multichar_delimiter(spark):
    rnd = random.Random(11)
    texts = ["".join(rnd.choice(["a", "b", "=", "::", "x"]) for _ in range(rnd.randint(0, 10))) for _ in range(1500)]
    texts = [t for t in texts if not any(e.strip("=") == "" and e != "" for e in t.split("::"))]
    _check(spark, texts, "::", "::")
