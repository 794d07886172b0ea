"""Canonical forms and lookups of whole texts, paragraphs and lines."""

import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from roadflow.llm import licenses

MIT, GPL = (next(t for n, t in licenses.KNOWN if n == name and len(t) > 200) for name in ("MIT", "GPL-3.0-or-later"))


def report(spark, texts, **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("kind", F.lit("clash")).withColumn("license", F.lit(1))
    return {r.doc_id: (r.text_license, r.n_lines, r.licenses) for r in licenses.license_report(docs, **more).collect()}


def test_equivalent_texts(spark):
    shouted = "Copyright (c) 2020 Somebody\nAll rights reserved.\n\n" + MIT.upper().replace(",", " ;").replace(". ", "!\n")
    got = report(spark, [MIT, shouted, MIT + " more", GPL.replace("License", "Licence").replace('"', "”"), "© 2001 X\n" + MIT, MIT.replace("free of charge", "for a charge")])
    assert [got[i][0] for i in range(6)] == ["MIT", "MIT", None, "GPL-3.0-or-later", "MIT", None]


def test_lines_and_paragraphs_inside_documents(spark):
    line = "Released under the MIT License."
    body = "some words\n\n" + GPL.split("\n\n")[0] + "\n\nother"
    got = report(spark, [f"text\n  {line.upper()}\r\nmore\n{line}", f"a\n\n{line}\n\nb", body, f"word {line}", "Licensed under the Apache Licence; version 2.0", None, "", "\n\n \n", "..."])
    assert got[0] == (None, 2, "MIT") and got[1] == (None, 1, "MIT")
    assert got[2] == (None, 0, "") and got[3] == (None, 0, "")  # part of a licence, and a line with more, are none
    assert got[4] == ("Apache-2.0", 1, "Apache-2.0")
    assert all(got[i] == (None, 0, "") for i in (5, 6, 7, 8))


def test_own_table_multi_line_paragraph_and_its_bound(spark):
    known = [("Own", "one\ntwo lines"), ("Empty", "..."), ("Later", "ONE two lines")]
    got = report(spark, ["x\n\none two\nlines\n\ny", "one two lines"], known=known)
    assert got[0] == (None, 0, "Later") or got[0] == (None, 0, "Own")
    assert got[1][1] == 1
    with pytest.raises(ValueError, match="known licences"):
        licenses.known_table(spark, [("x", "y")] * (licenses.MOST_KNOWN + 1))


def test_whole_files_runs_and_wrapped_lines(spark):
    full = {name: (Path(licenses.__file__).parent / "known" / f"{name}.txt").read_text() for name in ("Apache-2.0", "GPL-3.0-only", "LGPL-2.1-only", "MPL-2.0", "BSD-3-Clause")}
    isc = next(t for n, t in licenses.KNOWN if n == "ISC")
    holder = "Copyright (c) 2020 Somebody"
    wrapped = f"{holder}\n\n" + isc.replace("copyright notice", "\ncopyright notice")
    mit = f"MIT License\n\n{holder}\n\n{MIT}"
    inside = f"README\n\nsome words\n\n{mit}\n\nmore words"
    got = report(spark, [mit, wrapped, inside, *full.values(), MIT.replace("\n\n", "\n") + "\n\nend", "x\n\n" + MIT[:-1] + " and more", full["Apache-2.0"].replace("(c) You must", "(c) You need not")])
    assert got[0][0] == "MIT" and got[1][0] == "ISC" and got[2] == (None, 0, "MIT")
    assert [got[3 + i][0] for i in range(5)] == list(full)
    assert got[8] == (None, 0, "MIT") and got[9] == (None, 0, "") and got[10][0] is None


def test_repeated_rows_nulls_empty(spark):
    docs = spark.createDataFrame([(None, "Released under the MIT License.")] * 3, "doc_id long, text string")
    assert [tuple(r) for r in licenses.license_report(docs).collect()] == [(None, "MIT", 1, "MIT")] * 3
    assert licenses.license_report(docs.where("false")).count() == 0


def test_runs_against_all_runs():
    rng = random.Random(2)
    for _ in range(2000):
        paragraphs = ["".join(rng.choices("ab ", k=rng.randrange(1, 5))) for _ in range(rng.randrange(9))]
        known = {" ".join("".join(rng.choices("ab ", k=rng.randrange(1, 5))) for _ in range(rng.randrange(1, 4))) for _ in range(5)}
        head = min(map(len, known))
        sizes = {}
        for c in known:
            sizes.setdefault(c[:head], set()).add(len(c))
        got = {(i, c) for i, c in licenses.paragraph_runs(paragraphs, {h: sorted(n) for h, n in sizes.items()}) if c in known}
        n = len(paragraphs)
        want = {(i, c) for i in range(n) for j in range(i, n) if (c := " ".join(paragraphs[i : j + 1])) in known}
        assert got == want


def test_many_starts_take_time_in_proportion(spark):
    assert report(spark, [MIT + "\n\n" + MIT])[0] == (None, 0, "MIT")
    began = time.monotonic()
    got = report(spark, ["\n\n".join([MIT] * 4000)])
    assert got[0] == (None, 0, "MIT") and time.monotonic() - began < 30
