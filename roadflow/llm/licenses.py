"""License scans by canonical digest.

A text and a known licence are the same when their canonical forms are: lower case, lines that state a
copyright left out, equivalent spellings made one, anything but letters and digits one space. Canonical forms
are compared whole, by their SHA-256, in a hash join with the table of known licences. Looked up are each
document's whole text, its paragraphs (stretches between blank lines) and its lines, each as an entire text.

The known table is a parameter; it is a small list (``MOST_KNOWN`` entries at most, checked) and is sent to
the tasks, so that documents are read once and only hits are shuffled.

Also looked up are runs of a document's paragraphs, however the known text is cut into paragraphs: from each
paragraph that begins as a known licence does, as far as one is long, if a paragraph ends there.

Defined results: a null text has no units; a unit whose canonical form is empty is no licence; of two known
entries with one canonical form the first by name counts; repeated rows are scanned alike; an empty table gives no
rows; a very long text takes time in proportion to its length; columns of other names are not read.
"""

from __future__ import annotations

from functools import reduce
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadflow.llm.common import row_key, text_or_empty

MOST_KNOWN = 10_000
#: First code points of a known text that a run of paragraphs must begin with to be looked at.
HEAD = 16

#: Spellings that license guidelines call equivalent, as (pattern, spelling).
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("acknowledgement", "acknowledgment"),
    ("merchantability", "merchantability"),
    ("non commercial", "noncommercial"),
    ("v([0-9])", "version $1"),
)
#: A statement of copyright: with a year, a sign or a holder. Prose that a line break cut before "copyright
#: notice", and list items "(c) You must", are none.
_PROSE = r"(?:notices?|holders?|owners?|laws?|licen[cs]es?|statements?|status|interests?|protection|disclaimers?|treat(?:y|ies)|rights?|permissions?|permitted|is|are|was|as|and|or|of|in|on|to|for|that|which|this|may|shall|doctrines?)\b"
COPYRIGHT = rf"^\s*(?:copyright\b(?!\s*[.,;:/)]*\s*(?:$|{_PROSE}))|\(c\)\s*(?:copyright\b|©|[0-9]{{4}}|<year>)|©|all rights reserved)"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""

_ZERO_BSD = _ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")
_BSD_3 = (
    (Path(__file__).parent / "known" / "BSD-3-Clause.txt").read_text()
    .replace("the name of the University nor the names of its contributors", "the name of the copyright holder nor the names of its contributors")
    .replace("THE REGENTS AND CONTRIBUTORS", "THE COPYRIGHT HOLDERS AND CONTRIBUTORS")
    .replace("THE REGENTS OR CONTRIBUTORS", "THE COPYRIGHT HOLDER OR CONTRIBUTORS")
)
_BSD_2 = _BSD_3[: _BSD_3.index("3. Neither")] + _BSD_3[_BSD_3.index("THIS SOFTWARE IS PROVIDED") :]


def _full_texts() -> tuple[tuple[str, str], ...]:
    """(license, text) of the files in the folder ``known``, with and without the title before the text."""
    out = []
    for file in sorted((Path(__file__).parent / "known").glob("*.txt")):
        text = file.read_text()
        out.append((file.stem, text))
        title, _, body = text.strip().partition("\n\n")
        if body.strip() and len(title) < 200 and file.stem != "BSD-3-Clause":
            out.append((file.stem, body))
    return tuple(out)


#: Public licence texts and notices by SPDX identifier.
KNOWN = (
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", _GPL),
    ("ISC", _ISC),
    ("MIT", _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MPL-2.0", _MPL),
    ("0BSD", _ZERO_BSD),
    ("BSD-2-Clause", _BSD_2),
    ("BSD-2-Clause", f"BSD 2-Clause License\n\n{_BSD_2}"),
    ("BSD-3-Clause", _BSD_3),
    ("BSD-3-Clause", f"BSD 3-Clause License\n\n{_BSD_3}"),
    ("ISC", f"ISC License\n\n{_ISC}"),
    ("ISC", f"The ISC License\n\n{_ISC}"),
    ("MIT", f"MIT License\n\n{_MIT}"),
    ("MIT", f"The MIT License\n\n{_MIT}"),
    ("MIT", f"The MIT License (MIT)\n\n{_MIT}"),
    *_full_texts(),
)


def canonical_line(line: Column) -> Column:
    """A line's canonical form, without spaces at its ends; empty for a copyright line."""
    low = F.lower(line)
    plain = F.trim(F.regexp_replace(low, r"[^\p{L}\p{N}]+", " "))
    spelt = reduce(lambda t, s: F.regexp_replace(t, rf"\b{s[0]}\b", s[1]), SPELLINGS, plain)
    return F.when(low.rlike(COPYRIGHT), "").otherwise(spelt)


def canonical_paragraphs(text: Column) -> Column:
    """array<array<string>>: the canonical lines, without empty ones, of each paragraph of a text."""
    lines = lambda p: F.filter(F.transform(F.split(p, "\n", -1), canonical_line), lambda x: x != "")
    return F.transform(F.split(text, r"\n[\x20\t\r]*\n\s*", -1), lines)


def units(paragraphs: Column) -> Column:
    """array<struct<kind, at, canonical>> of a text given as canonical paragraphs: its lines, its paragraphs and
    itself. Pass a column, not an expression: it is used more than once."""
    unit = lambda kind, x, i: F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("at"), x.alias("canonical"))
    joined = F.transform(paragraphs, lambda p: F.array_join(p, " "))
    return F.concat(
        F.transform(F.flatten(paragraphs), lambda x, i: unit("line", x, i)),
        F.transform(joined, lambda x, i: unit("paragraph", x, i)),
        F.array(unit("text", F.array_join(F.filter(joined, lambda x: x != ""), " "), F.lit(0))),
    )


def paragraph_runs(paragraphs: list[str], sizes: dict[str, list[int]]) -> list[tuple[int, str]]:
    """(at, canonical) of the runs of canonical paragraphs that begin with a key of ``sizes`` (all of one length)
    and have one of its numbers of code points. Each start looks up where paragraphs end, so that a text
    takes time in proportion to its length."""
    if not sizes:
        return []
    text, head = " ".join(paragraphs), len(next(iter(sizes)))
    starts, at = [], 0
    for p in paragraphs:
        starts.append(at)
        at += len(p) + 1
    ends = {x - 1 for x in starts[1:]} | {at - 1}
    out = []
    for i, x in enumerate(starts):
        out += [(i, text[x : x + n]) for n in sizes.get(text[x : x + head], ()) if x + n in ends]
    return out


def runs(paragraphs: Column, sizes: dict[str, list[int]]) -> Column:
    """array<struct<kind, at, canonical>>: ``paragraph_runs`` of a column of canonical paragraphs, none for null."""
    result = pa.list_(pa.struct([("kind", pa.string()), ("at", pa.int32()), ("canonical", pa.string())]))

    @F.arrow_udf("array<struct<kind:string,at:int,canonical:string>>")
    def found(texts: pa.Array) -> pa.Array:
        each = ([{"kind": "run", "at": i, "canonical": c} for i, c in paragraph_runs(p, sizes)] if p else [] for p in texts.to_pylist())
        return pa.array(list(each), result)

    return found(paragraphs)


def _canonical_known(spark, known) -> DataFrame:
    """(license, c) of the known licences, from (license, text); c is the canonical form."""
    if len(known) > MOST_KNOWN:
        raise ValueError(f"{len(known)} known licences; the lookup table holds {MOST_KNOWN}")
    texts = spark.createDataFrame(list(known), "license string, text string")
    whole = F.filter(units(F.col("p")), lambda u: u["kind"] == "text")[0]["canonical"]
    return texts.select("license", canonical_paragraphs(F.col("text")).alias("p")).select("license", whole.alias("c")).where("c <> ''")


def known_table(spark, known=KNOWN) -> DataFrame:
    """(digest, license) of the known licences, from (license, text)."""
    return _canonical_known(spark, known).groupBy(F.sha2("c", 256).alias("digest")).agg(F.min("license").alias("license"))


def find_licenses(documents: DataFrame, known=KNOWN) -> DataFrame:
    """(key, kind, at, license): every unit of a document that is a known licence, by the key of its row."""
    rows = documents.select(row_key("doc_id", text_or_empty()).alias("key"), canonical_paragraphs(text_or_empty()).alias("p"))
    # of MOST_KNOWN entries at most, their first letters and lengths
    forms = [(r.h, r.n) for r in _canonical_known(documents.sparkSession, known).select(F.left("c", F.lit(HEAD)).alias("h"), F.length("c").alias("n")).distinct().collect()]
    every = units(F.col("p"))
    if forms:
        head = min(HEAD, *(n for _, n in forms))
        sizes: dict[str, list[int]] = {}
        for h, n in sorted(forms):
            sizes.setdefault(h[:head], []).append(n)
        begins = lambda x, i: F.left(F.array_join(F.slice("joined", i + 1, head), " "), F.lit(head)).isin(sorted(sizes))
        # only texts in which a run may begin are sent to Python
        any_start = F.exists(F.transform("joined", begins), lambda x: x)
        rows = rows.withColumn("joined", F.filter(F.transform("p", lambda p: F.array_join(p, " ")), lambda x: x != ""))
        rows = rows.withColumn("runs", runs(F.when(any_start, F.col("joined")), sizes))
        every = F.concat(every, "runs")
    rows = rows.select("key", F.inline(every))
    digests = rows.where("canonical <> ''").select("key", "kind", "at", F.sha2("canonical", 256).alias("digest"))
    return digests.join(F.broadcast(known_table(documents.sparkSession, known)), "digest").select("key", "kind", "at", "license")


def license_report(documents: DataFrame, known=KNOWN) -> DataFrame:
    """doc_id, text_license (of the whole text, or null), n_lines (lines that are a licence) and licenses (of any
    unit, sorted, comma-joined), a row per document."""
    hits = find_licenses(documents, known).distinct()
    of = hits.groupBy("key").agg(
        F.max(F.when(F.col("kind") == "text", F.col("license"))).alias("text_license"),
        F.sum((F.col("kind") == "line").cast("long")).alias("n_lines"),
        F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"),  # of at most the known ones
    )
    keyed = documents.select("doc_id", row_key("doc_id", text_or_empty()).alias("key"))
    return keyed.join(of, "key", "left").select("doc_id", "text_license", F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"), F.coalesce("licenses", F.lit("")).alias("licenses"))
