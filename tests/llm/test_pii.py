"""Spans against Python's re, counts and ratios against a plain computation, masking."""

import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from roadflow.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end(), kind, m[0]))
    return sorted(out)


def spans_text(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind, _ in spans)


def random_texts(rng, n):
    bits = ["a.b@c.de", "x@y", "@", "é", "\U0001f600", " ", "\n", "1.2.3.4", "256.1.1.1", "001.02.3.255", "1.2.3.4.5.6.7.8.9", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 123-456 78", "+1", "..", "12345678901234567890", "5500000000000004", "-", "+", "word", "_", "%x+y@z-.q.r", "a@b.c@d.e", ",", "(", ")", "0", "7"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(25))) for _ in range(n)]


def test_base_spans_match_the_patterns(spark):
    texts = [None, "", *random_texts(random.Random(2), 1500), "9" * 30000 + "@", "a" * 30000, "1." * 20000, "+" + "1 " * 20000, "x@" + "a." * 20000, " " * 30000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("base", F.lit(1))
    got = {r.doc_id: r for r in pii.span_report(docs).collect()}
    for i, t in enumerate(texts):
        want = brute(t)
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(spans_text(want).encode()).hexdigest(), t
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in want) for k in range(4)]


def bits_left(share, sightings):
    """-log2 of the lower root of |share - p| = Z sqrt(p (1 - p) / sightings), by bisection."""
    low, high = 0.0, share
    for _ in range(200):
        p = (low + high) / 2
        if share - p > pii.Z * math.sqrt(p * (1 - p) / sightings):
            low = p
        else:
            high = p
    return -math.log2((low + high) / 2)


def brute_terms(rows):
    """{text: [(start, end, removed)]}, the term spans by the definitions of the module."""
    stop = r"\x20\x09-\x0D.,;:!?0-9\"'`‘’‚“”„«»‹›‐‑‒–—―()\[\]{}<>\-"
    term = re.compile(rf"(?<![^{stop}])[^\W\d_]{{3,}}(?![^{stop}])")
    n, copies = len(rows), {}
    for _, t in rows:
        copies[t or ""] = copies.get(t or "", 0) + 1
    entities, terms, n_term = {}, {}, {}
    for t, c in copies.items():
        plain = list(t)
        for start, _, end, kind, value in brute(t):
            plain[start:end] = " " * (end - start)
            name = re.sub("[^0-9]", "", value) if kind in ("card", "phone") else value.lower()
            entities.setdefault(f"{kind}:{name}", set()).add(t)
        plain = "".join(plain)
        terms[t] = [(m.start(), m.end(), m[0].lower()) for m in term.finditer(plain)]
        for w in set(re.split(f"[{stop}]+", plain.lower())):
            n_term[w] = n_term.get(w, 0) + c
    left = {}
    for texts in entities.values():
        of = {}
        for t in texts:
            for w in {x[2] for x in terms[t]}:
                of.setdefault(w, []).append(t)
        share_e = sum(copies[t] for t in texts) / n
        for w, ts in of.items():
            share = min(1.0, sum(copies[t] for t in ts) / n_term[w])
            bits = bits_left(share, len(ts) / share)
            if bits <= pii.GENERALISE and -math.log2(share_e) - bits >= pii.GAIN:
                for t in ts:
                    left[t, w] = min(bits, left.get((t, w), 9))
    return {t: [(a, b, left[t, w] <= pii.REMOVE) for a, b, w in ws if (t, w) in left] for t, ws in terms.items()}


def test_terms_and_masks(spark):
    rng = random.Random(4)
    people = [("Quimby", "q@x.org"), ("Zelda Fitz", "+49 30 1234567"), ("Oskar", "10.0.0.1")]
    rows = [(9000, None), (9001, "")]
    for i in range(200):
        words = [rng.choice("the and of with some common words here often".split()) for _ in range(rng.randrange(3, 40))]
        if i % 4 == 0:
            name, what = people[i // 4 % 3]
            words.insert(rng.randrange(len(words)), f"{name}, {what}" if i % 8 else f"{what} ({name}) {name};")
        rows.append((rng.choice([i, None, 7]), " ".join(words)))
    rows += [rows[2]] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("terms", F.lit("clash")).withColumn("n_chars", F.lit(3).cast("long"))
    want = brute_terms(rows)
    assert any("Quimby" in t and s for t, s in want.items() if s)
    got = pii.with_spans(docs, "found", "added").collect()
    assert len(got) == len(rows)
    for r in got:
        assert sorted((s.start, s.end, s.removed) for s in r.added) == want[r.text or ""], r.text
    clean = pii.sanitised(docs)
    assert clean.columns == docs.columns
    clean = clean.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in clean) == sorted((i is None, i or 0) for i, _ in rows)
    for r in clean:
        assert not brute(r.text) and "Quimby" not in (r.text or "")
    untouched = {t for _, t in rows if not brute(t)}
    assert untouched <= {r.text for r in clean}


FILL = "the and of with some common words here "


def test_far_terms(spark):
    """Terms of an entity of two texts count, wherever they stand and whatever quotes, brackets or hyphens are around."""
    rows = [(i, FILL * 4) for i in range(300)]
    rare = "Quimbly wrote " + FILL * 9 + 'to q@x.org and "quimbly" or Quimbly-1 [Quimbly] {quimbly}<quimbly>.'
    rows += [(900, rare), (899, "q@x.org (quimbly)"), *[(i, "wrote the words") for i in range(901, 910)], (910, "org of x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.span_report(docs).collect()}
    at = [m.start() for m in re.finditer("quimbly", rare.lower())]
    assert [s for s in got[900].spans.split(",") if s.startswith("term")] == [f"term:{a}:{a + 7}" for a in at] and got[900].n_term == len(at) == 6
    assert all(got[i].n_term == 0 for i in got if i not in (899, 900))
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert "quimbly" not in clean[900].lower() and "wrote" in clean[900] and "[TERM]" in clean[900] and clean[899] == "[EMAIL] ([TERM])"


def test_one_sighting_is_no_evidence(spark):
    """Names of planted entities are found, rare harmless words are not, and the size of the corpus changes nothing.

    Harmless: words of a single text with the entity, of copies of one text, and of as many texts without it.
    """
    rng, names, rows = random.Random(11), [], []
    word = lambda: "".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(6))
    for k in range(40):
        name, mail, shared = word(), f"p{k}@x{k}.org", word()
        names.append(name)
        for i in range(2 + k % 4):
            rows.append(f"{word()} {FILL}{name} {mail} {word()} {shared if i < 2 else ''}")
        rows += [f"{FILL}{shared} {word()}"] * 2 + [f"{FILL}{shared} {word()} {word()}"]
        rows += [f"{word()} {word()} {FILL} c{k}@y.org {word()}"] * 3  # copies
    masked = []
    for extra in (0, 3000):
        docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows + [FILL] * extra)], "doc_id long, text string")
        added = pii.with_spans(docs, "base", "added").where("size(added) > 0").select("text", "added").collect()
        masked.append({(r.text, s.start, s.removed) for r in added for s in r.added})
        found = [r.text[s.start : s.end] for r in added for s in r.added]
        precision, recall = sum(w in names for w in found) / len(found), len(set(found) & set(names)) / len(names)
        assert precision == 1 and recall == 1, (precision, recall)
    assert masked[0] == masked[1] and {x[2] for x in masked[0]} == {True, False}


def test_bound(spark):
    """The bound on hand-made counts, against bisection; a word that spans' places reveal counts once."""
    counts = [(1, 1, 1), (2, 2, 2), (9, 9, 1), (4, 4, 4), (3, 7, 2), (50, 60, 50), (5, 4, 5)]
    got = spark.createDataFrame(counts, "a long, b long, c long").select("a", "b", "c", pii.surely(F.col("a"), F.col("b"), F.col("c")).alias("p")).collect()
    for r in got:
        share = min(1, r.a / r.b)
        assert abs(-math.log2(r.p) - bits_left(share, r.c / share)) < 1e-9
    by = {tuple(r[:3]): -math.log2(r.p) for r in got}
    assert by[1, 1, 1] == by[9, 9, 1] > 1.4 > pii.GENERALISE >= by[2, 2, 2] > pii.REMOVE >= by[4, 4, 4]


def test_lists_of_addresses_are_one_class(spark):
    text = " ".join(f"name{'abcdefghij'[i % 10]}x u{i}@x.org" for i in range(300))
    docs = spark.createDataFrame([(1, text), (2, text + " more"), (3, "a u1@x.org b"), (4, "u1@y.org namebx")] + [(i, "words") for i in range(10, 500)], "doc_id long, text string")
    found = pii.found_spans(docs)
    assert pii.pairs_of(found).count() == 2 * (10 + 11)  # u1's texts and those of the others, with ten terms and one more
    assert pii.span_report(docs).where("doc_id = 1").first().n_term == 9 * 30  # namebx stands in a text without them, too


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pii.span_report(none).count() == 0 and pii.sanitised(none).count() == 0


def test_long_texts_of_very_many_matches(spark):
    """Spans, blanked and rewritten text over many parts, against Python; time does not grow with the square."""
    import time

    numbers = " ".join(f"{i:07d}" for i in range(40_000))
    mixed = "é " + "; ".join(f"a{i}@ex.org +49 (0)30 12{i:05d}" for i in range(3000))
    docs = spark.createDataFrame([(1, numbers), (2, mixed)], "doc_id long, text string")
    got = docs.select("doc_id", pii.base_spans(F.col("text")).alias("s")).withColumn("n", F.size("s"))
    began = time.time()
    spans = {r.doc_id: [(x.start, x.kind, x.end) for x in r.s] for r in got.collect()}
    assert time.time() - began < 60 and spans[1] == []
    want = [x[:3] for x in brute(mixed)]
    assert spans[2] == want and len(want) >= 6000
    blanked = docs.where("doc_id = 2").select(pii._blanked(F.col("text"), pii.base_spans(F.col("text")))).first()[0]
    plain = list(mixed)
    for start, _, end in want:
        plain[start:end] = " " * (end - start)
    assert blanked == "".join(plain)
    text = pii.sanitised(docs.where("doc_id = 2")).first().text
    out, at = [], 0
    for start, k, end in want:
        if start >= at:  # overlapping spans are masked as one
            out += [mixed[at:start], pii.MASKS[k]]
        at = max(at, end)
    assert text == "".join(out) + mixed[at:]
