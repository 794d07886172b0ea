"""Information-theoretic sanitisation of personal data, with DataFrame functions only.

Protected entities are the personal data that fixed patterns find (email, ip, card, phone). Terms in an
entity's documents are weighed by what they disclose of it, after C-sanitised models of text sanitisation: over
the corpus, with documents as events,

    IC(e) = -log2 p(e)        PMI(e; t) = log2(p(e | t) / p(e))        left = IC - PMI = -log2 p(e | t)

``left`` are the bits that stay unknown of the entity to someone who reads the term, PMI the bits they gain. A
rare term is no evidence: p(e | t) is not n(e, t) / n(t) but the lower end of that share's score interval
(Wilson) at ``Z``, one-sided, for as many sightings as there are different texts: copies of a text are one
sighting, so n(t) counts as n(t) * texts(e, t) / n(e, t). A term that was only ever seen in one text leaves at
least 1.4 bits, however rare it is and however large the corpus.

A pair whose term leaves at most ``GENERALISE`` bits and gains at least ``GAIN`` bits discloses: the term is
replaced by its class, and if it leaves at most ``REMOVE`` bits it is removed. So two texts of two are enough to
generalise and four of four to remove, at every size of the corpus; an entity in over half of all documents has
too little information for anything to disclose it. A pair (e, t) occurs in a document that has both, anywhere;
a term is a run of three or more letters between the text's ends, white space, digits, quotes, brackets, hyphens
or the punctuation . , ; : ! ?, in lower case. Where a pattern matched there are no terms.

Where: a disclosing term is masked wherever it stands in a document of its entity. The spans of the patterns
always stay; the method adds spans of kind ``term``.

Corpus counts are counts of documents: an aggregate of (entity, term) over the distinct texts with entities,
one of entities, and one of the hashes of all distinct words of each document. Entities of the very same texts
have equal counts with every term and are counted as one, so that a list of addresses does not make a pair of
each address and word; entities of a single text can have no disclosing term and are left out before pairs are
made, which changes no result. An entity or term in a third of all documents is summed before the shuffle; nothing is
collected. Terms are named by 64-bit hashes.

Defined results: a null text is empty and stays null when masked; equal texts get equal spans; a null doc_id
is kept; repeated rows are documents of their own in the counts but one sighting of a pair; an empty table gives
no rows; further columns, whatever their names, are kept. Lists are walked in parts, so that a very long text or
very many matches take time in proportion. Equal ratios are treated alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadflow.llm.common import SPACE, fresh, stored, text_or_empty

KINDS = ("email", "ip", "card", "phone", "term")
#: 90 of 100, one-sided.
Z = 1.2816
#: Bits of an entity that a term leaves unknown, at most; bits that it gains, at least.
GENERALISE = 1.0
REMOVE = 0.5
GAIN = 1.0

#: The patterns, fixed values in meaning. They are written so that a long run of digits or letters is read
#: once: possessive repeats where nothing could be given back, and no start inside a run whose start failed
#: (unless the match before ended there).
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text needs for a pattern to match at all.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
STOPS = rf"{SPACE}.,;:!?0-9\"'`‘’‚“”„«»‹›‐‑‒–—―()\[\]{{}}<>\-"
TERM = rf"(?<![^{STOPS}])\p{{L}}{{3,}}(?![^{STOPS}])"
MASKS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "[TERM]")


#: Lists are walked in parts of so many: appending to a list copies it, so long ones would take the square of their length.
PART = 256


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _parts(items: Column) -> Column:
    """A list (a bound one) cut into parts of ``PART``."""
    at = F.when(F.size(items) > 0, F.sequence(F.lit(0), F.size(items) - 1, F.lit(PART))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.slice(items, i + 1, F.lit(PART)))


def _before(numbers: Column, merged) -> Column:
    """For each number ``merged`` of 0 and all numbers before it."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(
        numbers, zero, lambda acc, x: F.struct(merged(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"]
    )


def _in_order(items: Column, length, placed, kind: str) -> Column:
    """array<kind>: ``placed(start, item)`` of every item, where items of ``length(item)`` follow one another."""
    def one(part: Column, first: Column) -> Column:
        zero = F.struct(first.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
        step = lambda acc, x: F.struct((acc["at"] + length(x)).alias("at"), F.concat(acc["out"], F.array(placed(acc["at"], x))).alias("out"))
        return F.aggregate(part, zero, step, lambda acc: acc["out"])

    def placed_parts(parts: Column) -> Column:
        sizes = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda n, x: n + length(x)))
        return F.flatten(F.zip_with(parts, _before(sizes, lambda n, x: n + x), one))

    return _bound(_bound(items, _parts), placed_parts)


def _rewritten(text: Column, spans: Column, written) -> Column:
    """The text with each span (in order of start) replaced: ``written(at, span)`` is what to put for a span where
    the text is done up to ``at``, null to leave it out with the text before it. Every part of the spans works on its
    own stretch of the text."""
    stretch = lambda p, b: F.struct(p.alias("spans"), b.alias("at"), F.substring(text, b + 1, F.array_max(F.transform(p, lambda s: s["end"])) - b).alias("text"))

    def one(z: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            new = written(acc["at"], s)
            gap = F.substring(z["text"], acc["at"] - z["at"] + 1, s["start"] - acc["at"])
            out = F.when(new.isNotNull(), F.concat(acc["out"], F.array(gap, new))).otherwise(acc["out"])
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

        zero = F.struct(z["at"].alias("at"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(z["spans"], zero, step, lambda acc: F.array_join(acc["out"], ""))

    def whole(parts: Column) -> Column:
        ends = F.transform(parts, lambda p: F.array_max(F.transform(p, lambda s: s["end"])))
        done = F.array_join(F.transform(F.zip_with(parts, _before(ends, F.greatest), stretch), one), "")
        return F.concat(done, F.substring(text, F.coalesce(F.array_max(ends), F.lit(0)) + 1, F.length(text)))

    return _bound(_bound(spans, _parts), whole)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of the pattern's leftmost matches, in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda g, v: F.struct(F.length(g).alias("gap"), F.length(v).alias("size"), v.alias("value")))

    def placed(at: Column, x: Column) -> Column:
        start = at + x["gap"]
        return F.struct(start.alias("start"), (start + x["size"]).alias("end"), x["value"].alias("value"))

    return _in_order(pairs, lambda x: x["gap"] + x["size"], placed, "struct<start:int,end:int,value:string>")


def _luhn(digits: Column) -> Column:
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    value = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(doubled(c.cast("int"))))
    return F.aggregate(value, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)(?:\.|$)){4}$")
    if kind == "card":
        digits = F.regexp_replace(value, r"[\x20-]", "")
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(value, r"[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _entity(kind: str, value: Column) -> Column:
    """What is the same for all spellings of one entity."""
    if kind in ("card", "phone"):
        value = F.regexp_replace(value, r"[^0-9]", "")
    return F.concat(F.lit(f"{kind}:"), F.lower(value))


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end, entity>> of the patterns' valid matches, in the order of start and kind.

    ``kind`` is the number of the kind in ``KINDS``.
    """
    none = F.array().cast("array<struct<start:int,kind:int,end:int,entity:string>>")

    def spans(k: int, kind: str) -> Column:
        valid = F.filter(matches(text, PATTERNS[kind]), lambda m: _valid(kind, m["value"]))
        found = F.transform(valid, lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end"), _entity(kind, m["value"]).alias("entity")))
        can = F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else text.rlike("[0-9]")
        return F.when(can, found).otherwise(none)

    return F.sort_array(F.concat(*(spans(k, kind) for k, kind in enumerate(PATTERNS))))


def _blanked(text: Column, spans: Column) -> Column:
    """The text with spaces where the spans are."""
    return _rewritten(text, spans, lambda at, s: F.repeat(F.lit(" "), s["end"] - F.greatest(s["start"], at)))


def _words(text: Column) -> Column:
    """array<long>: the hashes of the distinct words between ``STOPS``, terms among them."""
    return F.array_distinct(F.transform(F.split(F.lower(text), f"[{STOPS}]+"), lambda w: F.xxhash64(w)))


def _terms(text: Column) -> Column:
    """array<struct<gap, size, h>>: every term with the code points before it and its own, and its hash."""
    found = F.regexp_extract_all(text, F.lit(TERM), F.lit(0))
    gaps = F.slice(F.split(text, TERM, -1), 1, F.size(found))
    return F.zip_with(gaps, found, lambda g, v: F.struct(F.length(g).alias("gap"), F.length(v).alias("size"), F.xxhash64(F.lower(v)).alias("h")))


def found_spans(documents: DataFrame) -> DataFrame:
    """A row per distinct text with any span of the patterns: digest (SHA-256 of the text), copies (documents
    with it), base (the spans), terms (all, in order), inside and bare (words that the spans' places take from the
    text's and add to them). Written to the shared folder, as counts, masking and reports read it: texts are searched
    once for all of them."""
    spans = documents.select(text_or_empty().alias("text")).withColumn("base", base_spans(F.col("text")))
    some = lambda x: F.when(F.size("base") > 0, x)
    spans = spans.withColumn("plain", some(_blanked(F.col("text"), F.col("base"))))
    each = spans.select(
        some(F.unhex(F.sha2("text", 256))).alias("digest"),
        some(F.col("base")).alias("base"),
        some(_terms(F.col("plain"))).alias("terms"),
        some(F.array_except(_words(F.col("text")), _words(F.col("plain")))).alias("inside"),
        some(F.array_except(_words(F.col("plain")), _words(F.col("text")))).alias("bare"),
    )
    each = stored(each, "pii-spans").where("digest is not null")
    one = each.groupBy("digest").agg(F.count("*").alias("copies"), F.first(F.struct("base", "terms", "inside", "bare")).alias("x"))
    return stored(one.select("digest", "copies", "x.*"), "pii-texts")


def pairs_of(found: DataFrame) -> DataFrame:
    """(digest, copies, e, n_entity, h): every entity of two or more texts with every term of each of them, entities
    of the same texts as one; e names those, n_entity is the number of their documents."""
    of = found.select("digest", "copies", F.explode(F.array_distinct("base.entity")).alias("entity"))
    same = of.groupBy("entity").agg(F.sum("copies").alias("n_entity"), F.count("*").alias("texts"), F.xxhash64(F.count("*"), F.bit_xor(F.xxhash64("digest"))).alias("e"))
    classes = of.join(same.where("texts > 1"), "entity").groupBy("digest").agg(F.collect_set(F.struct("e", "n_entity")).alias("es"))  # of one text
    both = found.select("digest", "copies", F.array_distinct("terms.h").alias("hs")).join(classes, "digest")
    return both.select("digest", "copies", "hs", F.inline("es")).select("digest", "copies", "e", "n_entity", F.explode("hs").alias("h"))


def surely(n_pair: Column, n_term: Column, texts: Column) -> Column:
    """The least share of the term's documents that have the entity, at ``Z``, from ``texts`` different sightings."""
    share = F.least(n_pair / n_term, F.lit(1.0))
    seen = texts / share
    spread = F.sqrt(share * (1 - share) / seen + F.lit(Z * Z / 4) / (seen * seen))
    return (share + F.lit(Z * Z / 2) / seen - Z * spread) / (1 + F.lit(Z * Z) / seen)


def disclosing(documents: DataFrame, found: DataFrame) -> DataFrame:
    """(e, h, left) of the pairs whose term discloses its entity, from counts over all documents."""
    n = documents.count()
    pairs = pairs_of(found).groupBy("e", "n_entity", "h").agg(F.sum("copies").alias("n_pair"), F.count("*").alias("texts")).where("texts > 1")
    words = documents.select(F.explode(_words(text_or_empty())).alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    moved = [found.select("copies", F.explode(c).alias("h")).groupBy("h").agg(F.sum(F.col("copies") * by).alias("n")) for c, by in (("inside", -1), ("bare", 1))]
    terms = words.unionByName(moved[0]).unionByName(moved[1]).groupBy("h").agg(F.sum("n").alias("n_term"))
    left = -F.log2(surely(F.col("n_pair"), F.col("n_term"), F.col("texts")))
    whole = -F.log2(F.col("n_entity") / F.lit(max(n, 1)))
    weighed = pairs.join(terms, "h").select("e", "h", left.alias("left"), (whole - left).alias("gain"))
    return weighed.where((F.col("left") <= GENERALISE) & (F.col("gain") >= GAIN)).select("e", "h", "left")


def term_spans(documents: DataFrame, found: DataFrame) -> DataFrame:
    """(digest, base, terms): for each text of ``found`` the patterns' spans and those that the method adds; terms is
    array<struct<start, kind, end, removed>>."""
    marked = pairs_of(found).join(disclosing(documents, found), ["e", "h"]).groupBy("digest", "h").agg(F.min("left").alias("left"))
    split = lambda removed: F.collect_list(F.when((F.col("left") <= REMOVE) == F.lit(removed), F.col("h")))
    masked = marked.groupBy("digest").agg(split(False).alias("general"), split(True).alias("gone"))  # one text's terms

    def placed(at: Column, t: Column) -> Column:
        start = at + t["gap"]
        return F.struct(start.alias("start"), F.lit(4).alias("kind"), (start + t["size"]).alias("end"), F.array_contains("gone", t["h"]).alias("removed"), t["h"].alias("h"))

    every = _in_order(F.col("terms"), lambda t: t["gap"] + t["size"], placed, "struct<start:int,kind:int,end:int,removed:boolean,h:bigint>")
    hit = F.filter(every, lambda t: t["removed"] | F.array_contains("general", t["h"]))
    spans = F.transform(hit, lambda t: F.struct(*[t[c].alias(c) for c in ("start", "kind", "end", "removed")]))
    some = F.when(F.col("general").isNotNull(), spans)
    return found.select("digest", "base", "terms").join(masked, "digest", "left").select("digest", "base", some.alias("terms"))


def with_spans(documents: DataFrame, base: str, terms: str) -> DataFrame:
    """``documents`` with the spans of the patterns and of disclosing terms in columns of these names."""
    digest, of, base_of, terms_of = (fresh(documents, c) for c in ("_digest", "_of", "_base_of", "_terms_of"))
    found = found_spans(documents)
    added = term_spans(documents, found).toDF(of, base_of, terms_of)
    joined = documents.withColumn(digest, F.unhex(F.sha2(text_or_empty(), 256))).join(added, F.col(digest) == F.col(of), "left")
    spans = lambda c, kind: F.coalesce(F.col(c), F.array().cast(f"array<struct<{kind}>>"))
    marked = {base: spans(base_of, "start:int,kind:int,end:int,entity:string"), terms: spans(terms_of, "start:int,kind:int,end:int,removed:boolean")}
    return joined.withColumns(marked).drop(digest, of, base_of, terms_of)


def sanitised(documents: DataFrame) -> DataFrame:
    """``documents`` with personal data masked by its kind, disclosing terms generalised or removed.

    ``n_chars``, if there is such a column, is the length of the new text. Overlapping spans are masked as one,
    under the first one's kind.
    """
    base, terms = fresh(documents, "_base"), fresh(documents, "_terms")
    marked = with_spans(documents, base, terms)
    cut = lambda x, removed: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), removed.alias("removed"))
    spans = F.sort_array(F.concat(F.transform(base, lambda x: cut(x, F.lit(False))), F.transform(terms, lambda x: cut(x, x["removed"]))))
    masks = F.array(*map(F.lit, MASKS))

    def mask(at: Column, s: Column) -> Column:
        return F.when(s["start"] >= at, F.when(s["removed"], "").otherwise(F.element_at(masks, s["kind"] + 1)))

    masked = _rewritten(F.col("text"), spans, mask)
    any_span = (F.size(base) > 0) | (F.size(terms) > 0)
    out = marked.withColumn("text", F.when(any_span, masked).otherwise(F.col("text")))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(any_span, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*documents.columns)


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_report(documents: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, n_term, base_sha256 and spans, a row per document."""
    marked = with_spans(documents.select("doc_id", "text"), "base", "terms")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    place = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    every = F.sort_array(F.concat(F.transform("base", place), F.transform("terms", place)))
    return marked.select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(PATTERNS)],
        F.size("terms").cast("long").alias("n_term"),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(every).alias("spans"),
    )
