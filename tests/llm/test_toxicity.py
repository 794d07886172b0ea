"""The grammar's marks, learned stems, held-out accuracy on the given tables, edge cases."""

import math
import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from roadflow.llm import toxicity
from roadflow.llm.common import table

SF = "/root/testdata/sf0.01"


def marks(text, stems=()):
    lexicon = toxicity.Lexicon(dict.fromkeys(stems, 1.0))
    tags = [lexicon.tag(w) for w in toxicity.WORD.findall(text.lower())]
    return [(t[0], *sorted(t[1])) for t in toxicity.transduced(tags) if isinstance(t, tuple)]


def test_transducers_compose():
    assert marks("the idiot") == [("insult",)]
    assert marks("you are an idiot") == [("insult", "aimed")]
    assert marks("idiot that you are") == [("insult", "aimed")]
    assert marks("this is not an idiot here") == [("insult", "negated")]
    assert marks("not one two three four idiot") == [("insult",)]
    assert marks("somebody said the man near the big red house was a moron") == [("insult", "reported")]
    assert marks("she said you are not a moron") == [("insult", "aimed", "negated", "reported")]
    assert marks("i will kill you") == [("threat", "aimed")]
    assert marks("lowihaft lowi low", ["lowi*"]) == [("insult",)] * 2


def test_compiled_machine_is_the_product():
    states = {s for s, _ in toxicity.FORWARD_TABLE}
    assert states <= {((n, r), t) for n in range(4) for r in (0, float("inf")) for t in range(5)}
    assert len(toxicity.FORWARD_TABLE) == len(states) * len(toxicity._symbols())
    for (state, symbol), (to, out) in toxicity.FORWARD_TABLE.items():  # the parts one after the other give the same
        (negated, reported), aimed = state
        a, x = toxicity._within(toxicity.NEGATION, "negated", 3).step(negated, symbol)
        b, x = toxicity._within(toxicity.REPORT, "reported", float("inf")).step(reported, x)
        c, x = toxicity._within(toxicity.TARGET, "aimed", 4).step(aimed, x)
        assert (to, out) == (((a, b), c), x)


def test_clauses_bound_the_cues():
    lexicon = toxicity.Lexicon({})
    one, two = lexicon.counts("he said so. an idiot"), lexicon.counts("he said so an idiot")
    reported = toxicity.FEATURES.index("insult reported")
    assert one[reported] == 0 < two[reported]
    assert not lexicon.counts(None).any() and not lexicon.counts("").any()


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = {r.doc_id: r for r in toxicity.toxicity_report(docs, labels).collect()}
    assert len(got) == docs.count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    for held in (False, True):
        pairs = [(truth[i], got[i].predicted) for i in truth if got[i].held_out == held]
        assert sum(t == p for t, p in pairs) / len(pairs) > 0.95
        assert not [1 for t, p in pairs if p > t]


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, turned)


def test_nulls_copies_no_labels(spark):
    docs = spark.createDataFrame([(None, "you idiot"), (1, None), (2, ""), (2, ""), (3, "you are a pathetic idiot, you moron")], "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("toxic", F.lit(5))
    labels = spark.createDataFrame([(None, 1), (1, None), (2, 0), (2, 1)], "doc_id long, toxic int")
    for given in (labels, labels.where("false")):
        got = toxicity.toxicity_report(docs, given).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    kept = toxicity.drop_toxic(docs, labels.where("false"))
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "2"]
    assert {r.score for r in kept.collect()} == {"clash"}
    assert toxicity.toxicity_report(docs.where("false"), labels).count() == 0


def test_copies_are_one_training_row(spark):
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5]
    rows = [(ids[0], "copied badword")] * 3000 + [(i, "copied badword") for i in ids[1:400]]
    rows += [(i, f"vilething text {i}") for i in ids[400:430]] + [(i, f"fine text {i}") for i in ids[430:600]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(k < 430)) for k, i in enumerate(ids[:600])], "doc_id long, toxic int")
    train = toxicity.training_rows(docs, labels)
    got = train.collect()
    assert len(got) == len({r.text for r in got}) == 201 and sum(r.toxic for r in got) == 31
    assert toxicity.training_rows(docs, labels, 50).count() == 50
    assert any(s.startswith("vile") for s in toxicity.learned_stems(train))


def statuses(text, **more):
    lexicon = toxicity.Lexicon({}, **more)
    return [m[:2] for c in toxicity.CLAUSE.split(text.lower()) for m in lexicon.matches(toxicity.WORD.findall(c))]


def test_clauses_match_by_phrase_and_status():
    assert statuses("I will beat you to death") == [("threat", "aimed")]
    assert statuses("I will not strangle you") == [("threat", "negated")]
    assert statuses("she said I will make you regret this") == [("threat", "reported")]
    assert statuses("we know exactly where you live") == [("threat", "aimed")]
    assert statuses("beat the eggs to death, kill the process") == [("threat", "plain")]
    assert statuses("beat the eggs. you rest until death") == []
    assert statuses("you piece of trash") == [("insult", "aimed")]
    assert statuses("a piece of bread") == []
    assert statuses("the word idiot appears in this dictionary") == [("insult", "reported")]
    assert statuses("not an idiot") == [("insult", "negated")] and statuses("not an idiot here, but you are a moron") == [("insult", "aimed")]
    assert statuses("idiot moron idiot") == [("insult", "plain")]  # a clause counts once


def brute_phrases(words, violent):
    """Kinds of the phrases that begin at each word, by trying all places."""

    def from_(places, gap, i):
        fits = i < len(words) and (words[i] in violent if places[0] == toxicity.VIOLENT else words[i] in places[0])
        return fits and (len(places) == 1 or any(from_(places[1:], gap, i + 1 + k) for k in range(gap + 1)))

    return [frozenset(k for k, places, gap in toxicity.PHRASES if from_(places, gap, i)) for i in range(len(words))]


def test_phrase_machine_against_brute_force():
    rng = random.Random(5)
    vocab = sorted({w for _, places, _ in toxicity.PHRASES for p in places for w in p if w[0] != "<"}) + ["kill", "murder", "x", "y"]
    lexicon = toxicity.Lexicon({})
    seen = 0
    for _ in range(6000):
        words = rng.choices(vocab if rng.random() < 0.5 else ["kill", "you", "beat", "death", "x", "piece", "of", "trash", "know", "where", "live"], k=rng.randrange(12))
        got = lexicon.phrases(words)
        assert got == brute_phrases(words, toxicity.THREATS)
        seen += any(got)
    assert seen > 300


def test_scores_of_clauses(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    fitted = toxicity.fit(docs, labels)
    none = toxicity.fit(docs, labels.where("false"))
    toxic = ["I will beat you to death", "you are an idiot", "we know where you live", "I am going to strangle you", "you worthless piece of trash"]
    clean = ["the word idiot appears in this dictionary", "he said you are not an idiot", "you are not an idiot", "kill the process", "I will not kill you", "", None]
    for model in (fitted, none):
        frame = spark.createDataFrame([(i, t) for i, t in enumerate(toxic + clean)], "doc_id long, text string")
        got = [r.score for r in toxicity.scored(frame, model).orderBy("doc_id").collect()]
        # the scores by hand: a logistic curve over the clauses of each text
        lexicon = toxicity.Lexicon(model.stems, model.threats)
        for text, score in zip(toxic + clean, got, strict=True):
            n, live = Counter(), False
            for clause in toxicity.CLAUSE.split((text or "").lower()):
                for kind, status, w in lexicon.matches(toxicity.WORD.findall(clause)):
                    n[kind if status == "plain" else f"{kind} {status}"] += w
                    live |= status == "aimed" or (kind, status) == ("insult", "plain")
            z = model.bias + sum(w * (float(live) if f == "any" else math.log1p(n[f])) for f, w in zip(toxicity.FEATURES, model.weights, strict=True))
            assert abs(score - 1 / (1 + math.exp(-z))) < 1e-9
        assert min(got[: len(toxic)]) >= 0.5 > max(got[len(toxic) :]), got


def test_threat_stems_are_learned(spark):
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, f"text {i}. I will grobnak you") for i in ids[:40]] + [(i, f"this vilething of {i}") for i in ids[40:80]]
    rows += [(i, f"fine text {i}, I will thank you") for i in ids[80:300]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(k < 80)) for k, i in enumerate(ids[:300])], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert any(s.startswith("grob") for s in model.threats) and not any(s.startswith("vile") for s in model.threats)
    frame = spark.createDataFrame([(1, "they are going to grobnak him"), (2, "he said: nothing. she said they will grobnak him"), (3, "a vilething")], "doc_id long, text string")
    got = [r.score for r in toxicity.scored(frame, model).orderBy("doc_id").collect()]
    assert got[0] >= 0.5 > got[1] and got[2] >= 0.5
