"""The clause grammar against a plain reading of its rules, the lexicon against plain counts, and held-out labels."""

import math
import random

import pytest
from pyspark.sql import functions as F

from siltline.llm import toxicity as tx
from siltline.llm.common import slabs, table

WEIGHTS = {"idiot": 6.0, "scum": 4.0, "lowei*": 5.0}
DOCS = "doc_id long, text string, evidence int, clauses string, score string, y int, hash int, label string"


def plain_clauses(text, weights):
    """Sentences with a match by the rules as the docstring has them, without states."""
    lexicon, out, begin = tx.Lexicon(weights), [], 0
    tokens = [(m.start(), m.end(), lexicon[m.group()]) for m in tx.TOKEN.finditer(text)]
    sentence = []
    for start, end, value in [*tokens, (len(text), len(text), tx.END)]:
        if value != tx.END:
            sentence.append(value)
            continue
        weight = plain_weight(sentence)
        if weight:
            out.append((begin, start, weight))
        begin, sentence = end, []
    return out


def plain_weight(values):
    counted = [i for i, v in enumerate(values) if v not in (tx.PAUSE, tx.QUOTE)]  # distances are in words
    place = {i: n for n, i in enumerate(counted)}

    def within(i, symbol, reach, barred=()):
        """Whether ``symbol`` stands at most ``reach`` words before i, with nothing barred between."""
        for j in range(i - 1, -1, -1):
            if values[j] in barred:
                return False
            if values[j] == symbol:
                return place[i] - place[j] <= reach
        return False

    total, last = 0, None
    for i, v in enumerate(values):
        threat = v == tx.HARM and within(i, tx.INTENT, tx.NEAR)
        if v > tx.INSULT or threat:
            factor = tx.AIMED if within(i, tx.TARGET, tx.NEAR) else 1
            factor *= tx.NEGATED if within(i, tx.NEGATION, tx.SCOPE, (tx.PAUSE,)) else 1
            reported = tx.SAYING in values[:i] or values[:i].count(tx.QUOTE) % 2
            total += factor * (tx.REPORTED if reported else 1) * (tx.THREAT_WEIGHT if threat else v - tx.INSULT)
            last = i
        elif v == tx.TARGET and last is not None and i - last <= tx.NEAR:
            total, last = total + tx.AIMED - 1, i - tx.NEAR
    return total


def test_clauses_weigh_by_what_surrounds_a_word():
    grammar = tx.Grammar(WEIGHTS)

    def weight(text):
        return sum(w for _, _, w in grammar.clauses(text))

    alone, aimed = weight("an idiot"), weight("You idiot")
    assert alone == 6 and aimed == 6 * tx.AIMED
    assert weight("not an idiot") == 6 * tx.NEGATED
    assert weight("not now, idiot") == 6  # a pause ends what a negation reaches
    assert weight('a "so called idiot"') == weight("the paper said idiot") == 6 * tx.REPORTED
    assert weight("Paper said. Idiot") == 6
    assert weight("I will kill you") == tx.THREAT_WEIGHT + tx.AIMED - 1
    assert weight("I will not kill him") == tx.THREAT_WEIGHT * tx.NEGATED + tx.AIMED - 1
    assert weight("kill the lights") == weight("we will see you") == 0
    assert weight("loweiung") == 5 and weight("lowei") == weight("owei") == 0
    assert grammar.clauses("Fine. An IDIOT, here! And scum") == [(5, 20, 6.0), (21, 30, 4.0)]


def random_text(rng, n):
    words = ["you", "not", "said", "will", "kill", "idiot", "scum", "loweix", "the", "of", "on", "table", '"', ",", ".", "!", "\n", "é"]
    return " ".join(rng.choices(words, weights=[2, 2, 1, 2, 2, 2, 1, 1, 4, 4, 4, 4, 1, 2, 1, 1, 1, 1], k=n))


@pytest.mark.parametrize("slab", [1 << 20, 20, 150])
def test_composed_machine_follows_the_rules(monkeypatch, slab):
    monkeypatch.setattr(tx, "slabs", lambda data: slabs(data, slab))
    rng, grammar = random.Random(slab), tx.Grammar(WEIGHTS)
    for _ in range(400):
        text = random_text(rng, rng.choice([1, 3, 8, 40]))
        got, want = grammar.clauses(text), plain_clauses(text, WEIGHTS)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want], text
        assert all(math.isclose(x[2], y[2]) for x, y in zip(got, want, strict=True)), text


def test_every_arc_of_the_composed_machine_is_that_of_its_parts():
    parts = [tx.threats(), tx.aimed(), tx.negated(), tx.reported()]
    after, written, factors = tx.compose(parts)
    rng, state, states = random.Random(1), 0, [p.start for p in parts]
    for _ in range(5000):
        symbol = rng.choice(tx.READ)
        into, factor = symbol, 1.0
        for i, part in enumerate(parts):
            states[i], into, f = part.step(states[i], into)
            factor *= f
        assert (written[state][symbol], factors[state][symbol]) == (into, factor)
        state = after[state][symbol]
        if symbol == tx.END:
            assert state == 0


def test_words_without_letters_or_space():
    grammar = tx.Grammar(WEIGHTS)
    assert grammar.clauses(None) == grammar.clauses("") == grammar.clauses(" \n\t") == []
    assert grammar.clauses("idiot" * 300_000) == []
    long = "x " * 600_000 + "you idiot. " + "y " * 600_000
    assert [w for _, _, w in grammar.clauses(long)] == [6 * tx.AIMED]
    assert grammar.clauses("İİ idiot") == [(0, 8, 6.0)]  # a letter that grows in lower case moves no place


def test_lexicon_counts_contexts(spark):
    rng = random.Random(2)
    rows = [(1, f"a{i} grumpel{'xyzwv'[i % 5]} b{i} plain") for i in range(40)]
    rows += [(1, "copied passage with zonk inside")] * 40  # one context only
    rows += [(0, f"c{i} plain d{rng.random()}") for i in range(120)]
    taught = spark.createDataFrame(rows, "y int, text string").repartition(3)
    weights = tx.learn_lexicon(taught, {1: 80, 0: 120})
    learned = {w for w in weights if w not in tx.INSULTS.split()}
    assert learned == {"grum*", "grump*", "grumpe*"}
    want = math.log(40.5 / 81) - math.log(0.5 / 121)
    assert math.isclose(weights["grum*"], want)
    assert math.isclose(weights["idiot"], math.log(3.5 / 81) - math.log(0.5 / 121))


def documents(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 2, 3, "z") for r in rows], DOCS)


def test_awkward_rows_and_names(spark):
    rows = [(1, None), (2, ""), (3, "you idiot. you scum"), (3, "you idiot. you scum"), (None, "calm"), (4, "calm " * 50_000)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(3, 1), (3, 0), (1, None), (None, 1), (9, 1), (2, 7)], "doc_id long, toxic int")
    model = tx.fit(docs, labels)  # the only label that counts says that 3 is fine
    assert (model.slope, model.shift) == tx.UNTAUGHT
    scored = tx.with_toxicity(docs, model)
    assert set(scored.columns) == set(docs.columns)
    got = {(r.doc_id, r.score) for r in scored.select("doc_id", "score").collect()}
    assert len(got) == 5 and scored.count() == 6
    by_id = dict(got)
    assert by_id[1] == by_id[2] == by_id[4] == by_id[None] < by_id[3]
    row = scored.where("doc_id = 3").first()
    assert [(c.start, c.end) for c in row.clauses] == [(0, 9), (10, 19)]
    assert math.isclose(row.score, 1 / (1 + math.exp(-(model.slope * row.evidence + model.shift))))
    empty = docs.limit(0)
    assert tx.with_toxicity(empty, tx.fit(empty, labels)).collect() == []
    assert tx.fit(docs, labels.limit(0)).weights.keys() == set(tx.INSULTS.split())


def test_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    scored = tx.op13_toxicity(spark, sf_dir)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = table(spark, sf_dir, "labels")
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = scored.join(labels, "doc_id").join(texts, "doc_id").where("held_out").toPandas()
    assert rows["score"].between(0, 1).all()
    clean = rows[rows["toxic"] == 0]
    assert (clean["predicted"] == 0).mean() > 0.98
    planted = rows[(rows["toxic"] == 1) & rows["text"].str.contains("idiot|moron|scum|stupid|loser")]
    assert len(planted) > 5 and (planted["predicted"] == 1).mean() > 0.9
    assert scored.count() == texts.count()
    assert scored.where((F.col("score") >= 0.7) != (F.col("predicted") == 1)).count() == 0
