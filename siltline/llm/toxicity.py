"""Operator 13, toxicity: a grammar of clauses, composed of small weighted transducers, with a learned lexicon.

Words become symbols: insult, target ("you"), negation, verb of saying, intent ("will"), harm ("kill"), pause and end of
sentence. Five transducers read the symbols. One turns intent and harm into a threat; one weighs up what follows a target
closely, one what a target follows; one weighs down what a negation precedes; one weighs down what is quoted or reported.
They are composed into one table of states, which walks over the clauses of a text and returns the weight of every clause
that holds an insult or a threat: "you are no idiot" and "he said she was an idiot" weigh less than "you idiot".

The weight of an insult is a log-odds ratio between toxic and other texts. Candidates are words, and word beginnings that
at least ``KINDS`` different words share, which are significantly more frequent in toxic texts of a sample. They are then
counted by distinct neighbours, so that a passage copied into a hundred documents counts once, and must be significant
again. ``INSULTS`` are known beforehand, as if seen a few times. A text's score is a logistic curve over the logarithm of
its summed clauses, fitted on a quarter of the sample that the lexicon has not seen, and shifted from the sample's share
of toxic texts to that of all labelled ones.

The lexicon is fitted on a bounded sample: per class the labelled texts with the smallest hashes, ``toxic_texts`` and
``other_texts`` of them, whole texts. The model is that lexicon and two numbers. Scoring covers all rows, whole texts in
parts of a megabyte between which the state of the grammar is carried, and shuffles nothing.

Defined cases: a null text counts as an empty one, and an empty one scores as a text without any match. A document with
several labels takes the smallest; null labels teach nothing. Without texts of both classes the curve is ``UNTAUGHT``.
Repeated texts are learned once per class. An empty table gives no rows. Columns of the names that are added are replaced.
"""

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import narrow, settle, slabs, table
from siltline.llm.quality import platt

OTHER, PAUSE, END, QUOTE, TARGET, NEGATION, SAYING, INTENT, HARM, INSULT, THREAT = SYMBOLS = range(11)
READ = SYMBOLS[:THREAT]  # threats come from the grammar, not from the text

# fixed values: words of everyday English, French, German and Spanish
WORDS = {
    TARGET: "you your yours you're youre u he she they them him her these those people tu toi te vous ton vos il elle ils "
    "du dich dir ihr euch dein sie er ustedes usted vosotros tú ti él ella ellos",
    NEGATION: "not no never n't isn't aren't wasn't don't doesn't didn't without hardly ne pas jamais sans nicht kein keine nie "
    "ohne nunca jamás sin tampoco",
    SAYING: "said says say called calls wrote writes claimed claims told quoted quotes alleged according dit disait appelé "
    "écrit selon sagte sagt schrieb nannte laut dijo dice llamó escribió según",
    INTENT: "will shall gonna going i'll we'll must should vais allons werde werden soll voy vamos",
    HARM: "kill hurt destroy beat shoot stab burn hang murder crush tuer frapper détruire brûler töten schlagen umbringen "
    "erschießen matar golpear destruir quemar",
}
INSULTS = (
    "idiot idiots moron morons stupid dumb imbecile loser losers scum trash garbage pathetic worthless disgusting clown "
    "pig fool jerk bastard asshole bitch idiote imbécile crétin salaud connard abruti ordure dummkopf arschloch trottel "
    "schwein abschaum blödmann estúpido idiota imbécil basura escoria cabrón inútil"
)

PRIOR = 3  # distinct contexts in toxic texts that INSULTS start with
THREAT_WEIGHT = 4.0
NEAR = 4  # words between a target and what is aimed at it, and between intent, harm and target
SCOPE = 3  # words that a negation reaches
AIMED, NEGATED, REPORTED = 1.25, 0.25, 0.5
KINDS = 4
STEMS = (4, 5, 6)  # characters of a word beginning
SIGNIFICANT = 3.0  # standard errors of a log-odds ratio
TELLING = 2.5  # least log-odds ratio: some twelve times as frequent in toxic texts
UNTAUGHT = (2.0, -4.0)  # slope and shift
ENDS = ".!?;:\n…"
TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[,()]|[.!?;:\n…]|[\"“”„«»]")


# ---- transducers


@dataclass(frozen=True)
class Transducer:
    """Arcs from a state and a symbol to a state, the symbol written, and a factor on its weight. Where no arc is
    given, the state stays and the symbol is written as it was read."""

    start: object
    arcs: dict = field(default_factory=dict)

    def step(self, state, symbol: int) -> tuple[object, int, float]:
        return self.arcs.get((state, symbol), (state, symbol, 1.0))


def countdown(opens: int, length: int, *, closes: Iterable[int], changes: dict[int, tuple[int, float]]) -> Transducer:
    """For ``length`` words after symbol ``opens``, ``changes`` says what other symbols become and by what factor."""
    arcs = {}
    for left in range(length + 1):
        for symbol in SYMBOLS:
            into, factor = changes.get(symbol, (symbol, 1.0)) if left else (symbol, 1.0)
            arcs[left, symbol] = (max(left - (symbol not in (PAUSE, QUOTE)), 0), into, factor)
        arcs[left, opens] = (length, opens, 1.0)
        for symbol in closes:
            arcs[left, symbol] = (0, symbol, 1.0)
    return Transducer(0, arcs)


def threats() -> Transducer:
    """Intent, then harm within a few words, is a threat; harm alone is a word like any other."""
    arcs = dict(countdown(INTENT, NEAR, closes=[END], changes={HARM: (THREAT, 1.0)}).arcs)
    arcs[0, HARM] = (0, OTHER, 1.0)
    return Transducer(0, arcs)


def aimed() -> Transducer:
    weighed = {INSULT: (INSULT, AIMED), THREAT: (THREAT, AIMED)}
    return countdown(TARGET, NEAR, closes=[END], changes=weighed)


def negated() -> Transducer:
    weighed = {INSULT: (INSULT, NEGATED), THREAT: (THREAT, NEGATED)}
    return countdown(NEGATION, SCOPE, closes=[END, PAUSE], changes=weighed)


def reported() -> Transducer:
    """What follows a verb of saying, and what stands between quotation marks, up to the end of the sentence."""
    arcs = {}
    for said in (False, True):
        for quoted in (False, True):
            here = (said, quoted)
            for symbol in (INSULT, THREAT):
                arcs[here, symbol] = (here, symbol, REPORTED if said or quoted else 1.0)
            arcs[here, SAYING] = ((True, quoted), SAYING, 1.0)
            arcs[here, QUOTE] = ((said, not quoted), QUOTE, 1.0)
            arcs[here, END] = ((False, False), END, 1.0)
    return Transducer((False, False), arcs)


def compose(machines: list[Transducer]) -> tuple[list[list[int]], list[list[int]], list[list[float]]]:
    """One machine that feeds each symbol through all: next states, symbols written and factors, by state and symbol.
    State 0 is the start."""
    states = {tuple(m.start for m in machines): 0}
    todo, after, written, factors = list(states), [], [], []
    for state in todo:  # grows while it is walked
        rows = ([], [], [])
        for symbol in READ:
            into, factor, to = symbol, 1.0, []
            for machine, at in zip(machines, state, strict=True):
                next_at, into, f = machine.step(at, into)
                to.append(next_at)
                factor *= f
            to = tuple(to)
            if to not in states:
                states[to] = len(states)
                todo.append(to)
            for row, value in zip(rows, (states[to], into, factor), strict=True):
                row.append(value)
        for part, row in zip((after, written, factors), rows, strict=True):
            part.append(row)
    return after, written, factors


# ---- lexicon and text


class Lexicon(dict):
    """Words to their symbol, or to ``INSULT + weight`` for insults; learned word by word as texts are read."""

    ROOM = 1 << 20  # words remembered

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights
        self.fixed = {w: symbol for symbol, words in WORDS.items() for w in words.split()}
        self.fixed |= dict.fromkeys(",()", PAUSE) | dict.fromkeys(ENDS, END) | dict.fromkeys('"“”„«»', QUOTE)

    def __missing__(self, token: str) -> float:
        word = token.lower()
        weight = max((self.weights[f] for f in shapes(word) if f in self.weights), default=0.0)
        value = INSULT + weight if weight > 0 else self.fixed.get(word, OTHER)
        if len(self) >= self.ROOM:
            self.clear()
        self[token] = value
        return value


def shapes(word: str) -> list[str]:
    """What may stand for a word in the lexicon: itself, and its beginnings with a star."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


class Grammar:
    """The composed machine over a lexicon."""

    def __init__(self, weights: dict[str, float]):
        self.lexicon = Lexicon(weights)
        self.after, self.written, self.factors = compose([threats(), aimed(), negated(), reported()])

    def clauses(self, text: str | None) -> list[tuple[int, int, float]]:
        """``start, end, weight`` of every clause with a match, in characters; clauses end with the sentence."""
        out, state, base = [], 0, 0
        begin = since = weight = 0  # of the clause that is being read; ``since``: words since the last match
        for slab in slabs((text or "").encode("utf-8", "replace")):
            part = slab.decode()
            values = [self.lexicon[t] for t in TOKEN.findall(part)]
            if not weight and max(values, default=OTHER) < HARM:  # nothing to match: only the state goes on
                last = 0
                if END in values:
                    last = len(values) - 1 - values[::-1].index(END)
                    begin = base + max(map(part.rfind, ENDS)) + 1
                for value in values[last:]:
                    state = self.after[state][value]
            else:
                for token, value in zip(TOKEN.finditer(part), values, strict=True):
                    symbol = INSULT if value > INSULT else value
                    written, factor = self.written[state][symbol], self.factors[state][symbol]
                    state = self.after[state][symbol]
                    since += 1
                    if written == INSULT:
                        weight, since = weight + factor * (value - INSULT), 0
                    elif written == THREAT:
                        weight, since = weight + factor * THREAT_WEIGHT, 0
                    elif written == TARGET and weight and since <= NEAR:
                        weight, since = weight + AIMED - 1, NEAR  # "idiots, all of you"
                    elif symbol == END:
                        if weight:
                            out.append((begin, base + token.start(), weight))
                        begin, weight = base + token.end(), 0
            base += len(part)
        if weight:
            out.append((begin, base, weight))
        return out


def evidence(clauses: list[tuple[int, int, float]]) -> float:
    return math.log1p(sum(weight for _, _, weight in clauses))


# ---- learning


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    slope: float
    shift: float


def log_odds(toxic, other, toxic_texts: int, other_texts: int):
    """Smoothed log-odds ratio of being in a toxic text, and its standard error."""
    ratio = np.log((toxic + 0.5) / (toxic_texts + 1)) - np.log((other + 0.5) / (other_texts + 1))
    return ratio, np.sqrt(1 / (toxic + 0.5) + 1 / (other + 0.5))


def significant(toxic: pd.Series, other: pd.Series, texts: dict[int, int]) -> np.ndarray:
    """Log-odds ratios, 0 where they are small or within the noise."""
    ratio, error = log_odds(toxic.to_numpy(float), other.to_numpy(float), texts.get(1, 0), texts.get(0, 0))
    return np.where((ratio >= TELLING) & (ratio >= SIGNIFICANT * error), ratio, 0.0)


def frequencies(frames: Iterator[pd.DataFrame], room: int = 1 << 18) -> Iterator[pd.DataFrame]:
    """``shape, y, n``: in how many texts of a class each word and word beginning occurs; partial counts."""
    counts = Counter()

    def flush():
        rows = [(shape, y, n) for (shape, y), n in counts.items()]
        counts.clear()
        return pd.DataFrame(rows, columns=["shape", "y", "n"])

    for frame in frames:
        for y, text in zip(frame["y"], frame["text"], strict=True):
            found = set()
            for word in {w for part in sequences(text) for w in part}:
                found.update(shapes(word))
            for shape in found:
                counts[shape, y] += 1
            if len(counts) > room:
                yield flush()
    yield flush()


def sequences(text: str) -> Iterator[list[str]]:
    """The words of a text, in lists of bounded length."""
    for slab in slabs(text.encode("utf-8", "replace")):
        yield [t.lower() for t in TOKEN.findall(slab.decode()) if t[0].isalnum()]


def contexts(frames: Iterator[pd.DataFrame], candidates: set[str]) -> Iterator[pd.DataFrame]:
    """``shape, y, context, word``: every candidate with a hash of the words on either side of it."""
    for frame in frames:
        out = set()
        for y, text in zip(frame["y"], frame["text"], strict=True):
            for tokens in sequences(text):
                for i, token in enumerate(tokens):
                    for shape in shapes(token):
                        if shape in candidates:
                            beside = "\0".join((*tokens[max(i - 1, 0) : i], "", *tokens[i + 1 : i + 2]))
                            out.add((shape, y, xxhash.xxh64_intdigest(beside) >> 1, token if shape != token else ""))
        yield pd.DataFrame(list(out), columns=["shape", "y", "context", "word"])


def sample(docs: DataFrame, labels: DataFrame, label: str, text: str, limits: dict[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """Distinct labelled texts, ``y, hash, text``: per class those with the smallest hashes; and all texts by class."""
    known = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).cast("int").alias("y"))
    known = narrow(settle(known))
    named = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    distinct = named.select("doc_id", "hash").join(known, "doc_id").select("y", "hash").distinct()
    counts = {r["y"]: r["count"] for r in distinct.groupBy("y").count().collect()}
    # hashes are even, so a class's share of their range holds about as many texts as wanted
    span = 1 << 64
    upto = {y: min(span // 2 - 1, -span // 2 + span * limits[y] // n) for y, n in counts.items()}
    if not upto:
        return None, {}
    drawn = named.where(f"hash <= {max(upto.values())}L").join(known, "doc_id")
    drawn = drawn.where(" OR ".join(f"y = {y} AND hash <= {u}L" for y, u in sorted(upto.items())))
    return settle(drawn.groupBy("y", "hash").agg(F.any_value("text").alias("text"))), counts


def learn_lexicon(taught: DataFrame, texts: dict[int, int]) -> dict[str, float]:
    """Weights of words and word beginnings; ``taught`` holds ``y, text`` and ``texts`` how many there are per class."""
    by_class = [F.sum(F.expr(f"if(y = {y}, n, 0)")).alias(name) for y, name in ((1, "toxic"), (0, "other"))]
    counts = taught.select("y", "text").mapInPandas(frequencies, "shape string, y int, n bigint").groupBy("shape").agg(*by_class)
    ratio = f"ln((toxic + 0.5) / {texts.get(1, 0) + 1}) - ln((other + 0.5) / {texts.get(0, 0) + 1})"
    told = counts.where("toxic >= 3").withColumn("ratio", F.expr(ratio)).withColumn(
        "z",
        F.expr("ratio / sqrt(1 / (toxic + 0.5) + 1 / (other + 0.5))"),
    )
    # at most the words of the sample divided by three
    candidates = {r.shape for r in told.where(f"z >= {SIGNIFICANT} AND ratio >= {TELLING}").select("shape").collect()} | set(INSULTS.split())
    beside = taught.select("y", "text").mapInPandas(
        lambda frames: contexts(frames, candidates), "shape string, y int, context bigint, word string"
    )
    beside = beside.groupBy("shape", "y").agg(
        F.countDistinct("context").alias("n"), F.countDistinct("word").alias("kinds")
    )
    rows = beside.toPandas()  # two rows per candidate at most
    rows = rows.pivot_table(index="shape", columns="y", values=["n", "kinds"], fill_value=0, aggfunc="sum")
    lexicon = pd.DataFrame(index=sorted(candidates))
    for name, column in (("toxic", ("n", 1)), ("other", ("n", 0)), ("kinds", ("kinds", 1))):
        lexicon[name] = rows[column].reindex(lexicon.index).fillna(0) if column in rows else 0
    seeds = lexicon.index.isin(INSULTS.split())
    lexicon["weight"] = np.where(
        seeds,
        log_odds(lexicon["toxic"] + PRIOR, lexicon["other"], texts.get(1, 0), texts.get(0, 0))[0],
        significant(lexicon["toxic"], lexicon["other"], texts),
    )
    stems = lexicon.index.str.endswith("*")
    lexicon = lexicon[(lexicon["weight"] > 0) & (~stems | (lexicon["kinds"] >= KINDS))]
    return lexicon["weight"].to_dict()


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "toxic",
    text: str = "text",
    toxic_texts: int = 2000,
    other_texts: int = 6000,
) -> Model:
    """Learn lexicon and curve from ``label`` (0 or 1) of ``labels`` by ``doc_id`` and the texts of ``docs``."""
    drawn, counts = sample(docs, labels, label, text, {1: toxic_texts, 0: other_texts})
    known = dict.fromkeys(INSULTS.split(), float(np.log(2 * PRIOR + 1)))
    if set(counts) != {0, 1}:
        return Model(known, *UNTAUGHT)
    taught, kept = drawn.where("pmod(hash, 4) <> 3"), drawn.where("pmod(hash, 4) = 3")
    texts = {r["y"]: r["count"] for r in taught.groupBy("y").count().collect()}
    weights = learn_lexicon(taught, texts) if set(texts) == {0, 1} else known
    judged = with_clauses(kept, weights).select("y", "evidence").toPandas()  # a quarter of the sample, two numbers a text
    positive = judged["y"].to_numpy() == 1
    if positive.all() or not positive.any():
        return Model(weights, *UNTAUGHT)
    slope, shift = platt(judged["evidence"].to_numpy(), positive)
    drawn_odds, odds = positive.sum() / (~positive).sum(), counts[1] / counts[0]
    return Model(weights, slope, shift + float(np.log(odds / drawn_odds)))


# ---- scoring


def with_clauses(docs: DataFrame, weights: dict[str, float], *, text: str = "text") -> DataFrame:
    """``docs`` with ``evidence`` and ``clauses``, the matches as ``start, end, weight`` in characters of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("evidence double, clauses array<struct<start:int,end:int,weight:double>>")
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        grammar = Grammar(shared.value)
        for texts in batches:
            found = [grammar.clauses(t) for t in texts]
            rows = [[{"start": a, "end": b, "weight": w} for a, b, w in clauses] for clauses in found]
            yield pd.DataFrame({"evidence": [evidence(c) for c in found], "clauses": rows})

    names = [c for c in docs.columns if c not in ("evidence", "clauses")]
    return docs.select(*map(_quoted, names), match(F.col(_quoted(text))).alias("__found")).select(
        *map(_quoted, names), "__found.evidence", "__found.clauses"
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def with_toxicity(docs: DataFrame, model: Model, *, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of being toxic, ``evidence`` and the matched ``clauses``."""
    found = with_clauses(docs, model.weights, text=text)
    margin = F.col("evidence") * model.slope + model.shift
    return found.withColumn(name, 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), margin)))))


def op13_toxicity(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.expr("coalesce(crc32(encode(cast(doc_id AS string), 'UTF-8')) % 3 = 1, false)")
    model = fit(docs.where(~held_out), table(spark, sf_dir, "labels"))
    scored = with_toxicity(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return scored.select("doc_id", "held_out", "score", F.expr("if(score >= 0.7, 1, 0)").alias("predicted"))
