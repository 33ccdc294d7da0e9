"""Operator 4, quality classifier: a linear support vector machine on n-gram indicators scaled by naive Bayes.

Features are the hashed n-grams (1 to 4) of bytes and of word shapes that occur in a text, whatever their number. Their log-count ratio
between the classes scales them, and a linear hinge-loss model is fitted on top by dual coordinate descent (Wang and
Manning, "Baselines and Bigrams", 2012; Hsieh et al., "A Dual Coordinate Descent Method for Large-scale Linear SVM",
2008). A quarter of the sample is left out of the fit to turn margins into probabilities (Platt scaling).

The model is fitted on a bounded sample: the ``sample_texts`` labelled texts with the smallest hashes per class, whole
texts. The fit is one task over at most ``2 * sample_texts`` sets of at most ``BUCKETS`` features; the model is one
number per bucket, whatever the corpus. Everything else covers all rows.

Defined cases: a null text counts as an empty one, which is scored by the model's constant; a document with several
labels takes the smallest; null labels teach nothing; with no labels every score is 0.5, and with one class only it is
that class's smoothed share (n + 1) / (n + 2). Repeated texts are learned once per class. An empty table gives no rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import narrow, settle, slabs, word_hashes, word_spans

BUCKETS = 1 << 17
MIX = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917), np.uint32(668265263))
SHAPES = 0x5BD1E995  # starts the codes of word shapes, so they differ from those of bytes


class Features:
    """The hashed n-grams of a text, each once: of bytes, and of word shapes.

    A word's shape is whether it has lower-case letters, a capital first, which mark ends it, its length in steps, and
    whether it repeats one of the two words before it.
    """

    def __init__(self, longest: int = 4):
        self.longest = longest
        self.seen = np.zeros(BUCKETS, bool)

    def __call__(self, text: str | None) -> np.ndarray:
        for slab in slabs((text or "").encode()):
            data = np.frombuffer(slab, np.uint8)
            self.mark(data.astype(np.uint32), np.uint32(0))
            starts, ends = word_spans(data)
            if len(starts):
                self.mark(self.shapes(data, starts, ends), np.uint32(SHAPES))
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found.astype(np.int32)

    def mark(self, symbols: np.ndarray, kind: np.uint32) -> None:
        code = np.full(len(symbols), kind, np.uint32)
        for n in range(min(self.longest, len(symbols))):
            code = (code[: len(symbols) - n] + symbols[n:] + np.uint32(1)) * MIX[n]
            self.seen[(code ^ (code >> np.uint32(15))) & np.uint32(BUCKETS - 1)] = True

    @staticmethod
    def shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        small = np.r_[0, np.cumsum((data >= 97) & (data <= 122), dtype=np.int64)]
        has_small = small[ends] > small[starts]
        first, last = data[starts], data[ends - 1]
        capital = (first >= 65) & (first <= 90)
        letter = ((last | 32) >= 97) & ((last | 32) <= 122) | (last >= 128) | (last >= 48) & (last <= 57)
        code = word_hashes(data, starts, ends)
        again = np.zeros(len(code), bool)
        for back in (1, 2):
            again[back:] |= code[back:] == code[:-back]
        length = np.minimum(ends - starts, 31) // 4
        mark = np.where(letter, 0, last).astype(np.uint32)
        return mark + (has_small * 256 + capital * 512 + again * 1024 + length * 2048).astype(np.uint32)


@dataclass(frozen=True)
class Model:
    """What scoring needs: two numbers per bucket and three for all."""

    weights: np.ndarray  # the classifier's weight times the feature's scale
    squares: np.ndarray  # the scale squared
    constant: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, features: np.ndarray) -> float:
        length = max(float(np.sqrt(self.squares[features].sum())), 1e-12)
        return float(self.weights[features].sum()) / length + self.constant

    def score(self, features: np.ndarray) -> float:
        return float(logistic(self.slope * self.margin(features) + self.shift))


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def log_count_ratio(rows: list[np.ndarray], positive: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """log of how much likelier a feature is in the positive class, with additive smoothing."""
    counts = np.full((2, BUCKETS), smoothing)
    for row, cls in zip(rows, positive.astype(int), strict=True):
        counts[cls, row] += 1
    counts /= counts.sum(axis=1, keepdims=True)
    return np.log(counts[1] / counts[0])


def dual_coordinate_descent(
    rows: list[np.ndarray], target: np.ndarray, scale: np.ndarray, *, cost: float = 1.0, epochs: int = 20, seed: int = 0
) -> tuple[np.ndarray, float]:
    """Weights and constant that minimise |w|^2 / 2 + cost * sum of hinge losses. Each text's scaled features are
    brought to length 1, so long texts do not outweigh short ones."""
    values = [scale[row] for row in rows]
    values = [v / max(np.linalg.norm(v), 1e-12) for v in values]
    weights, constant, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    lengths = [float((v * v).sum()) + 1 for v in values]
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in random.permutation(len(rows)):
            row, value, y = rows[i], values[i], target[i]
            gradient = y * ((weights[row] * value).sum() + constant) - 1
            new = min(max(alpha[i] - gradient / lengths[i], 0.0), cost)
            if new != alpha[i]:
                step = (new - alpha[i]) * y
                weights[row] += step * value
                constant += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return weights, constant


def platt(margins: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through margins, by damped Newton steps, with Platt's smoothed targets."""
    up, down = positive.sum(), (~positive).sum()
    want = np.where(positive, (up + 1) / (up + 2), 1 / (down + 2))
    slope, shift = 1.0, 0.0
    for _ in range(100):
        p = logistic(slope * margins + shift)
        error, spread = p - want, np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([error @ margins, error.sum()])
        curve = np.array([[spread @ margins**2, spread @ margins], [spread @ margins, spread.sum()]]) + 1e-6 * np.eye(2)
        step = np.clip(np.linalg.solve(curve, gradient), -2, 2)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(shift)


def fit_rows(rows: list[np.ndarray], positive: np.ndarray) -> Model:
    """A model from feature sets and classes."""
    up = int(positive.sum())
    if up in (0, len(rows)):
        share = (up + 1) / (len(rows) + 2)
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 1.0, float(np.log(share / (1 - share))))
    checked = np.zeros(len(rows), bool)
    for cls in (True, False):  # every fourth of either class, if there are at least eight
        members = np.flatnonzero(positive == cls)
        checked[members[3::4] if len(members) >= 8 else []] = True
    if not (checked & positive).any() or not (checked & ~positive).any():
        checked[:] = False
    used = [r for r, c in zip(rows, checked, strict=True) if not c]
    scale = log_count_ratio(used, positive[~checked])
    weights, constant = dual_coordinate_descent(used, np.where(positive[~checked], 1.0, -1.0), scale)
    model = Model(weights * scale, scale**2, constant)
    judged = checked if checked.any() else ~checked
    margins = np.array([model.margin(r) for r, c in zip(rows, judged, strict=True) if c])
    slope, shift = platt(margins, positive[judged])
    return Model(model.weights, model.squares, constant, slope, shift)


def fit(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", text: str = "text", sample_texts: int = 1500
) -> Model | None:
    """Learn ``label`` (0 or 1) of ``labels`` by ``doc_id`` from the texts of ``docs``; None without any label."""
    known = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).cast("int").alias("y"))
    known = narrow(settle(known))
    named = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    hashed = named.withColumn("hash", F.xxhash64("text"))
    sizes = hashed.select("doc_id", "hash").join(known, "doc_id").select("y", "hash").distinct()
    counts = {r["y"]: r["count"] for r in sizes.groupBy("y").count().collect()}
    if not counts:
        return None
    # hashes are even, so twice the share keeps enough texts and leaves a bounded number to rank
    span = 1 << 64
    upto = {y: min(span // 2 - 1, -span // 2 + span * 2 * sample_texts // n) for y, n in counts.items()}
    # the wider of the two limits goes first, so that only texts that can be drawn meet the labels
    drawn = hashed.where(f"hash <= {max(upto.values())}L").join(known, "doc_id")
    drawn = drawn.where(" OR ".join(f"y = {y} AND hash <= {u}L" for y, u in sorted(upto.items())))

    def featurise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for frame in frames:
            sets = [features(t).tobytes() for t in frame["text"]]
            yield pd.DataFrame({"y": frame["y"], "hash": frame["hash"], "features": sets})

    def train(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["hash", "y"])
        group = group[group.groupby("y").cumcount() < sample_texts]
        rows = [np.frombuffer(b, np.int32) for b in group["features"]]
        model = fit_rows(rows, group["y"].to_numpy() == 1)
        parts = (model.weights.tobytes(), model.squares.tobytes(), model.constant, model.slope, model.shift)
        return pd.DataFrame([parts], columns=["weights", "squares", "constant", "slope", "shift"])

    sets = drawn.dropDuplicates(["y", "hash"]).mapInPandas(featurise, "y int, hash long, features binary")
    row = (
        sets.groupBy(F.lit(0).alias("all"))
        .applyInPandas(train, "weights binary, squares binary, constant double, slope double, shift double")
        .first()
    )
    weights, squares = (np.frombuffer(row[c], np.float64) for c in ("weights", "squares"))
    return Model(weights, squares, row["constant"], row["slope"], row["shift"])


def with_score(docs: DataFrame, model: Model | None, *, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of class 1 as ``name``, which replaces a column of that name."""
    if model is None:
        return docs.withColumn(name, F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features()
        for texts in batches:
            yield pd.Series([shared.value.score(features(t)) for t in texts], dtype="float64")

    return docs.withColumn(name, score(F.col(text)))


def op4_quality_classifier(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.expr("coalesce(crc32(encode(cast(doc_id AS string), 'UTF-8')) % 5 = 0, false)")
    model = fit(docs.where(~held_out), labels)
    scored = with_score(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return scored.select("doc_id", "held_out", "score", F.expr("if(score >= 0.3, 1, 0)").alias("predicted"))
