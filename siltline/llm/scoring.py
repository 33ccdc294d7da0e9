"""Operator 9, language-model scoring: the cross-entropy difference between a target and a background model.

Both are bigram models over one vocabulary, trained on all rows: the target's rows and the others (Moore and Lewis,
"Intelligent Selection of Language Model Training Data", 2010). They are matched: the same vocabulary and cut-offs, the
same smoothing, and the background's counts brought to the target's total. The losses of a text are means per token,
the score is target loss minus background loss: the lower, the more a text is like the target.

Words are lower-case runs between white space. Every word and every pair of words has its own count, however rare, and
the counts come to the texts (:func:`score`). Texts are packed into blocks of a few megabytes. A block sends each distinct
word and pair that it holds once, as 64 bits of a hash with its own counts, to the part of all keys where it belongs: keys
are sorted, so few bytes a key suffice. The part adds up what all blocks sent and answers every block in the order asked,
about a byte a key. A block that has its answers knows the counts of all its words and pairs and scores its texts alone.
No key is hot, since a block sends it once; a text of any length is cut into pieces that know the word before them.
A smaller model of frequent words and pairs alone, in which all other words are one unknown word and other pairs have no
counts, is :func:`fit`.

    p(w)     = (c(w) + k q(w)) / (N + k)          q: the share in both together
    p(w | v) = (c(v w) + m p(w)) / (c(v) + m)     a text's first word follows a start mark

Defined cases: a null or empty text has 0 tokens, losses and score 0; without any target rows, or without others, both
models are the same and all scores are 0; every row counts, copies included (texts are known by 64 bits of a hash); a
null mark means "not target"; an empty table gives no rows. Columns of the names that are added are replaced, others
kept, whatever their names.
"""

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.functions.columns import quoted
from siltline.llm.common import narrow, nested, settle, slabs, stored, table, unnested, word_hashes, word_spans

LOSSES = ("n_tokens", "target_loss", "background_loss", "score")
FLUSH = 1 << 21  # entries gathered by a task before they are combined


def hashed_words(text: str | None) -> Iterator[np.ndarray]:
    """The word hashes of a text, in bounded parts."""
    for slab in slabs((text or "").lower().encode()):
        data = np.frombuffer(slab, np.uint8)
        starts, ends = word_spans(data)
        if len(starts):
            yield word_hashes(data, starts, ends).view(np.int64)


class Tally:
    """Counts per key, for the target and for the rest."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, target: bool) -> None:
        self.parts.append((keys, np.full(len(keys), target)))
        self.size += len(keys)

    def frame(self) -> pd.DataFrame:
        keys = np.concatenate([k for k, _ in self.parts]) if self.parts else np.zeros(0, np.int64)
        marks = np.concatenate([m for _, m in self.parts]) if self.parts else np.zeros(0, bool)
        found, place = np.unique(keys, return_inverse=True)
        both, inside = (np.bincount(place, w, len(found)).astype(np.int64) for w in (None, marks))
        self.__init__()
        return pd.DataFrame({"key": found, "t": inside, "b": both - inside})


def counted(docs: DataFrame, keys_of) -> DataFrame:
    """``key, t, b`` summed over all texts; ``keys_of`` turns a text into arrays of keys."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tally = Tally()
        for frame in frames:
            for text, target in zip(frame["text"], frame["target"], strict=True):
                for keys in keys_of(text):
                    tally.add(keys, bool(target))
                    if tally.size >= FLUSH:
                        yield tally.frame()
        yield tally.frame()

    rows = docs.mapInPandas(count, "key long, t long, b long")
    return rows.groupBy("key").agg(F.sum("t").alias("t"), F.sum("b").alias("b"))


@dataclass(frozen=True)
class Vocabulary:
    hashes: np.ndarray  # sorted; a word's id is its place, then come the unknown word and the start mark

    @property
    def unknown(self) -> int:
        return len(self.hashes)

    @property
    def width(self) -> int:
        return len(self.hashes) + 2

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[place] == hashes, place, self.unknown)

    def pairs(self, text: str | None) -> Iterator[np.ndarray]:
        """Each word together with the one before it, as one number."""
        last = self.unknown + 1
        for hashes in hashed_words(text):
            ids = self.ids(hashes)
            yield np.r_[last, ids[:-1]] * self.width + ids
            last = ids[-1]


@dataclass(frozen=True)
class Model:
    vocabulary: Vocabulary
    pairs: np.ndarray  # sorted keys of the pairs with counts of their own
    pair_loss: np.ndarray  # [2, pairs]: target, background
    word_loss: np.ndarray  # [2, words]: -log p(w)
    back_loss: np.ndarray  # [2, words and marks]: -log of the weight that an unlisted pair leaves to p(w)

    def losses(self, text: str | None) -> tuple[int, float, float]:
        """Tokens, and the mean loss of either model."""
        total, tokens = np.zeros(2), 0
        for keys in self.vocabulary.pairs(text):
            tokens += len(keys)
            before, word = np.divmod(keys, self.vocabulary.width)
            loss = self.word_loss[:, word] + self.back_loss[:, before]
            if len(self.pairs):
                place = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
                listed = self.pairs[place] == keys
                loss = np.where(listed, self.pair_loss[:, place], loss)
            total += loss.sum(axis=1)
        return (tokens, *(total / max(tokens, 1)))


def build(
    vocabulary: Vocabulary, words: np.ndarray, pairs: np.ndarray, counts: np.ndarray, *, k: float = 1.0, m: float = 20.0
) -> Model:
    """``words``: [2, words and unknown] counts; ``counts``: [2, pairs]. Target first, then the rest."""
    words, counts = words.astype(np.float64), counts.astype(np.float64)
    before, word = np.divmod(pairs, vocabulary.width)
    starts = counts[:, before == vocabulary.unknown + 1].sum(axis=1, keepdims=True)
    totals = words.sum(axis=1)
    if not totals.all():  # one side is empty: both models are that of all rows
        words = np.stack([words.sum(axis=0)] * 2)
        counts = np.stack([counts.sum(axis=0)] * 2)
        starts = np.stack([starts.sum(axis=0)] * 2)
        totals = words.sum(axis=1)
    scale = np.array([1.0, totals[0] / max(totals[1], 1.0)])[:, None]
    words, counts = words * scale, counts * scale
    share = words.sum(axis=0) / max(words.sum(), 1.0)
    mass = max(words[0].sum(), 1.0)
    p = (words + k * mass * share) / (mass * (1 + k))
    with np.errstate(divide="ignore"):
        word_loss = -np.log(p)
    word_loss[~np.isfinite(word_loss)] = 0.0  # a word that never occurs is never asked for
    context = np.concatenate([words, starts * scale], axis=1)  # and the start mark
    pair_loss = -np.log((counts + m * p[:, word]) / (context[:, before] + m)) if len(pairs) else counts
    return Model(vocabulary, pairs, pair_loss, word_loss, -np.log(m / (context + m)))


def fit(docs: DataFrame, *, min_share: float = 1e-5, min_pair_share: float = 2e-6) -> Model:
    """A model of the words and pairs that make up these shares of all tokens, from ``text`` and ``target`` (boolean) of
    all rows."""
    marked = marked_texts(docs)
    words = settle(counted(marked, hashed_words))
    totals = words.agg(F.sum("t"), F.sum("b")).first()
    n = sum(x or 0 for x in totals)
    listed = words.where(f"t + b >= {min_share * n!r}").toArrow().sort_by("key")  # at most 1 / min_share
    vocabulary = Vocabulary(listed["key"].to_numpy())
    known = np.stack([listed["t"].to_numpy(), listed["b"].to_numpy()])
    rest = np.array([[(t or 0)] for t in totals]) - known.sum(axis=1, keepdims=True)
    shared = marked.sparkSession.sparkContext.broadcast(vocabulary)
    pairs = counted(marked, lambda text: shared.value.pairs(text))
    frequent = pairs.where(f"t + b >= {min_pair_share * n!r}").toArrow().sort_by("key")
    counts = np.stack([frequent["t"].to_numpy(), frequent["b"].to_numpy()])
    return build(vocabulary, np.concatenate([known, rest], axis=1), frequent["key"].to_numpy(), counts)


def marked_texts(docs: DataFrame) -> DataFrame:
    return docs.select("text", F.coalesce("target", F.lit(False)).alias("target")).where("text IS NOT NULL")


def with_losses(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens, target_loss, background_loss, score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("n_tokens long, target_loss double, background_loss double")
    def score(texts: pd.Series) -> pd.DataFrame:
        rows = [shared.value.losses(t) for t in texts]
        return pd.DataFrame(rows, columns=["n_tokens", "target_loss", "background_loss"])

    rows = nested(docs, loss=score(F.col(text)))
    means = [F.col(f"loss.{c}") for c in LOSSES[:3]]
    return unnested(rows, docs.columns, dict(zip(LOSSES, (*means, means[1] - means[2]), strict=True)))


# ---- counts of everything


PART_BYTES = 8 << 20  # of text for each part of the keys
START = np.uint64(0x5EED)  # the word before a text's first


def mixed(first: np.ndarray, second: np.ndarray | np.uint64) -> np.ndarray:
    """64 bits of a hash of two numbers."""
    code = first * np.uint64(0x9E3779B97F4A7C15) + second * np.uint64(0xC2B2AE3D27D4EB4F)
    code ^= code >> np.uint64(29)
    code *= np.uint64(0xBF58476D1CE4E5B9)
    return code ^ (code >> np.uint64(32))


def packed(frames: Iterator[pd.DataFrame], block_bytes: int) -> Iterator[pd.DataFrame]:
    """Texts to blocks of pieces, each with its text's hash and mark, its number, and the word before it."""
    names = ["block", "docs", "numbers", "befores", "marks", "lengths", "pieces", "t", "b", "bytes"]
    rows, size = [], 0

    def block() -> pd.DataFrame:
        docs, numbers, befores, marks, pieces, words = map(list, zip(*rows, strict=True))
        tokens = [sum(n for n, mark in zip(words, marks, strict=True) if mark is side) for side in (True, False)]
        held = zstandard.compress(b"".join(pieces), 3)
        row = (uuid.uuid4().int >> 66, docs, numbers, befores, marks, list(map(len, pieces)), held, *tokens, size)
        return pd.DataFrame([row], columns=names)

    for frame in frames:
        for doc, text, target in zip(frame["doc"], frame["text"], frame["target"], strict=True):
            before = int(START)
            for number, slab in enumerate(slabs(text.lower().encode())):
                starts, ends = word_spans(np.frombuffer(slab, np.uint8))
                rows.append((doc, number, before, bool(target), slab, len(starts)))
                if len(starts):
                    last = np.frombuffer(slab[starts[-1] : ends[-1]], np.uint8)
                    before = int(word_hashes(last, np.array([0]), np.array([len(last)]))[0].view(np.int64))
                size += len(slab)
                if size >= block_bytes:
                    yield block()
                    rows, size = [], 0
    if rows:
        yield block()


class Keys:
    """The distinct words and pairs of a block, and where each token's are among them."""

    def __init__(self, row):
        words, before, place, at = [], [], [], 0
        text = np.frombuffer(zstandard.decompress(row.pieces), np.uint8)
        for i, (length, previous) in enumerate(zip(row.lengths, row.befores, strict=True)):
            data = text[at : at + length]
            at += length
            own = word_hashes(data, *word_spans(data))
            words.append(own)
            before.append(np.r_[np.int64(previous).astype(np.uint64), own[:-1]][: len(own)])
            place.append(np.full(len(own), i, np.int32))
        words, before, self.piece = map(np.concatenate, (words, before, place))
        marks = np.array(row.marks, bool)
        self.words, self.word = np.unique(words, return_inverse=True)
        # the words before are words of the block, the start, or the last word of an earlier piece
        self.contexts, context = np.unique(np.r_[self.words, before], return_inverse=True)
        own, context = context[: len(self.words)], context[len(self.words) :]
        pairs, self.pair = np.unique(context * np.int64(len(self.words)) + self.word, return_inverse=True)
        self.pair_context, self.pair_word = np.divmod(pairs, max(len(self.words), 1))
        self.word_context = own  # the place of each word among the contexts
        keys = np.r_[mixed(self.contexts, np.uint64(1)), mixed(mixed(self.contexts, np.uint64(2))[self.pair_context], self.words[self.pair_word])]
        target = marks[self.piece]
        size = len(self.contexts)
        inside = np.zeros((2, len(keys)), np.int64)
        for side, weight in enumerate((target, ~target)):
            inside[side, :size] = np.bincount(own[self.word], weight, size)
            inside[side, size:] = np.bincount(self.pair, weight, len(pairs))
        first = np.flatnonzero((self.contexts == START)[context])
        if len(first):  # a text begins there
            inside[0, np.searchsorted(self.contexts, START)] += target[first].sum()
            inside[1, np.searchsorted(self.contexts, START)] += (~target[first]).sum()
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.counts = keys[self.order], inside[:, self.order]

    def parts(self, bits: int) -> list[tuple[int, slice]]:
        """Runs of keys that begin with the same ``bits``."""
        which = (self.keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(self.keys), np.int64)
        borders = np.r_[0, np.flatnonzero(np.diff(which)) + 1, len(which)]
        return [(int(which[a]), slice(a, b)) for a, b in zip(borders[:-1], borders[1:], strict=True) if b > a]


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Unsigned numbers byte by byte of equal weight, so that the high bytes, mostly zero, compress to little."""
    width = max((int(numbers.max(initial=0)).bit_length() + 7) // 8, 1)
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.compress(planes.tobytes(), 1)


def unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    numbers = np.zeros((planes.shape[1], 8), np.uint8)
    numbers[:, : data[0]] = planes.T
    return numbers.view("<u8").ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as the first one and the steps between them."""
    return keys[:1].tobytes() + pack_numbers(np.diff(keys))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(np.r_[np.frombuffer(data, np.uint64, 1), unpack_numbers(data[8:])], dtype=np.uint64)


def asked(frames: Iterator[pd.DataFrame], bits: int) -> Iterator[pd.DataFrame]:
    """What every block asks of every part: its keys there, with its own counts."""
    for frame in frames:
        for row in frame.itertuples():
            keys = Keys(row)
            rows = [
                (row.block, part, run.stop - run.start, pack_keys(keys.keys[run]), *(pack_numbers(c[run]) for c in keys.counts))
                for part, run in keys.parts(bits)
            ]
            yield pd.DataFrame(rows, columns=["block", "part", "n", "keys", "t", "b"])


def answered(part: pd.DataFrame) -> pd.DataFrame:
    """The counts of all blocks together for the keys of one part, to each block in the order it asked."""
    found, place = np.unique(np.concatenate([unpack_keys(k) for k in part["keys"]]), return_inverse=True)
    ends = np.cumsum(part["n"].to_numpy())
    out = {"block": part["block"], "part": part["part"]}
    for side in ("t", "b"):
        own = np.concatenate([unpack_numbers(c) for c in part[side]]).astype(np.int64)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, place, own)
        total = total[place]
        out[side] = [pack_numbers(total[end - n : end]) for end, n in zip(ends, part["n"], strict=True)]
    return pd.DataFrame(out)


def piece_losses(frames: Iterator[pd.DataFrame], totals: list[int], k: float, m: float) -> Iterator[pd.DataFrame]:
    """``doc, number, tokens, l0, l1``: the summed losses of every piece of a block that has its answers."""
    one_side = not all(totals)  # then both models are that of all rows
    mass = max(float(sum(totals) if one_side else totals[0]), 1.0)
    scale = 1.0 if one_side else totals[0] / totals[1]
    for frame in frames:
        for row in frame.itertuples():
            keys = Keys(row)
            counts = np.empty((2, len(keys.keys)))
            for side, name in enumerate(("t", "b")):
                parts = [unpack_numbers(a[name]) for a in sorted(row.answers, key=lambda a: a["part"])]
                counts[side, keys.order] = np.concatenate(parts) if parts else []
            if one_side:
                counts[:] = counts.sum(axis=0)
            counts[1] *= scale
            context, pair = counts[:, : len(keys.contexts)], counts[:, len(keys.contexts) :]
            word = context[:, keys.word_context]
            p = (word + k * word.sum(axis=0) / 2) / (mass * (1 + k))
            loss = np.log(context[:, keys.pair_context] + m) - np.log(pair + m * p[:, keys.pair_word])
            n = len(row.lengths)
            sums = [np.bincount(keys.piece, loss[side, keys.pair], n) for side in (0, 1)]
            tokens = np.bincount(keys.piece, minlength=n)
            yield pd.DataFrame({"doc": row.docs, "number": row.numbers, "tokens": tokens, "l0": sums[0], "l1": sums[1]})


def score(docs: DataFrame, *, text: str = "text", block_bytes: int = 3 << 20, k: float = 1.0, m: float = 20.0) -> DataFrame:
    """``docs`` with ``n_tokens, target_loss, background_loss, score`` by models with every word and pair of ``docs``,
    which have a column ``target``. The size of blocks changes no result."""
    column = F.col(quoted(text))
    marked = docs.select(column.alias("text"), "target").transform(marked_texts).withColumn("doc", F.xxhash64("text"))
    blocks, _ = stored(
        marked.mapInPandas(
            lambda frames: packed(frames, block_bytes),
            "block long, docs array<long>, numbers array<int>, befores array<long>, marks array<boolean>,"
            " lengths array<int>, pieces binary, t long, b long, bytes long",
        ),
        "blocks",
    )
    *totals, size = (int(x or 0) for x in blocks.agg(F.sum("t"), F.sum("b"), F.sum("bytes")).first())
    bits = (size // PART_BYTES).bit_length()
    pieces = blocks.drop("t", "b", "bytes")
    answers = (
        pieces.mapInPandas(lambda frames: asked(frames, bits), "block long, part long, n int, keys binary, t binary, b binary")
        .groupBy("part")
        .applyInPandas(answered, "block long, part long, t binary, b binary")
    )
    # a block has one answer of each part, a few bytes a key of its own
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("part", "t", "b")).alias("answers"))
    lost = pieces.join(answers, "block").mapInPandas(
        lambda frames: piece_losses(frames, totals, k, m), "doc long, number int, tokens long, l0 double, l1 double"
    )
    # copies of a text have equal pieces
    sums = lost.groupBy("doc", "number").agg(*[F.any_value(c).alias(c) for c in ("tokens", "l0", "l1")])
    sums = settle(sums.groupBy("doc").agg(*[F.sum(c).alias(c) for c in ("tokens", "l0", "l1")]))
    met = nested(docs, doc=F.xxhash64(column)).join(sums.withColumnRenamed("doc", "own"), F.expr("doc = own"), "left")
    losses = [F.expr(f"coalesce({c} / greatest(tokens, 1L), 0D)") for c in ("l0", "l1")]
    added = dict(zip(LOSSES, (F.expr("coalesce(tokens, 0L)"), *losses, losses[0] - losses[1]), strict=True))
    return unnested(met, docs.columns, added)


def op9_lm_scoring(spark, sf_dir) -> DataFrame:
    """Target: documents labelled as good. Background: all others."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct()
    good = narrow(settle(good.withColumn("target", F.lit(True))))
    return score(docs.join(good, "doc_id", "left")).drop("text", "target")
