"""Operator 1, language identification by compression with one zstandard dictionary per language.

A language's model is raw text in lower case, given to zstandard as a raw-content dictionary. A text is cut into pieces of
``piece_bytes`` and every piece is compressed with every dictionary; the language whose dictionary makes the whole text
smallest wins. Pieces keep the dictionaries in use throughout a long text. The margin by which the winner beats the
second, as a share of the second's size, is the score; below ``min_margin`` the text is marked as rejected.

The dictionaries are fitted on a bounded sample: ``sample_texts`` distinct texts per language, the ones with the
smallest hashes, and of each ``slices`` slices of ``slice_chars`` characters spread evenly over the whole text. All
else covers all rows. Languages are counted first; more than ``MOST_LANGUAGES`` distinct ones are refused.

Defined cases: a null text or one without a letter is ``und`` with score 0; without any learned language all texts
are; with a single one the score is 1; a tie goes to the language that comes first in the alphabet, with score 0. Rows
with a null language or text teach nothing. An empty table gives no rows.
"""

from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltline.functions.columns import quoted
from siltline.llm.common import nested, unnested

MOST_LANGUAGES = 1000
UNDETERMINED = "und"


def fit(
    labelled: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    sample_texts: int = 96,
    slices: int = 4,
    slice_chars: int = 128,
) -> dict[str, bytes]:
    """Dictionary content per language; about ``sample_texts * slices * slice_chars`` characters each."""
    known = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("hash"))
    known = known.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = known.select("lang", "hash").distinct().groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return {}
    # hashes are even, so twice the share keeps enough texts and leaves a bounded number to rank
    span = 1 << 64
    limits = [(r["lang"], min(span // 2 - 1, -span // 2 + span * 2 * sample_texts // r["count"])) for r in sizes]
    limit = known.sparkSession.createDataFrame(limits, "lang string, upto long")
    drawn = known.join(F.broadcast(limit), "lang").where("hash <= upto").dropDuplicates(["lang", "hash"])
    by_hash = Window.partitionBy("lang").orderBy("hash")
    spread = F.expr(
        f"transform(sequence(0, {slices - 1}), i -> substring(text, cast(i * length(text) / {slices} AS int) + 1,"
        f" {slice_chars}))"
    )
    chosen = drawn.select("lang", "hash", spread.alias("slices")).withColumn("nth", F.row_number().over(by_hash))
    rows = chosen.where(f"nth <= {sample_texts}").orderBy("lang", "nth").collect()
    content: dict[str, list[str]] = {}
    for r in rows:
        content.setdefault(r["lang"], []).extend(r["slices"])
    return {name: "\n".join(found).lower().encode() for name, found in sorted(content.items())}


class Classifier:
    def __init__(self, content: dict[str, bytes], level: int, piece_bytes: int):
        self.names, self.piece_bytes = sorted(content), piece_bytes
        self.coders = []
        for name in self.names:
            words = zstandard.ZstdCompressionDict(content[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=level)
            coder = zstandard.ZstdCompressor(dict_data=words, level=level, write_content_size=False)
            self.coders.append(coder.compress)

    def __call__(self, text: str | None) -> tuple[str, float]:
        if not self.names or not text or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        if len(self.names) == 1:
            return self.names[0], 1.0
        data, step = text.lower().encode(), self.piece_bytes
        totals = [0] * len(self.names)
        for at in range(0, len(data), step):
            piece = data[at : at + step]
            totals = [n + len(compress(piece)) for n, compress in zip(totals, self.coders, strict=True)]
        best, second = sorted(totals)[:2]
        return self.names[totals.index(best)], (second - best) / second


@lru_cache(maxsize=4)
def classifier(content: tuple[tuple[str, bytes], ...], level: int, piece_bytes: int) -> Classifier:
    return Classifier(dict(content), level, piece_bytes)


def identify(
    docs: DataFrame,
    content: dict[str, bytes],
    *,
    text: str = "text",
    min_margin: float = 0.01,
    level: int = 6,
    piece_bytes: int = 2048,
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` (no language, or a margin below ``min_margin``), which
    replace columns of these names; all others are kept, whatever their names."""
    model = docs.sparkSession.sparkContext.broadcast(tuple(sorted(content.items())))

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found = map(classifier(model.value, level, piece_bytes), texts)
        return pd.DataFrame(list(found), columns=["lang_pred", "score"])

    rows = nested(docs, guess=predict(F.col(quoted(text))))
    unsure = F.expr(f"guess.lang_pred = '{UNDETERMINED}' OR guess.score < {min_margin}")
    added = {"lang_pred": F.col("guess.lang_pred"), "score": F.col("guess.score"), "rejected": unsure}
    return unnested(rows, docs.columns, added)


def op1_language_id(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.expr("coalesce(crc32(encode(cast(doc_id AS string), 'UTF-8')) % 3 = 1, false)")
    model = fit(docs.where(~held_out))
    marked = docs.select("doc_id", "text", held_out.alias("held_out"))
    return identify(marked, model).select("doc_id", "held_out", "lang_pred", "score", "rejected")
