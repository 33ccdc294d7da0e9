"""A corpus pipeline: raw documents to packed training sequences, in stages that are written and read again.

1. quality: documents that the classifier rejects go.
2. near copies: one document of each SimHash group stays.
3. substrings: passages that an earlier document has said are cut out.
4. benchmark: documents that hold a test item go.
5. packing: what is left becomes sequences of token pieces.

Stages 1 to 4 return the columns of ``documents``; ``n_chars`` follows the text where it changes. The last returns the
rows of :func:`siltline.llm.packing.pack`, with a checksum for the token ids. The operators' docstrings define what
happens to nulls, empty and very long texts, repeated rows and empty tables; a null text is an empty one to the
classifier, and no stage drops a row for being empty.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.llm import contamination, packing, quality, simhash, substrings
from siltline.llm.common import table
from siltline.sources.workspace import scratch

ACCEPTED = 0.3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.with_score(docs, model, name="__quality").where(f"__quality >= {ACCEPTED}").drop("__quality")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.representatives(docs, words=3, max_bits=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substrings.dedup(docs, min_words=20)
    n_chars = F.expr("if(size(removed_spans) > 0, length(text), n_chars)")
    return cut.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, outputs=["crc32(ids) AS ids_crc32"], **packing.public_vocabulary())


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

ORACLE_SQL = None  # trained scores, fingerprints, rolling hashes and token ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
