"""Operator 10, benchmark decontamination: MinHash containment search by size partitions, verified exactly.

Test items are partitioned by their number of shingles, up to 8, 16, 32 and so on. An item's signature are its smallest
shingle hashes, and each partition has a signature length and a number of matches that make a candidate of its own
(:func:`partitions`). Items of up to 8 shingles are looked up by all of them. Beyond, larger items must match in more
places, since a longer text meets more passages by chance, and the signature is as long as that takes for a pair at the
threshold to be missed at most once in ``1 / miss`` cases. Items that a partition's signature covers whole are found for
certain.

A document holds a share c of an item's shingles if and only if it holds about the share c of its signature, whatever
the document's own size, so signatures are looked up among the hashed shingles of whole documents (a signature of the
*document* would have to grow with it to see a short item at all). A document meets only the partitions whose items it
is large enough to hold. Candidates are verified on the text: the share of the item's distinct shingles that stand in
the document.

Words are runs of letters and digits, in lower case; shingles take ``words`` of them, and a shorter item is one shingle.
Everything is DataFrame functions. Signatures and candidates are broadcast only if they are counted and few
(``common.narrow``); otherwise the same joins shuffle.

Defined cases: null texts, and items without a word, match nothing; equal (id, text) rows count as one, on both sides;
ids may be null or shared by different texts; an empty table on either side gives no rows; other columns are ignored, and
kept by :func:`decontaminate`, whatever their names.
"""

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.functions import columns as fx
from siltline.llm.common import narrow, settle, table

SEPARATORS = r"'[^\\p{L}\\p{N}]+'"


def words_of(text: str) -> str:
    return f"array_remove(split(lower({text}), {SEPARATORS}), '')"


def items_of(benchmark: DataFrame, *, item_id: str, text: str, words: int) -> DataFrame:
    """``item, item_id, width, shingles``: the distinct shingles of each item, as text."""
    named = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).where("text IS NOT NULL")
    split = named.distinct().withColumn("w", F.expr(words_of("text"))).where("size(w) > 0")
    wide = split.withColumn("width", F.expr(f"least(size(w), {words})"))
    shingles = "array_distinct(transform(sequence(1, size(w) - width + 1), i -> array_join(slice(w, i, width), ' ')))"
    return wide.select(
        F.struct("item_id", F.xxhash64("text").alias("hash")).alias("item"), "item_id", "width",
        F.expr(shingles).alias("shingles"),
    )


def shingle_hash(width: int, words: str, start: str) -> str:
    return f"xxhash64({', '.join(f'get({words}, {start} + {k})' for k in range(width))})"


@dataclass(frozen=True)
class Partition:
    """Items of ``low`` to ``high`` shingles: the length of their signature and the matches that make a candidate."""

    low: int
    high: int
    length: int
    matches: int | None  # None: the signature is the whole item

    def need(self, threshold: float) -> str:
        """How many matches an item needs, given its ``size`` in shingles."""
        whole = f"cast(ceil(round(size * {threshold!r}D, 9)) AS int)"
        return whole if self.matches is None else f"if(size <= {self.length}, {whole}, {self.matches})"


def sure_matches(length: int, threshold: float, miss: float) -> int:
    """The most matches that ``length`` values of an item at the threshold reach but for a share ``miss`` of cases.

    Matches are counted as if drawn with replacement, which strays further from the mean than a signature does.
    """
    below = 0.0
    for n in range(length + 1):
        below += math.comb(length, n) * threshold**n * (1 - threshold) ** (length - n)
        if below > miss:
            return n
    return length


def partitions(largest: int, threshold: float, miss: float) -> list[Partition]:
    """Partitions for items of up to ``largest`` shingles."""
    out, low, high = [], 1, 8
    while low <= largest:
        wanted = high.bit_length() - 1  # 4 matches up to 16 shingles, one more for every doubling
        length = next((k for k in range(wanted, high) if sure_matches(k, threshold, miss) >= wanted), high)
        out.append(Partition(low, high, length, wanted if high > 8 and length < high else None))
        low, high = high + 1, 2 * high
    return out


def signatures(items: DataFrame, parts: list[Partition], threshold: float, widths: list[int]) -> DataFrame:
    """``hash, item, need, least``: the signature of each item by its partition, how many matches make a candidate, and
    how many shingles a document must have for any item of the partition."""
    by_width = " ".join(
        f"WHEN {n} THEN transform(transform(shingles, s -> split(s, ' ')), a -> {shingle_hash(n, 'a', '0')})"
        for n in widths
    )
    hashed = items.selectExpr("item", f"array_sort(array_distinct(CASE width {by_width} END)) AS hashes", "size(shingles) AS size")
    every = []
    for part in parts:
        own = hashed.where(f"size BETWEEN {part.low} AND {part.high}")
        least = math.ceil(round(part.low * threshold, 9))
        every.append(
            own.selectExpr("item", f"{part.need(threshold)} AS need", f"{least} AS least", f"explode(slice(hashes, 1, {part.length})) AS hash")
        )
    return reduce(DataFrame.unionByName, every)


def candidates(docs: DataFrame, items: DataFrame, *, threshold: float, miss: float) -> DataFrame:
    """``doc, item``: pairs that share enough of the item's signature. ``docs``: ``doc, text``."""
    sizes = items.groupBy("width").agg(F.max(F.size("shingles"))).collect()  # one row per width, 1 to the shingle length
    if not sizes:
        return docs.limit(0).join(items.limit(0).select("item")).select("doc", "item")
    widths, largest = sorted(r[0] for r in sizes), max(r[1] for r in sizes)
    index = narrow(settle(signatures(items, partitions(largest, threshold, miss), threshold, widths)))
    split = docs.select("doc", F.expr(words_of("text")).alias("w"))
    found = None
    for width in widths:
        grams = f"transform(sequence(0, size(w) - {width}), i -> {shingle_hash(width, 'w', 'i')})"
        sized = split.where(f"size(w) >= {width}").selectExpr("doc", "w", f"size(w) - {width - 1} AS grams")
        hashes = sized.select("doc", "grams", F.explode(F.expr(grams)).alias("hash"))
        part = hashes.join(index, "hash").where("grams >= least").drop("grams", "least")
        found = part if found is None else found.unionByName(part)
    hits = found.distinct().groupBy("doc", "item", "need").count()
    return hits.where("count >= need").select("doc", "item")


def contained(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    words: int = 5,
    threshold: float = 0.8,
    miss: float = 1e-6,
) -> DataFrame:
    """Pairs of a document and an item that it holds: ``doc_id, text_hash, item_id, shingles, found, containment``.

    ``miss`` bounds the share of pairs at the threshold that the search may overlook."""
    named = docs.select(
        F.struct(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("hash")).alias("doc"),
        F.col(text).alias("text"),
    ).where("text IS NOT NULL")
    items = items_of(benchmark, item_id=item_id, text=item_text, words=words)
    pairs = settle(candidates(named, items, threshold=threshold, miss=miss))
    wanted = narrow(pairs.select("doc").distinct())
    texts = named.join(wanted, "doc", "left_semi").dropDuplicates(["doc"])
    texts = texts.select("doc", F.expr(f"concat(' ', array_join({words_of('text')}, ' '), ' ')").alias("line"))
    checked = pairs.join(items, "item").join(texts, "doc")
    checked = checked.withColumn("found", F.expr("size(filter(shingles, s -> contains(line, concat(' ', s, ' '))))"))
    checked = checked.withColumn("containment", F.expr("found / size(shingles)"))
    return checked.where(f"containment >= {threshold}").selectExpr(
        "doc.doc_id", "doc.hash AS text_hash", "item_id", "size(shingles) AS shingles", "found", "containment"
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold an item. Columns and all other rows stay as they are."""
    found = settle(contained(docs, benchmark, **options).select("doc_id", "text_hash").distinct())
    key, text = (fx.quoted(options.get(c, c)) for c in ("doc_id", "text"))
    # the rows travel as one struct, so no name of theirs can clash with the keys
    rows = docs.select(F.struct("*").alias("row"), F.expr(key).alias("doc_id"), F.expr(f"xxhash64({text})").alias("text_hash"))
    bad = narrow(found).selectExpr("doc_id AS bad_id", "text_hash AS bad_hash")
    return rows.join(bad, F.expr("doc_id <=> bad_id AND text_hash = bad_hash"), "left_anti").select("row.*")


def op10_benchmark_decontamination(spark, sf_dir) -> DataFrame:
    found = contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "shingles", "found", "containment")


_WORDS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"

OP10_SQL = f"""
WITH items AS (SELECT DISTINCT item_id, text, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
wide AS (SELECT *, least(len(w), 5) AS width FROM items WHERE len(w) > 0),
wanted AS (
  SELECT DISTINCT item_id, text, width, array_to_string(list_slice(w, i, i + width - 1), ' ') AS s
  FROM (SELECT *, unnest(generate_series(1, len(w) - width + 1)) AS i FROM wide)),
sizes AS (SELECT item_id, text, count(*) AS shingles FROM wanted GROUP BY ALL),
split AS (SELECT DISTINCT doc_id, text, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
said AS (
  SELECT DISTINCT doc_id, text, width, array_to_string(list_slice(w, i, i + width - 1), ' ') AS s
  FROM (SELECT *, unnest(generate_series(1, len(w) - width + 1)) AS i
        FROM split, (SELECT DISTINCT width FROM wide) WHERE len(w) >= width))
SELECT doc_id, item_id, CAST(shingles AS INT) AS shingles, CAST(found AS INT) AS found, found / shingles AS containment
FROM (SELECT said.doc_id, said.text AS doc_text, wanted.item_id, wanted.text, count(*) AS found
      FROM said JOIN wanted USING (width, s) GROUP BY ALL) JOIN sizes USING (item_id, text)
WHERE found / shingles >= 0.8
"""
