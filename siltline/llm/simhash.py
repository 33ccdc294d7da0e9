"""Operator 8, SimHash near-dedup: fingerprints linked within a few bits by a Gray-order hierarchical index.

Fingerprints are computed from whole texts, made distinct, and indexed as a tree of *masked bit patterns*. A node is
a mask and the value that all its members share under it. Its free bits are split into ``max_bits + 1`` segments; two
members that differ in at most ``max_bits`` bits agree on one segment at least, so they meet again in a child whose
mask holds that segment, and every group that differs there is skipped without being looked at. Only crowded nodes are
split further, so a group of near copies of any size ends in leaves of at most ``leaf_rows`` members: a node with f
free bits has at most 2^f distinct members. Inside a leaf the members are sorted by Gray rank, which puts similar ones
next to each other; runs of 16 are factored into upper nodes (the bits they share), and pairs of nodes whose shared
bits already differ too often are pruned as a whole.

A leaf emits a spanning forest of what it links, never all pairs. Components are then joined across leaves.

Defined cases: a null or empty text has fingerprint 0, linked like any other; fewer words than the shingle length are
one shingle; rows with equal ids each get a result; the component of a null id's group is the smallest id that is not
null, or null; an empty table gives no rows. Other columns of the input are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import nested, unnested, components, settle, slabs, spanning

WIDTH = 64
RUN = 16  # members of a run and runs of an upper node
PAIRS = 1 << 22  # pairs looked at together in one task


# ---- fingerprints


def shingle_hashes(text: str | None, words: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of all runs of ``words`` lower-cased words, in bounded parts."""
    carry: list[bytes] = []
    first = True
    digest = xxhash.xxh64_intdigest
    for part in slabs((text or "").encode().lower()):
        tokens = carry + part.split()
        if len(tokens) >= words:
            runs = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
            yield np.fromiter((digest(r, 42) for r in runs), np.uint64, len(tokens) - words + 1)
            first = False
        carry = tokens[len(tokens) - words + 1 :] if len(tokens) >= words and words > 1 else tokens * (words > 1)
    if first and carry:
        yield np.array([digest(b" ".join(carry), 42)], np.uint64)


def fingerprint(text: str | None, words: int = 3) -> int:
    """The fingerprint as a signed 64-bit integer."""
    ones, total = np.zeros(WIDTH, np.int64), 0
    for hashes in shingle_hashes(text, words):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.uint32)
        total += len(hashes)
    return int(np.packbits(2 * ones > total).view(">i8")[0])


def with_fingerprint(docs: DataFrame, *, text: str = "text", words: int = 3, name: str = "fp") -> DataFrame:
    @F.pandas_udf("long")
    def compute(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return docs.withColumn(name, compute(F.col(text)))


# ---- the index


def segments(mask: int, parts: int) -> list[int]:
    """The free bits of ``mask``, from the highest, in ``parts`` even segments; each added to the mask."""
    free = [i for i in range(WIDTH - 1, -1, -1) if not mask >> i & 1]
    return [mask | sum(1 << int(i) for i in part) for part in np.array_split(free, parts) if len(part)]


def signed(x: int) -> int:
    return x - (1 << WIDTH) if x >> (WIDTH - 1) else x


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the order of the reflected Gray code."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def near_pairs(group: np.ndarray, codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of equal ``group`` within ``max_bits``. Rows must be sorted by group, then by Gray rank."""
    # levels[0]: the members; each further level factors runs of RUN nodes of one group
    first, last = np.arange(len(codes)), np.arange(1, len(codes) + 1)
    levels = [(first, last, codes, codes, group)]
    while True:
        _, _, both, some, owner = levels[-1]
        if (owner[1:] != owner[:-1]).all():
            break
        heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        place = np.arange(len(owner)) - np.repeat(heads, np.diff(np.r_[heads, len(owner)]))
        starts = np.flatnonzero(place % RUN == 0)
        ends = np.r_[starts[1:], len(owner)]
        levels.append(
            (starts, ends, np.bitwise_and.reduceat(both, starts), np.bitwise_or.reduceat(some, starts), owner[starts])
        )
    a = b = np.arange(len(levels[-1][0]))  # one top node per group, paired with itself
    for depth in range(len(levels) - 1, 0, -1):
        starts, ends = levels[depth][:2]
        _, _, both, some, _ = levels[depth - 1]
        wide = (ends - starts)[b]
        count = (ends - starts)[a] * wide
        pair = np.repeat(np.arange(len(a)), count)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
        left, right = starts[a][pair] + nth // wide[pair], starts[b][pair] + nth % wide[pair]
        ordered = left <= right if depth > 1 else left < right
        left, right = left[ordered], right[ordered]
        shared = ~(both[left] ^ some[left]) & ~(both[right] ^ some[right])
        close = np.bitwise_count((both[left] ^ both[right]) & shared) <= max_bits
        a, b = left[close], right[close]
    return (a, b) if len(levels) > 1 else (a[:0], b[:0])


def leaf_links(frames: Iterator[pd.DataFrame], max_bits: int) -> Iterator[pd.DataFrame]:
    """A spanning forest of the links in each leaf; rows of a leaf follow each other."""

    def link(fp: np.ndarray, group: np.ndarray) -> pd.DataFrame:
        codes = fp.view(np.uint64)
        order = np.lexsort((gray_rank(codes), group))
        codes, group = codes[order], group[order]
        a, b = near_pairs(group, codes, max_bits)
        root = spanning(a, b, len(codes))
        member = np.flatnonzero(root != np.arange(len(codes)))
        ids = codes.view(np.int64)
        return pd.DataFrame({"a": ids[member], "b": ids[root[member]]})

    def whole(fp: np.ndarray, heads: np.ndarray) -> Iterator[pd.DataFrame]:
        sizes = np.diff(np.r_[heads, len(fp)])
        group = np.repeat(np.arange(len(heads)), sizes)
        bundle = np.cumsum(sizes.astype(np.int64) ** 2) // PAIRS
        for cut in np.unique(bundle):
            rows = bundle[group] == cut
            yield link(fp[rows], group[rows])

    rest = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        mask, value = frame["mask"].to_numpy(), frame["value"].to_numpy()
        if not len(mask):
            continue
        heads = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])])
        rest = frame.iloc[heads[-1] :]
        if len(heads) > 1:
            yield from whole(frame["fp"].to_numpy()[: heads[-1]], heads[:-1])
    if rest is not None and len(rest):
        yield from whole(rest["fp"].to_numpy(), np.array([0]))


def links(fingerprints: DataFrame, *, max_bits: int = 3, leaf_rows: int = 1024) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``) that connect all within ``max_bits``."""
    spark, parts = fingerprints.sparkSession, max_bits + 1
    leaf_rows = max(leaf_rows, 1 << parts)
    masks = segments(0, parts)
    nodes = fingerprints.select(
        "fp", F.explode(F.array(*[F.lit(signed(m)) for m in masks])).alias("mask")
    ).withColumn("value", F.expr("fp & mask"))
    found = []
    while True:
        # settled, so that the joins shuffle anew and Spark can split the rows of a crowded node
        sizes = settle(nodes.groupBy("mask", "value").count().where("count > 1"))
        leaves = nodes.join(sizes.where(f"count <= {leaf_rows}"), ["mask", "value"]).drop("count")
        found.append(leaves)
        crowded = sizes.where(f"count > {leaf_rows}").drop("count")
        if crowded.isEmpty():
            break
        # the table of masks has at most parts^depth rows, and depth ends when 2^free <= leaf_rows
        below = [(signed(m), signed(child)) for m in masks for child in segments(m, parts)]
        step = spark.createDataFrame(below, "mask long, child long")
        nodes = (
            nodes.join(crowded, ["mask", "value"])
            .join(F.broadcast(step), "mask")
            .selectExpr("fp", "child AS mask", "fp & child AS value")
        )
        nodes = settle(nodes)
        masks = sorted({child for m in masks for child in segments(m, parts)})
    leaves = found[0]
    for more in found[1:]:
        leaves = leaves.unionByName(more)
    # settled, so that this shuffle is its own: Spark would keep the join's, whose partitions it may cut or read by mapper
    leaves = settle(leaves)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = leaves.repartition(width, "mask", "value").sortWithinPartitions("mask", "value")
    return dealt.mapInPandas(lambda frames: leaf_links(frames, max_bits), "a long, b long")


def near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 3, max_bits: int = 3
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash`` (64 bits), ``fp``, ``group`` (the smallest fingerprint of its
    group of near copies) and ``component_id`` (the smallest id of the group)."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = with_fingerprint(named.withColumn("text_hash", F.xxhash64("text")), words=words)
    marked = settle(marked.select("doc_id", "text_hash", "fp"))
    distinct = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("low")))
    groups = components(links(distinct.select("fp"), max_bits=max_bits)).withColumnRenamed("node", "fp")
    placed = distinct.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = settle(placed.groupBy("component").agg(F.min("low").alias("component_id")))
    owner = placed.join(least, "component").selectExpr("fp", "component AS group", "component_id")
    return marked.join(owner, "fp").select("doc_id", "text_hash", "fp", "group", "component_id")


def representatives(docs: DataFrame, *, words: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row for each group of near copies: that of the smallest id (of several texts with that id,
    the one with the smallest hash; of equal rows, any). The columns stay as they are."""
    groups = near_duplicates(docs, words=words, max_bits=max_bits)
    keep = groups.where("doc_id <=> component_id").groupBy("group", F.col("component_id").alias("keep_id"))
    keep = keep.agg(F.min("text_hash").alias("keep_hash")).drop("group").distinct()
    rows = nested(docs, doc_id=F.col("doc_id"), text_hash=F.xxhash64("text"))
    kept = rows.join(keep, F.expr("doc_id <=> keep_id AND text_hash = keep_hash"), "left_semi")
    return unnested(kept.dropDuplicates(["doc_id", "text_hash"]), docs.columns, {})


def op8_simhash_near_dedup(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    groups = near_duplicates(docs, words=3, max_bits=3)
    return groups.selectExpr("doc_id", "lpad(lower(hex(fp)), 16, '0') AS fingerprint", "component_id")
