"""Helpers that several operators share: reading, cutting lineage, components, vectorised hashing."""

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.functions.columns import quoted
from siltline.sources.workspace import scratch, shared_folder

BROADCAST_ROWS = 200_000
SPACE = bytes(range(9, 14)) + b" "
_SPACES = re.compile(b"[" + SPACE + b"]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the folder that all executors share. A lost executor costs no recomputation, and
    values that depend on the partition, such as generated ids, stay as they are."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet into a new folder that all executors share, read back, and the folder."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder made by :func:`stored`, once nothing reads it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def narrow(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, of short rows, marked for broadcasting if a count finds at most ``rows``; otherwise joins shuffle it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def nested(docs: DataFrame, **columns) -> DataFrame:
    """``docs`` as one struct ``row`` beside other columns, so that no name in it can clash with theirs."""
    return docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])


def unnested(rows: DataFrame, columns: list[str], added: dict) -> DataFrame:
    """The ``columns`` of ``row`` again, those in ``added`` replaced where they stand, and the others of ``added``."""
    old = [(added[c] if c in added else F.col(f"row.{quoted(c)}")).alias(c) for c in columns]
    return rows.select(*old, *[value.alias(name) for name, value in added.items() if name not in columns])


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index connected to each of ``n`` local nodes by the links ``a[i], b[i]``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links(a, b)``: ``node, component``, the component being its smallest node.

    Alternates two steps until nothing changes: every node hands its larger neighbours, then its smaller ones, to
    its smallest neighbour. Each is one aggregate that combines map-side and one join whose hot side Spark can split,
    so a hub of any degree is never gathered in one task. Rounds grow with the logarithm of the longest path; each
    is settled, so its lineage stays short. Nodes without links are not returned. No links give no rows.
    """
    edges = settle(
        links.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct()
    )
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges.selectExpr("a AS node", "b AS component").union(
                edges.selectExpr("b AS node", "b AS component").distinct()
            )
        state = now
        both = edges.union(edges.selectExpr("b AS a", "a AS b"))
        # settled, so that the join shuffles anew: next to its aggregate Spark would not split a hub's rows
        least = settle(both.groupBy("a").agg(F.min("b").alias("low")).selectExpr("a", "least(a, low) AS low"))
        large = both.join(least, "a").where("b > a").selectExpr("b AS a", "low AS b").distinct()
        least = settle(large.groupBy("a").agg(F.min("b").alias("low")))
        small = large.join(least, "a").selectExpr(
            "explode(array(struct(a, low AS b), struct(b AS a, low AS b))) AS e"
        )
        edges = settle(small.selectExpr("e.a", "e.b").where("a > b").distinct())


def slabs(data: bytes, size: int = 1 << 20):
    """``data`` in parts of about ``size`` bytes that end at white space, so a very long text needs bounded memory."""
    start = 0
    while start < len(data):
        border = _SPACES.search(data, start + size)
        end = border.start() if border else len(data)
        yield data[start:end]
        start = end


_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SPACE)] = False
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        n = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _POWERS[name] = np.cumprod(factors)  # wraps modulo 2^64
    return _POWERS["up"], _POWERS["down"]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a byte array begin and end; words are what stands between ASCII white space."""
    inside = np.r_[False, _IS_WORD[data], False]
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return turns[::2], turns[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, from one pass over all bytes."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    code = (sums[ends] - sums[starts]) * down[starts]
    code ^= code >> np.uint64(32)
    code *= np.uint64(0xD6E8FEB86659FD93)
    return code ^ (code >> np.uint64(32))
