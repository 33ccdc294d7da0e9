"""Operator 6, embedding near-dedup: int8 tile products with error bounds, exact recomputation where they leave doubt.

Vectors of a label are dealt to blocks (4,096 vectors of 64 components) and every pair of blocks is one task's tile, in
which strips of 1,024 are multiplied. Vectors travel in the type they have, once per block of their label, since the
pairs in doubt are computed again where they are found: sending such pairs to their vectors would list them. A vector
x of length 1 is kept as ``scale * q + e`` with q in int8 and the length of e known. For two of them

    |x . y - scale_x * scale_y * (q_x . q_y)| <= |e_x| * |scale_y q_y| + |e_y|

so only pairs whose integer product could reach the threshold are computed again, in double precision. The integer
products run as float32 matrix products, which are exact below 2^24 (up to 1,040 components; wider vectors are summed
in slices). A tile emits one row per linked vector and a spanning forest of its links, never its pairs.

Equal vectors of a label are compared once and counted, so copies cost nothing. The work is that of all pairs within a
label, in tiles: exact search in high dimensions has no cheaper way that is sure to lose no link.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and those with a null label,
link with nothing: 0 links, their own component, kept. Vectors of different width are not compared. Rows with equal ids
each get a result. An empty table gives no rows. Other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from siltline.llm.common import components, narrow, settle, spanning

LANES = 1024  # components per exact float32 product: 127 * 127 * 1024 < 2^24
CHUNK = 1 << 16  # pairs recomputed together


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, length of what was rounded away, and length of what was kept, per row."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    kept = codes * scale[:, None]
    return codes, scale, np.linalg.norm(unit - kept, axis=1), np.linalg.norm(kept, axis=1)


def integer_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros((len(a), len(b)))
    for lane in range(0, a.shape[1], LANES):
        part = slice(lane, lane + LANES)
        total += a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
    return total


class Side:
    """The vectors of one side of a tile: scaled, with lengths and codes found once for all strips."""

    def __init__(self, vectors: np.ndarray):
        # a power of two leaves every digit as it is and keeps squares from overflowing or vanishing
        self.rows = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
        self.length = np.linalg.norm(self.rows, axis=1)
        self.codes, self.scale, self.lost, self.kept = quantise(self.rows / self.length[:, None])

    def strips(self, rows: int) -> list[slice]:
        return [slice(at, at + rows) for at in range(0, len(self.rows), rows)]


def near(x: Side, y: Side, s: slice, t: slice, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of x in s and of y in t with cosine at or above the threshold, in double precision."""
    upper = integer_products(x.codes[s], y.codes[t]) * x.scale[s, None] * y.scale[None, t]
    upper += x.lost[s, None] * y.kept[None, t] + y.lost[None, t] + 1e-9  # 1e-9: rounding of these sums themselves
    i, j = np.nonzero(upper >= threshold)
    i, j = i + s.start, j + t.start
    sure = np.zeros(len(i), bool)
    for at in range(0, len(i), CHUNK):
        a, b = i[at : at + CHUNK], j[at : at + CHUNK]
        products = np.einsum("nd,nd->n", x.rows[a], y.rows[b])
        sure[at : at + CHUNK] = products / (x.length[a] * y.length[b]) >= threshold
    return i[sure], j[sure]


def tile_links(tile: pd.DataFrame, threshold: float, strip_rows: int) -> pd.DataFrame:
    """``a, b, n``: per linked vector a, its links within the tile (weighted), and where it hangs in the forest.

    Strips of both sides are multiplied one by one and each leaves a forest, so the pairs of one strip are the most
    that is held at once.
    """
    low, high = tile["low"].iloc[0], tile["high"].iloc[0]
    block, node, weight = (tile[c].to_numpy() for c in ("block", "node", "copies"))
    places = [np.flatnonzero(block == low)] if low == high else [np.flatnonzero(block == b) for b in (low, high)]
    sides = [Side(np.stack(tile["vector"].to_numpy()[p]).astype(np.float64)) for p in places if len(p)]
    n, ends = np.zeros(len(tile), np.int64), []
    if len(sides) == len(places):
        x, y = sides[0], sides[-1]
        for s in x.strips(strip_rows):
            for t in y.strips(strip_rows):
                if x is y and t.start < s.start:
                    continue
                i, j = near(x, y, s, t, threshold)
                if x is y and s == t:
                    i, j = i[i < j], j[i < j]
                i, j = places[0][i], places[-1][j]
                np.add.at(n, i, weight[j])
                np.add.at(n, j, weight[i])
                root = spanning(i, j, len(tile))
                hung = np.flatnonzero(root != np.arange(len(tile)))
                ends.append((hung, root[hung]))
    i, j = (np.concatenate([e[k] for e in ends] or [np.zeros(0, np.int64)]) for k in (0, 1))
    root = spanning(i, j, len(tile))
    linked = np.flatnonzero(n)
    return pd.DataFrame({"a": node[linked], "b": node[root[linked]], "n": n[linked]})


def links(vectors: DataFrame, *, threshold: float, block_values: int, strip_rows: int) -> DataFrame:
    """``a, b, n`` from all tiles. ``vectors``: distinct ``node, label, vector, copies``."""
    sizes = vectors.groupBy("label", F.size("vector").alias("width")).count()
    blocks = f"cast(ceil(count / greatest({strip_rows}, {block_values} div width)) AS int) AS blocks"
    blocks = sizes.selectExpr("label", "width", blocks)
    dealt = vectors.withColumn("width", F.size("vector")).join(narrow(settle(blocks)), ["label", "width"])
    dealt = dealt.withColumn("block", F.expr("cast(pmod(xxhash64(node), blocks) AS int)"))
    tiles = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).selectExpr(
        "node", "vector", "copies", "label", "width", "block", "least(block, other) AS low", "greatest(block, other) AS high"
    )
    return tiles.groupBy("label", "width", "low", "high").applyInPandas(
        lambda tile: tile_links(tile, threshold, strip_rows), "a long, b long, n long"
    )


def near_duplicates(
    rows: DataFrame,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = 0.98,
    block_values: int = 1 << 18,
    strip_rows: int = 1024,
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    A block holds about ``block_values`` components, but at least ``strip_rows`` vectors; a task holds two blocks
    and multiplies ``strip_rows`` vectors of either at a time.
    """
    held = rows.select(embedding).schema[0].dataType
    floats = isinstance(held, ArrayType) and isinstance(held.elementType, FloatType)
    kind = "float" if floats else "double"  # a float has one double, so half the bytes lose nothing
    named = rows.select(
        F.col(vec_id).alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.col(embedding).cast(f"array<{kind}>").alias("vector"),
    )
    sound = (
        "label IS NOT NULL AND size(vector) > 0 AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND"
        " abs(x) < double('infinity')) AND exists(vector, x -> x <> 0)"
    )
    marked = named.withColumn("sound", F.coalesce(F.expr(sound), F.lit(False)))
    plain = marked.where("sound").select("vec_id", "label", F.expr(f"transform(vector, x -> x + cast(0 AS {kind}))").alias("vector"))
    distinct = plain.groupBy("label", "vector").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))
    distinct = settle(distinct.withColumn("node", F.monotonically_increasing_id()))
    found = settle(links(distinct, threshold=threshold, block_values=block_values, strip_rows=strip_rows))
    counted = found.groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "node")
    groups = components(found.select("a", "b"))
    placed = (
        distinct.join(counted, "node", "left")
        .join(groups, "node", "left")
        .selectExpr("label", "vector", "low", "coalesce(n, 0) + copies - 1 AS n_links", "coalesce(component, node) AS component")
    )
    least = settle(placed.groupBy("component").agg(F.min("low").alias("component_id")))
    owner = placed.join(least, "component").select("label", "vector", "n_links", "component_id")
    linked = plain.join(owner, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = marked.where("NOT sound").selectExpr("vec_id", "0L AS n_links", "vec_id AS component_id")
    return linked.unionByName(alone).withColumn("kept", F.expr("vec_id <=> component_id"))


def op6_embedding_near_dedup(spark, sf_dir) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP6_SQL = """
WITH RECURSIVE rows AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
sound AS (
  SELECT * FROM rows
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) >= 0.98),
reach AS (
  SELECT vec_id, vec_id AS other FROM rows
  UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.other = links.a),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
degree AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN degree USING (vec_id)
"""
