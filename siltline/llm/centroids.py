"""Operator 11, centroid clustering: Lloyd's rounds in exact integers, with heaps of distance gaps.

A vector whose second nearest centroid is farther away than its own keeps its cluster until the centroids have moved by
the difference. So each cluster of a block keeps a heap of its vectors by the gap ``lower - upper`` between the bound of
the second distance and that of the first. When centroids move, no gap is touched: the cluster's own drift, and the
largest drift of any other centroid, are added to one number per cluster, and a vector is due when its gap at the time
it was pushed, plus the number at that time, no longer exceeds the number now. Only due vectors are popped, measured
against all centroids exactly and pushed again (Hamerly and Drake, "Accelerating Lloyd's Algorithm for k-Means
Clustering", 2015, on heap-ordered bounds). Ties are due as well, and rounding is allowed for, so the clusters are those
of the plain algorithm.

Vectors are packed into blocks of up to ``block_rows`` where they lie, without a shuffle, so neither a hot label nor a
hot cluster weighs on a task. A round reads the blocks, writes them again with their heaps and sums, and removes the
round before. To the driver come ``clusters * (width + 1)`` sums a round. A lost executor costs the tasks it ran.

Defined cases: vectors that are null, of another width, or hold null or non-finite components are left out. Rows with
equal ids are clustered one by one; among equal hashes of ids the smaller vector starts the earlier centroid, and a null
id hashes like an empty one. With fewer vectors than clusters every vector starts one. Components are limited to
2^27 / ``scale`` in size, beyond which squared distances would leave a long; a larger one fails the job. Other columns
are ignored, whatever their names. An empty table, or one without such vectors, gives no rows.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import discard, stored, table

LARGEST = 1 << 27  # 4 * LARGEST^2 * 64 components fit in a long
SMALL = 1 << 21  # up to here float64 matrix products of 64 components are exact
SLACK = 1e-9  # relative; far above the rounding of a square root and a few sums
BLOCK = "ids array<{id}>, codes binary, keys binary, order binary, starts binary, sums array<bigint>"


def narrowest(codes: np.ndarray) -> np.ndarray:
    """``codes`` in the smallest integer type that holds them."""
    top = max(int(codes.max(initial=0)), -int(codes.min(initial=0)) - 1)
    return codes.astype(next(t for t in (np.int8, np.int16, np.int32) if top <= np.iinfo(t).max))


def squares(codes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, one row per vector and one column per centroid."""
    codes, centroids = codes.astype(np.int64), centroids.astype(np.int64)
    largest = max(np.abs(codes).max(initial=0), np.abs(centroids).max(initial=0))
    if largest <= SMALL and codes.shape[1] <= 64:
        products = np.rint(codes.astype(np.float64) @ centroids.T.astype(np.float64)).astype(np.int64)
        return (codes**2).sum(axis=1)[:, None] - 2 * products + (centroids**2).sum(axis=1)[None, :]
    return np.stack([((codes - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def nearest(codes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every vector, ties to the smaller number, and a safe gap to the second nearest."""
    all_of = squares(codes, centroids)
    cluster = all_of.argmin(axis=1)
    rows = np.arange(len(codes))
    first = np.sqrt(all_of[rows, cluster].astype(np.float64))
    if len(centroids) == 1:
        return cluster, np.full(len(codes), np.inf)
    all_of[rows, cluster] = np.iinfo(np.int64).max
    second = np.sqrt(all_of.min(axis=1).astype(np.float64))
    return cluster, second - first - SLACK * (second + first + 1)


@dataclass
class Block:
    """Vectors with one heap per cluster. A heap is a run of ``order``; ``keys`` belong to vectors, not to places."""

    codes: np.ndarray
    keys: np.ndarray  # gap when pushed, plus the cluster's drift at that time
    order: np.ndarray
    starts: np.ndarray
    sums: np.ndarray  # clusters x (width + 1): component sums and counts

    @classmethod
    def of(cls, codes: np.ndarray, centroids: np.ndarray) -> "Block":
        k, width = centroids.shape
        block = cls(codes, np.empty(len(codes)), np.empty(0, np.int32), np.zeros(k + 1, np.int32), np.zeros((k, width + 1), np.int64))
        block.push(np.arange(len(codes)), centroids, np.zeros(k), {})
        return block

    @classmethod
    def stored(cls, row, width: int) -> "Block":
        codes = np.frombuffer(row.codes[1:], f"i{row.codes[0]}").reshape(-1, width)
        keys, order, starts = (
            np.frombuffer(b, t) for b, t in ((row.keys, np.float64), (row.order, np.int32), (row.starts, np.int32))
        )
        return cls(codes, keys.copy(), order, starts, np.array(row.sums, np.int64).reshape(-1, width + 1))

    def row(self, ids: list) -> tuple:
        codes = bytes([self.codes.itemsize]) + self.codes.tobytes()
        parts = (self.keys, self.order.astype(np.int32), self.starts.astype(np.int32))
        return (ids, codes, *(p.tobytes() for p in parts), self.sums.ravel().tolist())

    def members(self, cluster: int) -> np.ndarray:
        return self.order[self.starts[cluster] : self.starts[cluster + 1]]

    def advance(self, centroids: np.ndarray, drift: np.ndarray) -> int:
        """Pop what is due under the accumulated ``drift``, measure it and push it again; returns how many were due."""
        due, heaps = [], {}
        for j in range(len(centroids)):
            members = self.members(j)
            if not len(members) or self.keys[members[0]] > drift[j]:
                continue  # the top of the heap has a gap left, so all have
            heap = list(zip(self.keys[members].tolist(), members.tolist(), strict=True))
            popped = []
            while heap and heap[0][0] <= drift[j]:
                popped.append(heapq.heappop(heap)[1])
            heaps[j] = heap
            codes = self.codes[popped].astype(np.int64)
            self.sums[j, :-1] -= codes.sum(axis=0)
            self.sums[j, -1] -= len(popped)
            due += popped
        if due:
            self.push(np.array(due), centroids, drift, heaps)
        return len(due)

    def push(self, which: np.ndarray, centroids: np.ndarray, drift: np.ndarray, heaps: dict[int, list]) -> None:
        cluster, gap = nearest(self.codes[which], centroids)
        self.keys[which] = gap + drift[cluster]
        for j in np.unique(cluster).tolist():
            new = which[cluster == j]
            codes = self.codes[new].astype(np.int64)
            self.sums[j, :-1] += codes.sum(axis=0)
            self.sums[j, -1] += len(new)
            pairs = list(zip(self.keys[new].tolist(), new.tolist(), strict=True))
            heap = heaps.get(j)
            if heap is None:
                members = self.members(j)
                heap = list(zip(self.keys[members].tolist(), members.tolist(), strict=True))
            if len(pairs) * 8 < len(heap):
                for pair in pairs:
                    heapq.heappush(heap, pair)
            else:
                heap += pairs
                heapq.heapify(heap)
            heaps[j] = heap
        runs = [
            np.array([i for _, i in heaps[j]], np.int32) if j in heaps else self.members(j)
            for j in range(len(centroids))
        ]
        self.order = np.concatenate(runs) if runs else np.empty(0, np.int32)
        self.starts = np.cumsum([0, *map(len, runs)]).astype(np.int32)


def quantised(vectors: list, scale: int) -> np.ndarray:
    scaled = np.floor(np.stack([np.asarray(v, np.float64) for v in vectors]) * scale)
    if np.abs(scaled).max(initial=0) > LARGEST:
        raise ValueError(f"a component times {scale} exceeds 2^27; exact distances would not fit in a long")
    return scaled.astype(np.int64)


def first_blocks(frames: Iterator[pd.DataFrame], centroids: np.ndarray, scale: int, rows: int) -> Iterator[pd.DataFrame]:
    """Pack vectors into blocks and assign them for the first time."""

    def block(ids, vectors):
        made = Block.of(narrowest(quantised(vectors, scale)), centroids)
        return pd.DataFrame([made.row(ids)], columns=["ids", "codes", "keys", "order", "starts", "sums"])

    ids, vectors = [], []
    for frame in frames:
        for one, vector in zip(frame["vec_id"].tolist(), frame["vector"], strict=True):
            ids.append(None if one is pd.NA or one != one else one)
            vectors.append(vector)
            if len(ids) == rows:
                yield block(ids, vectors)
                ids, vectors = [], []
    if ids:
        yield block(ids, vectors)


def next_round(frames: Iterator[pd.DataFrame], centroids: np.ndarray, drift: np.ndarray) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for row in frame.itertuples():
            block = Block.stored(row, centroids.shape[1])
            block.advance(centroids, drift)
            out.append(block.row(row.ids))
        yield pd.DataFrame(out, columns=["ids", "codes", "keys", "order", "starts", "sums"])


def assigned(frames: Iterator[pd.DataFrame], centroids: np.ndarray) -> Iterator[pd.DataFrame]:
    """``vec_id, cluster, distance`` of every vector of a block."""
    for frame in frames:
        for row in frame.itertuples():
            block = Block.stored(row, centroids.shape[1])
            cluster = np.repeat(np.arange(len(centroids)), np.diff(block.starts))
            distance = ((block.codes[block.order].astype(np.int64) - centroids[cluster]) ** 2).sum(axis=1)
            ids = pd.Series([row.ids[i] for i in block.order], dtype=object)
            yield pd.DataFrame({"vec_id": ids, "cluster": cluster.astype(np.int32), "distance": distance})


def moved(blocks: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The centroids after one update, and how far each one went, rounded up."""
    k, width = centroids.shape
    sums = blocks.select(F.posexplode("sums").alias("at", "n")).groupBy("at").agg(F.sum(F.col("n").cast("decimal(38,0)")))
    total = {at: int(n) for at, n in sums.collect()}  # clusters * (width + 1) rows
    new = centroids.copy()
    for j in range(k):
        count = total[j * (width + 1) + width]
        if count:
            new[j] = [total[j * (width + 1) + i] // count for i in range(width)]
    squared = ((new - centroids) ** 2).sum(axis=1)
    return new, np.sqrt(squared.astype(np.float64)) * (1 + SLACK)


def drifts(steps: np.ndarray) -> np.ndarray:
    """How much each cluster's gaps shrink: by its own step and by the longest step of any other centroid."""
    if len(steps) == 1:
        return np.zeros(1)
    ranked = np.argsort(-steps, kind="stable")
    longest = np.full(len(steps), steps[ranked[0]])
    longest[ranked[0]] = steps[ranked[1]]
    return (steps + longest) * (1 + SLACK)


def cluster_vectors(
    rows: DataFrame,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    width: int = 64,
    clusters: int = 40,
    rounds: int = 5,
    seed: int = 2,
    scale: int = 256,
    block_rows: int = 4096,
) -> DataFrame:
    """One row per kept vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Vectors become integers ``floor(scale * x)``; centroids start as those with the ``clusters`` smallest hashes of
    ``seed:vec_id``. Sums of distances that leave a long are null.
    """
    spark = rows.sparkSession
    sound = (
        f"size(vector) = {width} AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    )
    named = rows.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
    kept = named.where(F.coalesce(F.expr(sound), F.lit(False)))
    label = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    whole = F.expr(f"transform(vector, x -> floor({scale} * x))")
    chosen = kept.select(label.alias("label"), whole.alias("codes"), "vector").orderBy("label", "codes").limit(clusters)
    start = [r.vector for r in chosen.collect()]
    id_type = named.schema["vec_id"].dataType.simpleString()
    result = (
        f"vec_id {id_type}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    if not start:
        return spark.createDataFrame([], result)
    centroids = quantised(start, scale)
    drift = np.zeros(len(centroids))
    layout = BLOCK.format(id=id_type)

    first = centroids
    blocks, path = stored(
        kept.mapInPandas(lambda frames: first_blocks(frames, first, scale, block_rows), layout), "clusters"
    )
    for _ in range(rounds):
        centroids, steps = moved(blocks, centroids)
        if not steps.any():
            break  # no centroid moved, so no later round changes anything
        drift = drift + drifts(steps)
        later = blocks.mapInPandas(lambda frames, c=centroids, d=drift: next_round(frames, c, d), layout)
        before = path
        blocks, path = stored(later, "clusters")
        discard(spark, before)

    last = centroids
    found = blocks.mapInPandas(lambda frames: assigned(frames, last), f"vec_id {id_type}, cluster int, distance bigint")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n"))
    inertia = {r.cluster: int(r.n) for r in sums.collect()}  # one row per cluster
    longest = (1 << 63) - 1
    facts = [
        (j, n if n <= longest else None, sum(inertia.values()) if sum(inertia.values()) <= longest else None, _digest(centroids[j]))
        for j, n in sorted(inertia.items())
    ]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return found.join(F.broadcast(facts), "cluster").select(*names)


def _digest(centroid: np.ndarray) -> str:
    return sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def op11_centroid_clustering(spark, sf_dir) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"), width=64, clusters=40, rounds=5, seed=2)


def _round_sql(n: int) -> str:
    """Assignment ``n`` to the centroids ``n``, and the centroids that follow from it."""
    return f"""
a{n} AS MATERIALIZED (
  SELECT r, arg_min(cluster, row(d, cluster)) AS cluster, min(d) AS distance FROM (
    SELECT r, cluster, list_sum(list_transform(list_zip(q, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM v, c{n}) GROUP BY r),
c{n + 1} AS MATERIALIZED (
  SELECT cluster, list(floored ORDER BY place) AS c FROM (
    SELECT cluster, place, ((sum(x) - ((sum(x) % count(*) + count(*)) % count(*))) // count(*))::BIGINT AS floored
    FROM (SELECT cluster, unnest(q) AS x, generate_subscripts(q, 1) AS place FROM v JOIN a{n} USING (r))
    GROUP BY cluster, place) GROUP BY cluster
  UNION ALL SELECT cluster, c FROM c{n} WHERE cluster NOT IN (SELECT cluster FROM a{n}))"""


OP11_SQL = f"""
WITH sound AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(e, lambda x: CAST(floor(256 * x) AS BIGINT)) AS q FROM sound),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, q) - 1 AS cluster, q AS c
  FROM (SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, q FROM v) QUALIFY cluster < 40),
{",".join(_round_sql(n) for n in range(5))},
{_round_sql(5)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM v JOIN a5 USING (r) JOIN c5 USING (cluster)
"""
