"""Operator 7, best-fit packing: token pieces into sequences, by best fit and swap-based local search.

1. Every text is tokenized and closed with an end id. Only longer documents are cut, into full pieces and one shorter
   first piece. Tokens are made once; what the caller wants of them (``outputs``) is settled with each piece.
2. Pieces are dealt by hash to shards of about ``shard_pieces``. In a shard, best fit in decreasing size gives the first
   bins. Then a local search empties bins: between an emptier and a fuller underfull bin it moves one or two pieces,
   swaps one for one, two for one or one for two, whenever that fills the fuller bin further, whichever two bins of the
   shard these are. Every step raises the sum of the squared fills, so the search ends: when no exchange helps any
   more, or at once when no packing can have fewer bins.
3. A shard wastes less than one sequence beyond what the search leaves, whatever the size of the table, so shards only
   bound memory. Full pieces are sequences of their own.

Defined cases: a null text is an empty one, and an empty one is the end id alone; rows with equal ids are separate
documents; an empty table gives no rows. Other columns of the input are ignored.
"""

import heapq
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import settle

# ---- tokens

BLOCK = 1 << 23  # bytes of text that are encoded together
CUT = re.compile(rb"[!-~\x8b-\x9e\xa1-\xa7\xaa-\xae\xb0-\xbf](?=[ \n])")  # no white space ends in these bytes
WIDE = [int.from_bytes(c.encode(), "big") for c in map(chr, range(128, 1 << 16)) if c.isspace()]


def closed(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place of UTF-8 ``data`` is no white space."""
    last = data[at - 1]
    solid = last > 32
    wide = np.flatnonzero(last > 127)
    if len(wide):
        low, mid, high = (data[at[wide] - n].astype(np.int32) for n in (1, 2, 3))
        code = high << 16 | mid << 8 | low
        solid[wide] = ~(np.isin(code, WIDE) | np.isin(code & 0xFFFF, WIDE))
    return solid


def borders(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the units of texts begin: at ``starts``, and at a space or line end next to what is no white space, since
    no pre-token of the vocabularies used here crosses these borders."""
    at = np.flatnonzero((data == 32) | (data == 10))
    at = at[at > 0]
    begins = np.zeros(len(data), bool)
    begins[at[closed(data, at)]] = True
    begins[starts] = True
    begins[0] = True
    return np.flatnonzero(begins)


def binary(data: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """``data`` in values that end at these bytes."""
    offsets = np.zeros(len(ends) + 1, np.int32)
    offsets[1:] = ends
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def unpacked(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of binary values and the offsets of these values in them."""
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets or bytes(4), np.int32)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(data or b"", np.uint8), offsets


class Encoder:
    """Token ids of whole texts, equal to ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``, as 32-bit
    integers (little-endian, as all machines Spark runs on).

    With the same vocabulary as ranks (``ranks``) and its splitting pattern, the distinct units between white space of
    about ``BLOCK`` bytes of text are encoded in one call. Texts with the string of a special token go through the
    tokenizer itself.
    """

    def __init__(self, path: str, ranks: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(map(re.escape, special))) if special else None
        self.plain = None
        if ranks:
            import base64

            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}
            coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
            self.plain = coder.encode_ordinary
            self.width = np.zeros(max(table.values()) + 1, np.int64)
            self.width[list(table.values())] = list(map(len, table))

    def ids(self, text: str) -> bytes:
        data = np.frombuffer(text.encode(), np.uint8)
        return self.flat(data, np.array([0, len(data)]))[0].tobytes()

    def flat(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts ``data[starts[i] : starts[i + 1]]``, one after another, and how many each has."""
        texts = len(starts) - 1
        alone = np.full(texts, self.plain is None)
        if self.special and self.plain:
            for found in self.special.finditer(data):  # it may span texts, and hide one that begins in it
                first, last = np.searchsorted(starts, [found.start(), found.end() - 1], "right") - 1
                alone[first : last + 1] = True
        made, counts, at = [], np.zeros(texts, np.int64), 0
        for nth in (*np.flatnonzero(alone).tolist(), texts):
            if at < nth:
                ids, counts[at:nth] = self.in_units(data[starts[at] : starts[nth]], starts[at : nth + 1] - starts[at])
                made.append(ids)
            if nth < texts:
                text = data[starts[nth] : starts[nth + 1]].tobytes().decode()
                made.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4"))
                counts[nth] = len(made[-1])
            at = nth + 1
        return np.concatenate(made), counts

    def in_units(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`flat`, for texts without special tokens, in blocks that end where a unit ends."""
        made, before, at, total = [np.zeros(0, "<u4")], np.zeros(len(starts), np.int64), 0, 0
        while at < len(data):
            cut = CUT.search(data, at + BLOCK) if len(data) - at > BLOCK else None
            end = cut.end() if cut else len(data)
            here = slice(*np.searchsorted(starts, [at, end]))
            begins = borders(data[at:end], starts[here] - at)
            ids, upto = self.block(data[at:end], begins)
            before[here] = total + upto[np.searchsorted(begins, starts[here] - at)]
            made.append(ids)
            total += len(ids)
            at = end
        before[starts == len(data)] = total
        return np.concatenate(made), np.diff(before)

    def block(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units that begin at these bytes, and the number of ids before each and after all of them."""
        units = binary(data, np.append(begins[1:], len(data))).dictionary_encode()
        ids, place = self.distinct(units.dictionary)
        found, offsets = unpacked(ids.take(pa.array(place[units.indices.to_numpy()])))
        return found[: offsets[-1]].view("<u4"), offsets // 4

    def distinct(self, units: pa.Array) -> tuple[pa.BinaryArray, np.ndarray]:
        """The ids of units in an order of their own, and the place of each unit in it."""
        data, offsets = unpacked(units)
        first = data[offsets[:-1]]
        joins = ((first == 32) | (first == 10)) & closed(data, offsets[1:])  # no border goes when such ones are joined
        text, ends = unpacked(units.filter(pa.array(joins)))
        ids = np.frombuffer(array("I", self.plain(text[: ends[-1]].tobytes().decode())), "<u4")
        stops = np.r_[0, np.cumsum(self.width[ids])]
        upto = np.searchsorted(stops, ends[1:])
        if not np.array_equal(stops[upto], ends[1:]):
            raise ValueError("a token crosses the end of a word")
        others = [self.plain(u.decode()) for u in units.filter(pa.array(~joins)).to_pylist()]
        ids = np.concatenate([ids, *(np.array(o, "<u4") for o in others)])
        upto = np.r_[upto, (upto[-1] if len(upto) else 0) + np.cumsum([len(o) for o in others], dtype=np.int64)]
        place = np.empty(len(units), np.int32)
        place[np.r_[np.flatnonzero(joins), np.flatnonzero(~joins)]] = np.arange(len(units), dtype=np.int32)
        return binary(ids, 4 * upto), place


@lru_cache(maxsize=2)
def encoder(path: str, ranks: str | None, pattern: str | None) -> Encoder:
    return Encoder(path, ranks, pattern)


def public_vocabulary() -> dict[str, str]:
    import public_tokenizers

    return {
        "path": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def pieces(
    docs: DataFrame,
    *,
    path: str,
    ranks: str | None = None,
    pattern: str | None = None,
    end_id: int = 2,
    capacity: int = 1024,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids`` (little-endian 32-bit) and ``row``, a number that no other piece has."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    most = -(-BLOCK // (4 * capacity))  # pieces handed on together

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, ranks, pattern).flat
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            data, offsets = unpacked(batch.column(1).cast(pa.binary()))
            offsets, at = offsets.astype(np.int64), 0
            while at < len(batch):
                end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK, "right")) - 1)
                ids, counts = encode(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
                ids = np.insert(ids, np.cumsum(counts), end_id)
                parts = counts // capacity + 1  # with the end id
                doc = np.repeat(np.arange(end - at), parts)
                nth = np.arange(len(doc)) - (np.cumsum(parts) - parts)[doc]
                head = counts + 1 - (parts - 1) * capacity
                start = np.where(nth == 0, 0, head[doc] + (nth - 1) * capacity)
                length = np.where(nth == 0, head[doc], capacity)
                stops = np.cumsum(length)
                for low in range(0, len(doc), most):
                    some = slice(low, low + most)
                    begin = stops[low] - length[low]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(at + doc[some])),
                            pa.array(nth[some], pa.int32()),
                            pa.array(start[some]),
                            pa.array(length[some]),
                            binary(ids[begin : stops[some][-1]], 4 * (stops[some] - begin)),
                            pa.array(row + np.arange(len(doc))[some]),
                        ],
                        ["doc_id", "piece", "start", "length", "ids", "row"],
                    )
                row += len(doc)
                at = end

    kind = dict(named.dtypes)["doc_id"]
    return named.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids binary, row long")


# ---- bins


def best_fit(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: each item, largest first, goes to the fullest bin that it fits."""
    bins: list[list[int]] = []
    room: dict[int, list[int]] = {}
    free = 0  # bit r is set if some bin has room r
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[item]
        fitting = free >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            at = room[left].pop()
            if not room[left]:
                free ^= 1 << left
            bins[at].append(item)
        else:
            at, left = len(bins), capacity
            bins.append([item])
        room.setdefault(left - size, []).append(at)
        free |= 1 << (left - size)
    return bins


def pair_sums(sizes: Sequence[int]) -> int:
    """Bit n is set if two of the sizes sum to n."""
    seen = sums = 0
    for size in sizes:
        sums |= seen << size
        seen |= 1 << size
    return sums


class Search:
    """Bins while pieces are exchanged between the underfull ones, fullest first.

    ``sizes_there`` has bit n set if some open bin, other than the one being filled, holds a piece of size n, and
    ``sums_there`` if one holds two pieces of n together; so the best partner for a swap is found by a few operations
    on one number instead of a walk over all bins. The sums of a bin are brought up to date when it is next asked for.
    """

    def __init__(self, bins: list[list[int]], sizes: Sequence[int], capacity: int):
        self.bins, self.sizes, self.capacity = bins, sizes, capacity
        self.fill = [sum(sizes[i] for i in b) for b in bins]
        self.owner = {i: k for k, b in enumerate(bins) for i in b}
        self.of_size: dict[int, set[int]] = {}
        self.sizes_there = 0
        self.of_sum: dict[int, set[int]] = {}
        self.sums_there = 0
        self.sums: dict[int, int] = {}
        self.open = {k for k, f in enumerate(self.fill) if f < capacity}
        self.stale = set(self.open)
        for k in self.open:
            for item in bins[k]:
                self.offer(item)

    def offer(self, item: int) -> None:
        self.of_size.setdefault(self.sizes[item], set()).add(item)
        self.sizes_there |= 1 << self.sizes[item]
        self.stale.add(self.owner[item])

    def withdraw(self, item: int) -> None:
        same = self.of_size[self.sizes[item]]
        same.remove(item)
        if not same:
            self.sizes_there ^= 1 << self.sizes[item]
        self.stale.add(self.owner[item])

    def refresh(self) -> None:
        """Bring the sums of the bins that changed up to date."""
        for k in self.stale:
            now = pair_sums([self.sizes[i] for i in self.bins[k]]) if k in self.open else 0
            changed = now ^ self.sums.get(k, 0)
            self.sums[k] = now
            while changed:
                low = changed & -changed
                changed ^= low
                there = self.of_sum.setdefault(low.bit_length() - 1, set())
                if now & low:
                    there.add(k)
                    self.sums_there |= low
                else:
                    there.remove(k)
                    if not there:
                        self.sums_there ^= low
        self.stale.clear()

    def pair(self, giver: int, total: int) -> tuple[int, int]:
        """Two pieces of a bin that make ``total`` together."""
        seen: dict[int, int] = {}
        for item in self.bins[giver]:
            if total - self.sizes[item] in seen:
                return item, seen[total - self.sizes[item]]
            seen[self.sizes[item]] = item
        raise KeyError(total)

    def best(self, taker: int) -> tuple[int, tuple[int, ...], tuple[int, ...], int]:
        """The exchange that fills ``taker`` furthest: gain, pieces that leave it, pieces that come, their bin."""
        own, sizes = self.bins[taker], self.sizes
        slack = self.capacity - self.fill[taker]
        single = {0: (), **{sizes[a]: (a,) for a in reversed(own)}}
        out = {sizes[a] + sizes[b]: (a, b) for n, a in enumerate(own) for b in own[:n]} | single
        found = (0, (), (), -1)
        for less, leave in out.items():  # a move, one for one, one for two
            size = (self.sizes_there & ((1 << (less + slack + 1)) - 1)).bit_length() - 1
            if size - less > found[0]:
                item = min(self.of_size[size], key=lambda i: (self.fill[self.owner[i]], i))
                found = (size - less, leave, (item,), self.owner[item])
                if found[0] == slack:
                    return found
        self.refresh()
        for less, leave in single.items():  # two moves, two for one
            total = (self.sums_there & ((1 << (less + slack + 1)) - 1)).bit_length() - 1
            if total - less > found[0]:
                giver = min(self.of_sum[total], key=lambda k: (self.fill[k], k))
                found = (total - less, leave, self.pair(giver, total), giver)
                if found[0] == slack:
                    return found
        return found

    def fill_up(self, taker: int) -> list[int]:
        """Exchange until nothing helps; returns the bins that gave."""
        gave = []
        while self.fill[taker] < self.capacity:
            gain, leave, come, giver = self.best(taker)
            if not gain:
                break
            for item in come:
                self.withdraw(item)
            for items, at, other in ((come, taker, giver), (leave, giver, taker)):
                for item in items:
                    self.bins[other].remove(item)
                    self.bins[at].append(item)
                    self.owner[item] = at
            for item in leave:
                self.offer(item)
            self.fill[taker] += gain
            self.fill[giver] -= gain
            gave.append(giver)
        return gave


def local_search(bins: list[list[int]], sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """Empty bins by exchanges between a fuller and an emptier underfull bin, until a pass over all makes none or no
    fewer bins can do. A piece only ever leaves for a bin at least as full, by an exchange that fills that one further,
    so the sum of squared fills grows with every step."""
    least = max(-(-sum(sizes) // capacity), sum(2 * s > capacity for s in sizes))  # no two of these share a bin
    gained = True
    while gained and len(bins) > least:
        gained = False
        search = Search(bins, sizes, capacity)
        fullest = [(-search.fill[k], k) for k in search.open]
        heapq.heapify(fullest)
        while fullest:
            known, taker = heapq.heappop(fullest)
            if taker not in search.open or -known != search.fill[taker]:
                continue
            search.open.remove(taker)
            for item in bins[taker]:
                search.withdraw(item)
            for giver in search.fill_up(taker):
                gained = True
                if search.fill[giver]:
                    heapq.heappush(fullest, (-search.fill[giver], giver))
                else:
                    search.open.discard(giver)
        bins = [b for b in bins if b]
    return bins


def fill_shard(shard: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Place the pieces of one shard: ``row, sequence_id, offset``."""
    shard = shard.sort_values(["length", "row"], ascending=[False, True])
    sizes, rows = shard["length"].tolist(), shard["row"].to_numpy()
    base = int(shard["shard"].iloc[0]) << 24
    out = []
    for nth, members in enumerate(local_search(best_fit(sizes, capacity), sizes, capacity)):
        offset = 0
        for item in sorted(members):
            out.append((rows[item], base + nth, offset))
            offset += sizes[item]
    return pd.DataFrame(out, columns=["row", "sequence_id", "offset"])


def pack(
    docs: DataFrame,
    *,
    outputs: Sequence[str] = ("ids",),
    capacity: int = 1024,
    shard_pieces: int = 4096,
    **tokens,
) -> DataFrame:
    """``doc_id, piece, start, length, *outputs, sequence_id, offset``, one row per piece. ``outputs`` are SQL
    expressions over the piece, of which ``ids`` holds the tokens; further arguments are those of :func:`pieces`."""
    cut = pieces(docs, capacity=capacity, **tokens)
    made = settle(cut.selectExpr("doc_id", "piece", "start", "length", *outputs, "row"))
    open_pieces = made.where(f"length < {capacity}").select("row", "length")
    shards = -(-open_pieces.count() // shard_pieces) or 1
    width = min(shards, 16 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = (
        open_pieces.withColumn("shard", F.expr(f"pmod(xxhash64(row), {shards}L)"))
        .repartition(width, "shard")  # by number: a shard is seconds of work for little data
        .groupBy("shard")
        .applyInPandas(lambda shard: fill_shard(shard, capacity), "row long, sequence_id long, offset long")
    )
    whole = made.where(f"length = {capacity}").selectExpr("*", "-1L - row AS sequence_id", "0L AS offset")
    return made.where(f"length < {capacity}").join(placed, "row").unionByName(whole).drop("row")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the token ids of whole sequences, from :func:`pack` with ``ids``."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = packed.groupBy("sequence_id").agg(ordered.alias("parts"))
    return whole.selectExpr("sequence_id", "aggregate(parts.ids, X'', (a, b) -> concat(a, b)) AS ids")


def op7_best_fit_packing(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, outputs=["crc32(ids) AS ids_crc32"], **public_vocabulary())
