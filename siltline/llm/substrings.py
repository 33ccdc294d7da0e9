"""Operator 5, substring dedup: content-defined chunks, deduplicated by digest.

A gear rolling hash runs over the bytes of a text. A chunk may begin where a word begins and the hash of the eight
bytes before matches a mask; so borders depend on the text around them alone, and an insertion moves only the chunks
it touches. In stretches without white space any character may begin a chunk, under a sparser mask; no chunk is
shorter than ``LEAST`` bytes unless it is a text's last, and none longer than about ``MOST``.

Single short chunks repeat by chance, so what is deduplicated is a *window*: a chunk with as many chunks after it as
make at least ``min_words`` words, or ``min_bytes`` bytes where words are long or white space is missing, as in Chinese,
base64 or minified code (and, at its end, the shortest run of chunks with as many). Windows are identified by 96 bits of
a digest. The first window of a digest, in order
of document id, text hash and place, stays; in all later ones every chunk of the window is cut out. A text thus keeps
what nobody said before it. Digests are combined map-side, only repeated ones travel back, and the spans of a document
meet in that document's row, so a passage in a third of all documents is no hot spot.

Defined cases: a null text stays null and an empty one empty; a text of fewer than ``min_words`` words and ``min_bytes``
bytes loses nothing;
within one text repeats count too; rows equal in id and text are one document and are cut alike; null ids come first
in the order; an empty table gives no rows; other columns are kept, whatever their names.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.functions import columns as fx
from siltline.llm.common import nested, settle, unnested, word_spans

LEAST, MOST = 16, 1024
MIN_BYTES = 400  # of a window with too few words; about three times what twenty words take
FILTER_BITS = 27  # of the bitmap that drops windows nobody repeats: 16 MB
WORD_MASK = np.uint8(0b1100_0000)  # one word start in four
CHAR_MASK = np.uint8(0b1111_1110)  # one character in 128, where white space is missing
GEAR = np.random.default_rng(20).integers(0, 256, 256).astype(np.uint8)  # the low eight bits suffice for the masks


def gear_hash(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte, modulo 256: h = 2 h + gear[byte], which forgets all but eight bytes."""
    gear = GEAR[data]
    code = gear.copy()
    for back in range(1, 8):
        code[back:] += gear[:-back] << np.uint8(back)
    return code


def chunk_starts(data: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    """Where the chunks of a text begin; the first at 0."""
    if not len(data):
        return np.zeros(0, np.int64)
    code = gear_hash(data)
    heads = word_starts[word_starts > 0]
    marked = heads[(code[heads - 1] & WORD_MASK) == 0]
    loose = np.flatnonzero((code[:-1] & CHAR_MASK) == 0) + 1
    loose = loose[(data[loose] & 0xC0) != 0x80]  # not inside a character
    marked = np.union1d(marked, loose)
    starts, last = [0], 0
    for at in marked.tolist():
        if at - last >= LEAST:
            while at - last > MOST:
                last += MOST
                while last < at and data[last] & 0xC0 == 0x80:
                    last += 1
                starts.append(last)
            if at - last >= LEAST:
                starts.append(at)
                last = at
    while len(data) - last > MOST:
        last += MOST
        while last < len(data) and data[last] & 0xC0 == 0x80:
            last += 1
        if last < len(data):
            starts.append(last)
    return np.array(starts)


def windows(text: str | None, min_words: int, min_bytes: int = MIN_BYTES) -> Iterator[tuple[int, int, int]]:
    """``digest, begin, end`` (in bytes) of the window at every chunk that has enough words or bytes after it, and of
    the shortest one that ends with the text."""
    raw = (text or "").encode()
    data = np.frombuffer(raw, np.uint8)
    word_starts, _ = word_spans(data)
    if len(word_starts) < min_words and len(raw) < min_bytes:
        return
    starts = chunk_starts(data, word_starts)
    borders = np.r_[starts, len(raw)]
    before = np.searchsorted(word_starts, borders)  # words that begin before each border
    upto = np.minimum(np.searchsorted(before, before[:-1] + min_words), np.searchsorted(borders, starts + min_bytes))
    whole = upto < len(borders)
    begins, ends = starts[whole], borders[upto[whole]]
    if ends[-1] < len(raw):
        begins, ends = np.r_[begins, begins[-1]], np.r_[ends, len(raw)]
    digest = xxhash.xxh3_128_intdigest
    for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
        yield digest(raw[begin:end].strip()), begin, end


def split_digests(digests: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of each digest as a 64-bit and a 32-bit number, which Spark hashes and sorts fastest. With 10^12 windows
    that leaves a chance of one in 10^5 that any two different ones agree."""
    words = np.frombuffer(b"".join(d.to_bytes(16, "little") for d in digests), np.int64).reshape(-1, 2)
    return words[:, 0], words[:, 1].astype(np.int32)


def digest_filter(digests: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of ``2^bits`` places, those of the distinct ``d1`` set: 16 MB for 27 bits, however many there are."""
    slot = f"(d1 & {(1 << bits) - 1}L)"
    places = digests.selectExpr(f"cast(shiftright({slot}, 15) AS int) AS part", f"{slot} & 32767 AS place")
    # dealt by part first: a partial bitmap per task and part would be far larger than the digests
    parts = places.repartition("part").groupBy("part").agg(F.expr("bitmap_construct_agg(place) AS held"))
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for row in parts.toLocalIterator():  # at most 2^(bits - 15) rows of 4 KB
        bitmap[row.part << 12 : (row.part + 1) << 12] = np.frombuffer(row.held, np.uint8)
    return bitmap


def may_hold(bitmap: np.ndarray, d1: np.ndarray) -> np.ndarray:
    slot = d1 & (len(bitmap) * 8 - 1)
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def window_rows(docs: DataFrame, min_words: int, min_bytes: int, wanted: Broadcast | None = None) -> DataFrame:
    """``id, hash, d1, tail, size``: the windows of each text, those alone that ``wanted`` may hold if it is given.
    ``tail`` is the second part of the digest and the begin in one number, ``size`` the bytes to the end: rows go through
    two shuffles and compress best with few zeros between."""
    kind = dict(docs.dtypes)["id"]

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 512):
                part = frame.iloc[at : at + 512]
                found = [list(windows(t, min_words, min_bytes)) for t in part["text"]]
                d1, d2 = split_digests([w[0] for ws in found for w in ws])
                begins, ends = (np.array([w[n] for ws in found for w in ws], np.int64) for n in (1, 2))
                tail, size = d2.astype(np.int64) << 32 | begins, (ends - begins).astype(np.int32)
                counts = [len(ws) for ws in found]
                at_text = np.repeat(np.arange(len(part)), counts)
                if wanted is not None:
                    held = may_hold(wanted.value, d1)
                    d1, tail, size, at_text = d1[held], tail[held], size[held], at_text[held]
                ids, hashes = (part[c].array.take(at_text) for c in ("id", "hash"))
                yield pd.DataFrame({"id": ids, "hash": hashes, "d1": d1, "tail": tail, "size": size})

    return docs.mapInPandas(cut, f"id {kind}, hash long, d1 long, tail long, size int")


def text_hash(text: str) -> str:
    """Tells texts of one id apart, by all 64 bits; turned so that texts are in order of the low 31 bits, then the rest."""
    code = f"xxhash64({fx.quoted(text)})"
    return f"((shiftleft({code}, 33) | shiftrightunsigned({code}, 31)) ^ shiftleft(1L, 63))"


def shuffled_anew(column: str) -> str:
    """The same value as an expression of its own. Joined by it, an aggregate's result is shuffled once more, and so is
    the other side: then Spark can split the rows of one hot key, which it does not do right next to the aggregate."""
    return f"({column} ^ 0)"


def repeated_spans(
    docs: DataFrame, *, doc_id: str, text: str, min_words: int, min_bytes: int, filter_bits: int
) -> DataFrame:
    """``id, hash, spans, first_ids``: what to cut from a text (numbers of begin and end), and who said it first.

    All windows are counted by the first part of the digest, in short rows that combine map-side. Only windows whose
    first part occurs again go on; they are settled and told apart by both parts. A bitmap of those first parts drops
    most of the others before they leave the scan; the exact join behind it drops the rest, so its size changes no result.
    """
    named = docs.select(F.col(doc_id).alias("id"), F.expr(text_hash(text)).alias("hash"), F.col(text).alias("text"))
    named = named.where("text IS NOT NULL")
    counted = window_rows(named, min_words, min_bytes).groupBy("d1").count()
    often = settle(counted.where("count > 1").select("d1"))
    wanted = docs.sparkSession.sparkContext.broadcast(digest_filter(often, filter_bits))
    found = window_rows(named, min_words, min_bytes, wanted)
    again = settle(found.join(often.selectExpr(f"{shuffled_anew('d1')} AS k1"), F.expr("d1 = k1"), "left_semi"))
    begin, d2 = "(tail & 4294967295L)", "shiftright(tail, 32)"
    span = F.expr(f"shiftleft({begin}, 32) | ({begin} + size)").alias("span")
    place = F.struct("id", "hash", span)
    first = again.groupBy("d1", F.expr(d2).alias("d2")).agg(F.min(place).alias("first"))
    first = first.selectExpr(f"{shuffled_anew('d1')} AS k1", f"{shuffled_anew('d2')} AS k2", "first")
    later = again.join(first, F.expr(f"d1 = k1 AND {d2} = k2")).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("id", "hash").agg(
        F.collect_set(span).alias("spans"), F.collect_set("first.id").alias("first_ids")
    )


# ---- cutting


def merged(spans: list[int]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one, in order."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted((s >> 32, s & 0xFFFFFFFF) for s in spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def without(text: str, spans: list[tuple[int, int]]) -> str:
    raw, at, kept = text.encode(), 0, []
    for begin, end in spans:
        kept.append(raw[at:begin])
        at = end
    return b"".join([*kept, raw[at:]]).decode()


def dedup(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = 20,
    min_bytes: int = MIN_BYTES,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``, and two more columns, both empty where nothing was
    cut: ``removed_spans`` (begin and end in bytes of the old text) and ``first_doc_ids`` (the documents that hold what
    was cut here; null ids are left out). Both replace columns of these names."""
    spans = repeated_spans(docs, doc_id=doc_id, text=text, min_words=min_words, min_bytes=min_bytes, filter_bits=filter_bits)

    @F.pandas_udf("text string, spans array<struct<begin:int,end:int>>")
    def cut(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        rows = []
        for value, own in zip(texts, found, strict=True):
            ranges = [] if own is None else merged([int(s) for s in own])
            rows.append((without(value, ranges) if ranges else value, [{"begin": b, "end": e} for b, e in ranges]))
        return pd.DataFrame(rows, columns=["text", "spans"])

    rows = nested(docs, key=F.col(fx.quoted(doc_id)), text_hash=F.expr(text_hash(text)))
    met = rows.join(spans, F.expr("key <=> id AND text_hash = hash"), "left")
    met = met.withColumn("cut", cut(F.col(f"row.{fx.quoted(text)}"), F.col("spans")))
    first = F.coalesce(F.array_sort("first_ids"), F.expr(f"cast(array() AS array<{dict(docs.dtypes)[doc_id]}>)"))
    added = {text: F.col("cut.text"), "removed_spans": F.col("cut.spans"), "first_doc_ids": first}
    return unnested(met, docs.columns, added)


def op5_substring_dedup(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup(docs, min_words=20)
