"""Language, quality, substrings, packing, benchmark, scoring and licences."""

import base64
import itertools
import math
import re
import zlib
from itertools import combinations

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F
import zstandard

import brute
from compare import connect, check
from siltline.llm import contamination, language, licenses, packing, quality, queries, scoring, simhash, substrings
from siltline.llm.common import slabs, table, word_hashes, word_spans

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, score double, hash long, count int"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def docs_of(spark, pairs, lang="en"):
    return spark.createDataFrame([(i, t, lang, 0.5, 1, 2) for i, t in pairs], DOCS)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_agrees(spark, name):
    assert check(spark, connect(SF), SF, queries.QUERIES[name], queries.ORACLE_SQL[name]) == ""


# ---- language


def test_language_is_learned_and_held_out(spark):
    got = {r.doc_id: r for r in language.op1_language_id(spark, SF).collect()}
    docs = table(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        assert got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 3 == 1)
    tested = [d for d in docs if d.lang and got[d.doc_id].held_out]
    assert np.mean([got[d.doc_id].lang_pred == d.lang for d in tested]) > 0.96
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_of_awkward_texts(spark):
    teach = [(i, f"the and of with {i} which that from", "en") for i in range(9)]
    teach += [(i, f"der und die mit {i} nicht auch von", "de") for i in range(9)]
    teach += [(1, None, "en"), (2, "no label", None), (3, "", "de")]
    taught = spark.createDataFrame([(a, b, c, 0.1, 1, 2) for a, b, c in teach], DOCS)
    model = language.fit(taught, sample_texts=5)
    assert sorted(model) == ["de", "en"]
    long = "which and that from the " * 30_000
    docs = docs_of(spark, [(1, None), (2, ""), (3, "12 !?"), (4, "der und nicht"), (5, long), (5, long), (None, "é")])
    got = rows(language.identify(docs.drop("score"), model), "doc_id", "lang_pred")
    assert got[:6] == [(1, "und"), (2, "und"), (3, "und"), (4, "de"), (5, "en"), (5, "en")] and got[6][1] in ("de", "en")
    sure = rows(language.identify(docs.drop("score"), model, min_margin=0.0).where("NOT rejected"), "doc_id")
    assert sure == [(4,), (5,), (5,), (None,)]
    assert language.identify(docs.drop("score"), model, min_margin=1.0).where("NOT rejected").count() == 0
    assert rows(language.identify(docs.drop("score"), {}), "lang_pred") == [("und",)] * 7
    only = rows(language.identify(docs.drop("score"), {"en": b"x"}), "lang_pred", "score")
    assert only.count(("en", 1.0)) == 4 and only.count(("und", 0.0)) == 3
    assert language.fit(taught.limit(0)) == {}
    assert language.identify(docs.limit(0).drop("score"), model).collect() == []


def test_language_sums_over_the_whole_text():
    model = {"a": b"alpha beta gamma " * 50, "b": b"one two three four " * 50}
    text = "One two gamma four alpha " * 700
    sizes = {}
    for name, content in model.items():
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        coder = zstandard.ZstdCompressor(level=6, dict_data=words, write_content_size=False)
        data = text.lower().encode()
        sizes[name] = sum(len(coder.compress(data[i : i + 2048])) for i in range(0, len(data), 2048))
    best, second = sorted(sizes.values())
    got = language.Classifier(model, 6, 2048)(text)
    assert got == (min(sizes, key=sizes.get), (second - best) / second)


# ---- quality


def test_quality_on_held_out_labels(spark):
    got = {r.doc_id: r for r in quality.op4_quality_classifier(spark, SF).collect()}
    assert len(got) == table(spark, SF, "documents").count()
    for doc, r in got.items():
        assert r.held_out == (zlib.crc32(str(doc).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    tested = [x for x in table(spark, SF, "labels").collect() if got[x.doc_id].held_out]
    good = [got[x.doc_id].predicted for x in tested if x.quality == 1]
    bad = [got[x.doc_id].predicted for x in tested if x.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2


def test_quality_awkward(spark):
    texts = [(i, "good words stand here " * 3) for i in range(20)] + [(i, "BAD!! WORDS!!" * 5) for i in range(20, 40)]
    docs = docs_of(spark, [*texts, (50, None), (51, ""), (52, "good words " * 90_000), (53, None), (None, "BAD!!"), (1, texts[1][1])])
    labels = [(i, int(i < 20)) for i in range(40)] + [(3, 1), (4, None), (50, 1), (None, 0), (99, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.fit(docs.drop("score"), labels)
    got = {r.doc_id: r.score for r in quality.with_score(docs.drop("score"), model).collect()}
    assert got[5] > 0.5 > got[25] and got[52] > 0.5 and got[50] == got[51] == got[53]
    assert quality.fit(docs, labels.limit(0)) is None and quality.fit(docs.limit(0), labels) is None
    assert {r.score for r in quality.with_score(docs.drop("score"), None).collect()} == {0.5}
    one = quality.fit(docs, labels.where("quality = 1"))
    shares = {round(r.score, 9) for r in quality.with_score(docs.drop("score"), one).collect()}
    assert len(shares) == 1 and shares.pop() > 0.6
    assert quality.with_score(docs.limit(0).drop("score"), model).collect() == []


def test_hinge_loss_optimum_and_features():
    rng = np.random.default_rng(0)
    sets = [np.sort(rng.choice(40, 8, replace=False)).astype(np.int32) for _ in range(60)]
    y = np.where([3 in s or 5 in s for s in sets], 1.0, -1.0)
    scale = np.ones(40)
    w, b = quality.dual_coordinate_descent(sets, y, scale, epochs=2000)

    def loss(w, b):
        margins = np.array([w[s].sum() / np.sqrt(8) + b for s in sets])
        return (w @ w + b * b) / 2 + np.maximum(0, 1 - y * margins).sum()

    best = loss(w, b)
    for _ in range(300):
        assert loss(w + rng.normal(size=40) * 0.01, b + rng.normal() * 0.01) >= best - 1e-6
    f = quality.Features()
    assert len(f(None)) == len(f("")) == 0 and set(f("abab")) <= set(f("abab abab")) and (f("xy") == f("xy")).all()


# ---- substrings


def test_chunks_match_a_walk_over_the_bytes():
    rng = np.random.default_rng(5)
    texts = ["", "a", "aa bb cc " * 40, "é" * 1500, "x" * 3000, "日本語のテキスト" * 200]
    texts += ["".join(rng.choice(list("abcdé \n"), 2500)) for _ in range(5)]
    for text in texts:
        raw = text.encode()
        data = np.frombuffer(raw, np.uint8)
        starts = substrings.chunk_starts(data, word_spans(data)[0]).tolist()
        assert starts == (brute.chunk_borders(raw)[:-1] if raw else [])


@pytest.mark.parametrize("filter_bits", [15, 16, substrings.FILTER_BITS])
def test_substring_dedup_matches_brute_force(spark, filter_bits):
    rng = np.random.default_rng(7)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(1, 9)))
    passage = " ".join(word() for _ in range(60))
    pairs = [(i, " ".join(word() for _ in range(90))) for i in range(8)]
    pairs += [(20 + i, f"{' '.join(word() for _ in range(i * 3))}\n{passage} {word()} {word()}") for i in range(5)]
    pairs += [(40, pairs[0][1]), (40, pairs[0][1]), (41, ""), (42, None), (None, passage), (43, "tic tac " * 60), (9, passage), (9, passage + " x")]
    docs = docs_of(spark, pairs)
    got = substrings.dedup(docs, min_words=12, filter_bits=filter_bits)
    assert got.columns == [*docs.columns, "removed_spans", "first_doc_ids"]
    assert rows(got, "doc_id", "text") == sorted(
        ((i, t) for (i, _), t in zip(pairs, brute.substring_dedup(pairs, 12), strict=True)), key=str
    )
    left = {r.doc_id: r for r in got.collect()}
    assert left[3].removed_spans == [] and left[3].first_doc_ids == [] and left[22].first_doc_ids == []
    assert left[40].text == "" and left[42].text is None and len(left[23].text.split()) < 30
    assert substrings.dedup(docs.limit(0)).collect() == []


def test_op5_on_a_table(spark, sf_dir):
    pairs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    want = brute.substring_dedup(pairs, 20)
    got = substrings.op5_substring_dedup(spark, sf_dir)
    assert rows(got, "doc_id", "text") == sorted(((i, t) for (i, _), t in zip(pairs, want, strict=True)), key=str)


def test_digest_filter_holds_every_digest(spark):
    rng = np.random.default_rng(2)
    d1 = rng.integers(-(2**63), 2**63 - 1, 4000)
    df = spark.createDataFrame([(int(d),) for d in d1] + [(0,), (-1,)], "d1 long")
    bitmap = substrings.digest_filter(df, 20)
    assert substrings.may_hold(bitmap, np.r_[d1, 0, -1]).all()
    others = rng.integers(-(2**63), 2**63 - 1, 100_000)
    assert abs(substrings.may_hold(bitmap, others).mean() - 4002 / 2**20) < 1e-3
    assert not substrings.digest_filter(df.limit(0), 20).any()


def test_substring_dedup_without_white_space(spark):
    """Chinese, base64 and minified code: a passage inside two longer texts goes from the second, unique ones stay."""
    rng = np.random.default_rng(12)
    han = lambda n: "".join(map(chr, rng.integers(0x4E00, 0x9FA5, n)))
    b64 = lambda n: base64.b64encode(rng.bytes(n)).decode()
    code = lambda n: ";".join(f"v{i}={x}" for i, x in enumerate(rng.integers(0, 10**9, n)))
    texts = []
    for make, size in ((han, 900), (b64, 2000), (code, 150)):
        shared = make(size)
        texts += [make(size // 3) + shared + make(size // 2), make(size // 2) + shared + make(size // 3), make(size)]
        texts += [f"words before it {shared} and some after", shared[:60]]
    rows_in = list(enumerate(texts))
    got = {r.doc_id: r for r in substrings.dedup(docs_of(spark, rows_in)).collect()}
    assert [got[i].text for i, _ in rows_in] == brute.substring_dedup(rows_in, 20)
    for n in range(0, len(texts), 5):
        for again in (n + 1, n + 3):
            assert len(got[again].text) < 0.75 * len(texts[again]) and n in got[again].first_doc_ids
        for whole in (n, n + 2, n + 4):
            assert got[whole].text == texts[whole] and got[whole].removed_spans == []


def test_no_name_of_a_column_clashes(spark):
    """Columns named like what the operators add or use inside: the former are replaced, the latter kept."""
    inner = ["row", "key", "id", "hash", "text_hash", "spans", "cut", "first_ids", "guess", "loss", "doc", "listed", "rest", "keep_id", "keep_hash"]
    added = ["lang_pred", "score", "rejected", "removed_spans", "first_doc_ids", "n_tokens", "target_loss", "background_loss"]
    base = spark.createDataFrame([(1, "one two three", True), (2, "four five", False), (3, None, None)], "doc_id long, text string, target boolean")
    docs = base.withColumns({c: F.lit(f"old {c}") for c in [*inner, *(f"__{c}" for c in inner), *added]})
    model = {"en": b"one two three four five", "de": b"eins zwei drei vier"}
    results = {
        ("lang_pred", "score", "rejected"): language.identify(docs, model),
        ("removed_spans", "first_doc_ids"): substrings.dedup(docs),
        ("n_tokens", "target_loss", "background_loss", "score"): scoring.score(docs),
        ("score",): quality.with_score(docs, None),
        (): simhash.representatives(docs),
    }
    for replaced, out in results.items():
        assert out.columns == docs.columns
        rows_out = out.collect()
        assert len(rows_out) == 3
        for r in rows_out:
            assert all((r[c] == f"old {c}") == (c not in replaced) for c in [*inner, *added])


def plain_features(text, longest=4):
    """Buckets of byte and word-shape n-grams, from their definition."""
    raw = (text or "").encode()
    words = [m for m in re.findall(rb"[^\t-\r ]+", raw)]
    shapes = []
    for i, w in enumerate(words):
        last = w[-1]
        letter = ord("a") <= (last | 32) <= ord("z") or last >= 128 or ord("0") <= last <= ord("9")
        code = 0 if letter else last
        code += 256 * any(ord("a") <= c <= ord("z") for c in w) + 512 * (ord("A") <= w[0] <= ord("Z"))
        code += 1024 * (w in words[max(i - 2, 0) : i]) + 2048 * (min(len(w), 31) // 4)
        shapes.append(code)
    out = set()
    for symbols, start in ((list(raw), 0), (shapes, quality.SHAPES)):
        for n in range(1, longest + 1):
            for i in range(len(symbols) - n + 1):
                code = start
                for symbol, mix in zip(symbols[i : i + n], quality.MIX, strict=False):
                    code = (code + symbol + 1) * int(mix) % 2**32
                out.add((code ^ code >> 15) % quality.BUCKETS)
    return out


def test_quality_model_from_its_definition(spark):
    """Features, log-count ratios, margins and scores, written out plainly over the labelled texts of the table."""
    sf = "/root/testdata/sf0.001"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    featurise = quality.Features()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for text in [*list(texts.values())[:60], None, "", " \t", "A", "éa é éa. É! aa aa"]:
        assert set(featurise(text).tolist()) == plain_features(text)

    known = {r.doc_id: r.quality for r in labels.collect()}
    taught = sorted({(xx(texts[d]), y, texts[d]) for d, y in known.items() if d in texts})
    counts = {y: sum(1 for _, own, _ in taught if own == y) for y in (0, 1)}
    # every fourth text of a class is kept for the curve
    place, used, kept = {0: 0, 1: 0}, [], []
    for _, y, text in taught:
        held = counts[y] >= 8 and place[y] % 4 == 3
        place[y] += 1
        (kept if held else used).append((plain_features(text), y))
    total = {y: [1.0] * quality.BUCKETS for y in (0, 1)}
    for features, y in used:
        for f in features:
            total[y][f] += 1
    sums = {y: sum(total[y]) for y in (0, 1)}
    ratio = lambda f: math.log(total[1][f] / sums[1] / (total[0][f] / sums[0]))

    model = quality.fit(docs, labels)
    scale2 = model.squares
    assert all(math.isclose(scale2[f], ratio(f) ** 2, rel_tol=1e-9, abs_tol=1e-15) for f in range(0, quality.BUCKETS, 37))

    # the weights are the optimum of the hinge loss: their duality gap closes
    plain_w = {f: (model.weights[f] / ratio(f) if ratio(f) else 0.0) for f in set().union(*(x for x, _ in used))}
    losses = 0.0
    for features, y in used:
        length = math.sqrt(sum(ratio(f) ** 2 for f in features)) or 1e-12
        margin = sum(plain_w[f] * ratio(f) for f in features) / length + model.constant
        losses += max(0.0, 1 - (1 if y else -1) * margin)
        assert math.isclose(margin, model.margin(np.array(sorted(features))), rel_tol=1e-6, abs_tol=1e-9)
    objective = sum(w * w for w in plain_w.values()) / 2 + model.constant**2 / 2 + losses
    assert objective <= len(used)  # better than no weights at all

    # Platt's curve: no slope and shift nearby fit the kept texts better
    up, down = sum(y for _, y in kept), sum(1 - y for _, y in kept)
    def misfit(slope, shift):
        out = 0.0
        for features, y in kept:
            p = 1 / (1 + math.exp(-(slope * model.margin(np.array(sorted(features))) + shift)))
            t = (up + 1) / (up + 2) if y else 1 / (down + 2)
            out -= t * math.log(p) + (1 - t) * math.log(1 - p)
        return out
    best = misfit(model.slope, model.shift)
    assert all(best <= misfit(model.slope + a, model.shift + b) + 1e-6 for a in (-0.05, 0, 0.05) for b in (-0.05, 0, 0.05))
    for r in quality.with_score(docs, model).limit(40).collect():
        margin = model.margin(np.array(sorted(plain_features(r.text)), np.int64))
        assert math.isclose(r.score, 1 / (1 + math.exp(-(model.slope * margin + model.shift))), rel_tol=1e-9)


def xx(text):
    code = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return code - 2**64 if code >= 2**63 else code


def test_substring_dedup_tells_texts_of_one_id_apart(spark):
    said = " ".join(f"said{j}" for j in range(60))
    texts = [f"{said} end72421", " ".join(f"new6345x{j}" for j in range(60))]
    assert len({brute.xxhash_of(t) for t in texts}) == 1  # the low 31 bits of their hashes agree
    got = substrings.dedup(docs_of(spark, [(1, said), (5, texts[0]), (5, texts[1])])).collect()
    left = {r.text for r in got if r.doc_id == 5}
    assert texts[1] in left and texts[0] not in left and len(left) == 2


# ---- packing


def check_packing(packed, texts, capacity=1024):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(packing.public_vocabulary()["path"])
    whole = sorted(
        tuple(coder.encode(t or "", add_special_tokens=False).ids) + (2,) for _, t in texts
    )
    by_doc = {}
    for r in packed:
        by_doc.setdefault(r["doc"], []).append(r)
    got = []
    for parts in by_doc.values():
        parts.sort(key=lambda r: r["piece"])
        ids = [i for r in parts for i in np.frombuffer(r["ids"], "<u4").tolist()]
        assert [r["piece"] for r in parts] == list(range(len(parts)))
        assert [r["start"] for r in parts] == np.cumsum([0] + [r["length"] for r in parts])[:-1].tolist()
        assert all(r["length"] * 4 == len(r["ids"]) for r in parts)
        assert all(r["length"] == capacity for r in parts[1:]) and parts[0]["length"] <= capacity
        got.append(tuple(ids))
    assert sorted(got) == whole
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in bins.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins), -(-sum(r["length"] for r in packed) // capacity)


def test_packing_keeps_every_token(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    texts += [(10_000, None), (10_001, ""), (10_002, "a <|endoftext|> b"), (10_003, "tab\t\t  x  y\r\n\n  z  ")]
    texts += [(10_004, "word " * 9000), (10_005, " \n lead"), (10_006, "trail \n\n"), (10_007, "É  é\n\n\nß x\x1c y")]
    docs = docs_of(spark, texts).repartition(3)
    packed = [r.asDict() | {"doc": r.doc_id} for r in packing.pack(docs, **packing.public_vocabulary()).collect()]
    bins, least = check_packing(packed, texts)
    assert bins <= least + 1
    joined = packing.sequences(spark.createDataFrame([(r["sequence_id"], r["offset"], bytes(r["ids"])) for r in packed], "sequence_id long, offset long, ids binary"))
    assert sum(len(r.ids) for r in joined.collect()) == sum(len(r["ids"]) for r in packed)


def test_packing_in_shards_with_repeated_ids(spark):
    texts = [(i % 50, f"word{i} " * (i * 7 % 120)) for i in range(400)] + [(None, "x")] * 3
    docs = docs_of(spark, texts).repartition(4)
    packed = packing.pack(docs, capacity=64, shard_pieces=100, **packing.public_vocabulary()).collect()
    sizes = {}
    for r in packed:
        sizes.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in s) <= 64 for s in sizes.values())
    least = -(-sum(r.length for r in packed) // 64)
    assert len(sizes) <= least + 8
    assert packing.pack(docs.limit(0), **packing.public_vocabulary()).collect() == []


def test_units_are_encoded_together_and_once(monkeypatch):
    import tiktoken

    asked, plain = [], tiktoken.Encoding.encode_ordinary
    monkeypatch.setattr(tiktoken.Encoding, "encode_ordinary", lambda self, text: asked.append(text) or plain(self, text))
    coder = packing.Encoder(**packing.public_vocabulary())
    words = [f"w{i * 7919 % 5000:x}q" for i in range(5000)]
    for text in (" ".join(words * 3), "tab\t " + "\n".join(words * 3) + "\r\n"):
        asked.clear()
        ids = np.frombuffer(coder.ids(text), "<u4").tolist()
        assert ids == coder.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(asked) < 10 and sum(map(len, asked)) < len(text) / 2


def test_ids_at_every_kind_of_white_space(monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 40)
    coder = packing.Encoder(**packing.public_vocabulary())
    rng = np.random.default_rng(7)
    signs = [*" \n\t\r\x0b\x1c\x85\xa0\u1680\u2003\u2028\u202f\u205f\u3000ab.1's\u00e9\u00e0\u4e2d\u2019\U0001f600", "  ", " the", "\n\n", "<|endoftext|>"]
    for _ in range(300):
        texts = ["".join(rng.choice(signs, rng.choice([0, 1, 2, 6, 40, 90]))) for _ in range(rng.integers(1, 8))]
        data = [t.encode() for t in texts]
        ids, counts = coder.flat(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
        want = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


def test_pieces_of_long_texts_and_other_keys(spark):
    texts = [("k", "so " * 3_000_000), (None, "\u4e2d\u6587 " * 700), ("k", None), ("", "x")]
    docs = spark.createDataFrame(texts, "name string, body string").repartition(1)
    got = packing.pieces(docs, capacity=100, doc_id="name", text="body", **packing.public_vocabulary()).collect()
    coder = packing.encoder(**packing.public_vocabulary())
    want = sorted(((k or "-", coder.tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for k, t in texts), key=str)
    made = []
    for r in got:
        if r.piece == 0:
            made.append((r.doc_id, []))
        assert r.start == len(made[-1][1]) and r.length * 4 == len(r.ids) and (r.length == 100 or r.piece == 0)
        made[-1][1].extend(np.frombuffer(r.ids, "<u4").tolist())
    assert sorted(((k or "-", ids) for k, ids in made), key=str) == want
    assert [r.row for r in got] == list(range(len(got)))


def test_op7_digests(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    encode = packing.encoder(**packing.public_vocabulary()).ids
    for r in packing.op7_best_fit_packing(spark, sf_dir).collect():
        ids = encode(texts[r.doc_id] or "") + (2).to_bytes(4, "little")
        assert zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32


def test_local_search_empties_bins_and_raises_squares():
    rng = np.random.default_rng(2)
    for _ in range(20):
        sizes = rng.integers(1, 60, 200).tolist()
        first = [[i] for i in range(len(sizes))]  # the worst start
        got = packing.local_search([list(b) for b in first], sizes, 100)
        assert sorted(i for b in got for i in b) == list(range(200))
        fills = [sum(sizes[i] for i in b) for b in got]
        assert max(fills) <= 100 and len(got) <= -(-sum(sizes) // 100) + 1
        start = packing.best_fit(sizes, 100)
        better = packing.local_search([list(b) for b in start], sizes, 100)
        assert len(better) <= len(start) and len(better) <= -(-sum(sizes) // 100) + 1
    assert packing.local_search([[0, 1], [2, 3]], [60, 30, 60, 40], 100) == [[0, 1], [2, 3]]
    for bins, sizes, want in (
        ([[0, 1], [2, 3]], [50, 30, 45, 5], (20, {1}, {2, 3})),  # two for one
        ([[0, 1], [2]], [50, 30, 40], (10, {1}, {2})),  # one for one
        ([[0, 1, 2], [3]], [50, 12, 8, 50], (30, {1, 2}, {3})),  # one for two
        ([[0], [1, 2]], [60, 25, 15], (40, set(), {1, 2})),  # a move of two
    ):
        search = packing.Search([list(b) for b in bins], sizes, 100)
        search.open.remove(0)
        for item in bins[0]:
            search.withdraw(item)
        gain, leave, come, giver = search.best(0)
        assert (gain, set(leave), set(come), giver) == (*want, 1)
    assert packing.best_fit([50, 50, 100, 1], 100) == [[2], [0, 1], [3]] and packing.best_fit([], 9) == []


def helpful(taker, giver, sizes, slack):
    """Whether a move of one or two pieces, or a swap of one or two for one or one for two, fills the taker further."""
    groups = lambda b: [(), *((i,) for i in b), *combinations(b, 2)]
    total = lambda items: sum(sizes[i] for i in items)
    return any(
        0 < total(come) - total(leave) <= slack
        for leave in groups(taker)
        for come in groups(giver)
        if come and len(leave) + len(come) <= 3
    )


def test_local_search_sees_all_bins_and_goes_on_while_it_gains():
    bins, sizes = [[0]] + [[i] for i in range(1, 10)] + [[10, 11, 12]], [60] + [50] * 9 + [25, 15, 19]
    search = packing.Search([list(b) for b in bins], sizes, 100)
    search.open.remove(0)
    search.withdraw(0)
    gain, leave, come, giver = search.best(0)  # the pair lies in none of the emptiest bins
    assert (gain, leave, set(come), giver) == (40, (), {10, 11}, 10)
    rng, ended = np.random.default_rng(7), 0
    for _ in range(30):
        sizes = rng.integers(20, 70, 60).tolist()
        got = packing.local_search([[i] for i in range(len(sizes))], sizes, 100)
        if len(got) <= max(-(-sum(sizes) // 100), sum(2 * s > 100 for s in sizes)):
            continue
        ended += 1
        fill = [sum(sizes[i] for i in b) for b in got]
        for t, g in combinations(sorted(range(len(got)), key=lambda k: -fill[k]), 2):
            assert fill[t] == fill[g] or not helpful(got[t], got[g], sizes, 100 - fill[t])
    assert ended


# ---- benchmark


def test_contamination_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(60)] + ["É", "b_c", "x-y"]
    item = lambda n: " ".join(rng.choice(words, n))
    items = [(i, item(n)) for i, n in enumerate([1, 2, 4, 5, 6, 9, 30, 60, 90])] + [(20, None), (21, ""), (22, "!?"), (None, item(12)), (3, item(15))]
    items += [items[5]]
    docs = [(i, item(300)) for i in range(12)] + [(90, None), (91, ""), (92, "..")]
    for i, (_, text) in enumerate(items):
        parts = (text or "").split()
        docs += [(30 + i, f"{item(40)} {text} {item(40)}"), (60 + i, f"{item(30)}\n{' '.join(parts[: len(parts) * 9 // 10]).upper()}! {item(9)}")]
        docs += [(100 + i, f"{item(30)} {' '.join(parts[: len(parts) // 2])} {item(9)}")]
    docs += [docs[20], (None, items[8][1]), (31, "another text")]
    df = docs_of(spark, docs)
    bench = spark.createDataFrame([(*i, "x", 2) for i in items], "item_id long, text string, doc_id string, count int")
    for miss in (1e-6, 1e-3):
        got = contamination.contained(df, bench, miss=miss)
        assert {(r.doc_id, r.item_id) for r in got.collect()} == brute.contained(docs, items)
    clashing = df.withColumns({c: F.lit("x") for c in ("bad_id", "row", "text_hash", "__bad_id", "hash", "item")})
    assert contamination.decontaminate(clashing, bench).columns == clashing.columns
    assert contamination.decontaminate(clashing, bench).count() == contamination.decontaminate(df, bench).count()
    bad = {d for d, _ in brute.contained(docs, items)}
    clean = contamination.decontaminate(df, bench)
    assert clean.columns == df.columns
    held = {(d, t) for d, t in docs for x in [brute.contained([(d, t)], items)] if x}
    assert rows(clean, "doc_id", "text") == sorted(((d, t) for d, t in docs if (d, t) not in held), key=str) and bad
    assert contamination.contained(df.limit(0), bench).collect() == []
    assert contamination.contained(df, bench.limit(0)).collect() == []
    assert contamination.decontaminate(df, bench.limit(0)).count() == len(docs)


def test_size_partitions():
    parts = contamination.partitions(300, 0.8, 1e-6)
    assert [(p.low, p.high) for p in parts] == [(1, 8), (9, 16), (17, 32), (33, 64), (65, 128), (129, 256), (257, 512)]
    assert parts[0].matches is None and parts[0].length == 8
    for p in parts:
        if p.matches is not None:
            assert p.length < p.high and contamination.sure_matches(p.length, 0.8, 1e-6) >= p.matches
            assert contamination.sure_matches(p.length - 1, 0.8, 1e-6) < p.matches
    assert [p.matches for p in parts[2:]] == sorted(p.matches for p in parts[2:])  # larger items match more often
    assert contamination.partitions(0, 0.8, 1e-6) == []


def test_recall_of_each_partition(spark):
    """Items of every size, each in a document that holds just four fifths of its shingles, at a high miss rate."""
    rng = np.random.default_rng(9)
    names = [f"w{i}" for i in range(5000)]
    items, docs = [], []
    for i in range(210):
        size = [5, 12, 25, 50, 100, 200, 400][i % 7]
        words = rng.choice(names, size + 4).tolist()
        items.append((i, " ".join(words)))
        cut = int(size * 0.81) + 5
        docs.append((i, " ".join([*rng.choice(names, 30), *words[:cut], *rng.choice(names, 50)])))
    want = brute.contained(docs, items)
    df = docs_of(spark, docs)
    bench = spark.createDataFrame(items, "item_id long, text string")
    parts = contamination.partitions(400, 0.8, 0.02)
    got = {(r.doc_id, r.item_id) for r in contamination.contained(df, bench, miss=0.02).collect()}
    assert got <= want
    for n in range(7):
        mine = {(d, i) for d, i in want if i % 7 == n}
        assert len(mine) >= 20 and len(got & mine) >= 0.9 * len(mine), parts[n]


# ---- scoring


@pytest.mark.parametrize("shares", [(0.0, 0.0), (0.004, 0.002)])
def test_scores_match_brute_force(spark, shares):
    rng = np.random.default_rng(6)
    words = [f"w{min(int(x), 300)}" for x in rng.zipf(1.5, 4000)]
    texts = [(" ".join(words[i * 40 : i * 40 + 40]) + (" target words" if i % 3 == 0 else ""), i % 3 == 0) for i in range(90)]
    texts += [(None, True), ("", False), ("W1\tw2", None), (" x ", True), texts[0], texts[0]]
    df = spark.createDataFrame([(i, t, m, 1) for i, (t, m) in enumerate(texts)], "doc_id long, text string, target boolean, key long")
    options = {"min_share": shares[0], "min_pair_share": shares[1]}
    for chosen, part in ((texts, df), ([(t, False) for t, _ in texts], df.selectExpr("doc_id", "text", "false AS target", "key"))):
        got = scoring.with_losses(part, scoring.fit(part, **options)).orderBy("doc_id").collect()
        want = brute.bigram_scores(chosen, **options)
        assert [r.n_tokens for r in got] == [w[0] for w in want]
        assert np.allclose([(r.target_loss, r.background_loss) for r in got], [w[1:] for w in want], rtol=1e-9)
        assert np.allclose([r.score for r in got], [r.target_loss - r.background_loss for r in got])
    scored = sorted((r.score, texts[r.doc_id][1]) for r in scoring.with_losses(df, scoring.fit(df, **options)).collect())
    assert [m for _, m in scored[:10]] == [True] * 10
    empty = df.limit(0)
    assert scoring.with_losses(empty, scoring.fit(empty)).collect() == []


def test_texts_in_pieces_score_like_whole_ones(monkeypatch):
    """Blocks, requests, answers and losses without Spark, with texts cut every sixty bytes."""
    monkeypatch.setattr(scoring, "slabs", lambda data: slabs(data, 60))
    rng = np.random.default_rng(5)
    texts = [(" ".join(f"w{int(x)}" for x in rng.zipf(1.6, rng.integers(0, 90))), i % 3 == 0) for i in range(40)]
    texts += [("", True), (" \n" * 90 + "y", True), ("z" * 200, False)]
    frame = pd.DataFrame([(i, *t) for i, t in enumerate(texts)], columns=["doc", "text", "target"])
    blocks = pd.concat(scoring.packed(iter([frame]), 700))
    assert len(blocks) > 5 and max(map(max, blocks["numbers"])) > 3
    requests = pd.concat(scoring.asked(iter([blocks]), 3))
    answers = pd.concat([scoring.answered(part) for _, part in requests.groupby("part")])
    blocks["answers"] = [answers[answers["block"] == b].to_dict("records") for b in blocks["block"]]
    totals = [int(blocks["t"].sum()), int(blocks["b"].sum())]
    lost = pd.concat(scoring.piece_losses(iter([blocks]), totals, 1.0, 20.0)).groupby("doc").sum()
    for i, (n, target, rest) in enumerate(brute.bigram_scores(texts, min_share=0, min_pair_share=0)):
        got = lost.loc[i] if i in lost.index else {"tokens": 0, "l0": 0.0, "l1": 0.0}
        assert got["tokens"] == n and np.allclose([got["l0"], got["l1"]], [n * target, n * rest], rtol=1e-9)


@pytest.mark.parametrize("block_bytes", [3 << 20, 500, 60])
def test_every_word_and_pair_counts(spark, block_bytes):
    rng = np.random.default_rng(8)
    words = [f"w{min(int(x), 300)}" for x in rng.zipf(1.5, 2400)]
    texts = [(" ".join(words[i * 40 : i * 40 + 40]) + (f" rare{i} end" if i % 2 else f" end rare{i}"), i % 3 == 0) for i in range(60)]
    texts += [(None, True), ("", False), ("W1\tw2", None), (" x ", True), texts[0], (texts[1][0], True), (" \n" * 90 + "y", True)]
    for chosen in (texts, [(t, False) for t, _ in texts]):
        df = spark.createDataFrame([(i, t, m) for i, (t, m) in enumerate(chosen)], "doc_id long, text string, target boolean")
        got = scoring.score(df.repartition(3), block_bytes=block_bytes).orderBy("doc_id").collect()
        want = brute.bigram_scores(chosen, min_share=0, min_pair_share=0)
        assert [r.n_tokens for r in got] == [w[0] for w in want]
        assert np.allclose([(r.target_loss, r.background_loss) for r in got], [w[1:] for w in want], rtol=1e-9)
    assert scoring.score(df.limit(0)).collect() == []


def test_keys_and_counts_travel_whole():
    rng = np.random.default_rng(3)
    for n in (1, 2, 300):
        for top in (2**8, 2**40, 2**64 - 1):
            keys = np.unique(rng.integers(0, top, n, dtype=np.uint64))
            assert np.array_equal(scoring.unpack_keys(scoring.pack_keys(keys)), keys)
            counts = rng.choice([0, 1, 254, 255, 256, 2**40], len(keys))
            assert np.array_equal(scoring.unpack_numbers(scoring.pack_numbers(counts)), counts)
    assert len(scoring.unpack_numbers(scoring.pack_numbers(np.zeros(0, np.int64)))) == 0


def test_word_hashes_tell_words_apart():
    text = "aa a aaa ab ba aa \x00 b aa".encode() + b" \n\t end"
    data = np.frombuffer(text, np.uint8)
    starts, ends = word_spans(data)
    assert [text[a:b] for a, b in zip(starts, ends, strict=True)] == text.split()
    codes = word_hashes(data, starts, ends)
    by_word = {}
    for w, c in zip(text.split(), codes.tolist(), strict=True):
        assert by_word.setdefault(w, c) == c
    assert len(set(by_word.values())) == len(by_word)


# ---- licences


def test_licences_are_inherited_from_the_nearest_folder(spark):
    mit, gpl = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["GPL-3.0"]
    files = [
        ("LICENSE", mit[1]), ("a/x.py", "no notice"), ("a/LICENSE.txt", f"Title\n{gpl[1]}"), ("a/b/c/y.py", None),
        ("a/b/z.py", f"# {licenses.TEMPLATES['Apache-2.0'][0]}\ncode"), ("top.py", ""), ("d/COPYING", "nothing at all"),
        ("d/e.py", "text"), (None, "lost"), (None, mit[0]), ("a/x.py", "no notice"), ("aa/q", "word " * 50_000), ("k/readme", gpl[0].upper()),
        ("k/w.py", "plain"), ("LICENSES/n.py", "plain"),
    ]
    df = spark.createDataFrame([(p, t, "x", 1.0, "w") for p, t in files], "path string, text string, license string, score double, word string")
    got = {(r.path, r.license, r.origin, r.folder) for r in licenses.scan(df).collect()}
    assert got == {
        ("LICENSE", "MIT", "own", None), ("a/x.py", "GPL-3.0", "inherited", "a"), ("a/LICENSE.txt", "GPL-3.0", "own", None),
        ("a/b/c/y.py", "GPL-3.0", "inherited", "a"), ("a/b/z.py", "Apache-2.0", "own", None), ("top.py", "MIT", "inherited", ""),
        ("d/COPYING", "MIT", "inherited", ""), ("d/e.py", "MIT", "inherited", ""), (None, None, None, None), (None, "MIT", "own", None),
        ("aa/q", "MIT", "inherited", ""), ("k/readme", "GPL-3.0", "own", None), ("k/w.py", "MIT", "inherited", ""),
        ("LICENSES/n.py", "MIT", "inherited", ""),
    }
    assert licenses.scan(df).count() == len(files)
    assert licenses.scan(df.limit(0)).collect() == []
    assert {r.license for r in licenses.scan(df, {}).collect()} == {None}


def test_a_notice_needs_no_path(spark):
    mit = f"{licenses.TEMPLATES['MIT'][0]}\ncode"
    files = [(None, mit), (None, mit), (None, "code"), (None, None), ("a/x.py", mit), ("a/x.py", "other code")]
    df = spark.createDataFrame(files, "path string, text string")
    got = sorted(((r.path, r.license, r.origin) for r in licenses.scan(df).collect()), key=str)
    assert got == sorted([(None, "MIT", "own")] * 2 + [(None, None, None)] * 2 + [("a/x.py", "MIT", "own"), ("a/x.py", None, None)], key=str)


def test_license_query_with_nulls_equals_sql(spark, tmp_path):
    """The SQL names the paths by itself."""
    notices = [t for texts in licenses.TEMPLATES.values() for t in texts]
    docs = [(i, f"line {i}\n{notices[i % len(notices)]}\n" + "more words here " * (i % 40), lang, source)
            for i, (lang, source) in enumerate(itertools.product(["en", None, "de", ""], ["s1", None, "s2"]))]
    docs += [(100 + i, f"no notice {i} " * 30, lang, source) for i, (_, _, lang, source) in enumerate(docs)]
    docs += [(None, f"x\n{notices[0]}", None, None), (200, None, None, "s1"), (201, "", "en", None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert check(spark, con, str(tmp_path), licenses.op3_license_scan, licenses.OP3_SQL) == ""
    own = licenses.op3_license_scan(spark, str(tmp_path)).where("origin = 'own' AND doc_id < 12").count()
    assert own == 12
