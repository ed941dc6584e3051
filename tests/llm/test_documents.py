"""Operators on documents against brute force: nulls, empty and very long texts, ties, repeated rows, empty tables, name clashes."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketwise.llm import bpe, decontaminate, langid, ngram_join, sharding, substring, suffix
from basketwise.llm.components import components

WORDS = re.compile("[^\x20\x09-\x0d]+")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANDOM = random.Random(3)
SOME = ["the", "Cat", "café", "naïve", "x", "of", "你好", "run", "42", "sky"] + [f"w{i}" for i in range(60)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(SOME) for _ in range(n))


def corpus():
    long = prose(20_000, 1)
    base, other = prose(300, 2), prose(120, 3)
    passage = prose(80, 4)
    near = base.split(" ")
    near[100] = "changed"
    texts = [
        base, base, " ".join(near), None, "", " \t\n", "one two", "one two", "ONE two", other, other + " " + passage, passage + " tail",
        prose(30, 5) + " " + passage, "a" * 400, "b " * 300, long, long[: len(long) // 2], base.upper(), "é" * 200, "x" + "é" * 200,
        "\x00\x01   \xa0 odd", "abc " * 12 + base, passage, passage,
    ]
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", 5, "other") for i, t in corpus()] + [(None, "nobody", None, 6, "x"), (None, None, None, 7, "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, size int, kept string").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def shingles(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def classes(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 240)] + [(7, 7), (None, 3), (9, 8), (8, 9)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 5 for i in range(200, 240)}, 9: 8}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_ngram_classes(docs, empty):
    texts = dict(corpus())
    sets = {i: shingles(t) for i, t in texts.items()}
    expected = classes(sets, lambda a, b: sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
    rows = ngram_join.link_documents(docs).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"]} == {
        i: (len(sets[i]), expected[i]) for i in sets
    }
    assert len(rows) == len(texts) + 2
    assert ngram_join.link_documents(empty).count() == 0


def test_ngram_classes_of_many_near_copies(spark):
    families = []
    for f in range(6):
        base = prose(60, 100 + f).split(" ")
        for c in range(25):
            words = list(base)
            for _ in range(c % 4):
                words[RANDOM.randrange(60)] = f"n{RANDOM.randrange(9)}"
            families.append(" ".join(words))
    common = " ".join(f"line{i}" for i in range(12))
    texts = {i: t + " " + common for i, t in enumerate(families)}
    sets = {i: shingles(t) for i, t in texts.items()}
    expected = classes(sets, lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.link_documents(df).collect()} == expected


def test_substrings_of_words(docs, empty):
    texts = [t for _, t in corpus()] + ["nobody", None]
    split = [WORDS.findall(t or "") for t in texts]
    seen = {}
    for w in split:
        for i in range(len(w) - 34):
            seen[tuple(w[i : i + 35])] = seen.get(tuple(w[i : i + 35]), 0) + 1
    expected = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        expected.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    got = substring.remove_repeats(docs)
    assert sorted((r["n_words"], r["n_removed"], r["kept"]) for r in got.collect()) == sorted(expected)
    assert got.columns == ["doc_id", "text", "lang", "size", "n_words", "n_removed", "kept"]
    assert substring.remove_repeats(empty).count() == 0


def cut_bytes(texts, window=50):
    first, out = {}, {}
    for i in sorted(texts):
        raw = (texts[i] or "").encode()
        gone = np.zeros(len(raw), bool)
        for j in range(len(raw) - window + 1):
            if first.get(raw[j : j + window], i) < i:
                gone[j : j + window] = True
        for j in range(len(raw) - window + 1):
            first.setdefault(raw[j : j + window], i)
        opens = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[i] = (len(raw), int(gone.sum()), opens, bytes(np.frombuffer(raw, np.uint8)[~gone]))
    return out


def test_suffix_cuts(docs, empty):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix.remove_repeats(docs).collect()}
    got.pop(None)
    assert got == cut_bytes(dict(corpus()))
    assert suffix.remove_repeats(docs).columns[:4] == ["doc_id", "text", "lang", "size"]
    assert suffix.remove_repeats(empty).count() == 0


def test_suffix_repeated_rows_and_missing_ids(spark):
    text = prose(40, 8)
    rows = [(4, text), (4, text), (None, text), (9, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    removed = sorted((r["doc_id"] or 99, r["n_removed"] > 0) for r in suffix.remove_repeats(df).collect())
    assert removed == [(4, False), (4, False), (9, True), (99, True)]


@pytest.mark.parametrize("seed", range(5))
def test_sorted_suffixes(seed):
    r = np.random.default_rng(seed)
    lengths = np.sort(r.integers(1, 30, 40))[::-1]
    strings = [bytes(r.integers(1, 4, n).astype(np.uint8)) for n in lengths]
    codes = np.frombuffer(b"".join(strings), np.uint8)
    starts = np.cumsum(lengths) - lengths
    common, rows = suffix.sorted_suffixes(codes, starts, lengths)
    by_row = {int(rows[i, j]): strings[i][j:] for i in range(len(strings)) for j in range(len(strings[i]))}
    suffixes = [by_row[i] for i in range(40, len(common))]
    assert suffixes == sorted(suffixes) and len(suffixes) == len(codes)
    for a, b, n in zip(suffixes, suffixes[1:], common[41:]):
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert same == n


@pytest.mark.parametrize("wide", [False, True])
def test_sorted_suffixes_sorts_new_rows_only(monkeypatch, wide):
    """A round sorts one symbol per string, not the rows of all rounds, whether or not a row and its symbol fit 32 bits."""
    r = np.random.default_rng(7)
    lengths = np.sort(r.integers(0, 60, 64))[::-1]
    strings = [bytes(r.choice([1, 2, 255], n).astype(np.uint8)) for n in lengths]
    codes, starts = np.frombuffer(b"".join(strings), np.uint8), np.cumsum(lengths) - lengths
    sizes, by_symbol = [], suffix._by_symbol
    monkeypatch.setattr(suffix, "_by_symbol", lambda last: sizes.append(len(last)) or by_symbol(last))
    if wide:
        monkeypatch.setattr(suffix, "_ROWS", 1 << 7)
    common, rows = suffix.sorted_suffixes(codes, starts, lengths)
    assert max(sizes) <= 64
    by_row = {int(rows[i, j]): s[j:] for i, s in enumerate(strings) for j in range(len(s))}
    expected = sorted(s[j:] for s in strings for j in range(len(s)))
    assert [by_row[i] for i in range(64, len(common))] == expected
    same = [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(expected, expected[1:])]
    assert common[65:].tolist() == same


def test_rows_by_symbol(monkeypatch):
    """Both ways of sorting give the order of a stable sort by the symbol."""
    last = np.random.default_rng(1).integers(0, 256, 5000).astype(np.uint8)
    expected = np.argsort(last, kind="stable").tolist()
    assert suffix._by_symbol(last).tolist() == expected and suffix._by_symbol(last[:0]).tolist() == []
    monkeypatch.setattr(suffix, "_ROWS", 1 << 12)
    assert suffix._by_symbol(last).tolist() == expected


TRICKY = [
    "<|endoftext|>a<|endoftext|><|endoftext|>", "  leading", "tabs\t\tand\n\n lines \n", "it's we'll I'D 'S", " nbsp wide", "1234567890 12ab",
    "\U0001f600\U0001f601 emoji", "a" * 3000, "ab" * 2000, "\x1c\x1d\x85 control", "�﻿", "    ", "!!!???###", "กำลัง",
]


def test_bpe_equals_the_library(spark, docs, empty):
    r = random.Random(5)
    noise = ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(160, 0x2FF), r.randrange(0x4E00, 0x4F00)])) for _ in range(60)) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate([t for _, t in corpus()] + TRICKY + noise)]
    library = Tokenizer.from_file(VOCABULARY)
    library.no_truncation()
    library.no_padding()
    coded = bpe.encode_decode(spark.createDataFrame(rows, "ids long, text string").withColumnRenamed("ids", "n"), VOCABULARY)
    for row in coded.collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == ids, row["text"]
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)
    clash = bpe.encode_decode(docs.withColumn("ids", F.lit(1)).withColumn("decoded", F.lit("z")), VOCABULARY)
    assert clash.columns == ["doc_id", "text", "lang", "size", "kept", "ids", "decoded"] and clash.count() == docs.count()
    assert bpe.encode_decode(empty, VOCABULARY).count() == 0


def test_language(spark, empty):
    sets = {"aa": "le la ouver queux ment tion eau".split(), "bb": "the ing thr whe ould ness ly".split()}
    r = random.Random(2)
    rows = [(i, " ".join("".join(r.choices(sets[n], k=2)) for _ in range(60)), n, i % 5 == 0) for i, n in enumerate(["aa", "bb"] * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, truth string, held boolean")
    model = langid.fit(df.where("not held").withColumnRenamed("truth", "lang"), VOCABULARY)
    found = langid.predict(df.withColumn("score", F.lit("clash")), model, VOCABULARY).collect()
    assert all(x["lang_pred"] == x["truth"] and 0.5 < x["score"] <= 1 for x in found)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !?"), (4, "ouver" * 4000), (None, "the thing")], "doc_id long, text string")
    got = [(x["lang_pred"], x["score"]) for x in langid.predict(odd.coalesce(1), model, VOCABULARY).collect()]
    assert got[:3] == [("und", 0.0)] * 3 and [g[0] for g in got[3:]] == ["aa", "bb"]
    assert langid.fit(empty, VOCABULARY) == {}
    assert {x["lang_pred"] for x in langid.predict(odd, {}, VOCABULARY).collect()} == {"und"}
    assert langid.predict(empty, model, VOCABULARY).count() == 0


def test_forward_sums_all_segmentations():
    table = langid.Pieces(VOCABULARY)
    chance = np.append(np.random.default_rng(1).random(table.count) / 4, 0)[:, None]
    text = b"the Cats " + b"understandings responsibility " + b"internationalization" * 2 + b" " + b"=" * 70 + b" " + "é".encode() * 13
    data = np.frombuffer(text, np.uint8)
    low, high, _ = langid._units(data, np.array([0, len(text)]))
    got = langid._log_chances(data, low, high, table, chance)[:, 0]
    longest = max(table.lengths)

    def all_ways(word):
        total = [1.0] + [0.0] * len(word)
        for end in range(1, len(word) + 1):
            for n in range(1, min(longest, end) + 1):
                piece = table.ids.get(word[end - n : end])
                if piece is not None:
                    total[end] += chance[piece, 0] * total[end - n]
        return np.log(total[-1])

    expected = [all_ways(b" " + w.lower()) for w in text.split(b" ")]
    assert np.allclose(got, expected)
    assert any(len(p) > 8 and p in b" understandings responsibility" for p in table.ids)


def test_long_words_do_not_underflow():
    table = langid.Pieces(VOCABULARY)
    chance = np.append(np.full(table.count, 1 / table.count), 0)[:, None]
    word = b"xq" * 20_000
    whole, half = (langid._forward_long(w, table, chance)[0] for w in (word, word[: len(word) // 2]))
    assert np.isfinite(whole) and whole == pytest.approx(2 * half, rel=1e-3)


@pytest.mark.parametrize("hot", [0, 60, 4000])
def test_shards(spark, empty, hot):
    rows = [(i, prose(1 + i % 40, i)) for i in range(3000)] + [(5000 + i, "the same text") for i in range(hot)] + [(9, None), (9, None), (None, "")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, slot int").repartition(5)
    got = sharding.shard_by_bytes(df, 8).collect()
    assert len(got) == len(rows)
    sizes, slots, groups = {}, {}, {}
    for r in got:
        assert r["size"] == len((r["text"] or "").encode()) + 1
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        groups.setdefault(r["text"] or "", set()).add(r["shard"])
    assert set(sizes) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(sizes.values()) / 8
    assert max(sizes.values()) - min(sizes.values()) < mean / 16
    giant = 14 * hot > mean
    assert all(len(s) == 1 for t, s in groups.items() if not (giant and t == "the same text"))
    assert sharding.shard_by_bytes(empty, 8).count() == 0


def test_contamination(spark, empty):
    items = [(1, "What moves first? The " + prose(30, 50) + ". So it is " + prose(8, 51) + "."), (2, prose(20, 52)), (3, None), (4, ""), (None, prose(40, 53))]
    item = items[0][1]
    changed = item.split(" ")
    for i in (8, 14, 20):
        changed[i] = "replaced"
    texts = [
        prose(200, 60) + " " + item + " " + prose(90, 61), prose(33, 62) + " " + " ".join(changed), items[1][1].upper(), prose(4000, 63), None, "",
        prose(50, 64) + " " + items[4][1], " ".join(item.split(" ")[:15]),
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, cosine string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert got == {(0, 1), (1, 1), (2, 2), (6, None)}
    assert decontaminate.contaminated(empty, benchmark).count() == 0
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0


def test_contamination_by_item_length(spark):
    """Recall of exact copies in longer texts against the subsequence over all pairs, by the item's length."""
    r = random.Random(7)
    vocabulary = [f"v{i}" for i in range(2000)]
    lengths = [1, 2, 3, 6, 8, 10, 12, 15, 20, 33, 59, 100, 300, 500]
    items = [(k, " ".join(r.choices(vocabulary, k=n))) for k, n in enumerate(n for n in lengths for _ in range(4))]
    texts = [" ".join(r.choices(vocabulary, k=r.randrange(40, 200))) for _ in items]
    texts = [(k, f"{t} {items[k][1]} {' '.join(r.choices(vocabulary, k=90))}") for k, t in enumerate(texts)]
    expected = set()
    for k, item in items:
        known = decontaminate.Item(k, item)
        size = len(known.words)
        for d, text in texts:
            ids = decontaminate._of_text(text).tolist()
            span = size + size // 2 + 1
            if sum(w in known.masks for w in ids) >= 0.65 * size and any(
                sum(w in known.masks for w in ids[i : i + span]) >= 0.65 * size
                and decontaminate.subsequence(known.masks, size, ids[i : i + span]) >= 0.65 * size
                for i in range(max(1, len(ids) - span + 1))
            ):
                expected.add((d, k))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.contaminated(docs, benchmark).collect()}
    for n in lengths:
        all_n = {e for e in expected if len(items[e[1]][1].split()) == n}
        print(n, len(all_n), f"{len(all_n & got) / len(all_n):.2f}")
    assert got == expected and len(expected) >= len(items)


@pytest.mark.parametrize("sample", [4, 40])
def test_recall_with_a_small_sample(spark, monkeypatch, sample):
    """Copies with every tenth word replaced, searched by an index fitted on few passages, against all passages with all items."""
    r = random.Random(12)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = [(k, " ".join(r.choices(vocabulary, k=n))) for k, n in enumerate([20, 40, 70, 120] * 5)]
    texts = []
    for k in range(60):
        copy = [r.choice(vocabulary) if i % 10 == 9 else w for i, w in enumerate(items[k % 20][1].split())]
        texts.append((k, " ".join(r.choices(vocabulary, k=r.randrange(60, 400)) + copy + r.choices(vocabulary, k=50))))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "SAMPLE", sample)
    pairs = lambda **o: {(x["doc_id"], x["item_id"]) for x in decontaminate.contaminated(docs, benchmark, **o).collect()}
    brute = pairs(cosine=-2.0)
    assert len(brute) >= 55 and len(pairs() & brute) >= 0.9 * len(brute)


def test_longest_common_subsequence():
    r = random.Random(4)
    for _ in range(50):
        a, b = [r.randrange(5) for _ in range(12)], [r.randrange(5) for _ in range(15)]
        best = [[0] * 16 for _ in range(13)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert decontaminate.subsequence(decontaminate.Item._masks(a), 12, b) == best[12][15]




def test_sums_of_blocks_take_one_word_of_each_at_a_time():
    """Blocks of 1 to 16 words, the last ones short, equal sums of their vectors; a step holds a vector per block, not per word."""
    import tracemalloc

    rng = np.random.default_rng(5)
    lengths = np.append(np.full(4000, decontaminate.HALF), [*range(1, 17), 2])
    starts = np.cumsum(lengths) - lengths
    feature = rng.integers(0, decontaminate.FEATURES, int(lengths.sum()))
    latent = rng.standard_normal((decontaminate.FEATURES, 64)).astype(np.float32)
    tracemalloc.start()
    got = decontaminate._block_sums(np.vstack([latent, np.zeros((1, 64), np.float32)]), feature, starts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    expected = np.stack([latent[feature[a : a + n]].astype(float).sum(axis=0) for a, n in zip(starts, lengths)])
    assert np.allclose(got, expected, atol=1e-4)
    assert (got == np.add.reduceat(latent[feature], starts, axis=0)).all()
    assert peak < 6 * got.nbytes + latent.nbytes * 1.1


def test_dense_rows_take_little_more_than_the_result():
    import tracemalloc

    rng = np.random.default_rng(6)
    packed = [rng.integers(0, decontaminate.FEATURES, n).astype(np.int16).tobytes() for n in [0, 1, *rng.integers(1, 33, 400)]]
    idf = rng.random(decontaminate.FEATURES) + 1
    tracemalloc.start()
    got = decontaminate._dense(packed, idf)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for row, words in zip(got, packed):
        one = np.bincount(np.frombuffer(words, np.int16), minlength=decontaminate.FEATURES) * idf
        assert (row == (one / (np.sqrt((one * one).sum()) or 1)).astype(np.float32)).all()
    assert peak < 3 * got.nbytes


def test_the_index_is_fitted_on_all_passages(spark, monkeypatch):
    """The covariance of all passages, repeated features and short ones included, against dense rows; no passage is left out."""
    rng = np.random.default_rng(9)
    width = decontaminate.FEATURES
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.3, n) % 90) for n in [0, 1, 31, 32, 33, *rng.integers(1, 200, 60)]]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    benchmark = spark.createDataFrame([("w1 w2 w3 w1",)], "item_text string").withColumnRenamed("item_text", "text")
    seen = []
    exact = decontaminate._covariance

    def kept(parts, whole, idf, directions):
        seen.append((idf, directions, exact(parts, whole, idf, directions)))
        return seen[-1][2]

    monkeypatch.setattr(decontaminate, "_covariance", kept)
    decontaminate.latent_words(docs, benchmark)
    passages = [decontaminate._feature(decontaminate._of_text(t))[i : i + 32] for t in texts for i in range(0, len(t.split()), 32)]
    counts = np.stack([np.bincount(p, minlength=width) for p in passages])
    expected_idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1
    item = np.bincount(decontaminate._feature(decontaminate._of_text("w1 w2 w3 w1")), minlength=width)
    rows = np.vstack([counts, item]) * expected_idf
    rows /= np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    assert len(seen) == 3
    for idf, directions, got in seen:
        assert np.allclose(idf, expected_idf)
        assert np.allclose(got, rows.T @ (rows @ directions), rtol=1e-4, atol=1e-4)


def test_segments_of_many_collections_hold_the_bytes_of_their_places():
    """A chunk dealt over hundreds of collections: every packed segment is the text at each of its places."""
    import pyarrow as pa

    from basketwise.llm import seeds

    class Stage:
        def mapInArrow(self, run, schema):
            return run

    r = random.Random(3)
    texts = [" ".join(r.choices(["abc", "defg", "hi", "jklmno"], k=r.randrange(5, 90))) for _ in range(40)]
    _, _, data, offsets = next(suffix.text_chunks(pa.array(texts)))
    _, _, anchors, text = suffix._runs(data, offsets, list(range(40)), 50)
    known = [seeds.keys_of(anchors[text == i], 40).astype(np.uint32).tobytes() for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(range(40)), pa.array(texts), pa.array(known, pa.binary())], names=list("abcd"))
    seen = 0
    for out in suffix._segments(Stage(), 50, 40, 320)([batch]):
        assert out.num_rows > 50
        for packed, where in zip(out.column("segments").to_pylist(), out.column("places").to_pylist()):
            n = int(np.frombuffer(packed, np.uint32, 1)[0])
            strings = np.frombuffer(packed, suffix._STRING, n, 4)
            codes = packed[4 + n * suffix._STRING.itemsize :]
            ends = np.cumsum(strings["size"], dtype=np.int64)
            held = {int(s): codes[e - z : e] for s, z, e in zip(strings["segment"].view(np.int64), strings["size"], ends)}
            for segment, sid, start in np.frombuffer(where, suffix._PLACE).tolist():
                assert texts[sid].encode()[start : start + len(held[segment])] == held[segment]
                seen += 1
    assert seen >= len(anchors)
