"""Spelling variants, prefix trie and packing against brute force: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketwise.llm import packing, spelling, trie

RUN = re.compile("[A-Za-zÀ-ÿ]+")
WORDS = re.compile("[^\x20\x09-\x0d]+")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def lower(word):
    return re.sub("[A-Z]", lambda m: m[0].lower(), word)


def counted(rows, drop_every):
    total = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return total


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(words, ratio):
    found, forms = {}, {}
    for a, n in words.items():
        others = [(-words[b], b) for b in words if near(a, b)]
        best = min(others, default=(0, None))
        form = best[1] if -best[0] >= ratio * n and best[1] is not None else None
        found[a] = [form, a, n, len(others), -best[0] if form else None]
        forms[a] = form
    for a in words:
        root = a
        while forms[root]:
            root = forms[root]
        found[a][1] = root
    return {a: tuple(v) for a, v in found.items()}


def test_word_counts(spark):
    r = random.Random(1)
    words = ["Hello", "heLLo", "ÉCOLE", "école", "naïve", "x", "aßb", "×y÷", "don't", "Wörld"]
    rows = [(r.randrange(9) if i % 7 else None, " ".join(r.choices(words, k=60))) for i in range(80)]
    rows += rows[:9] + [(1, None), (2, ""), (3, "12 _ 你好"), (4, "a" * 100_000), (5, "Q " * 50_000)]
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, n int").repartition(4)
    for drop in (None, 3, 199):
        got = {x["word"]: x["n"] for x in spelling.word_counts(df, drop_every=drop).collect()}
        assert got == counted(rows, drop)
    assert spelling.word_counts(df.limit(0)).count() == 0


def test_word_counts_hand_on_many_distinct_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "_DISTINCT", 5)
    rows = [(i, " ".join(chr(97 + (i + j) % 26) * (1 + j % 3) for j in range(20))) for i in range(50)]
    got = spelling.word_counts(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {x["word"]: x["n"] for x in got.collect()} == counted(rows, None)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_variants(spark, seed):
    r = random.Random(seed)
    # few letters: runs of equal letters, many neighbours, words that are neighbours in several ways, ties
    words = {"".join(r.choices("abcé", k=r.randrange(1, 7))) for _ in range(250)} | {"a", "aa", "aaa", "aaaa", "ab", "ba", "z" * 3000, "z" * 2999}
    words = {w: r.choice([1, 1, 2, 5, 10, 50, 250]) for w in words}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = {x["word"]: (x["form"], x["root"], x["n"], x["n_near"], x["form_n"]) for x in spelling.variants(df).collect()}
    assert got == variants(words, 5)
    pairs = {(x["word"], x["near"], x["near_n"]) for x in spelling.neighbours(df).collect()}
    assert pairs == {(a, b, words[b]) for a in words for b in words if near(a, b)}
    assert spelling.neighbours(df).count() == len(pairs)  # each once


def test_variants_of_nothing(spark):
    df = spark.createDataFrame([], "word string, n long")
    assert spelling.variants(df).count() == 0
    with pytest.raises(ValueError, match="ratio"):
        spelling.variants(df, ratio=1)


def rebuilt(turns):
    own = defaultdict(list)
    for c, t, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).digest()
            own[c].append((t is not None, t or 0, role, digest, text))
    own = {c: [(x[2], x[4]) for x in sorted(v, key=lambda x: x[:4])] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:]  # the remainder has the sign of the number
    return out


def nodes(convs):
    members = defaultdict(list)
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids, out = defaultdict(list), []
    for s in members:
        if s:
            kids[s[:-1]].append(s)

    def total(s):
        leaves, saved = (0, 0) if kids[s] else (1, 0)
        saved += (len(members[s]) - 1) * (len(WORDS.findall(s[-1][1])) if s else 0)
        for k in kids[s]:
            below = total(k)
            leaves, saved = leaves + below[0], saved + below[1]
        return leaves, saved

    for s, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(s))
        parent = min(members[s[:-1]]) if s else None
        out.append((min(m), len(s), parent, len(m), len(kids[s]), *total(s), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie_of(df):
    own = trie.numbered_turns(df)
    turns = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    return trie.prefix_trie(*trie.graft(own, F.col("conv_id") - F.col("conv_id") % 20, turns.cast("int"), 3))


def test_prefix_trie(spark, monkeypatch):
    monkeypatch.setattr(trie, "_HOT", 5)
    monkeypatch.setattr(trie, "_IDS", 3)
    r = random.Random(5)
    turns = []
    for c in [*range(0, 45), *range(61, 75), 300]:
        for t in range(r.randrange(1, 6)):
            turns.append((c, t, ["user", "assistant"][t % 2], r.choice(["hi", "hi", "yes\n no", "no", "", None])))
    turns += [(500 + i, 0, "user", "the same") for i in range(40)] + turns[:7]  # copies, and repeated rows
    turns += [(None, 0, "user", "lost"), (700, None, "user", "z"), (700, 1, None, "y"), (700, 1, "a", "y"), (700, 1, "a", "x"), (-5, 0, "user", "a b")]
    turns += [(800, t, "user", "again") for t in range(300)] + [(801, 0, "user", "long " * 50_000)]
    df = spark.createDataFrame([(*t, 0) for t in turns], "conv_id long, turn long, role string, text string, depth int").repartition(4)
    got = [tuple(x) for x in trie_of(df).collect()]
    assert sorted(got, key=repr) == nodes(rebuilt(turns))
    assert trie_of(df.limit(0)).count() == 0


@pytest.mark.parametrize("shape", ["chain", "star", "random", "caterpillar"])
def test_subtree_sums(spark, shape):
    r = random.Random(shape)
    n = 90
    parent = {
        "chain": [None, *range(n - 1)],
        "star": [None] + [0] * (n - 1),
        "random": [None] + [r.randrange(i) for i in range(1, n)],
        "caterpillar": [None] + [i - 1 if i % 2 else max(0, i - 2) for i in range(1, n)],
    }[shape]
    parent += [None, n]  # a second tree
    depth = []
    for p in parent:
        depth.append(0 if p is None else depth[p] + 1)
    total = [r.randrange(10) for _ in parent]
    rows = [(i, p, d, v, 1) for i, (p, d, v) in enumerate(zip(parent, depth, total))]
    size = [1] * len(parent)
    for i in range(len(parent) - 1, -1, -1):
        if parent[i] is not None:
            total[parent[i]] += total[i]
            size[parent[i]] += size[i]
    df = spark.createDataFrame(rows, "id long, parent long, depth int, v long, size long").repartition(3)
    got = {x["id"]: (x["v"], x["size"]) for x in trie.subtree_sums(df, ["v", "size"]).collect()}
    assert got == dict(enumerate(zip(total, size)))


def packed(spark, rows, **options):
    df = spark.createDataFrame([(*x, 7) for x in rows], "doc_id long, text string, length int").repartition(3)
    return packing.pack(df, VOCABULARY, **options)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_packing(spark, library):
    r = random.Random(1)
    words = ["the", "Cat", "café", "naïve", "x,", "you're", "你好", "<|endoftext|>", "42", "áb", "\x1cq\x85r", "İ", "ΑΣ", "e f"]
    rows = [(i, " ".join(r.choices(words, k=int(r.lognormvariate(3.5, 1)))) + r.choice(["", " ", "\n"])) for i in range(400)]
    rows += [(None, None), (7, ""), (7, "   "), (8, "the same")] + [(8, "the same")] * 40 + [(9, "long one " * 4000), (10, "z" * 3000), (11, "  ".join(words))]
    got = [x.asDict() for x in packed(spark, rows, capacity=256).collect()]
    assert set(got[0]) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    # every id of every document is in exactly one piece: (document, start, end, checksum) of pieces cover them
    wanted, covered = Counter(), Counter()
    texts = defaultdict(list)
    for i, text in rows:
        ids = library(text)
        texts[i, len(ids)].append(ids)
        wanted.update((i, len(ids), at) for at in range(len(ids)))
    for p in got:
        assert any(
            p["ids_crc32"] == zlib.crc32(np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) for ids in texts[p["doc_id"], p["doc_tokens"]]
        ), p
        covered.update((p["doc_id"], p["doc_tokens"], at) for at in range(p["start"], p["start"] + p["length"]))
    assert covered == wanted
    sequences = defaultdict(list)
    for p in got:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    padded = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 256
        padded += 0 if at & (at - 1) == 0 else 256 - at
    assert padded <= 0.04 * sum(len(library(t)) for _, t in rows)  # half of a class of 8 for each of some 100 ids
    assert sorted(sequences) == list(range(len(sequences)))


def test_packing_of_few_documents(spark):
    assert packed(spark, []).count() == 0
    got = packed(spark, [(1, None)], capacity=64).collect()
    assert [tuple(x) for x in got] == [(1, 0, 1, zlib.crc32(b"\2\0\0\0"), 1, 0, 0)]


@pytest.mark.parametrize("seed", [1, 2])
def test_column_generation_reaches_the_bound(seed):
    r = np.random.default_rng(seed)
    demand = np.zeros(64, dtype=np.int64)
    np.add.at(demand, np.minimum(r.lognormal(2, 1, 30_000).astype(int), 63), 1)
    plan = packing.plan_sequences(demand, 64)
    used, units = demand.copy(), (demand * np.arange(1, 65)).sum() / 64
    for c in plan.loose:
        used[c - 1] = plan.loose[c]
    taken = np.zeros(64, dtype=np.int64)
    for size, first, end, many, base in plan.slots:
        assert first == taken[size - 1] and (end - first) % many == 0
        taken[size - 1] = end
        assert base + (end - first) // many <= plan.sequences
    assert (taken == used).all()
    loose = ((demand - used) * np.arange(1, 65)).sum() / 64
    assert plan.sequences + loose <= units * 1.002 + 2


def test_loose_pieces_are_strung_together():
    lengths = [5, 64, 1, 100, 33, 2]
    parts = packing._string(lengths, 64)
    fill = defaultdict(int)
    for n, found in zip(lengths, parts):
        assert sum(p[1] for p in found) == n and [p[0] for p in found] == [sum(q[1] for q in found[:i]) for i in range(len(found))]
        for _, size, sequence, offset in found:
            assert fill[sequence] == offset
            fill[sequence] += size
    assert list(fill.values()) == [64, 64, 64, 8, 4, 1]


def test_pre_tokens_are_cut_at_spaces_only():
    """Their ids are those of the library for the whole text, without its normaliser and pattern."""
    r = random.Random(3)
    texts = ["".join(chr(r.randrange(256)) for _ in range(r.randrange(60))).replace("|", "") for _ in range(500)] + ["it's WE'LL \x1c\x1d\x85x\xa0y \xb5\xaa\xba \xb2\xb3 \xdf\xc0"]
    path = public_tokenizers.path("word_bpe_49k.json")
    words, library = packing._Words(path), Tokenizer.from_file(path)
    asked: list[str] = []
    words._separately = lambda parts: asked.extend(parts) or []
    for text in texts:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert not asked and words.cutter is not words.tokenizer


def test_pre_tokens_are_looked_up_once_for_many_texts():
    """A batch asks for each pre-token once, and the ids are still those of the library, text by text."""
    r = random.Random(4)
    pieces = ["'s", "'re", "'Ll", "'", "''ve", "'x", "STORY", "caf\xc9", "it's'T", "42\xbd", "?!", "\xa0", "\x85", " ", "\n\n", "\t", "\x1c", "\xb5m"]
    texts = ["".join(r.choices(pieces, k=r.randrange(12))) for _ in range(400)]
    texts[5:5], texts[100:100], texts[300:300] = ["", " \n"], ["\u212angstr\xf6m \u0141", "a <|endoftext|> b"], ["\u0130x"]
    path = public_tokenizers.path("word_bpe_49k.json")
    words, library = packing._Words(path), Tokenizer.from_file(path)
    asked: list = []
    lookup = words.parts.lookup
    words.parts.lookup = lambda keys, make: asked.extend(keys) or lookup(keys, make)
    for batch in (texts, texts[100:103], [], [""]):
        got = [np.frombuffer(ids, "<u4").tolist() for ids in words.encode_all(batch)]
        assert got == [library.encode(text, add_special_tokens=False).ids for text in batch]
        assert len(asked) == len(set(asked))
        asked.clear()
