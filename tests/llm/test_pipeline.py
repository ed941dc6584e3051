"""The pipeline's stages, one after the other, against brute force; near copies and shards with missing and repeated ids."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from test_documents import VOCABULARY, classes, cut_bytes, shingles
from tokenizers import Tokenizer
from zlib import crc32

import corpus_pipeline
from basketwise.llm import decontaminate, sharding

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def holds(known, ids):
    """Whether a stretch of one and a half times the item's length has enough of it and of its last sentence."""
    size, answer = len(known.words), len(known.answer)
    span = size + size // 2 + 1
    inside = [w in known.masks for w in ids]
    if sum(inside) < 0.65 * size:
        return False
    for i in range(max(1, len(ids) - span + 1)):
        if sum(inside[i : i + span]) >= 0.65 * size:
            part = ids[i : i + span]
            if decontaminate.subsequence(known.masks, size, part) >= 0.65 * size and decontaminate.subsequence(known.answer_masks, answer, part) >= 0.5 * answer:
                return True
    return False


def test_a_whole_run_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = [decontaminate.Item(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").where("text is not null").collect()]
    # language: documents with a letter are recognised, as these are all in one of the languages
    docs = {i: t for i, t in docs.items() if t and any(c.isalpha() for c in t)}
    sets = {i: shingles(t) for i, t in docs.items()}
    part = classes(sets, lambda a, b: len(sets[a]) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
    docs = {i: t for i, t in docs.items() if part[i] == i}
    cut = cut_bytes(docs)
    docs = {i: docs[i] if not c[1] else c[3].decode("utf-8", "replace") for i, c in cut.items() if c[1] < c[0] or not c[0]}
    docs = {i: t for i, t in docs.items() if not any(holds(k, decontaminate._of_text(t).tolist()) for k in items if k.words)}
    library = Tokenizer.from_file(VOCABULARY)
    expected = {i: (t, library.encode(t, add_special_tokens=False).ids) for i, t in docs.items()}
    got = {r["doc_id"]: (r["text"], list(r["ids"])) for r in corpus_pipeline.run(spark, folder).collect()}
    assert got == expected


def test_near_copies_go_by_id_and_text(spark):
    a, c = "one two three four five six seven eight nine ten", "something else that is not like the other one at all"
    rows = [(3, a), (7, a), (7, c), (None, a), (None, c), (8, None), (8, None), (9, ""), (None, None), (7, c), (None, "a text without any id")]
    docs = spark.createDataFrame([(i, t, "en", "s", 3) for i, t in rows], DOCUMENTS).withColumn("__n", F.lit(1))
    out = corpus_pipeline.join_ngrams(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in out.collect())
    assert got == [(0, ""), (0, "a text without any id"), (3, a), (7, c), (7, c), (8, ""), (8, ""), (9, "")]


@pytest.mark.parametrize("hot", [None, 7])
def test_shards_of_missing_and_repeated_ids(spark, hot):
    """A text larger than a shard, whose rows have no id, or all the same."""
    rows = [(i if hot is None else hot, f"text {i}") for i in range(2000)] + [(hot, "the same text")] * 4000 + [(None, None), (1, "é" * 700)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sharding.shard_by_bytes(df, 8).collect()
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in got:
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, crc32(raw))
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got) == sorted((i or 0, t or "") for i, t in rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) < sum(sizes.values()) / 8 / 16
