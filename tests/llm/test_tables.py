"""Archives, vectors, conversations and the pipeline against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketwise.llm import neardup, preference, warc
from basketwise.session import scratch_path

HEAD = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def pages():
    same = "<p>" + "equal " * 40 + "</p>"
    return [
        (5, "http://a/1", same), (3, "http://a/2\r\nX: y", same), (9, None, same), (9, None, same), (None, "u", same), (1, "u", "short"),
        (2, "u", "short"), (4, "u", None), (6, "u", ""), (7, "u", "text WARC/1.1\r\nnot a record" + "é" * 90), (8, "u", "before " + HEAD + HEAD + "after"),
        (10, "u", "WARC/1.1\r\n"), (11, "u", "x" * 300_000), (12, "u", "\r\n\r\nContent-Length: 3\r\n\r\n"), (13, "u", "a" * 99), (14, "u", "a" * 99),
        (15, "u", "é" * 50), (16, "u", "é" * 50),
    ]


def test_archives_come_back(spark):
    rows = pages()
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, refers_to string").repartition(2)
    first = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(first.get(raw, i), i)
    expected = []
    for i, _, html in rows:
        raw = (html or "").encode()
        again = raw in first and first[raw] != i
        kind = ("revisit", first[raw]) if again else ("response", None)
        expected.append((i, len(raw), hashlib.sha256(raw).hexdigest(), *kind))
    got = warc.archive_and_read(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert warc.archive_and_read(df.limit(0)).count() == 0


def test_chain_survives_splits_and_breaks_off(spark):
    path = scratch_path(spark, "warc-test")
    body = "".join(HEAD.replace(":77", f":{i}").replace("hello", f"WARC{i % 10}") for i in range(200))
    spark.createDataFrame([(body + HEAD[:85],)], "value string").coalesce(1).write.text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = warc.read_archives(spark, path).select("page_id", "offset", "payload_bytes").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r["page_id"] for r in got) == list(range(200))
    assert all(r["payload_bytes"] == 5 for r in got)


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(0)
    rows = []
    for c in range(30):
        base = r.standard_normal(16)
        for _ in range(1 + c % 5):
            rows.append((len(rows), (base + 0.02 * r.standard_normal(16)).tolist(), c % 3))
    crowd = r.standard_normal(16)
    rows += [(1000 + i, (crowd + 0.02 * r.standard_normal(16)).tolist(), 1) for i in range(90)]
    rows += [(2000, rows[0][1], rows[0][2]), (2001, rows[0][1], rows[0][2]), (2001, rows[0][1], rows[0][2]), (2002, rows[0][1], None)]
    rows += [(2003, None, 1), (2004, [0.0] * 16, 1), (2005, [float("nan")] * 16, 1), (2006, [None] + [1.0] * 15, 1), (2007, [1.0, 2.0], 1)]
    rows += [(2008, [2.0, 4.0], 1), (2009, [], 1), (None, crowd.tolist(), 1), (2010, [float("inf")] * 16, 1), (2011, [1e300] * 16, 2)]
    return rows


def test_near_vectors(spark, vectors):
    df = spark.createDataFrame([(*v, 1) for v in vectors], "vec_id long, embedding array<double>, label int, kept int").repartition(3)
    good = [
        v for v in vectors
        if v[0] is not None and v[2] is not None and v[1] and all(x is not None and np.isfinite(x) for x in v[1]) and any(v[1]) and v[0] != 2011
    ]
    links, root = {}, {v[0]: v[0] for v in vectors}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(good):
        for j, b in enumerate(good):
            if i != j and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links[i] = links.get(i, 0) + 1
                    p, q = find(a[0]), find(b[0])
                    root[max(p, q)] = min(p, q)
    expected = sorted((v[0], links.get(i, 0), find(v[0]), v[0] == find(v[0])) for i, v in enumerate(good))
    got = [tuple(r) for r in neardup.near_duplicates(df).collect()]
    named = {v[0] for v in good}
    assert sorted(g for g in got if g[0] in named) == expected
    rest = [g for g in got if g[0] not in named]
    assert all(n == 0 and c == i for i, n, c, _ in rest) and len(got) == len(vectors)
    assert (None, 0, None, False) in rest
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def crowded(n, pairs, mean, seed, size=32):
    """``n`` vectors whose mean cosine is ``mean``, and as many of these, ``pairs``, again at a cosine of 0.982."""
    r = np.random.default_rng(seed)
    base = r.standard_normal(size)
    base /= np.linalg.norm(base)
    out = r.standard_normal((n, size)) / np.sqrt(size) * np.sqrt(1 / mean - 1) + base
    out /= np.linalg.norm(out, axis=1, keepdims=True)
    off = r.standard_normal((pairs, size))
    off -= (off * out[:pairs]).sum(axis=1, keepdims=True) * out[:pairs]
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    return np.concatenate([out, 0.982 * out[:pairs] + np.sqrt(1 - 0.982**2) * off])


def test_near_vectors_of_crowded_labels(spark):
    """Nearly all links between brute force's pairs are found where one direction is common to a label."""
    rows, linked = [], set()
    for label, mean in enumerate([0.8, 0.93]):
        vectors = crowded(6000, 150, mean, label)
        units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        first = len(rows)
        rows += [(first + i, v.tolist(), label) for i, v in enumerate(vectors)]
        for i in range(0, len(units), 1000):
            near = units[i : i + 1000] @ units.T >= 0.98
            linked |= {(first + i + int(a), first + int(b)) for a, b in zip(*np.nonzero(near)) if i + a < b}
    assert len(linked) >= 300
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    part = {r["vec_id"]: r["component_id"] for r in neardup.near_duplicates(df).collect()}
    together = sum(part[a] == part[b] for a, b in linked)
    print(f"recall of {len(linked)} links: {together / len(linked):.3f}")
    assert together >= 0.98 * len(linked)


def test_preferences(spark):
    r = random.Random(1)
    turns = []
    for c in range(40):
        for t in range(r.randrange(1, 6)):
            turns.append((c, t, ["user", "assistant"][t % 2], r.choice(["hi", "yes\n", "no", "", None])))
    turns += turns[:5] + [(None, 0, "user", "lost"), (50, 0, None, "hi"), (51, 0, None, "hi"), (60, None, "user", "z"), (60, 1, "user", "y")]
    df = spark.createDataFrame([(*t, 0) for t in turns], "conv_id long, turn long, role string, text string, prompt int").repartition(3)
    listed = {}
    for c, t, role, text in set(turns):
        if c is not None:
            listed.setdefault(c, []).append((t is not None, t or 0, role is not None, role or "", text is not None, text or "", role, text))
    listed = {c: [(x[-2], x[-1]) for x in sorted(v, key=lambda x: x[:6])] for c, v in listed.items()}
    pairs = {(c, c + 1) for c in listed if c % 2 == 0 and c + 1 in listed}
    for c, v in listed.items():
        least = min(d for d, w in listed.items() if w[0] == v[0])
        if least != c:
            pairs.add((least, c))

    def render(part):
        return "".join(f"<|im_start|>{a or ''}\n{b or ''}<|im_end|>\n" for a, b in part)

    expected = {}
    for a, b in pairs:
        x, y = listed[a], listed[b]
        n = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        expected[a, b] = (n, render(x[:n]), render(x[n:]), render(y[n:]))
    got = preference.format_preferences(df).collect()
    assert {(r["chosen_id"], r["rejected_id"]): (r["prompt_turns"], r["prompt"], r["chosen"], r["rejected"]) for r in got} == expected
    assert len(got) == len(expected)
    for row in got:
        for side in ("chosen", "rejected"):
            at, said = 0, []
            for run in row[f"{side}_mask"]:
                if run["trained"]:
                    said.append(row[side][at : at + run["n"]])
                at += run["n"]
            assert at == len(row[side])
            own = listed[row[f"{side}_id"]][row["prompt_turns"] :]
            assert said == [f"{t or ''}<|im_end|>\n" for role, t in own if role == "assistant"]
    assert preference.format_preferences(df.limit(0)).count() == 0


def test_pipeline_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = corpus_pipeline.run(spark, sf_dir)
    kept = {r["doc_id"]: r for r in out.collect()}
    assert set(kept) < set(before) and out.columns[:5] == docs.columns
    assert all(r["n_tokens"] == len(r["ids"]) for r in kept.values())
    items = [" ".join(r["text"].split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert not any(i in " ".join(r["text"].split()) for i in items for r in kept.values())
    assert len({r["text"] for r in kept.values()}) == len(kept)


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_take_odd_documents(spark, stage, tmp_path):
    rows = [(1, "The cat sat on the mat and more.", "en", "s", 3), (None, "The dog", "en", None, None), (2, None, None, None, None), (3, "", "fr", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, "some item of the test")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for frame in (docs, docs.limit(0), docs.unionByName(docs)):
        out = stage(spark, frame, str(tmp_path))
        assert out.columns[:5] == docs.columns
        assert out.where(F.col("doc_id") == 1).count() == frame.where(F.col("doc_id") == 1).count() or stage is corpus_pipeline.identify_language


def test_only_contaminated_documents_go(spark, tmp_path):
    item = "some item of the test that has more than sixteen words so that passages are compared with it as well"
    texts = [(None, "clean words here"), (None, f"before it {item} after it"), (7, "clean words there"), (7, item), (8, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 3) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.remove_benchmark(spark, docs, str(tmp_path)).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out) == [(0, ""), (0, "clean words here"), (7, "clean words there"), (8, "")]
