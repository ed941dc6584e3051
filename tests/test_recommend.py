from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketwise.operators import recommend, similarity

SCHEMA = "CustomerID long, StockCode string, PurchaseCount long"


def _matrix(spark, counts):
    return spark.createDataFrame([(c, p, q) for c, basket in counts.items() for p, q in basket.items()], SCHEMA)


def _random_counts(seed, customers=60, products=25, popular=("P00", "P01", "P02")):
    """Every second customer owns a popular product; many own nothing else, in equal numbers."""
    rng = np.random.default_rng(seed)
    counts = {}
    for c in range(customers):
        basket = {p: int(rng.integers(1, 3)) for p in popular if rng.random() < 0.5}
        if c % 3:
            for p in rng.choice(products, size=4, replace=False):
                basket.setdefault(f"Q{p:02d}", int(rng.integers(1, 9)))
        if basket:
            counts[c] = basket
    return counts


def _nearest(counts, k):
    """Brute force over all pairs, ranked exactly."""
    length = {c: sum(q * q for q in b.values()) for c, b in counts.items()}
    best = {}
    for a, basket in counts.items():
        found = []
        for b, other in counts.items():
            dot = sum(q * other.get(p, 0) for p, q in basket.items())
            if a != b and dot:
                found.append((-(dot * dot) / length[b], b, dot / (length[a] ** 0.5 * length[b] ** 0.5)))
        best[a] = [(b, sim) for _, b, sim in sorted(found)[:k]]
    return best


def _as_lists(df):
    rows = df.toPandas().sort_values(["CustomerID", "rank"])
    return {c: list(zip(g.neighbour, g.similarity, strict=True)) for c, g in rows.groupby("CustomerID")}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("degree", [0, 8, 20, 1000])
def test_nearest_customers_equal_brute_force(spark, monkeypatch, seed, degree):
    monkeypatch.setattr(similarity, "CELL_ROWS", 5)
    counts = _random_counts(seed)
    got = _as_lists(similarity.nearest_customers(_matrix(spark, counts), k=5, max_pair_degree=degree))
    expected = {a: rows for a, rows in _nearest(counts, 5).items() if rows}
    assert got.keys() == expected.keys()
    for a, rows in expected.items():
        assert [b for b, _ in got[a]] == [b for b, _ in rows], a
        assert [s for _, s in got[a]] == pytest.approx([s for _, s in rows])


@pytest.mark.parametrize("degree", [8, 1000])
def test_asking_for_some_gives_the_same_lists(spark, degree):
    counts = _random_counts(3)
    asked = sorted(counts)[:7]
    customers = spark.createDataFrame([(c,) for c in [*asked, -5]], "CustomerID long")
    got = _as_lists(similarity.nearest_customers(_matrix(spark, counts), 4, customers, max_pair_degree=degree))
    expected = _nearest(counts, 4)
    assert {a: [b for b, _ in rows] for a, rows in got.items()} == {
        a: [b for b, _ in expected[a]] for a in asked if expected[a]
    }


@pytest.mark.parametrize("degree", [0, 8, 1000])
@pytest.mark.parametrize("shift", [0, 1 << 45])
def test_without_k_all_partners_come(spark, degree, shift):
    """Also with ids too large to travel in one number; some ask or all do."""
    counts = {c + shift: b for c, b in _random_counts(6, customers=80).items()} | {7000 + shift: {"alone": 3}}
    expected = {a: rows for a, rows in _nearest(counts, len(counts)).items() if rows}
    assert max(map(len, expected.values())) > 50
    for asked in (None, sorted(counts)[5:9]):
        customers = asked and spark.createDataFrame([(c,) for c in asked], "CustomerID long")
        got = _as_lists(similarity.nearest_customers(_matrix(spark, counts), None, customers, max_pair_degree=degree))
        assert got.keys() == {a for a in expected if asked is None or a in asked}
        for a, rows in got.items():
            assert [b for b, _ in rows] == [b for b, _ in expected[a]], a
            assert [s for _, s in rows] == pytest.approx([s for _, s in expected[a]])


def test_the_similarity_query_keeps_all_partners(spark, tmp_path):
    """60 customers who bought one product are partners of each other, all 59 of each."""
    import datetime

    from basketwise.plans.queries import QUERIES
    from basketwise.plans.stages import Lifecycle

    lc = Lifecycle(spark, str(tmp_path))
    lines = [(float(c), f"I{c}", "P", c % 5 + 1, 2.0, datetime.datetime(2020, 1, 1)) for c in range(60)]
    lc.retail = spark.createDataFrame(lines, "`Customer ID` double, Invoice string, StockCode string, Quantity int, Price double, InvoiceDate timestamp")
    assert QUERIES["customer_similarity"](lc).groupBy("CustomerID").count().where("count = 59").count() == 60


@pytest.mark.parametrize("some", [False, True])
def test_few_pairs_go_on_and_all_best_are_among_them(spark, monkeypatch, some):
    """90 customers of three wide products: most of their 8,010 ordered pairs cannot be among anybody's three best."""
    monkeypatch.setattr(similarity, "PAIRS", 500)
    rng = np.random.default_rng(8)
    counts = {c: {"A": int(rng.integers(1, 60)), "B" if c % 2 else "C": int(rng.integers(1, 60)), f"own{c}": 30} for c in range(90)}
    rows = [(c, p, q, sum(x * x for x in b.values()), 90, not some or c < 9) for c, b in counts.items() for p, q in b.items()]
    rare = spark.createDataFrame(rows, "CustomerID long, StockCode string, q long, n2 long, degree long, asks boolean")
    asked = [c for c in counts if not some or c < 9]
    pairs = similarity._rare_only(rare, 3)
    assert pairs.count() < len(asked) * 89 / 2
    got = similarity._best(pairs, 3).orderBy("a", "rank").collect()
    expected = _nearest(counts, 3)
    assert [(r["a"], r["b"]) for r in got] == [(a, b) for a in asked for b, _ in expected[a]]


def test_equal_baskets_leave_out_the_customer_itself(spark):
    counts = {c: {"X": 2, "Y": 1} for c in (4, 1, 3)} | {2: {"X": 4, "Y": 2}}
    got = _as_lists(similarity.nearest_customers(_matrix(spark, counts), 2, max_pair_degree=1))
    assert {a: [b for b, _ in rows] for a, rows in got.items()} == {1: [2, 3], 2: [1, 3], 3: [1, 2], 4: [1, 2]}
    assert all(s == pytest.approx(1.0) for rows in got.values() for _, s in rows)


def _recommended(counts, n, k):
    """Scores every product for every customer, as the full matrix would."""
    products = sorted({p for b in counts.values() for p in b})
    out = {}
    for a, rows in _nearest(counts, k).items():
        score = defaultdict(int)
        for b, sim in rows:
            for p, q in counts[b].items():
                score[p] += int(np.rint(sim * 1e9)) * q
        free = [p for p in products if p not in counts[a]]
        out[a] = [(p, score[p]) for p in sorted(free, key=lambda p: (-score[p], p))[:n]]
    return out


def _descriptions(spark, counts):
    products = sorted({p for b in counts.values() for p in b})
    rows = [(p, None if i == 0 else f"text {p}") for i, p in enumerate(products)]
    return spark.createDataFrame(rows, "StockCode string, Description string")


@pytest.mark.parametrize("seed", [4, 5])
def test_recommendations_with_padding_equal_brute_force(spark, seed):
    counts = _random_counts(seed, customers=25, products=8)
    counts[900] = {"Z9": 1}  # shares nothing with anybody
    got = recommend.recommend(_matrix(spark, counts), _descriptions(spark, counts), n=5, k=3).toPandas()
    expected = _recommended(counts, 5, 3)
    lists = got.sort_values(["CustomerID", "rank"]).groupby("CustomerID")
    assert set(lists.groups) == set(counts)
    for a, rows in lists:
        assert rows["rank"].tolist() == list(range(1, len(rows) + 1))
        assert rows.StockCode.tolist() == [p for p, _ in expected[a]], a
        assert rows.Score.tolist() == pytest.approx([round(s / 1e9, 3) for _, s in expected[a]], abs=1e-9)
        assert not set(rows.StockCode) & set(counts[a])


def test_without_padding_only_scored_products_appear(spark):
    counts = {1: {"A": 1}, 2: {"A": 1, "B": 3}, 3: {"C": 1}}
    rows = recommend.recommend(_matrix(spark, counts), _descriptions(spark, counts), pad=False).collect()
    assert [(r["CustomerID"], r["StockCode"]) for r in rows] == [(1, "B")]


def test_descriptions_unknown_only_for_unlisted_products(spark):
    counts = {1: {"X": 1}, 2: {"X": 1, "A": 3, "B": 2}}
    known = spark.createDataFrame([("A", None)], "StockCode string, Description string")
    one = spark.createDataFrame([(1,), (77,)], "CustomerID long")
    rows = recommend.recommend(_matrix(spark, counts), known, n=2, customers=one).orderBy("rank").collect()
    assert [(r["StockCode"], r["Description"]) for r in rows] == [("A", None), ("B", "Unknown")]
    summary = recommend.summary_per_customer(recommend.recommend(_matrix(spark, counts), known, n=2, customers=one))
    assert summary.first()["top_rec_product"] == "Unknown"


def test_mean_similarity_counts_missing_neighbours_as_zero(spark):
    counts = {1: {"A": 1}, 2: {"A": 1}, 3: {"B": 1}, 4: {"C": 2}}
    matrix = _matrix(spark, counts)
    near = similarity.nearest_customers(matrix, 3)
    first = matrix.where("CustomerID < 4").select("CustomerID").distinct()
    assert similarity.mean_similarity(near, first, matrix, top=2).first()[0] == pytest.approx(2 / 6)


def test_matrix_and_stats(spark):
    pdf = pd.DataFrame({"Customer ID": [1, 1, 2], "StockCode": ["A", "A", "B"], "Quantity": [1, 2, 5]})
    matrix = similarity.purchase_matrix(spark.createDataFrame(pdf))
    assert sorted(map(tuple, matrix.collect())) == [(1, "A", 3), (2, "B", 5)]
    assert tuple(similarity.matrix_stats(matrix).first()) == (2, 2, 2, 50.0)


def test_baskets_meet_in_one_exchange_by_customer(spark, capsys):
    """Neighbours' products are not dealt out, joined or sorted as rows; rows that repeat or lack a code count as they are."""
    counts = {1: {"A": 1}, 2: {"A": 1, "B": 3, "C": 2}, 3: {"A": 2, "C": 5}}
    extra = spark.createDataFrame([(2, "B", 3), (2, None, 1), (1, None, 4)], SCHEMA)
    matrix = _matrix(spark, counts).unionByName(extra)
    near = spark.createDataFrame([(1, 2, 0.5, 1), (1, 3, 0.25, 2)], "CustomerID long, neighbour long, similarity double, rank int")
    got = recommend.recommend(matrix, _descriptions(spark, counts), n=9, pad=False, neighbours=near)
    rows = got.orderBy("rank").select("CustomerID", "StockCode", "Score").collect()
    assert [tuple(r) for r in rows] == [(1, "B", 3.0), (1, "C", 2.25), (1, None, 0.5)]
    capsys.readouterr()
    got.select("CustomerID", "StockCode", "Score").explain()
    plan = capsys.readouterr().out
    assert plan.count("hashpartitioning(CustomerID") >= 1 and "StockCode" not in "".join(x.split(")")[0] for x in plan.split("hashpartitioning(CustomerID")[1:])


def test_lists_travel_in_the_narrowest_type_that_holds_them(spark):
    rows = spark.createDataFrame([(-(1 << 15), 1 << 15, 1 << 31, "x"), (3, None, 1, "y")], "a long, b long, c long, d string")
    assert [similarity._narrow(rows, c) for c in "abcd"] == ["smallint", "int", "bigint", "string"]
    assert similarity._narrow(rows.limit(0), "a") == "smallint"
    for big in (1, 1 << 20, 1 << 40):  # ids and units beyond each type
        counts = {c * big + 5: {p: q * big for p, q in b.items()} for c, b in {1: {"A": 1, "B": 2}, 2: {"A": 1, "B": 3}, 3: {"B": 1}}.items()}
        counts = {c: {p: min(q, 1 << 30) for p, q in b.items()} for c, b in counts.items()}
        got = _as_lists(similarity.nearest_customers(_matrix(spark, counts), 2))
        assert {a: [b for b, _ in x] for a, x in got.items()} == {a: [b for b, _ in x] for a, x in _nearest(counts, 2).items()}


def test_keys_and_counts_share_a_number(spark):
    cases = [([(-5, 0), (1 << 19, 2047)], "int"), ([(1 << 40, 7), (-(1 << 40), 0)], "bigint"), ([(1 << 60, 1 << 20)], None), ([(1, -1)], None), ([(1, None), (None, 2)], None), ([], "int")]
    for pairs, kind in cases:
        rows = spark.createDataFrame(pairs, "k long, n long")
        pack = similarity.Packed(rows, "k", "n")
        assert pack.type == kind
        back = rows.select(pack.put(rows.k, rows.n).alias("x")).select(pack.key(F.col("x")).alias("k"), pack.count(F.col("x")).alias("n"))
        assert back.schema == rows.schema
        assert sorted(map(str, map(tuple, back.collect()))) == sorted(map(str, pairs))
    assert similarity.Packed(spark.createDataFrame([("x", 1)], "k string, n long"), "k", "n").type is None


def test_lists_of_those_who_meet_are_moved_in_parts(spark, monkeypatch):
    """No more than AT_ONCE meetings are on disk at a time, whatever there are in all; the result is the same."""
    counts = _random_counts(3)
    written, store = [], similarity.materialise
    monkeypatch.setattr(similarity, "materialise", lambda df, name: written.append(name) or store(df, name))
    monkeypatch.setattr(similarity, "AT_ONCE", 700)
    got = _as_lists(similarity.nearest_customers(_matrix(spark, counts), k=5))
    assert written.count("met") > 1
    expected = {a: rows for a, rows in _nearest(counts, 5).items() if rows}
    assert {a: [b for b, _ in x] for a, x in got.items()} == {a: [b for b, _ in x] for a, x in expected.items()}
