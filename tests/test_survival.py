from datetime import datetime, timedelta
from math import inf, log

import numpy as np
import pandas as pd
import pytest

from basketwise.operators import cox, survival

START = datetime(2020, 1, 1, 12)


def _curve(spark, rows, **options):
    df = spark.createDataFrame(rows, "duration long, churned int" + (", g string" if len(rows[0]) == 3 else ""))
    return survival.kaplan_meier(df, **options)


def test_kaplan_meier_by_hand(spark):
    curve = _curve(spark, [(1, 1), (2, 0), (2, 1), (3, 1), (5, 0)]).orderBy("time").collect()
    assert [(r["time"], r["at_risk"], r["events"], r["censored"]) for r in curve] == [
        (1, 5, 1, 0), (2, 4, 1, 1), (3, 2, 1, 0), (5, 1, 0, 1)
    ]
    assert [r["survival"] for r in curve] == pytest.approx([0.8, 0.6, 0.3, 0.3])
    for r in curve:
        assert 0 <= r["ci_lower"] <= r["survival"] <= r["ci_upper"] <= 1
    # log-log Greenwood bounds at the first step
    s, var = 0.8, 1 / 20
    shift = 1.959963984540054 * var**0.5 / log(s)
    assert curve[0]["ci_lower"] == pytest.approx(np.exp(-np.exp(np.log(-np.log(s)) - shift)))


def test_survival_reaches_zero_and_median(spark):
    curve = _curve(spark, [(1, 1), (2, 1)])
    last = curve.orderBy("time").collect()[-1]
    assert last["survival"] == 0.0 and last["ci_lower"] is None
    assert survival.median_survival(curve).first()[0] == 1.0
    at = {r["time"]: r["survival"] for r in survival.survival_at_times(curve, [0, 1, 9]).collect()}
    assert at == {0: 1.0, 1: 0.5, 9: 0.0}


def test_median_is_infinite_when_half_never_leave(spark):
    rows = [(1, 0, "a"), (2, 0, "a"), (1, 1, "b"), (1, 1, "b")]
    curve = _curve(spark, rows, by=["g"])
    assert {r["g"]: r["median_survival"] for r in survival.median_survival(curve, ["g"]).collect()} == {"a": inf, "b": 1.0}


def _retail(spark, rows):
    return spark.createDataFrame(
        rows,
        "`Customer ID` long, Invoice string, StockCode string, Quantity int, InvoiceDate timestamp, TotalSpend double, "
        "Country string",
    )


def test_features_clip_after_the_monthly_rate(spark):
    rows = [
        (1, "a", "x", 1, START, 10.0, "B"),
        (1, "b", "x", 2, START + timedelta(hours=20), 5.0, "A"),
        (2, "c", "x", 1, START, 1.0, None),
        (2, "d", "y", 1, START + timedelta(days=60), 2.0, "C"),
        (3, "e", "z", 1, START + timedelta(days=100, hours=1), 7.0, "A"),
    ]
    got = {r["Customer ID"]: r for r in survival.survival_features(_retail(spark, rows)).collect()}
    one = got[1]
    assert (one["duration"], one["tenure_months"], one["days_since_last"], one["churned"]) == (1, 0.1, 99, 1)
    assert one["purchase_frequency"] == pytest.approx(20.0)
    assert (one["avg_order_value"], one["favourite_country"]) == (7.5, "A")
    assert (got[2]["duration"], got[2]["tenure_months"], got[2]["favourite_country"]) == (60, 2.0, "C")
    assert got[3]["churned"] == 0


def _numpy_cox(pdf, names, ridge):
    """Efron partial likelihood by plain loops over the sorted rows."""
    x = pdf[names].to_numpy()
    mean, spread = x.mean(0), x.std(0, ddof=1)
    x = (x - mean) / spread
    t, e = pdf.duration.to_numpy(), pdf.churned.to_numpy()
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        g, h = -ridge * beta, -ridge * np.eye(len(beta))
        w = np.exp(x @ beta)
        for time in np.unique(t[e == 1]):
            tied = (t == time) & (e == 1)
            risk = t >= time
            d = tied.sum()
            g = g + x[tied].sum(0)
            for step in range(d):
                weight = np.where(risk, w, 0) - step / d * np.where(tied, w, 0)
                s0 = weight.sum()
                s1 = weight @ x / s0
                g = g - s1
                h = h - ((x * weight[:, None]).T @ x / s0 - np.outer(s1, s1))
        move = np.linalg.solve(-h, g)
        beta = beta + move
        if np.abs(move).max() < 1e-12:
            break
    return beta / spread, np.sqrt(np.diag(np.linalg.inv(-h))) / spread


@pytest.mark.parametrize(("penalty", "scale"), [(0.1, "per_row"), (0.1, "total"), (1e-8, "total")])
def test_cox_equals_numpy(spark, monkeypatch, penalty, scale):
    rng = np.random.default_rng(3)
    n = 150
    a, b = rng.normal(size=n), rng.normal(size=n)
    pdf = pd.DataFrame(
        {
            "duration": np.ceil(rng.exponential(np.exp(-0.7 * a + 0.3 * b)) * 8).astype("int64"),
            "churned": (rng.random(n) < 0.7).astype("int32"),
            "a": a,
            "b": b,
        }
    )
    # many ties in several chunks
    monkeypatch.setattr(cox, "FEW_TIES", 4)
    model = cox.fit_cox(spark.createDataFrame(pdf), ["a", "b"], penalty=penalty, penalty_scale=scale)
    coef, errors = _numpy_cox(pdf, ["a", "b"], penalty * (n if scale == "per_row" else 1))
    assert model.coef == pytest.approx(coef, abs=1e-6)
    assert model.std_err == pytest.approx(errors, rel=1e-5)
    table = cox.cox_coefficients(spark.createDataFrame(pdf), model).collect()
    assert [r["feature"] for r in table] == ["a", "b"] if coef[0] < coef[1] else ["b", "a"]
    assert all(r["direction"] == ("reduces" if r["coef"] < 0 else "increases") for r in table)
    effects = cox.cox_partial_effects(model, "a", [0.0, 1.0]).toPandas().sort_values(["a", "time"])
    for _, part in effects.groupby("a"):
        assert part.survival.is_monotonic_decreasing and part.survival.between(0, 1).all()


def test_cox_features_drop_incomplete_rows(spark):
    rows = [(5, 1, 1.0), (6, 0, None), (7, 0, inf), (8, 1, float("nan"))]
    df = spark.createDataFrame(rows, "duration long, churned int, a double")
    assert [tuple(r) for r in cox.cox_features(df, ["a"]).collect()] == [(5, 1, log(2.0))]


def test_tie_sums_equal_sums_over_all_events(spark):
    rows = []
    for d in (1, 2, 31, 32, 33, 40, 100, 1000, 12345, 1_000_000):
        for u in (1e-9, 1e-4, 0.03, 0.3, 0.5, 0.5000001, 0.7, 0.99, 1 - 1e-9, 1.0):
            rows.append((d, 7.5 * d, 7.5 * d * u))
    got = {(r["d"], r["T"]): r for r in cox.tie_sums(spark.createDataFrame(rows, "d long, R double, T double")).collect()}
    for d, big, small in rows:
        part = np.arange(d, dtype=np.longdouble) / d
        left = np.longdouble(big) - part * np.longdouble(small)
        expected = {"log_left": np.log(left), "i1": 1 / left, "f1": part / left, "i2": left**-2, "f2": part / left**2, "g2": part**2 / left**2}
        for name, terms in expected.items():
            assert got[d, small][name] == pytest.approx(float(terms.sum()), rel=1e-10, abs=1e-300), (d, small / big, name)
