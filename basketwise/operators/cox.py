"""Cox proportional hazards with Efron ties and a ridge penalty.

Every Newton step is one aggregation over all customers. It leaves one row per distinct duration;
durations are whole days, so the running sums over this table are bounded by the days the data spans.
Sums over tied events have closed forms. One row reaches the driver: the likelihood, its gradient and its Hessian.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement
from math import log, pi
from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketwise.session import materialise

COVARIATES = ["total_orders", "total_spend", "avg_order_value", "unique_products", "purchase_frequency"]
FEW_TIES = 32
_TERMS = 48  # 2 ** -48 is what the series leaves out at most, relative to the first term


def cox_features(features: DataFrame, covariates: Sequence[str] = COVARIATES) -> DataFrame:
    """Duration, event and log1p covariates; rows with an infinite or missing value are dropped."""
    logs = [F.log1p(F.col(c).cast("double")).alias(c) for c in covariates]
    finite = [
        F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(F.col(c)).alias(c) for c in covariates
    ]
    return features.select("duration", "churned", *logs).select("duration", "churned", *finite).dropna()


@dataclass
class CoxModel:
    """Fitted coefficients on the original scale, and what is needed to predict."""

    covariates: list[str]
    coef: np.ndarray
    std_err: np.ndarray
    means: np.ndarray
    baseline: DataFrame
    log_likelihood: float
    iterations: int
    spreads: np.ndarray
    ridge: float


def tie_sums(times: DataFrame) -> DataFrame:
    """``times`` with the sums over the d tied events of a time, with R and T the hazards at risk and of the events.

    The l-th of them (from 0) is at risk against left = R - (l/d) T. The sums are log_left of ln(left), i1 and i2 of 1 / left and
    1 / left^2, f1 and f2 of (l/d) / left and (l/d) / left^2, g2 of (l/d)^2 / left^2. No row is made per event. With
    u = T / R: up to ``FEW_TIES`` events are added up one by one; more are closed forms, of power sums of l/d in a series by u up to
    one half, and above as differences of log-gamma, digamma and trigamma functions.
    """
    sums = ["log", "s01", "s11", "s02", "s12", "s22"]  # of ln(1 - u l/d) and (l/d)^m / (1 - u l/d)^k as s{m}{k}

    def fold(steps: str, terms: dict[str, str], with_: str) -> str:
        start = ", ".join(f"'{name}', 0D" for name in sums)
        more = ", ".join(f"'{name}', s.{name} + {terms[name]}" for name in sums)
        return f"aggregate({steps}, named_struct({start}), (s, {with_}) -> named_struct({more}))"

    left = "(1 - u * l / d)"
    one_by_one = {"log": f"log1p(-u * l / d)", "s01": f"1 / {left}", "s11": f"l / d / {left}"}
    one_by_one |= {"s02": f"1 / ({left} * {left})", "s12": f"l / d / ({left} * {left})", "s22": f"l / d * l / d / ({left} * {left})"}
    few = fold("sequence(0L, d - 1)", one_by_one, "l")

    # sums of (l/d)^q: Bernoulli's formula, whose k-th term needs q > 2 k - 1
    power = "q.d / (q.i + 1) - 0.5D"
    falling = "q.i"
    for k, divisor in enumerate([12, -720, 30240, -1209600, 47900160], start=1):
        power += f" + if(q.i > {2 * k - 1}, {falling} / ({divisor}D * pow(q.d, {2 * k - 1})), 0D)"
        falling += f" * (q.i - {2 * k - 1}) * (q.i - {2 * k})"
    powers = f"transform(sequence(0, {_TERMS + 2}), i -> named_struct('i', CAST(i AS DOUBLE), 'd', CAST(d AS DOUBLE)))"
    powers = f"transform({powers}, q -> if(q.i = 0, q.d, {power}))"
    series = {"log": "-if(j = 0, 0D, pow(u, j) / j * p[j])", "s01": "pow(u, j) * p[j]", "s11": "pow(u, j) * p[j + 1]"}
    series |= {"s02": "(j + 1) * pow(u, j) * p[j]", "s12": "(j + 1) * pow(u, j) * p[j + 1]", "s22": "(j + 1) * pow(u, j) * p[j + 2]"}
    many = fold(f"sequence(0, {_TERMS})", series, "j")

    # sums of ln(a - l), 1 / (a - l) and 1 / (a - l)^2 with a = d / u, from functions at a + 1 and a - d + 1 = low
    near = {
        "log": "d * ln(u / d) + g0", "s01": "d / u * g1", "s11": "(a * g1 - d) / u", "s02": "d / u * d / u * g2",
        "s12": "d / u * (a * g2 - g1) / u", "s22": "(a * a * g2 - 2 * a * g1 + d) / u / u",
    }
    close = "named_struct(" + ", ".join(f"'{name}', {near[name]}" for name in sums) + ")"

    staged = times.selectExpr("*", "T / R AS u", "d / (T / R) AS a", "1 + d * (greatest(R - T, 0D) / T) AS low")
    staged = staged.selectExpr("*", f"CASE WHEN d > {FEW_TIES} AND u <= 0.5D THEN {powers} END AS p", *[
        f"CASE WHEN d > {FEW_TIES} AND u > 0.5D THEN {_polygamma(k, 'a + 1')} - {_polygamma(k, 'low')} END AS g{k}" for k in range(3)
    ])
    staged = staged.withColumn("g2", -F.col("g2"))
    staged = staged.selectExpr("*", f"CASE WHEN d <= {FEW_TIES} THEN {few} WHEN u <= 0.5D THEN {many} ELSE {close} END AS s")
    return staged.selectExpr(
        *[f"`{c}`" for c in times.columns], "d * ln(R) + s.log AS log_left", "s.s01 / R AS i1", "s.s11 / R AS f1", "s.s02 / R / R AS i2", "s.s12 / R / R AS f2",
        "s.s22 / R / R AS g2",
    )


def _polygamma(order: int, x: str) -> str:
    """Log-gamma (0), digamma (1) or trigamma (2) of a number of at least about 1: asymptotic series after ten upward steps."""
    y = f"({x} + 10)"
    steps = {0: f"ln({x} + i)", 1: f"1 / ({x} + i)", 2: f"-1 / (({x} + i) * ({x} + i))"}[order]
    # fixed values: Bernoulli numbers in the three series
    if order == 0:
        head = f"({y} - 0.5D) * ln({y}) - {y} + {0.5 * log(2 * pi)!r}D"
        tail = [(1 / 12, 1), (-1 / 360, 3), (1 / 1260, 5), (-1 / 1680, 7), (1 / 1188, 9)]
    elif order == 1:
        head = f"ln({y}) - 0.5D / {y}"
        tail = [(-1 / 12, 2), (1 / 120, 4), (-1 / 252, 6), (1 / 240, 8), (-1 / 132, 10)]
    else:
        head = f"1 / {y} + 0.5D / ({y} * {y})"
        tail = [(1 / 6, 3), (-1 / 30, 5), (1 / 42, 7), (-1 / 30, 9), (5 / 66, 11)]
    series = "".join(f" + {c!r}D / pow({y}, {n})" for c, n in tail)
    return f"({head}{series} - aggregate(sequence(0, 9), 0D, (s, i) -> s + {steps}))"


def _per_time(rows: DataFrame, p: int, beta: np.ndarray) -> DataFrame:
    """One row per duration: hazard-weighted moments of those leaving then, and of the events.

    Written as SQL text: some fifty sums are parsed faster in one place than built call by call.
    """
    eta = " + ".join(f"x{j} * {float(beta[j])!r}D" for j in range(p))
    sums = {"d": "CAST(churned AS LONG)", "h": "h", "eh": "e * h", "e_eta": "e * eta"}
    for j in range(p):
        sums |= {f"h_{j}": f"h * x{j}", f"eh_{j}": f"e * h * x{j}", f"e_{j}": f"e * x{j}"}
    for i, j in combinations_with_replacement(range(p), 2):
        sums |= {f"h_{i}_{j}": f"h * x{i} * x{j}", f"eh_{i}_{j}": f"e * h * x{i} * x{j}"}
    return (
        rows.selectExpr("*", f"{eta} AS eta", "CAST(churned AS DOUBLE) AS e")
        .selectExpr("*", "exp(eta) AS h")
        .groupBy("duration")
        .agg(*[F.expr(f"sum({value}) AS {name}") for name, value in sums.items()])
    )


def _risk_table(rows: DataFrame, p: int, beta: np.ndarray) -> DataFrame:
    """One row per duration: its own moments, and as R, s_j and s_i_j those of all at risk then."""
    later = "OVER (PARTITION BY 0 ORDER BY duration DESC)"  # one row per distinct duration
    sums = [f"sum(h) {later} AS R", "eh AS T"]
    sums += [f"sum(h_{j}) {later} AS s_{j}" for j in range(p)]
    sums += [f"sum(h_{i}_{j}) {later} AS s_{i}_{j}" for i, j in combinations_with_replacement(range(p), 2)]
    return _per_time(rows, p, beta).selectExpr("*", *sums)


def derivatives_row(rows: DataFrame, p: int, beta: np.ndarray) -> DataFrame:
    """One row with the partial log-likelihood at ``beta``, its gradient g_j and its Hessian h_i_j (i <= j).

    ``rows``: duration, churned, x0 to x{p-1}.
    """
    table = _risk_table(rows, p, beta)
    joined = tie_sums(table.where("d > 0")).unionByName(table.where("d = 0"), allowMissingColumns=True)
    sums = ["sum(e_eta) - coalesce(sum(log_left), 0D) AS likelihood"]
    for j in range(p):
        sums.append(f"sum(e_{j}) - coalesce(sum(s_{j} * i1 - eh_{j} * f1), 0D) AS g_{j}")
    for i, j in combinations_with_replacement(range(p), 2):
        square = (
            f"s_{i}_{j} * i1 - eh_{i}_{j} * f1 - s_{i} * s_{j} * i2 + (s_{i} * eh_{j} + eh_{i} * s_{j}) * f2 - eh_{i} * eh_{j} * g2"
        )
        sums.append(f"-coalesce(sum({square}), 0D) AS h_{i}_{j}")
    return joined.selectExpr(*sums)


def _derivatives(rows: DataFrame, p: int, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    row = derivatives_row(rows, p, beta).first()
    hessian = np.empty((p, p))
    for i, j in combinations_with_replacement(range(p), 2):
        hessian[i, j] = hessian[j, i] = row[f"h_{i}_{j}"]
    return row["likelihood"], np.array([row[f"g_{j}"] for j in range(p)]), hessian


def fit_cox(
    features: DataFrame,
    covariates: Sequence[str] = COVARIATES,
    penalty: float = 0.1,
    penalty_scale: str = "per_row",
    max_iter: int = 50,
    tolerance: float = 1e-9,
) -> CoxModel:
    """Newton's method on standardised covariates.

    The ridge term is ``penalty / 2 * |beta|^2`` on the standardised scale, times the number of rows
    with ``penalty_scale='per_row'`` and as it is with ``'total'``.
    """
    names, p = list(covariates), len(covariates)
    source = materialise(features.select("duration", "churned", *names), "cox")
    row = source.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m_{c}") for c in names],
        *[F.stddev_samp(c).alias(f"s_{c}") for c in names],
    ).first()
    means = np.array([row[f"m_{c}"] for c in names])
    spreads = np.array([row[f"s_{c}"] or 1.0 for c in names])
    rows = source.select(
        "duration",
        "churned",
        *[((F.col(c) - float(m)) / float(s)).alias(f"x{j}") for j, (c, m, s) in enumerate(zip(names, means, spreads, strict=True))],
    )
    ridge = penalty * (row["n"] if penalty_scale == "per_row" else 1)

    def penalised(beta: np.ndarray):
        value, gradient, hessian = _derivatives(rows, p, beta)
        return value - ridge / 2 * beta @ beta, gradient - ridge * beta, hessian - ridge * np.eye(p), value

    rows = rows.persist()
    try:
        beta = np.zeros(p)
        value, gradient, hessian, plain = penalised(beta)
        done = 0
        for done in range(1, max_iter + 1):
            move = np.linalg.solve(-hessian, gradient)
            scale = 1.0
            while True:
                trial = penalised(beta + scale * move)
                if trial[0] >= value - 1e-9 * abs(value) or scale < 1e-6:
                    break
                scale /= 2
            beta = beta + scale * move
            gain = abs(trial[0] - value)
            value, gradient, hessian, plain = trial
            if np.abs(scale * move).max() < tolerance or gain < tolerance * 1e-3 * abs(value):
                break
        baseline = materialise(baseline_steps(rows, p, beta), "baseline")
    finally:
        rows.unpersist()
    errors = np.sqrt(np.diag(np.linalg.inv(-hessian))) / spreads
    return CoxModel(names, beta / spreads, errors, means, baseline, float(plain), done, spreads, ridge)


def baseline_steps(rows: DataFrame, p: int, beta: np.ndarray) -> DataFrame:
    """(time, step) of Breslow's cumulative hazard for a customer with all covariates zero."""
    steps = _risk_table(rows, p, beta).where("d > 0")
    return steps.select(F.col("duration").cast("long").alias("time"), (F.col("d") / F.col("R")).alias("step"))


def optimum_check(features: DataFrame, model: CoxModel) -> DataFrame:
    """(feature, gradient): the penalised gradient at the fitted coefficients, per row and standard deviation.

    It is computed anew from the features on their own scale. At the only maximum of the concave function all are zero.
    """
    p = len(model.covariates)
    centred = [(F.col(c) - float(m)).alias(f"x{j}") for j, (c, m) in enumerate(zip(model.covariates, model.means, strict=True))]
    rows = features.select("duration", "churned", *centred)
    _, gradient, _ = _derivatives(rows, p, model.coef)
    n = max(1, rows.count())
    left = (gradient / model.spreads - model.ridge * model.coef * model.spreads) / n
    return features.sparkSession.createDataFrame(list(zip(model.covariates, left.tolist())), "feature string, gradient double")


def cox_coefficients(features: DataFrame, model: CoxModel, alpha: float = 0.05) -> DataFrame:
    """Coefficients in ascending order with hazard ratio, error, z, p and direction."""
    normal = NormalDist()
    width = normal.inv_cdf(1 - alpha / 2)
    rows = []
    for name, coef, error in zip(model.covariates, model.coef.tolist(), model.std_err.tolist(), strict=True):
        z = coef / error
        rows.append((name, coef, error, coef - width * error, coef + width * error, z, 2 * normal.cdf(-abs(z))))
    table = features.sparkSession.createDataFrame(
        rows, "feature string, coef double, se_coef double, coef_lower double, coef_upper double, z double, p double"
    )
    return (
        table.withColumn("exp_coef", F.exp("coef"))
        .withColumn("direction", F.when(F.col("coef") < 0, "reduces").otherwise("increases"))
        .orderBy("coef", "feature")
    )


def cox_partial_effects(
    model: CoxModel, covariate: str = "purchase_frequency", values: Sequence[float] = (0.5, 1.0, 2.0, 3.0)
) -> DataFrame:
    """Survival curves with one covariate set to given values (on the log1p scale), the others at their means."""
    at = model.covariates.index(covariate)
    # the steps are Breslow's for standardised covariates, that is, at the means
    # one row per distinct duration
    hazard = F.sum("step").over(Window.partitionBy(F.lit(0)).orderBy("time"))
    profiles = F.array(
        *[
            F.struct(
                F.lit(float(v)).alias("value"),
                F.lit(float(np.exp((v - model.means[at]) * model.coef[at]))).alias("ratio"),
            )
            for v in values
        ]
    )
    return (
        model.baseline.withColumn("hazard", hazard)
        .select("time", "hazard", F.explode(profiles).alias("p"))
        .select("time", F.col("p.value").alias(covariate), F.exp(-F.col("hazard") * F.col("p.ratio")).alias("survival"))
    )

