"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

import re

from itertools import combinations_with_replacement

from basketwise.sources.lexicon import fixture_lists


# Fixed values, written out once more so that the two sides can disagree.
STOPWORDS = (
    "the a an and or but in on at to for of with is it this that was are be as have has had i my we you your "
    "they their not no so just very also one use used product food item order buy bought get got"
).split()
PUNCTUATION = r"!-/:-@\[-`{-~"


def _even(value: str, digits: int) -> str:
    return f"(round_even(({value}) * 1e{digits}, 0) / 1e{digits})"


def _sum(value: str, scale: int = 4) -> str:
    return f"CAST(SUM(CAST({value} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def _mean(value: str, scale: int = 4) -> str:
    return f"({_sum(value, scale)} / COUNT({value}))"


def _pct(condition: str) -> str:
    return f"(COUNT(*) FILTER (WHERE {condition}) * 100.0::DOUBLE / COUNT(*))"


def _values(rows: list[str]) -> str:
    return "(VALUES " + ", ".join(rows) + ")"


_WORDS, _BOOSTERS, _NEGATIONS = fixture_lists()
_CANCELLED = "(l_returnflag = 'R' AND l_linestatus = 'F')"
_RANK_KEY = "(dot::DOUBLE * dot::DOUBLE) / n2b::DOUBLE"


def _score(metric: str, reverse: bool) -> str:
    share = (
        f"((rank() OVER (ORDER BY {metric}) + (COUNT(*) OVER (PARTITION BY {metric}) - 1) / 2::DOUBLE)"
        " / (COUNT(*) OVER ())::DOUBLE)"
    )
    if reverse:
        share = f"(1 - {share})"
    return (
        f"CASE WHEN {share} <= 0.2::DOUBLE THEN 1 WHEN {share} <= 0.4::DOUBLE THEN 2 WHEN {share} <= 0.6::DOUBLE THEN 3 "
        f"WHEN {share} <= 0.8::DOUBLE THEN 4 ELSE 5 END"
    )


def _upper(word: str) -> str:
    return f"(upper({word}) = {word} AND lower({word}) <> {word})"


def _damped(j: int) -> str:
    louder = f"CASE WHEN {_upper(f'w{j}')} AND mixed THEN 0.733::DOUBLE ELSE 0 END"
    return (
        f"v + CASE WHEN w{j} IS NOT NULL AND l{j} IS NULL AND b{j} IS NOT NULL THEN "
        f"((CASE WHEN v < 0 THEN -b{j} ELSE b{j} END) + (CASE WHEN v > 0 THEN {louder} ELSE -({louder}) END))"
        f" * { {1: 1.0, 2: 0.95, 3: 0.9}[j] }::DOUBLE ELSE 0 END"
    )


def _turned(j: int) -> str:
    special = {
        1: "",
        2: "WHEN lower(w2) = 'never' AND lower(w1) IN ('so', 'this') THEN 1.25 "
        "WHEN lower(w2) = 'without' AND lower(w1) = 'doubt' THEN 1.0 ",
        3: "WHEN lower(w3) = 'never' AND (lower(w2) IN ('so', 'this') OR lower(w1) IN ('so', 'this')) THEN 1.25 "
        "WHEN lower(w3) = 'without' AND (lower(w2) = 'doubt' OR lower(w1) = 'doubt') THEN 1.0 ",
    }[j]
    return (
        f"v * CASE WHEN w{j} IS NULL OR l{j} IS NOT NULL THEN 1.0 {special}"
        f"WHEN n{j} IS NOT NULL OR contains(lower(w{j}), 'n''t') THEN -0.74 ELSE 1.0 END::DOUBLE"
    )


def _neighbours(k: int | None) -> str:
    best = "" if k is None else f" WHERE rank <= {k}"
    return f"""
        SELECT a AS CustomerID, b AS neighbour,
               dot::DOUBLE / (sqrt(n2a::DOUBLE) * sqrt(n2b::DOUBLE)) AS similarity, CAST(rank AS INTEGER) AS rank
        FROM ranked_pairs{best}"""


def _recommended(source: str, n: int) -> str:
    return f"""
        SELECT CustomerID, CAST(rank AS INTEGER) AS rank, StockCode, {_even("points / 1e9", 3)} AS Score, Description
        FROM (SELECT *, row_number() OVER (PARTITION BY CustomerID ORDER BY points DESC, StockCode) AS rank
              FROM (SELECT t.CustomerID, m.StockCode,
                           SUM(CAST(round_even(t.similarity * 1e9, 0) AS BIGINT) * m.PurchaseCount)::BIGINT AS points
                    FROM {source} t JOIN purchase_matrix m ON m.CustomerID = t.neighbour
                    GROUP BY 1, 2) s
              WHERE NOT EXISTS (SELECT 1 FROM purchase_matrix o
                                WHERE o.CustomerID = s.CustomerID AND o.StockCode = s.StockCode)) r
        LEFT JOIN descriptions USING (StockCode)
        WHERE rank <= {n}"""


def _kaplan_meier(source: str, by: str = "") -> str:
    keys, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    return f"""
        SELECT {keys}time, at_risk, events, censored, survival,
               CASE WHEN survival = 1 THEN 1.0 WHEN survival > 0 THEN exp(-exp(ln(-ln(survival)) - shift)) END AS ci_lower,
               CASE WHEN survival = 1 THEN 1.0 WHEN survival > 0 THEN exp(-exp(ln(-ln(survival)) + shift)) END AS ci_upper
        FROM (SELECT *, CASE WHEN survival > 0 AND survival < 1
                             THEN 1.959963984540054 * sqrt(hazard_var) / ln(survival) END AS shift
              FROM (SELECT *, product(1 - events / at_risk::DOUBLE) OVER ({part}ORDER BY time) AS survival,
                           SUM(CASE WHEN at_risk > events
                               THEN events / (at_risk * (at_risk - events))::DOUBLE END) OVER ({part}ORDER BY time) AS hazard_var
                    FROM (SELECT *, CAST(SUM(leaving) OVER ({part}ORDER BY time DESC) AS BIGINT) AS at_risk
                          FROM (SELECT {keys}duration AS time, CAST(SUM(churned) AS BIGINT) AS events,
                                       CAST(COUNT(*) - SUM(churned) AS BIGINT) AS censored, COUNT(*) AS leaving
                                FROM {source} GROUP BY ALL))))"""


def _histogram(source: str, column: str, bins: int) -> str:
    return f"""
        SELECT CAST(bin AS INTEGER) AS bin, low + width * (bin - 1) AS bin_start, low + width * bin AS bin_end,
               COUNT(v) AS count, mean AS mean_value
        FROM (SELECT MIN({column})::DOUBLE AS low, MAX({column})::DOUBLE AS high,
                     (MAX({column})::DOUBLE - MIN({column})::DOUBLE) / {bins}::DOUBLE AS width, {_mean(column)} AS mean
              FROM {source})
        CROSS JOIN range(1, {bins + 1}) r(bin)
        LEFT JOIN (SELECT {column}::DOUBLE AS v FROM {source}) x
               ON LEAST(floor({bins} * (v - low) / (high - low)) + 1, {bins}) = bin
        GROUP BY bin, low, high, width, mean"""


def _describe(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS metric, COUNT({c}) AS count, {_even(_mean(c), 2)} AS mean,
                   {_even(f"stddev_samp({c})", 2)} AS std, {_even(f"MIN({c})::DOUBLE", 2)} AS min,
                   {_even(f"MAX({c})::DOUBLE", 2)} AS max,
                   {_even(f"quantile_cont({c}::DOUBLE, 0.25)", 2)} AS q25,
                   {_even(f"quantile_cont({c}::DOUBLE, 0.5)", 2)} AS q50,
                   {_even(f"quantile_cont({c}::DOUBLE, 0.75)", 2)} AS q75
            FROM {source}"""
        for c in columns
    )


def _shares(source: str, column: str) -> str:
    return (
        f"SELECT {column}, COUNT(*) AS count, {_even('COUNT(*) / (SUM(COUNT(*)) OVER ())::DOUBLE * 100', 1)} AS percentage "
        f"FROM {source} GROUP BY {column}"
    )


def _word_counts(label: str, n: int) -> str:
    stop = ", ".join(f"'{w}'" for w in STOPWORDS)
    return f"""
        SELECT word, COUNT(*) AS count
        FROM (SELECT unnest(string_split_regex(regexp_replace(lower(Text), '[^a-z\\s]', '', 'g'), '\\s+')) AS word
              FROM (SELECT Text FROM scored_reviews WHERE vader_sentiment = '{label}'  ))
        WHERE length(word) > 3 AND word NOT IN ({stop})
        GROUP BY word ORDER BY count DESC, word LIMIT {n}"""


def _summary(source: str, label: str) -> str:
    return f"""
        SELECT *, {_even("churn_rate * 100", 1)} AS churn_rate_pct,
               {_even("total_revenue / CAST(SUM(CAST(total_revenue AS DECIMAL(24,4))) OVER () AS DOUBLE) * 100", 1)} AS revenue_share_pct
        FROM (SELECT {label}, COUNT(*) AS customer_count, {_even(_mean("Recency"), 2)} AS avg_recency,
                     {_even(_mean("Frequency"), 2)} AS avg_frequency, {_even(_mean("Monetary"), 2)} AS avg_monetary,
                     {_even(_sum("Monetary"), 2)} AS total_revenue, {_even(_mean("churned"), 2)} AS churn_rate,
                     {_even(_mean("duration"), 2)} AS avg_tenure_days, {_even(_mean("avg_order_value", 9), 2)} AS avg_order_value
              FROM {source} GROUP BY {label})"""


def _padded_lists(n: int) -> str:
    return f"""
        SELECT CustomerID, CAST(rank AS INTEGER) AS rank, StockCode, {_even("points / 1e9", 3)} AS Score, Description
        FROM (SELECT *, row_number() OVER (PARTITION BY CustomerID ORDER BY points DESC, StockCode) AS rank
              FROM (SELECT c.CustomerID, p.StockCode, coalesce(s.points, 0) AS points
                    FROM (SELECT DISTINCT CustomerID FROM purchase_matrix) c CROSS JOIN (SELECT DISTINCT StockCode FROM purchase_matrix) p
                    LEFT JOIN (SELECT t.CustomerID, m.StockCode,
                                      SUM(CAST(round_even(t.similarity * 1e9, 0) AS BIGINT) * m.PurchaseCount)::BIGINT AS points
                               FROM top_neighbours t JOIN purchase_matrix m ON m.CustomerID = t.neighbour WHERE t.rank = 1
                               GROUP BY 1, 2) s USING (CustomerID, StockCode)
                    WHERE NOT EXISTS (SELECT 1 FROM purchase_matrix o WHERE o.CustomerID = c.CustomerID AND o.StockCode = p.StockCode)))
        LEFT JOIN descriptions USING (StockCode)
        WHERE rank <= {n}"""


def _cox_derivatives(names: list[str], beta: list[float]) -> str:
    """Efron's partial likelihood: each tied event is a row with the moments of those at risk, less its share of the tied."""
    p = range(len(names))
    pairs = list(combinations_with_replacement(p, 2))
    moments = ["exp(eta)", *[f"exp(eta) * x{j}" for j in p], *[f"exp(eta) * x{i} * x{j}" for i, j in pairs]]
    own = ", ".join(f"SUM({m}) AS m{n}, SUM(e * {m}) AS t{n}" for n, m in enumerate(moments))
    run = ", ".join(f"SUM(m{n}) OVER (ORDER BY duration DESC) AS r{n}" for n in range(len(moments)))
    left = ", ".join(f"r{n} - l / d * t{n} AS a{n}" for n in range(len(moments)))
    events = ", ".join(["SUM(e * eta) AS ee", *[f"SUM(e * x{j}) AS e{j}" for j in p]])
    of_pair = {pair: 1 + len(names) + n for n, pair in enumerate(pairs)}
    out = [f"{_even('(SELECT ee FROM events) - SUM(ln(a0))', 3)} AS likelihood"]
    out += [_even(f"(SELECT e{j} FROM events) - SUM(a{1 + j} / a0)", 3) + f" AS g_{j}" for j in p]
    out += [_even(f"-SUM(a{of_pair[i, j]} / a0 - a{1 + i} / a0 * (a{1 + j} / a0))", 3) + f" AS h_{i}_{j}" for i, j in pairs]
    eta = " + ".join(f"{b}::DOUBLE * x{j}" for j, b in enumerate(beta))
    return f"""
        SELECT * FROM (WITH x AS (SELECT duration, churned::DOUBLE AS e, {", ".join(f"ln(1 + {c}::DOUBLE) AS x{j}" for j, c in enumerate(names))} FROM features),
        y AS (SELECT *, {eta} AS eta FROM x),
        events AS (SELECT {events} FROM y),
        per_day AS (SELECT duration, SUM(e) AS d, {own} FROM y GROUP BY 1),
        at_risk AS (SELECT *, {run} FROM per_day),
        each AS (SELECT *, unnest(range(0, d::BIGINT)) AS l FROM at_risk WHERE d > 0),
        remaining AS (SELECT {left} FROM each)
        SELECT {", ".join(out)} FROM remaining)"""


def _cox_effects(names: list[str], beta: list[float], shown: str, values: list[float]) -> str:
    """Breslow's hazard at the given coefficients, and the survival it leaves with one covariate set to values, the others zero."""
    eta = " + ".join(f"{b}::DOUBLE * ln(1 + {c}::DOUBLE)" for b, c in zip(beta, names, strict=True))
    listed = ", ".join(f"({v}::DOUBLE)" for v in values)
    return f"""
        SELECT * FROM (WITH per_day AS (SELECT duration, SUM(churned) AS d, SUM(exp({eta})) AS h FROM features GROUP BY 1),
        at_risk AS (SELECT duration, d, SUM(h) OVER (ORDER BY duration DESC) AS r FROM per_day),
        steps AS (SELECT duration::BIGINT AS time, SUM(d / r) OVER (ORDER BY duration) AS hazard FROM at_risk WHERE d > 0)
        SELECT time, v AS {shown}, {_even(f"exp(-hazard * exp({beta[names.index(shown)]}::DOUBLE * v))", 9)} AS survival FROM steps, (VALUES {listed}) t(v))"""


def _metric_rows(run: str, metrics: dict[str, str], parameters: dict[str, object]) -> str:
    rows = [
        f"SELECT '{run}' AS run, 'metric' AS kind, '{key}' AS key, CAST(({sql}) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text"
        for key, sql in metrics.items()
    ]
    for key, value in parameters.items():
        number = isinstance(value, (int, float))
        rows.append(
            f"SELECT '{run}', 'parameter', '{key}', {f'{value}::DOUBLE' if number else 'CAST(NULL AS DOUBLE)'}, "
            + ("CAST(NULL AS VARCHAR)" if number else f"'{value}'")
        )
    return " UNION ALL ".join(rows)


_RETAIL_STEPS = [
    ("raw", "TRUE"),
    ("null customer", '"Customer ID" IS NOT NULL'),
    ("cancelled", "Invoice NOT LIKE 'C%'"),
    ("quantity not positive", "Quantity > 0"),
    ("price not positive", "Price > 0"),
]


def _retail_funnel() -> str:
    rows, rule = [], []
    for step, (name, condition) in enumerate(_RETAIL_STEPS):
        rule.append(condition)
        kept = f"COUNT(*) FILTER (WHERE {' AND '.join(rule)})"
        rows.append(f"SELECT {step} AS step, '{name}' AS stage, {kept} AS rows, COUNT(*) - {kept} AS removed FROM retail_raw")
    return " UNION ALL ".join(rows)


def _missing(source: str, columns: list[str]) -> str:
    rows = [
        f"""SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE "{c}" IS NULL) AS missing_count,
                   {_even(f'COUNT(*) FILTER (WHERE "{c}" IS NULL) / COUNT(*)::DOUBLE * 100', 2)} AS missing_pct FROM {source}"""
        for c in columns
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(rows)}) WHERE missing_count > 0"


_REVIEW_COLUMNS = "ProductId, UserId, Rating, Summary, Text, Time, ReviewDate, ReviewLength"
_COX = ["total_orders", "total_spend", "avg_order_value", "unique_products", "purchase_frequency"]
_RETAIL_COLUMNS = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"]
_RETAIL_LIST = ", ".join(f'"{c}"' for c in _RETAIL_COLUMNS)

# Named steps, each built on earlier ones.
STEPS = {
    "retail_raw": f"""
        SELECT CASE WHEN {_CANCELLED} THEN 'C' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS Invoice,
               CAST(l_partkey AS VARCHAR) AS StockCode, p_name AS Description,
               CAST(CASE WHEN {_CANCELLED} THEN -l_quantity WHEN l_linenumber = 7 AND l_discount = 0 THEN 0
                    ELSE l_quantity END AS INTEGER) AS Quantity,
               o_orderdate + to_minutes(o_orderkey % 1440) AS InvoiceDate,
               CASE WHEN l_linenumber = 1 AND l_tax = 0.08 THEN 0::DOUBLE ELSE p_retailprice END AS Price,
               CASE WHEN o_orderkey % 20 <> 0 THEN CAST(o_custkey AS DOUBLE) END AS "Customer ID", n_name AS Country,
               row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) AS ordinal
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
             JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "reviews_raw": """
        SELECT doc_id AS Id, 'P' || CAST(n_chars % 150 AS VARCHAR) AS ProductId, 'U' || CAST(doc_id % 40 AS VARCHAR) AS UserId,
               CAST(n_chars % 5 + 1 AS INTEGER) AS Score,
               CASE WHEN doc_id % 50 <> 0 THEN string_split(text, '.')[1] END AS Summary,
               CASE WHEN doc_id % 97 <> 0 THEN text END AS Text, 1041379200 + doc_id % 450 * 86400 AS Time
        FROM documents""",
    "retail": """
        SELECT Invoice, StockCode, Description, Quantity, InvoiceDate, Price, CAST("Customer ID" AS BIGINT) AS "Customer ID",
               Country, Quantity * Price AS TotalSpend, CAST(year(InvoiceDate) AS INTEGER) AS Year,
               CAST(month(InvoiceDate) AS INTEGER) AS Month, dayname(InvoiceDate) AS Day, ordinal
        FROM retail_raw
        WHERE "Customer ID" IS NOT NULL AND Invoice NOT LIKE 'C%' AND Quantity > 0 AND Price > 0""",
    "reviews": """
        SELECT ProductId, UserId, Score AS Rating, Summary, Text, Time, make_timestamp(Time * 1000000) AS ReviewDate,
               CAST(length(Text) AS INTEGER) AS ReviewLength, Id AS ordinal
        FROM (SELECT *, row_number() OVER (PARTITION BY UserId, ProductId ORDER BY Id) AS n
              FROM reviews_raw WHERE Text IS NOT NULL AND Summary IS NOT NULL)
        WHERE n = 1""",
    "descriptions": "SELECT StockCode, arg_min(Description, ordinal) AS Description FROM retail GROUP BY StockCode",
    "rfm": f"""
        SELECT "Customer ID" AS CustomerID,
               date_sub('day', MAX(InvoiceDate), (SELECT MAX(InvoiceDate) FROM retail)) AS Recency,
               COUNT(DISTINCT Invoice) AS Frequency, {_sum("TotalSpend")} AS Monetary
        FROM retail GROUP BY 1""",
    "scores": f"""
        SELECT *, R_Score + F_Score + M_Score AS RFM_Score
        FROM (SELECT *, {_score("Recency", True)} AS R_Score, {_score("Frequency", False)} AS F_Score,
                     {_score("Monetary", False)} AS M_Score FROM rfm)""",
    "segments": """
        SELECT *, CASE WHEN RFM_Score >= 13 THEN 'Champions' WHEN RFM_Score >= 10 THEN 'Loyal Customers'
                       WHEN RFM_Score >= 7 THEN 'At Risk' ELSE 'Lost' END AS RFM_Segment
        FROM scores""",
    "clustered": """
        SELECT CustomerID, Recency, Frequency, Monetary, CAST(CASE RFM_Segment WHEN 'Champions' THEN 0 WHEN 'Loyal Customers' THEN 1
                   WHEN 'At Risk' THEN 2 ELSE 3 END AS INTEGER) AS Cluster FROM segments""",
    "profile": f"""
        SELECT Cluster, {_even(_mean("Recency"), 2)} AS Recency, {_even(_mean("Frequency"), 2)} AS Frequency,
               {_even(_mean("Monetary"), 2)} AS Monetary FROM clustered GROUP BY 1""",
    "labelled_profile": """
        SELECT *, CASE WHEN Recency < (SELECT median(Recency) FROM profile) THEN
                            CASE WHEN Monetary > (SELECT median(Monetary) FROM profile) THEN 'Champions' ELSE 'Loyal Customers' END
                       WHEN Monetary > (SELECT median(Monetary) FROM profile) THEN 'At Risk' ELSE 'Lost Customers' END AS Cluster_Label
        FROM profile""",
    "favourites": """
        SELECT "Customer ID", Country AS favourite_country
        FROM (SELECT *, row_number() OVER (PARTITION BY "Customer ID" ORDER BY times DESC, Country) AS n
              FROM (SELECT "Customer ID", Country, COUNT(*) AS times FROM retail GROUP BY 1, 2))
        WHERE n = 1""",
    "history": f"""
        SELECT "Customer ID", MIN(InvoiceDate) AS first_purchase, MAX(InvoiceDate) AS last_purchase,
               COUNT(DISTINCT Invoice) AS total_orders, {_sum("TotalSpend")} AS total_spend,
               CAST(SUM(Quantity) AS BIGINT) AS total_items, COUNT(DISTINCT StockCode) AS unique_products,
               {_mean("TotalSpend")} AS avg_order_value
        FROM retail GROUP BY 1""",
    "features": """
        SELECT *, total_orders / tenure_months AS purchase_frequency
        FROM (SELECT "Customer ID", first_purchase, last_purchase, total_orders, total_spend, total_items, unique_products,
                     avg_order_value, favourite_country, GREATEST(days, 1) AS duration, days_since_last,
                     CAST(days_since_last > 90 AS INTEGER) AS churned, GREATEST(days / 30::DOUBLE, 0.1::DOUBLE) AS tenure_months
              FROM (SELECT *, date_sub('day', first_purchase, last_purchase) AS days,
                           date_sub('day', last_purchase, (SELECT MAX(InvoiceDate) FROM retail)) AS days_since_last
                    FROM history JOIN favourites USING ("Customer ID")))""",
    "survival": """
        SELECT f.*, CASE WHEN total_spend >= upper_cut THEN 'High Value' WHEN total_spend >= middle_cut THEN 'Medium Value'
                         ELSE 'Low Value' END AS segment
        FROM features f CROSS JOIN (SELECT quantile_cont(total_spend, 0.5) AS middle_cut,
                                           quantile_cont(total_spend, 0.75) AS upper_cut FROM features)""",
    "at_risk_customers": f"""
        SELECT *, {_even('''days_since_last / 90::DOUBLE * 0.5::DOUBLE + 1 / GREATEST(total_orders, 1)::DOUBLE * 0.3::DOUBLE
                          + 1 / GREATEST(total_spend, 1::DOUBLE) * 0.2::DOUBLE''', 4)} AS risk_score
        FROM survival WHERE churned = 0 AND days_since_last BETWEEN 60 AND 90""",
    "curve": _kaplan_meier("features"),
    "segment_curves": _kaplan_meier("survival", "segment"),
    "purchase_matrix": """
        SELECT "Customer ID" AS CustomerID, StockCode, CAST(SUM(Quantity) AS BIGINT) AS PurchaseCount
        FROM retail GROUP BY 1, 2 HAVING SUM(Quantity) > 0""",
    "lengths": "SELECT CustomerID, SUM(PurchaseCount * PurchaseCount) AS n2 FROM purchase_matrix GROUP BY 1",
    "pairs": """
        SELECT p.*, x.n2 AS n2a, y.n2 AS n2b
        FROM (SELECT a.CustomerID AS a, b.CustomerID AS b, SUM(a.PurchaseCount * b.PurchaseCount) AS dot
              FROM purchase_matrix a JOIN purchase_matrix b ON a.StockCode = b.StockCode AND a.CustomerID <> b.CustomerID
              GROUP BY 1, 2) p
        JOIN lengths x ON x.CustomerID = p.a JOIN lengths y ON y.CustomerID = p.b""",
    "ranked_pairs": f"SELECT *, row_number() OVER (PARTITION BY a ORDER BY {_RANK_KEY} DESC, b) AS rank FROM pairs",
    "top_neighbours": _neighbours(10),
    "recommendations": _recommended("top_neighbours", 5),
    "long_lists": _recommended("top_neighbours", 10),
    "coverage": """
        SELECT COUNT(DISTINCT StockCode) AS recommended_products, (SELECT COUNT(DISTINCT StockCode) FROM purchase_matrix) AS products,
               COUNT(DISTINCT StockCode) / (SELECT COUNT(DISTINCT StockCode) FROM purchase_matrix)::DOUBLE * 100 AS coverage_pct
        FROM long_lists""",
    "evaluation": f"""
        SELECT (SELECT {_even("SUM(coalesce(similarity, 0)) / (5 * COUNT(DISTINCT CustomerID))", 9)}
                FROM (SELECT DISTINCT CustomerID FROM purchase_matrix) LEFT JOIN (SELECT * FROM top_neighbours WHERE rank <= 5)
                USING (CustomerID)) AS avg_similarity,
               (SELECT {_even(_mean("mean", 9), 9)} FROM (SELECT CustomerID, {_mean("Score")} AS mean FROM long_lists
                GROUP BY 1)) AS avg_score""",
    "rec_summary": f"""
        SELECT CustomerID, {_mean("Score")} AS avg_rec_score, arg_min(Description, rank) AS top_rec_product
        FROM recommendations GROUP BY CustomerID""",
    "facts": """
        SELECT CustomerID, Recency, Frequency, Monetary, RFM_Score, RFM_Segment, duration, churned, total_orders,
               avg_order_value, days_since_last, segment
        FROM segments LEFT JOIN survival ON CustomerID = "Customer ID" """,
    "master_customers": "SELECT * FROM facts LEFT JOIN rec_summary USING (CustomerID)",
    "lexicon": f"SELECT * FROM {_values([f'({w!r}, {v}::DOUBLE)' for w, v in _WORDS.items()])} t(token, valence)",
    "boosters": f"SELECT * FROM {_values([f'({w!r}, {v}::DOUBLE)' for w, v in _BOOSTERS.items()])} t(token, weight)",
    "negations": f"SELECT DISTINCT token FROM {_values([f'({w!r})' for w in _NEGATIONS])} t(token)",
    "texts": """
        SELECT ordinal, 'Text' AS field, Text AS t FROM reviews
        UNION ALL SELECT ordinal, 'Summary', Summary FROM reviews""",
    "word_lists": f"""
        SELECT ordinal, field, t, list_transform(
                   list_filter(string_split_regex(t, '\\s+'), lambda w: w <> ''),
                   lambda w: CASE WHEN length(regexp_replace(w, '^[{PUNCTUATION}]+|[{PUNCTUATION}]+$', '', 'g')) <= 2 THEN w
                             ELSE regexp_replace(w, '^[{PUNCTUATION}]+|[{PUNCTUATION}]+$', '', 'g') END) AS words
        FROM texts""",
    "marked": f"""
        SELECT ordinal, field, words, loud > 0 AND loud < len(words) AS mixed, but_at,
               LEAST(marks, 4) * 0.292::DOUBLE
               + CASE WHEN doubts <= 1 THEN 0 WHEN doubts <= 3 THEN doubts * 0.18::DOUBLE
                      ELSE 0.96::DOUBLE END AS emphasis
        FROM (SELECT *, len(list_filter(words, lambda w: {_upper("w")})) AS loud,
                     coalesce(list_position(list_transform(words, lambda w: lower(w)), 'but'), 0) AS but_at,
                     length(t) - length(replace(t, '!', '')) AS marks, length(t) - length(replace(t, '?', '')) AS doubts
              FROM word_lists)""",
    "occurrences": """
        SELECT *, lag(w0, 1) OVER w AS w1, lag(w0, 2) OVER w AS w2, lag(w0, 3) OVER w AS w3
        FROM (SELECT ordinal, field, mixed, but_at, emphasis, unnest(words) AS w0, generate_subscripts(words, 1) AS spot
              FROM marked)
        WINDOW w AS (PARTITION BY ordinal, field ORDER BY spot)""",
    "hits": f"""
        SELECT o.*, x.valence + CASE WHEN {_upper("w0")} AND mixed THEN sign(x.valence) * 0.733::DOUBLE ELSE 0 END AS v,
               l1.valence AS l1, l2.valence AS l2, l3.valence AS l3, b1.weight AS b1, b2.weight AS b2, b3.weight AS b3,
               n1.token AS n1, n2.token AS n2, n3.token AS n3
        FROM occurrences o JOIN lexicon x ON x.token = lower(w0) LEFT JOIN boosters b0 ON b0.token = lower(w0)
             LEFT JOIN lexicon l1 ON l1.token = lower(w1) LEFT JOIN lexicon l2 ON l2.token = lower(w2)
             LEFT JOIN lexicon l3 ON l3.token = lower(w3) LEFT JOIN boosters b1 ON b1.token = lower(w1)
             LEFT JOIN boosters b2 ON b2.token = lower(w2) LEFT JOIN boosters b3 ON b3.token = lower(w3)
             LEFT JOIN negations n1 ON n1.token = lower(w1) LEFT JOIN negations n2 ON n2.token = lower(w2)
             LEFT JOIN negations n3 ON n3.token = lower(w3)
        WHERE b0.token IS NULL""",
    "near1": f"SELECT * REPLACE ({_damped(1)} AS v) FROM hits",
    "turn1": f"SELECT * REPLACE ({_turned(1)} AS v) FROM near1",
    "near2": f"SELECT * REPLACE ({_damped(2)} AS v) FROM turn1",
    "turn2": f"SELECT * REPLACE ({_turned(2)} AS v) FROM near2",
    "near3": f"SELECT * REPLACE ({_damped(3)} AS v) FROM turn2",
    "turn3": f"SELECT * REPLACE ({_turned(3)} AS v) FROM near3",
    "valences": f"""
        SELECT ordinal, field, emphasis,
               v * CASE WHEN lower(w1) = 'least' AND l1 IS NULL AND NOT coalesce(lower(w2) IN ('at', 'very'), FALSE)
                        THEN -0.74 ELSE 1.0 END::DOUBLE
                 * CASE WHEN but_at > 0 AND spot < but_at THEN 0.5
                        WHEN but_at > 0 AND spot > but_at THEN 1.5 ELSE 1.0 END::DOUBLE AS v
        FROM turn3""",
    "compounds": f"""
        SELECT ordinal, field, {_even(f"pushed / sqrt(pushed * pushed + 15.0::DOUBLE)", 4)} AS compound
        FROM (SELECT ordinal, field, CASE WHEN total > 0 THEN total + emphasis WHEN total < 0 THEN total - emphasis ELSE 0 END AS pushed
              FROM (SELECT ordinal, field, SUM(CAST(round_even(v * 1e9, 0) AS BIGINT))::DOUBLE / 1e9 AS total,
                           MAX(emphasis) AS emphasis FROM valences GROUP BY ALL))""",
    "scored_reviews": """
        SELECT *, CASE WHEN vader_compound >= 0.05 THEN 'Positive' WHEN vader_compound <= -0.05 THEN 'Negative'
                       ELSE 'Neutral' END AS vader_sentiment, strftime(ReviewDate, '%Y-%m') AS YearMonth
        FROM (SELECT r.*, coalesce(x.compound, 0) AS vader_compound, coalesce(y.compound, 0) AS summary_sentiment
              FROM reviews r LEFT JOIN (FROM compounds WHERE field = 'Text') x USING (ordinal)
                   LEFT JOIN (FROM compounds WHERE field = 'Summary') y USING (ordinal))""",
    "product_sentiment": f"""
        SELECT ProductId, {_even(_mean("vader_compound"), 3)} AS avg_sentiment, COUNT(*) AS review_count,
               {_even(_mean("Rating"), 3)} AS avg_rating, {_even(_pct("vader_sentiment = 'Positive'"), 3)} AS pct_positive,
               {_even(_pct("vader_sentiment = 'Negative'"), 3)} AS pct_negative
        FROM scored_reviews GROUP BY ProductId HAVING COUNT(*) >= 5""",
    "months": f"""
        SELECT YearMonth, {_mean("vader_compound")} AS avg_sentiment, COUNT(*) AS review_count,
               {_pct("vader_sentiment = 'Positive'")} AS pct_positive
        FROM scored_reviews GROUP BY YearMonth HAVING COUNT(*) >= 50""",
}


def _with_steps(body: str) -> str:
    """Put the steps a query needs, and those they need, in front of it."""
    needed: set[str] = set()

    def collect(text: str) -> None:
        for name in STEPS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                collect(STEPS[name])

    collect(body)
    steps = ",\n".join(f"{name} AS ({sql})" for name, sql in STEPS.items() if name in needed)
    return f"WITH {steps}\n{body}" if steps else body


def _rounded(source: str, digits: int, *columns: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'{_even(c, digits)} AS {c}' for c in columns)}) FROM {source}"


_SURVIVAL_AT = (
    "SELECT {t} AS time, coalesce((SELECT arg_max(survival, time) FROM curve WHERE time <= {t}), 1.0) AS survival"
)
_MEDIAN = "coalesce(MIN(time) FILTER (WHERE survival <= 0.5)::DOUBLE, 'infinity'::DOUBLE) AS median_survival"
_COUNTED = ["master_customers", "rfm_segments", "survival_data", "at_risk_customers", "product_sentiment", "recommendations"]
_COUNTED_STEPS = dict(zip(_COUNTED, ["facts", "segments", "survival", "at_risk_customers", "product_sentiment", "recommendations"], strict=True))
_TABLE_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {step}" for name, step in _COUNTED_STEPS.items()
)
_MASTER_EXPORT = (
    "CustomerID, Recency, Frequency, Monetary, RFM_Score, RFM_Segment, duration, churned, total_orders, avg_order_value, "
    "days_since_last, segment"
)

_BODIES = {
    "retail_union": f"SELECT {_RETAIL_LIST} FROM retail_raw",
    "retail_raw": f"SELECT {_RETAIL_LIST} FROM retail_raw",
    "reviews_raw": "SELECT * FROM reviews_raw",
    "reviews_csv_roundtrip": "SELECT * FROM reviews_raw",
    "parquet_roundtrip": "SELECT * EXCLUDE (ordinal) FROM retail",
    "publish_tables": _TABLE_COUNTS,
    "retail_clean": "SELECT * EXCLUDE (ordinal) FROM retail",
    "reviews_clean": f"SELECT {_REVIEW_COLUMNS} FROM reviews",
    "retail_funnel": _retail_funnel(),
    "reviews_funnel": """
        SELECT step, stage, rows, (SELECT COUNT(*) FROM reviews_raw) - rows AS removed
        FROM (SELECT 0 AS step, 'raw' AS stage, COUNT(*) AS rows FROM reviews_raw
              UNION ALL SELECT 1, 'null text', COUNT(*) FROM reviews_raw WHERE Text IS NOT NULL AND Summary IS NOT NULL
              UNION ALL SELECT 2, 'duplicate', COUNT(*) FROM reviews)""",
    "profile_retail": """
        SELECT COUNT(*) AS row_count, 8 AS column_count, MIN(InvoiceDate) AS first_date, MAX(InvoiceDate) AS last_date,
               COUNT(DISTINCT "Customer ID") AS customers, COUNT(DISTINCT StockCode) AS products,
               COUNT(DISTINCT Country) AS countries FROM retail_raw""",
    "profile_reviews": """
        SELECT COUNT(*) AS row_count, 7 AS column_count, COUNT(DISTINCT ProductId) AS products,
               COUNT(DISTINCT UserId) AS users, MIN(Score) AS min_score, MAX(Score) AS max_score FROM reviews_raw""",
    "missing_values_retail": _missing("retail_raw", _RETAIL_COLUMNS),
    "missing_values_reviews": _missing(
        "reviews_raw", ["Id", "ProductId", "UserId", "Score", "Summary", "Text", "Time"]
    ),
    "monthly_revenue": f"SELECT strftime(InvoiceDate, '%Y-%m') AS month, {_sum('TotalSpend')} AS revenue FROM retail GROUP BY 1",
    "top_countries": f"""
        SELECT Country, {_sum("TotalSpend")} AS revenue FROM retail GROUP BY 1 ORDER BY revenue DESC, Country LIMIT 10""",
    "rating_distribution": "SELECT Rating, COUNT(*) AS count FROM reviews GROUP BY Rating",
    "lines_by_weekday": """
        SELECT CAST(position AS INTEGER) AS position, Day, line_count
        FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'), (4, 'Friday'), (5, 'Saturday'),
                     (6, 'Sunday')) d(position, Day)
        LEFT JOIN (SELECT Day, COUNT(*) AS line_count FROM retail GROUP BY Day) USING (Day)""",
    "rfm_metrics": "SELECT * FROM rfm",
    "rfm_describe": _describe("rfm", ["Recency", "Frequency", "Monetary"]),
    "rfm_score_describe": _describe("scores", ["R_Score", "F_Score", "M_Score", "RFM_Score"]),
    "rfm_scores": "SELECT * FROM scores",
    "rfm_segments": "SELECT * FROM segments",
    "rfm_segment_counts": _shares("segments", "RFM_Segment"),
    "segment_avg_revenue": f"SELECT RFM_Segment, {_mean('Monetary')} AS avg_revenue FROM segments GROUP BY 1",
    "rfm_score_histogram": _histogram("segments", "RFM_Score", 12),
    "rfm_scaled": "SELECT CustomerID, "
    + ", ".join(
        f"{_even(f'({m} - AVG({m}) OVER ()) / stddev_pop({m}) OVER ()', 9)} AS {m}_z"
        for m in ("Recency", "Frequency", "Monetary")
    )
    + " FROM rfm",
    "label_clusters": "SELECT * FROM labelled_profile",
    "segment_cluster_profile": "SELECT * FROM profile",
    "segment_cluster_labels": "SELECT CustomerID, Cluster, Cluster_Label FROM clustered JOIN labelled_profile USING (Cluster)",
    "segment_cluster_summary": _summary(
        "(SELECT f.*, Cluster_Label FROM facts f JOIN clustered USING (CustomerID) JOIN labelled_profile USING (Cluster))", "Cluster_Label"
    ),
    "cox_derivatives": _cox_derivatives(
        ["total_orders", "total_spend", "avg_order_value", "unique_products", "purchase_frequency"], [0.05, -0.1, 0.02, 0.1, -0.2]
    ),
    "cox_effects_given": _cox_effects(_COX, [0.05, -0.1, 0.02, 0.1, -0.2], "purchase_frequency", [0.5, 1.0, 2.0, 3.0]),
    "cox_optimum": "SELECT unnest([" + ", ".join(f"'{c}'" for c in _COX) + "]) AS feature, 0.0::DOUBLE AS gradient",
    "kmeans_check": "SELECT COUNT(*) AS customers, 4::BIGINT AS clusters, 0::BIGINT AS misplaced FROM rfm",
    "survival_features": "SELECT * FROM features",
    "survival_segments": "SELECT * FROM survival",
    "churn_summary": f"""
        SELECT COUNT(*) AS customers, COUNT(*) FILTER (WHERE churned = 1) AS churned_customers,
               COUNT(*) FILTER (WHERE churned = 0) AS active_customers, {_pct("churned = 1")} AS churn_rate_pct,
               {_pct("churned = 0")} AS active_rate_pct, {_mean("duration")} AS avg_duration, {_mean("total_spend")} AS avg_spend,
               {_mean("total_orders")} AS avg_orders FROM features""",
    "spend_segment_counts": _shares("survival", "segment"),
    "at_risk_customers": "SELECT * FROM at_risk_customers",
    "at_risk_top10": 'SELECT * FROM at_risk_customers ORDER BY risk_score DESC, "Customer ID" LIMIT 10',
    "retention_case": f"""
        SELECT COUNT(*) AS at_risk_customers, {_mean("total_spend")} AS avg_spend,
               COUNT(*) * {_mean("total_spend")} AS revenue_at_risk,
               COUNT(*) * {_mean("total_spend")} * 0.3::DOUBLE AS revenue_saved FROM at_risk_customers""",
    "kaplan_meier": _rounded("curve", 9, "survival", "ci_lower", "ci_upper"),
    "survival_at_times": _rounded(
        f"({' UNION ALL '.join(_SURVIVAL_AT.format(t=t) for t in (90, 180, 365))})", 9, "survival"
    ),
    "median_survival": f"SELECT {_MEDIAN} FROM curve",
    "kaplan_meier_by_segment": _rounded("segment_curves", 9, "survival", "ci_lower", "ci_upper"),
    "median_survival_by_segment": f"SELECT segment, {_MEDIAN} FROM segment_curves GROUP BY segment",
    "cox_features": "SELECT duration, churned, "
    + ", ".join(f"{_even(f'ln(1 + {c}::DOUBLE)', 9)} AS {c}" for c in _COX)
    + " FROM features",
    "purchase_matrix": "SELECT * FROM purchase_matrix",
    "matrix_stats": """
        SELECT COUNT(*) AS interactions, COUNT(DISTINCT CustomerID) AS customers, COUNT(DISTINCT StockCode) AS products,
               COUNT(*) / (COUNT(DISTINCT CustomerID) * COUNT(DISTINCT StockCode))::DOUBLE * 100 AS density_pct
        FROM purchase_matrix""",
    "customer_similarity": _neighbours(None),
    "top_neighbours": "SELECT * FROM top_neighbours",
    "top_neighbours_popular_split": "SELECT * FROM top_neighbours",
    "recommendations": "SELECT * FROM recommendations",
    "recommend_for_customer": """
        SELECT * FROM long_lists WHERE CustomerID = (SELECT MIN(CustomerID) FROM purchase_matrix)""",
    "recommendations_padded": _padded_lists(60),
    "rec_summary": "SELECT * FROM rec_summary",
    "top_recommended_products": f"""
        SELECT StockCode, total_score,
               CASE WHEN length(coalesce(Description, StockCode)) > 30
                    THEN substring(coalesce(Description, StockCode), 1, 30) || '...' ELSE coalesce(Description, StockCode) END AS label
        FROM (SELECT StockCode, {_sum("Score")} AS total_score FROM recommendations GROUP BY 1
              ORDER BY total_score DESC, StockCode LIMIT 15) LEFT JOIN descriptions USING (StockCode)""",
    "rec_score_histogram": _rounded(
        f"({_histogram('recommendations', 'Score', 50)})", 9, "bin_start", "bin_end", "mean_value"
    ),
    "catalog_coverage": "SELECT * FROM coverage",
    "reco_eval": "SELECT * FROM evaluation",
    "sentiment_scores": f"""
        SELECT {_REVIEW_COLUMNS}, vader_compound, summary_sentiment, vader_sentiment, YearMonth FROM scored_reviews""",
    "sentiment_distribution": _shares("scored_reviews", "vader_sentiment"),
    "sentiment_stats": f"""
        SELECT COUNT(*) AS reviews, {_mean("vader_compound")} AS avg_compound, MIN(vader_compound) AS min_compound,
               MAX(vader_compound) AS max_compound, {_pct("vader_sentiment = 'Positive'")} AS pct_positive,
               {_pct("vader_sentiment = 'Neutral'")} AS pct_neutral, {_pct("vader_sentiment = 'Negative'")} AS pct_negative
        FROM scored_reviews""",
    "sentiment_by_rating": f"""
        SELECT Rating, {_even(_mean("vader_compound"), 3)} AS avg_vader, COUNT(*) AS count,
               {_even(_pct("vader_sentiment = 'Positive'"), 3)} AS pct_positive FROM scored_reviews GROUP BY Rating""",
    "product_sentiment": "SELECT * FROM product_sentiment",
    "best_products": "SELECT * FROM product_sentiment ORDER BY avg_sentiment DESC, ProductId LIMIT 10",
    "worst_products": "SELECT * FROM product_sentiment ORDER BY avg_sentiment, ProductId LIMIT 10",
    "monthly_sentiment": "SELECT * FROM months",
    "monthly_sentiment_min55": "SELECT * FROM months WHERE review_count >= 55",
    "monthly_sentiment_overall": _rounded(
        f"(SELECT {_mean('avg_sentiment', 9)} AS avg_sentiment, {_mean('pct_positive', 9)} AS pct_positive FROM months)",
        7, "avg_sentiment", "pct_positive",
    ),
    "user_sentiment": f"""
        SELECT UserId, {_mean("vader_compound")} AS avg_sentiment, COUNT(*) AS review_count,
               {_pct("vader_sentiment = 'Positive'")} AS pct_positive FROM scored_reviews GROUP BY UserId""",
    "word_freq_positive": _word_counts("Positive", 30),
    "word_freq_negative": _word_counts("Negative", 30),
    "word_cloud_positive": _word_counts("Positive", 50),
    "word_cloud_negative": _word_counts("Negative", 50),
    "master_customers": "SELECT * FROM master_customers",
    "segment_summary_rfm": _summary("facts", "RFM_Segment"),
    "business_metrics": f"""
        SELECT COUNT(*) AS customers, {_sum("Monetary")} AS total_revenue, {_mean("churned")} * 100 AS churn_rate_pct,
               {_mean("Monetary")} AS revenue_per_customer,
               {_even("CAST(SUM(CAST(Monetary AS DECIMAL(18,4))) FILTER (WHERE RFM_Segment = 'Champions') AS DOUBLE)", 2)} AS champions_revenue
        FROM facts""",
    "export_master": f"SELECT {_MASTER_EXPORT} FROM facts",
    "export_rfm": "SELECT CustomerID, Recency, Frequency, Monetary, RFM_Score, RFM_Segment FROM segments",
    "export_survival": """
        SELECT "Customer ID" AS CustomerID, duration, churned, total_orders, total_spend, avg_order_value, days_since_last,
               segment, purchase_frequency FROM survival""",
    "export_at_risk": """
        SELECT "Customer ID" AS CustomerID, days_since_last, total_orders, total_spend, avg_order_value, risk_score, segment
        FROM at_risk_customers""",
    "export_product_sentiment": "SELECT * FROM product_sentiment",
    "metrics_recommendation": _metric_rows(
        "recommendation",
        {
            "total_customers": "SELECT COUNT(DISTINCT CustomerID) FROM purchase_matrix",
            "total_products": "SELECT COUNT(DISTINCT StockCode) FROM purchase_matrix",
            "total_interactions": "SELECT COUNT(*) FROM purchase_matrix",
            "catalog_coverage_pct": f"SELECT {_even('coverage_pct', 2)} FROM coverage",
            "avg_customer_similarity": f"SELECT {_even('avg_similarity', 4)} FROM evaluation",
            "avg_recommendation_score": f"SELECT {_even('avg_score', 4)} FROM evaluation",
        },
        {
            "model_type": "collaborative_filtering",
            "similarity_metric": "cosine_similarity",
            "n_recommendations": 10,
            "n_similar_customers": 10,
        },
    ),
    "metrics_survival": _metric_rows(
        "survival",
        {
            "churn_rate_pct": f"SELECT {_even(_pct('churned = 1'), 2)} FROM features",
            "total_customers": "SELECT COUNT(*) FROM features",
            "median_survival_days": f"SELECT {_MEDIAN} FROM curve",
            **{
                f"survival_at_{t}_days": f"SELECT {_even('survival * 100', 2)} FROM ({_SURVIVAL_AT.format(t=t)})"
                for t in (90, 180, 365)
            },
            "at_risk_customers": "SELECT COUNT(*) FROM at_risk_customers",
            "potential_revenue_at_risk": f"SELECT {_even('COUNT(*) * ' + _mean('total_spend'), 2)} FROM at_risk_customers",
        },
        {"churn_definition_days": 90, "model_type": "kaplan_meier + cox_ph", "cox_penalizer": 0.1},
    ),
    "metrics_sentiment": _metric_rows(
        "sentiment",
        {
            "total_reviews": "SELECT COUNT(*) FROM scored_reviews",
            **{
                f"pct_{label.lower()}": f"SELECT {_even(_pct(f'vader_sentiment = {label!r}'), 2)} FROM scored_reviews"
                for label in ("Positive", "Negative", "Neutral")
            },
            "avg_compound_score": f"SELECT {_even(_mean('vader_compound'), 4)} FROM scored_reviews",
            "products_analysed": "SELECT COUNT(*) FROM product_sentiment",
        },
        {"model_type": "VADER", "churn_threshold": 0.05},
    ),
    "metrics_mining": _metric_rows(
        "mining",
        {
            "total_customers": "SELECT COUNT(*) FROM facts",
            "total_revenue": f"SELECT {_even(_sum('Monetary'), 2)} FROM facts",
            "overall_churn_rate": f"SELECT {_even(_pct('churned = 1'), 2)} FROM facts",
            "avg_revenue_per_customer": f"SELECT {_even(_mean('Monetary'), 2)} FROM facts",
            "rfm_mean_score": f"SELECT {_even(_mean('RFM_Score'), 2)} FROM facts",
        },
        {"n_clusters": 4, "clustering_method": "kmeans", "rfm_scoring": "quintile"},
    ),
    **{
        name: f"""
        SELECT RFM_Segment, COUNT(*) AS Customers, {_even(_sum("Monetary"), digits)} AS Revenue,
               {_even(_mean("churned") + " * 100", 1)} AS Churn_Pct FROM facts GROUP BY 1"""
        for name, digits in (("dash_segment_revenue", 0), ("dash_segment_revenue_2dp", 2))
    },
    "dash_at_risk_count": "SELECT COUNT(*) AS At_Risk FROM at_risk_customers",
    "dash_top_recommended": f"""
        SELECT Description, Score FROM (SELECT Description, {_even(_sum("Score"), 0)} AS Score FROM recommendations GROUP BY 1)
        ORDER BY 2 DESC, 1 LIMIT 10""",
    "dash_sentiment_bands": """
        SELECT list_filter([(0.5, 'Very Positive'), (0.05, 'Positive'), (-0.05, 'Neutral'), (-9, 'Negative')],
                           lambda x: avg_sentiment >= x[1])[1][2] AS Band, COUNT(*) AS Products
        FROM product_sentiment GROUP BY 1""",
    "dash_table_counts": _TABLE_COUNTS,
    "written_outputs": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {source}"
        for name, source in {
            "retail_clean": "retail", "reviews_clean": "reviews", "reviews_with_sentiment": "scored_reviews",
            "product_sentiment": "product_sentiment", "customer_similarity": "top_neighbours", "recommendations": "recommendations",
            "survival_data": "survival", "at_risk_customers": "at_risk_customers", "rfm_segments": "segments", "master_customers": "facts",
            "export master_customers": "facts", "export rfm_segments": "segments", "export survival_data": "survival",
            "export at_risk_customers": "at_risk_customers", "export product_sentiment": "product_sentiment",
        }.items()
    ),
}

ORACLES = {name: _with_steps(body) for name, body in _BODIES.items()}
