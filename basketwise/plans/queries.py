"""Registry of named queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketwise.functions.numeric import exact_mean, histogram, percent_where, round_even
from basketwise.operators import (
    cleaning,
    cluster,
    cox,
    master,
    profiling,
    ranking,
    recommend,
    rfm,
    sentiment,
    similarity,
    survival,
)
from basketwise.plans import outputs
from basketwise.plans.outputs import AT_RISK_EXPORT, ID_RENAME, MASTER_EXPORT, RFM_EXPORT, SURVIVAL_EXPORT
from basketwise.plans.stages import Lifecycle
from basketwise.session import materialise, scratch_path
from basketwise.sinks import writers
from basketwise.sources import fixtures, readers
from basketwise.sources.schemas import RETAIL_RAW, REVIEWS_RAW

Query = Callable[[Lifecycle], DataFrame]

def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Results of exp, log and long products are reported to a fixed number of digits."""
    return df.withColumns({c: round_even(F.col(c), digits) for c in columns})


def _through_csv(lc: Lifecycle, df: DataFrame, name: str) -> DataFrame:
    """Write an export as CSV and read it back with its own schema."""
    path = scratch_path(lc.spark, name)
    writers.write_csv(df, path)
    return readers.read_csv(lc.spark, path, df.schema)


def _retail_clean(lc: Lifecycle) -> DataFrame:
    return lc.retail.drop("ordinal")


def _reviews_csv(lc: Lifecycle) -> DataFrame:
    path = scratch_path(lc.spark, "reviews-csv")
    writers.write_csv(lc.reviews_input, path)
    return readers.read_reviews_csv(lc.spark, path)


def _parquet_roundtrip(lc: Lifecycle) -> DataFrame:
    path = scratch_path(lc.spark, "retail")
    writers.write_parquet(_retail_clean(lc), path)
    return readers.read_table(lc.spark, path)


def _published_tables(lc: Lifecycle, clustered: bool = True) -> dict[str, DataFrame]:
    return {
        "master_customers": lc.clustered_master if clustered else lc.master,
        "rfm_segments": lc.kmeans_segments if clustered else lc.rfm_segments,
        "survival_data": lc.survival,
        "at_risk_customers": lc.at_risk,
        "product_sentiment": lc.product_sentiment,
        "recommendations": lc.recommendations,
    }


def _publish(lc: Lifecycle) -> DataFrame:
    path = scratch_path(lc.spark, "lifecycle")
    database = "lifecycle_" + path.rsplit("-", 1)[1]
    counts = materialise(writers.publish(_published_tables(lc), lc.spark, database, path), "published")
    listed = materialise(writers.list_tables(lc.spark, database), "listed")
    writers.drop_database(lc.spark, database)
    return counts.join(listed, "table_name")


def _written(lc: Lifecycle) -> DataFrame:
    """Rows of all tables and exports of a run; the RFM segments are the clusters, which any engine repeats."""
    target = scratch_path(lc.spark, "run")
    return outputs.counted(outputs.run(lc, target, _by_segment(lc)), lc, target)


def _table_counts(lc: Lifecycle) -> DataFrame:
    return writers.table_counts(_published_tables(lc, clustered=False))


def _survival_metrics(lc: Lifecycle) -> DataFrame:
    at = survival.survival_at_times(lc.curve)
    churn = lc.stored_features.agg(
        round_even(percent_where(F.col("churned") == 1), 2).alias("churn_rate_pct"),
        F.count(F.lit(1)).alias("total_customers"),
    )
    case = survival.retention_case(lc.at_risk).select(
        "at_risk_customers", round_even(F.col("revenue_at_risk"), 2).alias("potential_revenue_at_risk")
    )
    reached = at.agg(
        *[
            round_even(F.max(F.when(F.col("time") == t, F.col("survival"))) * 100, 2).alias(f"survival_at_{t}_days")
            for t in (90, 180, 365)
        ]
    )
    # four one-row results, put side by side
    values = churn.select(
        "*",
        survival.median_survival(lc.curve).scalar().alias("median_survival_days"),
        *[reached.select(c).scalar().alias(c) for c in reached.columns],
        *[case.select(c).scalar().alias(c) for c in case.columns],
    )
    # fixed values here and below: keys and parameters of the run metrics
    return master.run_metrics(
        values,
        "survival",
        {"churn_definition_days": 90, "model_type": "kaplan_meier + cox_ph", "cox_penalizer": 0.1},
    )


def _sentiment_metrics(lc: Lifecycle) -> DataFrame:
    shares = [
        round_even(percent_where(F.col("vader_sentiment") == label), 2).alias(f"pct_{label.lower()}")
        for label in ("Positive", "Negative", "Neutral")
    ]
    products = lc.product_sentiment.agg(F.count(F.lit(1)).alias("n")).scalar()
    values = lc.scored_reviews.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        *shares,
        round_even(exact_mean(F.col("vader_compound")), 4).alias("avg_compound_score"),
    ).withColumn("products_analysed", products)
    return master.run_metrics(values, "sentiment", {"model_type": "VADER", "churn_threshold": 0.05})


def _mining_metrics(lc: Lifecycle, facts: DataFrame) -> DataFrame:
    values = facts.agg(
        F.count(F.lit(1)).alias("total_customers"),
        round_even(F.sum(F.col("Monetary").cast("decimal(18,4)")).cast("double"), 2).alias("total_revenue"),
        round_even(percent_where(F.col("churned") == 1), 2).alias("overall_churn_rate"),
        round_even(exact_mean(F.col("Monetary")), 2).alias("avg_revenue_per_customer"),
        round_even(exact_mean(F.col("RFM_Score")), 2).alias("rfm_mean_score"),
    )
    return master.run_metrics(
        values, "mining", {"n_clusters": 4, "clustering_method": "kmeans", "rfm_scoring": "quintile"}
    )


def _mining_metrics_clusters(lc: Lifecycle) -> DataFrame:
    counts = master.label_counts(lc.kmeans_segments, "Cluster_Label")
    return _mining_metrics(lc, lc.facts).unionByName(counts)


def _evaluation(lc: Lifecycle) -> DataFrame:
    customers = lc.stored_matrix.select("CustomerID").distinct()
    near = similarity.mean_similarity(lc.stored_neighbours, customers, lc.stored_matrix)
    score = recommend.mean_list_score(lc.long_lists)
    return near.select(
        round_even(F.col("avg_similarity"), 9).alias("avg_similarity"),
        round_even(score.scalar(), 9).alias("avg_score"),
    )


def _recommendation_metrics(lc: Lifecycle) -> DataFrame:
    coverage = recommend.catalogue_coverage(lc.long_lists, lc.stored_matrix)
    scores = _evaluation(lc)
    stats = similarity.matrix_stats(lc.stored_matrix)
    values = stats.select(
        F.col("customers").alias("total_customers"),
        F.col("products").alias("total_products"),
        F.col("interactions").alias("total_interactions"),
        round_even(coverage.select("coverage_pct").scalar(), 2).alias("catalog_coverage_pct"),
        round_even(scores.select("avg_similarity").scalar(), 4).alias("avg_customer_similarity"),
        round_even(scores.select("avg_score").scalar(), 4).alias("avg_recommendation_score"),
    )
    return master.run_metrics(
        values,
        "recommendation",
        {
            "model_type": "collaborative_filtering",
            "similarity_metric": "cosine_similarity",
            "n_recommendations": 10,
            "n_similar_customers": 10,
        },
    )


def _recommend_some(lc: Lifecycle) -> DataFrame:
    """Point lookup: ten products for the first customer; an unknown id gives no rows."""
    unknown = lc.spark.range(1).select(F.lit(-1).cast("long").alias("CustomerID"))
    asked = recommend.first_customers(lc.stored_matrix, 1).unionByName(unknown)
    return recommend.recommend(lc.stored_matrix, lc.descriptions, n=10, customers=materialise(asked, "asked"))


#: coefficients that are given, not fitted
COX_GIVEN = [0.05, -0.1, 0.02, 0.1, -0.2]


def _cox_derivatives(lc: Lifecycle) -> DataFrame:
    """Likelihood, gradient and Hessian at fixed coefficients of the unscaled covariates."""
    p = len(cox.COVARIATES)
    rows = lc.cox_rows.select("duration", "churned", *[F.col(c).alias(f"x{j}") for j, c in enumerate(cox.COVARIATES)])
    row = cox.derivatives_row(rows, p, np.array(COX_GIVEN))
    return _rounded(row, 3, *row.columns)


def _cox_optimum(lc: Lifecycle) -> DataFrame:
    """The gradient at the fitted coefficients to six digits; adding zero takes the sign off a zero."""
    check = cox.optimum_check(lc.cox_rows, lc.cox_model)
    return check.select("feature", (round_even(F.col("gradient"), 6) + F.lit(0.0)).alias("gradient"))


def _cox_effects_given(lc: Lifecycle) -> DataFrame:
    """Partial effects of given coefficients, with the other covariates at zero."""
    p, beta = len(cox.COVARIATES), np.array(COX_GIVEN)
    rows = lc.cox_rows.select("duration", "churned", *[F.col(c).alias(f"x{j}") for j, c in enumerate(cox.COVARIATES)])
    none = np.zeros(p)
    model = cox.CoxModel(cox.COVARIATES, beta, none, none, materialise(cox.baseline_steps(rows, p, beta), "baseline"), 0.0, 0, none + 1, 0.0)
    return _rounded(cox.cox_partial_effects(model), 9, "survival")


def _padded(lc: Lifecycle) -> DataFrame:
    """One neighbour and long lists, so that lists run short and are filled up in code order."""
    return recommend.recommend(lc.stored_matrix, lc.descriptions, n=60, k=1)


def _by_segment(lc: Lifecycle) -> DataFrame:
    """The four RFM segments taken as clusters: a clustering that any engine repeats."""
    position = F.array_position(F.array(*map(F.lit, ["Champions", "Loyal Customers", "At Risk", "Lost"])), F.col("RFM_Segment"))
    return materialise(lc.rfm_segments.withColumn("Cluster", (position - 1).cast("int")), "segment-clusters")


def _label_profile(lc: Lifecycle) -> DataFrame:
    return cluster.label_clusters(cluster.cluster_profile(_by_segment(lc)))


def _labelled(lc: Lifecycle) -> DataFrame:
    return cluster.with_labels(_by_segment(lc))


QUERIES: dict[str, Query] = {
    # sources and sinks
    "retail_union": lambda lc: fixtures.retail_union(lc.spark, lc.sf_dir).drop("ordinal"),
    "retail_raw": lambda lc: lc.retail_input,
    "reviews_raw": lambda lc: lc.reviews_input,
    "reviews_csv_roundtrip": _reviews_csv,
    "parquet_roundtrip": _parquet_roundtrip,
    "publish_tables": _publish,
    "written_outputs": _written,
    # cleaning and profiling
    "retail_clean": _retail_clean,
    "reviews_clean": lambda lc: lc.reviews.drop("ordinal"),
    "retail_funnel": lambda lc: cleaning.retail_funnel(lc.retail_raw),
    "reviews_funnel": lambda lc: cleaning.reviews_funnel(lc.reviews_raw),
    "profile_retail": lambda lc: profiling.profile_retail(lc.retail_raw, len(RETAIL_RAW)),
    "profile_reviews": lambda lc: profiling.profile_reviews(lc.reviews_raw, len(REVIEWS_RAW)),
    "missing_values_retail": lambda lc: profiling.missing_values(lc.retail_input),
    "missing_values_reviews": lambda lc: profiling.missing_values(lc.reviews_input),
    "monthly_revenue": lambda lc: profiling.monthly_revenue(lc.retail),
    "top_countries": lambda lc: profiling.top_countries(lc.retail),
    "rating_distribution": lambda lc: profiling.rating_distribution(lc.reviews),
    "lines_by_weekday": lambda lc: profiling.lines_by_weekday(lc.retail),
    # recency, frequency, spend
    "rfm_metrics": lambda lc: lc.rfm_metrics,
    "rfm_describe": lambda lc: ranking.describe(lc.stored_metrics, rfm.METRICS),
    "rfm_score_describe": lambda lc: ranking.describe(lc.rfm_segments, ["R_Score", "F_Score", "M_Score", "RFM_Score"]),
    "rfm_scores": lambda lc: rfm.rfm_scores(lc.stored_metrics),
    "rfm_segments": lambda lc: lc.rfm_segments,
    "rfm_segment_counts": lambda lc: rfm.value_shares(lc.rfm_segments, "RFM_Segment"),
    "segment_avg_revenue": lambda lc: rfm.segment_avg_revenue(lc.rfm_segments, "RFM_Segment"),
    "rfm_score_histogram": lambda lc: histogram(lc.rfm_segments, "RFM_Score", 12),
    "rfm_scaled": lambda lc: _rounded(rfm.rfm_scaled(lc.stored_metrics), 9, "Recency_z", "Frequency_z", "Monetary_z"),
    # clusters
    "kmeans_segments": lambda lc: lc.kmeans_segments,
    "kmeans_profile": lambda lc: cluster.cluster_profile(lc.kmeans_segments),
    "kmeans_check": lambda lc: cluster.clustering_check(lc.stored_metrics, lc.kmeans_segments.select("CustomerID", "Cluster")),
    "kmeans_elbow": lambda lc: cluster.kmeans_elbow(lc.stored_metrics),
    "label_clusters": _label_profile,
    "segment_cluster_profile": lambda lc: cluster.cluster_profile(_by_segment(lc)),
    "segment_cluster_labels": lambda lc: _labelled(lc).select("CustomerID", "Cluster", "Cluster_Label"),
    "segment_cluster_summary": lambda lc: master.segment_summary(
        master.master_customers(_labelled(lc), lc.survival, lc.rec_summary), "Cluster_Label"
    ),
    # survival
    "survival_features": lambda lc: lc.features,
    "survival_segments": lambda lc: lc.survival,
    "churn_summary": lambda lc: survival.churn_summary(lc.features),
    "spend_segment_counts": lambda lc: rfm.value_shares(lc.survival, "segment"),
    "at_risk_customers": lambda lc: survival.by_risk(lc.at_risk),
    "at_risk_top10": lambda lc: survival.by_risk(lc.at_risk, 10),
    "retention_case": lambda lc: survival.retention_case(lc.at_risk),
    "kaplan_meier": lambda lc: _rounded(lc.curve, 9, "survival", "ci_lower", "ci_upper"),
    "survival_at_times": lambda lc: _rounded(survival.survival_at_times(lc.curve), 9, "survival"),
    "median_survival": lambda lc: survival.median_survival(lc.curve),
    "kaplan_meier_by_segment": lambda lc: _rounded(lc.segment_curves, 9, "survival", "ci_lower", "ci_upper"),
    "median_survival_by_segment": lambda lc: survival.median_survival(lc.segment_curves, by=["segment"]),
    "cox_features": lambda lc: _rounded(lc.cox_rows, 9, *cox.COVARIATES),
    "cox_derivatives": _cox_derivatives,
    "cox_optimum": _cox_optimum,
    "cox_effects_given": _cox_effects_given,
    "cox_coefficients": lambda lc: cox.cox_coefficients(lc.cox_rows, lc.cox_model),
    "cox_partial_effects": lambda lc: cox.cox_partial_effects(lc.cox_model),
    # recommendations
    "purchase_matrix": lambda lc: lc.matrix,
    "matrix_stats": lambda lc: similarity.matrix_stats(lc.matrix),
    "customer_similarity": lambda lc: similarity.nearest_customers(lc.matrix, k=None),
    "top_neighbours": lambda lc: lc.neighbours,
    "top_neighbours_popular_split": lambda lc: similarity.nearest_customers(lc.matrix, max_pair_degree=24),
    "recommendations": lambda lc: lc.recommendations,
    "recommend_for_customer": _recommend_some,
    "recommendations_padded": _padded,
    "rec_summary": lambda lc: lc.rec_summary,
    "top_recommended_products": lambda lc: recommend.top_products(lc.recommendations, lc.descriptions),
    "rec_score_histogram": lambda lc: _rounded(
        histogram(lc.recommendations, "Score", 50), 9, "bin_start", "bin_end", "mean_value"
    ),
    "catalog_coverage": lambda lc: recommend.catalogue_coverage(lc.long_lists, lc.stored_matrix),
    "reco_eval": _evaluation,
    # sentiment
    "sentiment_scores": lambda lc: lc.scored_reviews.drop("ordinal"),
    "sentiment_distribution": lambda lc: rfm.value_shares(lc.scored_reviews, "vader_sentiment"),
    "sentiment_stats": lambda lc: sentiment.sentiment_stats(lc.scored_reviews),
    "sentiment_by_rating": lambda lc: sentiment.sentiment_by_rating(lc.scored_reviews),
    "product_sentiment": lambda lc: lc.product_sentiment,
    "best_products": lambda lc: sentiment.best_products(lc.product_sentiment),
    "worst_products": lambda lc: sentiment.worst_products(lc.product_sentiment),
    "monthly_sentiment": lambda lc: sentiment.monthly_sentiment(lc.scored_reviews),
    "monthly_sentiment_min55": lambda lc: sentiment.monthly_sentiment(lc.scored_reviews, min_reviews=55),
    "monthly_sentiment_overall": lambda lc: _rounded(
        sentiment.monthly_sentiment_overall(sentiment.monthly_sentiment(lc.scored_reviews)),
        7, "avg_sentiment", "pct_positive",
    ),
    "user_sentiment": lambda lc: sentiment.user_sentiment(lc.scored_reviews),
    "word_freq_positive": lambda lc: sentiment.word_frequencies(lc.scored_reviews, "Positive"),
    "word_freq_negative": lambda lc: sentiment.word_frequencies(lc.scored_reviews, "Negative"),
    "word_cloud_positive": lambda lc: sentiment.word_frequencies(lc.scored_reviews, "Positive", n=50),
    "word_cloud_negative": lambda lc: sentiment.word_frequencies(lc.scored_reviews, "Negative", n=50),
    # master table, summaries, exports, metrics
    "master_customers": lambda lc: lc.master,
    "segment_summary_rfm": lambda lc: master.segment_summary(lc.facts, "RFM_Segment"),
    "segment_summary_cluster": lambda lc: master.segment_summary(lc.clustered_master, "Cluster_Label"),
    "business_metrics": lambda lc: master.business_metrics(lc.facts, "RFM_Segment"),
    "export_master": lambda lc: _through_csv(
        lc, writers.export_columns(lc.facts, [c for c in MASTER_EXPORT if c != "Cluster_Label"]), "master-csv"
    ),
    "export_master_clusters": lambda lc: _through_csv(
        lc, writers.export_columns(lc.clustered_master, MASTER_EXPORT), "master-csv"
    ),
    "export_rfm": lambda lc: _through_csv(
        lc, writers.export_columns(lc.rfm_segments, [c for c in RFM_EXPORT if c != "Cluster_Label"]), "rfm-csv"
    ),
    "export_rfm_clusters": lambda lc: _through_csv(lc, writers.export_columns(lc.kmeans_segments, RFM_EXPORT), "rfm-csv"),
    "export_survival": lambda lc: _through_csv(
        lc, writers.export_columns(lc.survival, SURVIVAL_EXPORT, ID_RENAME), "survival-csv"
    ),
    "export_at_risk": lambda lc: _through_csv(
        lc, writers.export_columns(survival.by_risk(lc.at_risk), AT_RISK_EXPORT, ID_RENAME), "at-risk-csv"
    ),
    "export_product_sentiment": lambda lc: _through_csv(lc, lc.product_sentiment, "product-csv"),
    "metrics_recommendation": _recommendation_metrics,
    "metrics_survival": _survival_metrics,
    "metrics_sentiment": _sentiment_metrics,
    "metrics_mining": lambda lc: _mining_metrics(lc, lc.facts),
    "metrics_mining_clusters": _mining_metrics_clusters,
    # dashboard
    "dash_segment_revenue": lambda lc: master.segment_revenue(lc.facts, 0),
    "dash_segment_revenue_2dp": lambda lc: master.segment_revenue(lc.facts, 2),
    "dash_at_risk_count": lambda lc: lc.at_risk.agg(F.count(F.lit(1)).alias("At_Risk")),
    "dash_top_recommended": lambda lc: master.top_recommended(lc.recommendations),
    "dash_sentiment_bands": lambda lc: master.sentiment_bands(lc.product_sentiment),
    "dash_table_counts": _table_counts,
}


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(Lifecycle(spark, sf_dir))

    return {name: bound(query) for name, query in QUERIES.items()}
