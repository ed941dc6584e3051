"""The batch pipeline, stage by stage, over the tables of one folder.

A stage hands over DataFrames. Only what later stages read several times is written in between.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketwise.operators import cleaning, cluster, cox, master, recommend, rfm, sentiment, similarity, survival
from basketwise.session import materialise, prepare
from basketwise.sources import fixtures
from basketwise.sources.lexicon import fixture_lists, lexicon_tables
from basketwise.sources.schemas import RETAIL_RAW, REVIEWS_RAW


CUSTOMER_COLUMNS = ["Customer ID", "Invoice", "StockCode", "Country", "InvoiceDate", "Quantity", "TotalSpend"]


class Lifecycle:
    """Lazily built stages for one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = prepare(spark)
        self.sf_dir = sf_dir

    @cached_property
    def retail_raw(self) -> DataFrame:
        return fixtures.retail_raw(self.spark, self.sf_dir)

    @cached_property
    def retail_input(self) -> DataFrame:
        return self.retail_raw.select(*[F.col(f"`{c}`") for c in RETAIL_RAW.names])

    @cached_property
    def reviews_raw(self) -> DataFrame:
        return fixtures.reviews_raw(self.spark, self.sf_dir)

    @cached_property
    def reviews_input(self) -> DataFrame:
        return self.reviews_raw.select(*REVIEWS_RAW.names)

    @cached_property
    def retail(self) -> DataFrame:
        return cleaning.clean_retail(self.retail_raw)

    @cached_property
    def history(self) -> DataFrame:
        """The clean lines' columns that customer stages need, as a table: the order lines are read once for all of them."""
        return materialise(self.retail.select(*CUSTOMER_COLUMNS), "history")

    @cached_property
    def reviews(self) -> DataFrame:
        """Clean reviews as a table: the texts are read and deduplicated once."""
        return materialise(cleaning.clean_reviews(self.reviews_raw), "reviews")

    @cached_property
    def rfm_metrics(self) -> DataFrame:
        return rfm.rfm_metrics(self.history)

    @cached_property
    def stored_metrics(self) -> DataFrame:
        """Customer metrics as a table: ranking, scoring and scaling read them, not the order lines."""
        return materialise(self.rfm_metrics, "rfm-metrics")

    @cached_property
    def rfm_segments(self) -> DataFrame:
        return rfm.rfm_segments(rfm.rfm_scores(self.stored_metrics))

    @cached_property
    def kmeans_segments(self) -> DataFrame:
        segments = cluster.kmeans_segments(materialise(self.rfm_segments, "rfm-segments"))
        return materialise(segments, "kmeans-segments")

    @cached_property
    def features(self) -> DataFrame:
        return survival.survival_features(self.history)

    @cached_property
    def stored_features(self) -> DataFrame:
        """Customer features as a table: the spend cuts and the segments read them, not the order lines."""
        return materialise(self.features, "features")

    @cached_property
    def survival(self) -> DataFrame:
        return survival.survival_segments(self.stored_features)

    @cached_property
    def at_risk(self) -> DataFrame:
        return survival.at_risk_customers(self.survival)

    @cached_property
    def curve(self) -> DataFrame:
        return survival.kaplan_meier(self.stored_features)

    @cached_property
    def segment_curves(self) -> DataFrame:
        return survival.kaplan_meier(self.survival, by=["segment"])

    @cached_property
    def cox_rows(self) -> DataFrame:
        return cox.cox_features(self.stored_features)

    @cached_property
    def cox_model(self) -> cox.CoxModel:
        return cox.fit_cox(self.cox_rows)

    @cached_property
    def matrix(self) -> DataFrame:
        return similarity.purchase_matrix(self.retail)

    @cached_property
    def stored_matrix(self) -> DataFrame:
        """Purchases as a table, from the stored lines where there are any."""
        made = similarity.purchase_matrix(self.history) if "history" in self.__dict__ else self.matrix
        return materialise(made, "purchases")

    @cached_property
    def descriptions(self) -> DataFrame:
        return recommend.first_descriptions(self.retail)

    @cached_property
    def neighbours(self) -> DataFrame:
        return similarity.nearest_customers(self.stored_matrix)

    @cached_property
    def stored_neighbours(self) -> DataFrame:
        return materialise(self.neighbours, "neighbours")

    @cached_property
    def long_lists(self) -> DataFrame:
        """Ten products for every customer, stored; the recommender is evaluated on them."""
        lists = recommend.recommend(self.stored_matrix, self.descriptions, n=10, neighbours=self.stored_neighbours)
        return materialise(lists, "long-lists")

    @cached_property
    def recommendations(self) -> DataFrame:
        """The first five of each list."""
        return self.long_lists.where(F.col("rank") <= 5)

    @cached_property
    def rec_summary(self) -> DataFrame:
        return recommend.summary_per_customer(self.recommendations)

    @cached_property
    def scored_reviews(self) -> DataFrame:
        """Scored reviews as a table; the summaries read it, not the texts' words."""
        words = lexicon_tables(self.spark, *fixture_lists())
        return materialise(sentiment.reviews_with_sentiment(self.reviews, *words, keys=["ordinal"]), "scored-reviews")

    @cached_property
    def product_sentiment(self) -> DataFrame:
        return sentiment.product_sentiment(self.scored_reviews)

    @cached_property
    def master(self) -> DataFrame:
        return master.master_customers(self.rfm_segments, self.survival, self.rec_summary)

    @cached_property
    def clustered_master(self) -> DataFrame:
        return master.master_customers(self.kmeans_segments, self.survival, self.rec_summary)

    @cached_property
    def facts(self) -> DataFrame:
        """The master table without its recommendation columns, for the summaries that use none."""
        none = self.spark.createDataFrame([], "CustomerID long, avg_rec_score double, top_rec_product string")
        return master.master_customers(self.rfm_segments, self.survival, none)
