"""User-based collaborative filtering for all customers, or some, in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketwise.functions.labels import short_label
from basketwise.functions.numeric import exact_mean, exact_sum, round_even
from basketwise.operators.similarity import Packed, nearest_customers
from basketwise.session import materialise

# Similarities are weighed as whole billionths, so that sums of scores do not depend on row order.
SIMILARITY_UNIT = 1_000_000_000
LINES = 1_000_000  # products of neighbours that one task adds up, about


def first_descriptions(retail: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Description of the first line of every product."""
    return retail.groupBy("StockCode").agg(F.min_by("Description", ordinal).alias("Description"))


def _numbered(codes: DataFrame) -> DataFrame:
    """Products with their position in code order, sorted in ranges and shifted by the lower ranges' sizes."""
    ranges = materialise(
        codes.repartitionByRange("StockCode").withColumn("range", F.spark_partition_id()), "product-ranges"
    )
    lower = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range
    before = ranges.groupBy("range").count().select("range", F.coalesce(F.sum("count").over(lower), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy("StockCode"))
    return ranges.withColumn("inside", inside).join(before, "range").select(
        "StockCode", (F.col("before") + F.col("inside")).alias("position")
    )


def _padding(short: DataFrame, taken: DataFrame, matrix: DataFrame) -> DataFrame:
    """The first products in code order that a customer neither owns nor got recommended.

    ``short`` gives (CustomerID, have, missing). The free positions lie in the gaps between the taken
    ones, so the catalogue is never paired with the customers.
    """
    catalogue = materialise(_numbered(matrix.select("StockCode").distinct()), "catalogue")
    size = catalogue.agg(F.max("position").alias("n")).scalar()
    held = (
        taken.join(short.select("CustomerID"), "CustomerID", "left_semi")
        .join(catalogue, "StockCode")
        .select("CustomerID", "position")
    )
    fence = short.select("CustomerID", (size + 1).alias("position"))
    line = Window.partitionBy("CustomerID").orderBy("position")
    gaps = (
        held.unionByName(fence)
        .withColumn("previous", F.coalesce(F.lag("position").over(line), F.lit(0).cast("long")))
        .withColumn("free_before", F.col("previous") - F.row_number().over(line) + 1)
        .join(short, "CustomerID")
        .withColumn("last", F.least(F.col("position") - 1, F.col("previous") + F.col("missing") - F.col("free_before")))
        .where(F.col("last") > F.col("previous"))
    )
    return (
        gaps.select(
            "CustomerID",
            "have",
            "previous",
            "free_before",
            F.explode(F.sequence(F.col("previous") + 1, F.col("last"))).alias("position"),
        )
        .withColumn("rank", (F.col("have") + F.col("free_before") + F.col("position") - F.col("previous")).cast("int"))
        .join(catalogue, "position")
        .select("CustomerID", "rank", "StockCode", F.lit(0).cast("long").alias("points"))
    )


def _scored(matrix: DataFrame, near: DataFrame, n: int, k: int, customers: DataFrame | None) -> DataFrame:
    """(CustomerID, rank, StockCode, points) of the n best products that the neighbours bought and the customer does not own.

    Baskets travel whole: each neighbour's, weighed, and the customer's own meet in one exchange by customer, and are taken apart and added
    up where they arrive. So no exchange, join or sort sees the products of all neighbours as rows. Products travel as their position
    in code order, in one number with the count.
    """
    lines, own = matrix, matrix
    tasks = int(matrix.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if customers is None:
        many = matrix.count() * k // LINES + 1
    else:  # only what those asked for need
        near, many = materialise(near, "asked-neighbours"), 0
        lines = matrix.join(near.select(F.col("neighbour").alias("CustomerID")).distinct(), "CustomerID", "left_semi")
        own = matrix.join(near.select("CustomerID").distinct(), "CustomerID", "left_semi")
    weight = F.rint(F.col("similarity") * float(SIMILARITY_UNIT)).cast("long")
    codes = materialise(_numbered(lines.select("StockCode").distinct().where("StockCode is not null")), "products")
    # a product without code is the first one; what a customer owns counts only if a neighbour bought it
    placed = lambda x: x.join(codes, "StockCode", "left").select("CustomerID", F.coalesce("position", F.lit(0).cast("long")).alias("code"), "PurchaseCount")
    lines = materialise(placed(lines.where("CustomerID is not null")), "placed")
    own = None if customers is None else placed(own.where("CustomerID is not null").join(codes.select("StockCode"), "StockCode", "left_semi"))
    pack = Packed(lines, "code", "PurchaseCount")
    bought = lines.groupBy("CustomerID").agg(F.collect_list(pack.put(F.col("code"), F.col("PurchaseCount"))).alias("items"))
    owned = bought
    if customers is not None:  # their counts do not matter, and need not fit
        zero = F.lit(0).cast(lines.schema["PurchaseCount"].dataType)
        owned = own.groupBy("CustomerID").agg(F.collect_list(pack.put(F.col("code"), zero)).alias("items"))
    offered = near.join(bought.withColumnRenamed("CustomerID", "neighbour"), "neighbour").select("CustomerID", weight.alias("weight"), "items")
    met = offered.select("CustomerID", F.lit(False).alias("own"), "weight", "items").unionByName(
        owned.select("CustomerID", F.lit(True).alias("own"), F.lit(None).cast("long").alias("weight"), "items")
    )
    met = met.repartition(many, "CustomerID") if many > tasks else met.repartition("CustomerID")
    points = F.col("weight") * pack.count(F.col("item"))
    rows = met.select("CustomerID", "weight", "own", F.explode("items").alias("item"))
    rows = rows.select("CustomerID", "own", pack.key(F.col("item")).alias("code"), points.alias("points")).where("NOT own OR code > 0")
    added = rows.groupBy("CustomerID", "code").agg(F.sum("points").alias("points"), F.max("own").alias("own"))
    best = Window.partitionBy("CustomerID").orderBy(F.desc("points"), "code")
    ranked = added.where(~F.col("own")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
    named = ranked.join(codes.select(F.col("position").alias("code"), "StockCode"), "code", "left")
    return named.select("CustomerID", "rank", "StockCode", "points")


def recommend(
    matrix: DataFrame,
    descriptions: DataFrame,
    n: int = 5,
    k: int = 10,
    customers: DataFrame | None = None,
    pad: bool = True,
    neighbours: DataFrame | None = None,
) -> DataFrame:
    """The n products that weigh most among the k nearest customers' purchases and are not yet owned.

    With ``pad`` customers with fewer scored products get further ones of score 0, in code order.
    Unknown ``customers`` give no rows.
    """
    near = nearest_customers(matrix, k, customers) if neighbours is None else neighbours
    scored = _scored(matrix, near, n, k, customers)
    if pad:
        owned = matrix.select("CustomerID", "StockCode")
        scored = materialise(scored, "recommended")
        known = matrix.select("CustomerID").distinct()
        if customers is not None:
            known = known.join(customers.select("CustomerID").distinct(), "CustomerID", "left_semi")
        have = scored.groupBy("CustomerID").agg(F.count(F.lit(1)).alias("have"))
        short = (
            known.join(have, "CustomerID", "left")
            .select("CustomerID", F.coalesce("have", F.lit(0).cast("long")).alias("have"))
            .withColumn("missing", n - F.col("have"))
            .where("missing > 0")
        )
        short = materialise(short, "short-lists")
        if not short.isEmpty():
            taken = owned.unionByName(scored.select("CustomerID", "StockCode"))
            scored = scored.unionByName(_padding(short, taken, matrix))
    named = descriptions.withColumn("known", F.lit(True))
    return scored.join(named, "StockCode", "left").select(
        "CustomerID",
        "rank",
        "StockCode",
        round_even(F.col("points") / F.lit(float(SIMILARITY_UNIT)), 3).alias("Score"),
        F.when(F.col("known"), F.col("Description")).otherwise("Unknown").alias("Description"),
    )


def first_customers(matrix: DataFrame, n: int) -> DataFrame:
    return matrix.select("CustomerID").distinct().orderBy("CustomerID").limit(n)


def catalogue_coverage(recommendations: DataFrame, matrix: DataFrame) -> DataFrame:
    """Share of the catalogue that occurs in the recommendations."""
    products = matrix.agg(F.count_distinct("StockCode").alias("n")).scalar()
    return recommendations.agg(F.count_distinct("StockCode").alias("recommended_products")).select(
        "recommended_products",
        products.alias("products"),
        (F.col("recommended_products") / F.nullif(products, F.lit(0).cast("long")) * 100).alias("coverage_pct"),
    )


def mean_list_score(recommendations: DataFrame) -> DataFrame:
    """Mean over customers of the mean score of their lists."""
    lists = recommendations.groupBy("CustomerID").agg(exact_mean(F.col("Score")).alias("mean"))
    return lists.agg(exact_mean(F.col("mean"), 9).alias("avg_score"))


def summary_per_customer(recommendations: DataFrame) -> DataFrame:
    """Mean score and the best-ranked product that has a description."""
    described = F.when(F.col("Description").isNotNull(), F.col("rank"))
    return recommendations.groupBy("CustomerID").agg(
        exact_mean(F.col("Score")).alias("avg_rec_score"),
        F.min_by("Description", described).alias("top_rec_product"),
    )


def top_products(recommendations: DataFrame, descriptions: DataFrame, n: int = 15) -> DataFrame:
    """Products with the highest total score, with a short label (the code where there is no description)."""
    best = (
        recommendations.groupBy("StockCode")
        .agg(exact_sum(F.col("Score")).alias("total_score"))
        .orderBy(F.desc("total_score"), "StockCode")
        .limit(n)
    )
    text = F.coalesce(F.col("Description"), F.col("StockCode"))
    named = best.join(descriptions, "StockCode", "left").select("StockCode", "total_score", short_label(text).alias("label"))
    return named.orderBy(F.desc("total_score"), "StockCode")
