"""Popularity and average-score tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions import year_month


def with_year_month(ratings: DataFrame, zone: str = "UTC") -> DataFrame:
    return ratings.select(
        "productId", "score", year_month(F.col("timestamp"), zone).alias("yearMonth")
    )


def rate_more(ratings: DataFrame) -> DataFrame:
    """Ratings per product over all time, most rated first."""
    counts = ratings.groupBy("productId").agg(F.count("productId").alias("count"))
    return counts.orderBy(F.desc("count"), "productId")


def rate_more_recently(ratings: DataFrame, zone: str = "UTC") -> DataFrame:
    """Ratings per product and month, latest month and most rated first."""
    counts = (
        with_year_month(ratings, zone)
        .groupBy("yearMonth", "productId")
        .agg(F.count("productId").alias("count"))
    )
    return counts.select("productId", "count", "yearMonth").orderBy(
        F.desc("yearMonth"), F.desc("count"), "productId"
    )


def average_score(ratings: DataFrame) -> DataFrame:
    """Mean score per product, best first."""
    means = ratings.groupBy("productId").agg(F.avg("score").alias("avg"))
    return means.orderBy(F.desc("avg"), "productId")


def distinct_entities(ratings: DataFrame) -> DataFrame:
    """Every user and every product that occurs, as (kind, id)."""
    both = F.explode(
        F.array(
            F.struct(F.lit("user").alias("kind"), F.col("userId").alias("id")),
            F.struct(F.lit("product").alias("kind"), F.col("productId").alias("id")),
        )
    )
    return ratings.select(both.alias("e")).select("e.kind", "e.id").distinct()
