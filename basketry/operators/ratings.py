"""Rating table maintenance, per-user history and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions import epoch_seconds, normalise_score


def from_web(requests: DataFrame) -> DataFrame:
    """Ratings from web requests (userId, productId, raw, timestamp): stars halved, time in seconds."""
    return schemas.conform(
        requests.withColumns(
            {
                "score": normalise_score(F.col("raw")),
                "timestamp": epoch_seconds(F.col("timestamp")),
            }
        ),
        schemas.RATING,
    )


def newest(*columns: str) -> Column:
    """An order key that is larger for newer ratings; equal times fall back to the given columns."""
    return F.struct("timestamp", *columns)


def upsert(base: DataFrame, changes: DataFrame, keep_first_timestamp: bool = False) -> DataFrame:
    """One rating per (userId, productId): the newest of base and changes, changes winning ties.

    With ``keep_first_timestamp`` a re-rating changes the score only.
    """
    every = base.withColumn("step", F.lit(0)).unionByName(changes.withColumn("step", F.lit(1)))
    when = F.min("timestamp") if keep_first_timestamp else F.max("timestamp")
    return every.groupBy("userId", "productId").agg(
        F.max_by("score", newest("step", "score")).alias("score"),
        when.alias("timestamp"),
    )


def recent_ratings(ratings: DataFrame, n: int = 20) -> DataFrame:
    """The n newest ratings of each user, numbered from 1 (newest)."""
    order = [F.desc("timestamp"), F.desc("productId"), F.desc("score")]
    position = F.row_number().over(Window.partitionBy("userId").orderBy(*order))
    return ratings.withColumn("position", position).where(F.col("position") <= n)


def to_recent_lists(ratings: DataFrame, n: int) -> DataFrame:
    """(userId, recents): the n newest ratings of each user in one row, newest first."""
    entry = F.struct("position", "productId", "score", "timestamp")
    lists = recent_ratings(ratings, n).groupBy("userId").agg(F.array_sort(F.collect_list(entry)).alias("l"))
    return lists.select("userId", F.transform("l", lambda e: F.struct(e.productId, e.score, e.timestamp)).alias("recents"))


def from_recent_lists(lists: DataFrame) -> DataFrame:
    """(userId, position, productId, score, timestamp), the rows of the lists."""
    return lists.select("userId", F.posexplode("recents").alias("at", "e")).select(
        "userId", (F.col("at") + 1).alias("position"), "e.productId", "e.score", "e.timestamp"
    )


def latest_rating(ratings: DataFrame) -> DataFrame:
    """The newest rating of each user; the same one that has position 1 in recent_ratings."""
    whole = F.struct("timestamp", "productId", "score")
    last = ratings.groupBy("userId").agg(F.max(whole).alias("last"))
    return last.select("userId", "last.productId", "last.score", "last.timestamp")


def hash_split(ratings: DataFrame, train: float = 0.8, seed: int = 0) -> DataFrame:
    """Adds ``part`` ('train' or 'test') from a seeded hash of the row.

    Unlike ``randomSplit`` the result does not depend on partitioning or row order, so a
    recomputed task puts every row on the same side again.
    """
    key = F.md5(F.concat_ws("|", "userId", "productId", "timestamp", F.lit(seed)))
    share = F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))
    return ratings.withColumn("part", F.when(share < train, "train").otherwise("test"))
