"""Real-time recommendation lists: candidates similar to the product just rated, scored against
the user's recent ratings.

Every step is a join on user or product; the work per user is bounded by the list sizes and by
what the user has rated, never by the number of similar products.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import log_gain
from basketry.operators.ratings import latest_rating, recent_ratings
from basketry.operators.similarity import Index, Similarity
from basketry.session import gathered, stored


def candidate_products(
    events: DataFrame, ratings: DataFrame, similarity: Similarity, n: int = 20
) -> DataFrame:
    """(userId, rank, productId, rep, sim): for each event (userId, productId), the n products most
    similar to it that the user has not rated. One event per user.

    A user with r ratings can lose at most r list entries to rated products, so only the first n + r
    products of a similarity list can matter, whatever r is. Only the lists of the products just rated
    are ranked, and read as far as the products that come before fall short of that.
    """
    rated = ratings.select("userId", "productId").distinct()
    rated = rated.join(events.select("userId").distinct(), "userId", "left_semi")
    reach = rated.groupBy("userId").agg((F.count("*") + n + 1).alias("reach"))
    trigger = (
        events.select("userId", F.col("productId").alias("item"))
        .join(reach, "userId", "left")
        .withColumn("reach", F.coalesce("reach", F.lit(n + 1)))
        .join(similarity.members, "item")
        .withColumnRenamed("item", "trigger")
    )
    furthest = trigger.groupBy("rep").agg(F.max("reach").alias("furthest"))
    lists = similarity.pairs.withColumnRenamed("item", "rep").join(furthest, "rep")
    sizes = similarity.members.groupBy(F.col("rep").alias("other")).agg(F.count("*").alias("size"))
    # So many products come before any of a class at least: all of the classes that are more similar, and
    # one of each that is as similar and has a smaller first product.
    equal = Window.partitionBy("rep", "sim")
    so_far = F.sum("size").over(Window.partitionBy("rep").orderBy(F.desc("sim")))
    earlier = so_far - F.sum("size").over(equal) + F.row_number().over(equal.orderBy("other")) - 1
    near = lists.join(sizes, "other").withColumn("before", earlier).where("before < furthest")
    near = stored(near, "near")
    members = similarity.members.select(F.col("rep").alias("other"), F.col("item").alias("productId"))
    members = members.join(near.groupBy("other").agg(F.max("furthest").alias("most")), "other")
    in_class = F.row_number().over(Window.partitionBy("other").orderBy("productId"))
    first = members.withColumn("member_rank", in_class).where("member_rank <= most").drop("most")
    possible = (
        trigger.join(near.drop("furthest", "size"), "rep")
        .where("before < reach")
        .join(first, "other")
        .where("member_rank <= reach")
        .select("userId", "trigger", "productId", "other", "sim")
        .where(F.col("productId") != F.col("trigger"))
        .join(rated, ["userId", "productId"], "left_anti")
    )
    place = Window.partitionBy("userId").orderBy(F.desc("sim"), "productId")
    return (
        possible.withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= n)
        .select("userId", "rank", "productId", F.col("other").alias("rep"), "sim")
    )


def score_candidates(
    candidates: DataFrame, recents: DataFrame, similarity: Similarity, threshold: float = 0.4
) -> DataFrame:
    """(userId, productId, score) of candidates with a recent rating of similarity over threshold.

    Score: mean of similarity * rating, plus log10 of the ratings above 3, minus log10 of the others.
    """
    recent = recents.select("userId", F.col("productId").alias("item"), F.col("score").alias("stars"))
    recent = recent.join(similarity.members, "item").select(
        "userId", F.col("rep").alias("recent_rep"), "stars"
    )
    close = similarity.pairs.where(F.col("sim") > threshold).select(
        F.col("item").alias("rep"), F.col("other").alias("recent_rep"), "sim"
    )
    # Only the lists of candidates are read; a batch has few.
    close = close.join(candidates.select("rep").distinct(), "rep", "left_semi")
    asked = candidates.select("userId", "productId", "rep").join(recent, "userId")
    return _mean_scores(asked.join(close, ["rep", "recent_rep"]))


def _mean_scores(rows: DataFrame) -> DataFrame:
    """(userId, productId, score) from each candidate's similar recent ratings (sim, stars)."""
    liked = F.col("stars") > 3
    return rows.groupBy("userId", "productId").agg(
        (
            F.avg(F.col("sim") * F.col("stars"))
            + log_gain(F.count_if(liked))
            - log_gain(F.count_if(~liked))
        ).alias("score")
    )


def indexed_candidates(events: DataFrame, ratings: DataFrame, index: Index, n: int = 20) -> DataFrame:
    """As :func:`candidate_products`, from stored lists that are read as far as they can matter.

    Of a list, rows of rank and with products ahead within n + 1 + what the user has rated; of a class,
    as many members. No list is sorted, and none is read beyond that.
    """
    rated = ratings.select("userId", "productId").distinct()
    reach = rated.groupBy("userId").agg((F.count("*") + n + 1).alias("reach"))
    trigger = events.select("userId", F.col("productId").alias("item")).join(reach, "userId", "left")
    trigger = trigger.withColumn("reach", F.coalesce("reach", F.lit(n + 1)))
    trigger = gathered(trigger.join(index.reps_of(events.select(F.col("productId").alias("item"))), "item"), "triggers", source=events)
    trigger = trigger.withColumnRenamed("item", "trigger")
    furthest = trigger.groupBy(F.col("rep").alias("item")).agg(F.max("reach").alias("furthest"))
    near = index.lists_of(trigger.select(F.col("rep").alias("item"))).join(furthest, "item")
    near = gathered(near.where("rank <= furthest AND ahead < furthest"), "near", source=events)
    several = near.where("size > 1")
    members = index.members_of(several.select(F.col("other").alias("rep"))).select(
        F.col("rep").alias("other"), "place", F.col("item").alias("productId")
    )
    most = several.groupBy("other").agg(F.max("furthest").alias("most"))
    members = members.join(most, "other").where("place <= most").drop("most")
    listed = near.where("size = 1").withColumns({"place": F.lit(1), "productId": F.col("other")})
    listed = listed.unionByName(several.join(members, "other")).withColumnRenamed("item", "rep")
    possible = (
        trigger.join(listed, "rep")
        .where("rank <= reach AND ahead < reach AND place <= reach AND productId <> trigger")
        .select("userId", "productId", "other", "sim")
        .join(rated, ["userId", "productId"], "left_anti")
    )
    place = Window.partitionBy("userId").orderBy(F.desc("sim"), "productId")
    return (
        possible.withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= n)
        .select("userId", "rank", "productId", F.col("other").alias("rep"), "sim")
    )


def indexed_scores(candidates: DataFrame, recents: DataFrame, index: Index, threshold: float = 0.4) -> DataFrame:
    """As :func:`score_candidates`; only the similarities of candidates to recent ratings are read."""
    recent = recents.select("userId", F.col("productId").alias("item"), F.col("score").alias("stars"))
    recent = recent.join(index.reps_of(recent), "item").select("userId", F.col("rep").alias("other"), "stars")
    asked = candidates.select("userId", "productId", F.col("rep").alias("item")).join(recent, "userId")
    close = index.sims_of(candidates.select(F.col("rep").alias("item"))).where(F.col("sim") > threshold)
    return _mean_scores(asked.join(close, ["item", "other"]))


def indexed_recs(
    ratings: DataFrame,
    index: Index,
    events: DataFrame,
    recents: DataFrame | None = None,
    n_recent: int = 20,
    n_candidates: int = 20,
    threshold: float = 0.4,
) -> DataFrame:
    """As :func:`stream_recs` for the users of ``events``, whose ratings ``ratings`` holds.

    ``recents``: their newest ratings with ``position``, where these are kept apart.
    """
    events = gathered(latest_rating(events), "latest")
    newest = recent_ratings(ratings, n_recent) if recents is None else recents
    recents = gathered(newest.where(F.col("position") <= n_recent), "recent-ratings", source=events)
    candidates = gathered(indexed_candidates(events, ratings, index, n_candidates), "candidates", source=events)
    scored = indexed_scores(candidates, recents, index, threshold)
    return to_user_recs(events.select("userId"), ranked_scores(scored))


def ranked_scores(scored: DataFrame) -> DataFrame:
    """Adds ``rank`` by score within each user."""
    place = Window.partitionBy("userId").orderBy(F.desc("score"), "productId")
    return scored.withColumn("rank", F.row_number().over(place))


def to_user_recs(users: DataFrame, ranked: DataFrame) -> DataFrame:
    """(userId, recs): one row per user in rank order, an empty list where nothing survived."""
    entry = F.struct("rank", "productId", "score")
    lists = ranked.groupBy("userId").agg(F.array_sort(F.collect_list(entry)).alias("l"))
    recs = F.transform(
        F.coalesce("l", F.array()), lambda e: F.struct(e.productId.alias("productId"), e.score.alias("score"))
    )
    return users.join(lists, "userId", "left").select("userId", recs.alias("recs"))


def stream_recs(
    ratings: DataFrame,
    similarity: Similarity,
    events: DataFrame | None = None,
    n_recent: int = 20,
    n_candidates: int = 20,
    threshold: float = 0.4,
) -> DataFrame:
    """(userId, recs) as left behind by a stream of rating events.

    ``ratings`` already holds the events. Since the last save wins, each user's latest event
    decides; ``events`` defaults to the latest rating of every user.
    """
    recents = stored(recent_ratings(ratings, n_recent), "recent-ratings")
    events = recents.where("position = 1") if events is None else latest_rating(events)
    candidates = candidate_products(events, ratings, similarity, n_candidates)
    scored = score_candidates(candidates, recents, similarity, threshold)
    return to_user_recs(events.select("userId"), ranked_scores(scored))
