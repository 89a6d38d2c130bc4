"""The recommender's jobs from files to result tables, each table a folder under one base path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas
from basketry.operators import factorization, ratings, realtime, similarity, statistics
from basketry.session import children, gathered, remove, scratch, stored
from basketry.sources import files, sinks
from basketry.sources.keyed import MOST, KeyedTable
from basketry.streaming import events

# Table names.
PRODUCT = "Product"
RATING = "Rating"
RATE_MORE = "RateMoreProducts"
RATE_MORE_RECENTLY = "RateMoreRecentlyProducts"
AVERAGE = "AverageProducts"
USER_RECS = "UserRecs"
PRODUCT_RECS = "ProductRecs"
ITEM_CF_RECS = "ItemCFProductRecs"
CONTENT_RECS = "ContentBasedProductRecs"
STREAM_RECS = "StreamRecs"
RECENT = "RecentRatings"

PRODUCT_PAIRS = "ProductSimilarityPairs"
PRODUCT_MEMBERS = "ProductSimilarityMembers"
# Pairs of classes over the threshold, who is in which class, and lists for display.
PRODUCT_TABLES = (PRODUCT_PAIRS, PRODUCT_MEMBERS, PRODUCT_RECS)
ITEM_CF_TABLES = ("ItemCFPairs", "ItemCFMembers", ITEM_CF_RECS)
CONTENT_TABLES = ("ContentBasedPairs", "ContentBasedMembers", CONTENT_RECS)
PRODUCT_INDEX = "ProductSimilarityIndex"
ARRIVED = "ArrivedRatings"
ARRIVALS = T.StructType([*schemas.RATING.fields, T.StructField("arrival", T.IntegerType())])
REJECTED = "Rejected"
SHARDS = 256


def rating_table(spark: SparkSession, base: str) -> KeyedTable:
    """Ratings by user, also looked up by product: those loaded, and of every (user, product) rated since, the newest."""
    return KeyedTable(spark, f"{base}/{RATING}", schemas.RATING, ["userId", "productId"], ("timestamp",), ("productId",))


def list_table(spark: SparkSession, base: str) -> KeyedTable:
    """The real-time list of every user, the last one written."""
    return KeyedTable(spark, f"{base}/{STREAM_RECS}", schemas.USER_RECS, ["userId"])


def recent_table(spark: SparkSession, base: str) -> KeyedTable:
    """The newest ratings of every user in one row; rating a product again does not take the older entry away."""
    return KeyedTable(spark, f"{base}/{RECENT}", schemas.RECENT_LISTS, ["userId"])


KEYED = {RATING: rating_table, RECENT: recent_table, STREAM_RECS: list_table}


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return KEYED[name](spark, base).read() if name in KEYED else spark.read.parquet(f"{base}/{name}")


def load(
    spark: SparkSession, base: str, product_file: str, rating_file: str, shards: int = SHARDS
) -> None:
    """Product and rating files to tables laid out for lookup; unusable rows go to their own tables.

    Ratings are partitioned by a hash of the user; those that follow from the log join them there.
    """
    products = files.typed_products(
        files.delimited(spark, product_file, schemas.PRODUCT_FILE, "^")
    )
    scored = files.typed_ratings(files.delimited(spark, rating_file, schemas.RATING_FILE, ","))
    for name, rows in ((PRODUCT, products), (RATING, scored)):
        sinks.overwrite(files.quarantined(rows), f"{base}/{REJECTED}{name}")
    sinks.overwrite_for_lookup(files.accepted(products), f"{base}/{PRODUCT}", "productId")
    start_ratings(spark, base, files.accepted(scored), shards)


def start_ratings(spark: SparkSession, base: str, scored: DataFrame, shards: int = SHARDS) -> None:
    """The rating table and every user's newest ratings, to be followed by :func:`take_ratings`."""
    rating_table(spark, base).load(scored, shards)
    newest = ratings.to_recent_lists(table(spark, base, RATING), events.CAPACITY)
    recent_table(spark, base).load(newest, shards)


def count_ratings(spark: SparkSession, base: str) -> None:
    """The three statistics tables."""
    scored = table(spark, base, RATING)
    sinks.overwrite(statistics.rate_more(scored), f"{base}/{RATE_MORE}")
    sinks.overwrite(statistics.rate_more_recently(scored), f"{base}/{RATE_MORE_RECENTLY}")
    sinks.overwrite(statistics.average_score(scored), f"{base}/{AVERAGE}")


def factorize(
    spark: SparkSession,
    base: str,
    rank: int = factorization.BEST_RANK,
    iterations: int = factorization.ITERATIONS,
    reg_param: float = factorization.BEST_REG_PARAM,
    n: int = 20,
    threshold: float = 0.4,
) -> None:
    """User lists, the whole product similarity (pairs of classes and members), and product lists of n."""
    with scratch(spark):
        rated = table(spark, base, RATING)
        model = factorization.train(ratings.upsert(rated, rated.limit(0)), rank, iterations, reg_param)
        sinks.overwrite(factorization.user_recs(model, n), f"{base}/{USER_RECS}")
        _write_similarity(spark, base, factorization.product_similarity(model, threshold), n, *PRODUCT_TABLES)
        similarity.write_index(product_similarity(spark, base), f"{base}/{PRODUCT_INDEX}", rating_table(spark, base).shards())


def product_similarity(spark: SparkSession, base: str) -> similarity.Similarity:
    return similarity.Similarity(
        table(spark, base, PRODUCT_PAIRS), table(spark, base, PRODUCT_MEMBERS)
    )


def _write_similarity(
    spark: SparkSession, base: str, found: similarity.Similarity, n: int, pairs: str, members: str, lists: str
) -> None:
    """The whole similarity, which look-ups read, and lists of n for display."""
    sinks.overwrite(found.pairs, f"{base}/{pairs}")
    sinks.overwrite(found.members, f"{base}/{members}")
    whole = similarity.Similarity(table(spark, base, pairs), table(spark, base, members))
    sinks.overwrite(similarity.as_recs(similarity.top_similar(whole, n)), f"{base}/{lists}")


def relate_products(spark: SparkSession, base: str, n: int = 20, threshold: float = 0.4) -> None:
    """Product similarity and lists by common raters and by tags."""
    with scratch(spark):
        by_raters = similarity.rater_similarity(table(spark, base, RATING), threshold)
        _write_similarity(spark, base, by_raters, n, *ITEM_CF_TABLES)
        by_tags = similarity.tag_similarity(table(spark, base, PRODUCT), threshold)
        _write_similarity(spark, base, by_tags, n, *CONTENT_TABLES)


def tune(spark: SparkSession, base: str, **grid) -> DataFrame:
    """The parameter pair of least hold-out error on an 80/20 split, as (rank, regParam, rmse)."""
    with scratch(spark):
        split = stored(ratings.hash_split(table(spark, base, RATING)), "tuning")
        train, test = split.where("part = 'train'"), split.where("part = 'test'")
        return factorization.best_point(factorization.grid_search(train, test, **grid))


def take_ratings(spark: SparkSession, base: str, new: DataFrame, version: int, most: int = MOST) -> None:
    """Merges new ratings into the rating table and renews the lists of their users, as one version.

    What is read and written goes with the ratings taken in: their users' shards, the stored lists of the
    products just rated as far as needed, and one folder for each shard touched. A version that was
    taken in before is left as it is, so a call that failed is simply repeated.
    """
    scored, recent, lists = (KEYED[name](spark, base) for name in (RATING, RECENT, STREAM_RECS))
    scored.append(new, version)
    taken = gathered(scored.changes(version), "taken")
    # Tables look at a batch before they write it, so what a large one takes to work out is stored first.
    settled = (lambda rows, label: rows) if taken.isLocal() else stored
    if version > recent.version():
        with scratch(spark):
            before = ratings.from_recent_lists(recent.lookup(taken)).drop("position")
            recent.append(settled(ratings.to_recent_lists(before.unionByName(taken), events.CAPACITY), "recents"), version)
    if version > lists.version():
        index = similarity.read_index(spark, f"{base}/{PRODUCT_INDEX}", scored.shards())
        with scratch(spark):
            history = gathered(scored.lookup(taken), "history", source=taken)
            newest = gathered(ratings.from_recent_lists(recent.changes(version)), "newest", source=taken)
            lists.append(settled(realtime.indexed_recs(history, index, taken, newest), "lists"), version, scored.shards())
    for one in (scored, recent, lists):
        one.compact(most)


def arrive(spark: SparkSession, base: str, log: str, version: int) -> None:
    """Appends what is new in the log folder to the arrivals, under the number of the version it will be."""
    parsed = events.parsed_ratings(events.rating_messages(events.text_lines(spark, log)))
    target = f"{base}/{ARRIVED}"
    events.append_files(
        events.stamped(parsed, version), target, f"{target}-progress", partition_by=("arrival",)
    ).awaitTermination()


def follow_log(spark: SparkSession, base: str, log: str, most: int = MOST) -> None:
    """Takes in what was appended to the log folder since the last call, each line once.

    What a failed call had read from the log is taken in first, as the version it was meant to be.
    """
    arrived = f"{base}/{ARRIVED}"

    def take(version: int) -> int:
        if not children(spark, f"{arrived}/arrival={version}"):
            return version - 1
        every = spark.read.schema(ARRIVALS).parquet(arrived)
        take_ratings(spark, base, every.where(F.col("arrival") == version).drop("arrival"), version, most)
        # Readers ask for one arrival only, so those taken in before can go.
        remove(spark, f"{arrived}/arrival={version - 1}")
        return version

    # Version 1 is what was loaded.
    done = take(max(1, list_table(spark, base).version()) + 1)
    arrive(spark, base, log, done + 1)
    take(done + 1)
