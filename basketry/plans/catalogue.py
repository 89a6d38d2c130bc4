"""One query per operator, each over whole supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry import jobs, schemas
from basketry.functions import log_line, normalise_score, split_list
from basketry.operators import factorization as als
from basketry.operators import factors
from basketry.operators import ratings as history
from basketry.operators import realtime, serving, similarity, statistics, users
from basketry.session import fresh_path, stored
from basketry.sources import files, sinks, tables
from basketry.sources.keyed import KeyedTable
from basketry.streaming import events as stream

Query = Callable[[SparkSession, str], DataFrame]

# List lengths and thresholds used by the registered queries.
LIST = 20
SHOWN = 6
SOLVED = 1e-3
NOW_MILLIS = 1_556_436_808_000
SHARDS = 4
SEARCH = "widget|ring"
RANKS = (8, 16, 32, 64)

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# ------------------------------------------------------------------------------------ scans


@query
def rating_scan(spark, sf_dir):
    return tables.order_ratings(spark, sf_dir).select("userId", "productId", "score")


@query
def rating_file_scan(spark, sf_dir):
    path = fresh_path(spark, "ratings-csv")
    tables.order_ratings(spark, sf_dir).write.csv(path)
    return files.read_ratings(spark, path)


@query
def product_scan(spark, sf_dir):
    path = fresh_path(spark, "products-csv")
    raw = tables.part_products(spark, sf_dir).select(
        "productId", "name", F.lit("1,2").alias("c"), F.lit("B0").alias("a"),
        F.concat(F.lit(" http://img/"), "productId").alias("imageUrl"), "categories", "tags",
    )
    raw.write.option("sep", "^").option("quote", "").csv(path)
    return files.read_products(spark, path)


@query
def rating_normalise(spark, sf_dir):
    stars = tables.order_stars(spark, sf_dir)
    return stars.select("userId", "productId", "raw", normalise_score(F.col("raw")).alias("score"))


@query
def rating_year_month(spark, sf_dir):
    return statistics.with_year_month(tables.order_ratings(spark, sf_dir))


@query
def sink_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "rating-table")
    sinks.overwrite_for_lookup(
        tables.order_ratings(spark, sf_dir), path, "userId", "productId", "timestamp"
    )
    return files.read_table(spark, path, schemas.RATING)


@query
def product_read(spark, sf_dir):
    """The ratings of the most rated product, read from a table laid out by user."""
    rated = tables.order_ratings(spark, sf_dir)
    kept = KeyedTable(spark, fresh_path(spark, "rating-table"), schemas.RATING, ["userId", "productId"], also=("productId",))
    kept.load(rated, 8)
    most = rated.groupBy("productId").count().orderBy(F.desc("count"), "productId").limit(1)
    return kept.lookup_other(most, "productId")


@query
def hot_products(spark, sf_dir):
    """How many of 200 tasks the ratings of each hot product would fill in the join of the stream."""
    return stream.hot_products(tables.event_ratings(spark, sf_dir), 200)


@query
def sink_overwrite(spark, sf_dir):
    """A table written twice holds the second rows alone."""
    path = fresh_path(spark, "rating-table")
    for ratings in (tables.order_ratings(spark, sf_dir), tables.event_ratings(spark, sf_dir)):
        sinks.overwrite(ratings, path)
    return files.read_table(spark, path, schemas.RATING)


# ------------------------------------------------------------------------------- statistics


@query
def rate_more(spark, sf_dir):
    return statistics.rate_more(tables.order_ratings(spark, sf_dir))


@query
def rate_more_recently(spark, sf_dir):
    return statistics.rate_more_recently(tables.order_ratings(spark, sf_dir))


@query
def average_score(spark, sf_dir):
    return rounded(statistics.average_score(tables.order_ratings(spark, sf_dir)), "avg")


@query
def distinct_entities(spark, sf_dir):
    return statistics.distinct_entities(tables.order_ratings(spark, sf_dir))


def _co_rated(ratings: DataFrame) -> similarity.Similarity:
    return similarity.kept(similarity.rater_similarity(ratings))


# ---------------------------------------------------------------------------------- serving


def _info(spark, sf_dir, listed: DataFrame | None = None) -> DataFrame:
    """Details of all products, or of the listed ones: only their ratings are averaged."""
    scored, products = tables.order_ratings(spark, sf_dir), tables.part_products(spark, sf_dir)
    if listed is not None:
        ids = listed.select("productId").distinct()
        scored, products = (x.join(ids, "productId", "left_semi") for x in (scored, products))
    return serving.product_info(products, statistics.average_score(scored))


@query
def product_info(spark, sf_dir):
    documents = serving.to_documents(_info(spark, sf_dir))
    return rounded(serving.from_documents(documents), "score")


@query
def product_search(spark, sf_dir):
    found = serving.search_by_name(tables.part_products(spark, sf_dir), SEARCH)
    return rounded(_info(spark, sf_dir, found), "score")


@query
def serve_hot(spark, sf_dir):
    recently = statistics.rate_more_recently(tables.order_ratings(spark, sf_dir))
    listed = serving.hot_list(recently, LIST)
    return rounded(serving.with_products(listed, _info(spark, sf_dir, listed)), "score")


@query
def hot_entries(spark, sf_dir):
    """The hot list as stored entries, each with the score 0.0 it carries until products are joined."""
    recently = statistics.rate_more_recently(tables.order_ratings(spark, sf_dir))
    return serving.hot_list(recently, LIST)


@query
def serve_rate_more(spark, sf_dir):
    counts = statistics.rate_more(tables.order_ratings(spark, sf_dir))
    listed = serving.most_rated_list(counts, LIST)
    return rounded(serving.with_products(listed, _info(spark, sf_dir, listed)), "score")


@query
def point_read(spark, sf_dir):
    """The details of one product, the last one, by its key."""
    products = tables.part_products(spark, sf_dir)
    last = products.agg(F.max("productId")).first()[0]
    return serving.by_key(products, "productId", last)


@query
def id_list_read(spark, sf_dir):
    """The products of a given list of ids, those of the first entries by popularity."""
    counts = statistics.rate_more(tables.order_ratings(spark, sf_dir))
    ids = [r[0] for r in serving.most_rated_list(counts, LIST).select("productId").collect()]
    return serving.by_ids(tables.part_products(spark, sf_dir), ids)


@query
def recs_to_products(spark, sf_dir):
    """Details of every product in the whole content-similarity list of every class, in list order.

    Classes of equal products list classes; the rank is that of the listed product's class.
    """
    similar = similarity.kept(similarity.tag_similarity(tables.part_products(spark, sf_dir)))
    others = similar.members.select(F.col("rep").alias("otherId"), F.col("item").alias("productId"))
    # Details come to each product once, before it is listed by many.
    others = serving.with_products(others, _info(spark, sf_dir))
    details = [c for c in others.columns if c not in ("productId", "otherId")]
    listed = similarity.whole_lists(similar).withColumnRenamed("productId", "forProduct").join(others, "otherId")
    listed = listed.where("productId <> forProduct").select("productId", "forProduct", "rank", *details)
    return rounded(listed, "score")


@query
def serve_user_recs(spark, sf_dir):
    """The first real-time recommendations of every customer who has any, by customer name."""
    ratings = tables.event_ratings(spark, sf_dir)
    recs = realtime.stream_recs(ratings, _co_rated(ratings))
    customers = tables.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("username"), F.col("c_custkey").cast("int").alias("userId")
    )
    info = _info(spark, sf_dir)
    shown = serving.recs_for_users(customers.select("username"), customers, recs, info, SHOWN)
    return rounded(shown.select("username", "userId", "rank", "productId", "name", "score"), "score")


# ------------------------------------------------------------------------- rating and user tables


@query
def rating_from_web(spark, sf_dir):
    """Order lines as web requests with the time in milliseconds."""
    stars = tables.order_stars(spark, sf_dir)
    return history.from_web(stars.withColumn("timestamp", F.col("timestamp") * 1000))


@query
def rating_upsert(spark, sf_dir):
    """Order ratings as the stored table, event ratings as the changes."""
    stored = tables.order_ratings(spark, sf_dir)
    return history.upsert(stored, tables.event_ratings(spark, sf_dir))


@query
def rating_upsert_keep_time(spark, sf_dir):
    stored = tables.order_ratings(spark, sf_dir)
    return history.upsert(stored, tables.event_ratings(spark, sf_dir), keep_first_timestamp=True)


@query
def user_register(spark, sf_dir):
    """Customers are registered; every customer and supplier name asks for registration."""
    registered = tables.customer_users(spark, sf_dir)
    names = registered.select("username").unionByName(
        tables.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("username"))
    )
    new = users.register(registered, names, NOW_MILLIS)
    return new.select("userId", "username", "first", "timestamp")


@query
def user_update(spark, sf_dir):
    """Customers with orders are no longer new and prefer their market segment."""
    customer = tables.table(spark, sf_dir, "customer")
    orders = tables.table(spark, sf_dir, "orders").select("o_custkey").distinct()
    active = customer.join(orders, customer.c_custkey == orders.o_custkey, "left_semi")
    names = active.select("c_name", "c_mktsegment")
    registered = tables.customer_users(spark, sf_dir)
    changes = names.join(registered, names.c_name == registered.username).select(
        "userId", F.lit(False).alias("first"), F.array("c_mktsegment").alias("prefGenres")
    )
    updated = users.update_profile(registered, changes)
    return updated.withColumn("prefGenres", F.array_join("prefGenres", "|"))


@query
def user_recent_ratings(spark, sf_dir):
    return history.recent_ratings(tables.event_ratings(spark, sf_dir), LIST)


@query
def train_test_split(spark, sf_dir):
    return history.hash_split(tables.event_ratings(spark, sf_dir))


# --------------------------------------------------------------------------------- text formats


@query
def log_format(spark, sf_dir):
    ratings = tables.event_ratings(spark, sf_dir)
    return ratings.select(log_line(*[F.col(c) for c in ratings.columns]).alias("line"))


@query
def log_parse(spark, sf_dir):
    lines = tables.event_log(spark, sf_dir).select("value")
    return stream.parsed_ratings(stream.rating_messages(lines))


@query
def log_quarantine(spark, sf_dir):
    return stream.unparsed_messages(tables.event_log(spark, sf_dir).select("value"))


@query
def tag_explode(spark, sf_dir):
    products = tables.part_products(spark, sf_dir)
    return products.select("productId", F.explode(split_list(F.col("tags"))).alias("tag"))


# ----------------------------------------------------------------------------------- similarity


def _pairs(s: similarity.Similarity) -> DataFrame:
    """Pairs of classes; who is in which class is told by the members."""
    pairs = s.pairs.where("item <> other").select(
        F.col("item").alias("productId"), F.col("other").alias("otherId"), F.col("sim")
    )
    return rounded(pairs, "sim")


def _top(s: similarity.Similarity) -> DataFrame:
    return rounded(similarity.top_similar(s, LIST), "sim")


def _members(s: similarity.Similarity) -> DataFrame:
    return s.members.select(F.col("item").alias("productId"), F.col("rep").alias("sameAs"))


@query
def product_similarity(spark, sf_dir):
    return _pairs(similarity.vector_similarity(tables.embedding_vectors(spark, sf_dir)))


@query
def product_similarity_members(spark, sf_dir):
    return _members(similarity.vector_similarity(tables.embedding_vectors(spark, sf_dir)))


@query
def product_recs(spark, sf_dir):
    vectors = tables.embedding_vectors(spark, sf_dir)
    return _top(similarity.vector_similarity(vectors, lists_of=LIST))


@query
def item_cf(spark, sf_dir):
    return _pairs(similarity.rater_similarity(tables.event_ratings(spark, sf_dir)))


@query
def item_cf_members(spark, sf_dir):
    return _members(similarity.rater_similarity(tables.event_ratings(spark, sf_dir)))


@query
def item_cf_orders(spark, sf_dir):
    return _pairs(similarity.rater_similarity(tables.order_ratings(spark, sf_dir), 0.1))


@query
def item_cf_orders_members(spark, sf_dir):
    return _members(similarity.rater_similarity(tables.order_ratings(spark, sf_dir), 0.1))


@query
def item_cf_recs(spark, sf_dir):
    return _top(similarity.rater_similarity(tables.event_ratings(spark, sf_dir)))


@query
def content_based(spark, sf_dir):
    return _pairs(similarity.tag_similarity(tables.part_products(spark, sf_dir)))


@query
def content_based_members(spark, sf_dir):
    return _members(similarity.tag_similarity(tables.part_products(spark, sf_dir)))


@query
def content_based_recs(spark, sf_dir):
    return _top(similarity.tag_similarity(tables.part_products(spark, sf_dir)))


@query
def sim_map(spark, sf_dir):
    """Similarity of every class to every other, looked up in the map form of its whole list."""
    similar = similarity.rater_similarity(tables.event_ratings(spark, sf_dir))
    maps = similarity.as_map(similarity.as_recs(similarity.whole_lists(similar)))
    found = maps.select(
        "productId",
        F.size("sims").alias("listed"),
        F.explode(F.map_keys("sims")).alias("otherId"),
        "sims",
    )
    return rounded(
        found.select(
            "productId",
            "listed",
            "otherId",
            similarity.sim_of(F.col("sims"), F.col("otherId")).alias("sim"),
            similarity.sim_of(F.col("sims"), F.lit(-1)).alias("unknown"),
        ),
        "sim",
    )


@query
def sim_lookup(spark, sf_dir):
    """Similarity of the products of any two consecutive ratings of a user, 0.0 if not over the threshold."""
    ratings = tables.event_ratings(spark, sf_dir)
    similar = _co_rated(ratings)
    turn = Window.partitionBy("userId").orderBy("timestamp", "productId", "score")
    asked = ratings.withColumn("otherId", F.lag("productId").over(turn)).dropna(subset=["otherId"])
    asked = asked.select("productId", "otherId").distinct()
    return rounded(similarity.sim_between(asked, similar), "sim")


# ------------------------------------------------------------------------------------ real time


@query
def candidate_products(spark, sf_dir):
    ratings = tables.event_ratings(spark, sf_dir)
    found = realtime.candidate_products(
        history.latest_rating(ratings), ratings, _co_rated(ratings), LIST
    )
    return rounded(found.select("userId", "rank", "productId", "sim"), "sim")


@query
def stream_recs(spark, sf_dir):
    ratings = tables.event_ratings(spark, sf_dir)
    recs = realtime.stream_recs(ratings, _co_rated(ratings))
    return rounded(serving.flatten(recs, "userId", keep_empty=True), "score")


@query
def similarity_index(spark, sf_dir):
    """The stored lists that real-time look-ups read: place in the list, and products of more similar classes."""
    path = fresh_path(spark, "similarity-index")
    similarity.write_index(_co_rated(tables.event_ratings(spark, sf_dir)), path, SHARDS)
    lists = similarity.whole_table(similarity.read_index(spark, path, SHARDS), "lists")
    listed = lists.select(F.col("item").alias("productId"), "rank", "ahead", F.col("other").alias("otherId"), "size", "sim")
    return rounded(listed, "sim")


@query
def indexed_recs(spark, sf_dir):
    """As stream_recs, from the stored lists."""
    ratings = stored(tables.event_ratings(spark, sf_dir), "ratings")
    path = fresh_path(spark, "similarity-index")
    similarity.write_index(_co_rated(ratings), path, SHARDS)
    recs = realtime.indexed_recs(ratings, similarity.read_index(spark, path, SHARDS), ratings)
    return rounded(serving.flatten(recs, "userId", keep_empty=True), "score")


@query
def rating_merge(spark, sf_dir):
    """Statistics of the rating table after event ratings were merged into the order ratings, in three batches."""
    base = fresh_path(spark, "merged")
    merged = jobs.rating_table(spark, base)
    merged.load(history.upsert(tables.order_ratings(spark, sf_dir), tables.order_ratings(spark, sf_dir).limit(0)), SHARDS)
    new = stored(tables.event_ratings(spark, sf_dir), "new")
    for part in range(3):
        merged.append(new.where(F.col("timestamp") % 3 == part), part + 2)
        merged.compact(most=1)
    return rounded(statistics.average_score(merged.read()), "avg")


@query
def rating_merge_rows(spark, sf_dir):
    """The merged rating table itself."""
    base = fresh_path(spark, "merged")
    merged = jobs.rating_table(spark, base)
    merged.load(history.upsert(tables.order_ratings(spark, sf_dir), tables.order_ratings(spark, sf_dir).limit(0)), SHARDS)
    merged.append(tables.event_ratings(spark, sf_dir), 2)
    return merged.read()


# -------------------------------------------------------------------------- matrix factorisation


def _order_model(spark, sf_dir):
    ratings = tables.order_ratings(spark, sf_dir)
    return als.train(history.upsert(ratings, ratings.limit(0)))


def _event_split(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    split = history.hash_split(tables.event_ratings(spark, sf_dir))
    return split.where("part = 'train'"), split.where("part = 'test'")


@query
def rmse_eval(spark, sf_dir):
    return rounded(als.rmse(als.item_mean_predictions(*_event_split(spark, sf_dir))), "rmse")


@query
def als_factors(spark, sf_dir):
    model = _order_model(spark, sf_dir)
    by_user = als.user_vectors(model).toDF("id", "vector").withColumn("kind", F.lit("user"))
    by_product = als.product_vectors(model).toDF("id", "vector").withColumn("kind", F.lit("product"))
    return by_user.unionByName(by_product)


@query
def als_factor_shape(spark, sf_dir):
    """Whom the model has factors for, how many each, and whether they are finite."""
    model = _order_model(spark, sf_dir)
    by_user = als.user_vectors(model).toDF("id", "vector").withColumn("kind", F.lit("user"))
    by_product = als.product_vectors(model).toDF("id", "vector").withColumn("kind", F.lit("product"))
    finite = F.forall("vector", lambda x: F.abs(x) < 1e9)
    return by_user.unionByName(by_product).select(
        "kind", "id", F.size("vector").alias("dims"), finite.alias("finite")
    )


@query
def als_residuals(spark, sf_dir):
    """Whether the model's factors solve the normal equations of every user's ratings."""
    ratings = tables.order_ratings(spark, sf_dir)
    ratings = stored(history.upsert(ratings, ratings.limit(0)), "rated")
    model = als.train(ratings)
    found = als.user_residuals(ratings, als.user_vectors(model, "float"), als.product_vectors(model, "float"))
    return found.select("userId", "n", (F.col("residual") < SOLVED).alias("solved"))


@query
def als_predict(spark, sf_dir):
    """Predictions for every pair rated by an event, from the model of the order ratings."""
    pairs = tables.event_ratings(spark, sf_dir).select("userId", "productId").distinct()
    return als.predict(_order_model(spark, sf_dir), pairs)


@query
def als_user_recs(spark, sf_dir):
    return serving.flatten(als.user_recs(_order_model(spark, sf_dir), LIST), "userId")


@query
def als_product_recs(spark, sf_dir):
    return _top(als.product_similarity(_order_model(spark, sf_dir), lists_of=LIST))


@query
def param_grid(spark, sf_dir):
    grid = als.grid_search(*_event_split(spark, sf_dir))
    best = als.best_point(grid).select("rank", "regParam", F.lit(True).alias("best"))
    return grid.join(best, ["rank", "regParam"], "left").fillna(False, ["best"])


# Given factors: the supplied vectors, as those of users and of products alike.


def _factors(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    vectors = tables.embedding_vectors(spark, sf_dir)
    return vectors.withColumnRenamed("productId", "userId"), vectors


@query
def factor_user_recs(spark, sf_dir):
    return factors.user_lists(*_factors(spark, sf_dir), LIST)


@query
def factor_predict(spark, sf_dir):
    pairs = tables.event_ratings(spark, sf_dir).select("userId", "productId").distinct()
    return rounded(factors.predictions(pairs, *_factors(spark, sf_dir)), "prediction")


@query
def factor_rmse(spark, sf_dir):
    predicted = factors.predictions(tables.event_ratings(spark, sf_dir), *_factors(spark, sf_dir))
    return rounded(als.rmse(predicted), "rmse")


@query
def factor_grid(spark, sf_dir):
    """Error on (user, product) of the factors cut to several ranks, and which rank is best."""
    ratings = tables.event_ratings(spark, sf_dir)
    grid = factors.rmse_by_rank(ratings, *_factors(spark, sf_dir), RANKS)
    grid = stored(grid.withColumn("regParam", F.lit(0.0)), "grid")
    best = als.best_point(grid).select("rank", F.lit(True).alias("best"))
    return rounded(grid.join(best, "rank", "left").fillna(False, ["best"]).select("rank", "rmse", "best"), "rmse")


# ------------------------------------------------------------------------------------ streaming


def _logged(spark, sf_dir) -> str:
    """Writes the event log as text files and gives their folder."""
    path = fresh_path(spark, "event-log")
    tables.event_log(spark, sf_dir).select("value").write.text(path)
    return path


def _run(spark, df: DataFrame, label: str) -> DataFrame:
    """Runs a stream over all that is there and reads back what it appended."""
    path = fresh_path(spark, label)
    stream.append_files(df, path, fresh_path(spark, f"{label}-checkpoint")).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


@query
def stream_log_filter(spark, sf_dir):
    lines = stream.text_lines(spark, _logged(spark, sf_dir))
    return _run(spark, stream.keyed_messages(stream.rating_messages(lines)), "messages")


@query
def stream_rating_parse(spark, sf_dir):
    lines = stream.text_lines(spark, _logged(spark, sf_dir))
    return _run(spark, stream.parsed_ratings(stream.rating_messages(lines)), "ratings")


@query
def stream_restart(spark, sf_dir):
    """The log arrives in two parts; the second run goes on from the first one's checkpoint."""
    log = tables.event_log(spark, sf_dir)
    half = log.agg(F.avg("event_id")).first()[0]
    source, target, progress = (fresh_path(spark, x) for x in ("log", "ratings", "ratings-progress"))
    for arrival in (F.col("event_id") <= half, F.col("event_id") > half):
        log.where(arrival).select("value").write.mode("append").text(source)
        parsed = stream.parsed_ratings(stream.rating_messages(stream.text_lines(spark, source)))
        stream.append_files(parsed, target, progress).awaitTermination()
    return spark.read.schema(parsed.schema).parquet(target)


@query
def stream_daily(spark, sf_dir):
    """Ratings by day of event time, of the days that the watermark has closed."""
    lines = stream.text_lines(spark, _logged(spark, sf_dir))
    parsed = stream.parsed_ratings(stream.rating_messages(lines))
    return _run(spark, stream.counts_by_time(parsed), "daily").select(
        F.unix_timestamp("windowStart").alias("day"), "ratings", "scores"
    )


@query
def stream_similar(spark, sf_dir):
    """Every rating event of the stream joined with the whole stored list of its product's class."""
    similar = _co_rated(tables.event_ratings(spark, sf_dir))
    stored = fresh_path(spark, "product-recs")
    lists = similarity.as_recs(similarity.whole_lists(similar)).withColumnRenamed("productId", "rep")
    of_member = similar.members.join(lists, "rep").select(F.col("item").alias("productId"), "recs")
    sinks.overwrite(of_member, stored)
    recs = files.read_table(spark, stored, schemas.PRODUCT_RECS)
    lines = stream.text_lines(spark, _logged(spark, sf_dir))
    parsed = stream.parsed_ratings(stream.rating_messages(lines))
    joined = _run(spark, stream.join_recs(parsed, recs), "events-with-recs")
    return rounded(
        joined.select("userId", "productId", "timestamp", F.posexplode_outer("recs").alias("pos", "rec"))
        .select("userId", "productId", "timestamp", "pos", "rec.productId", "rec.score")
        .toDF("userId", "productId", "timestamp", "pos", "otherId", "sim"),
        "sim",
    )


@query
def stream_rescore(spark, sf_dir):
    """Real-time lists kept up to date by two arrivals of log files, each rescoring whom it touched."""
    similar = _co_rated(tables.event_ratings(spark, sf_dir))
    log = tables.event_log(spark, sf_dir)
    half = log.agg(F.avg("event_id")).first()[0]
    source, target, progress = (fresh_path(spark, x) for x in ("log", "ratings", "ratings-progress"))
    snapshot = spark.createDataFrame([], schemas.USER_RECS)
    for arrival, part in enumerate((F.col("event_id") <= half, F.col("event_id") > half)):
        log.where(part).select("value").write.mode("append").text(source)
        lines = stream.text_lines(spark, source)
        parsed = stream.parsed_ratings(stream.rating_messages(lines))
        ratings = sinks.sharded(stream.stamped(parsed, arrival), SHARDS)
        stream.append_files(ratings, target, progress, partition_by=("arrival", "shard")).awaitTermination()
        stored_ratings = spark.read.schema(ratings.schema).parquet(target)
        new = stored_ratings.where(F.col("arrival") == arrival).drop("arrival")
        lists = stream.rescore(stored_ratings.drop("arrival"), similar, snapshot, new)
        snapshot = stored(lists, "stream-recs")
    return rounded(serving.flatten(snapshot, "userId", keep_empty=True), "score")


@query
def stream_follow_log(spark, sf_dir):
    """The job that follows a log: two arrivals, each merged into the ratings, whose users get their lists anew."""
    base, source = fresh_path(spark, "follow"), fresh_path(spark, "log")
    jobs.start_ratings(spark, base, spark.createDataFrame([], schemas.RATING), SHARDS)
    similarity.write_index(_co_rated(tables.event_ratings(spark, sf_dir)), f"{base}/{jobs.PRODUCT_INDEX}", SHARDS)
    log = tables.event_log(spark, sf_dir)
    half = log.agg(F.avg("event_id")).first()[0]
    for arrival in (F.col("event_id") <= half, F.col("event_id") > half):
        log.where(arrival).select("value").write.mode("append").text(source)
        jobs.follow_log(spark, base, source)
    lists = jobs.table(spark, base, jobs.STREAM_RECS)
    return rounded(serving.flatten(lists, "userId", keep_empty=True), "score")


@query
def stream_user_recents(spark, sf_dir):
    """The bounded history of every user after the whole stream."""
    lines = stream.text_lines(spark, _logged(spark, sf_dir))
    parsed = stream.parsed_ratings(stream.rating_messages(lines))
    versions = _run(spark, stream.recent_state(parsed), "recent-state")
    return stream.current_state(versions)
