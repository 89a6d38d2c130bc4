"""Rating, product, user and log views over the supplied test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions import LOG_MARKER, java_string_hash, log_line, normalise_score


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds_of(moment: Column) -> Column:
    """Epoch seconds of a time without zone, read as UTC whatever the session zone is."""
    days = F.unix_date(moment.cast("date")).cast("bigint")
    return days * 86400 + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


def order_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw 1..10 star value per order line."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("productId"),
        (F.pmod(F.col("l_quantity").cast("int") - 1, F.lit(10)) + 1).alias("raw"),
        seconds_of(F.col("o_orderdate")).alias("timestamp"),
    )


def order_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    stars = order_stars(spark, sf_dir)
    return schemas.conform(stars.withColumn("score", normalise_score(F.col("raw"))), schemas.RATING)


def event_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per event that is not an error."""
    events = table(spark, sf_dir, "events").where("event_type <> 'error'")
    return schemas.conform(_event_fields(events), schemas.RATING)


def _event_fields(events: DataFrame) -> DataFrame:
    raw = F.pmod(F.floor("value").cast("int"), F.lit(10)) + 1
    return events.select(
        F.col("user_id").alias("userId"),
        F.from_json("props", "k INT")["k"].alias("productId"),
        normalise_score(raw).alias("score"),
        seconds_of(F.col("ts")).alias("timestamp"),
        "event_type",
        "value",
        "event_id",
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an application-log line: (event_id, value).

    Errors give lines without a marker or with a marked but unusable message.
    """
    e = _event_fields(table(spark, sf_dir, "events"))
    prefix = F.lit("INFO --- [http] web :  ")
    user, product = F.col("userId"), F.col("productId")
    line = (
        F.when(
            F.col("event_type") != "error",
            F.concat(prefix, log_line(user, product, F.col("score"), F.col("timestamp"))),
        )
        .when(F.col("value") < 2, F.concat(prefix, F.lit(LOG_MARKER)))
        .when(
            F.col("value") < 5,
            F.concat(prefix, F.lit(LOG_MARKER), F.concat_ws("|", user, product)),
        )
        .when(
            F.col("value") < 10,
            F.concat(prefix, F.lit(LOG_MARKER), F.concat_ws("|", user, product, F.lit("x"), F.lit("y"))),
        )
        .otherwise(F.concat(F.lit("ERROR --- [http] user "), user.cast("string")))
    )
    return e.select("event_id", line.alias("value"))


def part_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with tags: the words of name, type and brand."""
    words = F.concat_ws(" ", "p_name", "p_type", "p_brand")
    part = table(spark, sf_dir, "part")
    return schemas.conform(
        part.select(
            F.col("p_partkey").alias("productId"),
            F.col("p_name").alias("name"),
            F.lit("").alias("imageUrl"),
            F.col("p_type").alias("categories"),
            F.regexp_replace(words, " +", "|").alias("tags"),
        ),
        schemas.PRODUCT,
    )


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("int").alias("productId"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )


def customer_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as registered users; the name carries the user's key in the rating tables."""
    return schemas.conform(
        table(spark, sf_dir, "customer").select(
            java_string_hash(F.col("c_name")).alias("userId"),
            F.col("c_name").alias("username"),
            F.lit(True).alias("first"),
            F.lit(0).alias("timestamp"),
            F.expr("CAST(array() AS array<string>)").alias("prefGenres"),
        ),
        schemas.USER,
    )
