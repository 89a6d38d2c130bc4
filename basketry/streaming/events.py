"""Rating events as streams: log filtering, parsing, per-user state, incremental rescoring."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from basketry.functions import after_marker, has_marker, parse_rating_fields
from basketry.operators.realtime import stream_recs
from basketry.operators.similarity import Similarity
from basketry.sources.files import parse_messages
from basketry.sources.sinks import replace_rows

# History kept per user, message key, micro-batch interval.
CAPACITY = 40
MESSAGE_KEY = "logProcessor"
INTERVAL = "2 seconds"

FILES_PER_BATCH = 1000

HISTORY = "userId int, productId int, score double, timestamp bigint"
STATE = "products array<int>, scores array<double>, times array<bigint>, version bigint"
RECENT = "userId int, version bigint, products array<int>, scores array<double>, times array<bigint>"


# ----------------------------------------------------------------------------------- sources


def text_lines(
    spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Log lines from text files appended to a folder, as (value); a backlog takes several batches."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def kafka_lines(spark: SparkSession, servers: str, topic: str, rows_per_batch: int) -> DataFrame:
    """Messages of a topic as (value); needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("maxOffsetsPerTrigger", rows_per_batch)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


# --------------------------------------------------------------------- stateless, batch or stream


def rating_messages(lines: DataFrame) -> DataFrame:
    """The text after the marker of every marked line that has any, as (value)."""
    return (
        lines.where(has_marker(F.col("value")))
        .select(after_marker(F.col("value")).alias("value"))
        .where("value <> ''")
    )


def parsed_ratings(messages: DataFrame) -> DataFrame:
    """Typed ratings of the messages that have four usable fields."""
    return parse_messages(messages).dropna("any")


def unparsed_messages(lines: DataFrame) -> DataFrame:
    """Marked lines that give no rating, for quarantine."""
    fields = parse_rating_fields(after_marker(F.col("value")))
    usable = reduce(and_, [f.isNotNull() for f in fields])
    return lines.where(has_marker(F.col("value")) & ~usable)


def keyed_messages(messages: DataFrame) -> DataFrame:
    """(key, value) rows for a message topic."""
    return messages.select(F.lit(MESSAGE_KEY).alias("key"), "value")


def with_event_time(ratings: DataFrame) -> DataFrame:
    return ratings.withColumn("eventTime", F.timestamp_seconds("timestamp"))


def counts_by_time(ratings: DataFrame, width: str = "1 day", delay: str = "2 hours") -> DataFrame:
    """(windowStart, ratings, scores) of every span of event time that the watermark has closed.

    The clock is the newest rating's time less ``delay``; ratings behind it are too late and drop out.
    """
    timed = with_event_time(ratings).withWatermark("eventTime", delay)
    spans = timed.groupBy(F.window("eventTime", width)).agg(
        F.count("*").alias("ratings"), F.sum("score").alias("scores")
    )
    return spans.select(F.col("window.start").alias("windowStart"), "ratings", "scores")


# Products with one in so many ratings or more are hot, so there are at most so many of them.
HOT_SHARE = 1000


def hot_products(ratings: DataFrame, tasks: int, share: int = HOT_SHARE) -> DataFrame:
    """(productId, salts) of products with at least one in ``share`` of the ratings taken in so far.

    ``salts`` is how many of ``tasks`` equal tasks the product's ratings would fill.
    """
    counts = ratings.groupBy("productId").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    salts = F.ceil(F.col("n") * tasks / total).cast("int")
    return counts.where(F.col("n") * share >= total).select("productId", salts.alias("salts"))


def join_recs(ratings: DataFrame, recs: DataFrame, salts: int = 4, hot: DataFrame | None = None) -> DataFrame:
    """Each rating event with the stored list of its product; no list gives an empty one.

    Streams are not re-planned at run time, so events of a hot product are spread over partitions,
    each of which gets the list: over as many as ``hot`` (see :func:`hot_products`) says, which is broadcast as it has
    ``HOT_SHARE`` rows at most, others over one; without ``hot`` every product over ``salts``.
    """
    empty = F.array().cast(recs.schema["recs"].dataType)
    spread = F.lit(salts)
    if hot is not None:
        hot = F.broadcast(hot)
        ratings, recs = (df.join(hot, "productId", "left") for df in (ratings, recs))
        spread = F.coalesce("salts", F.lit(1))
    salted = ratings.withColumn("salt", F.pmod(F.xxhash64("userId", "timestamp"), spread).cast("int"))
    copies = recs.withColumn("salt", F.explode(F.sequence(F.lit(0), spread - 1)))
    joined = salted.drop("salts").join(copies.drop("salts"), ["productId", "salt"], "left").drop("salt")
    return joined.withColumn("recs", F.coalesce("recs", empty))


# ------------------------------------------------------------------------------------- sinks


def append_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    continuous: bool = False,
    name: str | None = None,
    partition_by: Iterable[str] = (),
) -> StreamingQuery:
    """Appends the stream to parquet files, exactly once across restarts.

    Takes what is there and stops, or runs on every two seconds when ``continuous``.
    """
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    trigger = {"processingTime": INTERVAL} if continuous else {"availableNow": True}
    return writer.outputMode("append").trigger(**trigger).start(path)


def publish(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Sends (key, value) rows to a topic every two seconds; needs the Kafka connector."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=INTERVAL)
        .start()
    )


# ------------------------------------------------------------------------------ per-user state


def _newest(rows: Iterable[tuple], capacity: int) -> list[tuple]:
    """The newest (timestamp, productId, score), newest first; ties by product, then score."""
    return heapq.nlargest(capacity, rows)


def recent_state(ratings: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The newest ratings of every user a micro-batch touches, one row with a version each.

    The state holds ``capacity`` ratings per user. Each Arrow batch of a task is first cut to the newest
    ratings per user, so a very active user sends a few rows per batch to the state and not all.
    """

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ordered = frame.sort_values(["timestamp", "productId", "score"], ascending=False, kind="stable")
            yield ordered.groupby("userId", sort=False).head(capacity)

    def advance(
        key: tuple[int], frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        products, scores, times, version = state.get if state.exists else ([], [], [], 0)
        kept = list(zip(times, products, scores))
        for frame in frames:
            arrived = zip(frame["timestamp"].tolist(), frame["productId"].tolist(), frame["score"].tolist())
            kept = _newest((*kept, *arrived), capacity)
        times, products, scores = ([r[i] for r in kept] for i in range(3))
        state.update((products, scores, times, version + 1))
        yield pd.DataFrame(
            {"userId": [key[0]], "version": [version + 1], "products": [products], "scores": [scores], "times": [times]}
        )

    fields = ratings.select("userId", "productId", "score", "timestamp")
    return (
        fields.mapInPandas(cut, HISTORY)
        .groupBy("userId")
        .applyInPandasWithState(advance, RECENT, STATE, "append", GroupStateTimeout.NoTimeout)
    )


def current_state(versions: DataFrame) -> DataFrame:
    """(userId, position, productId, score, timestamp) of each user's last version, in one aggregate."""
    entries = F.arrays_zip(F.col("products").alias("p"), F.col("scores").alias("s"), F.col("times").alias("t"))
    last = versions.groupBy("userId").agg(F.max_by(entries, "version").alias("entries"))
    rows = last.select("userId", F.posexplode("entries").alias("at", "e"))
    return rows.select(
        "userId", (F.col("at") + 1).alias("position"), F.col("e.p").alias("productId"),
        F.col("e.s").alias("score"), F.col("e.t").alias("timestamp"),
    )


def compacted(versions: DataFrame) -> DataFrame:
    """The last version of each user alone, to replace a table that has grown."""
    fields = [F.max_by(c, "version").alias(c) for c in ("products", "scores", "times")]
    return versions.groupBy("userId").agg(F.max("version").alias("version"), *fields)


# ------------------------------------------------------------------------ incremental rescoring


def stamped(ratings: DataFrame, arrival: int) -> DataFrame:
    """Adds ``arrival``, the number of the run that takes the ratings in, to ask for what is new.

    No clock is involved: a run that is repeated after a failure gives the rest the same number.
    """
    return ratings.withColumn("arrival", F.lit(arrival))


def rescore(
    ratings: DataFrame, similarity: Similarity, snapshot: DataFrame, new: DataFrame, **options
) -> DataFrame:
    """The snapshot (userId, recs) with the lists of all users in ``new`` computed afresh.

    ``ratings`` is the whole rating table including ``new``. Doing it again changes nothing, so a
    replayed batch is harmless. If both carry ``shard``, the column the table is partitioned by, only
    the shards of touched users are read.
    """
    both = set(ratings.columns) & set(new.columns)
    keys = ["userId", *(["shard"] if "shard" in both else [])]
    touched = new.select(*keys).distinct()
    history = ratings.join(touched, keys, "left_semi").drop("shard")
    lists = stream_recs(history, similarity, events=new, **options)
    return replace_rows(snapshot, lists, "userId")
