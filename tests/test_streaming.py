import random
import time
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions import LOG_MARKER
from basketry.operators import realtime, similarity
from basketry.streaming import events as stream


class Source:
    """A folder that receives log files one after another."""

    def __init__(self, root):
        self.path = root / "log"
        self.path.mkdir()
        self.files = 0

    def add(self, lines):
        target = self.path / f"{self.files:04}.txt"
        target.write_text("\n".join(lines) + "\n")
        self.files += 1
        time.sleep(0.02)


def marked(rating):
    return f"INFO x : {LOG_MARKER}" + "|".join(str(f) for f in rating)


def run(df, root, name):
    query = stream.append_files(df, str(root / name), str(root / f"{name}-checkpoint"), name=name)
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(str(root / name))


def ratings_of(spark, source, **options):
    return stream.parsed_ratings(stream.rating_messages(stream.text_lines(spark, str(source.path), **options)))


def test_filter_and_parse(spark, tmp_path):
    source = Source(tmp_path)
    source.add(["noise", marked((1, 2, 3.0, 4)), LOG_MARKER, marked((1, 2))])
    messages = stream.keyed_messages(stream.rating_messages(stream.text_lines(spark, str(source.path))))
    assert rows(run(messages, tmp_path, "messages"), "value") == [
        ("logProcessor", "1|2"), ("logProcessor", "1|2|3.0|4"),
    ]
    parsed = stream.with_event_time(ratings_of(spark, source))
    got = run(parsed, tmp_path, "parsed").select("userId", "productId", "score", "timestamp", F.unix_timestamp("eventTime"))
    assert rows(got) == [(1, 2, 3.0, 4, 4)]


def test_restart_takes_only_new_files(spark, tmp_path):
    source = Source(tmp_path)
    source.add([marked((1, 2, 3.0, 4))])
    run(ratings_of(spark, source), tmp_path, "out")
    source.add([marked((1, 3, 3.0, 5))])
    assert rows(run(ratings_of(spark, source), tmp_path, "out"), "productId") == [
        (1, 2, 3.0, 4), (1, 3, 3.0, 5),
    ]
    assert run(ratings_of(spark, source), tmp_path, "out").count() == 2


def test_continuous_run(spark, tmp_path):
    source = Source(tmp_path)
    source.add([marked((1, 2, 3.0, 4))])
    ratings = ratings_of(spark, source)
    query = stream.append_files(ratings, str(tmp_path / "out"), str(tmp_path / "progress"), continuous=True)
    try:
        query.processAllAvailable()
        source.add([marked((1, 3, 3.0, 5))])
        query.processAllAvailable()
    finally:
        query.stop()
    out = spark.read.schema(ratings.schema).parquet(str(tmp_path / "out"))
    assert rows(out, "productId") == [(1, 2, 3.0, 4), (1, 3, 3.0, 5)]


def test_join_with_stored_lists(spark, tmp_path):
    source = Source(tmp_path)
    source.add([marked((1, 2, 3.0, 4)), marked((1, 99, 3.0, 5))])
    recs = spark.createDataFrame([(2, [(7, 0.9), (8, 0.5)])], schemas.PRODUCT_RECS)
    joined = run(stream.join_recs(ratings_of(spark, source), recs), tmp_path, "joined")
    got = {r["productId"]: [tuple(x) for x in r["recs"]] for r in joined.collect()}
    assert got == {2: [(7, 0.9), (8, 0.5)], 99: []}
    hot = spark.range(1000).selectExpr("CAST(id AS INT) userId", "2 productId", "1D score", "id timestamp")
    assert stream.join_recs(hot, recs).where("size(recs) = 2").count() == 1000


@pytest.mark.parametrize("capacity", [40, 3])
def test_recent_state_is_bounded(spark, tmp_path, capacity):
    source, every = Source(tmp_path), defaultdict(list)
    generator = random.Random(capacity)
    clock = 0
    for _ in range(3):
        lines = []
        for _ in range(60):
            clock += 1
            rating = (generator.choice([1, 1, 1, 2, 3]), generator.randrange(5), 2.5, clock)
            every[rating[0]].append(rating)
            lines.append(marked(rating))
        generator.shuffle(lines)
        source.add(lines)
    state = stream.recent_state(ratings_of(spark, source, files_per_batch=1), capacity)
    versions = run(state, tmp_path, "state")
    assert versions.select(F.max("version")).first()[0] == 3
    got = defaultdict(list)
    for r in stream.current_state(versions).orderBy("userId", "position").collect():
        got[r["userId"]].append((r["userId"], r["productId"], r["score"], r["timestamp"]))
    assert got == {u: sorted(v, key=lambda r: -r[3])[:capacity] for u, v in every.items()}
    compact = stream.compacted(versions)
    assert compact.count() == len(every)
    assert sorted(stream.current_state(compact).collect()) == sorted(stream.current_state(versions).collect())


def recs_of(df):
    return {r["userId"]: [(x["productId"], round(x["score"], 9)) for x in r["recs"]] for r in df.collect()}


def test_incremental_lists_equal_the_batch(spark, tmp_path):
    generator = random.Random(8)
    source = Source(tmp_path)
    pairs = [(a, b, round(0.4 + 0.6 * generator.random(), 3)) for a in range(30) for b in range(30) if a != b and generator.random() < 0.5]
    sims = similarity.from_pairs(spark.createDataFrame(pairs, "productId int, otherId int, sim double"))
    snapshot, clock = spark.createDataFrame([], schemas.USER_RECS), 0
    for batch in range(3):
        lines = []
        for _ in range(30):
            clock += 1
            user = generator.choice([1, 2] if batch == 1 else range(8))
            lines.append(marked((user, generator.randrange(40), generator.randrange(1, 11) / 2, clock)))
        source.add(lines)
        table = run(stream.stamped(ratings_of(spark, source), batch), tmp_path, "ratings")
        new = table.where(F.col("arrival") == batch)
        assert new.count() == 30
        ratings = table.drop("arrival")
        once = stream.rescore(ratings, sims, snapshot, new.drop("arrival"))
        path = str(tmp_path / f"snapshot-{batch}")
        once.write.parquet(path)
        snapshot = spark.read.parquet(path)
        again = stream.rescore(ratings, sims, snapshot, new.drop("arrival"))
        assert recs_of(again) == recs_of(snapshot)
    assert recs_of(snapshot) == recs_of(realtime.stream_recs(ratings, sims))
    assert len(recs_of(snapshot)) == 8


def test_kafka_source_needs_its_connector(spark):
    try:
        lines = stream.kafka_lines(spark, "localhost:9092", "log", 1000)
    except Exception as error:
        assert "kafka" in str(error).lower()
    else:
        assert lines.isStreaming and lines.columns == ["value"]


def test_salts_follow_the_measured_share(spark):
    """Half of all events on one product: its events spread over tasks, and cold products are not copied."""
    known = spark.range(4000).selectExpr(
        "CAST(id AS INT) userId", "CAST(if(id % 2 = 0, 4000, id) AS INT) productId", "1D score", "id timestamp"
    )
    hot = stream.hot_products(known, 8, share=100)
    assert [tuple(r) for r in hot.collect()] == [(4000, 4)]
    recs = spark.createDataFrame([(p, [(p + 1, 0.5)]) for p in range(0, 4001)], schemas.PRODUCT_RECS)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:  # streams are not re-planned
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        largest = {}
        for name, salts in (("none", hot.where("false")), ("measured", hot)):
            joined = stream.join_recs(known, recs, hot=salts)
            assert joined.where("size(recs) = 1 AND recs[0].productId = productId + 1").count() == 4000
            held = joined.where("productId = 4000").groupBy(F.spark_partition_id().alias("p")).count()
            largest[name] = max(r["count"] for r in held.collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert largest["none"] == 2000 and largest["measured"] <= 1100


def test_measured_salts_in_a_stream(spark, tmp_path):
    source = Source(tmp_path)
    source.add([marked((1, 2, 3.0, 4)), marked((1, 99, 3.0, 5))])
    recs = spark.createDataFrame([(2, [(7, 0.9), (8, 0.5)])], schemas.PRODUCT_RECS)
    hot = spark.createDataFrame([(2, 3), (5, 2)], "productId int, salts int")
    joined = run(stream.join_recs(ratings_of(spark, source), recs, hot=hot), tmp_path, "joined")
    assert joined.columns == stream.join_recs(ratings_of(spark, source), recs).columns
    assert {r["productId"]: len(r["recs"]) for r in joined.collect()} == {2: 2, 99: 0}
