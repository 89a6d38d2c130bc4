"""Keyed tables against a dictionary, and what batches read and write."""

import os
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators import realtime, similarity
from basketry.operators.running import running_total
from basketry.session import gathered
from basketry.sources import keyed
from basketry.sources.keyed import KeyedTable


def ratings(spark, some):
    return spark.createDataFrame(some, schemas.RATING)


def table(spark, path):
    return KeyedTable(spark, str(path), schemas.RATING, ["userId", "productId"], ("timestamp",))


def files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


@pytest.mark.parametrize("named", [1000, 1])
def test_against_a_dictionary(spark, tmp_path, monkeypatch, named):
    monkeypatch.setattr(keyed, "NAMED_KEYS", named)
    draw = random.Random(8)
    one = table(spark, tmp_path / "t")
    start = [(u, p, 1.0, 100) for u in range(20) for p in range(3)] + [(0, 0, 2.0, 90), (19, 9, 2.0, 90), (19, 9, 2.0, 90)]
    one.load(ratings(spark, start), 4)
    want = {}
    for r in start:
        want.setdefault(r[:2], []).append(r[2:])
    for version in range(2, 6):
        new = [(draw.randrange(22), draw.randrange(4), draw.randrange(10) / 2, draw.randrange(80, 130)) for _ in range(6)]
        new.append((new[0][0], new[0][1], 0.5, new[0][3]))
        one.append(ratings(spark, new), version)
        for u, p in {r[:2] for r in new}:
            own = [(t, 0, s) for s, t in want.get((u, p), [])] + [(t, 1, s) for x, y, s, t in new if (x, y) == (u, p)]
            t, _, s = max(own)
            want[u, p] = [(s, t)]
        if version == 4:
            assert one.compact(most=1) > 0
            assert one.compact(most=1) == 0
        flat = sorted((*k, *v) for k, own in want.items() for v in own)
        assert sorted(rows(one.read())) == flat
        asked = spark.createDataFrame([(0,), (5,), (19,), (77,)], "userId int")
        assert sorted(rows(one.lookup(asked))) == [r for r in flat if r[0] in (0, 5, 19)]
        before = sorted(rows(one.read()))
        one.append(ratings(spark, [(1, 1, 5.0, 999)]), version)
        assert sorted(rows(one.read())) == before
    assert one.version() == 5


def test_empty_tables_and_batches(spark, tmp_path):
    one = table(spark, tmp_path / "t")
    assert one.version() == 0 and rows(one.read()) == []
    one.append(ratings(spark, []), 1, shards=3)
    assert one.version() == 1 and rows(one.read()) == []
    one.append(ratings(spark, [(1, 1, 1.0, 1), (1, 1, 2.0, 1)]), 2)
    assert rows(one.read()) == [(1, 1, 2.0, 1)]
    assert one.compact() == 0


def test_lists_are_replaced(spark, tmp_path):
    one = KeyedTable(spark, str(tmp_path / "t"), schemas.USER_RECS, ["userId"])
    for version, lists in enumerate(([(1, [(2, 0.5)]), (2, [])], [(1, [])], [(3, [(1, 1.0), (2, 0.5)])]), 1):
        one.append(spark.createDataFrame(lists, schemas.USER_RECS), version, shards=2)
    found = {r.userId: [tuple(x) for x in r.recs] for r in one.read().collect()}
    assert found == {1: [], 2: [], 3: [(1, 1.0), (2, 0.5)]}


def test_files_are_bounded(spark, tmp_path):
    one = table(spark, tmp_path / "t")
    one.append(ratings(spark, []), 1, shards=2)
    counts = []
    for version in range(2, 26):
        one.append(ratings(spark, [(version % 5, version, 1.0, version)]), version)
        one.compact(most=3)
        counts.append(len(files(tmp_path / "t")))
    assert rows(one.read(), "productId") == [(v % 5, v, 1.0, v) for v in range(2, 26)]
    assert max(counts) <= 2 * (3 + 1) * 3
    assert len(os.listdir(tmp_path / "t" / "live")) <= 2 * 3  # with their checksums


def test_a_batch_reads_and_writes_what_it_touches(spark, tmp_path):
    """The same batch against a table and one of ten times its rows and shards."""
    new = ratings(spark, [(u, 999, 4.0, 10**9) for u in range(4)])
    found = []
    for size in (1, 10):
        one = table(spark, tmp_path / f"t{size}")
        every = spark.range(40_000 * size).select(
            (F.col("id") % (1000 * size)).cast("int").alias("userId"), (F.col("id") / (1000 * size)).cast("int").alias("productId"),
            F.rand(1).alias("score"), F.col("id").alias("timestamp"),
        )
        one.load(every, 8 * size)
        one.append(new, 2)
        written = sum(os.path.getsize(f) for f in files(tmp_path / f"t{size}" / "data" / "version=2"))
        read = sum(os.path.getsize(f.removeprefix("file://")) for f in one.lookup(new).inputFiles())
        assert one.lookup(new).count() == 4 * 41
        found.append((written, read, sum(os.path.getsize(f) for f in files(tmp_path / f"t{size}"))))
    (written, read, whole), (written_10, read_10, whole_10) = found
    assert whole_10 > 5 * whole
    assert written_10 < 1.5 * written and read_10 < 1.7 * read


def test_running_total(spark):
    draw = random.Random(3)
    some = [(draw.choice([1, 1, 1, 2, None]), i, draw.randrange(5)) for i in range(3000)]
    given = spark.createDataFrame(some, "k int, o int, v int").repartition(6)
    got = {r.o: r.t for r in running_total(given.where("k IS NOT NULL"), "k", [F.desc("o")], F.col("v"), "t").collect()}
    for k in (1, 2):
        total = 0
        for _, o, v in sorted((r for r in some if r[0] == k), key=lambda r: -r[1]):
            assert got[o] == total
            total += v


def test_index_gives_the_same_lists(spark, tmp_path):
    """Users with many ratings, classes of copies, ties, unknown products."""
    draw = random.Random(9)
    sims = {}
    for _ in range(500):
        a, b = draw.sample(range(0, 60, 3), 2)
        sims[min(a, b), max(a, b)] = draw.choice([0.41, 0.5, 0.5, 0.7])
    pairs = [(a, b, s) for (a, b), s in sims.items()] + [(b, a, s) for (a, b), s in sims.items()]
    members = [(i, i - i % 3 if i < 30 else i) for i in range(60) if i < 30 or i % 3 == 0]
    pairs += [(r, r, 1.0) for r in range(0, 30, 3)]
    whole = similarity.Similarity(
        spark.createDataFrame(pairs, "item int, other int, sim double"), spark.createDataFrame(members, "item int, rep int")
    )
    rated = [(u, p, draw.randrange(1, 11) / 2, draw.randrange(1000)) for u in range(30) for p in draw.sample(range(70), 3 + u)]
    given = ratings(spark, rated)
    similarity.write_index(whole, str(tmp_path / "index"), 4)
    index = similarity.read_index(spark, str(tmp_path / "index"), 4)
    events = realtime.latest_rating(given)
    for n in (1, 5, 20):
        want = rows(realtime.candidate_products(events, given, whole, n), "userId", "rank")
        assert rows(realtime.indexed_candidates(events, given, index, n), "userId", "rank") == want

    def lists(df):
        return {u: [(x["productId"], round(x["score"], 6)) for x in r] for u, r in rows(df)}

    assert lists(realtime.indexed_recs(given, index, given)) == lists(realtime.stream_recs(given, whole))


def test_lists_are_not_read_beyond_need(spark, tmp_path):
    """A product similar to all others: its list is cut before anything is sorted."""
    n = 5000
    pairs = spark.range(1, n).selectExpr("0 AS item", "cast(id AS int) AS other", "1 - id / 20000 AS sim")
    whole = similarity.Similarity(pairs, spark.range(n).selectExpr("cast(id AS int) AS item", "cast(id AS int) AS rep"))
    similarity.write_index(whole, str(tmp_path / "index"), 2)
    index = similarity.read_index(spark, str(tmp_path / "index"), 2)
    given = ratings(spark, [(1, 0, 5.0, 9), (1, 1, 5.0, 8), (1, 2, 5.0, 7)])
    found = realtime.indexed_candidates(given.where("productId = 0"), given, index, 20)
    assert [r[2] for r in rows(found, "rank")] == list(range(3, 23))
    read = index.lists_of(spark.createDataFrame([(0,)], "item int")).where("rank <= 24")
    assert len({re.search(r"shard=\d+", f)[0] for f in read.inputFiles()}) == 1
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(rank,24)" in plan and "In(item" in plan.replace("EqualTo(item", "In(item")


def scanned(df):
    """Rows that the file scans of an executed query gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().get("numOutputRows").get().value()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_second_key_skips_files(spark, tmp_path):
    """Products lie across all users' files; without a dictionary only the filters can tell which files hold one."""
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    settings.set("parquet.enable.dictionary", "false")
    try:
        many = spark.range(32_000).selectExpr(
            "CAST(id AS INT) userId", "CAST(abs(hash(id)) % 1000003 AS INT) productId", "1D score", "id timestamp"
        )
        asked = many.where("userId = 77").select("productId")
        read = {}
        for also in ((), ("productId",)):
            one = KeyedTable(spark, str(tmp_path / f"t{len(also)}"), schemas.RATING, ["userId", "productId"], ("timestamp",), also)
            one.load(many, 16)
            found = one.lookup_other(asked, "productId")
            read[len(also)] = scanned(found)
            assert rows(found, "userId") == rows(many.join(asked, "productId", "left_semi").select(*found.columns), "userId")
        assert read[0] > 16_000 and read[1] <= 4 * 2_500
        one.append(ratings(spark, [(77, asked.first()[0], 9.0, 10**6)]), 2)
        assert [r.score for r in one.lookup_other(asked, "productId").where("userId = 77").collect()] == [9.0]
    finally:
        settings.unset("parquet.enable.dictionary")


def test_second_key_with_many_values(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "NAMED_KEYS", 1)
    one = table(spark, tmp_path / "t")
    one.load(ratings(spark, [(1, 2, 1.0, 1), (2, 3, 1.0, 1), (3, 4, 1.0, 1)]), 2)
    asked = spark.createDataFrame([(2,), (3,), (9,), (None,)], "productId int")
    assert [r.userId for r in rows_of(one.lookup_other(asked, "productId"))] == [1, 2]
    with pytest.raises(ValueError):
        one.lookup_other(asked.withColumnRenamed("productId", "score"), "score")


def rows_of(df):
    return sorted(df.collect())


def test_a_large_batch_spreads_over_files(spark, tmp_path, monkeypatch):
    """More rows than go through the driver are dealt by ranges of the key, not one task a shard."""
    monkeypatch.setattr(keyed, "LOCAL_ROWS", 10)
    one = table(spark, tmp_path / "t")
    one.load(spark.createDataFrame([], schemas.RATING), 1)
    new = spark.range(5000).selectExpr("CAST(id AS INT) userId", "CAST(id % 7 AS INT) productId", "1D score", "id timestamp")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        one.append(new, 2)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(one.changes(2).inputFiles()) > 1
    assert rows(one.read(), "userId") == rows(new, "userId")


def test_steps_of_a_large_batch_are_worked_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(100).mapInArrow(counted, "id bigint")
    large, small = gathered(spark.range(100), "large", rows=5), gathered(spark.range(5), "small", rows=5)
    assert small.isLocal() and not large.isLocal()
    assert gathered(df, "step", rows=5, source=large).count() == 100
    assert seen.value == 100
    assert gathered(spark.range(3), "step", rows=5, source=small).isLocal()
