"""Scans, sinks, statistics, rating and user tables, serving."""

import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators import ratings as history
from basketry.operators import serving, statistics, users
from basketry.sources import files, sinks, tables


def ratings_of(spark, data):
    return spark.createDataFrame(data, schemas.RATING)


def write_lines(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_product_file(spark, tmp_path):
    path = write_lines(
        tmp_path / "products.txt",
        [
            '3982^A "quoted" name ^1057,439^B009^ http://x/i.jpg ^cards|toys^ fun|好用 ',
            "notanumber^n^1^2^u^c^t",
            "7^short row",
        ],
    )
    good = rows(files.read_products(spark, path))
    assert good == [(3982, 'A "quoted" name', "http://x/i.jpg", "cards|toys", "fun|好用")]
    typed = files.typed_products(files.delimited(spark, path, schemas.PRODUCT_FILE, "^"))
    assert files.quarantined(typed).count() == 2


def test_rating_file(spark, tmp_path):
    path = write_lines(tmp_path / "ratings.csv", ["4867,457976,5.0,1395676800", "1,2,x,3", "5, 6 ,1,7"])
    assert rows(files.read_ratings(spark, path), "userId") == [
        (5, 6, 1.0, 7),
        (4867, 457976, 5.0, 1395676800),
    ]


def test_lookup_layout_splits_a_hot_user(spark, tmp_path):
    many = spark.range(4000).select(
        F.lit(7).alias("userId"), F.col("id").cast("int").alias("productId"), F.lit(1.0).alias("score"),
        F.col("id").alias("timestamp"),
    )
    path = str(tmp_path / "t")
    sinks.overwrite_for_lookup(many, path, "userId", "productId", files=4)
    back = files.read_table(spark, path, schemas.RATING)
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) == 4 and max(sizes) < 2000
    plan = serving.by_key(back, "userId", 7)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(userId), EqualTo(userId,7)]" in plan


def test_sharded_table_reads_only_the_shards_it_needs(spark, tmp_path):
    many = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("userId"),
        F.col("id").cast("int").alias("productId"), F.lit(1.0).alias("score"), F.col("id").alias("timestamp"),
    )
    path = str(tmp_path / "t")
    sinks.overwrite_sharded(sinks.sharded(many, 16), path, "userId", "productId", files=8)
    back = spark.read.parquet(path)
    assert back.count() == 3000 and back.select("shard").distinct().count() == 16
    hot = back.where("userId = 7").select(F.input_file_name()).distinct().count()
    assert hot > 1
    asked = spark.createDataFrame([(7,), (8,)], "userId int").where("userId > 0")
    found = back.join(sinks.sharded(asked, 16), ["userId", "shard"], "left_semi")
    assert found.count() == many.where("userId in (7, 8)").count()
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()


def test_replace_rows(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "userId int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "userId int, v string")
    once = sinks.replace_rows(old, new, "userId")
    assert rows(once, "userId") == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(sinks.replace_rows(once, new, "userId"), "userId") == rows(once, "userId")


def test_statistics(spark):
    march, april = 1551398400, 1554076800
    r = ratings_of(spark, [(1, 10, 4.0, march), (2, 10, 2.0, april), (1, 20, 5.0, april), (3, 20, 5.0, april), (3, 5, 1.0, april)])
    assert rows(statistics.rate_more(r)) == [(10, 2), (20, 2), (5, 1)]
    assert rows(statistics.rate_more_recently(r)) == [
        (20, 2, 201904), (5, 1, 201904), (10, 1, 201904), (10, 1, 201903),
    ]
    assert rows(statistics.average_score(r)) == [(20, 5.0), (10, 3.0), (5, 1.0)]
    assert rows(statistics.distinct_entities(r), "kind", "id") == [
        ("product", 5), ("product", 10), ("product", 20), ("user", 1), ("user", 2), ("user", 3),
    ]


def test_upsert(spark):
    base = ratings_of(spark, [(1, 10, 4.0, 100), (1, 11, 2.0, 100), (2, 10, 1.0, 50)])
    changes = ratings_of(spark, [(1, 10, 3.0, 200), (1, 10, 5.0, 300), (2, 10, 2.0, 50), (3, 3, 3.0, 1)])
    expected = [(1, 10, 5.0, 300), (1, 11, 2.0, 100), (2, 10, 2.0, 50), (3, 3, 3.0, 1)]
    once = history.upsert(base, changes)
    assert rows(once, "userId", "productId") == expected
    assert rows(history.upsert(once, changes), "userId", "productId") == expected
    kept = history.upsert(base, changes, keep_first_timestamp=True)
    assert rows(kept, "userId", "productId")[0] == (1, 10, 5.0, 100)


def test_upsert_of_milliseconds(spark):
    from basketry.functions import epoch_seconds

    web = ratings_of(spark, [(1, 10, 4.0, 1556436808123)])
    web = web.withColumn("timestamp", epoch_seconds(F.col("timestamp")))
    base = ratings_of(spark, [(1, 10, 1.0, 1556436809)])
    assert rows(history.upsert(web, base)) == [(1, 10, 1.0, 1556436809)]


def test_recent_and_latest(spark):
    data = [(1, p, 1.0 + p % 5, 100 + p // 2) for p in range(50)] + [(2, 9, 3.0, 5)]
    r = ratings_of(spark, data)
    recent = history.recent_ratings(r, 20)
    assert recent.groupBy("userId").count().orderBy("userId").collect()[0]["count"] == 20
    newest = sorted([d for d in data if d[0] == 1], key=lambda d: (d[3], d[1], d[2]), reverse=True)[:20]
    got = rows(recent.where("userId = 1").orderBy("position"))
    assert [g[:4] for g in got] == newest
    first = recent.where("position = 1").select("userId", "productId", "score", "timestamp")
    assert rows(first, "userId") == rows(history.latest_rating(r), "userId")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_split_is_stable(spark):
    r = spark.range(5000).select(
        (F.col("id") % 100).cast("int").alias("userId"), F.col("id").cast("int").alias("productId"),
        F.lit(1.0).alias("score"), F.col("id").alias("timestamp"),
    )
    once = {tuple(x) for x in history.hash_split(r).collect()}
    again = {tuple(x) for x in history.hash_split(r.repartition(7)).collect()}
    assert once == again
    share = sum(x[4] == "train" for x in once) / len(once)
    assert 0.78 < share < 0.82
    assert once != {tuple(x) for x in history.hash_split(r, seed=1).collect()}


def test_register_and_update(spark):
    known = spark.createDataFrame([(99162322, "hello", True, 1, [])], schemas.USER)
    asked = spark.createDataFrame([("hello",), ("new",), ("new",)], "username string")
    new = users.register(known, asked, 5)
    assert rows(new) == [(108960, "new", True, 5, [])]
    changes = spark.createDataFrame([(99162322, False, ["a", "b"])], "userId int, first boolean, prefGenres array<string>")
    updated = users.update_profile(known.unionByName(new), changes)
    assert rows(updated, "username") == [
        (99162322, "hello", False, 1, ["a", "b"]), (108960, "new", True, 5, []),
    ]


def products_of(spark):
    data = [(i, f"name {i}", "u", "c", "t") for i in (1, 2, 3)]
    return spark.createDataFrame(data, schemas.PRODUCT)


def test_serving(spark):
    averages = spark.createDataFrame([(1, 4.5)], "productId int, avg double")
    info = serving.product_info(products_of(spark), averages)
    assert [(r["productId"], r["score"]) for r in info.orderBy("productId").collect()] == [
        (1, 4.5), (2, 0.0), (3, 0.0),
    ]
    assert rows(serving.from_documents(serving.to_documents(info)), "productId") == rows(info, "productId")
    assert serving.by_ids(info, [1, 3, 9]).count() == 2
    assert serving.by_key(info, "productId", 2).first()["name"] == "name 2"
    assert serving.search_by_name(info, "e [13]$").count() == 2
    assert serving.search_by_name(info, "NAME").count() == 0

    monthly = spark.createDataFrame(
        [(1, 5, 201904), (2, 9, 201903), (1, 8, 201903), (3, 1, 201903), (9, 7, 201903)],
        "productId int, count bigint, yearMonth int",
    )
    assert rows(serving.hot_list(monthly, 4), "rank") == [(1, 1, 0.0), (2, 2, 0.0), (4, 9, 0.0)]
    listed = serving.with_products(serving.hot_list(monthly, 4), info)
    assert [(r["rank"], r["productId"]) for r in listed.orderBy("rank").collect()] == [(1, 1), (2, 2)]


def test_recs_for_users(spark):
    averages = spark.createDataFrame([(1, 4.5)], "productId int, avg double")
    info = serving.product_info(products_of(spark), averages)
    recs = spark.createDataFrame([(7, [(3, 0.9), (8, 0.8), (1, 0.7)]), (8, [])], schemas.USER_RECS)
    people = spark.createDataFrame([("a", 7), ("b", 8)], "username string, userId int")
    got = serving.recs_for_users(people.select("username"), people, recs, info, 3)
    assert [(r["username"], r["rank"], r["productId"]) for r in got.orderBy("rank").collect()] == [
        ("a", 1, 3), ("a", 3, 1),
    ]
    assert rows(serving.flatten(recs, "userId", 1, keep_empty=True), "userId") == [
        (7, 1, 3, 0.9), (8, None, None, None),
    ]


def test_order_ratings_read_only_what_they_need(spark, small):
    plan = tables.order_ratings(spark, small).select("productId")._jdf.queryExecution().toString()
    assert "l_extendedprice" not in plan.split("Physical Plan")[1]


def test_shared_dir(spark, monkeypatch):
    from basketry import session

    class Conf(dict):
        set = dict.__setitem__

    class Fake:
        def __init__(self, master, **conf):
            self.conf = Conf(conf)
            self.sparkContext = type("Context", (), {"master": master})

    assert session.shared_dir(Fake("spark://h:1", **{"spark.checkpoint.dir": "/shared"})) == "/shared"
    local = Fake("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)
    with pytest.raises(ValueError):
        session.shared_dir(Fake("spark://h:1"))
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


def test_register_stamps_with_the_current_time(spark):
    known = spark.createDataFrame([], schemas.USER)
    asked = spark.createDataFrame([("new",)], "username string")
    before = time.time() * 1000
    stamp = users.register(known, asked).first()["timestamp"]
    assert before - 1 <= stamp <= time.time() * 1000
