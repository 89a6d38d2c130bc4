"""From files and a log to every result table."""

import random

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from basketry import jobs, schemas
from basketry.functions import LOG_MARKER
from basketry.operators import ratings as history
from basketry.operators import realtime, serving, statistics
from basketry.session import scratch, stored


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    generator = random.Random(6)
    products = [
        f"{p}^product {p}^1,2^A{p}^http://i/{p}^c{p % 3}|d^{'|'.join(generator.sample('abcdefgh', 3))}"
        for p in range(30)
    ]
    scored = [
        f"{u},{p},{generator.randrange(1, 11) / 2},{1_550_000_000 + generator.randrange(5_000_000)}"
        for u in range(25)
        for p in generator.sample(range(30), 12)
    ]
    (root / "products.txt").write_text("\n".join([*products, "broken^line"]) + "\n")
    (root / "ratings.csv").write_text("\n".join([*scored, "1,2,three,4"]) + "\n")
    path = str(root / "tables")
    jobs.load(spark, path, str(root / "products.txt"), str(root / "ratings.csv"), shards=4)
    jobs.count_ratings(spark, path)
    jobs.factorize(spark, path, rank=4, iterations=3, reg_param=0.1, n=5)
    jobs.relate_products(spark, path, n=5)
    return path


def test_loaded(spark, base):
    assert jobs.table(spark, base, jobs.PRODUCT).count() == 30
    assert jobs.table(spark, base, jobs.RATING).count() == 300
    assert jobs.table(spark, base, jobs.REJECTED + jobs.PRODUCT).count() == 1
    assert jobs.table(spark, base, jobs.REJECTED + jobs.RATING).count() == 1


def test_statistics_and_serving(spark, base):
    counts = jobs.table(spark, base, jobs.RATE_MORE)
    monthly = jobs.table(spark, base, jobs.RATE_MORE_RECENTLY)
    for t in (counts, monthly):
        assert t.agg(F.sum("count")).first()[0] == 300
    info = serving.product_info(
        jobs.table(spark, base, jobs.PRODUCT), jobs.table(spark, base, jobs.AVERAGE)
    )
    shown = serving.with_products(serving.hot_list(monthly, 5), info)
    assert 0 < shown.count() <= 5


@pytest.mark.parametrize("name", [jobs.PRODUCT_RECS, jobs.ITEM_CF_RECS, jobs.CONTENT_RECS])
def test_product_lists(spark, base, name):
    recs = jobs.table(spark, base, name)
    assert [f.name for f in recs.schema] == [f.name for f in schemas.PRODUCT_RECS]
    flat = serving.flatten(recs, "productId").toDF("id", "rank", "otherId", "score")
    assert flat.count() > 0
    assert flat.where("score <= 0.4 OR id = otherId OR rank > 5").count() == 0


def test_user_lists(spark, base):
    recs = jobs.table(spark, base, jobs.USER_RECS)
    assert recs.count() == 25 and recs.where("size(recs) > 5").count() == 0


def test_tune(spark, base):
    best = jobs.tune(spark, base, ranks=(2,), reg_params=(1.0, 0.1), iterations=2).collect()
    assert len(best) == 1 and best[0]["rank"] == 2


def test_following_the_log(spark, base, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    generator, clock = random.Random(1), 1_600_000_000
    loaded = jobs.table(spark, base, jobs.RATING).collect()
    logged = []
    for part in range(3):
        lines = []
        for _ in range(8):
            clock += 1
            logged.append((generator.randrange(12), generator.randrange(30), 4.5, clock))
            lines.append(f"x {LOG_MARKER}{'|'.join(map(str, logged[-1]))}")
        (log / f"{part}.txt").write_text("\n".join([*lines, f"x {LOG_MARKER}1|2|x|y"]) + "\n")
        if part == 1:  # a call that failed after it had read the log
            jobs.arrive(spark, base, str(log), 3)
        jobs.follow_log(spark, base, str(log))
    jobs.follow_log(spark, base, str(log))
    assert jobs.rating_table(spark, base).version() == 4
    merged = history.upsert(spark.createDataFrame(loaded), spark.createDataFrame(logged, schemas.RATING))
    assert rows(jobs.table(spark, base, jobs.RATING), "userId", "productId") == rows(merged, "userId", "productId")
    jobs.count_ratings(spark, base)
    assert rows(jobs.table(spark, base, jobs.RATE_MORE), "productId") == rows(statistics.rate_more(merged), "productId")
    newest = spark.createDataFrame(logged, schemas.RATING)
    every = spark.createDataFrame(loaded).unionByName(newest)
    own = jobs.table(spark, base, jobs.RECENT).collect()
    assert {r.userId: r.recents for r in own} == {r.userId: r.recents for r in history.to_recent_lists(every, 40).collect()}
    whole = realtime.stream_recs(every, jobs.product_similarity(spark, base), events=newest)
    kept = jobs.table(spark, base, jobs.STREAM_RECS)

    def lists(df):
        return [(u, [(x["productId"], round(x["score"], 6)) for x in r]) for u, r in rows(df, "userId")]

    # The lists of the last batch a user was in are those of all ratings up to then; later ones leave them.
    last = {u: t for u, _, _, t in logged}
    assert {u for u, _ in lists(kept)} == set(last)
    in_last_batch = {u for u, t in last.items() if t > clock - 8}
    of_last = [{u: x for u, x in lists(t) if u in in_last_batch} for t in (kept, whole)]
    assert of_last[0] == of_last[1]


def test_a_batch_that_comes_again_changes_nothing(spark, base):
    new = spark.createDataFrame([(3, 5, 1.5, 1_700_000_000), (24, 5, 2.0, 1_700_000_001)], schemas.RATING)
    version = jobs.rating_table(spark, base).version() + 1
    found = []
    for _ in range(2):
        jobs.take_ratings(spark, base, new, version)
        found.append([sorted(map(str, jobs.table(spark, base, t).collect())) for t in jobs.KEYED])
    assert found[0] == found[1]


def test_stored_tables_go_with_their_job(spark):
    with scratch(spark):
        inner = stored(spark.range(5), "inner")
        assert inner.count() == 5
        path = inner.inputFiles()[0]
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)
    assert stored(spark.range(5), "outer").count() == 5
