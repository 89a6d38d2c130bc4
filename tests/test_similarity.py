"""Similarities against brute force, with hot users, hot tags, copies and many small blocks."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators import similarity
from basketry.operators.similarity import common, raters, tags, vectors


def expand(similar):
    """All pairs of items, as a dict, from representatives and members."""
    members = defaultdict(list)
    for item, rep in rows(similar.members):
        members[rep].append(item)
    found = {}
    for a, b, sim in rows(similar.pairs):
        for x in members[a]:
            for y in members[b]:
                if x != y:
                    assert (x, y) not in found
                    found[x, y] = sim
    return found


def same(found, expected):
    assert found.keys() == expected.keys()
    assert all(abs(found[k] - v) < 1e-8 for k, v in expected.items())


def cosine_of_sets(groups, threshold):
    expected = {}
    for a, x in groups.items():
        for b, y in groups.items():
            sim = round(len(x & y) / math.sqrt(len(x) * len(y)), 9)
            if a != b and sim > threshold:
                expected[a, b] = sim
    return expected


def skewed_raters(seed=3):
    """User 0 rated everything, product 0 is rated by everyone, products 100-139 only by user 0."""
    generator = random.Random(seed)
    data = {(0, p) for p in range(140)} | {(u, 0) for u in range(60)}
    for u in range(1, 60):
        for _ in range(generator.randrange(1, 25)):
            data.add((u, min(int(generator.expovariate(0.05)), 99)))
    return data


@pytest.mark.parametrize("block_items, lanes, chunk_rows", [(1024, 64, 50_000), (9, 64, 50_000), (5, 3, 7)])
@pytest.mark.parametrize("threshold", [0.4, 0.1])
def test_raters(spark, monkeypatch, block_items, lanes, chunk_rows, threshold):
    monkeypatch.setattr(raters, "BLOCK_ITEMS", block_items)
    monkeypatch.setattr(raters.common_rater_pairs, "__defaults__", (block_items,))
    monkeypatch.setattr(common, "LANE_BLOCKS", lanes)
    monkeypatch.setattr(raters, "LANE_BLOCKS", lanes)
    monkeypatch.setattr(raters, "CHUNK_ROWS", chunk_rows)
    data = skewed_raters()
    repeated = [(u, p, 1.0, t) for u, p in data for t in range(1 + (u + p) % 2)]
    similar = similarity.rater_similarity(spark.createDataFrame(repeated, schemas.RATING), threshold)
    by_product = defaultdict(set)
    for u, p in data:
        by_product[p].add(u)
    same(expand(similar), cosine_of_sets(by_product, threshold))


@pytest.mark.parametrize("hot_user, work", [(7, 16_000_000), (4096, 300), (7, 300)])
def test_raters_of_few_and_of_many_items(spark, monkeypatch, hot_user, work):
    monkeypatch.setattr(raters, "HOT_USER", hot_user)
    monkeypatch.setattr(raters, "BLOCK_WORK", work)
    monkeypatch.setattr(raters, "EXPAND_AT_ONCE", 50)
    monkeypatch.setattr(raters.common_rater_pairs, "__defaults__", (20,))
    data = skewed_raters(9)
    similar = similarity.rater_similarity(spark.createDataFrame([(u, p, 1.0, 0) for u, p in data], schemas.RATING), 0.1)
    by_product = defaultdict(set)
    for u, p in data:
        by_product[p].add(u)
    same(expand(similar), cosine_of_sets(by_product, 0.1))


def test_a_user_sends_a_row_for_each_block_and_not_for_every_two(spark):
    entries = spark.range(40).selectExpr("7L feature", "CAST(id AS INT) item", "5 n", "0 level", "CAST(id AS INT) block")
    strips = raters._strips(entries).collect()
    assert len(strips) == 39 and sum(len(r["items"]) for r in strips) == 40 * 41 // 2 - 1
    met = {(r["items"][0], b) for r in strips for b in r["items"][1:]}
    assert met == {(a, b) for a in range(40) for b in range(a + 1, 40)}


def test_products_of_one_hot_user_make_no_pairs_among_each_other(spark):
    data = [(0, p, 1.0, 0) for p in range(500)]
    similar = similarity.rater_similarity(spark.createDataFrame(data, schemas.RATING))
    assert rows(similar.pairs) == [(0, 0, 1.0)]
    assert similar.members.count() == 500


def tag_products(seed=5):
    """A third of the products carry 'hot', a third are copies of one set."""
    generator = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    sets = {}
    for p in range(150):
        if p % 3 == 0:
            sets[p] = {"w1", "copy", "hot"}
        else:
            sets[p] = set(generator.sample(words, generator.randrange(1, 6))) | ({"hot"} if p % 3 == 1 else set())
    return sets


@pytest.mark.parametrize("block_items, lanes", [(512, 64), (3, 64), (2, 2)])
@pytest.mark.parametrize("threshold", [0.4, 0.15])
def test_tags(spark, monkeypatch, block_items, lanes, threshold):
    monkeypatch.setattr(tags.tag_pairs, "__defaults__", (block_items,))
    monkeypatch.setattr(common, "LANE_BLOCKS", lanes)
    sets = tag_products()
    data = [(p, "n", "u", "c", "|".join(sorted(t, key=hash)) + "||") for p, t in sets.items()]
    data.append((900, "n", "u", "c", ""))
    similar = similarity.tag_similarity(spark.createDataFrame(data, schemas.PRODUCT), threshold)
    n = len(sets) + 1
    df = defaultdict(int)
    for t in sets.values():
        for w in t:
            df[w] += 1
    weight = {w: math.log((n + 1) / (c + 1)) for w, c in df.items()}
    length = {p: math.sqrt(sum(weight[w] ** 2 for w in t)) for p, t in sets.items()}
    expected = {}
    for a, x in sets.items():
        for b, y in sets.items():
            sim = round(sum(weight[w] ** 2 for w in x & y) / (length[a] * length[b]), 9)
            if a != b and sim > threshold:
                expected[a, b] = sim
    same(expand(similar), expected)


def test_very_common_tags_bring_no_items_together(spark):
    data = [(p, "n", "u", "c", f"everywhere|rare{p}|{'even' if p % 2 else 'odd'}") for p in range(300)]
    df = spark.createDataFrame(data, schemas.PRODUCT)
    tagged = similarity.tag_similarity(df)
    assert tagged.pairs.count() == 0
    weighted = tags.weighted_tags(
        df.selectExpr("productId AS rep", "1L AS copies", "split(tags, '[|]') AS tags")
    )
    used = {r["feature"] for r in tags.prefix_entries(weighted, 0.4).collect()}
    assert used == {f"rare{p}" for p in range(300)}


@pytest.mark.parametrize("block_items", [2048, 7])
@pytest.mark.parametrize("threshold", [0.4, -0.2])
def test_vectors(spark, monkeypatch, block_items, threshold):
    monkeypatch.setattr(vectors.vector_pairs, "__defaults__", (None, block_items))
    generator = np.random.default_rng(2)
    data = {i: generator.normal(size=6) for i in range(60)}
    for i in range(60, 90):
        data[i] = data[7]
    data[90] = -data[3]
    data[91] = np.zeros(6)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in data.items()], "productId int, vector array<double>")
    similar = similarity.vector_similarity(df, threshold)
    expected = {}
    for a, x in data.items():
        for b, y in data.items():
            if a != b and a != 91 and b != 91:
                sim = round(float(x @ y / (np.linalg.norm(x) * np.linalg.norm(y))), 9)
                if sim > threshold:
                    expected[a, b] = sim
    same(expand(similar), expected)
    short = similarity.vector_similarity(df, threshold, lists_of=4)
    whole, listed = (similarity.top_similar(s, 4) for s in (similar, short))
    order = ("productId", "rank")
    assert rows(listed, *order) == rows(whole, *order)


def test_negative_thresholds_are_refused(spark):
    with pytest.raises(ValueError):
        similarity.rater_similarity(spark.createDataFrame([], schemas.RATING), -0.1)
    with pytest.raises(ValueError):
        similarity.tag_similarity(spark.createDataFrame([], schemas.PRODUCT), -0.1)


def test_nothing_in_nothing_out(spark):
    no_vectors = spark.createDataFrame([], "productId int, vector array<double>")
    for found in (
        similarity.rater_similarity(spark.createDataFrame([], schemas.RATING)),
        similarity.tag_similarity(spark.createDataFrame([], schemas.PRODUCT)),
        similarity.vector_similarity(no_vectors),
    ):
        assert rows(found.pairs) == rows(found.members) == []


def test_exactly_the_threshold_is_out(spark):
    data = [(u, 1, 1.0, 0) for u in range(5)] + [(u, 2, 1.0, 0) for u in (0, 1, 5, 6, 7)]
    df = spark.createDataFrame(data, schemas.RATING)
    assert similarity.rater_similarity(df, 0.4).pairs.count() == 0
    assert rows(similarity.rater_similarity(df, 0.39).pairs, "item") == [(1, 2, 0.4), (2, 1, 0.4)]


@pytest.mark.parametrize("k", [1, 3, 10, 60])
def test_top_lists(spark, k):
    sets = tag_products()
    data = [(p, "n", "u", "c", "|".join(t)) for p, t in sets.items()]
    similar = similarity.kept(similarity.tag_similarity(spark.createDataFrame(data, schemas.PRODUCT), 0.2))
    expected = defaultdict(list)
    for (a, b), sim in expand(similar).items():
        expected[a].append((-sim, b))
    expected = {a: [b for _, b in sorted(v)[:k]] for a, v in expected.items()}
    top = similarity.top_similar(similar, k)
    got = defaultdict(list)
    for a, rank, b, _ in rows(top, "productId", "rank"):
        got[a].append(b)
        assert rank == len(got[a])
    assert got == expected
    recs = similarity.as_recs(top)
    assert {r["productId"]: [x["productId"] for x in r["recs"]] for r in recs.collect()} == expected
    looked_up = similarity.as_map(recs).where("productId = 0").select(
        similarity.sim_of(F.col("sims"), F.lit(12345))
    )
    assert looked_up.first()[0] == 0.0


@pytest.mark.parametrize("threshold", [0.99, 0.999])
def test_very_many_levels(spark, threshold):
    """As many rater counts as items, at thresholds that set most of them apart."""
    items = spark.range(1, 100_001).select(F.col("id").cast("int").alias("item"), F.col("id").alias("n"))
    placed, blocks = raters._placed(raters._levelled(items, threshold), 64)
    found = placed.groupBy("level").agg(
        F.min("block").alias("first"), F.max("block").alias("last"), F.count("*").alias("n")
    ).orderBy("level").collect()
    assert sum(r.n for r in found) == 100_000
    assert all(a["last"] < b["first"] for a, b in zip(found, found[1:]))
    assert max(r["last"] for r in found) < blocks


def test_high_threshold_against_all_pairs(spark):
    rated = [(u, p) for p in range(1, 41) for u in range(300) if u < 250 + p or (u + p) % 97 == 0]
    ratings = spark.createDataFrame([(u, p, 3.0, 1) for u, p in rated], schemas.RATING)
    raters_of = {p: {u for u, q in rated if q == p} for p in range(1, 41)}
    expected = {
        (a, b)
        for a in raters_of
        for b in raters_of
        if a != b
        and round(len(raters_of[a] & raters_of[b]) / (len(raters_of[a]) * len(raters_of[b])) ** 0.5, 9) > 0.995
    }
    found = similarity.kept(similarity.rater_similarity(ratings, 0.995))
    members = {}
    for r in found.members.collect():
        members.setdefault(r.rep, []).append(r.item)
    got = {
        (x, y) for r in found.pairs.collect() for x in members[r.item] for y in members[r.other] if x != y
    }
    assert got == expected and len(got) > 40


def test_vectors_of_two_lengths_are_refused(spark):
    vectors = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0, 4.0]), (3, [1.0, 0.0, 1.0])], "productId int, vector array<double>")
    with pytest.raises(ValueError, match="no cosine"):
        similarity.vector_similarity(vectors)


def test_whole_lists_and_lookups(spark):
    pairs = [(1, 2, 0.9), (2, 1, 0.9), (1, 5, 0.5), (5, 1, 0.5), (1, 1, 1.0)]
    s = similarity.Similarity(
        spark.createDataFrame(pairs, "item int, other int, sim double"),
        spark.createDataFrame([(1, 1), (3, 1), (2, 2), (5, 5), (7, 7)], "item int, rep int"),
    )
    lists = {}
    for r in similarity.whole_lists(s).orderBy("productId", "rank").collect():
        lists.setdefault(r.productId, []).append((r["rank"], r.otherId, r.sim))
    assert lists == {1: [(1, 1, 1.0), (2, 2, 0.9), (3, 5, 0.5)], 2: [(1, 1, 0.9)], 5: [(1, 1, 0.5)]}
    asked = spark.createDataFrame([(1, 3), (3, 2), (5, 3), (2, 5), (1, 1), (7, 99)], "productId int, otherId int")
    got = {(r.productId, r.otherId): r.sim for r in similarity.sim_between(asked, s).collect()}
    assert got == {(1, 3): 1.0, (3, 2): 0.9, (5, 3): 0.5, (2, 5): 0.0, (1, 1): 0.0, (7, 99): 0.0}


def test_tiles_of_distant_clusters_are_skipped(spark):
    generator = np.random.default_rng(11)
    centres = generator.normal(size=(12, 8))
    points = np.concatenate([c + 0.05 * generator.normal(size=(60, 8)) for c in centres]) * generator.uniform(0.1, 9, (720, 1))
    made = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "item int, vector array<double>")
    units = points / np.linalg.norm(points, axis=1, keepdims=True)
    cosines = np.round(units @ units.T, 9)
    np.fill_diagonal(cosines, -1)
    placed, partners = vectors.clustered(made, 0.9, 32, 40)
    clusters = placed.select("cluster").distinct().count()
    assert placed.count() == 720 and partners.count() < 0.5 * clusters**2
    assert placed.groupBy("block").count().agg({"count": "max"}).first()[0] < 64
    for threshold in (0.9, 0.3, -0.5):
        want = {(int(a), int(b)): cosines[a, b] for a, b in zip(*np.nonzero(cosines > threshold))}
        found = {(r.a, r.b): r.sim for r in vectors.vector_pairs(made, threshold, block_items=32).collect()}
        assert found.keys() == want.keys() and all(abs(found[p] - want[p]) < 1e-8 for p in want)
    lists = vectors.vector_pairs(made, 0.3, 3, block_items=32).collect()
    for item in range(0, 720, 37):
        best = sorted((-r.sim, r.b) for r in lists if r.a == item)[:3]
        assert [b for _, b in best] == [b for _, b in sorted((-c, b) for b, c in enumerate(cosines[item]) if c > 0.3)[:3]]


def test_best_cells_over_many_strips_and_chunks(monkeypatch):
    monkeypatch.setattr(common, "STRIP_ROWS", 7)
    monkeypatch.setattr(common, "STRIP_COLUMNS", 11)
    left = np.random.default_rng(5).normal(size=(40, 4)).round(1)
    left[20:30] = left[3]
    dots = np.round(left @ left.T, 9)
    np.fill_diagonal(dots, -np.inf)
    for least, k in ((0.0, None), (0.5, 3), (-9.0, 12), (0.0, 60)):
        bound = np.full(40, -np.inf) if k is None or k >= 40 else np.sort(np.where(dots > least, dots, -np.inf), axis=1)[:, -k]
        want = {(i, j) for i in range(40) for j in range(40) if dots[i, j] > least and dots[i, j] >= bound[i]}
        got = [(int(i), int(j)) for a, b, _ in common.best_cells(left, left, least, k, True) for i, j in zip(a, b)]
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("spread", [0.01, 10.0])
def test_copies_of_vectors_grow_no_faster_than_the_vectors(spark, monkeypatch, spread):
    """Each vector travels to a bounded number of tiles, with clusters and without."""
    monkeypatch.setattr(common, "LEAST_BLOCK", 16)
    monkeypatch.setattr(vectors, "LEAST_BLOCK", 16)
    generator = np.random.default_rng(13)
    for n in (1000, 4000):
        points = generator.normal(size=(20, 5))[generator.integers(0, 20, n)] + spread * generator.normal(size=(n, 5))
        made = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "item int, vector array<double>")
        met = vectors.meetings(made, 0.4, common.block_size(n, 5), n)[0]
        assert met.count() <= n * vectors.MOST_COPIES * (common.VECTOR_BLOCKS + 1)
        assert met.select("item").distinct().count() == n


def test_a_hot_feature_meets_in_a_grid(spark):
    """Every pair of blocks once, and no cell of the grid with more than its share of blocks on either side."""
    lists = spark.range(300).selectExpr("7L feature", "CAST(id AS INT) block", "300 blocks", "array(id, id + 1) list", "0 info")
    left, right = common.lane_sides(lists.withColumn("lanes", F.lit(5)))
    for side in (left, right):
        cells = side.groupBy("feature", "lane_i", "lane_j").count().collect()
        assert len(cells) == 25 and {r["count"] for r in cells} == {60}
    met = common.block_pairs(lists).select("i", "j").collect()
    assert len(met) == len(set(met)) == 300 * 301 // 2


def test_numbers_of_tags_count_up_from_the_rarest(spark):
    sets = [(1, 1, ["a", "b", "z"]), (2, 2, ["b", "c", "z"]), (3, 1, ["a", "d", "z"])]
    groups = spark.createDataFrame(sets, "rep int, copies long, tags array<string>")
    named = {(r.item, r.feature): r.w for r in tags.weighted_tags(groups).collect()}
    order = sorted({(-w, f) for (_, f), w in named.items()})
    want = {(i, order.index((-w, f)), w) for (i, f), w in named.items()}
    assert {(r.item, r.feature, r.w) for r in tags.numbered_tags(groups).collect()} == want
    assert "z" not in {f for _, f in named}


def test_a_tag_on_half_of_all_products(spark):
    data = [(p, "n", "u", "c", f"hot|own{p // 2}" if p % 2 else f"own{p // 2}") for p in range(20_000)]
    similar = similarity.tag_similarity(spark.createDataFrame(data, schemas.PRODUCT), 0.4)
    pairs = {(r.item, r.other) for r in similar.pairs.collect()}
    assert pairs == {(p, p ^ 1) for p in range(20_000)}


def test_strips_of_users(spark):
    """A row for each block of a user's: its items, then those of later blocks up to one level above; null is a user too."""
    generator = random.Random(3)
    entries = []
    for user in [None, *range(40)]:
        for item in generator.sample(range(60), generator.choice([1, 2, 9, 30])):
            block = item % 7
            entries.append((user, item, 5 + block // 2, block, block // 2))
    df = spark.createDataFrame(entries, "feature int, item int, n int, block int, level int")
    wanted = []
    for user, _, _, i, at in {(e[0], 0, 0, e[3], e[4]) for e in entries}:
        own = [e for e in entries if e[0] == user]
        left = sorted(e[1] for e in own if e[3] == i)
        later = sorted(e[1] for e in own if e[3] > i and abs(e[4] - at) <= 1)
        if len(left + later) > 1:
            wanted.append((-1 if user is None else user, i, len(left), left, later))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        found = raters._strips(df).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all(r.inner and [5 + x % 7 // 2 for x in r["items"]] == r.raters for r in found)
    got = [(-1 if r.feature is None else r.feature, r.i, r.first, sorted(r["items"][: r.first]), sorted(r["items"][r.first :])) for r in found]
    assert sorted(got) == sorted(wanted)


def test_strips_are_made_in_blocks(spark):
    """No list is filtered row by row for every block of a user."""
    df = spark.createDataFrame([(1, 2, 5, 0, 0)], "feature int, item int, n int, block int, level int")
    plan = raters._strips(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "MapInArrow" in plan
