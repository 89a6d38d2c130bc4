"""Real-time lists: hand-worked scores, boundary cases, brute force with a hot user and copies."""

import math
import random
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators import realtime, serving, similarity


def similar_of(spark, pairs):
    both = [(a, b, s) for a, b, s in pairs] + [(b, a, s) for a, b, s in pairs]
    return similarity.from_pairs(spark.createDataFrame(both, "productId int, otherId int, sim double"))


def lists_of(recs):
    return {r["userId"]: [(x["productId"], round(x["score"], 6)) for x in r["recs"]] for r in recs.collect()}


def test_worked_scores(spark):
    sims = similar_of(spark, [(1, 9, 0.8), (2, 9, 0.5), (3, 9, 0.4), (4, 9, 0.6)])
    ratings = [
        (1, 2, 3.0, 1), (1, 3, 4.0, 2), (1, 1, 5.0, 3),  # third is not over 0.4; 3.0 is a penalty
        (2, 4, 4.0, 1), (2, 2, 2.0, 2), (2, 1, 5.0, 3),
        (3, 3, 5.0, 1),  # its only recent has exactly 0.4: candidate falls out, empty list
        (4, 77, 5.0, 1),  # product unknown to the similarity table
    ]
    df = spark.createDataFrame(ratings, schemas.RATING)
    assert lists_of(realtime.stream_recs(df, sims)) == {
        1: [(9, 2.75)],
        2: [(9, 2.767697)],
        3: [],
        4: [],
    }


def test_rated_products_are_no_candidates(spark):
    sims = similar_of(spark, [(1, p, 1 - p / 100) for p in range(2, 50)])
    rated = [(1, p, 4.0, p) for p in range(2, 12)] + [(1, 1, 4.0, 99)]
    df = spark.createDataFrame(rated, schemas.RATING)
    events = df.where("productId = 1")
    found = rows(realtime.candidate_products(events, df, sims, 20), "rank")
    assert [r[2] for r in found] == list(range(12, 32))


def brute_force(ratings, sims, n_recent, n_candidates, threshold):
    by_user = defaultdict(list)
    for u, p, s, t in ratings:
        by_user[u].append((t, p, s))
    result = {}
    for u, mine in by_user.items():
        mine = sorted(mine, reverse=True)
        rated = {p for _, p, _ in mine}
        near = sorted((-s, b) for (a, b), s in sims.items() if a == mine[0][1] and b not in rated)
        scored = []
        for _, q in near[:n_candidates]:
            used = [(sims[q, p], s) for _, p, s in mine[:n_recent] if sims.get((q, p), 0) > threshold]
            if used:
                liked = sum(s > 3 for _, s in used)
                mean = sum(x * s for x, s in used) / len(used)
                gain = math.log10(max(1, liked)) - math.log10(max(1, len(used) - liked))
                scored.append((round(-(mean + gain), 9), q, mean + gain))
        result[u] = [(q, round(v, 6)) for _, q, v in sorted(scored)]
    return result


@pytest.mark.parametrize(
    "n_recent, n_candidates, threshold", [(20, 20, 0.4), (5, 3, 0.4), (40, 50, 0.55), (1, 1, 0.3)]
)
def test_against_brute_force(spark, n_recent, n_candidates, threshold):
    generator = random.Random(11)
    ratings = []
    for u in range(25):
        for t in range(300 if u == 0 else generator.randrange(1, 12)):
            ratings.append((u, min(int(generator.expovariate(0.06)), 59), generator.randrange(1, 11) / 2, t))
    ratings += [(0, p, 4.0, 1000) for p in range(60, 75)]  # copies: rated by the hot user alone
    df = spark.createDataFrame(ratings, schemas.RATING)
    similar = similarity.kept(similarity.rater_similarity(df, 0.3))
    members = defaultdict(list)
    for item, rep in rows(similar.members):
        members[rep].append(item)
    sims = {
        (x, y): s for a, b, s in rows(similar.pairs) for x in members[a] for y in members[b] if x != y
    }
    assert any(len(m) > 10 for m in members.values())
    recs = realtime.stream_recs(
        df, similar, n_recent=n_recent, n_candidates=n_candidates, threshold=threshold
    )
    expected = brute_force(ratings, sims, n_recent, n_candidates, threshold)
    got = lists_of(recs)
    assert got.keys() == expected.keys()
    for user, listed in expected.items():
        assert sorted(got[user]) == sorted(listed)
        assert [s for _, s in got[user]] == sorted((s for _, s in got[user]), reverse=True)


def test_empty_lists_survive_flattening(spark):
    users = spark.createDataFrame([(1,), (2,)], "userId int")
    ranked = realtime.ranked_scores(
        spark.createDataFrame([(1, 5, 2.0), (1, 4, 3.0), (1, 3, 2.0)], "userId int, productId int, score double")
    )
    recs = realtime.to_user_recs(users, ranked)
    flat = serving.flatten(recs, "userId", keep_empty=True)
    assert rows(flat, F.col("userId"), F.col("rank")) == [
        (1, 1, 4, 3.0), (1, 2, 3, 2.0), (1, 3, 5, 2.0), (2, None, None, None),
    ]
