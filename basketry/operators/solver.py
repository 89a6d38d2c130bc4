"""Factorisation of one rating table at several points (rank, regParam) at once, as scored on held-out ratings.

The same alternating least squares as :func:`basketry.operators.factorization.train`, from the same first factors. All
points go through the ratings together: an iteration is one pass over blocks of users and one sum per product, however
many points there are. Users' factors never travel: where they are solved, a product's part of its normal equations
is added up over its raters in the block, or, if that is smaller, the raters' factors are sent as they are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.similarity.common import runs
from basketry.session import fresh_path, remove

# Ratings of a block; a user's are never divided. Small tables have smaller blocks, up to ``FEW_BLOCKS`` of them.
BLOCK_RATINGS, SMALL_BLOCK_RATINGS, FEW_BLOCKS = 1 << 18, 1 << 15, 24
# Factors multiplied at once, and ratings of an owner above which they are multiplied piece by piece.
AT_ONCE, LONG = 1 << 12, 1 << 11
# Numbers in a batch of messages.
BATCH_NUMBERS = 1 << 19

RATING = ["held", "userId", "productId", "score"]
BLOCKS = "block int, ratings array<struct<held: boolean, userId: int, productId: int, score: double>>"
# Lets go of a query's shuffles when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
MESSAGES = "point int, item int, n bigint, sums array<double>, raters array<float>"
FACTORS = "point int, item int, vector array<float>"
PREDICTIONS = "point int, score double, prediction double"


def sums(table: np.ndarray, index: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of y y' and of score y over the rows y of ``table`` at ``index``."""
    gram, goal = np.zeros((table.shape[1],) * 2), np.zeros(table.shape[1])
    for i in range(0, len(index), LONG):
        y = table[index[i : i + LONG]].astype(np.float64)
        gram += y.T @ y
        goal += y.T @ score[i : i + LONG]
    return gram, goal


def solution(gram: np.ndarray, goal: np.ndarray, ridge: np.ndarray) -> np.ndarray:
    """x of (gram + ridge I) x = goal, one or many."""
    diagonal = np.arange(gram.shape[-1])
    gram[..., diagonal, diagonal] += ridge[..., None]
    if not np.all(ridge):
        np.linalg.cholesky(gram)  # fails if there are fewer ratings than factors
    return np.linalg.solve(gram, goal[..., None])[..., 0]


class Systems:
    """The normal equations of many owners: ratings ``starts[i]`` to ``starts[i + 1]`` are those of owner i.

    ``index`` tells a rating's row in the table of the other side's factors. Owners with about as many ratings are
    solved together, padded with ratings of no weight; those with fewer ratings than factors through
    the smaller system of their ratings, which has the same solution.
    """

    def __init__(self, starts: np.ndarray, index: np.ndarray, score: np.ndarray) -> None:
        self.number = number = np.diff(starts)
        self.long = [(i, index[starts[i] : starts[i + 1]], score[starts[i] : starts[i + 1]]) for i in np.flatnonzero(number > LONG)]
        index, score = np.append(index, -1), np.append(score, 0.0)
        padded = np.where(number > 8, -(-number // 8) * 8, number)
        padded[number > LONG] = 0
        self.groups = []
        for n in np.unique(padded[padded > 0]):
            alike = np.flatnonzero(padded == n)
            for owners in np.array_split(alike, math.ceil(len(alike) * n / AT_ONCE)):
                at = starts[owners][:, None] + np.arange(n)
                at = np.where(at < starts[owners + 1][:, None], at, len(index) - 1)
                self.groups.append((owners, index[at], score[at]))

    def solve(self, table: np.ndarray, reg_param: float) -> np.ndarray:
        """Factors of all owners, in the precision that models keep."""
        rank = table.shape[1]
        found = np.empty((len(self.number), rank), np.float32)
        for owners, index, score in self.groups:
            y, ridge = table[index].astype(np.float64), reg_param * self.number[owners]
            y[index < 0] = 0  # ratings of no weight
            turned = y.transpose(0, 2, 1)
            if index.shape[1] < rank and reg_param > 0:
                found[owners] = (turned @ solution(y @ turned, score, ridge)[:, :, None])[:, :, 0]
            else:
                found[owners] = solution(turned @ y, (turned @ score[:, :, None])[:, :, 0], ridge)
        for i, index, score in self.long:
            found[i] = solution(*sums(table, index, score), reg_param * self.number[i])
        return found


class _Block:
    """Ratings of some users: those to train on, grouped by user and by product, and those held out."""

    def __init__(self, ratings: pa.StructArray) -> None:
        held, user, item, score = (ratings.field(k).to_numpy(zero_copy_only=False) for k in range(4))
        held = held.astype(bool)
        order = np.lexsort((score, item, user))
        order = order[~held[order]]
        self.users, by = np.unique(user[order], return_inverse=True)
        self.items = np.unique(item)
        of, self.score = np.searchsorted(self.items, item[order]), score[order]
        self.systems = Systems(np.append(np.flatnonzero(np.diff(by, prepend=-1)), len(by)), of, self.score)
        self.by_item = np.argsort(of, kind="stable")
        self.raters, self.of_item = by[self.by_item], of[self.by_item]
        self.item_starts = np.append(np.flatnonzero(np.diff(self.of_item, prepend=-1)), len(of))
        known = held & np.isin(user, self.users)
        self.asked = (np.searchsorted(self.users, user[known]), np.searchsorted(self.items, item[known]), score[known])

    def table(self, of_users: bool, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Factors by position of their user or product; NaN where there are none."""
        keys = self.users if of_users else self.items
        placed = np.full((len(keys), vectors.shape[1]), np.nan, np.float32)
        placed[np.searchsorted(keys, ids)] = vectors
        return placed

    def messages(self, points: Iterable[int], x: np.ndarray) -> Iterator[pa.RecordBatch]:
        """What the users' factors ``x`` add to the products' normal equations."""
        rank = x.shape[1]
        numbers, score = np.diff(self.item_starts), self.score[self.by_item]
        item = self.items[self.of_item[self.item_starts[:-1]]]
        dense = numbers * (rank + 1) > rank * (rank + 3)  # floats sent as they are, and doubles added up
        upper, packed = np.triu_indices(rank), []
        step = max(1, BATCH_NUMBERS // (rank * (rank + 3) // 2))
        at = np.flatnonzero(dense)
        for some in np.split(at, range(step, len(at), step)) if len(at) else []:
            packed = np.empty((len(some), rank * (rank + 3) // 2))
            for row, i in zip(packed, some):
                part = slice(self.item_starts[i], self.item_starts[i + 1])
                gram, row[:rank] = sums(x, self.raters[part], score[part])
                row[rank:] = gram[upper]
            yield from _sent(points, item[some], numbers[some], _lists(packed.ravel(), np.full(len(some), packed.shape[1])), None)
        at = np.flatnonzero(~dense)
        step = max(1, BATCH_NUMBERS // (rank * (rank + 1)))
        for some in np.split(at, range(step, len(at), step)) if len(at) else []:
            part = np.concatenate([np.arange(self.item_starts[i], self.item_starts[i + 1]) for i in some])
            rows = np.column_stack([score[part].astype(np.float32), x[self.raters[part]]])
            yield from _sent(points, item[some], numbers[some], None, _lists(rows.ravel(), numbers[some] * (rank + 1)))


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32), pa.array(values))


def _sent(points: Iterable[int], item: np.ndarray, n: np.ndarray, added: pa.Array | None, raters: pa.Array | None) -> Iterator[pa.RecordBatch]:
    columns = [
        pa.array(item, pa.int32()),
        pa.array(n, pa.int64()),
        pa.nulls(len(item), pa.list_(pa.float64())) if added is None else added,
        pa.nulls(len(item), pa.list_(pa.float32())) if raters is None else raters,
    ]
    for point in points:
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(item), point, np.int32)), *columns], names=["point", "item", "n", "sums", "raters"])


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _pass(points: Sequence[tuple[int, float]], first: bool, last: bool):
    """Blocks with their ratings (point -1), then factors by point: of the users if ``first``, else of the products.

    Gives messages to the products or, if ``last``, predictions of the ratings held out.
    """

    def met(block: _Block, point: int, ids: list[np.ndarray], vectors: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rank, reg_param = points[point]
        given = block.table(first, np.concatenate(ids), np.concatenate(vectors))
        if first:  # the points of a rank begin alike
            yield from block.messages([k for k, p in enumerate(points) if p[0] == rank], given)
            return
        x = block.systems.solve(given, reg_param)
        if not last:
            yield from block.messages([point], x)
            return
        user, item, score = block.asked
        found = np.einsum("ij,ij->i", x[user], given[item]).astype(np.float64)
        known = ~np.isnan(found)
        columns = [np.full(known.sum(), point, np.int32), score[known], found[known]]
        yield from pa.Table.from_arrays([pa.array(c) for c in columns], names=["point", "score", "prediction"]).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, now, ids, vectors = None, None, [], []
        for key, rows in runs(batches, ["block", "point"]):
            if key != now and ids:
                yield from met(block, now[1], ids, vectors)
                ids, vectors = [], []
            now = key
            if key[1] < 0:
                block = _Block(rows.column("ratings").flatten())
            else:
                ids.append(rows.column("item").to_numpy(zero_copy_only=False))
                vectors.append(_matrix(rows.column("vector")))
        if ids:
            yield from met(block, now[1], ids, vectors)

    return run


class _Sums:
    """A product's normal equations at a point, as they come in."""

    def __init__(self, key: tuple[int, int], rank: int) -> None:
        self.key, self.rank, self.n = key, rank, 0
        self.added: np.ndarray | None = None
        self.raters: list[np.ndarray] = []

    def add(self, rows: pa.RecordBatch) -> None:
        self.n += int(np.sum(rows.column("n").to_numpy(zero_copy_only=False)))
        packed = rows.column("sums").flatten().to_numpy(zero_copy_only=False)
        if len(packed):
            total = packed.reshape(-1, self.rank * (self.rank + 3) // 2).sum(axis=0)
            self.added = total if self.added is None else self.added + total
        raters = rows.column("raters").flatten().to_numpy(zero_copy_only=False)
        if len(raters):
            self.raters.append(raters.reshape(-1, self.rank + 1))
        if sum(map(len, self.raters)) > LONG:
            self._fold()

    def _fold(self) -> None:
        rows = np.concatenate(self.raters)
        gram, goal = sums(rows[:, 1:], np.arange(len(rows)), rows[:, 0])
        total = np.concatenate([goal, gram[np.triu_indices(self.rank)]])
        self.added, self.raters = total if self.added is None else self.added + total, []

    def solve(self, reg_param: float) -> np.ndarray:
        if self.raters:
            self._fold()
        gram = np.zeros((self.rank, self.rank))
        gram[np.triu_indices(self.rank)] = self.added[self.rank :]
        gram = np.triu(gram) + np.triu(gram, 1).T
        return solution(gram, self.added[: self.rank], np.float64(reg_param * self.n)).astype(np.float32)


def _factors(points: Sequence[tuple[int, float]]):
    """Messages sorted by point and product into the products' factors."""

    def solved(waiting: list[_Sums]) -> Iterator[pa.RecordBatch]:
        """``waiting`` has one point; products with few raters are solved together."""
        point = waiting[0].key[0]
        few = [s for s in waiting if s.added is None]
        many = [s for s in waiting if s.added is not None]
        vectors = [s.solve(points[point][1])[None] for s in many]
        if few:
            rows = np.concatenate([r for s in few for r in s.raters])
            starts = np.cumsum([0, *(s.n for s in few)])
            vectors.append(Systems(starts, np.arange(len(rows)), rows[:, 0].astype(np.float64)).solve(rows[:, 1:], points[point][1]))
        items = np.array([s.key[1] for s in [*many, *few]], np.int32)
        x = np.concatenate(vectors)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(items), point, np.int32)), pa.array(items), _lists(x.ravel(), np.full(len(items), x.shape[1]))],
            names=["point", "item", "vector"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[_Sums] = []
        numbers = 0
        for key, rows in runs(batches, ["point", "item"]):
            rank = points[key[0]][0]
            if not waiting or waiting[-1].key != key:
                if waiting and (waiting[-1].key[0] != key[0] or numbers > BATCH_NUMBERS):
                    yield from solved(waiting)
                    waiting, numbers = [], 0
                waiting.append(_Sums(key, rank))
            waiting[-1].add(rows)
            numbers += len(rows.column("sums").flatten()) + len(rows.column("raters").flatten())
        if waiting:
            yield from solved(waiting)

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ratings sorted by block, one row a block."""

    def packed(block: int, rows: list[pa.StructArray]) -> pa.RecordBatch:
        whole = pa.concat_arrays(rows)
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.ListArray.from_arrays([0, len(whole)], whole)], names=["block", "ratings"])

    now, rows = None, []
    for (block,), some in runs(batches, ["block"]):
        if rows and block != now:
            yield packed(now, rows)
            rows = []
        now = block
        rows.append(pa.StructArray.from_arrays([some.column(k) for k in RATING], names=RATING))
    if rows:
        yield packed(now, rows)


def _given(name: str, what: str) -> Column:
    return F.when(F.col(name).isNull(), F.raise_error(F.lit(f"{what} MUST NOT be Null"))).otherwise(F.col(name))


def rating_rows(ratings: DataFrame, held: bool) -> DataFrame:
    """As ALS takes them: ids must be there, and scores to train on must be numbers."""
    score = F.col("score").cast("double")
    if not held:
        wrong = F.col("score").isNull() | F.isnan("score")
        score = F.when(wrong, F.raise_error(F.lit("Ratings MUST NOT be Null or NaN"))).otherwise(score.cast("float").cast("double"))
    ids = [_given(k, f"{k} Ids").cast("int").alias(k) for k in ("userId", "productId")]
    rows = ratings.select(F.lit(held).alias("held"), *ids, score.alias("score"))
    return rows.where(F.col("score").isNotNull()) if held else rows


def block_count(ratings: int) -> int:
    return max(1, min(FEW_BLOCKS, math.ceil(ratings / SMALL_BLOCK_RATINGS)), math.ceil(ratings / BLOCK_RATINGS))


@contextmanager
def held_out_predictions(
    train: DataFrame,
    test: DataFrame,
    first: Callable[[DataFrame], DataFrame],
    points: Sequence[tuple[int, float]],
    iterations: int,
    blocks: int | None = None,
) -> Iterator[DataFrame]:
    """(point, score, prediction) of the test rows whose user and product have been trained on; can be read inside the block.

    ``points``: (rank, regParam), numbered from 0. ``first`` makes (point, userId, vector), the users' factors to begin
    with, under the first point of each rank, from one rating of each user. The largest things a task holds are a block's
    ratings and one point's factors of their users and products. Only products' factors are kept from one iteration to the next.
    """
    spark, used = train.sparkSession, []
    cleaned = spark.conf.get(CLEANUP, None)

    def kept(df: DataFrame, label: str) -> DataFrame:
        used.append(fresh_path(spark, label))
        df.write.parquet(used[-1])
        return spark.read.schema(df.schema).parquet(used[-1])

    def dealt(df: DataFrame, *order: str) -> DataFrame:
        return df.repartitionById(blocks, "block").sortWithinPartitions("block", *order)

    try:
        # Whatever is read again is stored, so messages may go as soon as the products are solved.
        spark.conf.set(CLEANUP, "true")
        rows = kept(rating_rows(train, False).unionByName(rating_rows(test, True)), "grid-rows")
        trained = rows.where(~F.col("held"))
        blocks = blocks or block_count(trained.count())
        users = kept(trained.groupBy("userId").agg(F.min("productId").alias("productId"), F.lit(0.0).alias("score")), "grid-users")
        in_block = lambda user: F.pmod(F.xxhash64(user), F.lit(blocks)).cast("int").alias("block")
        rows = rows.select(in_block("userId"), *RATING)
        wanted = kept(rows.select("block", F.col("productId").alias("item")).distinct(), "grid-wanted")
        packed = kept(dealt(rows).mapInArrow(_packed, BLOCKS), "grid-blocks")
        nothing = [F.lit(None).cast(t).alias(k) for k, t in (("vector", "array<float>"), ("ratings", packed.schema["ratings"].dataType))]
        packed = packed.select("block", F.lit(-1).alias("point"), F.lit(0).alias("item"), nothing[0], "ratings")

        def met(factors: DataFrame, run, ddl: str) -> DataFrame:
            sent = packed.unionByName(factors.select("block", "point", "item", "vector", nothing[1]))
            return dealt(sent, "point", "item").mapInArrow(run, ddl)

        factors = first(users).select(in_block("userId"), "point", F.col("userId").alias("item"), F.col("vector").cast("array<float>").alias("vector"))
        for i in range(iterations):
            messages = met(factors, _pass(points, i == 0, False), MESSAGES)
            messages = messages.repartition("point", "item").sortWithinPartitions("point", "item")
            products = kept(messages.mapInArrow(_factors(points), FACTORS), "grid-products")
            if i:
                remove(spark, used.pop(-2))
            factors = wanted.join(products, "item")
        yield met(factors, _pass(points, False, True), PREDICTIONS)
    finally:
        if cleaned is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, cleaned)
        for path in used:
            remove(spark, path)
