"""Predictions and lists from given factor tables, whatever model they come from."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.similarity.common import FOUND_DDL, SLACK, best_cells, block_size, found_batches, runs, tile_tasks
from basketry.session import stored

NORM_RANGES = 64


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)


def predictions(pairs: DataFrame, users: DataFrame, products: DataFrame, rank: int | None = None) -> DataFrame:
    """The pairs (userId, productId, ...) that have both factors, with ``prediction``.

    ``users``: (userId, vector), ``products``: (productId, vector). With ``rank``, only the first
    numbers of both vectors count.
    """
    cut = (lambda v: F.slice(v, 1, rank)) if rank else (lambda v: v)
    left = users.select("userId", cut(F.col("vector")).alias("user_vector"))
    right = products.select("productId", cut(F.col("vector")).alias("product_vector"))
    joined = pairs.join(left, "userId").join(right, "productId")
    return joined.withColumn("prediction", dot(F.col("user_vector"), F.col("product_vector"))).select(
        *pairs.columns, "prediction"
    )


def rmse_by_rank(ratings: DataFrame, users: DataFrame, products: DataFrame, ranks: Iterable[int]) -> DataFrame:
    """(rank, rmse) of the factors cut to each rank, on the (user, product) of the ratings; one scan."""
    joined = ratings.join(users.withColumnRenamed("vector", "u"), "userId").join(
        products.withColumnRenamed("vector", "p"), "productId"
    )
    points = [
        F.struct(F.lit(r).alias("rank"), (F.col("score") - dot(F.slice("u", 1, r), F.slice("p", 1, r))).alias("error"))
        for r in ranks
    ]
    errors = joined.select(F.explode(F.array(*points)).alias("e")).select("e.*")
    return errors.groupBy("rank").agg(F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"))


class _Sides:
    """A block of users and a block of products."""

    def __init__(self, key: tuple[int, int]) -> None:
        self.key = key
        self.sides: tuple[list, list] = ([], [])

    def add(self, side: int, batch: pa.RecordBatch) -> None:
        ids = batch.column("item").to_numpy(zero_copy_only=False)
        self.sides[side].append((ids, batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)))

    def best(self, n: int) -> Iterator[pa.RecordBatch]:
        if not all(self.sides):
            return
        (users, left), (products, right) = ([np.concatenate(x) for x in zip(*side)] for side in self.sides)
        for rows, columns, dots in best_cells(left, right, 0.0, n):
            yield from found_batches(users[rows], products[columns], dots, np.ones(len(dots)))


def _kernel(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = None
        for (i, j, side), batch in runs(batches, ["i", "j", "side"]):
            if tile is None or tile.key != (i, j):
                if tile is not None:
                    yield from tile.best(n)
                tile = _Sides((i, j))
            tile.add(side, batch)
        if tile is not None:
            yield from tile.best(n)

    return run


class Ranges(NamedTuple):
    """Products by falling norm, in at most ``NORM_RANGES`` ranges of some blocks each."""

    cuts: list[float]
    longest: list[float]
    first: list[int]
    last: list[int]

    def of(self, norm: Column) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, self.cuts)), lambda c: c > norm)) if self.cuts else F.lit(0)

    def block(self, item: str) -> Column:
        """Number of an item's block; a column ``range`` has its range."""
        at = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("range") + 1)
        return (at(self.first) + F.pmod(F.xxhash64(item), at(self.last) - at(self.first) + 1)).cast("int")

    def blocks(self, reach: Column | None) -> Column:
        """All blocks of the first range; with ``reach``, those of further ranges that it holds for."""
        numbered = list(enumerate(zip(self.longest, self.first, self.last, strict=True)))
        if reach is None:
            return F.sequence(F.lit(self.first[0]), F.lit(self.last[0]))
        within = [
            F.when((bound > 0) & (bound + SLACK >= reach), F.sequence(F.lit(i), F.lit(j)))
            for r, (longest, i, j) in numbered
            if r
            for bound in [F.lit(longest * (1 + SLACK)) * F.col("norm")]
        ]
        return F.flatten(F.array_compact(F.array(*within)))


def norm_ranges(products: DataFrame, block_items: int, ranges: int) -> Ranges:
    """``products`` has ``norm``. What comes to the driver is one row a range."""
    number = min(ranges, math.ceil(products.count() / block_items))
    quantiles = products.approxQuantile("norm", [k / number for k in range(1, number)], 0.001) if number > 1 else []
    cuts = sorted(set(quantiles), reverse=True)
    placed = Ranges(cuts, [], [], [])
    found = products.groupBy(placed.of(F.col("norm")).alias("range")).agg(F.max("norm").alias("longest"), F.count("*").alias("n"))
    sizes = {r["range"]: (r["longest"], math.ceil(r["n"] / block_items)) for r in found.collect()}
    for r in range(len(cuts) + 1):
        longest, blocks = sizes.get(r, (0.0, 1))
        placed.first.append(placed.last[-1] + 1 if r else 0)
        placed.last.append(placed.first[-1] + blocks - 1)
        placed.longest.append(longest)
    return placed


def _best(found: DataFrame, n: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("dot"), "b"))
    return found.select("a", "b", "dot").withColumn("rank", place).where(F.col("rank") <= n)


def _meet(users: DataFrame, products: DataFrame, n: int, most: int) -> tuple[DataFrame, DataFrame]:
    """The n best of each user in each block it names in ``blocks``, and the tiles (i, j) this takes, ``most`` at most."""
    left = users.select("i", F.explode("blocks").alias("j"), F.lit(0).alias("side"), "item", "vector")
    tiles = left.select("i", "j").distinct()
    right = products.join(tiles, "j").select("i", "j", F.lit(1).alias("side"), "item", "vector")
    dealt = left.unionByName(right).repartition(tile_tasks(users, most), "i", "j").sortWithinPartitions("i", "j", "side")
    return dealt.mapInArrow(_kernel(n), FOUND_DDL), tiles


def lists_and_tiles(
    users: DataFrame, products: DataFrame, n: int = 20, block_items: int | None = None, ranges: int = NORM_RANGES
) -> tuple[DataFrame, DataFrame]:
    """As :func:`user_lists`, and the tiles (i, j) of a block of users and one of products that were multiplied."""
    counts = [
        x.agg(F.approx_count_distinct(k), F.min(F.size("vector")), F.max(F.size("vector"))).first()
        for x, k in ((users, "userId"), (products, "productId"))
    ]
    if len({v for c in counts for v in c[1:] if v is not None}) > 1:
        raise ValueError("factors of different length have no product")

    def side(vectors: DataFrame, key: str) -> DataFrame:
        numbers = vectors.select(F.col(key).cast("bigint").alias("item"), F.col("vector").cast("array<double>").alias("vector"))
        return numbers.withColumn("norm", F.sqrt(dot(F.col("vector"), F.col("vector"))))

    of_users, of_products = (block_items or block_size(c[0], c[1]) for c in counts)
    user_blocks = max(1, math.ceil(counts[0][0] / of_users))
    left = side(users, "userId").withColumn("i", F.pmod(F.xxhash64("item"), F.lit(user_blocks)).cast("int"))
    right = side(products, "productId")
    placed = norm_ranges(right, of_products, ranges)
    right = right.withColumn("range", placed.of(F.col("norm")))
    right = stored(right.select("item", "vector", placed.block("item").alias("j")), "products-by-norm")
    found, tiles = _meet(left.withColumn("blocks", placed.blocks(None)), right, n, user_blocks * (placed.last[0] + 1))
    best = _best(found, n)
    if placed.cuts:
        first = stored(best, "first-lists")
        least = first.where(F.col("rank") == n).select(F.col("a").alias("item"), "dot")
        reach = F.coalesce("dot", F.lit(0.0))
        further = left.join(least, "item", "left").withColumn("blocks", placed.blocks(reach)).where(F.size("blocks") > 0)
        found, more = _meet(further, right, n, user_blocks * placed.last[-1])
        best, tiles = _best(first.select("a", "b", "dot").unionByName(found.select("a", "b", "dot")), n), tiles.unionByName(more)
    lists = best.select(F.col("a").cast("int").alias("userId"), "rank", F.col("b").cast("int").alias("productId"), F.col("dot").alias("score"))
    return lists, tiles


def user_lists(
    users: DataFrame, products: DataFrame, n: int = 20, block_items: int | None = None, ranges: int = NORM_RANGES
) -> DataFrame:
    """(userId, rank, productId, score): the n best products of each user with a prediction above 0.

    Users and products meet block by block as matrix products; a tile lets out the n best of each of
    its users, so what leaves the tasks is bounded by the blocks. Ties go by product id.

    Products are blocked by falling norm. All users meet the longest first; a user then meets only
    ranges whose greatest norm times the user's own reaches the user's n-th score so far, which is exact.
    Products travel only to blocks of users that still need them.
    """
    return lists_and_tiles(users, products, n, block_items, ranges)[0]
