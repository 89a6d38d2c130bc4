"""What the three similarity measures share."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.session import stored

# Similarities are rounded, so that equal ones stay equal whatever order their terms were added in.
DIGITS = 9
SLACK = 10.0**-DIGITS
LANE_BLOCKS = 64
# Vectors: so many blocks, so that what is shuffled grows in proportion, until a block has so many bytes.
LEAST_BLOCK = 2048
VECTOR_BLOCKS = 16
BLOCK_BYTES = 1 << 26
STRIP_ROWS, STRIP_COLUMNS = 512, 4096

FOUND_DDL = "a bigint, b bigint, dot double, scale double"
FOUND = pa.schema(
    [("a", pa.int64()), ("b", pa.int64()), ("dot", pa.float64()), ("scale", pa.float64())]
)
FOUND_ROWS = 200_000


class Similarity(NamedTuple):
    """All pairs over the threshold.

    ``pairs``: (item, other, sim), both directions, between representatives. A representative that
    stands for several items is also paired with itself, sim 1. ``members``: (item, rep), every
    item with its representative, the smallest id among equal items.
    """

    pairs: DataFrame
    members: DataFrame


def check_threshold(threshold: float) -> None:
    """For counts and weights: pairs with nothing in common are never looked at."""
    if threshold < 0:
        raise ValueError("threshold must not be negative")


def task_count(df: DataFrame) -> int:
    """Tasks for block work. The number is given outright so AQE does not merge small, heavy tasks."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    return max(4 * cores, int(spark.conf.get("spark.sql.shuffle.partitions")))


def block_size(items: int, numbers: int | None) -> int:
    """Vectors a block: a share of all of them, within what a task may hold. All copies of a vector travel, one for each block it meets."""
    return max(1, min(max(LEAST_BLOCK, math.ceil(items / VECTOR_BLOCKS)), BLOCK_BYTES // (8 * (numbers or 1))))


def tile_tasks(df: DataFrame, tiles: int) -> int:
    """Tasks for so many tiles: few meet in one task."""
    return max(task_count(df), min(2 * tiles, 4096))


def best_cells(left: np.ndarray, right: np.ndarray, least: float, k: int | None, diagonal: bool = False) -> Iterator[tuple[np.ndarray, ...]]:
    """(rows, columns, values) of the cells of ``left @ right.T``, rounded, over ``least``, the diagonal left out if asked.

    With ``k``, of a row only cells that are no less than its k-th best. What a row's k-th best is among the
    first columns already rules out nearly all cells of the others, so these are compared once.
    """
    for start in range(0, len(left), STRIP_ROWS):
        strip = left[start : start + STRIP_ROWS]
        floor = np.full(len(strip), least - SLACK)
        found = []
        for first in range(0, len(right), STRIP_COLUMNS):
            dots = strip @ right[first : first + STRIP_COLUMNS].T
            if diagonal:
                own = np.arange(max(start, first), min(start + len(strip), first + dots.shape[1]))
                dots[own - start, own - first] = -np.inf
            keep = dots > floor[:, None]
            if k is not None and first == 0 and k < dots.shape[1]:
                best = np.partition(np.where(keep, dots, -np.inf), -k, axis=1)[:, -k]
                floor = np.maximum(floor, best - 2 * SLACK)
                keep &= dots > floor[:, None]
            rows, columns = np.nonzero(keep)
            found.append((rows, first + columns, np.round(dots[rows, columns], DIGITS)))
        rows, columns, values = (np.concatenate(x) for x in zip(*found, strict=True))
        keep = values > least
        if k is not None:
            order = np.lexsort((-values, rows))
            order = order[keep[order]]
            count = np.bincount(rows[order], minlength=len(strip))
            begin = np.cumsum(count) - count
            bound = np.full(len(strip), -np.inf)
            many = count > k
            bound[many] = values[order[begin[many] + k - 1]]
            keep &= values >= bound[rows]
        yield start + rows[keep], columns[keep], values[keep]


def found_batches(a, b, dot, scale) -> Iterator[pa.RecordBatch]:
    """Pairs as Arrow batches of bounded size."""
    for i in range(0, len(a), FOUND_ROWS):
        cut = slice(i, i + FOUND_ROWS)
        arrays = [pa.array(np.ascontiguousarray(x[cut])) for x in (a, b, dot, scale)]
        yield pa.RecordBatch.from_arrays(arrays, schema=FOUND)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Splits sorted batches where the key changes: (key, slice)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            changed[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            yield tuple(c[start].item() for c in columns), batch.slice(start, end - start)


def block_pairs(lists: DataFrame, most_blocks: int | None = None) -> DataFrame:
    """(feature, i, j, left, right, info_left, info_right) with i <= j for every two blocks of a feature.

    ``lists``: (feature, block, list, info) and ``blocks``, how many blocks the feature is spread
    over, which may be left out if no feature has more than ``most_blocks``. On the diagonal
    ``right`` is NULL and stands for ``left``. Blocks of one feature meet in a grid of lanes
    (:func:`lane_sides`), so no task pairs up a hot feature alone.
    """
    same = lists.where(F.size("list") > 1).select(
        "feature",
        F.col("block").alias("i"),
        F.col("block").alias("j"),
        F.col("list").alias("left"),
        F.lit(None).cast(lists.schema["list"].dataType).alias("right"),
        F.col("info").alias("info_left"),
        F.col("info").alias("info_right"),
    )
    if most_blocks == 1:
        return same
    if "blocks" in lists.columns:
        lanes = F.ceil(F.col("blocks") / LANE_BLOCKS).cast("int")
        spread = lists.where("blocks > 1").withColumn("lanes", lanes)
    else:
        spread = lists.withColumn("lanes", F.lit(1))
    left, right = lane_sides(spread)
    cross = left.join(right, ["feature", "lane_i", "lane_j"]).where("i < j")
    return same.unionByName(cross.drop("lane_i", "lane_j"))


def lane_sides(spread: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join of a feature's blocks, dealt over a grid of ``lanes`` x ``lanes`` cells.

    A left block goes to the cells of its row, a right block to those of its column. With one lane for
    every ``LANE_BLOCKS`` blocks a cell has about that many blocks on either side, however hot the feature.
    """
    every = F.explode(F.sequence(F.lit(0), F.col("lanes") - 1))
    own = F.pmod("block", "lanes")
    left = spread.select(
        "feature",
        own.alias("lane_i"),
        every.alias("lane_j"),
        F.col("block").alias("i"),
        F.col("list").alias("left"),
        F.col("info").alias("info_left"),
    )
    right = spread.select(
        "feature",
        every.alias("lane_i"),
        own.alias("lane_j"),
        F.col("block").alias("j"),
        F.col("list").alias("right"),
        F.col("info").alias("info_right"),
    )
    return left, right


def kept(similarity: Similarity) -> Similarity:
    """The similarity as stored tables, for use in more than one place."""
    return Similarity(stored(similarity.pairs, "pairs"), stored(similarity.members, "members"))


def over(found: DataFrame, threshold: float) -> DataFrame:
    sim = F.round(F.col("dot") / F.col("scale"), DIGITS)
    return found.select("a", "b", sim.alias("sim")).where(F.col("sim") > threshold)


def both_ways(pairs: DataFrame) -> DataFrame:
    """Pairs, each found once, in both directions."""
    two = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.select(F.explode(two).alias("p"), "sim").select("p.a", "p.b", "sim")


def similarity(directed: DataFrame, groups: DataFrame, members: DataFrame) -> Similarity:
    """Adds (rep, rep, 1) for each rep that stands for several items to the directed pairs."""
    pairs = directed.select(
        F.col("a").cast("int").alias("item"), F.col("b").cast("int").alias("other"), "sim"
    )
    itself = groups.where("copies > 1").select(
        F.col("rep").alias("item"), F.col("rep").alias("other"), F.lit(1.0).alias("sim")
    )
    return Similarity(pairs.unionByName(itself), members)
