"""Co-rating cosine: common raters over the root of the product of both rater counts."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import stored

from .common import (
    FOUND_DDL,
    LANE_BLOCKS,
    SLACK,
    Similarity,
    block_pairs,
    both_ways,
    check_threshold,
    found_batches,
    over,
    runs,
    similarity,
    task_count,
)

BLOCK_ITEMS = 2048
# A chunk hands on at most one count per pair of its two blocks, so about one per row it took in.
CHUNK_ROWS = BLOCK_ITEMS**2
BROADCAST_BLOCKS = 100_000
EXPAND_AT_ONCE = 2_000_000
# A user with more items sends them block by block.
HOT_USER = 4096
# Pairs of a block's items with others, user by user, that one task is to count.
BLOCK_WORK = 16_000_000


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and row offsets of an array column."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


class _Strip:
    """Common-rater counts of one block of items with all items, added up user by user.

    Counts are kept of pairs that occur, sorted; a pair is one number, the smaller id above the larger.
    """

    def __init__(self, key: tuple) -> None:
        self.key = key
        self.whole = key[2] == 1
        self.found: list[tuple[np.ndarray, ...]] = []
        self.pending = self.held = 0

    def add(self, batch: pa.RecordBatch) -> None:
        items, offset = _flat(batch.column("items"))
        raters = _flat(batch.column("raters"))[0].astype(np.float64)
        first, inner = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("first", "inner"))
        row = np.repeat(np.arange(len(first)), first)
        place = np.arange(len(row)) - np.repeat(np.cumsum(first) - first, first)
        at = offset[row] + place
        begin = np.where(inner[row], at + 1, offset[row] + first[row])
        spans = offset[row + 1] - begin
        work = np.cumsum(spans)
        start = 0
        while start < len(work):
            done = work[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(work, done + EXPAND_AT_ONCE, side="right")))
            length = spans[start:end]
            other = np.arange(int(length.sum())) + np.repeat(begin[start:end] - np.cumsum(length) + length, length)
            one = np.repeat(at[start:end], length)
            low, high = np.minimum(items[one], items[other]).astype(np.int64), np.maximum(items[one], items[other]).astype(np.int64)
            self.found.append(((low << 32) | (high & 0xFFFFFFFF), np.ones(len(one)), raters[one] * raters[other]))
            self.pending += len(one)
            if self.pending > max(EXPAND_AT_ONCE, self.held):
                self._add_up()
            start = end

    def _add_up(self) -> None:
        keys, counts, squares = (np.concatenate(x) for x in zip(*self.found, strict=True))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
        counts = np.add.reduceat(counts[order], edges) if len(edges) else counts
        self.found = [(keys[edges], counts, squares[order][edges])]
        self.pending, self.held = 0, len(edges)

    def pairs(self, threshold: float) -> Iterator[pa.RecordBatch]:
        """Pairs over the threshold; every counted pair if the block is one of several chunks."""
        if not self.found:
            return
        self._add_up()
        keys, common, squares = self.found[0]
        scale = np.sqrt(squares)
        keep = common > ((threshold - SLACK) * scale if self.whole else 0.0)
        high = (keys[keep] & 0xFFFFFFFF).astype(np.uint32).view(np.int32).astype(np.int64)
        yield from found_batches(keys[keep] >> 32, high, common[keep], scale[keep])


def _kernel(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strip = None
        for key, batch in runs(batches, ["i", "chunk", "chunks"]):
            if strip is None or strip.key != key:
                if strip is not None:
                    yield from strip.pairs(threshold)
                strip = _Strip(key)
            strip.add(batch)
        if strip is not None:
            yield from strip.pairs(threshold)

    return run


def _levelled(items: DataFrame, threshold: float) -> DataFrame:
    """Adds ``level``: items more than one level apart cannot be over the threshold.

    The cosine is at most sqrt(smaller count / larger count), so counts further apart than a factor
    threshold^-2 are out. A hot product meets only the few that are nearly as hot.
    """
    if not 0 < threshold < 1:
        return items.withColumn("level", F.lit(0))
    step = -2 * math.log(threshold)
    return items.withColumn("level", F.floor(F.ln(F.col("n").cast("double")) / step).cast("int"))


def _placed(items: DataFrame, block_items: int) -> tuple[DataFrame, int]:
    """Adds ``block``: items hashed into blocks of about ``block_items``, or if given ``work`` for one task, within their level.

    Also gives the number of blocks.

    One row a level, at most the number of distinct counts, is joined to the items.
    """
    width = F.ceil(F.count("*") / block_items)
    if "work" in items.columns:
        width = F.greatest(width, F.ceil(F.sum("work") / BLOCK_WORK))
    width = width.cast("int")
    before = F.sum("width").over(Window.orderBy("level").rowsBetween(Window.unboundedPreceding, -1))
    levels = items.groupBy("level").agg(width.alias("width"))
    levels = stored(levels.withColumn("start", F.coalesce(before, F.lit(0)).cast("int")), "levels")
    inside = F.pmod(F.xxhash64("item"), F.col("width")).cast("int")
    placed = items.join(levels, "level").withColumn("block", inside + F.col("start")).drop("width", "start")
    return placed, levels.agg(F.sum("width")).first()[0] or 0


def _same_as_before(column: pa.Array) -> np.ndarray:
    """Whether each value, nulls alike, equals the one before."""
    now, before = column.slice(1), column.slice(0, max(0, len(column) - 1))
    equal = pc.or_(pc.fill_null(pc.equal(now, before), False), pc.and_(pc.is_null(now), pc.is_null(before)))
    return np.concatenate([[False], equal.to_numpy(zero_copy_only=False)])[: len(column)]


def _user_strips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: entries sorted by feature, block, level and item into the rows of :func:`_strips`."""

    def strips(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Of whole users. Blocks are numbered by level, so what an item's block meets follows it without a gap."""
        block, level, item, n = (rows.column(k).to_numpy() for k in ("block", "level", "item", "n"))
        new_user = ~_same_as_before(rows.column("feature"))
        user = np.cumsum(new_user) - 1
        begin = np.flatnonzero(new_user | np.concatenate([[True], block[1:] != block[:-1]]))
        first = np.diff(begin, append=len(block))
        # Levels do not fall within a user, so users and levels make one rising number.
        width = int(level.max()) + 3
        end = np.searchsorted(user * width + level, user[begin] * width + level[begin] + 1, side="right")
        kept = end - begin > 1
        begin, end, first = begin[kept], end[kept], first[kept]
        total = np.cumsum(end - begin)
        start = 0
        while start < len(begin):
            done = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, done + EXPAND_AT_ONCE, side="right")))
            length = (end - begin)[start:stop]
            edges = np.concatenate([[0], np.cumsum(length)])
            at = np.arange(edges[-1]) + np.repeat(begin[start:stop] - edges[:-1], length)
            lists = [pa.ListArray.from_arrays(edges.astype(np.int32), pa.array(x[at])) for x in (item, n)]
            some = begin[start:stop]
            columns = [rows.column("feature").take(pa.array(some)), pa.array(block[some]), *lists, pa.array(first[start:stop].astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.ones(len(some), bool))], names=["feature", "i", "items", "raters", "first", "inner"])
            start = stop

    waiting: list[pa.RecordBatch] = []
    for rows in batches:
        if not len(rows):
            continue
        together = pa.Table.from_batches([*waiting, rows]).combine_chunks().to_batches()[0]
        last = np.flatnonzero(~_same_as_before(together.column("feature")))[-1]
        if last:
            yield from strips(together.slice(0, last))
        waiting = [together.slice(last)]
    if waiting:
        yield from strips(waiting[0])


def _strips(entries: DataFrame) -> DataFrame:
    """(feature, i, items, raters, first, inner) of users with one list each: their items in block i, then those of later blocks."""
    rows = entries.select("feature", *(F.col(k).cast("int").alias(k) for k in ("block", "level", "item", "n")))
    order = ["feature", "block", "level", "item"]
    kind = entries.schema["feature"].dataType.simpleString()
    ddl = f"feature {kind}, i int, items array<int>, raters array<int>, first int, inner boolean"
    return rows.repartition(task_count(entries), "feature").sortWithinPartitions(*order).mapInArrow(_user_strips, ddl)


def _tiles(entries: DataFrame, blocks: int) -> DataFrame:
    """As :func:`_strips`, of users whose items travel as one list a block: a row for every two blocks."""
    entry = F.struct("item", "n")
    lists = entries.groupBy("feature", "block", "level").agg(F.collect_list(entry).alias("list")).withColumnRenamed("level", "info")
    if blocks > LANE_BLOCKS:
        spread = lists.groupBy("feature").agg(F.count("*").alias("blocks"))
        lists = lists.join(spread, "feature")
    rows = block_pairs(lists, most_blocks=blocks).where(F.abs(F.col("info_left") - F.col("info_right")) <= 1)
    rows = rows.withColumn("e", F.when(F.col("right").isNull(), F.col("left")).otherwise(F.concat("left", "right")))
    return rows.select(
        "feature", "i", F.col("e.item").alias("items"), F.col("e.n").alias("raters"), F.size("left").alias("first"),
        F.col("right").isNull().alias("inner"),
    )


def common_rater_pairs(
    rated: DataFrame, items: DataFrame, threshold: float, block_items: int = BLOCK_ITEMS
) -> DataFrame:
    """(a, b, sim), a < b, with cosine > threshold.

    ``rated``: distinct (feature, item), feature being the user; ``items``: (item, n) with n raters,
    only these take part. For each block with an item of the user's, one row has the user's items there and
    those of later blocks, so a user of many blocks sends a list to each and not a row for every two. The items
    of a user with more than ``HOT_USER`` travel as one list per block, and every two lists meet. ``chunks`` splits
    the users of a block with many; counts of such a block are added up before the threshold is applied.
    """
    ints = items.select(F.col("item").cast("int").alias("item"), F.col("n").cast("int").alias("n"))
    taken = rated.select("feature", F.col("item").cast("int").alias("item")).join(ints, "item")
    sizes = stored(taken.groupBy("feature").agg(F.count("*").alias("rated")), "rater-sizes")
    same_user = F.col("feature").eqNullSafe(F.col("user"))
    taken = stored(taken.join(sizes.withColumnRenamed("feature", "user"), same_user).drop("user"), "rater-items")
    work = taken.groupBy("item", "n").agg(F.sum(F.least("rated", F.lit(HOT_USER))).alias("work"))
    placed, blocks = _placed(_levelled(work, threshold), block_items)
    entries = stored(taken.join(placed.drop("n", "work"), "item"), "rater-entries")
    rows = entries.groupBy(F.col("block").alias("i")).agg(F.ceil(F.count("*") / CHUNK_ROWS).cast("int").alias("chunks"))
    if blocks <= BROADCAST_BLOCKS:  # one small row per block
        rows = F.broadcast(rows)
    strips = _strips(entries.where(F.col("rated") <= HOT_USER)).unionByName(_tiles(entries.where(F.col("rated") > HOT_USER), blocks))
    strips = (
        strips.join(rows, "i")
        .withColumn("chunk", F.pmod(F.xxhash64("feature"), F.col("chunks")).cast("int"))
        .select("i", "chunk", "chunks", "items", "raters", "first", "inner")
        .repartition(task_count(rated), "i", "chunk")
        .sortWithinPartitions("i", "chunk")
    )
    counted = strips.mapInArrow(_kernel(threshold), FOUND_DDL)
    total = counted.groupBy("a", "b").agg(F.sum("dot").alias("dot"), F.first("scale").alias("scale"))
    return over(total, threshold)


def rater_similarity(ratings: DataFrame, threshold: float = 0.4) -> Similarity:
    """Co-rating similarity of all rated products.

    Products with the same set of raters are recognised by its size and two 64-bit hashes that
    combine in any order, so no rater list is ever built.
    """
    check_threshold(threshold)
    pairs = ratings.select(F.col("userId").alias("feature"), F.col("productId").alias("item"))
    rated = stored(pairs.distinct(), "rated")
    items = rated.groupBy("item").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("feature")).alias("h1"),
        F.bit_xor(F.xxhash64(F.lit(1), "feature")).alias("h2"),
    )
    same = ["n", "h1", "h2"]
    items = stored(items, "rated-items")
    groups = items.groupBy(*same).agg(F.min("item").alias("rep"), F.count("*").alias("copies"))
    members = items.join(groups, same).select("item", "rep")
    found = common_rater_pairs(rated, groups.select(F.col("rep").alias("item"), "n"), threshold)
    return similarity(both_ways(found), groups, members)
