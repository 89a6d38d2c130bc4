"""Factors of one large rating table by alternating least squares, solved block by block.

The same equations as Spark's ALS, solved in the same order from the same first factors. Users and products
are dealt into blocks, and a block holds the ratings of its owners and the factors that occur in them. A half-step
solves all owners of a block together (:class:`basketry.operators.solver.Systems`); the factors are written, and each is
sent once to every block of the other side with a rating of its owner. Only one half-step's messages lie on disk.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.similarity.common import runs
from basketry.operators.solver import CLEANUP, Systems, rating_rows
from basketry.session import fresh_path, remove

# Ratings of a block, of which those of an owner are never divided, and bytes of the factors met in them, at most; small tables
# have smaller blocks. The fewer the blocks, the fewer copies of a factor travel. How many there are does not change the factors.
BLOCK_RATINGS, BLOCK_BYTES, SMALL_BLOCK_RATINGS = 1 << 22, 1 << 29, 1 << 15
# Owners whose factors are one row; and what a task is given at once, in bytes.
CHUNK, AT_ONCE = 2048, 1 << 26
# Executors may not have come yet.
FEW_CORES = 8
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

# Arrays as bytes: owners (int) with their number of ratings (int) and of blocks to send to (int), these blocks (int); the ids
# met in the ratings (int), and by owner each rating's place among them (int) and its score (float).
HELD_FIELDS = ["owners", "number", "outs", "to", "sources", "index", "score"]
HELD = f"struct<{', '.join(f'{k}: binary' for k in HELD_FIELDS)}>"
BLOCKS = f"block int, held {HELD}"
SOLVED = "ids binary, vectors binary, outs binary, to binary"
MESSAGES = "block int, ids binary, vectors binary"
FACTORS = "id int, features array<float>"


def block_count(ratings: int, ids: int, rank: int, cores: int) -> int:
    """Blocks for so many ratings of ``ids`` users or products, one for each core or some times as many."""
    blocks = min(cores, math.ceil(ratings / SMALL_BLOCK_RATINGS))

    def large(share: float) -> bool:
        met = ids * -math.expm1(-share / ids)  # ids among so many ratings, met by chance
        return share > BLOCK_RATINGS or 4 * rank * met > BLOCK_BYTES

    while large(ratings / max(1, blocks)):
        blocks += cores
    return max(1, blocks)


def _numbers(value: pa.Scalar, kind: type = np.int32) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind)


def _bytes(values: np.ndarray, kind: type = np.int32) -> pa.Array:
    return pa.array([np.ascontiguousarray(values, kind).tobytes()], pa.binary())


def _cut(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The bytes of the rows of ``values`` between edges."""
    offsets = (edges * (values.nbytes // max(1, len(values)))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _packed(blocks: int):
    """Task: rows (block, owner, other, score, to) sorted by block into one row a block."""

    def packed(block: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts)
        owner, other, score, to = (rows.column(k).to_numpy() for k in ("owner", "other", "score", "to"))
        order = np.lexsort((score, other, owner))
        owners, by, number = np.unique(owner[order], return_inverse=True, return_counts=True)
        sources, index = np.unique(other[order], return_inverse=True)
        pairs = np.unique(by.astype(np.int64) * blocks + to[order])
        outs = np.bincount(pairs // blocks, minlength=len(owners))
        columns = [_bytes(x) for x in (owners, number, outs, pairs % blocks, sources, index)]
        held = pa.StructArray.from_arrays([*columns, _bytes(score[order], np.float32)], names=HELD_FIELDS)
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), held], names=["block", "held"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for (block,), rows in runs(batches, ["block"]):
            if parts and block != now:
                yield packed(now, parts)
                parts = []
            now = block
            parts.append(rows)
        if parts:
            yield packed(now, parts)

    return run


class _Held:
    """A block's ratings, and the factors of the other side as they come in."""

    def __init__(self, held: pa.StructScalar, rank: int) -> None:
        self.owners, self.number, self.outs, self.to, self.sources, self.index = (_numbers(held[k]) for k in HELD_FIELDS[:-1])
        self.score = _numbers(held["score"], np.float32)
        self.table = np.full((len(self.sources), rank), np.nan, np.float32)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.table[np.searchsorted(self.sources, ids)] = vectors.reshape(len(ids), -1)

    def rows(self, vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Owners with their factors and the blocks that want them."""
        ends = np.cumsum(self.outs, dtype=np.int64)
        for i in range(0, len(self.owners), CHUNK):
            own = slice(i, i + CHUNK)
            to = self.to[ends[i] - self.outs[i] : ends[own][-1]]
            columns = [_bytes(self.owners[own]), _bytes(vectors[own], np.float32), _bytes(self.outs[own]), _bytes(to)]
            yield pa.RecordBatch.from_arrays(columns, names=["ids", "vectors", "outs", "to"])

    def solved(self, reg_param: float) -> np.ndarray:
        starts = np.concatenate([[0], np.cumsum(self.number, dtype=np.int64)])
        return Systems(starts, self.index, self.score.astype(np.float64)).solve(self.table, reg_param)


def _solved(rank: int, reg_param: float):
    """Task: blocks, each followed by the factors sent to it, into the factors of their owners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block = None, None
        for rows in batches:
            for number, held, ids, vectors in zip(*rows.columns, strict=True):
                if held.is_valid:
                    if block is not None:
                        yield from block.rows(block.solved(reg_param))
                    now, block = number, _Held(held, rank)
                elif number != now:
                    raise ValueError(f"factors without ratings in block {number}")
                else:
                    block.add(_numbers(ids), _numbers(vectors, np.float32))
        if block is not None:
            yield from block.rows(block.solved(reg_param))

    return run


def _begun(rank: int):
    """Task: blocks, each followed by rows (id, features) of their owners, into the same as :func:`_solved` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, x = None, None
        for rows in batches:
            held = rows.column("held")
            edges = [*np.flatnonzero(held.is_valid().to_numpy(zero_copy_only=False)).tolist(), len(rows)]
            for begin, end in zip([0, *edges], edges):
                some = rows.slice(begin, end - begin)
                if begin < end and held[begin].is_valid:
                    if block is not None:
                        yield from block.rows(x)
                    block = _Held(held[begin], 0)
                    x, some = np.full((len(block.owners), rank), np.nan, np.float32), some.slice(1)
                if len(some):
                    vectors = some.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, rank)
                    x[np.searchsorted(block.owners, some.column("id").to_numpy())] = vectors
        if block is not None:
            yield from block.rows(x)

    return run


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: factors to the blocks that want them, one row for each of these."""
    for rows in batches:
        for ids, vectors, outs, to in zip(*rows.columns, strict=True):
            ids, outs, to = map(_numbers, (ids, outs, to))
            x = _numbers(vectors, np.float32).reshape(len(ids), -1)
            order = np.argsort(to, kind="stable")
            owner, to = np.repeat(np.arange(len(ids)), outs)[order], to[order]
            starts = np.flatnonzero(np.diff(to, prepend=-1))
            edges = np.append(starts, len(to))
            columns = [pa.array(to[starts], pa.int32()), _cut(ids[owner], edges), _cut(x[owner], edges)]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "ids", "vectors"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for ids, vectors in zip(rows.column("ids"), rows.column("vectors"), strict=True):
            ids, x = _numbers(ids), _numbers(vectors, np.float32)
            lists = pa.ListArray.from_arrays(np.arange(len(ids) + 1, dtype=np.int32) * (len(x) // len(ids)), pa.array(x))
            yield pa.RecordBatch.from_arrays([pa.array(ids), lists], names=["id", "features"])


@contextmanager
def factors(
    ratings: DataFrame, first: DataFrame, rank: int, reg_param: float, iterations: int, blocks: int | None = None
) -> Iterator[tuple[DataFrame, DataFrame]]:
    """(id, features) of all users and of all products; can be read inside the block.

    ``ratings``: as made by ``solver.rating_rows``, read several times; ``first``: (id, features), the users' factors
    to begin with. A task holds one block's ratings, the factors they meet, and those of its owners.
    """
    spark, used = ratings.sparkSession, []
    settings = {CLEANUP: "true", BATCH_BYTES: str(AT_ONCE)}
    before = {k: spark.conf.get(k, None) for k in settings}

    def kept(df: DataFrame, label: str) -> DataFrame:
        used.append(fresh_path(spark, label))
        df.write.option("compression", "none").parquet(used[-1])
        return spark.read.schema(df.schema).parquet(used[-1])

    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        if not blocks:
            n, *ids = ratings.agg(F.count("*"), *(F.approx_count_distinct(k) for k in ("userId", "productId"))).first()
            blocks = block_count(n, max(1, *ids), rank, max(FEW_CORES, spark.sparkContext.defaultParallelism))
        in_block = lambda k: F.pmod(F.xxhash64(k), F.lit(blocks)).cast("int")

        def sides(owner: str, other: str) -> DataFrame:
            rows = ratings.select(
                in_block(owner).alias("block"), F.col(owner).alias("owner"), F.col(other).alias("other"),
                F.col("score").cast("float").alias("score"), in_block(other).alias("to"),
            )
            rows = rows.repartitionById(blocks, "block").sortWithinPartitions("block")
            return kept(rows.mapInArrow(_packed(blocks), BLOCKS), f"blocks-of-{owner}")

        def met(held: DataFrame, rows: DataFrame, run) -> DataFrame:
            dealt = held.unionByName(rows, allowMissingColumns=True).repartitionById(blocks, "block")
            dealt = dealt.sortWithinPartitions("block", F.col("held").isNull())
            return kept(dealt.mapInArrow(run, SOLVED), "factors")

        of_users, of_products = sides("userId", "productId"), sides("productId", "userId")
        x = met(of_users, first.select(in_block("id").alias("block"), "id", "features"), _begun(rank))
        solve, y = _solved(rank, reg_param), None
        for i in range(iterations):
            y = met(of_products, x.mapInArrow(_sent, MESSAGES), solve)
            remove(spark, used.pop(-2))
            x = met(of_users, y.mapInArrow(_sent, MESSAGES), solve)
            if i < iterations - 1:
                remove(spark, used.pop(-2))
        yield x.mapInArrow(_unpacked, FACTORS), y.mapInArrow(_unpacked, FACTORS)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
        for path in used:
            remove(spark, path)
