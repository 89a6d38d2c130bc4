"""A quality classifier from preference pairs.

Documents marked good are preferred to documents marked bad. A Bradley-Terry model, fitted by
Newton steps on the logistic loss of feature differences, gives each document a strength; the
threshold is the quantile of the training strengths at the share of bad labels.

The model is fitted on all labelled rows that are not held out; by doc_id, each bad row meets ``OPPONENTS``
good ones in a fixed rotation. Pairs are made block by block and only their sums come to the driver. Features
are read from texts only.

Defined results: null text is empty and scored like any text; labels that are null are left out,
a doc_id with two labels counts as bad; without both labels in the training rows every document
scores 0.5; rows that repeat give repeated results, and of different texts under one doc_id the one with the
least features is learnt; an empty table gives no rows; other columns are
ignored. Texts of any length are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.bitmaps import bitmap, passes
from basketry.llm.quality_rules import duplicate_lines, repeated_words, row_sums
from basketry.llm.words import SEPARATOR, Hasher, Slice, batch, mixed, per_row, released, space_words, text_slices
from basketry.operators.running import running_total
from basketry.session import fresh_path, remove

OPPONENTS = 8
# Bad rows of a block, which also holds their opponents, and blocks of a file.
BLOCK_ROWS, FILE_BLOCKS = 1024, 16
RIDGE = 1e-2
STEPS = 30
CLASSES = {
    "upper": np.isin(np.arange(256), list(range(65, 91))),
    "digit": np.isin(np.arange(256), list(range(48, 58))),
    "stop": np.isin(np.arange(256), list(b".,;?")),
    "bang": np.isin(np.arange(256), list(b"!")),
    "bar": np.isin(np.arange(256), list(b"|")),
    "symbol": np.isin(np.arange(256), list(b"#*$%&<>@~^=_")),
    "line": np.isin(np.arange(256), list(b"\n")),
}


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def features(piece: Slice, hasher: Hasher) -> np.ndarray:
    """One row of numbers per text; rates, so that length alone says little."""
    n = piece.last - piece.first
    words = space_words(piece, hasher)
    n_words = np.maximum(per_row(words.row, n), 1)
    chars = np.maximum(row_sums(((piece.data & 0xC0) != 0x80) & ~SEPARATOR[piece.data], piece.offsets), 1)
    count = {k: row_sums(inside[piece.data], piece.offsets) for k, inside in CLASSES.items()}
    distinct = np.unique(words.hash ^ mixed(words.row.astype(np.uint64)), return_index=True)[1]
    again = np.flatnonzero((words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1]))
    short = words.row[words.end - words.start <= 3]
    by_word = [count[k] / n_words for k in ("stop", "bang", "bar", "symbol", "line")]
    rates = [
        *by_word,
        *[np.sqrt(x) for x in by_word],
        count["upper"] / chars,
        count["digit"] / chars,
        per_row(words.row[distinct], n) / n_words,
        np.sqrt(per_row(words.row[again], n) / n_words),
        np.sqrt(repeated_words(words, n) / n_words),
        np.sqrt(duplicate_lines(piece) / (count["line"] + 1)),
        per_row(short, n) / n_words,
        np.minimum(chars / n_words, 20.0),
        np.log1p(per_row(words.row, n)),
    ]
    return np.stack(rates, 1).astype(np.float64)


class Model(NamedTuple):
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        strength = self.standard(x) @ self.weights
        return 1 / (1 + np.exp(np.clip(self.threshold - strength, -50, 50)))

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.center) / self.scale, -8, 8)


def slopes(difference: np.ndarray, weights: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of pairs, and the sums over them of the loss's slope and curve."""
    p = 1 / (1 + np.exp(np.clip(difference @ weights, -50, 50)))
    return len(p), difference.T @ p, (difference * (p * (1 - p))[:, None]).T @ difference


def newton(n: int, sums: Callable[[np.ndarray], tuple[int, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weights of least loss, from the sums of :func:`slopes` over all pairs."""
    weights = np.zeros(n)
    for _ in range(STEPS):
        pairs, slope, curve = sums(weights)
        step = np.linalg.solve(curve / pairs + RIDGE * np.eye(n), slope / pairs - RIDGE * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def unfitted(n: int) -> Model:
    return Model(np.zeros(n), np.ones(n), np.zeros(n), 0.0)


def standardising(center: np.ndarray, spread: np.ndarray) -> Model:
    return Model(center, np.where(spread > 1e-9, spread, 1.0), np.zeros(len(center)), 0.0)


def fit(x: np.ndarray, good: np.ndarray, opponents: int = OPPONENTS) -> Model:
    """Strengths from pairs (good, bad), and the threshold at the quantile of bad rows; of rows in memory."""
    n = x.shape[1] if x.ndim == 2 else 1
    if not len(good) or good.all() or not good.any():
        return unfitted(n)
    model = standardising(x.mean(0), x.std(0))
    z = model.standard(x)
    bad = np.flatnonzero(~good)
    winners = np.flatnonzero(good)
    # Each bad row meets the next opponents in turn, so all good rows take part evenly.
    turn = (np.arange(len(bad))[:, None] * opponents + np.arange(opponents)[None, :]) % len(winners)
    difference = z[winners[turn]].reshape(-1, n) - np.repeat(z[bad], opponents, 0)
    weights = newton(n, lambda w: slopes(difference, w))
    strength = np.sort(z @ weights)
    # Between the two strengths on either side of the quantile.
    at = len(bad)
    threshold = (strength[at - 1] + strength[at]) / 2
    return model._replace(weights=weights, threshold=float(threshold))


def measured(documents: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, x) of documents that may be among the ``known``; a bitmap of their ids spares the texts a shuffle."""
    held = bitmap(known.select(F.xxhash64("doc_id").alias("key")), "key")

    def run(batches):
        hasher = Hasher()
        for rows in batches:
            some = rows.filter(pa.array(passes(held, rows.column(2).to_numpy(zero_copy_only=False))))
            for piece in text_slices(some.column(1)):
                ids = some.column(0).slice(piece.first, piece.last - piece.first).cast(pa.int64())
                x = pa.array(list(features(piece, hasher)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([ids, x], names=["doc_id", "x"])

    wanted = documents.where("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64(F.col("doc_id").cast("bigint")))
    return wanted.mapInArrow(released(run), "doc_id bigint, x array<double>")


def block_of(good: int, bad: int, opponents: int) -> Column:
    """Blocks of a good row by ``place``: the first, where it counts, and all those with bad rows that it meets.

    Bad row i meets the good rows at 8 i to 8 i + 7, counted on from the last to the first.
    """
    step, turns, place = BLOCK_ROWS * opponents, bad * opponents, F.col("place")
    whole = lambda x: F.floor(x).cast("bigint")
    if good >= step:
        rounds = F.greatest(whole((F.lit(turns - 1) - place) / good), F.lit(0))
        return F.transform(F.sequence(F.lit(0).cast("bigint"), rounds), lambda k: whole((place + k * good) / step))
    # Few good rows: each block is asked whether its turns come to the row.
    begin = lambda j: j * step
    met = lambda j: place + good * F.greatest(F.ceil((begin(j) - place) / good), F.lit(0))
    blocks = F.sequence(F.lit(0).cast("bigint"), F.lit(math.ceil(bad / BLOCK_ROWS) - 1).cast("bigint"))
    return F.filter(blocks, lambda j: (j == 0) | (met(j) < F.least(begin(j + 1), F.lit(turns))))


BLOCKS = "block bigint, bad array<double>, first bigint, place array<bigint>, good array<double>"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, bad ones first, into one row a block."""

    def packed(block: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        of = rows.column("good").to_numpy()
        place, lost = rows.column("place").to_numpy(), int((~of).sum())
        x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        cut = lost * (len(x) // len(of))
        columns = [[block], [x[:cut]], [int(place[0]) if lost else 0], [place[lost:]], [x[cut:]]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "bad", "first", "place", "good"])

    now, parts = None, []
    for rows in batches:
        block = rows.column("block").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)] if len(block) else [0]
        for begin, end in zip(edges, edges[1:]):
            if parts and block[begin] != now:
                yield packed(now, parts)
                parts = []
            now = int(block[begin])
            parts.append(rows.slice(begin, end - begin))
    if parts:
        yield packed(now, parts)


class Block(NamedTuple):
    number: int
    bad: np.ndarray
    first: int
    place: np.ndarray
    good: np.ndarray

    def own(self, opponents: int) -> np.ndarray:
        """Bad rows and those good rows that count here."""
        return np.concatenate([self.bad, self.good[self.place // (BLOCK_ROWS * opponents) == self.number]])

    def differences(self, model: Model, good: int, opponents: int) -> np.ndarray:
        turn = ((self.first + np.arange(len(self.bad)))[:, None] * opponents + np.arange(opponents)[None, :]) % good
        won = model.standard(self.good)[np.searchsorted(self.place, turn.ravel())]
        return won - np.repeat(model.standard(self.bad), opponents, 0)


def _blocks(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[Block]:
    for rows in batches:
        for block, bad, first, place, good in zip(*rows.columns, strict=True):
            bad, place, good = (x.values.to_numpy(zero_copy_only=False) for x in (bad, place, good))
            yield Block(block.as_py(), bad.reshape(-1, n), first.as_py(), place, good.reshape(-1, n))


def train(documents: DataFrame, labels: DataFrame, opponents: int = OPPONENTS) -> Model:
    """The model from all labelled rows outside the held-out part."""
    spark, used = documents.sparkSession, []
    n = len(features(next(text_slices(pa.array(["a"]))), Hasher())[0])

    def kept(df: DataFrame, label: str) -> DataFrame:
        used.append(fresh_path(spark, label))
        df.write.parquet(used[-1])
        return spark.read.schema(df.schema).parquet(used[-1])

    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg((F.min("quality") == 1).alias("good"))
    try:
        known = kept(known, "known-labels")
        # Copies of a labelled row are learnt once.
        rows = measured(documents, known).join(known, "doc_id").groupBy("doc_id", "good").agg(F.min("x").alias("x"))
        rows = kept(rows, "labelled")
        of = {r["good"]: r["n"] for r in rows.groupBy("good").agg(F.count("*").alias("n")).collect()}
        if len(of) < 2:
            return unfitted(n)
        blocks = kept(_dealt(rows, of[True], of[False], opponents), "label-blocks")
        return _fitted(blocks, n, of[True], of[False], opponents)
    finally:
        for path in used:
            remove(spark, path)


def _dealt(rows: DataFrame, good: int, bad: int, opponents: int) -> DataFrame:
    """(doc_id, good, x) as blocks of bad rows, in turn by doc_id, with all good rows they meet."""
    placed = running_total(rows, "good", [F.col("doc_id")], F.lit(1), "place")
    own = F.array(F.floor(F.col("place") / BLOCK_ROWS).cast("bigint"))
    block = F.explode(F.when(F.col("good"), block_of(good, bad, opponents)).otherwise(own)).alias("block")
    files = math.ceil(max(bad / BLOCK_ROWS, good / BLOCK_ROWS / opponents) / FILE_BLOCKS)
    dealt = placed.select(block, "good", "place", "x").repartition(files, "block")
    return dealt.sortWithinPartitions("block", "good", "place").mapInArrow(_packed, BLOCKS)


def _fitted(blocks: DataFrame, n: int, good: int, bad: int, opponents: int) -> Model:
    """As :func:`fit`. One row a block comes to the driver, where they are added in order."""

    def gathered(run: Callable[[Block], tuple[int, np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
        def task(batches):
            for block in _blocks(batches, n):
                number, numbers = run(block)
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (block.number, number, numbers)], names=["block", "number", "numbers"])

        found = blocks.mapInArrow(task, "block bigint, number bigint, numbers array<double>").toArrow().sort_by("block")
        rows = found.column("numbers").to_pylist()
        return zip(found.column("number").to_pylist(), map(np.array, rows), strict=True)

    def moments(block: Block) -> tuple[int, np.ndarray]:
        x = block.own(opponents)
        return len(x), np.concatenate([x.mean(0), ((x - x.mean(0)) ** 2).sum(0)]) if len(x) else np.zeros(2 * n)

    count, center, squares = 0, np.zeros(n), np.zeros(n)
    for number, found in gathered(moments):
        if number:
            gap, count = found[:n] - center, count + number
            squares = squares + found[n:] + gap**2 * ((count - number) * number / count)
            center = center + gap * (number / count)
    model = standardising(center, np.sqrt(squares / count))

    def sums(weights: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        def run(block: Block) -> tuple[int, np.ndarray]:
            pairs, slope, curve = slopes(block.differences(model, good, opponents), weights)
            return pairs, np.concatenate([slope, curve.ravel()])

        pairs, total = 0, np.zeros(n + n * n)
        for number, found in gathered(run):
            pairs, total = pairs + number, total + found
        return pairs, total[:n], total[n:].reshape(n, n)

    weights = newton(n, sums)

    def strengths(batches):
        for block in _blocks(batches, n):
            own = model.standard(block.own(opponents)) @ weights
            ids = [np.full(len(own), block.number), np.arange(len(own)), own]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in ids], names=["block", "row", "strength"])

    found = blocks.mapInArrow(strengths, "block bigint, row bigint, strength double").withColumn("all", F.lit(0))
    ranked = running_total(found, "all", [F.col("strength"), F.col("block"), F.col("row")], F.lit(1), "before")
    # Between the two strengths on either side of the quantile.
    beside = [r["strength"] for r in ranked.where(F.col("before").isin(bad - 1, bad)).select("strength").collect()]
    return model._replace(weights=weights, threshold=sum(beside) / 2)


FOUND = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def scores(documents: DataFrame, model: Model) -> DataFrame:
    def run(batches):
        hasher = Hasher()
        for rows in batches:
            for piece in text_slices(rows.column(1)):
                ids = rows.column(0).slice(piece.first, piece.last - piece.first).cast(pa.int64())
                yield batch(FOUND, ids, model.score(features(piece, hasher)))

    return documents.select("doc_id", "text").mapInArrow(released(run), "doc_id bigint, score double")


def keep_good(documents: DataFrame, model: Model) -> DataFrame:
    """The rows, with all their columns, that the model does not reject."""
    at = documents.columns.index("text")

    def run(batches):
        hasher = Hasher()
        for rows in batches:
            for piece in text_slices(rows.column(at)):
                good = model.score(features(piece, hasher)) >= 0.5
                yield rows.slice(piece.first, len(good)).filter(pa.array(good))

    return documents.mapInArrow(released(run), documents.schema)


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    found = scores(documents, train(documents, labels))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
