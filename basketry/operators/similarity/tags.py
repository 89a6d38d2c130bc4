"""TF-IDF cosine over sets of tags."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import split_list
from basketry.operators.running import running_total
from basketry.session import stored

from .common import (
    FOUND_DDL,
    SLACK,
    Similarity,
    block_pairs,
    both_ways,
    check_threshold,
    found_batches,
    over,
    similarity,
    task_count,
)

BLOCK_ITEMS = 512


class _Block:
    """Items of one list: ids, squared norms, and their (item, tag, weight) entries."""

    def __init__(self, entries: pa.StructArray) -> None:
        self.ids = entries.field(0).to_numpy(zero_copy_only=False)
        self.norm2 = entries.field(1).to_numpy(zero_copy_only=False)
        vectors = entries.field(2)
        self.row = np.repeat(np.arange(len(self.ids)), np.diff(vectors.offsets.to_numpy()))
        tags = vectors.flatten()
        self.tag = tags.field(0).to_numpy(zero_copy_only=False)
        self.weight = tags.field(1).to_numpy(zero_copy_only=False)

    def matrix(self, column: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Values by item and by the tags of ``column``, which is sorted and not empty."""
        at = np.minimum(np.searchsorted(column, self.tag), len(column) - 1)
        kept = column[at] == self.tag
        dense = np.zeros((len(self.ids), len(column)))
        dense[self.row[kept], at[kept]] = values[kept]
        return dense


def _cosines(feature: int, left: _Block, right: _Block, diagonal: bool, threshold: float):
    """Pairs over the threshold whose first common tag, rarest first, is ``feature``.

    The same pair also meets at its other common tags and is left to the first one.
    """
    column = np.intersect1d(left.tag, right.tag)
    earlier = column[column < feature]
    dots = left.matrix(column, left.weight) @ right.matrix(column, right.weight).T
    scale = np.sqrt(left.norm2[:, None] * right.norm2[None, :])
    keep = dots > (threshold - SLACK) * scale
    if len(earlier):
        ones_a, ones_b = np.ones(len(left.tag)), np.ones(len(right.tag))
        keep &= left.matrix(earlier, ones_a) @ right.matrix(earlier, ones_b).T == 0
    if diagonal:
        keep &= left.ids[:, None] < right.ids[None, :]
    rows, columns = np.nonzero(keep)
    return left.ids[rows], right.ids[columns], dots[rows, columns], scale[rows, columns]


def _kernel(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = batch.column("feature").to_pylist()
            lefts, rights = batch.column("left"), batch.column("right")
            for r, feature in enumerate(features):
                left = _Block(lefts[r].values)
                diagonal = not rights[r].is_valid
                right = left if diagonal else _Block(rights[r].values)
                yield from found_batches(*_cosines(feature, left, right, diagonal, threshold))

    return run


def tag_weights(groups: DataFrame) -> DataFrame:
    """(feature, w) of the tags of sets (rep, copies, tags); w = ln((products + 1) / (with tag + 1)).

    A tag carried by every product weighs 0 and is left out.
    """
    words = groups.select("copies", F.explode("tags").alias("feature"))
    total = groups.agg(F.sum("copies")).scalar()
    idf = words.groupBy("feature").agg(
        F.round(F.ln((total + 1) / (F.sum("copies") + 1)), 12).alias("w")
    )
    return idf.where("w > 0")


def weighted_tags(groups: DataFrame) -> DataFrame:
    """(item, feature, w) of tag sets (rep, copies, tags)."""
    words = groups.select(F.col("rep").alias("item"), F.explode("tags").alias("feature"))
    return words.join(tag_weights(groups), "feature").select("item", "feature", "w")


def numbered_tags(groups: DataFrame) -> DataFrame:
    """As :func:`weighted_tags`, with numbers for tags: they count up from the rarest tag, ties by name."""
    ranked = tag_weights(groups).withColumn("all", F.lit(0))
    numbers = running_total(ranked, "all", [F.desc("w"), F.asc("feature")], F.lit(1), "number")
    words = groups.select(F.col("rep").alias("item"), F.explode("tags").alias("feature"))
    found = words.join(numbers, "feature")
    return found.select("item", F.col("number").cast("bigint").alias("feature"), "w")


def prefix_entries(weighted: DataFrame, threshold: float) -> DataFrame:
    """(item, feature, norm2, vector) for the tags that can bring an item over the threshold > 0.

    Take an item's tags rarest first. Once the remaining ones are no longer than threshold times the
    whole vector, they cannot lift a pair over the threshold alone; so two items over it share a tag
    before that point in both. Very common tags hardly ever come before it.
    """
    whole = Window.partitionBy("item")
    tail = whole.orderBy(F.asc("w"), F.desc("feature"))
    square = F.col("w") * F.col("w")
    return weighted.select(
        "item",
        "feature",
        F.sum(square).over(whole).alias("norm2"),
        F.sum(square).over(tail).alias("rest2"),
        F.collect_list(F.struct("feature", "w")).over(whole).alias("vector"),
    ).where(F.sqrt("rest2") > (threshold - SLACK) * F.sqrt("norm2"))


def tag_pairs(entries: DataFrame, threshold: float, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(a, b, sim), each pair once, with cosine > threshold, from :func:`prefix_entries` of numbered tags.

    Only items that share such a tag meet, each with its whole vector. A tag with many items is split
    into blocks.
    """
    blocks = entries.groupBy("feature").agg(
        F.ceil(F.count("*") / block_items).cast("int").alias("blocks"), F.count("*").alias("items")
    )
    lists = stored(
        entries.join(blocks.where("items > 1"), "feature")
        .withColumn("block", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
        .groupBy("feature", "block", "blocks")
        .agg(
            F.collect_list(
                F.struct(F.col("item").cast("bigint").alias("item"), "norm2", "vector")
            ).alias("list")
        )
        .withColumn("info", F.lit(0)),
        "tag-lists",
    )
    rows = block_pairs(lists).select("feature", "i", "j", "left", "right")
    spread = rows.repartition(task_count(entries), "feature", "i", "j")
    found = spread.drop("i", "j").mapInArrow(_kernel(threshold), FOUND_DDL)
    return over(found, threshold)


def tag_similarity(products: DataFrame, threshold: float = 0.4) -> Similarity:
    """TF-IDF cosine over the tag sets of products that have a weighted tag."""
    check_threshold(threshold)
    tagged = products.select(
        F.col("productId").alias("item"),
        F.array_sort(F.array_distinct(split_list(F.col("tags")))).alias("tags"),
    ).withColumn("key", F.xxhash64("tags"))
    same = ["key", "tags"]
    groups = tagged.groupBy(*same).agg(F.min("item").alias("rep"), F.count("*").alias("copies"))
    groups = stored(groups, "tag-sets")
    entries = stored(prefix_entries(numbered_tags(groups), threshold), "tag-entries")
    known = groups.join(entries.select(F.col("item").alias("rep")), "rep", "left_semi")
    members = tagged.join(known, same).select("item", "rep")
    return similarity(both_ways(tag_pairs(entries, threshold)), known, members)
