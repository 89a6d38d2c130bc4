"""A stored form of a similarity for look-ups: lists that are read as far as they are needed.

Four tables, each partitioned by a hash of the id it is asked by and sorted by it:

* ``lists``: (item, rank, ahead, other, size, sim), the list of each class in order; ``ahead`` counts the
  products of all classes that are more similar, ``size`` those of the listed class;
* ``pairs``: (item, other, sim) for single similarities;
* ``reps``: (item, rep), the class of a product;
* ``members``: (rep, place, item), the products in order of classes that have several.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.running import running_total
from basketry.sources.keyed import looked_up
from basketry.sources.sinks import overwrite_sharded, sharded

from .common import Similarity

SCHEMAS = {
    "lists": "item int, rank int, ahead bigint, other int, size bigint, sim double, shard int",
    "pairs": "item int, other int, sim double, shard int",
    "reps": "item int, rep int, shard int",
    "members": "rep int, place int, item int, shard int",
}


class Index(NamedTuple):
    spark: SparkSession
    path: str
    shards: int

    def _near(self, name: str, ids: DataFrame, column: str) -> DataFrame:
        return looked_up(self.spark, f"{self.path}/{name}", SCHEMAS[name], ids, column, self.shards).drop("shard")

    def reps_of(self, ids: DataFrame) -> DataFrame:
        """(item, rep) of the ids (item)."""
        return self._near("reps", ids, "item")

    def lists_of(self, reps: DataFrame) -> DataFrame:
        """The lists of the classes (item), to be cut by rank."""
        return self._near("lists", reps, "item")

    def members_of(self, reps: DataFrame) -> DataFrame:
        """(rep, place, item) of the classes (rep) that have several products, to be cut by place."""
        return self._near("members", reps, "rep")

    def sims_of(self, items: DataFrame) -> DataFrame:
        """(item, other, sim) of the classes (item); a join on both skips what it does not ask for."""
        return self._near("pairs", items, "item")


def ranked_lists(similarity: Similarity) -> DataFrame:
    """Rows of ``lists``."""
    sizes = similarity.members.groupBy(F.col("rep").alias("other")).agg(F.count("*").alias("size"))
    pairs = similarity.pairs.join(sizes, "other")
    # Numbered by (sim, other), and added up over distinct similarities, as equally similar classes do not come ahead.
    ranked = running_total(pairs, "item", [F.desc("sim"), F.col("other")], F.lit(1), "rank")
    steps = pairs.groupBy("item", "sim").agg(F.sum("size").alias("of_sim"))
    steps = running_total(steps, "item", [F.desc("sim")], F.col("of_sim"), "ahead").drop("of_sim")
    return ranked.join(steps, ["item", "sim"]).select(
        "item", (F.col("rank") + 1).cast("int").alias("rank"), F.col("ahead").cast("long").alias("ahead"), "other", "size", "sim"
    )


def numbered_members(similarity: Similarity) -> DataFrame:
    """Rows of ``members``."""
    several = similarity.members.groupBy("rep").agg(F.count("*").alias("n")).where("n > 1").select("rep")
    own = similarity.members.join(several, "rep", "left_semi").select("rep", "item")
    return running_total(own, "rep", [F.col("item")], F.lit(1), "place").select(
        "rep", (F.col("place") + 1).cast("int").alias("place"), "item"
    )


def write_index(similarity: Similarity, path: str, shards: int) -> None:
    for name, rows, key, order in (
        ("lists", ranked_lists(similarity), "item", ["item", "rank"]),
        ("pairs", similarity.pairs.select("item", "other", "sim"), "item", ["item", "other"]),
        ("reps", similarity.members.select("item", "rep"), "item", ["item"]),
        ("members", numbered_members(similarity), "rep", ["rep", "place"]),
    ):
        overwrite_sharded(sharded(rows, shards, key), f"{path}/{name}", *order)


def read_index(spark: SparkSession, path: str, shards: int) -> Index:
    return Index(spark, path, shards)


def whole_table(index: Index, name: str) -> DataFrame:
    """One of the four tables."""
    return index.spark.read.schema(SCHEMAS[name]).parquet(f"{index.path}/{name}").drop("shard")
