"""Mixing sources to target weights by systematic sampling.

Within a source every document expects the same number of copies, target / size of the source.
Documents stand in order of size; their expected copies are summed up along that order, one random
offset per source is added, and a document is emitted once for every integer the sum passes. Going
by size keeps the words taken near the target whatever the offset. The running sum is worked out
over ranges of (source, size), so a source with a third of all rows is spread over many tasks.

Defined results: null text has size 0; the null source is a source of its own, the last; rows that
repeat are rows of their own; ties of size go by doc_id, then by a hash of the row; sources of size
0 get nothing; an empty table gives no rows. Columns other than doc_id, text and source only
travel along.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketry.llm.words import released, unused
from basketry.session import stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
SEED = 7
WORD = "[^\\x20\\x09-\\x0D]+"


def sizes(documents: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and a hash of the whole row."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    return documents.select("doc_id", "source", size, F.xxhash64(*hashed_columns(documents)).alias("row_hash"))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """Per source: words to take and the offset. ``sources``: one row a source with its size.

    Sources that would exceed ``most`` times their size stop there; the rest share what is over by
    weight. In order of cap per weight the full sources come first, so one running sum finds them.
    """
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    position = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    capped = sources.withColumn("position", position).select(
        "source", "source_size", "position",
        F.element_at(cycle, (F.col("position") - 1) % len(weights) + 1).alias("weight"),
        (F.lit(float(most)) * F.col("source_size")).alias("cap"),
        (F.lit(float(share)) * F.sum("source_size").over(everything)).alias("total"),
    )
    order = Window.orderBy(F.col("cap") / F.col("weight"), "position")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    shared = capped.withColumns({"rank": F.row_number().over(order), "per_weight": (F.col("total") - before) / rest})
    open_from = F.min(
        F.when(F.col("per_weight") * F.col("weight") < F.col("cap"), F.struct("rank", "per_weight"))
    ).over(everything)
    level = F.coalesce(open_from.getField("per_weight"), F.lit(float("inf")))
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))))
    # Twenty bits, so adding whole numbers never rounds.
    offset = F.conv(F.substring(drawn, 1, 5), 16, 10).cast("double") / (1 << 20)
    return shared.withColumn("level", level).select(
        "source", "source_size", F.least(F.col("cap"), F.col("level") * F.col("weight")).alias("target"), offset.alias("offset")
    )


RANGED = pa.schema(
    [("doc_id", pa.int64()), ("source", pa.string()), ("size", pa.int64()), ("row_hash", pa.int64()),
     ("part", pa.int32()), ("place", pa.int64())]
)


def _places(batches):
    """Task: rows in order get their place, from 1, among the partition's rows of the same source."""
    part, source, place = TaskContext.get().partitionId(), object(), 0
    for rows in batches:
        found = []
        for s in rows.column("source").to_pylist():
            place = place + 1 if s == source else 1
            source = s
            found.append(place)
        yield pa.RecordBatch.from_arrays(
            [*(rows.column(n).cast(t) for n, t in zip(RANGED.names[:4], RANGED.types, strict=False)),
             pa.array([part] * len(found), pa.int32()), pa.array(found, pa.int64())],
            schema=RANGED,
        )


def copies(documents: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """Every document row's doc_id, source, size, row_hash, source_size, target and number of copies."""
    measured = stored(sizes(documents), "sizes")
    order = [F.col("source").asc_nulls_last(), "size", "doc_id", "row_hash"]
    ranged = stored(
        measured.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            released(_places), "doc_id bigint, source string, size bigint, row_hash bigint, part int, place bigint"
        ),
        "ranged",
    )
    # Small tables: one row a source and partition, and one row a source.
    parts = ranged.groupBy("source", "part").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    by_part = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(by_part), F.lit(0)))
    sources = parts.groupBy("source").agg(F.sum("words").alias("source_size"))
    goals = targets(sources, weights, share, most, seed).withColumnRenamed("source", "of")
    parts = parts.join(goals, parts.source.eqNullSafe(goals.of)).select(
        F.col("source").alias("of"), F.col("part").alias("in_part"), "before", "source_size", "target", "offset"
    )
    placed = ranged.join(parts, ranged.source.eqNullSafe(parts.of) & (F.col("part") == F.col("in_part")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rank = (F.col("before") + F.col("place")).cast("double")
    crossed = F.floor(F.col("offset") + rate * rank) - F.floor(F.col("offset") + rate * (rank - 1))
    return placed.select("doc_id", "source", "size", "row_hash", "source_size", "target", crossed.cast("long").alias("copies"))


def mixed(documents: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """The mix itself: every document as often as it was emitted, with all its columns."""
    plan = copies(documents, weights, share, most, seed)
    id_key, hash_key, n, equal, own, copy = (
        unused(documents.columns, f"mix_{c}") for c in ("doc_id", "row_hash", "copies", "equal_rows", "own_hash", "copy")
    )
    # Rows that are equal in all columns are interchangeable: one of them is repeated.
    taken = plan.groupBy(F.col("doc_id").alias(id_key), F.col("row_hash").alias(hash_key)).agg(
        F.sum("copies").alias(n), F.count("*").alias(equal)
    )
    taken = stored(taken.where(F.col(n) > 0), "taken")
    hashed = documents.withColumn(own, F.xxhash64(*hashed_columns(documents)))

    def repeated(part: DataFrame, rows: DataFrame) -> DataFrame:
        same = rows["doc_id"].eqNullSafe(part[id_key]) & (rows[own] == part[hash_key])
        joined = rows.join(part.hint("shuffle_hash"), same)
        times = F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))).alias(copy)
        return joined.select(*[rows[c] for c in documents.columns], times).drop(copy)

    single = F.col(equal) == 1
    mix = repeated(taken.where(single), hashed)
    if not taken.where(~single).isEmpty():
        some = taken.where(~single)
        same = hashed["doc_id"].eqNullSafe(some[id_key]) & (hashed[own] == some[hash_key])
        once = hashed.join(some.hint("shuffle_hash"), same, "left_semi").dropDuplicates(["doc_id", own])
        mix = mix.unionByName(repeated(some, once))
    return mix


def hashed_columns(documents: DataFrame) -> list[str]:
    """Columns that Spark can hash."""
    return [c for c, kind in documents.dtypes if "map<" not in kind and "variant" not in kind]


def mix_report(documents: DataFrame) -> DataFrame:
    plan = copies(documents)
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
