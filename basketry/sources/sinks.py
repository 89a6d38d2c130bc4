"""Table writes: overwrite, lookup layout, keyed replace."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overwrite(df: DataFrame, path: str) -> None:
    """Replace the whole table at ``path``."""
    df.write.mode("overwrite").parquet(path)


def second_keys(columns: Iterable[str]) -> dict[str, str]:
    """Write options: Bloom filters by which a read by other columns than the sorted ones skips row groups."""
    options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return options | ({"parquet.bloom.filter.adaptive.enabled": "true"} if options else {})


def overwrite_for_lookup(
    df: DataFrame, path: str, *keys: str, files: int | None = None, also: Iterable[str] = ()
) -> None:
    """Replace the table, range-partitioned and sorted by ``keys``; ``also`` names columns of other point reads.

    Each file then covers a narrow key range, so a point read skips all other files by their
    parquet statistics. Listing further columns after the lookup key lets the ranges split
    inside one hot key.
    """
    parts = [files, *keys] if files else list(keys)
    ranged = df.repartitionByRange(*parts).sortWithinPartitions(*keys)
    ranged.write.mode("overwrite").options(**second_keys(also)).parquet(path)


def sharded(df: DataFrame, shards: int, key: str = "userId") -> DataFrame:
    """Adds ``shard``, a hash of the key, to partition a table by."""
    return df.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(shards)).cast("int"))


def overwrite_sharded(df: DataFrame, path: str, *keys: str, files: int | None = None) -> None:
    """Replace the table, one folder per shard, sorted by ``keys`` inside.

    A join that includes the shard reads only the folders its other side needs. Ranges over shard
    and keys let one hot key spread over several files.
    """
    order = ["shard", *keys]
    parts = [files, *order] if files else order
    ranged = df.repartitionByRange(*parts).sortWithinPartitions(*order)
    ranged.write.mode("overwrite").partitionBy("shard").parquet(path)


def replace_rows(current: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``current`` with every row whose key occurs in ``new`` replaced by the new rows."""
    kept = current.join(new.select(key), key, "left_anti")
    return kept.unionByName(new)
