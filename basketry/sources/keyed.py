"""Tables of keyed rows that take in changes without being rewritten.

Rows lie in folders by version and shard, a hash of the first key. A batch of changes adds a folder for
each shard it touches and reads nothing. Readers take the folders that the newest list of live folders
names and let the newest row of a changed key win. A shard with many folders is rewritten into one, by
itself. So a batch costs what it holds, a look-up reads the shards of its keys, and the number of files
is bounded by shards and ``most``.

A version is taken in once: repeating it changes nothing. Readers of a list of live folders have until
the second commit after it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.session import LOCAL_ROWS, children, read_text, remove, write_text
from basketry.sources.sinks import second_keys, sharded

# Look-ups of so many keys name them to the file scan, which then skips row groups; more are joined.
NAMED_KEYS = 1000
FEW_FOLDERS = 16
# Folders of changes that a shard may have before it is rewritten.
MOST = 8


def asked_for(ids: DataFrame, column: str, shards: int) -> tuple[list[int], Column | None]:
    """The shards that some ids lie in, and a condition that names the ids if they are few.

    At most ``NAMED_KEYS`` ids and ``shards`` numbers come to the driver. Many ids have to be joined.
    """
    asked = sharded(ids.select(column), shards, column)
    # Repeated ids are not taken out first: that would cost a shuffle, and a local table needs no job at all.
    some = asked.limit(NAMED_KEYS + 1).collect()
    if len(some) <= NAMED_KEYS:
        return sorted({r["shard"] for r in some}), F.col(column).isin(sorted({r[column] for r in some if r[column] is not None}))
    return sorted(r["shard"] for r in asked.select("shard").distinct().collect()), None


def looked_up(spark: SparkSession, path: str, schema: str, ids: DataFrame, column: str, shards: int) -> DataFrame:
    """The rows of some ids, from a table partitioned by ``shard`` of the column and sorted by it.

    Only the folders of their shards are listed.
    """
    numbers, named = asked_for(ids, column, shards)
    there = [f"{path}/shard={n}" for n in numbers]
    if len(there) > FEW_FOLDERS:
        there = [f"{path}/{name}" for name in children(spark, path) if name in {f"shard={n}" for n in numbers}]
    else:
        there = [folder for folder in there if children(spark, folder)]
    if not there:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", path).parquet(*there)
    return found.where(named) if named is not None else found.join(ids.select(column).distinct(), column, "left_semi")


class KeyedTable:
    """Rows with one winner a key among changes: the greatest by the columns ``newest``, then the latest version.

    Rows that :meth:`load` wrote stay as they are until their key changes. ``also`` names keys beside the first
    that rows are looked up by.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], newest: tuple[str, ...] = (), also: tuple[str, ...] = ()):
        self.spark, self.path, self.schema, self.keys, self.newest, self.also = spark, path, schema, keys, newest, also
        self.values = [c for c in schema.names if c not in keys]

    # ---- lists of live folders, one small file a commit, numbered 2 * version, plus 1 after rewriting shards

    def _commits(self) -> list[int]:
        return sorted(int(x) for x in children(self.spark, f"{self.path}/live") if x.isdigit())

    def _live(self, commit: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.path}/live/{commit}"))

    def _commit(self, number: int, shards: int, folders: list[list[int]]) -> None:
        write_text(self.spark, f"{self.path}/live/{number}", json.dumps({"shards": shards, "folders": sorted(folders)}))
        commits = self._commits()
        for old in commits[:-2]:
            still = [tuple(f) for c in commits[-2:] for f in self._live(c)["folders"]]
            for version, whole, shard in {tuple(f) for f in self._live(old)["folders"]}.difference(still):
                remove(self.spark, f"{self.path}/data/version={version}/whole={whole}/shard={shard}")
            remove(self.spark, f"{self.path}/live/{old}")

    def version(self) -> int:
        """The last version taken in, 0 for none."""
        return max(self._commits(), default=0) // 2

    def shards(self) -> int:
        return self._live(self._commits()[-1])["shards"]

    def folders(self) -> list[list[int]]:
        """[version, whole, shard] of every folder that readers take."""
        commits = self._commits()
        return self._live(commits[-1])["folders"] if commits else []

    # ---- writing

    def _write(self, rows: DataFrame, version: int, whole: int, shards: int, ranges: bool) -> list[list[int]]:
        target = f"{self.path}/data/version={version}/whole={whole}"
        own = sharded(rows.select(*self.schema.names), shards, self.keys[0])
        order = ["shard", *self.keys]
        # Ranges let a large shard spread over tasks; a small batch of changes has one file a shard.
        dealt = own.repartitionByRange(*order) if ranges else self._in_order(own, order)
        writer = dealt.sortWithinPartitions(*order).write.mode("overwrite").partitionBy("shard")
        # A batch of changes is too small to be worth the filters.
        writer.options(**second_keys(self.also if whole else ())).parquet(target)
        found = [x.partition("=")[2] for x in children(self.spark, target) if x.startswith("shard=")]
        return [[version, whole, int(x)] for x in found]

    @staticmethod
    def _in_order(own: DataFrame, order: list[str]) -> DataFrame:
        """A small batch as a local table by shard; a large one dealt by ranges, as it has more rows than tasks should be shards."""
        found = own.limit(LOCAL_ROWS + 1).toArrow()
        if found.num_rows > LOCAL_ROWS:
            return own.repartitionByRange(*order)
        return own.sparkSession.createDataFrame(found.sort_by("shard"), own.schema)

    def load(self, rows: DataFrame, shards: int) -> None:
        """Replaces the table by rows that need not have one row a key."""
        remove(self.spark, self.path)
        self._commit(2, shards, self._write(rows, 1, 1, shards, True))

    def append(self, rows: DataFrame, version: int, shards: int | None = None) -> None:
        """Takes in changed rows as a version greater than all before; one that is there already is left."""
        if version <= self.version():
            return
        commits = self._commits()
        before = self._live(commits[-1]) if commits else {"shards": shards, "folders": []}
        added = self._write(rows, version, 0, before["shards"], False)
        self._commit(2 * version, before["shards"], before["folders"] + added)

    def compact(self, most: int = MOST) -> int:
        """Rewrites the shards with more than ``most`` folders of changes, and tells how many these were."""
        commits = self._commits()
        live = self._live(commits[-1]) if commits else {"folders": []}
        changes = [shard for _, whole, shard in live["folders"] if not whole]
        large = sorted({s for s in changes if changes.count(s) > most})
        if large and commits[-1] % 2 == 0:
            version = commits[-1] // 2
            rows = self._read([f for f in live["folders"] if f[2] in large])
            made = self._write(rows, version, 1, live["shards"], True)
            kept = [f for f in live["folders"] if f[2] not in large]
            self._commit(commits[-1] + 1, live["shards"], kept + made)
        return len(large)

    # ---- reading

    def _scan(self, folders: list[list[int]]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, *(T.StructField(c, T.IntegerType()) for c in ("version", "whole", "shard"))])
        root = f"{self.path}/data"
        paths = [f"{root}/version={v}/whole={w}/shard={s}" for v, w, s in folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", root).parquet(*paths)

    def _read(self, folders: list[list[int]], condition: Column | None = None) -> DataFrame:
        whole, changes = (self._scan([f for f in folders if f[1] == w]) for w in (1, 0))
        if condition is not None:
            whole, changes = whole.where(condition), changes.where(condition)
        if all(f[1] for f in folders):
            return whole.select(*self.schema.names)
        changed = changes.select(*self.keys).distinct()
        scalar = [f.name for f in self.schema.fields if f.name in self.values and not isinstance(f.dataType, T.ArrayType)]
        order = F.struct(*self.newest, "version", *[c for c in scalar if c not in self.newest])
        every = whole.join(changed, self.keys, "left_semi").unionByName(changes)
        won = every.groupBy(*self.keys).agg(F.max_by(F.struct(*self.values), order).alias("won")).select(*self.keys, "won.*")
        return whole.join(changed, self.keys, "left_anti").select(*self.schema.names).unionByName(won.select(*self.schema.names))

    def read(self) -> DataFrame:
        return self._read(self.folders())

    def changes(self, version: int) -> DataFrame:
        """The rows that a version took in."""
        return self._scan([f for f in self.folders() if f[0] == version and not f[1]]).select(*self.schema.names)

    def lookup_other(self, ids: DataFrame, column: str) -> DataFrame:
        """The rows of some values of another key; row groups whose Bloom filters rule them all out are skipped."""
        if column not in self.keys:
            raise ValueError(f"{column} is no key")
        some = ids.select(column).distinct()
        few = [r[0] for r in some.limit(NAMED_KEYS + 1).collect()]
        if len(few) > NAMED_KEYS:
            return self.read().join(some, column, "left_semi")
        return self._read(self.folders(), F.col(column).isin(sorted(x for x in few if x is not None)))

    def lookup(self, ids: DataFrame) -> DataFrame:
        """The rows of some values of the first key; only their shards are read."""
        key = self.keys[0]
        numbers, named = asked_for(ids, key, self.shards())
        found = self._read([f for f in self.folders() if f[2] in set(numbers)], named)
        return found if named is not None else found.join(ids.select(key).distinct(), key, "left_semi")
