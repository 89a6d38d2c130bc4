"""Near-duplicate groups by min-max hashing.

Every document's set of five-word shingles keeps, under each of ``HASHES`` permutations, both its
minimum and its maximum. The 2 x ``HASHES`` values are banded (minima and maxima of one permutation
fall into different bands), so half the hash evaluations of plain MinHash serve the same bands. A
pair at the least similarity shares a band with probability 1 - 2.5e-6.

Bands only propose. Documents with equal sets are one class from the start. The classes that share a
bucket form the group of the bucket's hub; a group is compared in parts of at most ``PART`` classes,
on full sets, where each class is compared with the hub and, unless it is linked with it by then,
with all others of the part. Groups of more than one part that do not end up connected are compared
across parts too, a block of the unconnected classes against every part, so no proposed pair between
different components goes unchecked. No pair of copies is ever listed.

Defined results: null and blank texts have no shingles and are linked with nothing; a text of fewer
than five words is one shingle; links are 100 * intersection >= ``PERCENT`` * union; the class id
is the smallest doc_id, null last; rows that repeat fall into one class, each with its row; an empty
table gives no rows; other columns are ignored. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.bitmaps import bitmap, passes
from basketry.llm.words import Hasher, Slice, mixed, per_row, released, space_words, text_slices, unused, windows
from basketry.session import stored

SHINGLE = 5
PERCENT = 85
HASHES = 55
BAND = 5
SEED = 11
PART = 256


def row_key(doc_id: Column, text: Column) -> Column:
    """Names a row by its id and text; rows that repeat share the name."""
    parts = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.unhex(F.md5(parts))


def shingle_sets(piece: Slice, hasher: Hasher, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every row's distinct shingles, sorted by row and hash."""
    words = space_words(piece, hasher)
    count = per_row(words.row, piece.last - piece.first)
    row, _, found = windows(words, size)
    parts = [(row, found)]
    for n in range(1, size):
        if (count == n).any():
            row, _, found = windows(words, n)
            at = count[row] == n
            parts.append((row[at], mixed(found[at] + np.uint64(n))))
    row, found = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    return row[fresh], found[fresh]


def signatures(found: np.ndarray, starts: np.ndarray, hashes: int = HASHES, seed: int = SEED) -> np.ndarray:
    """Minima, then maxima, under each permutation; one column a set. ``starts``: where each set begins."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, hashes, dtype=np.uint64)
    kept = np.empty((2 * hashes, len(starts)), np.uint64)
    for k in range(hashes):
        values = found * factors[k]
        values ^= values >> np.uint64(31)
        values *= shifts[k] | np.uint64(1)
        kept[k] = np.minimum.reduceat(values, starts)
        kept[hashes + k] = np.maximum.reduceat(values, starts)
    return kept


def band_keys(kept: np.ndarray, band: int = BAND) -> np.ndarray:
    """One key per set and band, from ``band`` neighbouring values."""
    keys = np.empty((kept.shape[1], len(kept) // band), np.uint64)
    for b in range(keys.shape[1]):
        total = np.full(kept.shape[1], b + 1, np.uint64)
        for v in kept[b * band : (b + 1) * band]:
            total = mixed(total ^ v) + np.uint64(b)
        keys[:, b] = total
    return keys


SKETCH = pa.schema(
    [("doc_id", pa.int64()), ("node", pa.binary()), ("n_shingles", pa.int64()), ("same", pa.binary()), ("bands", pa.list_(pa.int64()))]
)


def sketches(documents: DataFrame) -> DataFrame:
    """Per row: its name, number of shingles, a 128-bit digest of the set, and band keys."""

    def run(batches):
        hasher = Hasher()
        for rows in batches:
            for piece in text_slices(rows.column(2)):
                n = piece.last - piece.first
                row, found = shingle_sets(piece, hasher)
                count = per_row(row, n)
                held = np.flatnonzero(count)
                same, bands = [None] * n, [None] * n
                if len(held):
                    starts = np.concatenate([[0], np.cumsum(count[held])[:-1]])
                    digest = np.stack(
                        [np.add.reduceat(mixed(found ^ np.uint64(c)), starts) for c in (0x51ED27, 0xA3B195)], 1
                    )
                    keys = band_keys(signatures(found, starts)).view(np.int64)
                    for i, r in enumerate(held):
                        same[r], bands[r] = digest[i].tobytes(), keys[i]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).slice(piece.first, n).cast(pa.int64()), rows.column(1).slice(piece.first, n).cast(pa.binary()),
                     pa.array(count, pa.int64()), pa.array(same, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    schema=SKETCH,
                )

    named = documents.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("node"), "text")
    return named.mapInArrow(released(run), "doc_id bigint, node binary, n_shingles bigint, same binary, bands array<bigint>")


def by_group(batches) -> Iterator[list[tuple]]:
    """Rows (hub, part, node, ...) in order, as lists of one (hub, part) each; repeated nodes once."""
    held: list[tuple] = []
    for rows in batches:
        for row in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            if held and row[:2] != held[-1][:2]:
                yield held
                held = []
            if not held or row[2] != held[-1][2]:
                held.append(row)
    if held:
        yield held


class Part:
    """The full sets of some classes, compared one against all."""

    def __init__(self, texts: list, hasher: Hasher, percent: int = PERCENT):
        rows, found = [], []
        for piece in text_slices(pa.array(texts, pa.large_string())):
            row, h = shingle_sets(piece, hasher)
            rows.append(row + piece.first)
            found.append(h)
        self.row, self.found = np.concatenate(rows), np.concatenate(found)
        self.count = per_row(self.row, len(texts))
        self.ends = np.cumsum(self.count)
        self.percent = percent
        self.parent = list(range(len(texts)))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j

    def similar(self, i: int) -> np.ndarray:
        """All others that are linked with class i."""
        own = self.found[self.ends[i] - self.count[i] : self.ends[i]]
        close = (100 * self.count >= self.percent * len(own)) & (100 * len(own) >= self.percent * self.count)
        close[i] = False
        if not len(own) or not close.any():
            return np.zeros(0, np.int64)
        pick = close[self.row]
        row, found = self.row[pick], self.found[pick]
        at = np.minimum(np.searchsorted(own, found), len(own) - 1)
        shared = per_row(row[own[at] == found], len(self.count))
        return np.flatnonzero(close & (100 * shared >= self.percent * (self.count + len(own) - shared)))


def confirm_task(percent: int):
    """Task: groups of (hub, part, node, text, class, pivot) to links between classes not yet connected.

    Pivots are compared with all. Groups without known classes are a hub's first comparison: the hub
    comes first, then whoever is not connected with it.
    """
    links = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches):
        hasher = Hasher()
        for rows in by_group(batches):
            part, found = Part([r[3] for r in rows], hasher, percent), []
            seen: dict[bytes, int] = {}
            for i, r in enumerate(rows):
                if r[4] is not None:
                    part.join(seen.setdefault(r[4], i), i)

            def compare(i: int, rows=rows, part=part, found=found) -> None:
                found += [(rows[i][2], rows[j][2]) for j in part.similar(i) if part.join(i, int(j))]

            if rows[0][4] is not None:
                for i, r in enumerate(rows):
                    if r[5]:
                        compare(i)
            else:
                hub = next(i for i, r in enumerate(rows) if r[2] == r[0])
                compare(hub)
                for i in range(len(rows)):
                    if part.root(i) != part.root(hub):
                        compare(i)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found, strict=True)], schema=links)

    return run


def texts_of(documents: DataFrame, groups: DataFrame) -> DataFrame:
    """node, text of the rows that a bitmap of the groups' nodes lets through; only these are shuffled."""
    key = F.xxhash64("node").alias("key")
    mask = documents.sparkSession.sparkContext.broadcast(bitmap(groups.select(key), "key"))

    def run(batches):
        for rows in batches:
            chosen = rows.filter(pa.array(passes(mask.value, rows.column(1).to_numpy())))
            yield pa.RecordBatch.from_arrays([chosen.column(0), chosen.column(2)], names=["node", "text"])

    named = documents.select(row_key(F.col("doc_id"), F.col("text")).alias("node"), "text")
    return named.select("node", key, "text").mapInArrow(released(run), "node binary, text string")


def confirmed(groups: DataFrame, documents: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) within groups (hub, part, node, class, pivot), on full sets."""
    groups = stored(groups, "groups")
    # The groups' side of a partition is small; the texts need no sort.
    with_text = texts_of(documents, groups).join(groups.hint("shuffle_hash"), "node").select("hub", "part", "node", "text", "class", "pivot")
    dealt = with_text.repartition("hub", "part").sortWithinPartitions("hub", "part", "node")
    return dealt.mapInArrow(released(confirm_task(percent)), "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node of every connected component, by alternating stars."""

    def star(edges: DataFrame, upward: bool) -> DataFrame:
        """Large star: neighbours above a node move to the smallest neighbour; small star: those below."""
        both = edges if not upward else edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("least"))
        least = least.withColumn("least", F.least("least", "of"))
        joined = both.join(least, F.col("a") == F.col("of"))
        if upward:
            moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        else:
            moved = joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
        return moved.where("a <> b").distinct()

    # Every edge points from the larger to the smaller node.
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    while not are_stars(edges):
        edges = stored(star(star(edges, True), False), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def are_stars(edges: DataFrame) -> bool:
    """Whether every node points to one other at most, and none of those points further."""
    if not edges.groupBy("a").count().where("count > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty()


def parts_of(members: DataFrame) -> DataFrame:
    """(hub, node) dealt into parts of about PART nodes of a hub, with the number of parts."""
    counts = members.groupBy("hub").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    return members.join(counts, "hub").select("hub", part.alias("part"), "node", "parts")


def near_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, and node (see ``row_key``) of every row."""
    rows = stored(sketches(documents), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node"))
    sets = rows.where("n_shingles > 0").groupBy("same").agg(first.alias("first"), F.first("bands").alias("bands"))
    sets = stored(sets.select("same", "first.node", "first.doc_id", "bands"), "sets")
    entries = sets.select(F.explode("bands").alias("key"), "node")
    hubs = entries.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1")
    members = entries.join(hubs, "key").where("node <> hub").select("hub", "node").distinct()
    dealt = stored(parts_of(members), "members")
    none = F.lit(None).cast("binary").alias("class")
    heads = dealt.select("hub", "part", F.col("hub").alias("node")).distinct()
    groups = dealt.select("hub", "part", "node").union(heads).select("*", none, F.lit(False).alias("pivot"))
    links = stored(confirmed(groups, documents, percent), "links")
    found = components(links)
    split = dealt.where("parts > 1")
    if not split.isEmpty():
        found = stored(found, "components")
        across = across_parts(split, found)
        if across is not None:
            more = stored(confirmed(across, documents, percent), "links")
            if not more.isEmpty():
                found = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    roots = sets.select("same", "node", "doc_id").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node")
    chosen = roots.groupBy("root").agg(F.min(order).alias("chosen"))
    classes = roots.select("same", "root").join(chosen, "root").select(
        "same", F.col("chosen.doc_id").alias("component_id"), F.col("chosen.node").alias("representative")
    )
    alone = F.col("n_shingles") == 0
    return rows.select("doc_id", "node", "n_shingles", "same").join(classes, "same", "left").select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | (F.col("node") == F.col("representative"))).alias("kept"),
        "node",
    )


def deduplicated(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each class, with all its columns; rows that are linked with nothing all stay."""
    found = near_duplicates(documents, percent).where("kept")
    kept = stored(found.groupBy("node").agg(F.max("n_shingles").alias("n_shingles"), F.count("*").alias("rows")), "kept")
    name = unused([*documents.columns, "rows", "n_shingles"], "row_name")
    named = documents.withColumn(name, row_key(F.col("doc_id"), F.col("text")))
    once = (F.col("rows") == 1) | (F.col("n_shingles") == 0)

    def chosen(which: Column) -> DataFrame:
        nodes = kept.where(which).select(F.col("node").alias(name))
        return named.join(nodes.hint("shuffle_hash"), name, "left_semi")

    rows = chosen(once)
    if not kept.where(~once).isEmpty():
        rows = rows.unionByName(chosen(~once).dropDuplicates([name]))
    return rows.drop(name)


def across_parts(split: DataFrame, found: DataFrame) -> DataFrame | None:
    """Groups that compare, within a hub of several parts, its unconnected classes with every part."""
    classes = split.join(found, "node", "left").withColumn("class", F.coalesce("root", "node"))
    sizes = classes.groupBy("hub", "class").agg(F.count("*").alias("n"))
    main = sizes.groupBy("hub").agg(F.max_by("class", F.struct("n", "class")).alias("main"), F.count("*").alias("classes"))
    open_hubs = main.where("classes > 1").select("hub", "main")
    members = stored(classes.select("hub", "part", "node", "parts", "class").join(open_hubs, "hub"), "unconnected")
    left = members.where(~F.col("class").eqNullSafe(F.col("main")))
    if left.isEmpty():
        return None
    blocks = left.groupBy("hub").agg(F.ceil(F.count("*") / PART).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")
    # Part of a comparison: the number of a block and of a part.
    pivots = left.join(blocks, "hub").select(
        "hub", "node", "class", F.lit(True).alias("pivot"), block.alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
    )
    others = members.join(blocks, "hub").select(
        "hub", "node", "class", F.lit(False).alias("pivot"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "part",
    )
    both = pivots.unionByName(others).groupBy("hub", "block", "part", "node", "class").agg(F.max("pivot").alias("pivot"))
    pair = (F.col("block").cast("long") * (1 << 32) + F.col("part")).alias("part")
    return both.select("hub", pair, "node", "class", "pivot")
