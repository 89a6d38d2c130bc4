"""Token-id files: documents as compressed id arrays under one shared dictionary.

A file set is a folder with three Parquet tables, written by Spark so that lost tasks are simply
written again:

* ``dictionary``: one row with the dictionary, its SHA-256, the width of an id and the end id;
* ``blocks``: about ``BLOCK_BYTES`` of concatenated zstandard frames a row, one frame a document,
  documents in ascending (doc_id, crc, length) order over shards and blocks. Each block names the
  dictionary hash and lists its documents, frame lengths and first ids, so it can be read alone;
* ``index``: one row a document with shard, block, offset and length of its frame, ids before it in
  the shard, and the dictionary hash, for reading short documents one by one;
* ``shards``: the ids before each shard.

Defined results: null text counts as empty and holds the end id only; a null doc_id sorts first;
rows that repeat a doc_id stay rows of their own; an empty table gives files without documents;
other columns are ignored. A text of any length is one frame, never cut.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import sys
import types
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketry.llm.words import SEPARATOR, Hasher, Slice, lowered, released, runs, text_slices, trim
from basketry.session import fresh_path, stored

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
# The dictionary is trained on the first SAMPLE_IDS ids of SAMPLE_DOCS documents chosen by hash.
SAMPLE_DOCS = 512
SAMPLE_IDS = 4096
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
BLOCK_BYTES = 1 << 20
# Each Python worker keeps the ids of so many pieces, and of so many bytes in all, then starts over.
KNOWN_PIECES = 2_000_000
KNOWN_BYTES = 48 << 20

FRAMES = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("crc", pa.int64()), ("seq", pa.int64()), ("frame", pa.binary())])
BLOCKS = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("n_tokens", pa.int64()), ("dictionary_sha256", pa.string()),
     ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
     ("lengths", pa.list_(pa.int64())), ("data", pa.binary())]
)
DICTIONARY_DDL = "sha256 string, data binary, width string, end_id int"
SHARDS_DDL = "shard int, n_tokens bigint, before bigint"
INDEX_DDL = "shard int, block int, dictionary_sha256 string, doc_id bigint, start bigint, offset bigint, length bigint"
READ = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def ddl(schema: pa.Schema) -> str:
    names = {"int64": "bigint", "int32": "int", "double": "double", "bool": "boolean"}

    def name(kind) -> str:
        return f"array<{name(kind.value_type)}>" if pa.types.is_list(kind) else names.get(str(kind), str(kind))

    return ", ".join(f"{f.name} {name(f.type)}" for f in schema)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Known:
    """Id lists and bytes of pieces by 64-bit hash: sorted keys with places in two pools, and a smaller sorted part for new ones.

    Who finds a piece compares its bytes, as others may have its hash.
    """

    def __init__(self, width: str):
        self.pool, self.used = np.zeros(1 << 16, width), 0
        self.letters, self.written = np.zeros(1 << 18, np.uint8), 0
        self.parts = [self._empty(), self._empty()]

    @staticmethod
    def _empty() -> tuple[np.ndarray, ...]:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(4))

    def __len__(self) -> int:
        return sum(len(p[0]) for p in self.parts)

    @property
    def size(self) -> int:
        """Bytes in use."""
        return self.used * self.pool.itemsize + self.written + sum(x.nbytes for p in self.parts for x in p)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """By key: place and number of the ids, place and number of the bytes; the numbers are -1 for unknown ones."""
        found = np.full((4, len(keys)), -1, np.int64)
        for known, *values in self.parts:
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[at] == keys
                for row, value in zip(found, values, strict=True):
                    row[hit] = value[at[hit]]
        return found

    def add(self, keys: np.ndarray, lists: list[np.ndarray], words: list[bytes]) -> None:
        """New keys in ascending order with their ids and bytes."""
        lengths, sizes = (np.array([len(x) for x in of], np.int64) for of in (lists, words))
        while self.used + int(lengths.sum()) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.written + int(sizes.sum()) > len(self.letters):
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        places, starts = self.used + np.cumsum(lengths) - lengths, self.written + np.cumsum(sizes) - sizes
        self.pool[self.used : self.used + int(lengths.sum())] = np.concatenate(lists)
        self.letters[self.written : self.written + int(sizes.sum())] = np.frombuffer(b"".join(words), np.uint8)
        self.used, self.written = self.used + int(lengths.sum()), self.written + int(sizes.sum())
        self.parts[1] = self._merged(self.parts[1], (keys, places, lengths, starts, sizes))
        if 8 * len(self.parts[1][0]) > len(self.parts[0][0]):
            self.parts = [self._merged(*self.parts), self._empty()]

    @staticmethod
    def _merged(old: tuple, new: tuple) -> tuple:
        order = np.argsort(np.concatenate([old[0], new[0]]), kind="stable")
        return tuple(np.concatenate(x)[order] for x in zip(old, new, strict=True))


class Encoder:
    """Ids of texts as little-endian arrays; equal to encoding each text at once.

    The tokenizer drops white space and looks at runs of letters, single digits and runs of other
    signs one by one, so a text's ids are those of its pieces in turn. Pieces are looked up by hash and
    compared byte by byte; new ones go to the tokenizer together. A-Z are lower-cased before, as the tokenizer's own
    normaliser does. A text that might hold a special token's string goes to it whole.
    """

    def __init__(self, path: str):
        # Spark's tasks fill the cores; threads of each worker would only hold memory of their own. Read at the first batch.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        self.hasher = Hasher()
        self.known = Known(self.width)

    @classmethod
    def of_worker(cls, path: str) -> Encoder:
        """The encoder that this Python worker keeps from task to task."""
        held = sys.modules.setdefault("_basketry_held", types.ModuleType("_basketry_held"))
        if getattr(held, "encoder_path", None) != path:
            held.encoder, held.encoder_path = cls(path), path
        return held.encoder

    def _encoded(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of single pieces. Words of letters alone go many to a call and are told apart again."""
        texts = [w.decode() for w in words]
        found: list = [None] * len(words)
        letters = [i for i, t in enumerate(texts) if t.isalpha()]
        lines = [letters[i : i + 256] for i in range(0, len(letters), 256)]
        encoded = self.tokenizer.encode_batch([" ".join([texts[i] for i in x]) for x in lines], add_special_tokens=False)
        for line, encoding in zip(lines, encoded, strict=True):
            ids = np.array(encoding.ids, self.width)
            starts = np.flatnonzero(np.diff(np.array(encoding.word_ids, np.int64), prepend=-1)).tolist()
            if len(starts) == len(line):
                for i, start, end in zip(line, starts, [*starts[1:], len(ids)], strict=True):
                    found[i] = ids[start:end]
        rest = [i for i, x in enumerate(found) if x is None]
        for i, encoding in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False), strict=True):
            found[i] = np.array(encoding.ids, self.width)
        return found

    def encode(self, piece: Slice) -> list[np.ndarray]:
        """The ids of every row of a slice."""
        row, start, end = pieces(piece)
        data = lowered(piece.data)
        keys, first, which = np.unique(self.hasher.ranges(data, start, end), return_index=True, return_inverse=True)
        found = self.known.find(keys)
        new = np.flatnonzero(found[1] < 0)
        if len(self.known) + len(new) > KNOWN_PIECES or (len(new) and self.known.size > KNOWN_BYTES):
            self.known = Known(self.width)
            new = np.arange(len(keys))
        if len(new):
            raw = data.tobytes()
            words = [raw[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)]
            self.known.add(keys[new], self._encoded(words), words)
            found = self.known.find(keys)
        places, lengths, letters, sizes = found[:, which]
        differs = sizes != end - start
        # Pieces of one size are compared with the known ones of their hash, all bytes of the slice at once.
        own = np.flatnonzero(~differs)
        ends = np.cumsum(sizes[own])
        step = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes[own], sizes[own])
        same = data[np.repeat(start[own], sizes[own]) + step] == self.known.letters[np.repeat(letters[own], sizes[own]) + step]
        differs[own[np.searchsorted(ends, np.flatnonzero(~same), "right")]] = True
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.known.pool[np.repeat(places - (ends - lengths), lengths) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.searchsorted(row, np.arange(piece.last - piece.first + 1))]
        found = [ids[a:b] for a, b in itertools.pairwise(bounds.tolist())]
        mark = np.flatnonzero((piece.data[:-1] == ord("<")) & (piece.data[1:] == ord("|")))
        at = piece.offsets - piece.offsets[0]
        # So does a text with a piece that has another one's hash.
        whole = np.concatenate([np.searchsorted(at, mark, "right") - 1, row[differs]])
        for i in np.unique(whole).tolist():
            text = piece.data[at[i] : at[i + 1]].tobytes().decode()
            found[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width)
        return found


# Bytes of ASCII letters and digits (1) and of ASCII signs but the apostrophe (2).
SIDE = np.zeros(256, np.uint8)
SIDE[list(range(33, 127))] = 2
SIDE[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1
SIDE[ord("'")] = 0


def pieces(piece: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of what the tokenizer can be given alone.

    Words are cut between a letter or digit and a sign; not beside an apostrophe, which may begin a
    contraction, nor beside other characters than ASCII and Latin-1 letters, which may join either.
    """
    data = piece.data
    side = SIDE[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    side[lead] = side[lead + 1] = 1
    cut = np.flatnonzero((side[:-1] + side[1:] == 3) & (side[:-1] * side[1:] == 2)) + 1
    offsets = piece.offsets - piece.offsets[0]
    _, start, end = runs(~SEPARATOR[data], np.unique(np.concatenate([offsets, cut])))
    return np.searchsorted(offsets, start, "right") - 1, start, end


def id_batches(path: str, end_id: int):
    """Task: (doc_id, text) to lists of (doc_id, serialised ids with the end id)."""

    def run(batches):
        encoder = Encoder.of_worker(path)
        end = np.array([end_id], encoder.width)
        for rows in batches:
            for piece in text_slices(rows.column(1)):
                ids = [np.concatenate([x, end]).tobytes() for x in encoder.encode(piece)]
                yield rows.column(0).slice(piece.first, len(ids)), ids, encoder.width
            trim()

    return run


def crc32(ids: bytes, width: str) -> int:
    return zlib.crc32(np.frombuffer(ids, width).astype("<u4").tobytes())


def train_dictionary(documents: DataFrame, path: str, end_id: int = END_ID) -> bytes:
    """The shared dictionary; empty when there is too little to learn from."""
    import zstandard

    sample = documents.select("doc_id", "text").where("length(text) > 0")
    chosen = sample.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    sample = sample.join(F.broadcast(chosen.distinct()), "doc_id")  # at most SAMPLE_DOCS ids
    # A chosen id may stand for many rows: equal ones count once, and the same ones are taken in every run.
    sample = sample.dropDuplicates(["doc_id", "text"]).orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text").limit(SAMPLE_DOCS)
    encoded = id_batches(path, end_id)

    def run(batches):
        for _, arrays, width in encoded(batches):
            size = np.dtype(width).itemsize
            yield pa.RecordBatch.from_arrays([pa.array([x[: SAMPLE_IDS * size] for x in arrays], pa.binary())], names=["ids"])

    rows = sample.mapInArrow(released(run), "ids binary").collect()
    samples = sorted(bytes(r.ids) for r in rows)
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 8), samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def compressor(dictionary: bytes):
    import zstandard

    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def decompressor(dictionary: bytes):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def encode_frames(documents: DataFrame, path: str, dictionary: bytes, end_id: int = END_ID) -> DataFrame:
    """One compressed frame a document. ``seq`` tells rows apart that are equal in all else."""
    encoded = id_batches(path, end_id)

    def run(batches):
        pack, seq = compressor(dictionary), TaskContext.get().partitionId() << 40
        for ids, arrays, width in encoded(batches):
            size = np.dtype(width).itemsize
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array([len(x) // size for x in arrays], pa.int64()),
                 pa.array([crc32(x, width) for x in arrays], pa.int64()),
                 pa.array(range(seq, seq + len(arrays)), pa.int64()),
                 pa.array([pack.compress(x) for x in arrays], pa.binary())],
                schema=FRAMES,
            )
            seq += len(arrays)

    return documents.select("doc_id", "text").mapInArrow(released(run), ddl(FRAMES))


def block_task(sha256: str):
    """Task: frames in order to blocks; starts count from the shard's first id."""

    def run(batches):
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []
        size = 0

        def made() -> pa.RecordBatch:
            starts = [start, *(start + x for x in itertools.accumulate(h[1] for h in held))]
            offsets = [0, *itertools.accumulate(len(h[2]) for h in held)]
            lengths = [len(h[2]) for h in held]
            row = (shard, block, starts.pop() - start, sha256, [h[0] for h in held], starts, offsets[:-1], lengths, b"".join(h[2] for h in held))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, BLOCKS.types, strict=True)], schema=BLOCKS)

        for rows in batches:
            for held_row in zip(*(rows.column(i).to_pylist() for i in (0, 1, 4)), strict=True):
                held.append(held_row)
                size += len(held_row[2])
                if size >= BLOCK_BYTES:
                    yield made()
                    start += sum(h[1] for h in held)
                    block, held, size = block + 1, [], 0
        if held:
            yield made()

    return run


def write(documents: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encodes every document and writes the file set into the folder ``path``."""
    spark = documents.sparkSession
    tokenizer = tokenizer or tokenizer_path()
    dictionary = train_dictionary(documents, tokenizer, end_id)
    sha256 = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame(
        [(sha256, bytearray(dictionary), Encoder(tokenizer).width, end_id)], DICTIONARY_DDL
    ).coalesce(1).write.parquet(f"{path}/dictionary")
    # Encoded once and kept, as range partitioning reads its input twice.
    frames = stored(encode_frames(documents, tokenizer, dictionary, end_id), "frames")
    order = ["doc_id", "crc", "n_tokens", "seq"]
    ordered = frames.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(released(block_task(sha256)), ddl(BLOCKS)).write.parquet(f"{path}/blocks")
    blocks = spark.read.schema(ddl(BLOCKS)).parquet(f"{path}/blocks")
    # One row a shard, and as many shards as there were writing tasks.
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"))
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    totals.select("shard", "n_tokens", F.coalesce(before, F.lit(0)).alias("before")).write.parquet(f"{path}/shards")
    entry = F.explode(F.arrays_zip("doc_ids", "starts", "offsets", "lengths"))
    blocks.select("shard", "block", "dictionary_sha256", entry.alias("entry")).select(
        "shard", "block", "dictionary_sha256", F.col("entry.doc_ids").alias("doc_id"),
        F.col("entry.starts").alias("start"), F.col("entry.offsets").alias("offset"),
        F.col("entry.lengths").alias("length"),
    ).write.parquet(f"{path}/index")


class Dictionary(NamedTuple):
    sha256: str
    data: bytes
    width: str


def read_dictionary(spark: SparkSession, path: str) -> Dictionary:
    row = spark.read.schema(DICTIONARY_DDL).parquet(f"{path}/dictionary").first()
    found = Dictionary(row.sha256, bytes(row.data), row.width)
    if hashlib.sha256(found.data).hexdigest() != found.sha256:
        raise ValueError(f"{path}: the dictionary does not have its hash")
    return found


def frames_of(rows: pa.RecordBatch, dictionary: Dictionary, unpack) -> Iterator[tuple]:
    """(doc_id, shard, start in shard, ids as bytes) of every frame of some blocks."""
    names = ("shard", "dictionary_sha256", "doc_ids", "starts", "offsets", "lengths", "data")
    for shard, sha256, ids, starts, offsets, lengths, data in zip(*(rows.column(n).to_pylist() for n in names), strict=True):
        if sha256 != dictionary.sha256:
            raise ValueError("the block was written with another dictionary")
        for doc_id, start, offset, length in zip(ids, starts, offsets, lengths, strict=True):
            yield doc_id, shard, start, unpack.decompress(data[offset : offset + length])


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone."""
    dictionary = read_dictionary(spark, path)

    def run(batches):
        unpack, size = decompressor(dictionary.data), np.dtype(dictionary.width).itemsize
        for rows in batches:
            found = [(d, s, at, len(x) // size, crc32(x, dictionary.width)) for d, s, at, x in frames_of(rows, dictionary, unpack)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found, strict=True), READ.types, strict=True)], schema=READ
            )

    blocks = spark.read.schema(ddl(BLOCKS)).parquet(f"{path}/blocks").drop("block", "n_tokens")
    read = blocks.mapInArrow(released(run), ddl(READ))
    shards = spark.read.schema(SHARDS_DDL).parquet(f"{path}/shards")
    start = (F.col("at") + F.col("before")).alias("start")
    return read.join(shards.select("shard", "before"), "shard").select("doc_id", start, "n_tokens", "ids_crc32")


def read_documents(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """doc_id and ids of the wanted documents; only their frames are unpacked, found by the index."""
    dictionary = read_dictionary(spark, path)
    width, sha256 = dictionary.width, dictionary.sha256

    def run(batches):
        unpack = decompressor(dictionary.data)
        for rows in batches:
            ids, frames, hashes = (rows.column(n).to_pylist() for n in ("doc_id", "frame", "dictionary_sha256"))
            if any(h != sha256 for h in hashes):
                raise ValueError("the block was written with another dictionary")
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()),
                 pa.array([np.frombuffer(unpack.decompress(x), width).astype(np.int32) for x in frames], pa.list_(pa.int32()))],
                names=["doc_id", "ids"],
            )

    entries = spark.read.schema(INDEX_DDL).parquet(f"{path}/index").join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    blocks = spark.read.schema(ddl(BLOCKS)).parquet(f"{path}/blocks").select("shard", "block", "data")
    frame = F.substring("data", F.col("offset").cast("int") + 1, F.col("length").cast("int")).alias("frame")
    found = entries.join(blocks, ["shard", "block"]).select("doc_id", frame, "dictionary_sha256")
    return found.mapInArrow(released(run), "doc_id bigint, ids array<int>")


def token_files(documents: DataFrame) -> DataFrame:
    """Writes the file set into the shared folder and returns the digests read back from it."""
    spark = documents.sparkSession
    path = fresh_path(spark, "token-files")
    write(documents, path)
    return digests(spark, path)
