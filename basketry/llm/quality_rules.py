"""Quality rules: surface counts, and a likelihood ratio between trusted and raw text.

Lower-cased words and word pairs are hashed into buckets. Their counts over all trusted documents
and over all documents give two multinomials; a document's score is the sum of log ratios of its
n-grams, divided by their number. Every document is held against the same fixed threshold.

Defined results: null text has no words; a text without words fails the base rules and scores 0;
lines without words are no duplicates; rows that repeat give repeated results and count each time;
an empty table gives no rows; trusted ids that repeat count once, null ids never; other columns are
ignored. Texts of any length are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.bitmaps import bitmap, passes
from basketry.llm.words import SEPARATOR, Hasher, Slice, Words, batch, mixed, per_row, space_words, text_slices, windows
from basketry.session import stored

BUCKETS = 1 << 16
THRESHOLD = -0.2
LEAST_WORDS = 20
MOST_REPEATED = 30
WINDOW = 8
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))


COUNTS = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])


def row_sums(inside: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of each row's bytes are marked."""
    total = np.zeros(len(inside) + 1, np.int64)
    np.cumsum(inside, out=total[1:])
    return total[offsets[1:] - offsets[0]] - total[offsets[:-1] - offsets[0]]


def repeated_words(words: Words, rows: int, size: int = WINDOW) -> np.ndarray:
    """Words that lie in windows found at least twice in their row, the first find included."""
    row, at, found = windows(words, size)
    keys = found ^ mixed(row.astype(np.uint64))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    depth = np.zeros(len(words.row) + 1, np.int64)
    np.add.at(depth, at[twice], 1)
    np.add.at(depth, at[twice] + size, -1)
    return per_row(words.row[np.cumsum(depth)[:-1] > 0], rows)


def duplicate_lines(piece: Slice) -> np.ndarray:
    """Lines with a word that equal an earlier line of their row."""
    raw, at = piece.data.tobytes(), piece.offsets - piece.offsets[0]
    found = np.zeros(len(at) - 1, np.int64)
    for i in range(len(found)):
        lines = raw[at[i] : at[i + 1]].split(b"\n")
        if len(lines) > 1 and len(distinct := set(lines)) < len(lines):
            blank = sum(1 for x in lines if not x.split())
            found[i] = len(lines) - blank - sum(1 for x in distinct if x.split())
    return found


def surface(piece: Slice, hasher: Hasher) -> dict[str, np.ndarray]:
    """The counts that the base rules read, by row."""
    n = piece.last - piece.first
    words = space_words(piece, hasher, lower=False)
    code_points = (piece.data & 0xC0) != 0x80
    return {
        "n_words": per_row(words.row, n),
        "word_chars": row_sums(code_points & ~SEPARATOR[piece.data], piece.offsets),
        "n_symbols": row_sums(SYMBOLS[piece.data], piece.offsets),
        "n_dup_lines": duplicate_lines(piece),
        "n_repeat_words": repeated_words(words, n),
    }


def gram_buckets(piece: Slice, hasher: Hasher, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every word and word pair; the two orders have a half of the buckets each."""
    words = space_words(piece, hasher)
    row, _, pairs = windows(words, 2)
    half = np.uint64(buckets // 2)
    ones = (words.hash % half).astype(np.int64)
    twos = (pairs % half).astype(np.int64) + buckets // 2
    return np.concatenate([words.row, row]), np.concatenate([ones, twos])


def gram_counts(documents: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: counts over all texts, added up in every task before the shuffle."""

    def run(batches):
        hasher, counts = Hasher(), np.zeros(buckets, np.int64)
        for rows in batches:
            for piece in text_slices(rows.column(0)):
                counts += np.bincount(gram_buckets(piece, hasher, buckets)[1], minlength=buckets)
        used = np.flatnonzero(counts)
        yield batch(COUNTS, used, counts[used])

    return documents.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def trusted_counts(documents: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: counts over the texts of trusted documents.

    Tasks count each document that a bitmap of the trusted ids lets through; those counts, not the
    texts, are shuffled to the join with the ids, which decides.
    """
    doc_id = F.col("doc_id").cast("bigint")
    ids = stored(trusted.select(doc_id.alias("doc_id")).where("doc_id IS NOT NULL").distinct(), "trusted")
    key = F.xxhash64(doc_id).alias("key")
    mask = documents.sparkSession.sparkContext.broadcast(bitmap(ids.select(key), "key"))
    schema = pa.schema([("doc_id", pa.int64()), ("grams", pa.binary())])
    width = "<u2" if buckets <= 1 << 16 else "<u4"

    def send(batches):
        hasher = Hasher()
        for rows in batches:
            chosen = rows.filter(pa.array(passes(mask.value, rows.column(1).to_numpy())))
            for piece in text_slices(chosen.column(2)):
                n = piece.last - piece.first
                row, bucket = gram_buckets(piece, hasher, buckets)
                order = np.lexsort((bucket, row))
                ends = np.cumsum(per_row(row, n)).tolist()
                sent = bucket[order].astype(width)
                grams = [sent[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                yield batch(schema, chosen.column(0).slice(piece.first, n).cast(pa.int64()), grams)

    def add(batches):
        counts = np.zeros(buckets, np.int64)
        for rows in batches:
            grams = b"".join(rows.column(0).to_pylist())
            counts += np.bincount(np.frombuffer(grams, width), minlength=buckets)
        used = np.flatnonzero(counts)
        yield batch(COUNTS, used, counts[used])

    sent = documents.select("doc_id", key, "text").mapInArrow(send, "doc_id bigint, grams binary")
    target = sent.join(ids.hint("shuffle_hash"), "doc_id", "left_semi").select("grams")
    return target.mapInArrow(add, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def log_ratios(documents: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """log p(trusted) - log p(raw) by bucket, one added to every count. At most ``buckets`` rows are collected."""
    both = trusted_counts(documents, trusted, buckets).withColumnRenamed("n", "target").join(
        gram_counts(documents, buckets).withColumnRenamed("n", "raw"), "bucket", "full_outer"
    )
    counts = np.zeros((2, buckets))
    found = both.na.fill(0).toPandas()
    counts[0, found.bucket], counts[1, found.bucket] = found.target, found.raw
    # Each order is a multinomial of its own.
    ratios = np.zeros(buckets)
    for part in (slice(0, buckets // 2), slice(buckets // 2, buckets)):
        p, q = (counts[k, part] + 1 for k in (0, 1))
        ratios[part] = np.log(p / p.sum()) - np.log(q / q.sum())
    return ratios


FOUND = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
     ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
     ("ratio", pa.float64())]
)
FOUND_DDL = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, ratio double"
)


def judge(documents: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """One row a document: surface counts, the ratio per n-gram and whether it is kept.

    ``trusted``: doc_id of the documents whose wording is the target. Without any, both
    multinomials are near flat or equal, and the rules alone decide.
    """
    spark = documents.sparkSession
    ratios = spark.sparkContext.broadcast(log_ratios(documents, trusted, buckets))  # 8 bytes a bucket

    def run(batches):
        hasher, weights = Hasher(), ratios.value
        for rows in batches:
            ids = rows.column(0).cast(pa.int64())
            for piece in text_slices(rows.column(1)):
                n = piece.last - piece.first
                found = surface(piece, hasher)
                row, bucket = gram_buckets(piece, hasher, buckets)
                grams = np.maximum(per_row(row, n), 1)
                ratio = np.bincount(row, weights[bucket], minlength=n)[:n] / grams
                words = found["n_words"]
                failed = (words < LEAST_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED * words)
                yield batch(FOUND, ids.slice(piece.first, n), *found.values(), failed, ~failed & (ratio >= threshold), ratio)

    return documents.select("doc_id", "text").mapInArrow(run, FOUND_DDL)


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1").select("doc_id")
