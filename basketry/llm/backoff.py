"""Stupid-backoff scores of every document under a trigram model of all other documents.

Words are lower-cased (A-Z). Every n-gram of one to ``ORDER`` words of the corpus counts, from one
occurrence on; a document's own occurrences are taken off before it is scored, or every n-gram of a
document would be known. A word scores count(n-gram) / count(its context) at the longest order whose
n-gram another document has, times ``BACKOFF`` for each order given up; single words are shares of
the words of the other documents, and a word that no other document has scores ``BACKOFF`` / number of
words beyond that. The first words of a text have shorter contexts and give up none for it. A document's
score is the sum of log10 over its words.

Documents are dealt into batches of about ``BATCH_BYTES`` by a hash of the row. A batch sends each of its
n-grams once, with its count, as one row for each range of hashes; so a frequent n-gram travels once a batch
and no range grows hot. In a row the hashes stand in order, as gaps. Numbers travel as bytes, all lowest ones first
and all highest ones last, since the shuffle's own compression then takes no room for leading zeros. The
task of a range adds up its count table and joins it to the n-grams it was made from; what other batches have
of them goes back to each batch, which sums its documents up. N-grams are told apart by
hashes of 58 bits only, whose gaps take 5 bytes: of n different ones about n / 2 ** 58 share another's count.

Defined results: null text has no words; a text without words scores 0; rows that repeat are documents of
their own and count for each other; an empty table gives no rows; other columns are ignored. Texts of any
length are read whole. Rows of the same id and text meet in one batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.words import Hasher, per_row, space_words, text_slices, windows

ORDER = 3
BACKOFF = 0.4
BITS = 58
BATCH_BYTES = 1 << 23
RANGE_GRAMS = 1 << 21

SENT_DDL = "range bigint, batch bigint, gaps binary, n binary"
KNOWN_DDL = "range bigint, batch bigint, n binary"
FOUND_DDL = "doc_id bigint, n_words bigint, score double, n_backoff bigint, n_unseen bigint"


def ngrams(texts: pa.ChunkedArray, order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row of every word; for each n up to ``order``, the hashes of the n-grams in reading order."""
    hasher, rows, found = Hasher(), [np.zeros(0, np.int32)], [[np.zeros(0, np.uint64)] for _ in range(order)]
    for piece in text_slices(texts):
        words = space_words(piece, hasher)
        rows.append((words.row + piece.first).astype(np.int32))
        for n, grams in enumerate(found, 1):
            grams.append(windows(words, n)[2] >> np.uint64(64 - BITS))
    return np.concatenate(rows), [np.concatenate(grams) for grams in found]


def ends(row: np.ndarray, n: int) -> np.ndarray:
    """Where the n-grams end."""
    return np.flatnonzero(row[n - 1 :] == row[: max(len(row) - n + 1, 0)]) + n - 1


def pack(numbers: np.ndarray) -> bytes:
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()


def pack_few(numbers: np.ndarray, usual: int) -> bytes:
    """Numbers that are mostly the usual one: a bit for each that is not, then these."""
    others = numbers != usual
    return len(numbers).to_bytes(8, "little") + np.packbits(others).tobytes() + pack(numbers[others])


def unpack_few(data: bytes, usual: int) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    end = 8 + -(-size // 8)
    found = np.full(size, usual, np.int64)
    found[np.unpackbits(np.frombuffer(data[8:end], np.uint8), count=size).astype(bool)] = unpack(data[end:])
    return found


def own_counts(row: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """How often each place's n-gram stands in the place's own row."""
    _, which, n = np.unique(row.astype(np.int64) * (gram.max(initial=0) + 1) + gram, return_inverse=True, return_counts=True)
    return n[which]


def word_logs(row: np.ndarray, counts: list[np.ndarray], total: int, backoff: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log10 of each word, whether it backed off, whether it is unseen; ``counts`` of other documents by order, 0 where none ends."""
    n = np.arange(len(row))
    first = np.searchsorted(row, row)
    longest = np.minimum(n - first + 1, len(counts))
    others = total - (np.searchsorted(row, row, "right") - first)
    value = longest * np.log10(backoff) - np.log10(max(total, 1))
    reached = np.zeros(len(row), np.int64)
    for order, here in enumerate(counts, 1):
        hit = np.flatnonzero(here > 0)
        context = others[hit] if order == 1 else counts[order - 2][hit - 1]
        value[hit] = (longest[hit] - order) * np.log10(backoff) + np.log10(here[hit]) - np.log10(context)
        reached[hit] = order
    return value, reached < longest, reached == 0


def scores(
    documents: DataFrame, order: int = ORDER, backoff: float = BACKOFF, batch_bytes: int = BATCH_BYTES, range_grams: int = RANGE_GRAMS
) -> DataFrame:
    """doc_id, n_words, score (sum of log10), n_backoff (words not known in their longest context), n_unseen (of these, not known at all)."""
    words, size = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.octet_length("text")
    total, size = (x or 0 for x in documents.agg(F.sum(words), F.sum(size)).first())
    batches, ranges = max(1, -(-size // batch_bytes)), max(1, -(-total * order // range_grams))

    def explode(rows):
        grams, n = np.unique(np.concatenate(ngrams(rows.column("text"), order)[1]), return_counts=True)
        # Ranges of the upper 32 bits of the hash, so that each holds a slice of the sorted n-grams.
        place = ((grams >> np.uint64(BITS - 32)) * np.uint64(ranges)) >> np.uint64(32)
        starts = np.flatnonzero(np.diff(place, prepend=np.uint64(ranges)))
        gaps = np.diff(grams, prepend=np.uint64(0))
        gaps[starts] = grams[starts]
        edges = list(zip(starts.tolist(), [*starts[1:].tolist(), len(grams)], strict=False))
        packed = [pack(gaps[i:j]) for i, j in edges], [pack_few(n[i:j], 1) for i, j in edges]
        batch = np.full(len(starts), rows.column("batch")[0].as_py())
        columns = (place[starts].astype(np.int64), batch, *(pa.array(x, pa.binary()) for x in packed))
        return pa.table(columns, names=["range", "batch", "gaps", "n"])

    def count(rows):
        grams = [np.cumsum(unpack(x), dtype=np.uint64) for x in rows.column("gaps").to_pylist()]
        n = np.concatenate([unpack_few(x, 1) for x in rows.column("n").to_pylist()])
        _, which = np.unique(np.concatenate(grams), return_inverse=True)
        others = np.bincount(which, n).astype(np.int64)[which] - n
        answer = [pack_few(x, 0) for x in np.split(others, np.cumsum([len(g) for g in grams])[:-1])]
        return pa.table((rows.column("range"), rows.column("batch"), pa.array(answer, pa.binary())), names=["range", "batch", "n"])

    def finish(rows, known):
        row, found = ngrams(rows.column("text"), order)
        edges = np.cumsum([len(grams) for grams in found])[:-1]
        _, which, n = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
        answers = known.sort_by("range").column("n").to_pylist()
        parts = n + np.concatenate([np.zeros(0, np.int64), *(unpack_few(x, 0) for x in answers)])
        counts = [np.zeros(len(row), np.int64) for _ in range(order)]
        for size, gram in enumerate(np.split(which, edges), 1):
            at = ends(row, size)
            counts[size - 1][at] = parts[gram] - own_counts(row[at], gram)
        value, missed, unseen = word_logs(row, counts, total, backoff)
        sums = [np.bincount(row, x, minlength=rows.num_rows) for x in (value, missed, unseen)]
        columns = (rows.column("doc_id").cast(pa.int64()), per_row(row, rows.num_rows), sums[0].astype(float), sums[1].astype(np.int64), sums[2].astype(np.int64))
        return pa.table(columns, names=["doc_id", "n_words", "score", "n_backoff", "n_unseen"])

    named = documents.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).alias("batch"))
    texts = named.groupBy("batch")
    known = texts.applyInArrow(explode, SENT_DDL).groupBy("range").applyInArrow(count, KNOWN_DDL)
    return texts.cogroup(known.groupBy("batch")).applyInArrow(finish, FOUND_DDL)
