"""Alignment of two tokenizers over whole texts, with corpus-wide counts of linked id pairs.

Both tokenizers encode space+text. Byte offsets where tokens of both end cut the tokens into groups;
every A token of a group is linked to every B token of it. A pair of ids counts once a document.

Counting is external. Tasks gather the pairs of some ``RUN_BYTES`` of text into a run: its distinct
pairs with their number of documents, sorted by radix of the A id, A id, B id, one zstd frame a radix.
The frames of a radix meet in one task, where a k-way heap merge adds up the counts; as the order is
A-major, an A id's highest count is known when its last pair has passed. The counts then stream back
to the runs, frame by frame, and there to the documents, whose links are kept beside their run as
places in its list of pairs. So only distinct pairs of whole runs are shuffled for counting, a pair
that every document holds as often as there are runs, and a task's memory is bounded by a run and by
the pairs of a radix that the two vocabularies can make.

Both tokenizers work on words apart: neither joins what stands before a single space, or line end,
between other signs with what stands after it. So texts are cut there and each distinct piece is
encoded once, its bytes compared as dictionary keys; each cut is also an end of a group.

Defined results: a text that is null or empty, that holds U+2581 or is otherwise not given back by
the tokens of either side, has no tokens; rows that repeat are documents of their own; a null doc_id
is kept; texts of any length are taken whole, their distinct pairs held by one task; an empty table
gives no rows; other columns are ignored. Ids above 65,535 are an error.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import os
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.token_files import ddl, tokenizer_path
from basketry.llm.words import Slice, per_row, text_slices
from basketry.session import fresh_path, stored

SIDE_A, SIDE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
RUN_BYTES = 8 << 20
SLICE_BYTES = 1 << 19
# Each Python worker keeps pieces and what is known of them in so many bytes, then starts over.
KNOWN_BYTES = 96 << 20
OVERHEAD = 300
# New pieces given to the tokenizers at a time.
LINE = 128
# Runs that a task merges at a time, and pairs in one row of the counts.
FAN, ROW_PAIRS = 64, 1 << 16
RADIX_SHIFT = np.uint32(24)
# Groups with more links than this are counted by distinct ids.
SMALL_GROUP = 64

RUNS = pa.schema(
    [("kind", pa.string()), ("run", pa.int64()), ("radix", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
     ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("data", pa.binary())]
)
COUNTS = pa.schema([("radix", pa.int32()), ("part", pa.int32()), ("data", pa.binary())])
BACK = pa.schema([("run", pa.int64()), ("radix", pa.int32()), ("data", pa.binary())])
DIGESTS = pa.schema(
    [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
     ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())]
)
PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n_docs", pa.int64()), ("best", pa.bool_())])


def packed(*columns: np.ndarray) -> bytes:
    """Columns of one length as a frame; the first is ascending."""
    import zstandard

    first = np.diff(columns[0].astype(np.int64), prepend=0)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.astype("<i8").tobytes() for c in (first, *columns[1:])))


def unpacked(frame: bytes, n: int) -> list[np.ndarray]:
    import zstandard

    columns = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), "<i8").reshape(n, -1)
    return [np.cumsum(columns[0]), *columns[1:]]


def codes(a, b):
    """A pair as one number: radix of the A id, the rest of it, the B id; so whole A ids stand together."""
    return (a & 255) << 24 | (a >> 8) << 16 | b


def ids(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (code >> 16 & 255) << 8 | code >> 24 & 255, code & 65535


class Pool:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.data, self.used = np.zeros(1024, kind), 0

    def extend(self, values) -> None:
        while self.used + len(values) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        self.data[self.used : self.used + len(values)] = values
        self.used += len(values)


# Bytes that stand beside a cut: printable ASCII, and before it a Latin-1 letter in two bytes.
PRINTABLE = np.zeros(256, bool)
PRINTABLE[0x21:0x7F] = True
AFTER = PRINTABLE.copy()
AFTER[0xC3] = True
BREAK = np.isin(np.arange(256), list(b" \n"))


def pieces(piece: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of what both tokenizers can be given alone; empty rows have none."""
    data, offsets = piece.data, piece.offsets - piece.offsets[0]
    first = offsets[:-1][np.diff(offsets) > 0]
    cut = np.zeros(len(data), bool)
    if len(data) > 2:
        before = PRINTABLE[data[:-2]]
        before[1:] |= (data[:-3] == 0xC3) & (data[1:-2] >= 0x80)
        cut[1:-1] = before & BREAK[data[1:-1]] & AFTER[data[2:]]
        # Neither side of a cut lies in another row.
        cut[first[first > 0] - 1] = False
    cut[first] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(data))[: len(start)]
    return np.searchsorted(offsets, start, "right") - 1, start, end


def byte_alphabet() -> dict[str, int]:
    """The letters of byte-level vocabularies: printable Latin-1 stands for itself, other bytes follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Groups and links of texts, worked out once for each distinct piece."""

    def __init__(self, side_a: str, side_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(side_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=side_b)
        letters = byte_alphabet()
        self.a_bytes = {
            i: bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
            for entry, i in self.a.get_vocab(with_added_tokens=True).items()
        }
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        if max(self.a_bytes, default=0) > 65535 or len(self.b_bytes) > 65536:
            raise ValueError("token ids must fit into 16 bits")
        self.a_length = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_length[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        self.forget()

    @classmethod
    def of_worker(cls, side_a: str, side_b: str) -> Aligner:
        """The aligner that this Python worker keeps from task to task."""
        held = sys.modules.setdefault("_basketry_held", types.ModuleType("_basketry_held"))
        if getattr(held, "aligner_paths", None) != (side_a, side_b):
            held.aligner, held.aligner_paths = cls(side_a, side_b), (side_a, side_b)
        return held.aligner

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.known_bytes = 0
        self.texts: list[bytes] = []
        # Per piece: A tokens, B tokens, groups, links; whether tokens give it back; where its pairs start and how many.
        self.sizes = [Pool(np.int64) for _ in range(4)]
        self.fits, self.pair_start, self.pair_count = Pool(bool), Pool(np.int64), Pool(np.int64)
        self.pair_codes, self.pair_times = Pool(np.int64), Pool(np.int64)

    def encoded(self, texts: list[bytes]) -> Iterator[tuple[list[int], list[int]] | None]:
        """Ids of both sides, or None where either does not give the text back. B puts a space before each text itself."""
        given = [x.decode("utf-8", "replace") for x in texts]
        a = self.a.encode_batch_fast(given, add_special_tokens=False)
        b = self.b.encode([t[1:] if t[0] == " " else t for t in given], num_threads=1)
        for text, x, y in zip(texts, a, b, strict=True):
            x = x.ids
            # Before a line end that space is a token of its own, and not part of the text.
            y = y if text[:1] == b" " else y[1:]
            same = b"".join(map(self.a_bytes.__getitem__, x)) == text == b"".join(map(self.b_bytes.__getitem__, y))
            yield (x, y) if same else None

    def learn(self, found: list[bytes]) -> None:
        """Encodes new pieces, many to a line as they could stand in a text."""
        lines, line = [], []
        for piece in found:
            if line and (len(line) == LINE or not (PRINTABLE[line[-1][-1]] and BREAK[piece[0]] and AFTER[(piece[1:2] or b" ")[0]])):
                lines.append(line)
                line = []
            line.append(piece)
        lines.append(line)
        ids = list(self.encoded([b"".join(x) for x in lines]))
        alone = [p for x, known in zip(lines, ids, strict=True) if known is None and len(x) > 1 for p in x]
        again = iter(list(self.encoded(alone)) if alone else [])
        fits, a, b = [], [], []
        for pieces_of_line, known in zip(lines, ids, strict=True):
            whole = known is not None or len(pieces_of_line) == 1
            for own in [known] if whole else [next(again) for _ in pieces_of_line]:
                fits += [own is not None] * (len(pieces_of_line) if whole else 1)
                if own is not None:
                    a += own[0]
                    b += own[1]
        self.keep(found, np.array(fits, bool), np.array(a, np.int64), np.array(b, np.int64))

    def keep(self, found: list[bytes], fits: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Stores groups and links of new pieces; the ids are those of the pieces that fit, in turn."""
        end_of_piece = np.cumsum(np.array([len(x) for x in found]) * fits)
        end_a, end_b = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        ends = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        in_a, in_b = (np.bincount(g, minlength=len(ends)) for g in (group_a, group_b))
        piece_of_group = np.searchsorted(end_of_piece, ends)
        n = len(found)
        sizes = [
            np.bincount(piece_of_group, w, minlength=n).astype(np.int64) for w in (in_a, in_b, np.ones(len(ends)), in_a * in_b)
        ]
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        # Small groups at once, each A token with the B tokens of its group; large ones by distinct ids.
        small = in_a * in_b <= SMALL_GROUP
        own = np.flatnonzero(small[group_a])
        times = in_b[group_a[own]]
        total = int(times.sum())
        beside = np.repeat(first_b[group_a[own]] - (np.cumsum(times) - times), times) + np.arange(total)
        code = [codes(a[np.repeat(own, times)], b[beside])]
        often, of_piece = [np.ones(total, np.int64)], [piece_of_group[group_a[np.repeat(own, times)]]]
        for g in np.flatnonzero(~small).tolist():
            (x, k), (y, m) = (
                np.unique(s[f : f + c], return_counts=True) for s, f, c in ((a, first_a[g], in_a[g]), (b, first_b[g], in_b[g]))
            )
            code.append(codes(x[:, None], y[None, :]).ravel())
            often.append((k[:, None] * m[None, :]).ravel())
            of_piece.append(np.full(len(x) * len(y), piece_of_group[g]))
        code, often, of_piece = map(np.concatenate, (code, often, of_piece))
        if not small.all():
            order = np.argsort(of_piece, kind="stable")
            code, often, of_piece = code[order], often[order], of_piece[order]
        count = np.bincount(of_piece, minlength=n)
        start = np.cumsum(count) - count
        texts = self.written(a, b, first_a, first_b, in_a, in_b, group_a, group_b, piece_of_group, n)
        self.known.update(zip(found, range(len(self.texts), len(self.texts) + n), strict=True))
        self.texts += texts
        self.known_bytes += sum(map(len, found)) + sum(map(len, texts)) + 16 * len(code) + OVERHEAD * n
        for pool, values in zip(self.sizes, sizes, strict=True):
            pool.extend(values)
        self.fits.extend(fits)
        self.pair_start.extend(self.pair_codes.used + start)
        self.pair_count.extend(count)
        self.pair_codes.extend(code)
        self.pair_times.extend(often)

    @staticmethod
    def written(a, b, first_a, first_b, in_a, in_b, group_a, group_b, piece_of_group, n: int) -> list[bytes]:
        """The groups of each piece in decimal: ids between commas, sides between bars, groups between semicolons."""
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[first_a + in_a - 1] = last_b[first_b + in_b - 1] = True
        # In a group all A tokens stand before all B tokens.
        place_a = np.arange(len(a)) + first_b[group_a]
        place_b = np.arange(len(b)) + (first_a + in_a)[group_b]
        ids, sign = np.zeros(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        sign[place_a[last_a]], sign[place_b[last_b]] = ord("|"), ord(";")
        digits = np.where(ids > 9999, 5, np.where(ids > 999, 4, np.where(ids > 99, 3, np.where(ids > 9, 2, 1))))
        signs = np.zeros((len(ids), 6), np.uint8)
        for k in range(5):
            # The k-th digit from the left; columns beyond the last one are not taken.
            signs[:, k] = ids // 10 ** np.maximum(digits - 1 - k, 0) % 10 + ord("0")
        signs[np.arange(len(ids)), digits] = sign
        raw = signs[np.arange(6) <= digits[:, None]].tobytes()
        piece = np.zeros(len(ids), np.int64)
        piece[place_a], piece[place_b] = piece_of_group[group_a], piece_of_group[group_b]
        ends = np.cumsum(np.bincount(piece, digits + 1, minlength=n).astype(np.int64)).tolist()
        return [raw[x : max(x, y - 1)] for x, y in itertools.pairwise([0, *ends])]

    def align(self, piece: Slice) -> Aligned:
        rows = piece.last - piece.first
        row, start, end = pieces(piece)
        raw = piece.data.tobytes()
        words = [raw[x:y] for x, y in zip(start.tolist(), end.tolist(), strict=True)]
        for i in np.flatnonzero(np.diff(row, prepend=-1)).tolist():
            words[i] = b" " + words[i]
        if self.known_bytes > KNOWN_BYTES:
            self.forget()
        known = self.known
        if new := list(dict.fromkeys([w for w in words if w not in known])):
            self.learn(new)
        at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        unfit = np.bincount(row, ~self.fits.data[at], minlength=rows)[:rows] > 0
        keep = ~unfit[row]
        row, at = row[keep], at[keep]
        sizes = [np.bincount(row, p.data[at], minlength=rows)[:rows].astype(np.int64) for p in self.sizes]
        bounds, place = np.append(0, np.cumsum(per_row(row, rows))).tolist(), at.tolist()
        texts = self.texts
        digests = [
            hashlib.sha256(b";".join([texts[k] for k in place[x:y]])).hexdigest() if y > x else ""
            for x, y in itertools.pairwise(bounds)
        ]
        held, often = np.unique(row << 32 | at, return_counts=True)
        row, at = held >> 32, held & 0xFFFFFFFF
        n = self.pair_count.data[at]
        flat = np.repeat(self.pair_start.data[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        pairs, times = summed(np.repeat(row, n) << 32 | self.pair_codes.data[flat], self.pair_times.data[flat] * np.repeat(often, n))
        return Aligned(sizes, digests, per_row(pairs >> 32, rows), (pairs & 0xFFFFFFFF).astype(np.uint32), times)


class Aligned(types.SimpleNamespace):
    """Of a slice: sizes and digests by row, how many pairs each row has, and the pairs with their links."""

    def __init__(self, sizes, digests, n_pairs, pairs, times):
        super().__init__(sizes=sizes, digests=digests, n_pairs=n_pairs, pairs=pairs, times=times)


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    return keys[first], np.add.reduceat(values, first)


def rows_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch in which columns that are not given are null."""
    n = len(next(iter(columns.values())))
    arrays = [
        columns[f.name] if isinstance(columns.get(f.name), pa.Array) else pa.array(columns.get(f.name, [None] * n), f.type)
        for f in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def run_task(side_a: str, side_b: str, run_bytes: int):
    """Task: documents to rows ``doc``, each with its links, and rows ``pairs``, the frames of runs."""

    def flushed(run: int, held: list[tuple[pa.Array, Aligned]]) -> Iterator[pa.RecordBatch]:
        pairs, place, docs = np.unique(np.concatenate([x.pairs for _, x in held]), return_inverse=True, return_counts=True)
        done = 0
        for doc_ids, x in held:
            ends = done + np.cumsum(x.n_pairs)
            data = [
                packed(place[end - n : end], x.times[end - n - done : end - done])
                for end, n in zip(ends.tolist(), x.n_pairs.tolist(), strict=True)
            ]
            done += int(x.n_pairs.sum())
            n_a, n_b, n_groups, n_links = x.sizes
            yield rows_of(
                RUNS, kind=["doc"] * len(data), run=[run] * len(data), doc_id=doc_ids.cast(pa.int64()), n_a=n_a, n_b=n_b,
                n_groups=n_groups, n_links=n_links, groups_sha256=x.digests, data=data,
            )
        radix, first = np.unique(pairs >> RADIX_SHIFT, return_index=True)
        data = [packed(pairs[x:y], docs[x:y]) for x, y in itertools.pairwise([*first.tolist(), len(pairs)])]
        if data:
            yield rows_of(RUNS, kind=["pairs"] * len(data), run=[run] * len(data), radix=radix.astype(np.int32), data=data)

    def task(batches):
        aligner = Aligner.of_worker(side_a, side_b)
        run, held, size = TaskContext.get().partitionId() << 32, [], 0
        for rows in batches:
            for piece in text_slices(rows.column(1), min(SLICE_BYTES, run_bytes)):
                held.append((rows.column(0).slice(piece.first, piece.last - piece.first), aligner.align(piece)))
                size += len(piece.data)
                if size >= run_bytes:
                    yield from flushed(run, held)
                    run, held, size = run + 1, [], 0
        if held:
            yield from flushed(run, held)

    return task


def merged(frames: list[bytes]) -> Iterator[tuple[int, int]]:
    """Pairs of sorted frames in order, each with the sum of its counts."""
    runs = [zip(*(c.tolist() for c in unpacked(f, 2)), strict=True) for f in frames]
    for code, same in itertools.groupby(heapq.merge(*runs), key=lambda entry: entry[0]):
        yield code, sum(n for _, n in same)


def framed(entries: Iterator[tuple[int, int]]) -> bytes:
    columns = np.array(list(entries), np.int64).reshape(-1, 2).T
    return packed(*columns)


def count_task(batches):
    """Task: frames in order of radix to the counts of all pairs of each radix, in order, best ones marked."""

    def counted(radix: int, levels: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        part, held = 0, []

        def row() -> pa.RecordBatch:
            return rows_of(COUNTS, radix=[radix], part=[part], data=[packed(*np.array(held, np.int64).T)])

        for _, pairs in itertools.groupby(merged(list(itertools.chain(*levels))), key=lambda entry: entry[0] >> 16):
            of_one = list(pairs)
            most = max(n for _, n in of_one)
            held += [(code, n, n == most) for code, n in of_one]
            if len(held) >= ROW_PAIRS:
                yield row()
                part, held = part + 1, []
        if held:
            yield row()

    radix, levels = None, [[]]
    for rows in batches:
        for own, frame in zip(rows.column("radix").to_pylist(), rows.column("data").to_pylist(), strict=True):
            if own != radix:
                if radix is not None:
                    yield from counted(radix, levels)
                radix, levels = own, [[]]
            levels[0].append(frame)
            for k in itertools.count():
                if len(levels[k]) < FAN:
                    break
                if k + 1 == len(levels):
                    levels.append([])
                levels[k + 1].append(framed(merged(levels[k])))
                levels[k] = []
    if radix is not None:
        yield from counted(radix, levels)


def back_task(batches):
    """Task: the counts of a radix, then its frames; each frame's pairs get their counts, doubled, plus 1 for best ones."""
    radix, code, value, parts = None, None, None, []
    for rows in batches:
        found = ([], [], [])
        for own, run, frame in zip(*(rows.column(n).to_pylist() for n in ("radix", "run", "data")), strict=True):
            if own != radix:
                radix, code, parts = own, None, []
            if run is None:
                parts.append(unpacked(frame, 3))
                continue
            if code is None:
                code, n, best = (np.concatenate(c) for c in zip(*parts, strict=True))
                value, parts = 2 * n + best, []
            pairs, _ = unpacked(frame, 2)
            told = value[np.searchsorted(code, pairs)]
            for column, x in zip(found, (run, radix, packed(np.arange(len(told)), told)), strict=True):
                column.append(x)
        yield rows_of(BACK, run=found[0], radix=found[1], data=found[2])


def sum_task(batches):
    """Task: the counts that came back to a run, by radix, then its documents."""
    run, value, parts = None, np.zeros(0, np.int64), []
    copied = [n for n in DIGESTS.names if n not in ("n_best", "count_sum")]
    for rows in batches:
        best, total, docs = [], [], []
        for i, (own, radix, frame) in enumerate(zip(*(rows.column(n).to_pylist() for n in ("run", "radix", "data")), strict=True)):
            if own != run:
                run, parts, value = own, [], np.zeros(0, np.int64)
            if radix is not None:
                parts.append(unpacked(frame, 2)[1])
                continue
            if parts:
                value, parts = np.concatenate(parts), []
            place, times = unpacked(frame, 2)
            told = value[place]
            docs.append(i)
            best.append(int(((told & 1) * times).sum()))
            total.append(int(((told >> 1) * times).sum()))
        mine = rows.take(pa.array(docs, pa.int64()))
        yield rows_of(DIGESTS, n_best=best, count_sum=total, **{n: mine.column(n) for n in copied})


def runs(documents: DataFrame, side_a: str | None = None, side_b: str | None = None, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Documents aligned and cut into runs, as a table in the shared folder."""
    spark = documents.sparkSession
    task = run_task(side_a or tokenizer_path(SIDE_A), side_b or tokenizer_path(SIDE_B), run_bytes)
    path = fresh_path(spark, "alignment-runs")
    documents.select("doc_id", "text").mapInArrow(task, ddl(RUNS)).write.partitionBy("kind").parquet(path)
    return spark.read.schema(ddl(RUNS)).parquet(path)


def counts(found: DataFrame) -> DataFrame:
    """Sorted pairs of all runs with their counts, by radix and part."""
    frames = found.where("kind = 'pairs'").select("radix", "run", "data")
    return stored(
        frames.repartitionByRange("radix").sortWithinPartitions("radix", "run").mapInArrow(count_task, ddl(COUNTS)), "pair-counts"
    )


def digests(found: DataFrame, counted: DataFrame) -> DataFrame:
    """What the links of each document add up to."""
    frames = found.where("kind = 'pairs'").select("radix", "run", F.lit(0).alias("part"), "data")
    first = counted.select("radix", F.lit(None).cast("bigint").alias("run"), "part", "data")
    order = ["radix", F.col("run").asc_nulls_first(), "part"]
    met = first.unionByName(frames).repartitionByRange("radix").sortWithinPartitions(*order)
    back = stored(met.mapInArrow(back_task, ddl(BACK)), "pair-counts-back")
    documents = found.where("kind = 'doc'").drop("kind", "radix")
    order = ["run", F.col("radix").asc_nulls_last()]
    home = back.unionByName(documents, allowMissingColumns=True).repartitionByRange("run").sortWithinPartitions(*order)
    return home.mapInArrow(sum_task, ddl(DIGESTS))


def alignment(documents: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    found = runs(documents)
    return digests(found, counts(found))


def pair_counts(documents: DataFrame) -> DataFrame:
    """Every linked pair (a, b): the number of documents that hold it, and whether it is the highest of its A id."""

    def task(batches):
        for rows in batches:
            for frame in rows.column("data").to_pylist():
                code, n, best = unpacked(frame, 3)
                a, b = ids(code)
                yield rows_of(PAIRS, a=a, b=b, n_docs=n, best=best.astype(bool))

    return counts(runs(documents)).mapInArrow(task, "a bigint, b bigint, n_docs bigint, best boolean")
