"""Benchmark items in documents, re-parameterised ones included.

Texts become template tokens: numbers, names (a capital inside a sentence) and units after a number
turn into typed placeholders, other words are lower-cased (A-Z and Latin-1); punctuation around words and a
possessive 's go. A capital that need not make a name (at the start of a sentence, line or text, in a word of
capitals or of one letter, before a hyphen or an apostrophe) is read both ways, as a word and as a name. Windows of
``WINDOW`` tokens are joined by a hash of their words as they stand, so that every window of an item meets
its copies, and those with at least ``LITERAL`` words that are no placeholders also by a hash of their
template tokens. Where placeholders dominate, changed values are accepted only as part of a longer
window, of ``LONG`` tokens (or of the whole item, if it is shorter) with ``LITERAL`` such words. Windows
of one document and item that lie on one diagonal (the same distance between the two positions) are
one alignment. In an alignment each item value stands for one document value, and each name of the document
for one of the item (two numbers may become equal); windows with a placeholder that breaks this do not
count. A document is contaminated by an
item if the aligned windows cover at least ``COVER`` of all windows of the item, or if windows of one
alignment follow each other over ``RUN`` tokens as they stand or twice as many with changed values, which
finds passages of long items.

Windows that more than ``SHARED`` items hold, such as a common line of instructions, are not joined with all
of them: they count for an item that another window proposes, and items with the same common windows are
one part, matched once as the shortest of them. What a document covers of a part it covers of every such item,
so a part that is found names all of them whose own number of windows allows it.

Windows of ``LONG`` tokens are looked up by halves first, so possible names cost readings of half a window.

A fixed-size bitmap of the benchmark's window hashes goes to the tasks and holds back windows that
no item has; what passes is joined exactly. So only the bitmap is broadcast, whatever the benchmark's
size, and no document text is shuffled.

Defined results: null texts have no tokens; an item of fewer than ``WINDOW`` tokens is one window; an
item of fewer than ``LITERAL`` tokens can not be found; items that repeat an id are one item;
rows that repeat give one result row; a document without a find gives no row; empty tables give no
rows; other columns are ignored. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.bitmaps import BITS, bitmap, passes
from basketry.llm.near_dup import row_key
from basketry.llm.words import BASE, Hasher, Slice, batch, lowered, mixed, per_row, released, space_words, text_slices, unused
from basketry.session import stored

WINDOW = 6
LITERAL = 4
LONG = 12
COVER = 0.3
RUN = 13
# A window of more items is joined only where another window proposes the item, and once for all of them.
SHARED = 16

# Units, as they stand after a number.
UNITS = (
    "mm cm m km in inch inches ft feet yard yards mile miles mg g gram grams kg kilograms lb lbs pounds oz ton tons tonnes "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week "
    "weeks month months year years percent dollars dollar cents cent euro euros usd eur degrees degree km/h mph kmh hz "
    "khz mhz ghz kb mb gb tb w kw v j kj cal kcal pa kpa bar"
).split()
NUMBER, NAME, UNIT = 1, 2, 3

PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[list(range(33, 48)) + list(range(58, 65)) + list(range(91, 97)) + list(range(123, 127))] = True
DIGIT = np.isin(np.arange(256), list(range(48, 58)))
NUMERIC = np.isin(np.arange(256), [*range(48, 58), *b".,/%:-"])
UPPER = np.isin(np.arange(256), list(range(65, 91)))
UPPER_LATIN = np.isin(np.arange(256), [x for x in range(0x80, 0x9F) if x != 0x97])  # after byte C3
JOINER = np.isin(np.arange(256), list(b"'-"))
LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(128, 256)])
STOP = np.isin(np.arange(256), list(b".!?:"))


SLOTS = mixed(np.arange(1, 5, dtype=np.uint64) * np.uint64(BASE))  # hashes of placeholders by kind


class Tokens(NamedTuple):
    """Template tokens of a slice: row, byte range, kind (0 for literal words), hash, hash as a word, may be a name."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    kind: np.ndarray
    hash: np.ndarray
    raw: np.ndarray
    maybe: np.ndarray


def folded(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z and the capitals of Latin-1 in lower case."""
    low = lowered(data)
    lead = np.flatnonzero(data[:-1] == 0xC3)
    following = data[lead + 1]
    capital = lead[(following >= 0x80) & (following <= 0x9E) & (following != 0x97)] + 1
    low[capital] += 0x20
    return low


def possessive(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many bytes at the end of each range are 's, with either apostrophe."""
    at = lambda back: data[np.maximum(end - back, 0)]
    if not len(data):
        return np.zeros(len(end), np.int64)
    s = (at(1) == ord("s")) | (at(1) == ord("S"))
    plain = s & (at(2) == ord("'")) & (end - start > 2)
    curly = s & (at(2) == 0x99) & (at(3) == 0x80) & (at(4) == 0xE2) & (end - start > 4)
    return 2 * plain + 4 * curly


def unit_hashes(hasher: Hasher) -> np.ndarray:
    found = [space_words(p, hasher).hash for p in text_slices(pa.array(UNITS))]
    return np.unique(np.concatenate(found))


def tokens(piece: Slice, hasher: Hasher, units: np.ndarray) -> Tokens:
    data = piece.data
    words = space_words(piece)
    row, start, end = words.row, words.start.copy(), words.end.copy()
    raw_end = words.end
    # A sentence starts a row, a line, or after a word that ends in a stop.
    opens = np.ones(len(row) + 1, bool)
    if len(row):
        last = data[raw_end[:-1] - 1]
        opens[1:-1] = (row[1:] != row[:-1]) | STOP[last]
        opens[np.searchsorted(start, np.flatnonzero(data == ord("\n")))] = True
    opens = opens[:-1]
    while (trim := (start < end) & PUNCTUATION[data[np.minimum(start, len(data) - 1)]]).any() if len(data) else False:
        start[trim] += 1
    while (trim := (start < end) & PUNCTUATION[data[np.maximum(end - 1, 0)]]).any() if len(data) else False:
        end[trim] -= 1
    end -= possessive(data, start, end)
    held = start < end
    row, start, end, opens = row[held], start[held], end[held], opens[held]

    def within(inside: np.ndarray, some: np.ndarray) -> np.ndarray:
        """For each token, whether it is one of some and has only such bytes."""
        only = np.zeros(len(row), bool)
        only[some] = counts(inside, some) == end[some] - start[some]
        return only

    def counts(inside: np.ndarray, some: np.ndarray) -> np.ndarray:
        """How many such bytes some tokens have."""
        size = end[some] - start[some]
        begin = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(start[some] - begin, size)
        return np.add.reduceat(inside[data[at]], begin, dtype=np.int64) if len(some) else size

    length = end - start
    kind = np.zeros(len(row), np.int8)
    if len(row):
        upper = np.flatnonzero(UPPER[data[start]])
        kind[within(LETTER, upper[counts(UPPER, upper) == 1]) & (length > 1) & ~opens] = NAME
        digits = np.flatnonzero(DIGIT[data])
        holder = np.searchsorted(start, digits, "right") - 1
        kind[within(NUMERIC, np.unique(holder[(holder >= 0) & (digits < end[holder])]))] = NUMBER
        found = hasher.ranges(folded(data), start, end)
        after = np.zeros(len(row), bool)
        after[1:] = (kind[:-1] == NUMBER) & (row[1:] == row[:-1])
        kind[after & np.isin(found, units)] = UNIT
        latin = (data[start] == 0xC3) & UPPER_LATIN[data[np.minimum(start + 1, end - 1)]]
        maybe = within(LETTER | JOINER, np.flatnonzero((kind == 0) & (UPPER[data[start]] | latin)))
    else:
        maybe = np.zeros(0, bool)
        found = np.zeros(0, np.uint64)
    return Tokens(row, start, end, kind, np.where(kind > 0, SLOTS[kind], found), found, maybe)


class Windows(NamedTuple):
    """Windows of one length: first token, hash, whether it is the hash of the words as they stand, places of names.

    Places are sets of bits: ``also`` has the tokens that are read as names beside those that are names
    anyway, ``names`` has both.
    """

    size: int
    at: np.ndarray
    hash: np.ndarray
    verbatim: bool
    also: np.ndarray
    names: np.ndarray


# Readings that are hashed at a time.
READINGS = 1 << 19


def rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    last = len(hashes) - n + 1
    total = np.full(last, n, np.uint64)
    for k in range(n):
        total = total * np.uint64(BASE) + hashes[k : k + last]
    return total


def readings(names: np.ndarray, maybe: np.ndarray, known: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows, by number, and places of names that they may be read with: those in ``known`` that hold all names."""
    cases, case = np.unique((names.astype(np.int64) << n) | maybe, return_inverse=True)
    sure, most = cases >> n, (cases >> n) | (cases & ((1 << n) - 1))
    step = max(1, READINGS // max(len(known), 1))
    fits = [np.nonzero(((sure[i : i + step, None] & ~known) == 0) & ((known & ~most[i : i + step, None]) == 0)) for i in range(0, len(cases), step)]
    if not fits:
        return
    count = np.bincount(np.concatenate([f[0] + i * step for i, f in enumerate(fits)]), minlength=len(cases))
    which = np.concatenate([f[1] for f in fits])
    begin = np.cumsum(count) - count
    each = count[case]
    part = np.cumsum(each) // READINGS
    edges = np.searchsorted(part, np.arange(part[-1] + 2 if len(part) else 1))
    for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        window = np.repeat(np.arange(i, j), each[i:j])
        ends = np.cumsum(each[i:j])
        place = np.arange(len(window)) - np.repeat(ends - each[i:j], each[i:j])
        if len(window):
            yield window, known[which[begin[case[window]] + place]]


def name_places(found: Tokens, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For every run of n tokens the places of names, and of tokens that may be names, as sets of bits."""
    last = len(found.row) - n + 1
    names, maybe = np.zeros(last, np.int32), np.zeros(last, np.int32)
    named = (found.kind == NAME).astype(np.int32)
    also = found.maybe.astype(np.int32)
    for k in range(n):
        names |= named[k : k + last] << k
        maybe |= also[k : k + last] << k
    return names, maybe


def template_hash(found: Tokens, n: int, at: np.ndarray, also: np.ndarray, total: np.ndarray | None = None) -> np.ndarray:
    """Hashes, not yet mixed, of the runs of n tokens at the given places with more tokens read as names."""
    hashes = (rolled(found.hash, n) if total is None else total)[at]
    if also.any():
        change = SLOTS[NAME] - found.hash
        for k in range(n):
            more = np.flatnonzero(also >> k & 1)
            hashes[more] += change[at[more] + k] * np.uint64(pow(BASE, n - 1 - k, 1 << 64))
    return hashes


def read_runs(found: Tokens, n: int, at: np.ndarray, known: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of n tokens, in every known reading: first token, places of names, those beside certain names."""
    names, maybe = name_places(found, n)
    held = np.zeros(1 << n, bool)
    held[known] = True
    # Runs that can be read in one way only need no search.
    one = at[maybe[at] == 0]
    one = one[held[names[one]]]
    yield one, names[one].astype(np.int64), np.zeros(len(one), np.int64)
    both = at[maybe[at] > 0]
    for which, read in readings(names[both], maybe[both], known, n):
        yield both[which], read, read & ~names[both[which]].astype(np.int64)


def whole_runs(found: Tokens, n: int) -> np.ndarray:
    """First tokens of the runs of n tokens within a row."""
    last = len(found.row) - n + 1
    return np.flatnonzero(found.row[:last] == found.row[n - 1 :]) if last > 0 else np.zeros(0, np.int64)


def plain_words(found: Tokens, n: int) -> np.ndarray:
    """How many words of every run of n tokens are certainly no placeholders, or may be none."""
    total = np.concatenate([[0], np.cumsum(found.kind == 0)])
    return total[n:] - total[:-n]


def token_windows(found: Tokens, n: int, window: int, literal: int, known: np.ndarray | None = None) -> Iterator[Windows]:
    """Every run of n tokens within a row: as it stands up to ``window`` tokens, as a template in every reading with enough literal words.

    known: places of names in the other side's windows; others need not be read.
    """
    whole = whole_runs(found, n)
    if not len(whole):
        return
    if n <= window:
        yield Windows(n, whole, mixed(rolled(found.raw, n)[whole]), True, np.zeros(len(whole), np.int64), np.full(len(whole), -1))
    plain, enough, total = plain_words(found, n), min(literal, n), rolled(found.hash, n)
    known = np.arange(1 << n) if known is None else known
    for at, read, extra in read_runs(found, n, whole[plain[whole] >= enough], known):
        left = plain[at] - np.bitwise_count(extra)
        keep = (left >= enough) & (left < n)
        at, read, extra = at[keep], read[keep], extra[keep]
        yield Windows(n, at, mixed(template_hash(found, n, at, extra, total)), False, extra, read)


def halves(found: Tokens, w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first and second half of each window, in the window's reading."""
    first = w.size // 2
    left = template_hash(found, first, w.at, w.also & ((1 << first) - 1))
    return mixed(left), mixed(template_hash(found, w.size - first, w.at + first, w.also >> first))


def known_runs(found: Tokens, n: int, places: list[int], known: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, ...]:
    """Runs of n tokens in every reading with these places of names whose hash is known, by place: first token, names, names beside certain ones."""
    parts, total = [], rolled(found.hash, n)
    for at, names, also in read_runs(found, n, whole_runs(found, n), np.array([x for x in places if x < 1 << n], np.int64)):
        kept = known(mixed(template_hash(found, n, at, also, total)))
        parts.append((at[kept], names[kept], also[kept]))
    at, names, also = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(at, kind="stable")
    return at[order], names[order], also[order]


def long_windows(found: Tokens, n: int, literal: int, places: list[int], known: Callable[[np.ndarray], np.ndarray]) -> Windows:
    """Runs of n tokens as templates, in those readings whose halves are both known; places are those of names in halves.

    A half has at most 2 ** (n / 2) readings, so a text in capitals costs that many hashes a word, not 2 ** n.
    """
    first = n // 2
    none = np.zeros(0, np.int64)
    if not len(whole_runs(found, n)):
        return Windows(n, none, none.view(np.uint64), False, none, none)
    left_at, left_names, left_also = before = known_runs(found, first, places, known)
    right_at, right_names, right_also = before if n == 2 * first else known_runs(found, n - first, places, known)
    begin, end = (np.searchsorted(right_at, left_at + first, side) for side in ("left", "right"))
    left = np.repeat(np.arange(len(left_at)), end - begin)
    right = np.arange(len(left)) - np.repeat(np.cumsum(end - begin) - end, end - begin)
    at, names, also = left_at[left], left_names[left] | right_names[right] << first, left_also[left] | right_also[right] << first
    inside = found.row[at] == found.row[at + n - 1]
    at, names, also = at[inside], names[inside], also[inside]
    plain = plain_words(found, n)[at] - np.bitwise_count(also)
    keep = (plain >= min(literal, n)) & (plain < n)
    at, names, also = at[keep], names[keep], also[keep]
    return Windows(n, at, mixed(template_hash(found, n, at, also)), False, also, names)


def needed(found: Tokens, w: Windows, window: int, literal: int) -> np.ndarray:
    """Which windows of an item are no mere sum of shorter ones, that are joined anyway."""
    if w.size <= window:
        return np.ones(len(w.at), bool)
    plain = np.concatenate([[0], np.cumsum(found.kind == 0)])
    few = np.zeros(len(w.at), bool)
    for j in range(w.size - window + 1):
        names = np.bitwise_count((w.also >> j) & ((1 << window) - 1))
        few |= plain[w.at + j + window] - plain[w.at + j] - names < literal
    return few


def slots_of(found: Tokens, at: int, n: int, raw: bytes, also: int = 0) -> list[str]:
    """The window's placeholders in order, each with its kind so that values of two kinds never meet."""
    return [
        f"{int(found.kind[i]) or NAME}:{raw[found.start[i] : found.end[i]].decode(errors='replace').lower()}"
        for i in range(at, at + n)
        if found.kind[i] or also >> (i - at) & 1
    ]


ITEM = pa.schema(
    [("item_id", pa.int64()), ("n_windows", pa.int32()), ("size", pa.int32()), ("verbatim", pa.bool_()), ("names", pa.int64()),
     ("window", pa.int64()), ("left", pa.int64()), ("right", pa.int64()), ("item_pos", pa.int64()), ("item_slots", pa.list_(pa.string()))]
)


def item_windows(benchmark: DataFrame, window: int = WINDOW, literal: int = LITERAL, long: int = LONG) -> DataFrame:
    """All windows of the items, with the number of windows of the item; an item shorter than a window is one."""

    def run(batches):
        hasher = Hasher()
        units = unit_hashes(hasher)
        for rows in batches:
            ids = rows.column(0).cast(pa.int64()).to_pylist()
            for piece in text_slices(rows.column(1)):
                found = tokens(piece, hasher, units)
                count = per_row(found.row, piece.last - piece.first)
                begin = np.cumsum(count) - count
                raw = piece.data.tobytes()
                out = []
                for n in range(literal, max(window, long) + 1):
                    for w in token_windows(found, n, window, literal):
                        held = np.ones(len(w.at), bool) if n in (window, long) else count[found.row[w.at]] == n
                        held &= needed(found, w, window, literal)
                        left, right = halves(found, w) if n > window else (w.hash, w.hash)
                        columns = (w.at, w.hash.view(np.int64), left.view(np.int64), right.view(np.int64), w.names, w.also)
                        for i, h, a, b, names, also in zip(*(c[held].tolist() for c in columns), strict=True):
                            r = int(found.row[i])
                            windows = max(1, int(count[r]) - window + 1)
                            slots = slots_of(found, i, n, raw, also)
                            out.append((ids[piece.first + r], windows, n, w.verbatim, names, h, a, b, i - int(begin[r]), slots))
                if out:
                    yield batch(ITEM, *zip(*out, strict=True))

    return benchmark.where("item_id IS NOT NULL").select("item_id", "text").mapInArrow(
        released(run),
        "item_id bigint, n_windows int, size int, verbatim boolean, names bigint, window bigint, "
        "left bigint, right bigint, item_pos bigint, item_slots array<string>",
    )


HIT = pa.schema(
    [("node", pa.binary()), ("doc_id", pa.int64()), ("size", pa.int32()), ("verbatim", pa.bool_()), ("window", pa.int64()),
     ("pos", pa.int64()), ("slots", pa.list_(pa.string()))]
)


def document_windows(
    documents: DataFrame, windows: DataFrame, window: int = WINDOW, literal: int = LITERAL, bits: int = BITS
) -> DataFrame:
    """The windows of documents that the bitmap lets through."""
    context = documents.sparkSession.sparkContext
    mask = context.broadcast(bitmap(windows, "window", bits))
    parts = windows.where(F.col("size") > window).select(F.explode(F.array("left", "right")).alias("half"))
    half_mask = context.broadcast(bitmap(parts, "half", bits))
    known: dict[int, set[int]] = {}  # by size, places in windows or halves of windows: at most 2 ** window sets
    split = F.array(F.expr("names & (shiftleft(1L, cast(size / 2 as int)) - 1)"), F.expr("shiftright(names, cast(size / 2 as int))"))
    sets = F.explode(F.when(F.col("size") > window, split).otherwise(F.array("names")))
    for n, names in map(tuple, windows.select("size", sets).distinct().collect()):
        known.setdefault(n, set()).update({names} - {-1})
    places = context.broadcast({n: sorted(names) for n, names in sorted(known.items())})

    def found_windows(found: Tokens) -> Iterator[Windows]:
        for n, names in places.value.items():
            if n > window:
                yield long_windows(found, n, literal, names, lambda keys: passes(half_mask.value, keys, bits))
            else:
                yield from token_windows(found, n, window, literal, np.array(names, np.int64))

    def run(batches):
        hasher, held = Hasher(), mask.value
        units = unit_hashes(hasher)
        for rows in batches:
            nodes, ids = rows.column(0).cast(pa.binary()), rows.column(1).cast(pa.int64())
            for piece in text_slices(rows.column(2)):
                found = tokens(piece, hasher, units)
                count = per_row(found.row, piece.last - piece.first)
                begin = np.cumsum(count) - count
                raw, out = None, []
                for w in found_windows(found):
                    hit = passes(held, w.hash, bits)
                    if hit.any():
                        raw = raw or piece.data.tobytes()
                        for i, h, also in zip(*(c[hit].tolist() for c in (w.at, w.hash.view(np.int64), w.also)), strict=True):
                            r = int(found.row[i])
                            out.append((r + piece.first, w.size, w.verbatim, h, i - int(begin[r]), slots_of(found, i, w.size, raw, also)))
                if out:
                    where, *rest = zip(*out, strict=True)
                    where = pa.array(where)
                    yield batch(HIT, nodes.take(where), ids.take(where), *rest)

    named = documents.select(row_key(F.col("doc_id"), F.col("text")).alias("node"), "doc_id", "text")
    return named.mapInArrow(released(run), "node binary, doc_id bigint, size int, verbatim boolean, window bigint, pos bigint, slots array<string>")


def has_run(places: Column, n: int) -> Column:
    """Whether n of the places, which are distinct, follow each other."""
    ordered = F.array_sort(places)
    ends = F.arrays_zip(ordered.alias("first"), F.slice(ordered, n, F.greatest(F.size(places), F.lit(1))).alias("last"))
    return F.exists(ends, lambda e: F.coalesce(e.last - e.first == n - 1, F.lit(False)))


def clashing(pairs: Column) -> Column:
    """Of distinct pairs of values, those whose item value stands for two values, or whose name is that of two item values."""

    def neighbours(ordered: Column, same) -> Column:
        zipped = F.arrays_zip(ordered.alias("p"), F.slice(ordered, 2, F.greatest(F.size(ordered), F.lit(1))).alias("q"))
        return F.flatten(F.transform(F.filter(zipped, same), lambda z: F.array(z.p, z.q)))

    by_item = neighbours(F.array_sort(pairs), lambda z: z.p.item == z.q.item)
    turned = F.array_sort(F.transform(pairs, lambda p: F.struct(p.doc.alias("doc"), p.item.alias("item"))))
    by_doc = neighbours(turned, lambda z: (z.p.doc == z.q.doc) & z.p.item.startswith(f"{NAME}:"))
    return F.array_union(by_item, F.transform(by_doc, lambda p: F.struct(p.item.alias("item"), p.doc.alias("doc"))))


KEY = ["window", "size", "verbatim"]


def shared_parts(items: DataFrame, shared: int = SHARED) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Windows of at most ``shared`` items, the items' other windows, one part for each different lot of the latter, its items.

    An item's windows that many items hold are its common part. Items with equal common parts, wherever in the
    item they begin, are told apart only by other windows; for the common part alone the shortest of them
    (the smallest id among equals) is matched, since its covered share is the largest. The last table has
    (item_id, n_windows) of the shortest and ``same``, the (n_windows, item_id) of all, itself included.
    """
    held = items.groupBy(*KEY).agg(F.count_distinct("item_id", "n_windows").alias("holders"))
    often = held.where(F.col("holders") > shared).select(*KEY, F.lit(True).alias("often"))
    marked = stored(items.join(often, KEY, "left"), "item-parts")
    rare, common = marked.where("often IS NULL").drop("often"), marked.where("often").drop("often")
    lots = common.groupBy("item_id", "n_windows").agg(
        F.min("item_pos").alias("first"), F.collect_set(F.struct(*KEY, "item_pos", "item_slots")).alias("lot")
    )
    lots = lots.withColumn("lot", F.array_sort(F.transform("lot", lambda w: w.withField("item_pos", w.item_pos - F.col("first")))))
    # Equal lots by two hashes, so that a lot is not carried to each of its items.
    lots = lots.withColumns({"h1": F.xxhash64("lot"), "h2": F.xxhash64(F.lit(1), "lot")})
    parts = lots.groupBy("h1", "h2").agg(F.min(F.struct("n_windows", "item_id")).alias("short"), F.min_by("lot", "n_windows").alias("lot"))
    parts = stored(parts, "common-parts")
    others = lots.groupBy("h1", "h2").agg(F.collect_list(F.struct("n_windows", "item_id")).alias("same"))
    members = parts.select("h1", "h2", "short.item_id", "short.n_windows").join(others, ["h1", "h2"]).drop("h1", "h2")
    return rare, common, parts.select("short.item_id", "short.n_windows", F.inline("lot")), members


def found_items(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, literal: int = LITERAL, cover: float = COVER,
    long: int = LONG, length: int = RUN, shared: int = SHARED,
) -> DataFrame:
    """As :func:`matches`, and ``ids``, all items found thereby: of a part, those that the covered windows suffice for."""
    items = stored(item_windows(benchmark, window, literal, long), "item-windows")
    rare, common, parts, members = shared_parts(items, shared)
    hits = stored(document_windows(documents, items, window, literal), "window-hits")
    by_item = ["node", "doc_id", "item_id", "n_windows", "part"]
    columns = ["item_id", "n_windows", "item_pos", "item_slots", *KEY]
    direct = rare.select(*columns, F.lit(False).alias("part")).unionByName(parts.select(*columns, F.lit(True).alias("part")))
    met = hits.join(direct, KEY)
    # Windows that many items hold count for an item that another window proposes.
    proposed = met.where("NOT part").select("node", "doc_id", "item_id", "n_windows", "part").distinct()
    more = proposed.join(common.select(*columns), ["item_id", "n_windows"]).join(hits, ["node", "doc_id", *KEY])
    # A longer window stands for the windows in it. Words as they stand may be placeholders to one side only.
    joined = met.unionByName(more.select(*met.columns)).select(
        *by_item, "verbatim", (F.col("pos") - F.col("item_pos")).alias("diagonal"),
        F.sequence("item_pos", F.col("item_pos") + F.greatest(F.col("size") - window, F.lit(0))).alias("places"),
        F.when(F.col("verbatim"), F.arrays_zip(F.col("item_slots").alias("item"), F.col("item_slots").alias("doc")))
        .otherwise(F.arrays_zip(F.col("item_slots").alias("item"), F.col("slots").alias("doc"))).alias("pairs"),
    )
    aligned = joined.groupBy(*by_item, "diagonal").agg(F.collect_set(F.struct("places", "pairs", "verbatim")).alias("hits"))
    # A run as it stands counts whatever else the diagonal holds.
    copied = F.array_distinct(F.flatten(F.filter("hits", lambda h: h.verbatim).places))
    # The clashes of a diagonal are worked out once, not for each of its hits.
    clashes = F.array(clashing(F.array_distinct(F.flatten("hits.pairs"))))
    sound = F.transform(clashes, lambda c: F.filter("hits", lambda h: ~F.arrays_overlap(h.pairs, c)))[0]
    valid = aligned.select(*by_item, sound.alias("hits"), copied.alias("copied"))
    own = F.filter("hits", lambda h: F.forall(h.pairs, lambda p: p.item == p.doc))
    placed = valid.select(
        *by_item, "copied", F.array_distinct(F.flatten("hits.places")).alias("places"), F.flatten(own.places).alias("own_places"),
        has_run(F.col("copied"), max(1, length - window + 1)).alias("copied_run"),
    )
    with_run = lambda of: F.when(F.col("copied_run"), F.array_union(of, "copied")).otherwise(F.col(of))
    counted = placed.select(
        *by_item, with_run("places").alias("places"), with_run("own_places").alias("own_places"),
        (F.col("copied_run") | has_run(F.col("places"), max(1, 2 * length - window + 1))).alias("run"),
    )
    together = lambda of: F.size(F.array_distinct(F.flatten(F.collect_list(of))))
    covered = counted.groupBy(*by_item).agg(
        together("places").alias("n_covered"), together("own_places").alias("n_own"), F.bool_or("run").alias("run")
    )
    share = F.col("n_covered") / F.col("n_windows")
    # Items of a part are listed, not paired with documents; the shortest has the largest share.
    found = covered.where((share >= cover) | F.col("run")).join(members.withColumn("part", F.lit(True)), ["item_id", "n_windows", "part"], "left")
    enough = F.filter("same", lambda s: F.col("run") | (F.col("n_covered") / s.n_windows >= cover))
    ids = F.when(F.col("part"), F.transform(enough, lambda s: s.item_id)).otherwise(F.array("item_id"))
    best = F.max(F.struct(share.alias("covered"), (F.col("n_own") == F.col("n_covered")).alias("same_values"))).alias("best")
    finds = found.withColumn("ids", ids).groupBy("node", "doc_id", "item_id").agg(best, F.flatten(F.collect_list("ids")).alias("ids"))
    return finds.select("node", "doc_id", "item_id", "best.covered", "best.same_values", "ids")


def matches(documents: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """node, doc_id, item_id, covered share, whether all placeholder values are the item's own.

    Of items met only in their equal common parts, the shortest stands for all.
    """
    return found_items(documents, benchmark, **settings).drop("ids")


def contaminated(documents: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """One row a contaminated document: its items, the largest covered share, and whether values differ."""
    found = found_items(documents, benchmark, **settings).groupBy("node", "doc_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"),
        F.max("covered").alias("covered"),
        (~F.bool_and("same_values")).alias("reparameterised"),
    )
    items = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return found.select("node", "doc_id", F.size("ids").cast("bigint").alias("n_items"), items.alias("items"), "covered", "reparameterised")


def clean(documents: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows, with all their columns, of documents that no item contaminates."""
    name = unused(documents.columns, "row_name")
    nodes = matches(documents, benchmark, **settings).select(F.col("node").alias(name))
    named = documents.withColumn(name, row_key(F.col("doc_id"), F.col("text")))
    return named.join(nodes.hint("shuffle_hash"), name, "left_anti").drop(name)
