"""Secrets in whole texts: fixed patterns, and values whose guess cost is high.

A value that stands behind a credential word is cut into words, dates, repeats, keyboard walks and
brute-force spans so that the sum of their guess costs is least; a value that stays costly is a
secret, one that falls apart into guessable pieces ("changeme2024") is a placeholder. The span of
such a value is added with kind ``guess``; pattern spans always stay.

The cost is the least over all segmentations: words from a ranked list (as they are, capitalised or
with digits for letters), dates in all their forms, walks of three and more neighbouring keys from any
key to any other, and repeats, in which the unit of up to 64 characters before the span comes again.

Defined results: null text is empty; no finds give counts of 0, the digest of the empty string and
no spans; spans count code points, end exclusive, and go by start, kind as listed, then end; rows
that repeat give repeated results; an empty table gives no rows; other columns are ignored. Only
doc_id and text are read. A value of any length is segmented as a whole.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from basketry.llm.words import batch, runs, text_slices

FLAGS = re.ASCII | re.IGNORECASE
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", FLAGS)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "guess")
# Credential words, then a sign of assignment, then the value.
CONTEXT = re.compile(
    r"""(?:passwo?r?d|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth)"""
    r"""["']?\s*(?:=>|:=|[:=])\s*["'`]?([^\s"'`<>,;]{6,})|bearer\x20+([A-Za-z0-9+/_.=~-]{6,})""",
    FLAGS,
)
HINTS = (b"pass", b"pwd", b"secret", b"token", b"api", b"key", b"credential", b"auth", b"bearer")
GUESS_BITS = 45.0

# Words that guesses start from, commonest first.
COMMON = (
    "password 123456 admin welcome login letmein qwerty monkey dragon master secret test user root changeme default "
    "example sample demo guest temp token key api access public private account service server system database prod "
    "production staging local dev development your my the this here value string text name none null true false "
    "insert replace enter placeholder dummy foo bar baz hello world love baby angel summer winter spring autumn monday "
    "friday january june july august october december football baseball soccer hockey super star shadow sun moon magic "
    "princess hunter killer tiger cookie cheese pepper banana orange apple google amazon azure cloud github docker "
    "new old one two three four five"
).split()
LEET = str.maketrans("013457@$!", "oleastasi")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
SEGMENT_BITS = 1.0


def next_keys() -> set[tuple[str, str]]:
    """Pairs of keys that follow each other along a row, down a column, or in the alphabet."""
    pairs = {(a, b) for row in ROWS for a, b in zip(row, row[1:], strict=False)}
    pairs |= {(a, b) for up, down in zip(ROWS[:3], ROWS[1:4], strict=False) for a, b in zip(up, down, strict=False)}
    return pairs | {(b, a) for a, b in pairs}


NEXT_KEYS = next_keys()
RANKS = {w: i + 1 for i, w in enumerate(COMMON)}
DATE = re.compile(
    r"(?:19|20)\d\d(?:[-_./]?(?:0[1-9]|1[0-2])(?:[-_./]?(?:0[1-9]|[12]\d|3[01]))?)?"
    r"|(?:0[1-9]|[12]\d|3[01])[-_./]?(?:0[1-9]|1[0-2])[-_./]?(?:(?:19|20)\d\d|\d\d)"
)
DATE_LENGTHS = range(4, 11)
DATE_BITS = math.log2(366 * 100)
WALK, WALK_BITS = 3, math.log2(47) + 2.0
UNIT = 64


def char_bits(value: str) -> float:
    """Brute-force bits of one character: log2 of the sizes of the classes the value draws on."""
    if re.fullmatch("[0-9a-f]+", value) or re.fullmatch("[0-9A-F]+", value):
        return 4.0
    size = 26 * any("a" <= c <= "z" for c in value) + 26 * any("A" <= c <= "Z" for c in value)
    size += 10 * any("0" <= c <= "9" for c in value) + 33 * any(not c.isalnum() for c in value)
    size += 100 * any(ord(c) > 127 for c in value)
    return math.log2(max(size, 10))


def squares(value: str) -> dict[int, list[int]]:
    """By end: the units, up to ``UNIT`` characters and not repeats themselves, that stand there twice running."""
    codes = np.frombuffer(value.encode("utf-32-le"), np.uint32)
    ends: dict[int, list[int]] = {}
    same: dict[int, np.ndarray] = {}
    for unit in range(1, min(UNIT, len(codes) // 2) + 1):
        # For each end, how many characters before it equal those one unit earlier; 2 * UNIT stands for more.
        equal = np.concatenate([np.zeros(unit, bool), codes[unit:] == codes[:-unit]])
        at = np.arange(1, len(codes) + 1)
        run = np.minimum(at - np.maximum.accumulate(np.where(equal, 0, at)), 2 * UNIT - 1).astype(np.int8)
        if 2 * unit <= UNIT:
            same[unit] = run
        twice = run >= unit
        for part in range(1, unit // 2 + 1):
            if unit % part == 0:
                twice &= same[part] < unit - part
        for end in np.flatnonzero(twice).tolist():
            ends.setdefault(end + 1, []).append(unit)
    return ends


def word_bits(value: str, words: dict[str, int] = RANKS) -> dict[int, list[tuple[int, float]]]:
    """By end: (start, bits) of the words."""
    low = value.lower()
    if len(low) != len(value):
        low = "".join(c.lower() if c.isascii() else c for c in value)
    plain, longest = low.translate(LEET), max(map(len, words), default=0)
    ends: dict[int, list[tuple[int, float]]] = {}
    for i in range(len(value)):
        for j in range(i + 2, min(len(value), i + longest) + 1):
            for spelt in {low[i:j], plain[i:j]}:
                if rank := words.get(spelt):
                    word, leet = value[i:j], sum(a != b for a, b in zip(low[i:j], spelt, strict=True))
                    case = 0 if word == low[i:j] else 1 if word[1:] == low[i + 1 : j] or word.isupper() else len(word)
                    ends.setdefault(j, []).append((i, math.log2(rank + 1) + leet + case))
    return ends


def cheapest(starts: list[int], best: list[float], end: int, unit: int, extra: int) -> float:
    """Least ``best[start] + log2((end - start) / unit + extra)``; drops starts that can never be least again.

    The logarithms of two starts draw nearer as the end moves on, so a later start that is no cheaper
    than an earlier one never will be.
    """
    least, kept = math.inf, []
    for start in starts:
        bits = best[start] + math.log2((end - start) // unit + extra)
        if bits < least:
            least = bits
            kept.append(start)
    starts[:] = kept
    return least


def guess_bits(value: str, words: dict[str, int] = RANKS) -> float:
    """log2 of the guesses for the cheapest segmentation of the value."""
    n, per_char = len(value), char_bits(value)
    low = value.lower() if value.isascii() else "".join(c.lower() if c.isascii() else c for c in value)
    ending, twice = word_bits(value, words), squares(value)
    for i in range(n):
        if value[i] in "0123456789":
            for length in DATE_LENGTHS:
                if i + length <= n and DATE.fullmatch(value, i, i + length):
                    signs = not value[i : i + length].isdigit()
                    ending.setdefault(i + length, []).append((i, DATE_BITS + 2 * signs))
    best = [0.0] * (n + 1)
    walk, walks = 0, []
    copies: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for j in range(1, n + 1):
        # One more brute-force character extends the span before it.
        least = best[j - 1] + per_char
        for i, bits in ending.get(j, ()):
            least = min(least, best[i] + bits + SEGMENT_BITS)
        if j > 1 and (low[j - 2], low[j - 1]) not in NEXT_KEYS:
            walk, walks = j - 1, []
        if j - walk >= WALK:
            walks.append(j - WALK)
            least = min(least, cheapest(walks, best, j, 1, 0) + WALK_BITS + SEGMENT_BITS)
        for unit in twice.get(j, ()):
            last, starts = copies.get((unit, j % unit), (0, []))
            starts = [*starts, j - unit] if last == j - unit else [j - unit]
            least = min(least, cheapest(starts, best, j, unit, 1) + SEGMENT_BITS)
            copies[unit, j % unit] = j, starts
        best[j] = least
    return best[n]


def spans_of(text: str, bits: float = GUESS_BITS, words: dict[str, int] = RANKS) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every find, sorted."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 16]
    for m in CONTEXT.finditer(text):
        group = 1 if m[1] is not None else 2
        if guess_bits(m[group], words) >= bits:
            found.append((m.start(group), 3, m.end(group)))
    return sorted(found)


HEX_BYTES = np.isin(np.arange(256), list(b"0123456789abcdef"))
FOUND = pa.schema(
    [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
     ("base_sha256", pa.string()), ("spans", pa.string()), ("n_guess", pa.int64())]
)
NOTHING = hashlib.sha256(b"").hexdigest()


def scan(documents: DataFrame, bits: float = GUESS_BITS, words: dict[str, int] = RANKS) -> DataFrame:
    """One row a document with counts, the digest of the pattern spans, and all spans.

    ``words``: lower-case words with their ranks, 1 the commonest.
    """

    def listed(found) -> str:
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)

    def run(batches):
        for rows in batches:
            ids = rows.column(0).cast(pa.int64())
            for piece in text_slices(rows.column(1)):
                n = piece.last - piece.first
                row, start, end = runs(HEX_BYTES[piece.data], piece.offsets)
                marked = np.zeros(n, bool)
                marked[row[end - start >= 16]] = True
                counts = np.zeros((4, n), np.int64)
                sha, spans = [NOTHING] * n, [""] * n
                raw, at = piece.data.tobytes(), piece.offsets - piece.offsets[0]
                for i in range(n):
                    content = raw[at[i] : at[i + 1]]
                    # Every find holds one of these; the patterns themselves run on such texts only.
                    if not marked[i] and b"AKIA" not in content:
                        low = content.lower()
                        if not any(h in low for h in HINTS):
                            continue
                    found = spans_of(content.decode(), bits, words)
                    for _, kind, _ in found:
                        counts[kind, i] += 1
                    sha[i] = hashlib.sha256(listed(x for x in found if x[1] < 3).encode()).hexdigest()
                    spans[i] = listed(found)
                yield batch(FOUND, ids.slice(piece.first, n), counts[0], counts[1], counts[2], sha, spans, counts[3])

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_guess bigint"
    )
