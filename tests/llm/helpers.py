"""Documents with everything that is odd, and small reference versions of what the operators do."""

import re

DDL = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, size int, copies int, "
    "score double, row_hash string, kept boolean, mix_own_hash int, row_name string"
)
LONG = " ".join(f"wörd{i % 997} and{i % 13}." for i in range(30_000))


def odd_rows() -> list[tuple]:
    texts = [
        (1, "the quick brown fox jumps over the lazy dog", "a"),
        (2, "the quick brown fox jumps over the lazy dog", "a"),
        (2, "the quick brown fox jumps over the lazy dog", "a"),
        (3, None, "a"),
        (4, "", None),
        (5, " \t\n\x0b\x0c\r ", "b"),
        (6, "one two", "b"),
        (7, "One TWO", "b"),
        (None, "no id here at all my friend", None),
        (8, LONG, "c"),
        (9, "ümlaut İstanbul \x1c <|endoftext|> ﬁ 中文 x\x00y ½", "c"),
        (9, "another text under the same id", "c"),
        (10, "!!! ### ||| ...", "z"),
    ]
    return [(d, t, "en", s, None, "n", 1, 2, 0.5, "h", True, i, "r") for i, (d, t, s) in enumerate(texts)]


def odd(spark):
    return spark.createDataFrame(odd_rows(), DDL)


def nothing(spark):
    return spark.createDataFrame([], DDL)


def docs(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def space_split(text, lower=True) -> list[str]:
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words] if lower else words


def shingle_set(text, n=5) -> frozenset:
    words = space_split(text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def classes(rows, percent=85) -> dict:
    """Smallest reachable id by row number, comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(root(i), []).append(i)
    return {
        i: min((rows[k][0] for k in group if rows[k][0] is not None), default=None)
        for group in members.values()
        for i in group
    }
