import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import LONG, docs, nothing, odd, odd_rows

from basketry.llm import token_alignment as ta
from basketry.llm.token_files import tokenizer_path
from basketry.llm.words import text_slices


@pytest.fixture(scope="module")
def aligner():
    return ta.Aligner(tokenizer_path(ta.SIDE_A), tokenizer_path(ta.SIDE_B))


def whole(aligner, text):
    """Groups of a text that is encoded at once, or none if its bytes do not come back."""
    if not text:
        return []
    a = aligner.a.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.encode(text)
    given = (" " + text).encode()
    if b"".join(aligner.a_bytes[i] for i in a) != given or b"".join(aligner.b_bytes[i] for i in b) != given:
        return []
    sides = []
    for ids, table in ((a, aligner.a_bytes), (b, aligner.b_bytes)):
        at, by_end = 0, {}
        for i in ids:
            at += len(table[i])
            by_end[at] = i
        sides.append(by_end)
    found, group = [], ([], [])
    for end in sorted(set(sides[0]) | set(sides[1])):
        for side, own in zip(sides, group, strict=True):
            if end in side:
                own.append(side[end])
        if end in sides[0] and end in sides[1]:
            found.append(group)
            group = ([], [])
    return found


def want(aligner, rows):
    groups = [whole(aligner, t) for _, t in rows]
    links = [[(x, y) for a, b in g for x in a for y in b] for g in groups]
    count = Counter(p for own in links for p in set(own))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    found = []
    for (d, _), g, own in zip(rows, groups, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        found.append(
            (d, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(own),
             sum(count[p] == best[p[0]] for p in own), sum(count[p] for p in own), hashlib.sha256(text.encode()).hexdigest() if g else "")
        )
    return sorted(found, key=str), count, best


def got(rows):
    names = ta.DIGESTS.names
    return sorted((tuple(r[n] for n in names) for r in rows), key=str)


SIGNS = ["a", "the", "é", "à", "ß", "İ", "中文", "日", "😀", " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", " ", "　", "\x85",
         "▁", "'s", "'", ".", "...", "!!!!!!!!!", "<s>", "</s>", "<unk>", "<0x41>", "<|endoftext|>", "123", "4567890", "\x00", "\x1c",
         "x" * 40, "Ã", "Â", "́", "ﬁ", "½", "-", "_", "#", "ŁódŹ", "สวัสดี", "مرحبا"]


def random_texts(n, seed=3):
    draw = random.Random(seed)
    texts = ["".join(draw.choices(SIGNS, k=draw.randint(1, 30))) for _ in range(n)]
    return texts + [" ".join(draw.choices(SIGNS, k=draw.randint(1, 30))) for _ in range(n)]


def test_pieces_give_the_groups_of_whole_texts(aligner):
    texts = random_texts(3000)
    aligner.forget()
    for piece in text_slices(pa.array(texts), 1 << 14):
        found = aligner.align(piece)
        for i, digest in enumerate(found.digests):
            g = whole(aligner, texts[piece.first + i])
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            assert digest == (hashlib.sha256(text.encode()).hexdigest() if g else ""), texts[piece.first + i]
            assert [s[i] for s in found.sizes] == [sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(len(a) * len(b) for a, b in g)]


def test_against_brute_force(spark, aligner, monkeypatch):
    texts = random_texts(150, 5) + ["the same text here"] * 9 + ["", None, " ", LONG[:3000]]
    rows = [(i % 290, t) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    expected, count, best = want(aligner, rows)
    found = ta.runs(table, run_bytes=300)
    assert found.where("kind = 'pairs'").select("run").distinct().count() > 8
    assert got(ta.digests(found, ta.counts(found)).collect()) == expected
    pairs = {(r.a, r.b): (r.n_docs, r.best) for r in ta.pair_counts(table).collect()}
    assert pairs == {p: (n, n == best[p[0]]) for p, n in count.items()}


def test_merge_in_levels(spark, aligner):
    """More runs than one merge takes."""
    rows = [(i, f"word{i % 7} the and {i % 3}") for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    found = ta.runs(table, run_bytes=1)
    assert got(ta.digests(found, ta.counts(found)).collect()) == want(aligner, rows)[0]


def test_large_groups(aligner, monkeypatch):
    """Tokens that nowhere end together are counted by distinct ids."""
    monkeypatch.setattr(ta, "SMALL_GROUP", 1)
    aligner.forget()
    text = "สวัสดีมรحبا中文日本" * 40 + "!" * 333 + "=-" * 300
    [piece] = text_slices(pa.array([text]))
    found = aligner.align(piece)
    groups = whole(aligner, text)
    links = Counter((x, y) for a, b in groups for x in a for y in b)
    a, b = ta.ids(found.pairs.astype(np.int64))
    assert dict(zip(zip(a.tolist(), b.tolist(), strict=True), found.times.tolist(), strict=True)) == links


def test_odd_documents(spark, aligner):
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert got(ta.alignment(odd(spark)).collect()) == want(aligner, rows)[0]
    assert ta.alignment(nothing(spark)).collect() == []
    assert ta.pair_counts(nothing(spark)).collect() == []
    only_empty = ta.alignment(docs(spark, ["", None])).collect()
    assert got(only_empty) == [(0, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]
