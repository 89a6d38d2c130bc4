import math
from collections import Counter

import numpy as np
import pytest
from helpers import docs, nothing, odd, odd_rows, space_split

from basketry.llm import backoff


def grams(words, n):
    return [tuple(words[i - n + 1 : i + 1]) for i in range(n - 1, len(words))]


def scored(texts, order=3, factor=0.4):
    """n_words, score, n_backoff, n_unseen, straight from the definition."""
    texts = [space_split(t) for t in texts]
    total = sum(map(len, texts))
    known = Counter(g for t in texts for n in range(1, order + 1) for g in grams(t, n))
    found = []
    for t in texts:
        own = Counter(g for n in range(1, order + 1) for g in grams(t, n))
        others = known - own
        score, missed, unseen = 0.0, 0, 0
        for i in range(len(t)):
            longest = min(i + 1, order)
            for n in range(longest, -1, -1):
                gram = tuple(t[i - n + 1 : i + 1])
                if n and others[gram]:
                    context = others[gram[:-1]] if n > 1 else total - len(t)
                    score += math.log10(factor ** (longest - n) * others[gram] / context)
                    break
                if not n:
                    score += math.log10(factor**longest / total)
                    unseen += 1
            missed += n < longest
        found.append((len(t), score, missed, unseen))
    return found


def compare(got, want):
    key = lambda r: (str(r[0]), r[1], r[3], r[4], round(r[2], 4))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert (a[0], a[1], a[3], a[4]) == (b[0], b[1], b[3], b[4]) and abs(a[2] - b[2]) < 1e-6


@pytest.mark.parametrize(("order", "size", "grams"), [(3, 1 << 24, 1 << 21), (3, 300, 50), (2, 1000, 7), (1, 100, 1)])
def test_against_direct_scores(spark, order, size, grams):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.6, n) % 40) for n in rng.integers(0, 60, 80)]
    texts += ["w1 w2 " * 200, "W1 W2", "", None, "never seen", "w1 w2 " * 200]
    found = backoff.scores(docs(spark, texts).repartition(5), order, batch_bytes=size, range_grams=grams).collect()
    compare(found, [(i, *s) for i, s in enumerate(scored(texts, order))])


def test_one_document_knows_nothing_of_itself(spark):
    (row,) = backoff.scores(docs(spark, ["a b a b"])).collect()
    assert (row.n_words, row.n_backoff, row.n_unseen) == (4, 4, 4)
    copies = backoff.scores(docs(spark, ["a b a b", "A b a\nb", "c"])).orderBy("doc_id").collect()
    assert [(r.n_backoff, r.n_unseen) for r in copies] == [(0, 0), (0, 0), (1, 1)]


def test_odd_documents(spark):
    want = scored([r[1] for r in odd_rows()])
    compare(backoff.scores(odd(spark)).collect(), [(r[0], *w) for r, w in zip(odd_rows(), want, strict=True)])
    assert backoff.scores(nothing(spark)).collect() == []


def test_texts_are_shuffled_once(spark, capsys):
    found = backoff.scores(docs(spark, ["a b c"] * 9))
    found.explain("simple")
    plan = capsys.readouterr().out
    found.collect()
    found.explain("simple")
    assert "ReusedExchange" in plan + capsys.readouterr().out


def test_packing():
    for numbers in ([], [0], [0, 1, 255, 256, 2**64 - 1], list(range(1000))):
        numbers = np.array(numbers, np.uint64)
        assert np.array_equal(backoff.unpack(backoff.pack(numbers)), numbers)
        assert np.array_equal(backoff.unpack_few(backoff.pack_few(numbers.view(np.int64), 1), 1), numbers.view(np.int64))
