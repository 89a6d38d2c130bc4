import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import classes, docs, nothing, odd, odd_rows, shingle_set

from basketry.llm import near_dup
from basketry.llm.words import Hasher, text_slices


def family(rng, words, copies, edits):
    """A text and copies of it with some words changed."""
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    found = [" ".join(base)]
    for _ in range(copies):
        changed = list(base)
        for _ in range(rng.randrange(edits + 1)):
            changed[rng.randrange(words)] = f"x{rng.randrange(5000)}"
        found.append(" ".join(changed))
    return found


def test_odd_documents(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    by_row = classes(rows)
    want = sorted(
        ((d, len(shingle_set(t)), by_row[i] if shingle_set(t) else d) for i, (d, t) in enumerate(rows)),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1]),
    )
    found = near_dup.near_duplicates(odd(spark)).select("doc_id", "n_shingles", "component_id")
    got = sorted((tuple(r) for r in found.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == want
    kept = near_dup.deduplicated(odd(spark))
    assert kept.columns == odd(spark).columns
    # 2 and the rows that repeat it go with 1, 7 goes with 6
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 8, 9, 9, 10]


def test_empty_table(spark):
    assert near_dup.near_duplicates(nothing(spark)).collect() == []
    assert near_dup.deduplicated(nothing(spark)).collect() == []


@pytest.mark.parametrize("part", [256, 3])
def test_families_against_all_pairs(spark, monkeypatch, part):
    monkeypatch.setattr(near_dup, "PART", part)
    rng = random.Random(5)
    texts = []
    for words, copies, edits in [(60, 40, 2), (200, 15, 6), (30, 10, 1), (12, 6, 1), (80, 30, 3)]:
        texts += family(rng, words, copies, edits)
    texts += texts[:20] + [t.upper() for t in texts[:3]]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    found = near_dup.near_duplicates(docs(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in found} == classes(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_classes_that_only_meet_across_parts(spark, monkeypatch):
    """A chain of texts whose ends are far apart, all in the group of one hub."""
    monkeypatch.setattr(near_dup, "PART", 2)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(12):
        words[rng.randrange(120)] = f"y{i}"
        words[rng.randrange(120)] = f"z{i}"
        texts.append(" ".join(words))
    found = near_dup.near_duplicates(docs(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in found} == classes(list(enumerate(texts)))


def test_bands_find_pairs_and_estimate_similarity():
    rng = random.Random(2)
    met, error = 0, []
    for _ in range(200):
        base = [rng.randrange(10**9) for _ in range(400)]
        other = [rng.randrange(10**9) if rng.random() < 0.08 else x for x in base]
        rows = np.concatenate([np.unique(np.array(x, np.uint64) * np.uint64(near_dup.SEED * 2**33 + 1)) for x in (base, other)])
        kept = near_dup.signatures(rows, np.array([0, 400]))
        true = len(set(base) & set(other)) / len(set(base) | set(other))
        error.append((kept[:, 0] == kept[:, 1]).mean() - true)
        keys = near_dup.band_keys(kept)
        met += bool((keys[0] == keys[1]).any())
    assert met == 200
    assert abs(np.mean(error)) < 0.01


def test_sets_of_a_slice():
    texts = ["a b c d e f", "a b", "", "A B", "a a a a a a a a"]
    [piece] = text_slices(pa.array(texts))
    row, _ = near_dup.shingle_sets(piece, Hasher())
    assert np.bincount(row, minlength=5).tolist() == [len(shingle_set(t)) for t in texts]
    assert np.bincount(row, minlength=5).tolist() == [2, 1, 0, 1, 1]


def test_regular_words_are_not_linked(spark):
    texts = ["".join(("ab", "ba")[k][i.bit_count() & 1] for i in range(n)) for n in (512, 1024, 2048, 4096) for k in (0, 1)]
    found = near_dup.near_duplicates(docs(spark, texts)).collect()
    assert all(r.kept and r.component_id == r.doc_id for r in found)
