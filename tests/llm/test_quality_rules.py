import collections
import re

import numpy as np
import pyarrow as pa
import pytest
from helpers import docs, nothing, odd, odd_rows, space_split

from basketry.llm import quality_rules as rules
from basketry.llm.words import Hasher, text_slices


def base(text):
    text = text or ""
    words = space_split(text, lower=False)
    grams = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        dup += bool(space_split(line)) and line in seen
        seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


TEXTS = [
    "a b c d e f g h " * 3,
    "a b c d e f g h\na b c d e f g h i\n\n\n \n \nx\nx\nx ",
    "ééé ### $$ | <b>\r\nx\r\nx",
    "A b c d e f g h a b c d e f g h",
    "y " * 40,
]


def test_surface_counts(spark):
    found = {r.doc_id: r for r in rules.judge(docs(spark, TEXTS), docs(spark, [])).collect()}
    for i, text in enumerate(TEXTS):
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(text)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)


def test_odd_documents(spark):
    trusted = spark.createDataFrame([(1,), (1,), (None,), (8,)], "doc_id bigint")
    found = rules.judge(odd(spark), trusted).collect()
    assert len(found) == len(odd_rows())
    want = sorted((str(r[0]), *base(r[1])) for r in odd_rows())
    got = sorted(
        (str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found
    )
    assert got == want
    assert all(r.ratio == 0 and not r.kept for r in found if r.n_words == 0)
    assert rules.judge(nothing(spark), trusted).collect() == []


def test_ratio_against_direct_counts(spark):
    texts = ["good words here", "good good words", "bad bad junk", "junk words bad"]
    table = docs(spark, texts)
    ratios = rules.log_ratios(table, spark.createDataFrame([(0,), (1,)], "doc_id bigint"), 64)
    [piece] = text_slices(pa.array(texts))
    row, bucket = rules.gram_buckets(piece, Hasher(), 64)
    raw, target = (np.bincount(bucket[np.isin(row, part)], minlength=64) + 1.0 for part in (range(4), range(2)))
    for half in (slice(0, 32), slice(32, 64)):
        want = np.log(target[half] / target[half].sum()) - np.log(raw[half] / raw[half].sum())
        assert np.allclose(ratios[half], want)


def test_junk_goes_and_clean_text_stays(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = rules.judge(spark.read.parquet(f"{sf}/documents.parquet"), rules.trusted_ids(labels))
    both = found.join(labels, "doc_id").where("n_words >= 20").toPandas()
    assert both[both.quality == 1].kept.mean() > 0.99
    assert both[both.quality == 0].kept.mean() < 0.1


@pytest.mark.parametrize("rows", [0, 1, 3])
def test_row_sums(rows):
    data = np.array([True, False, True, True][:rows])
    assert rules.row_sums(data, np.array([0, min(1, rows), rows])).tolist() == [int(data[:1].sum()), int(data[1:].sum())]
