import hashlib
from collections import Counter

import pytest
from helpers import docs, nothing, odd, odd_rows
from pyspark.sql import functions as F

from basketry.llm import exact_dedup

PROSE = " ".join(f"Alpha {i} beta gamma. {'Delta' if i % 3 else 'Mu'} {i * i} end.\n" * (i % 5 == 0) + f"word{i}" for i in range(3000))


def want(rows):
    """(doc_id, keep_id, group_size, sha256) of every row, and how many rows of a (text, doc_id) stay."""
    texts = [(d, t or "") for d, t in rows]
    size = Counter(t for _, t in texts)
    keep = {t: max((d for d, u in texts if u == t and d is not None), default=None) for _, t in texts}
    return sorted(((d, keep[t], size[t], hashlib.sha256(t.encode()).hexdigest()) for d, t in texts), key=str)


def got(found):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str)


def test_chunks_make_up_the_text(spark):
    texts = ["", "a", PROSE, "x" * 10_000, "中。" * 5000, "😀" * 5000, "\n" * 3000, "a. B" * 2000, "\x00\r\n é" * 900]
    found = docs(spark, texts).select("text", exact_dedup.chunks(F.col("text")).alias("c")).collect()
    for r in found:
        assert "".join(r.c) == r.text
        assert all(0 < len(c) <= exact_dedup.MOST for c in r.c)


def test_shared_passages_share_chunks(spark):
    texts = [PROSE, "Another beginning here. " + PROSE[:9000] + " a different end"]
    one, two = (set(r.c) for r in docs(spark, texts).select(exact_dedup.chunks(F.col("text")).alias("c")).collect())
    assert len(one & two) >= 0.5 * len(two)


@pytest.mark.parametrize("bits", [64, 3, 0])
def test_against_brute_force(spark, bits):
    """Also where most or all chunks have one hash."""
    parts = [PROSE[i * 700 : i * 700 + 1500] for i in range(6)]
    texts = [a + b for a in parts for b in parts] + [b + a for a in parts for b in parts[:2]] + ["", None, "x", "x ", " x"] * 2
    rows = [((i * 7) % 101, t) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = exact_dedup.verdicts(table, bits).collect()
    assert got(found) == want(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)


def test_odd_documents(spark):
    found = exact_dedup.duplicates(odd(spark)).collect()
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert got(found) == want(rows)
    assert sum(r.kept for r in found) == len({t or "" for _, t in rows})
    kept = exact_dedup.deduplicated(odd(spark))
    assert kept.columns == odd(spark).columns
    assert Counter((r.text or "") for r in kept.collect()) == Counter({t or "" for _, t in rows})
    assert exact_dedup.duplicates(nothing(spark)).collect() == []
    assert exact_dedup.deduplicated(nothing(spark)).collect() == []


def test_texts_that_are_not_utf8(spark):
    table = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate([b"a\xff", b"a\xfe", b"a\xff"])], "doc_id bigint, raw binary")
    table = table.select("doc_id", F.col("raw").cast("string").alias("text"))
    assert sorted((r.doc_id, r.keep_id) for r in exact_dedup.verdicts(table).collect()) == [(0, 2), (1, 1), (2, 2)]


def test_no_python_in_the_plan(spark):
    plan = exact_dedup.verdicts(docs(spark, ["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
