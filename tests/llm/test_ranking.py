import numpy as np
from helpers import docs, nothing, odd, odd_rows

from basketry.llm import ranking

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = ranking.classify(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    both = found.join(labels, "doc_id").toPandas()
    held = both[both.held_out]
    assert len(held) > 50
    assert (held.predicted == held.quality).mean() > 0.95
    assert ((both.score >= 0.5) == (both.predicted == 1)).all()
    assert both.score.between(0, 1).all()


def test_held_out_labels_are_not_read(spark):
    import zlib

    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.toPandas()
    out = flipped.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 3 == 1)
    flipped.loc[out, "quality"] = 1 - flipped.loc[out, "quality"]
    a, b = ranking.train(table, labels), ranking.train(table, spark.createDataFrame(flipped))
    assert np.array_equal(a.weights, b.weights) and a.threshold == b.threshold


def test_pairs_recover_a_hidden_order():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 3))
    good = x @ [2.0, -1.0, 0.0] + rng.normal(size=600) * 0.1 > -1
    model = ranking.fit(x, good)
    assert model.weights[0] > 0 > model.weights[1]
    assert ((model.score(x) >= 0.5) == good).mean() > 0.95
    # The threshold is the quantile: as many rows below it as are bad.
    assert (model.score(x) < 0.5).sum() == (~good).sum()


def test_odd_documents_and_labels(spark):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (2, 1), (3, None), (None, 0), (8, 1), (10, 0), (99, 1)], "doc_id bigint, quality int"
    )
    found = ranking.classify(odd(spark), labels).collect()
    assert len(found) == len(odd_rows())
    assert all(0 <= r.score <= 1 for r in found)
    same = [r.score for r in found if r.doc_id == 2]
    assert len(same) == 2 and same[0] == same[1]
    assert ranking.classify(nothing(spark), labels).collect() == []
    kept = ranking.keep_good(odd(spark), ranking.train(odd(spark), labels))
    assert kept.columns == odd(spark).columns


def test_one_label_only(spark):
    labels = spark.createDataFrame([(0, 1), (1, 1)], "doc_id bigint, quality int")
    assert [r.score for r in ranking.classify(docs(spark, ["a b", "c"]), labels).collect()] == [0.5, 0.5]


def learnt(spark, texts, quality):
    """Model of the rows of these texts and labels, and the one of the same rows in memory."""
    import pyarrow as pa

    from basketry.llm.words import Hasher, text_slices

    table = docs(spark, texts)
    labels = spark.createDataFrame([(i, int(q)) for i, q in enumerate(quality)], "doc_id bigint, quality int")
    held = [r[0] for r in table.select(ranking.held_out(table.doc_id)).collect()]
    x = np.concatenate([ranking.features(s, Hasher()) for s in text_slices(pa.array(texts))])[~np.array(held)]
    return ranking.train(table, labels), ranking.fit(x, np.array(quality)[~np.array(held)])


def alike(a, b):
    assert np.abs(b.weights).max() > 0.1
    for one, other in zip(a, b):
        assert np.allclose(one, other, rtol=1e-9, atol=1e-9)


def made(rows, seed=5):
    rng = np.random.default_rng(seed)
    good = rng.random(rows) < 0.6
    marks = rng.integers(1, 6, rows) + 4 * ~good
    return [f"text {'Word ' * int(k)}of {i}" + "! " * int(m) for i, (k, m) in enumerate(zip(rng.integers(1, 9, rows), marks))], good


def test_all_labelled_rows_are_learnt(spark):
    texts, good = made(36_000)
    good[30_000:] = ~good[30_000:]
    alike(*learnt(spark, texts, good))


def test_blocks_make_the_pairs_of_the_whole(spark, monkeypatch):
    """Fewer and more good rows than bad rows have turns, and than a block has turns."""
    monkeypatch.setattr(ranking, "BLOCK_ROWS", 16)
    for share in (0.02, 0.3, 0.97):
        texts, _ = made(900)
        good = np.random.default_rng(7).random(900) < share
        alike(*learnt(spark, texts, good))
