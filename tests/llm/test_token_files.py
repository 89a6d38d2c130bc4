import zlib

import numpy as np
import pytest
from helpers import docs, nothing, odd, odd_rows

from basketry.llm import token_files as tf
from basketry.session import fresh_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tf.tokenizer_path())


def expected(tokenizer, rows):
    """(doc_id, start, n_tokens, crc) with documents in the order of the files."""
    found = []
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        found.append((doc_id, zlib.crc32(ids.tobytes()), len(ids)))
    found.sort(key=lambda x: (x[0] is not None, x))
    starts = np.cumsum([0, *(n for _, _, n in found)])
    return [(d, int(s), n, crc) for (d, crc, n), s in zip(found, starts, strict=False)]


def key(row):
    return (row[0] is not None, *row)


def test_odd_documents_read_back(spark, tokenizer):
    path = fresh_path(spark, "tokens")
    tf.write(odd(spark), path)
    got = sorted((tuple(r) for r in tf.digests(spark, path).collect()), key=key)
    want = expected(tokenizer, [r[:2] for r in odd_rows()])
    assert got == sorted(want, key=key)
    wanted = spark.createDataFrame([(6,), (8,), (3,), (77,)], "doc_id bigint")
    read = {r.doc_id: list(r.ids) for r in tf.read_documents(spark, path, wanted).collect()}
    texts = {r[0]: r[1] for r in odd_rows()}
    assert read == {d: [*tokenizer.encode(texts[d] or "", add_special_tokens=False).ids, 1] for d in (6, 8, 3)}
    index = spark.read.parquet(f"{path}/index")
    assert index.count() == len(odd_rows())
    assert {r[0] for r in index.select("dictionary_sha256").distinct().collect()} == {tf.read_dictionary(spark, path).sha256}


def test_all_documents_with_a_dictionary(spark, small, tokenizer):
    table = spark.read.parquet(f"{small}/documents.parquet")
    path = fresh_path(spark, "tokens")
    tf.write(table, path)
    assert len(tf.read_dictionary(spark, path).data) > 0
    got = sorted(tuple(r) for r in tf.digests(spark, path).collect())
    assert got == expected(tokenizer, [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()])


def test_another_dictionary_is_refused(spark):
    path = fresh_path(spark, "tokens")
    tf.write(docs(spark, ["a b c"]), path)
    other = spark.createDataFrame([("0" * 64, bytearray(b"x"), "<u2", 1)], tf.DICTIONARY_DDL)
    other.write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(ValueError, match="does not have its hash"):
        tf.digests(spark, path)


def test_empty_table(spark):
    assert tf.token_files(nothing(spark)).collect() == []


def test_forgetting_pieces_changes_nothing(tokenizer, monkeypatch):
    import pyarrow as pa

    from basketry.llm.words import text_slices

    monkeypatch.setattr(tf, "KNOWN_PIECES", 5)
    texts = ["It's a o'clock 'll", "séa. «x» …. a.b,c", "12 3a a3", "é́ x", "a b c d e f g h"] * 3
    encoder = tf.Encoder(tf.tokenizer_path())
    got = [x.tolist() for p in text_slices(pa.array(texts), 20) for x in encoder.encode(p)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_regular_words(spark, tokenizer):
    """Words that sums of powers modulo 2 ** 64 give one hash."""
    texts = ["".join(("ab", "ba")[k][i.bit_count() & 1] for i in range(n)) for n in (512, 1024, 2048, 4096) for k in (0, 1)]
    path = fresh_path(spark, "tokens")
    tf.write(docs(spark, texts), path)
    assert sorted(tuple(r) for r in tf.digests(spark, path).collect()) == expected(tokenizer, list(enumerate(texts)))


def test_same_dictionary_whatever_the_order(spark):
    """Also where a chosen id stands for many rows."""
    rows = [(i % 3, " ".join(f"word{(i * k) % 97}" for k in range(60))) for i in range(900)] * 2
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {tf.train_dictionary(t, tf.tokenizer_path()) for t in (table.repartition(3), table.repartition(5), table.orderBy("text"))}
    assert len(found) == 1 and found != {b""}


def test_pieces_that_share_a_hash(tokenizer, monkeypatch):
    import pyarrow as pa

    from basketry.llm.words import Hasher, text_slices

    monkeypatch.setattr(Hasher, "ranges", lambda self, data, start, end: ((end - start) // 2).astype(np.uint64))
    texts = ["the cat sat", "one two six", "cat one", "", "a b ab ba abc", "hello world, again", "the"] * 3
    encoder = tf.Encoder(tf.tokenizer_path())
    got = [x.tolist() for p in text_slices(pa.array(texts), 30) for x in encoder.encode(p)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_known_pieces_are_bounded_in_bytes(tokenizer, monkeypatch):
    """Few but long pieces, which a number of pieces does not bound."""
    import pyarrow as pa

    from basketry.llm.words import text_slices

    monkeypatch.setattr(tf, "KNOWN_BYTES", 1 << 16, raising=False)
    texts = [f"w{i} " + "abcdefgh"[i % 8] * 5000 + chr(97 + i % 26) for i in range(200)]
    encoder, most, got = tf.Encoder(tf.tokenizer_path()), 0, []
    for p in text_slices(pa.array(texts), 10_000):
        got += [x.tolist() for x in encoder.encode(p)]
        most = max(most, encoder.known.written)
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert most < (1 << 16) + 20_000


def test_a_task_gives_free_memory_back(monkeypatch):
    from basketry.llm import words

    given = []
    monkeypatch.setattr(words, "trim", lambda: given.append(len(given)))
    assert list(words.released(lambda batches: (x + 1 for x in batches))(iter([1, 2]))) == [2, 3]
    assert given == [0, 1]
