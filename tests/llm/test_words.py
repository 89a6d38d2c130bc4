import numpy as np
import pyarrow as pa
from helpers import space_split
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm.words import Hasher, space_words, text_slices, windows

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="abC \n\t\r\x0b\x1cé中", max_size=30)), max_size=20)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 60))
def test_words_of_slices_are_the_words_of_texts(texts, size):
    hasher, found, by_word = Hasher(), [[] for _ in texts], {}
    for piece in text_slices(pa.array(texts, pa.string()), size):
        words = space_words(piece, hasher)
        raw = piece.data.tobytes()
        for r, s, e, h in zip(words.row, words.start, words.end, words.hash, strict=True):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw[s:e].decode())
            found[piece.first + r].append(word)
            assert by_word.setdefault(word, h) == h
    assert found == [space_split(t) for t in texts]
    assert len(set(by_word.values())) == len(by_word)


def test_windows_stay_within_rows():
    [piece] = text_slices(pa.array(["a b c", "b c", "a b c d"]))
    row, at, found = windows(space_words(piece, Hasher()), 3)
    assert row.tolist() == [0, 2, 2]
    assert found[0] == found[1] != found[2]


def test_sliced_column_and_long_text():
    column = pa.array(["x", "a b", None, "c " * 5000]).slice(1)
    pieces = list(text_slices(column, 100))
    assert [(p.first, p.last) for p in pieces] == [(0, 2), (2, 3)]
    assert len(space_words(pieces[-1]).row) == 5000
    assert list(text_slices(pa.array([], pa.string()))) == []
    assert np.array_equal(space_words(next(text_slices(pa.array([None]).cast(pa.string())))).row, [])


def thue_morse(n):
    return "".join("ab"[i.bit_count() & 1] for i in range(n)), "".join("ba"[i.bit_count() & 1] for i in range(n))


def test_regular_words_have_hashes_of_their_own():
    words = [w for n in (2, 8, 9, 16, 63, 64, 65, 512, 1024, 2048, 4096) for w in thue_morse(n)]
    words += ["a" * n for n in range(1, 200) if n > 1] + ["a" * n + "\x00" for n in range(20)]
    [piece] = text_slices(pa.array(words))
    found = Hasher().ranges(piece.data, piece.offsets[:-1], piece.offsets[1:])
    assert len(set(found.tolist())) == len(set(words))
    # Wherever a range stands, its hash is the same.
    [piece] = text_slices(pa.array([f"x {w} y" for w in words]))
    again = space_words(piece, Hasher(), lower=False)
    by_place = again.hash[1::3]
    assert np.array_equal(by_place, found)
