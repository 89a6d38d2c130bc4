from helpers import docs, nothing, odd

from basketry.llm import decontaminate as check

ITEM = "A train leaves Paris at 80 km per hour and meets Anna after 3 hours. How far did Anna wait from Paris?"
BENCH = [
    (1, ITEM),
    (2, "the rarest flower of the northern valley opens only when heavy rain has fallen for weeks"),
    (2, "the rarest flower of the northern valley opens only when heavy rain has fallen for weeks"),
    (3, "short item of six words only"),
    (4, "too short"),
    (5, None),
]
FILLER = "some words before that say nothing much about anything in particular. "


def benchmark(spark, rows=BENCH):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def found(spark, texts, **settings):
    rows = check.contaminated(docs(spark, texts), benchmark(spark), **settings).collect()
    return {r.doc_id: (r["items"], r.reparameterised) for r in rows}


def test_exact_changed_and_clean(spark):
    new = ITEM.replace("Paris", "London").replace("Anna", "Peter").replace("80", "95").replace("3 hours", "7 hours")
    mixed = ITEM.replace("leaves Paris", "leaves London").replace("3 hours", "7 hours").replace("meets Anna", "meets Paris")
    texts = [
        FILLER + ITEM + " " + FILLER,
        FILLER + new,
        mixed,
        FILLER * 5,
        BENCH[1][1].upper(),
        BENCH[1][1].replace("heavy", "light") + " " + ITEM,
        FILLER + BENCH[3][1],
        "too short",
        "",
    ]
    got = found(spark, texts)
    assert got[0] == ("1", False)
    assert got[1] == ("1", True)
    assert 2 not in got or got[2][1] is False
    assert 3 not in got and 7 not in got and 8 not in got
    assert got[4] == ("2", False)
    assert got[5] == ("1,2", False)
    assert got[6] == ("3", False)


def test_inconsistent_slots_do_not_count(spark):
    item = [(9, "then Anna gave Bob 5 apples and Bob gave Anna 6 pears and then Anna thanked Bob for 6 pears")]
    same = "then Carl gave Dora 2 apples and Dora gave Carl 9 pears and then Carl thanked Dora for 9 pears"
    muddled = "then Carl gave Dora 2 apples and Emil gave Fred 9 pears and then Gina thanked Hans for 1 pears"
    rows = check.matches(docs(spark, [same, muddled]), benchmark(spark, item), literal=2).collect()
    assert {(r.doc_id, r.same_values) for r in rows} == {(0, False)}


def test_cleaning_keeps_columns_and_odd_rows(spark):
    rows = check.clean(odd(spark), benchmark(spark))
    assert rows.columns == odd(spark).columns
    assert rows.count() == odd(spark).count()
    assert check.contaminated(nothing(spark), benchmark(spark)).collect() == []
    assert check.contaminated(odd(spark), benchmark(spark, [])).collect() == []
    assert check.contaminated(odd(spark), benchmark(spark)).collect() == []


def test_whole_items_in_given_documents(spark, small):
    """Every document that holds an item's words in a row is found, and no other."""
    import re

    table = spark.read.parquet(f"{small}/documents.parquet")
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    plain = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    wanted = {}
    for item in items.collect():
        for row in table.collect():
            if plain(item.text) in plain(row.text):
                wanted.setdefault(row.doc_id, set()).add(item.item_id)
    got = check.contaminated(table, items).collect()
    assert {r.doc_id: set(map(int, r["items"].split(","))) for r in got} == wanted


def test_small_bitmap_only_lets_more_through(spark):
    items = check.item_windows(benchmark(spark)).cache()
    table = docs(spark, [FILLER + ITEM, FILLER * 20])
    few = check.document_windows(table, items, bits=8).count()
    many = check.document_windows(table, items).count()
    assert few >= many > 0


def test_items_of_numbers_are_found_as_copies(spark):
    items = [(1, "What is 37 * 48 + 92?"), (2, "3 5 8 13 21 34 55 89"), (3, "Add 3 and 5 to 8 then list 13 21 34 55 in order of size")]
    texts = [
        FILLER + "What is 37 * 48 + 92? " + FILLER,
        FILLER + "What is 38 * 48 + 92? " + FILLER,
        "so 3 5 8 13 21 34 55 89 it goes",
        "so 4 6 9 14 22 35 56 90 it goes",
        "Add 4 and 6 to 9 then list 14 22 35 56 in order of size",
    ]
    rows = check.contaminated(docs(spark, texts), benchmark(spark, items)).collect()
    assert {r.doc_id: (r["items"], r.reparameterised) for r in rows} == {0: ("1", False), 2: ("2", False), 4: ("3", True)}


def test_share_is_of_all_windows(spark):
    item = "1 2 3 4 5 6 7 8 9 10 the sum of all is asked 11 12 13 14 15 16 17 18 19 20"
    assert found_rows(spark, "here the sum of all is asked again", item) == []


def found_rows(spark, text, item):
    return check.contaminated(docs(spark, [text]), benchmark(spark, [(1, item)])).collect()


def test_names_wherever_they_stand(spark):
    items = [
        (1, "Tom has 5 apples. Tom gives 2 away. Tom eats 1 more. How many apples are left?"),
        (2, "the basket that Maria's uncle brought from town holds both Maria's hat and O'Brien's old umbrella"),
        (3, "somebody bought 3 apples and 5 pears at the market before the rain began to fall"),
    ]
    texts = [
        "Anna has 7 apples. Anna gives 3 away. Anna eats 2 more. How many apples are left?",
        "the basket that Anna's uncle brought from town holds both Anna's hat and McCoy's old umbrella",
        "somebody bought 4 apples and 4 pears at the market before the rain began to fall",
    ]
    rows = check.matches(docs(spark, texts), benchmark(spark, items)).collect()
    assert {(r.doc_id, r.item_id, r.covered, r.same_values) for r in rows} >= {(0, 1, 1.0, False), (1, 2, 1.0, False), (2, 3, 1.0, False)}


def test_one_clash_drops_only_its_windows(spark):
    item = [(1, "then Bob met Eve at 7 by the old town gate and all of them walked along the quiet river until Bob was tired")]
    text = "then Dan met Eve at 7 by the old town gate and all of them walked along the quiet river until Max was tired"
    rows = check.matches(docs(spark, [text]), benchmark(spark, item)).collect()
    assert [(r.doc_id, round(r.covered * 19)) for r in rows] == [(0, 14)]


def test_passages_of_long_items(spark):
    words = [f"{a}{b}" for a in ("ba", "de", "fi", "go", "ku", "la", "me", "no", "pu", "ri") for b in ("lor", "mun", "nas", "pet", "rik", "sol")]
    long = [words[(7 * i + i // 60) % 60] for i in range(300)]
    names = [w if i % 5 else f"Mr{w[:2]}{w[2]}".title() for i, w in enumerate(long)]
    items = [(1, " ".join(long)), (2, "so " + " ".join(names))]
    changed = " ".join(w.replace("Mr", "Dr") for w in names[100:140])
    texts = [FILLER + " ".join(long[i:j]) + " " + FILLER for i, j in ((20, 80), (200, 213), (200, 212))] + [FILLER + "so then " + changed]
    rows = check.contaminated(docs(spark, texts), benchmark(spark, items)).collect()
    assert {r.doc_id: (r["items"], r.reparameterised) for r in rows} == {0: ("1", False), 1: ("1", False), 3: ("2", True)}


def test_readings_by_halves_are_all_readings(spark):
    """Long windows in capitals and not, against every reading of every window."""
    import random

    import numpy as np
    import pyarrow as pa

    from basketry.llm.words import Hasher, text_slices

    rng = random.Random(5)
    words = ["Ann", "bob", "CAT", "dog", "Eve's", "fig", "12", "km", "Gus", "hat."]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [text(40) for _ in range(6)]
    texts = [text(60) + " " + item.replace("Ann", "Zoe").replace("12", "7") for item in items] + [items[0].upper(), "", text(11)]
    hasher = Hasher()
    units = check.unit_hashes(hasher)
    tokens = lambda rows: check.tokens(next(text_slices(pa.array(rows))), hasher, units)
    for n in (11, 12):
        own = tokens(items)
        wanted = list(check.token_windows(own, n, 6, 4))
        known = {x for w in wanted for h in check.halves(own, w) for x in h.tolist()}
        full = {x for w in wanted for x in w.hash.tolist()}
        other = tokens(texts)
        brute = {(i, h, m) for w in check.token_windows(other, n, 6, 4) for i, h, m in zip(w.at.tolist(), w.hash.tolist(), w.names.tolist(), strict=True) if h in full}
        w = check.long_windows(other, n, 4, list(range(64)), lambda keys: np.isin(keys, list(known)))
        got = {(i, h, m) for i, h, m in zip(w.at.tolist(), w.hash.tolist(), w.names.tolist(), strict=True) if h in full}
        assert got == brute and brute


def test_long_text_in_capitals_takes_seconds(spark):
    import time

    item = [(1, " ".join(["Ann BOB Eve-Lyn 12 km MAX"] * 8) + " ends the story here")]
    caps = " ".join(f"WORD{'ABCDEFGHIJ'[i % 10]}{'KLMNOPQRST'[i // 10 % 10]}" for i in range(20_000))
    start = time.monotonic()
    assert check.contaminated(docs(spark, [caps]), benchmark(spark, item)).collect() == []
    assert time.monotonic() - start < 25


LINE = "read the question below with care and choose one of the four answers given under it"


def many_items(n):
    return [(i, f"{LINE} q{i}a q{i}b q{i}c q{i}d q{i}e q{i}f q{i}g q{i}h") for i in range(n)]


def test_a_line_of_all_items_does_not_pair_them_with_all_documents(spark):
    items = benchmark(spark, [*many_items(200), (500, "the rarest flower of the northern valley opens only when rain has fallen")])
    texts = [f"{LINE} d{i}a d{i}b d{i}c" for i in range(200)] + ["so " + many_items(50)[42][1]]
    rows = check.matches(docs(spark, texts), items).collect()
    # The line alone is one part, named by its smallest item; a whole item is found itself.
    assert len(rows) == 202
    assert {r.item_id for r in rows if r.doc_id < 200} == {0}
    assert {(r.item_id, r.covered) for r in rows if r.doc_id == 200 and r.item_id} == {(42, 1.0)}


def test_shared_windows_lose_no_document(spark):
    """With every window counted as shared by many items or none, the same documents are found."""
    names = ["Ann", "Ben", "Cora", "Dan"]
    same = [(i, f"then {a} gave {b} {i} apples and {b} gave {a} 6 pears and then {a} thanked {b} again for 6 pears") for i, (a, b) in enumerate((a, b) for a in names for b in names if a != b)]
    items = [*many_items(6), *same, (90, same[0][1]), (91, same[0][1])]
    texts = [LINE, LINE[:40], "so " + items[3][1], same[5][1], same[5][1].replace("Dan", "Eli"), "then Ann gave Ben 3 apples", items[2][1] + " " + same[1][1]]
    found = lambda shared: {
        r.doc_id: (r.covered, r.reparameterised) for r in check.contaminated(docs(spark, texts), benchmark(spark, items), shared=shared).collect()
    }
    every = found(1000)
    for shared in (0, 1, 3):
        assert {k: v[0] for k, v in found(shared).items()} == {k: v[0] for k, v in every.items()}


def test_every_item_with_a_common_part_is_named(spark):
    """The items of a document do not depend on how many items share a window; longer items need more of it."""
    words = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    part = " ".join(LINE.split()[:11])  # no run of 13: the share of the item decides
    items = [(i, f"{part} q{i}a q{i}b q{i}c") for i in range(4)] + [(9, f"{part} {words}"), (10, f"{LINE} {words[::-1]}"), (11, f"{LINE} {words}")]
    texts = [part, f"so {LINE} it is", f"then {LINE} and {part} again", "nothing of the kind is to be found in here", items[2][1]]
    found = lambda shared: {
        r.doc_id: (r.n_items, r["items"]) for r in check.contaminated(docs(spark, texts), benchmark(spark, items), shared=shared).collect()
    }
    every = found(1000)
    assert every[0] == (4, "0,1,2,3") and every[1] == (6, "0,1,2,3,10,11")
    for shared in (0, 2, 5):
        assert found(shared) == every


def test_clashes_and_runs(spark):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(3)
    kinds = [[f"{k}:{v}" for v in "abcde"] for k in (1, 2)]
    cases = []
    for _ in range(60):
        pairs = {tuple(rng.choice(kind) for _ in "ab") for kind in rng.choices(kinds, k=rng.randrange(6))}
        cases.append((sorted(pairs), rng.sample(range(12), rng.randrange(10)), rng.randrange(1, 5)))
    table = spark.createDataFrame(cases, "pairs array<struct<item string, doc string>>, places array<int>, n int")
    for n in (1, 2, 4):
        rows = table.select("pairs", "places", check.clashing(F.col("pairs")).alias("bad"), check.has_run(F.col("places"), n).alias("run")).collect()
        for r in rows:
            pairs = [tuple(p) for p in r.pairs]
            breaks = lambda p, q: (p[0] == q[0] and p[1] != q[1]) or (p[0] != q[0] and p[1] == q[1] and p[0][0] == "2")
            assert {tuple(p) for p in r.bad} == {p for p in pairs if any(breaks(p, q) for q in pairs)}
            assert r.run == any(all(x + k in r.places for k in range(n)) for x in r.places)
