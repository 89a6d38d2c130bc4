import itertools
import random
import re
import time

import pytest
from helpers import docs, nothing, odd, odd_rows

from basketry.llm import license_scan as scan


def accepts(template, text):
    words = scan.WORD.findall(text.lower())
    return scan.compile_template(template).longest(words, 0) == len(words)


@pytest.mark.parametrize(
    ("text", "accepted"),
    [
        ("a b", True),
        ("a x b", True),
        ("a x y b", True),
        ("a x y z b", False),
        ("a b c", True),
        ("a b c d", True),
        ("a b d", False),
        ("a", False),
        ("b", False),
    ],
)
def test_regions(text, accepted):
    assert accepts("a {{some:2}} b [[c [[d]]]]", text) == accepted


def test_first_words():
    assert scan.compile_template("[[a]] b").first_words == {"a", "b"}
    assert scan.compile_template("{{x:1}} b").first_words is None
    with pytest.raises(ValueError, match="not closed"):
        scan.compile_template("[[a")


TEXTS = [
    "x\nThis work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0. Licensed under CC-BY.",
    "All rights reserved. all Rights, reserved",
    "Released under the MIT License.",
    "Licensed under the Apache License, Version 2.0.",
    "general public licenses cc bye account by all rights",
    "Copyright (c) 2020 Some One and Others. All rights reserved.",
    "é cc by",
    scan.TEMPLATES["mit"].replace("{{holders:8}}", "THE AUTHORS").replace("[[including the next paragraph]]", ""),
    scan.TEMPLATES["mit"].replace("{{holders:8}}", "THE AUTHORS").replace("copies", "copy").replace("[[", "").replace("]]", ""),
]


def test_phrases_and_templates(spark):
    found = {r.doc_id: r for r in scan.scan(docs(spark, TEXTS)).collect()}
    get = lambda i: (found[i].n_base, found[i].first_word, found[i].last_word, found[i].base_labels, found[i].labels)
    assert get(0) == (1, 8, 8, "gpl", "gpl,gpl-notice")
    assert get(1) == (2, 2, 9, "cc-by", "cc-by,cc-by-nc-notice")
    assert get(2) == (2, 0, 3, "reserved", "reserved")
    assert get(3) == (0, None, None, "", "mit-notice")
    assert get(4) == (0, None, None, "", "apache-2.0-notice")
    assert get(5) == (0, None, None, "", "")
    assert get(6) == (1, 7, 7, "reserved", "copyright-notice,reserved")
    assert get(7) == (1, 1, 1, "cc-by", "cc-by")
    assert get(8)[4] == "mit"
    assert get(9)[4] == ""
    assert found[2].score == 1 and found[5].score == 0 and 0 < found[0].score < 1
    assert found[8].score == 1


def expanded(template):
    """Every wording of a small template over the words a, b and x, as lists of words."""
    tokens = scan.TOKEN.findall(template)

    def parsed(at):
        found = [[]]
        while at < len(tokens) and tokens[at] != "]]":
            if tokens[at] == "[[":
                inner, at = parsed(at + 1)
                parts = [[], *inner]
            elif tokens[at].startswith("{{"):
                most = int(tokens[at][2:-2].split(":")[1])
                parts = [list(w) for n in range(most + 1) for w in itertools.product("abx", repeat=n)]
            else:
                parts = [[tokens[at]]]
            found = [[*f, *p] for f in found for p in parts]
            at += 1
        return found, at

    return {tuple(w) for w in parsed(0)[0] if w}


@pytest.mark.parametrize(
    "template",
    ["a b", "[[a]] b", "{{p:2}} a", "{{p:2}} a {{q:1}} b", "[[a [[b]]]] x a", "[[{{p:1}} b]] a [[a]]", "a {{p:2}}", "[[a]] [[b]]", "{{p:2}}"],
)
def test_finds_equal_expanded_templates(template):
    wordings = expanded(template)
    automata = {"t": scan.compile_template(template)}
    draw = random.Random(3)
    for _ in range(300):
        words = draw.choices("abx", k=draw.randint(0, 12))
        want, covered = [], 0
        for i in range(len(words)):
            lengths = [n for n in range(1, len(words) - i + 1) if tuple(words[i : i + n]) in wordings]
            if i >= covered and lengths:
                want.append((i, max(lengths), "t"))
                covered = i + max(lengths)
        assert scan.finds(words, automata, {})[1] == want


def test_changed_wording_loses_the_label():
    automata = {label: scan.compile_template(t) for label, t in scan.TEMPLATES.items()}
    for label in ("isc", "bsd", "mit", "unlicense", "apache-2.0-header", "mpl-2.0-header"):
        words = plain(scan.TEMPLATES[label]).split()
        words = [w for token in words for w in scan.WORD.findall(token)]
        own = {label: automata[label]}
        assert scan.finds(words, own, {})[1] == [(0, len(words), label)]
        fixed = len(words) - 3  # a word near the end of the disclaimer
        assert scan.finds([*words[:fixed], "changed", *words[fixed + 1 :]], own, {})[1] == []
        assert scan.finds([*words[: len(words) // 2], "added", *words[len(words) // 2 :]], own, {})[1] in ([], [(0, len(words) + 1, label)])


def test_long_texts_cost_their_length():
    automata = {label: scan.compile_template(t) for label, t in scan.TEMPLATES.items()}
    notice = "random words here today released under the mit license".split()
    start = time.monotonic()
    base, matched = scan.finds(["filler"] * 1_000_000 + notice, automata, scan.PHRASES)
    assert base == [] and matched == [(1_000_004, 5, "mit-notice")]
    permission = plain(scan.TEMPLATES["mit"]).split()[:60]
    assert scan.finds(permission * 5_000, automata, scan.PHRASES) == ([], [])
    assert scan.finds("under the terms of the gnu".split() * 50_000, automata, scan.PHRASES) == ([], [])
    assert time.monotonic() - start < 60


def plain(template):
    """The mandatory wording, "word" where wording is free."""
    text = re.sub(r"\[\[|\]\]", lambda m: f" {m[0]} ", re.sub(r"\{\{[a-z]+:\d+\}\}", "word", template))
    while "[[" in text:
        text = re.sub(r"\[\[[^\[\]]*\]\]", "", text)
    return text


def test_odd_documents(spark):
    found = scan.scan(odd(spark)).collect()
    want = sorted((str(r[0]), len(scan.WORD.findall(lower(r[1])))) for r in odd_rows())
    assert sorted((str(r.doc_id), r.n_words) for r in found) == want
    assert all(r.labels == "" and r.score == 0 and r.first_word is None for r in found)
    assert scan.scan(nothing(spark)).collect() == []


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_every_template_accepts_its_own_wording():
    for label, template in scan.TEMPLATES.items():
        assert accepts(template, plain(template)), label
        assert all(w.decode() in scan.WORD.findall(plain(template)) for w in scan.mandatory(template))
