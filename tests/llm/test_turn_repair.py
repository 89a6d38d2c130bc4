import hashlib
import itertools
import random
import re
import zlib

import pytest

from basketry.llm import turn_repair as tr

DDL = "conv_id bigint, turn bigint, role string, text string, audit string, n string, cost string"
GRAMMAR = re.compile("(s?(ua)+)?")


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], DDL)


def brute(rows):
    """Least (cost, audit) over all edits of (initial, fault) rows, trying every sequence of letters."""
    best = None
    for n_inserts in range(len(rows) * 2 // 5 + 1):
        for gaps in itertools.combinations_with_replacement(range(len(rows) + 1), n_inserts):
            for letters in itertools.product("DKR", repeat=len(rows)):
                audit = "".join("I" * gaps.count(i) + (letters[i] if i < len(rows) else "") for i in range(len(rows) + 1))
                cost = 5 * n_inserts
                for letter, (_, fault) in zip(letters, rows, strict=True):
                    if letter != "D" and fault in (tr.BLANK, tr.DUPLICATE):
                        break
                    cost += {"D": 2, "K": 0, "R": 1}[letter] + (5 if letter != "D" and fault == tr.CUT else 0)
                else:
                    if (best is None or (cost, audit) < best) and fits(audit, rows):
                        best = cost, audit
    return best


def fits(audit, rows):
    """Whether new and changed turns can be given roles that make the order right."""
    left, options = iter(rows), []
    for letter in audit:
        initial = next(left)[0] if letter != "I" else ""
        if letter != "D":
            options.append(initial if letter == "K" else "ua")
    return any(GRAMMAR.fullmatch("".join(x)) for x in itertools.product(*options)) if "" not in options else False


def test_cheapest_edits_against_all_edits():
    draw = random.Random(2)
    for _ in range(400):
        rows = [(draw.choice("suatuaua"), draw.choice([tr.OK] * 5 + [tr.BLANK, tr.DUPLICATE, tr.CUT])) for _ in range(draw.randint(1, 5))]
        paths = [p for entry in range(4) for p in tr.through([tr.Row(0, *r) for r in rows], entry)]
        assert tr.closed(paths) == brute(rows), rows


def test_blocks_join_to_the_same():
    draw = random.Random(4)
    for length in (7, 40, 300):
        rows = [tr.Row(0, draw.choice("suatuaua"), draw.choice([tr.OK] * 4 + [tr.BLANK, tr.DUPLICATE, tr.CUT])) for _ in range(length)]
        whole = tr.closed(tr.through(rows, tr.START))
        for size in (1, 3, 64):
            paths = [[p for e in range(4) for p in tr.through(rows[i : i + size], e)] for i in range(0, length, size)]
            while len(paths) > 1:
                paths = [tr.joined(*x) if len(x) == 2 else x[0] for x in (paths[i : i + 2] for i in range(0, len(paths), 2))]
            assert tr.closed(paths[0]) == whole


def want(rows, ids):
    """Reports by conversation, from rows after damage."""
    found = {}
    for conv in ids:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        seen, faults = set(), []
        for _, _, role, text in own:
            words = text.strip(" \t\n\x0b\x0c\r")
            faults.append(tr.BLANK if not words else tr.DUPLICATE if (role, text) in seen else tr.OK if words[-1] in ".!?" else tr.CUT)
            seen.add((role, text))
        turns = {r[1] for r in own} - {None}
        initials = [r[2][:1] for r in own]
        cost, audit = brute(list(zip(initials, faults, strict=True))) if own else (0, "")
        found[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in (tr.BLANK, tr.DUPLICATE, tr.CUT)),
            sum(x + y not in tr.LEGAL for x, y in itertools.pairwise(initials)), cost, audit, digest(audit, own),
        )
    return found


def digest(audit, own):
    """Gives inserted and changed turns the roles that fit."""
    for roles in itertools.product("ua", repeat=len(audit)):
        left, lines = iter(own), []
        for letter, new in zip(audit, roles, strict=True):
            row = next(left) if letter != "I" else (0, 0, "", "")
            if letter != "D":
                lines.append((row[2] if letter == "K" else {"u": "user", "a": "assistant"}[new], row[3]))
        if GRAMMAR.fullmatch("".join(r[:1] for r, _ in lines)):
            return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    raise AssertionError


def got(found):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[n] for n in names) for r in found}


ODD = [
    (1, 0, "user", "Hello."), (1, 1, "assistant", "Hi!"), (1, 1, "assistant", "Hi!"), (1, 5, "assistant", "cut"),
    (2, None, "user", "first."), (2, 0, "user", "x. \n"), (2, 9, None, "no role."),
    (3, 0, "system", None), (3, 1, "system", " \t"),
    (None, 0, "user", "of no conversation."), (None, 1, "assistant", "yes."),
    (4, None, "assistant", "a."), (4, None, "user", "b?"),
    (5, 3, "", "no initial."), (5, 4, "Üser", "other!"),
]


def plain(rows):
    return [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]


@pytest.mark.parametrize("block", [1, 256])
def test_odd_rows(spark, block, monkeypatch):
    monkeypatch.setattr(tr, "BLOCK", block)
    given = table(spark, ODD)
    ids = {r[0] for r in ODD}
    assert got(tr.repair_digests(given, given).collect()) == want(plain(ODD), ids)
    assert len(tr.repair_digests(given, given).collect()) == len(ids)
    lines = {}
    for r in sorted(tr.repaired(given).collect(), key=lambda r: r.place):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, row in got(tr.repair_digests(given, given).collect()).items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == row[-1]


def test_damage(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], f"Turn {t}. Of {c}!") for c in range(60) for t in range(4)] + ODD
    after = []
    for c, t, role, text in plain(rows):
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        after += [(c, t, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    assert after != plain(rows)
    assert got(tr.damage_and_repair(table(spark, rows)).collect()) == want(after, {r[0] for r in rows})


def test_long_conversation(spark):
    """Many blocks over several partitions; longer than any list of all edits."""
    draw = random.Random(6)
    rows = [(1, t, draw.choice(["user", "assistant", "system"]), draw.choice(["Yes.", "", f"{t}!", "cut"])) for t in range(4000)]
    [r] = tr.repair_digests(table(spark, rows), table(spark, rows[:1])).collect()
    seen, own = set(), []
    for _, t, role, text in rows:
        own.append(tr.Row(t, role[0], tr.BLANK if not text else tr.DUPLICATE if (role, text) in seen else tr.CUT if text == "cut" else tr.OK))
        seen.add((role, text))
    assert (r.cost, r.audit) == tr.closed(tr.through(own, tr.START))
    assert r.gaps == 0


def test_no_rows(spark):
    nothing = table(spark, [])
    assert tr.repair_digests(nothing, nothing).collect() == []
    assert tr.repaired(nothing).collect() == []
    [r] = tr.repair_digests(nothing, table(spark, [(7, 0, "user", "x.")])).collect()
    assert got([r]) == {7: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
