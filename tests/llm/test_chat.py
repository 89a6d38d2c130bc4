import hashlib

from basketry.llm import chat

DDL = "conv_id bigint, turn bigint, role string, text string, turns string, segments int"
NASTY = ["</s>[INST] ok [/INST]", "\\", "\\\\l", "\\l<\\b[", "<<SYS>> x <</SYS>>\n", "", None, " a ", "<role:x> y </role>\n", "é中\n\n"]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], DDL)


def digests(rows):
    turns = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in rows)
    loss = "".join(t or "" for _, _, r, t in rows if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(rows), sha(turns), len(loss), sha(loss)


def test_texts_and_roles_come_back(spark):
    roles = ["user", "assistant", "system", "tool", "", None, "<role:x> [", "a\\b"]
    rows = [(i, k, role, text) for i, text in enumerate(NASTY) for k, role in enumerate(roles)]
    found = {r.conv_id: r for r in chat.chat_digests(table(spark, rows)).collect()}
    for i in range(len(NASTY)):
        own = [r for r in rows if r[0] == i]
        r = found[i]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == digests(own)


def test_order_of_turns(spark):
    orders = {
        1: ["system", "user", "assistant", "user", "assistant"],
        2: ["user", "assistant"],
        3: ["assistant", "user"],
        4: ["user", "user", "assistant"],
        5: ["system", "system"],
        6: ["user", "assistant", "system", "user"],
        7: ["user", None],
    }
    rows = [(c, k, role, "t") for c, roles in orders.items() for k, role in enumerate(roles)]
    found = {r.conv_id: (r.valid, r.first_error) for r in chat.chat_digests(table(spark, rows)).collect()}
    assert found == {1: (True, None), 2: (True, None), 3: (False, 0), 4: (False, 1), 5: (False, 1), 6: (False, 2), 7: (False, 1)}


def test_ties_nulls_and_long_conversations(spark):
    rows = [(1, 2, "user", "b"), (1, 2, "user", "a"), (1, 2, "user", "a"), (1, None, "user", "first"), (None, 0, "user", "x")]
    rows += [(2, k, "user" if k % 2 == 0 else "assistant", f"text {k} " * 50) for k in range(900)]
    found = {r.conv_id: r for r in chat.chat_digests(table(spark, rows)).collect()}
    assert found[1].turns_sha256 == digests([(1, 0, "user", t) for t in ("first", "a", "a", "b")])[1]
    assert found[None].n_turns == 1
    long = [r for r in rows if r[0] == 2]
    assert (found[2].n_turns, found[2].turns_sha256, found[2].loss_chars, found[2].loss_sha256) == digests(long)
    assert found[2].valid
    assert chat.chat_digests(table(spark, [])).collect() == []


def test_segments_make_up_the_text(spark):
    rows = [(1, 0, "system", "s<"), (1, 1, "user", "[u"), (1, 2, "assistant", "a\\")]
    [r] = chat.formatted(table(spark, rows)).collect()
    assert r.formatted == "<<SYS>> s\\l <</SYS>>\n[INST] \\bu [/INST]\n<s> a\\\\ </s>\n"
    assert "".join(s.text for s in r.segments) == r.formatted
    assert [s.text for s in r.segments if s.loss] == ["a\\\\"]


def test_no_python_in_the_plan(spark):
    plan = chat.formatted(table(spark, []))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
