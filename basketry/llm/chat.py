"""Chat formatting with DataFrame functions only.

A declarative template marks every turn with control strings and says whose text counts for the
loss; a finite-state machine over the roles checks the order of turns. Control strings that occur
inside texts are escaped, reversibly, so the marks in the output are always the template's own.

Defined results: a null text is empty and a null role is the role ""; roles the template does not
know get a mark with their name and no loss; turns go by turn, then role, then text (null turn
first); a null conv_id is one conversation; a conversation that breaks the order is formatted all
the same, with the place of the first wrong turn in ``first_error``; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.session import stored

# Escapes: every control string starts with one of these characters.
ESCAPE = "\\"
ESCAPED = {"<": "\\l", "[": "\\b"}
# In role names also the sign that ends their mark.
ESCAPED_IN_ROLES = ESCAPED | {">": "\\g"}


@dataclass(frozen=True)
class Turn:
    """Marks around a role's texts, and whether the text counts for the loss."""

    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role, and the order of roles: (state, role) leads to the next state."""

    turns: dict[str, Turn]
    order: dict[tuple[str, str], str]
    start: str = "start"
    other: Turn = field(default_factory=lambda: Turn("<role:{role}> ", " </role>\n"))

    def __post_init__(self):
        for turn in (*self.turns.values(), self.other):
            if turn.opening[:1] not in ESCAPED or turn.closing.strip()[:1] not in ESCAPED:
                raise ValueError("control strings start with a character that texts escape")


TEMPLATE = Template(
    turns={
        "system": Turn("<<SYS>> ", " <</SYS>>\n"),
        "user": Turn("[INST] ", " [/INST]\n"),
        "assistant": Turn("<s> ", " </s>\n", loss=True),
    },
    order={
        ("start", "system"): "system",
        ("start", "user"): "user",
        ("system", "user"): "user",
        ("user", "assistant"): "assistant",
        ("assistant", "user"): "user",
    },
)


def escaped(text: Column, codes: dict[str, str] = ESCAPED) -> Column:
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for plain, code in codes.items():
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    """Reads escapes from the left: doubled escape signs first, the others between them."""

    def piece(part: Column) -> Column:
        for plain, code in ESCAPED_IN_ROLES.items():
            part = F.replace(part, F.lit(code), F.lit(plain))
        return part

    return F.array_join(F.transform(F.split(text, re.escape(ESCAPE * 2)), piece), ESCAPE)


def _by_role(role: Column, values: dict[str, object], other: Column) -> Column:
    found = None
    for name, value in values.items():
        found = F.when(role == name, F.lit(value)) if found is None else found.when(role == name, F.lit(value))
    return other if found is None else found.otherwise(other)


def formatted(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, formatted text, segments (text, loss) whose texts in turn are that text, first_error."""
    role, text = F.coalesce("role", F.lit("")), escaped(F.coalesce("text", F.lit("")))
    named = F.replace(F.lit(template.other.opening), F.lit("{role}"), escaped(role, ESCAPED_IN_ROLES))
    marks = template.turns
    rows = conversations.select(
        "conv_id",
        F.struct(
            "turn",
            role.alias("role"),
            text.alias("text"),
            _by_role(role, {k: t.opening for k, t in marks.items()}, named).alias("opening"),
            _by_role(role, {k: t.closing for k, t in marks.items()}, F.lit(template.other.closing)).alias("closing"),
            _by_role(role, {k: t.loss for k, t in marks.items()}, F.lit(False)).alias("loss"),
        ).alias("entry"),
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("entry")).alias("turns"))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                segment(t.opening, F.lit(False)), segment(t.text, t.loss), segment(t.closing, F.lit(False))
            ),
        )
    )
    return whole.select("conv_id", segments.alias("segments"), first_error(F.col("turns.role"), template).alias("first_error")).select(
        "conv_id", F.array_join("segments.text", "").alias("formatted"), "segments", "first_error"
    )


def first_error(roles: Column, template: Template = TEMPLATE) -> Column:
    """Place, from 0, of the first turn that the machine has no transition for; null if none."""
    steps = F.create_map(*[F.lit(x) for (s, r), to in template.order.items() for x in (f"{s}>{r}", to)])
    begin = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("wrong"))

    def step(seen: Column, role: Column) -> Column:
        state = F.try_element_at(steps, F.concat(seen.state, F.lit(">"), role))
        wrong = F.coalesce(seen.wrong, F.when(state.isNull(), seen.at))
        return F.struct(F.coalesce(state, F.lit("")).alias("state"), (seen.at + 1).alias("at"), wrong.alias("wrong"))

    return F.aggregate(roles, begin, step).getField("wrong")


def turns_of(text: Column, template: Template = TEMPLATE) -> Column:
    """The turns (role, text) of a formatted text, found by its marks alone."""
    before, after = template.other.opening.split("{role}")
    openings = [re.escape(t.opening) for t in template.turns.values()]
    named = re.escape(before) + r"[^<\[]*?" + re.escape(after)
    closings = {t.closing for t in (*template.turns.values(), template.other)}
    pattern = f"({'|'.join([*openings, named])})([^<\\[]*)({'|'.join(map(re.escape, sorted(closings)))})"
    marks, texts = (F.regexp_extract_all(text, F.lit(pattern), F.lit(i)) for i in (1, 2))

    def turn(pair: Column) -> Column:
        mark = pair.getField("marks")
        name = F.substr(mark, F.lit(len(before) + 1), F.length(mark) - len(before) - len(after))
        role = _by_role(mark, {t.opening: r for r, t in template.turns.items()}, unescaped(name))
        return F.struct(role.alias("role"), unescaped(pair.getField("texts")).alias("text"))

    return F.transform(F.arrays_zip(marks.alias("marks"), texts.alias("texts")), turn)


def digests(output: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Per conversation, from the formatted text and its loss flags: turns, their digest, the loss text's."""
    lines = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    under = F.transform(F.filter("segments", lambda s: s.loss), lambda s: unescaped(s.text))
    read = output.withColumns(
        {"turns": turns_of(F.col("formatted"), template), "loss_text": F.array_join(under, "")}
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.col("first_error").isNull().alias("valid"),
        F.col("first_error").cast("long").alias("first_error"),
    )


def chat_digests(conversations: DataFrame) -> DataFrame:
    """Formats, writes to the shared folder, and describes what is read back."""
    return digests(stored(formatted(conversations), "chat"))
