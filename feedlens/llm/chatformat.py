"""Chat formatting: a finite-state machine over roles validates turn order, and a declarative template emits text
segments with loss flags.

A template names the strings around each role's text, the arcs of the machine
and its control strings. Control strings inside texts are escaped, so the
formatted text reads back to exactly the turns it was made of. DataFrame
functions only: turns become segments row by row, and only whole formatted
conversations, where they are asked for, are gathered by conversation."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Splits a control string inside a text; the text's own ones are doubled.
ESCAPE = "\\"
START = ""


@dataclass(frozen=True)
class Role:
    """The strings before and after a role's text, and whether the text is trained on."""
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``roles`` in the order in which a reader tries them; at most the last may open without a control string.

    ``other`` holds the strings before the name, between name and text and
    after the text of a role that the template does not name. ``arcs`` maps
    a state (START, or the role last read) to the roles that may follow."""
    begin: str
    roles: dict[str, Role]
    other: tuple[str, str, str]
    controls: tuple[str, ...]
    arcs: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self):
        if any(len(c) < 2 or ESCAPE in c for c in self.controls):
            raise ValueError("a control string has two characters at least and no escape character")
        for a in self.controls:
            for b in self.controls:
                if any(a.startswith(b[k:]) or b[k:].startswith(a) for k in range(1, len(b))):
                    raise ValueError(f"control strings {b!r} and {a!r} can overlap")
        marked = [s for r in self.roles.values() for s in (r.open, r.close)][:-2] + [list(self.roles.values())[-1].close, *self.other]
        if not all(any(c in s for c in self.controls) for s in marked):
            raise ValueError("every string around a text holds a control string, but for the last role's opening")


#: Instruction turns in brackets, answers closed by the end mark.
INSTRUCT = Template(
    begin="<s>",
    roles={"system": Role("<<SYS>>\n", "\n<</SYS>>\n\n"), "user": Role("[INST] ", " [/INST]"),
           "assistant": Role(" ", " </s>", loss=True)},
    other=("[ROLE] ", " [TEXT] ", " [/ROLE]"),
    controls=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[TEXT]", "[/ROLE]"),
    arcs={START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
)


def escape(text: Column, template: Template) -> Column:
    """``text`` without any control string: an escape character stands after the first character of each."""
    inside = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in template.controls)
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return F.regexp_replace(doubled, inside, ESCAPE * 2)  # in a replacement, two stand for one


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _order(columns: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def segments(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per turn: conv_id, position (from 0), role, state (before it), ok, segments (text, loss).

    Turns stand by turn number (null first), equal ones by role and text
    (null first). ok: the machine has an arc from the state by the role; after a
    turn without one it goes on from that turn's role. Null texts and roles
    are empty; repeated rows are turns of their own; rows with a null conv_id are one
    conversation; an empty table gives no rows and other columns are ignored. Segments in a
    row concatenate to the turn's formatted text, the conversation's first
    turn with the template's beginning. The rows of a conversation are sorted with
    spilling and never gathered, however many there are."""
    own = Window.partitionBy("conv_id").orderBy(*_order(["turn", "role", "text"]))
    rows = conversations.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("position", (F.row_number().over(own) - 1).cast("long"))
    rows = rows.withColumn("state", F.coalesce(F.lag(F.coalesce("role", F.lit(""))).over(own), F.lit(START)))
    role, text = F.coalesce("role", F.lit("")), escape(F.coalesce("text", F.lit("")), template)
    before, middle, after = template.other
    opening = F.concat(F.lit(before), escape(role, template), F.lit(middle))
    closing, loss = F.lit(after), F.lit(False)
    for name, r in template.roles.items():
        opening = F.when(role == name, F.lit(r.open)).otherwise(opening)
        closing = F.when(role == name, F.lit(r.close)).otherwise(closing)
        loss = F.when(role == name, F.lit(r.loss)).otherwise(loss)
    opening = F.concat(F.when(F.col("position") == 0, F.lit(template.begin)).otherwise(F.lit("")), opening)
    ok = F.lit(False)
    for state, follow in template.arcs.items():
        at = (F.col("position") == 0) if state == START else (F.col("position") > 0) & (F.col("state") == state)
        ok = F.when(at, role.isin(*follow)).otherwise(ok)
    part = lambda t, flag: F.struct(t.alias("text"), flag.alias("loss"))
    return rows.select("conv_id", "position", role.alias("role"), "state", ok.alias("ok"),
                       F.array(part(opening, F.lit(False)), part(text, loss), part(closing, F.lit(False))).alias("segments"))


def format_conversations(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation: conv_id, valid, first_bad (position of the first turn without an arc, or null), ended
    (the machine's last state), segments, formatted (their concatenation).

    Here a conversation's turns meet in one row, as its formatted text must;
    ``segments`` holds them without. Odd rows count as there."""
    turns = segments(conversations, template)
    one = turns.groupBy("conv_id").agg(
        F.min(F.when(~F.col("ok"), F.col("position"))).alias("first_bad"), F.max_by("role", "position").alias("ended"),
        F.array_sort(F.collect_list(F.struct("position", "segments"))).alias("turns"))
    parts = F.flatten(F.transform("turns", lambda t: t["segments"]))
    return (one.select("conv_id", F.col("first_bad").isNull().alias("valid"), "first_bad", "ended", parts.alias("segments"))
            .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")))


def read_turns(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns (role, text) of a formatted conversation, read from its text alone."""
    body = F.substring(formatted, len(template.begin) + 1, 1 << 30)
    before, middle, after = template.other
    forms = [(name, r.open, r.close) for name, r in template.roles.items()]
    forms.insert(len(forms) - 1, (None, before, after))
    pattern = "(?s)" + "|".join(f"{re.escape(a)}.*?{re.escape(b)}" for _, a, b in forms)

    def turn(t: Column) -> Column:
        role, text = F.lit(None).cast("string"), F.lit(None).cast("string")
        for name, a, b in reversed(forms):
            inner = F.substring(t, F.lit(len(a) + 1), F.length(t) - len(a) - len(b))
            found = F.startswith(t, F.lit(a)) & F.endswith(t, F.lit(b))
            if name is None:
                cut = F.instr(inner, middle)
                said = F.substring(inner, F.lit(1), cut - 1)
                inner = F.substring(inner, cut + len(middle), F.length(inner))
            else:
                said = F.lit(name)
            role, text = F.when(found, said).otherwise(role), F.when(found, inner).otherwise(text)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.regexp_extract_all(body, F.lit(pattern), F.lit(0)), turn)


def trained_text(parts: Column) -> Column:
    """All text of ``parts`` (segments) under the loss flag, unescaped."""
    return F.array_join(F.transform(F.filter(parts, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
