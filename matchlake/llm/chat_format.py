"""Chat formatting: a state machine over roles and a declarative template, in DataFrame functions only.

The state after a turn is its role; ``TURNS`` lists the allowed steps, checked with the role before. Every
turn becomes one row with its text segments (opening, body, closing), each with its loss flag. Control
strings inside texts are escaped, so the marks of the template can be found again without doubt.

Edge cases: null text and null role count as empty; an unknown role is formatted by the template's last
style, which writes the role down, and breaks the turn order; turns are ordered by turn, then role and text, so that
repeated turns have a fixed order and are all kept; null turns come first; rows with null conv_id form one
conversation; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: steps of the state machine, from the role before (empty at the start) to the next
TURNS = {
    "": ["system", "user"],
    "system": ["user"],
    "user": ["assistant"],
    "assistant": ["user"],
}


@dataclass(frozen=True)
class Style:
    open: str
    close: str
    learn: bool = False


@dataclass(frozen=True)
class Template:
    """Marks of each role and of all other roles. Marks start with ``<`` or ``[``, leading white space of a close aside."""

    roles: dict[str, Style] = field(default_factory=lambda: {
        "system": Style("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": Style("[INST] ", " [/INST]"),
        "assistant": Style("<s>", "</s>", learn=True),
    })
    other_open: tuple[str, str] = ("<<ROLE>>", "<</ROLE>>")
    other_close: str = "<</TURN>>"

    def controls(self) -> list[str]:
        marks = [m for s in self.roles.values() for m in (s.open, s.close)]
        return sorted({m.strip() for m in [*marks, *self.other_open, self.other_close]})


LLAMA = Template()


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() else f"\\x{{{ord(c):x}}}" for c in text)


def escape(text: Column, template: Template) -> Column:
    r"""``\`` becomes ``\b``; the first sign of a control string becomes ``\l`` (``<``) or ``\o`` (``[``)."""
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    for sign, letter in (("<", "l"), ("[", "o")):
        rests = [_quoted(c[1:]) for c in template.controls() if c[0] == sign]
        text = F.regexp_replace(text, f"{_quoted(sign)}(?={'|'.join(rests)})", f"\\\\{letter}")
    return text


def unescape(text: Column) -> Column:
    for letter, sign in (("l", "<"), ("o", "["), ("b", "\\")):
        text = F.replace(text, F.lit(f"\\{letter}"), F.lit(sign))
    return text


def format_turns(turns: DataFrame, template: Template = LLAMA) -> DataFrame:
    """conv_id, place (from 1), allowed, segments (text, learn): one row per turn of (conv_id, turn, role, text)."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    steps = F.array(*[F.lit(f"{a}>{b}") for a, bs in TURNS.items() for b in bs])
    step = F.concat(F.lag("role", 1, "").over(order), F.lit(">"), "role")
    opening, closing, learn = None, None, None
    for role, style in template.roles.items():
        hit = F.col("role") == role
        opening = F.when(hit, style.open) if opening is None else opening.when(hit, style.open)
        closing = F.when(hit, style.close) if closing is None else closing.when(hit, style.close)
        learn = F.when(hit, style.learn) if learn is None else learn.when(hit, style.learn)
    named = F.concat(F.lit(template.other_open[0]), escape(F.col("role"), template), F.lit(template.other_open[1]))
    segment = lambda text, flag: F.struct(text.alias("text"), flag.alias("learn"))
    return rows.select(
        "conv_id", F.row_number().over(order).alias("place"), F.array_contains(steps, step).alias("allowed"),
        F.array(segment(opening.otherwise(named), F.lit(False)),
                segment(escape(F.col("text"), template), learn.otherwise(False)),
                segment(closing.otherwise(template.other_close), F.lit(False))).alias("segments"))


def conversations(formatted: DataFrame) -> DataFrame:
    """conv_id, valid, formatted, segments: the turns of a conversation put together again."""
    turns = F.array_sort(F.collect_list(F.struct("place", "segments", "allowed")))
    return formatted.groupBy("conv_id").agg(turns.alias("turns")).select(
        "conv_id", F.forall("turns", lambda t: t["allowed"]).alias("valid"),
        F.flatten(F.transform("turns", lambda t: t["segments"])).alias("segments"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def parse(text: Column, template: Template = LLAMA) -> Column:
    """Array of (role, text) read from a formatted conversation."""
    known = [f"{_quoted(s.open)}(.*?){_quoted(s.close)}" for s in template.roles.values()]
    other = f"{_quoted(template.other_open[0])}(.*?){_quoted(template.other_open[1])}(.*?){_quoted(template.other_close)}"
    pattern = "(?s)" + "|".join([*known, other])
    turns = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def read(turn: Column) -> Column:
        role, body = None, None
        for name, style in template.roles.items():
            hit = F.startswith(turn, F.lit(style.open))
            inner = F.substring(turn, F.lit(len(style.open) + 1), F.char_length(turn) - len(style.open) - len(style.close))
            role = F.when(hit, name) if role is None else role.when(hit, name)
            body = F.when(hit, inner) if body is None else body.when(hit, inner)
        role = role.otherwise(unescape(F.regexp_extract(turn, "(?s)" + other, 1)))
        body = body.otherwise(F.regexp_extract(turn, "(?s)" + other, 2))
        return F.struct(role.alias("role"), unescape(body).alias("text"))

    return F.transform(turns, read)
