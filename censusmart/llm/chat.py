"""Chat formatting from a declarative template, in DataFrame expressions only.

A template says for each role which marks open and close its turns and whether its text counts for the loss, and which role
may follow which. The turn order is checked by a finite-state machine whose state is the role of the turn before.
The output is one row per conversation: ``valid`` and the text segments in order, each with its loss flag.

Control strings inside a text are broken up reversibly: every backslash is doubled, and a backslash goes behind the
first character of every control string, so that none is left in the text. A single backslash therefore always
marks a break, and ``unescaped`` takes both away again. Marks are set off by spaces and control strings contain none, so text and mark
cannot join into a control string.

Defined cases: a null text or role is an empty one; a role the template does not name gets the marks of other
roles, with its name inside, and makes the conversation invalid; null conversation ids form one conversation; turns of
one number are ordered by role and text, null numbers come last; an empty table gives no rows. A conversation is one output
row, so its texts together are limited by the size of a string (2 GB).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "^", "$"


@dataclass(frozen=True)
class Role:
    """Control strings around a role's text, and whether the text counts for the loss."""
    opens: str
    closes: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks, loss flags and turn order of a chat format."""
    begin: str = "<s>"
    roles: dict[str, Role] = field(default_factory=lambda: {
        "system": Role("<<SYS>>", "<</SYS>>"),
        "user": Role("[INST]", "[/INST]"),
        "assistant": Role("[ANSWER]", "</s>", loss=True),
    })
    other: tuple[str, str, str] = ("[ROLE]", "[SAYS]", "[/ROLE]")
    order: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant", END), "assistant": ("user", END),
    })

    def controls(self) -> list[str]:
        marks = [self.begin, *self.other, *(m for r in self.roles.values() for m in (r.opens, r.closes))]
        if any(re.search(r"\s|\\", m) or len(m) < 2 for m in marks):
            raise ValueError("a control string has two characters or more, without blanks and backslashes")
        if any(a != b and (a in b or any(a.endswith(b[:n]) for n in range(1, len(b)))) for a in marks for b in marks) or any(
                m.endswith(m[:n]) for m in marks for n in range(1, len(m))):
            raise ValueError("control strings must not overlap or contain one another")
        return sorted(set(marks), key=len, reverse=True)


def escaped(text: Column, template: Template) -> Column:
    """The text without control strings."""
    inner = "|".join(f"{re.escape(m[0])}(?={re.escape(m[1:])})" for m in template.controls())
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"(?:{inner})", r"$0\\")


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped``."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _segments(template: Template) -> Column:
    """Segments of one turn (role, text): opening mark, text, closing mark."""
    def pieces(opens: Column, closes: str, loss: bool) -> Column:
        text = escaped(F.col("text"), template)
        return F.array(*(F.struct(t.alias("text"), F.lit(f).alias("loss"))
                         for t, f in ((opens, False), (text, loss), (F.lit(f" {closes}"), False))))

    named, says, closes = template.other
    result = pieces(F.concat(F.lit(f"{named} "), escaped(F.col("role"), template), F.lit(f" {says} ")), closes, False)
    for name, role in template.roles.items():
        result = F.when(F.col("role") == name, pieces(F.lit(f"{role.opens} "), role.closes, role.loss)).otherwise(result)
    return result


def format_conversations(rows: DataFrame, template: Template = Template(), conv_id: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, n_turns, valid, segments) of every conversation; segments is an array of (text, loss)."""
    turns = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("turn").asc_nulls_last(), "role", "text"]
    conversation = Window.partitionBy("conv_id").orderBy(*order)
    step = F.concat_ws(">", F.coalesce(F.lag("role").over(conversation), F.lit(START)), "role")
    allowed = [f"{a}>{b}" for a, following in template.order.items() for b in following]
    last = [a for a, following in template.order.items() if END in following]
    numbered = turns.select("conv_id", "role", F.row_number().over(conversation).alias("nth"), step.isin(allowed).alias("in_order"),
                            _segments(template).alias("segments"))
    grouped = numbered.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.bool_and("in_order").alias("in_order"), F.max_by("role", "nth").alias("last"),
        F.array_sort(F.collect_list(F.struct("nth", "segments"))).alias("turns"))
    begin = F.array(F.struct(F.lit(template.begin).alias("text"), F.lit(False).alias("loss")))
    return grouped.select("conv_id", "n_turns", (F.col("in_order") & F.col("last").isin(last)).alias("valid"),
                          F.concat(begin, F.flatten(F.col("turns.segments"))).alias("segments"))


def formatted_text(segments: Column) -> Column:
    return F.array_join(segments["text"], "")


def parsed_turns(text: Column, template: Template = Template()) -> Column:
    """The turns of a formatted text as an array of (role, text)."""
    named, says, closes = template.other
    between = ".*?"
    patterns = [f"{re.escape(r.opens)} {between} {re.escape(r.closes)}" for r in template.roles.values()]
    patterns.append(f"{re.escape(named)} {between} {re.escape(says)} {between} {re.escape(closes)}")
    found = F.regexp_extract_all(text, F.lit("(?s)" + "|".join(patterns)), F.lit(0))

    def turn(whole: Column) -> Column:
        head = F.instr(whole, f" {says} ")
        result = F.struct(unescaped(F.substring(whole, F.lit(len(named) + 2), head - len(named) - 2)).alias("role"),
                          unescaped(F.substring(whole, head + len(says) + 2, F.length(whole) - head - len(says) - len(closes) - 2)).alias("text"))
        for name, r in template.roles.items():
            skip = len(r.opens) + 1
            body = F.substring(whole, F.lit(skip + 1), F.length(whole) - skip - len(r.closes) - 1)
            result = F.when(F.startswith(whole, F.lit(f"{r.opens} ")), F.struct(F.lit(name).alias("role"), unescaped(body).alias("text"))).otherwise(result)
        return result

    return F.transform(found, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, in order, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
