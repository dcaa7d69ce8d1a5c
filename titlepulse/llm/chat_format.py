"""Chat formatting: a finite-state machine over roles, and a template that can be read back.

A template declares, for each role, the marks around its text and whether the text counts for the loss; and the
machine: which roles may follow which, from the start on.  The state after a turn is its role, so the step to the next
turn needs the role before it and nothing else.

``turns`` is the operator for conversations of any length: a row per turn with its segments (mark, escaped text,
mark; each with its loss flag), its place in the formatted conversation, and whether the machine allows it there.
Turns are ordered within slices of ``SLICE_TURNS`` turn numbers; how many turns and characters come before a slice, and
the state in which it starts, follow from one short row per slice.  So no task sorts a conversation that spans many slices.
``conversations`` puts a conversation's segments together in one row, which then is as long as the conversation.
``read_back`` parses formatted conversations by the template alone.

Control strings inside texts are escaped: a backslash after their first character, and every backslash doubled.  So a
text never holds a control string, and unescaping gives exactly the text.  A template is refused if a
control string could arise where a mark and a text meet, or if a mark could be taken for another.

Turns are ordered by ``turn, role, text``, nulls first; repeated rows are turns of their own, and repeated turn numbers are
ordered by role and text.  A null text is empty.  A null role is the empty role; roles that the template doesn't name
have marks that hold the role's name, and the machine never allows them.  Turns out of order are kept and marked,
nothing is dropped.  Rows with a null conv_id are one conversation.  An empty table gives an empty result.  Further
columns, whatever their names, are left out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_TURNS = 1024
START = ""


@dataclass(frozen=True)
class Marks:
    """What stands before and after the texts of a role, and whether the texts count for the loss."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    roles: dict[str, Marks]
    other: tuple[str, str, str]  # before the name of any other role, between name and text, after the text
    follows: dict[str, tuple[str, ...]]  # roles that may come after a role, or after START
    ends: tuple[str, ...]  # roles that may come last
    control: tuple[str, ...]  # what texts must not hold unescaped

    def __post_init__(self):
        marks = [*self.other, *[m for own in self.roles.values() for m in (own.before, own.after)]]
        ends = [self.other[1], self.other[2], *[own.after for own in self.roles.values()]]
        starts = [self.other[0], *[own.before for own in self.roles.values()]]
        if not all(marks) or any(a is not b and b.startswith(a) for n, a in enumerate(starts) for b in starts[:n] + starts[n + 1 :]):
            raise ValueError("every mark needs a text, and no mark before a text may begin another")
        if not all(any(c in mark for c in self.control) for mark in ends):
            raise ValueError("every mark after a text needs a control string")
        if any("\\" in s for s in (*marks, *self.control)) or any(len(c) < 2 for c in self.control):
            raise ValueError("control strings have two characters at least; no backslash can be part of the template")
        for c in self.control:
            for mark in marks:
                if mark in c[1:-1] or any(mark.endswith(c[:n]) or mark.startswith(c[n:]) for n in range(1, len(c))):
                    raise ValueError(f"{c!r} could arise from {mark!r} and a text beside it")


INSTRUCTIONS = Template(
    roles={
        "system": Marks("<<SYS>>\n", "\n<</SYS>>\n\n"),
        "user": Marks("[INST] ", " [/INST]"),
        "assistant": Marks(" ", "</s>", loss=True),
    },
    other=("<|role|>", "<|text|>", "<|end|>"),
    follows={START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    ends=("assistant",),
    control=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>", "<|end|>"),
)


def escape(text: Column, template: Template) -> Column:
    pattern = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in template.control)
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, F.lit(pattern), F.lit("$0\\\\"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"\\(\\?)"), F.lit("$1"))


def _segments(role: Column, text: Column, template: Template) -> Column:
    """Three segments of a turn: mark, escaped text, mark."""

    def three(before: Column, after: Column, loss: bool) -> Column:
        parts = ((before, False), (escape(text, template), loss), (after, False))
        return F.array(*[F.struct(part.alias("text"), F.lit(flag).alias("loss")) for part, flag in parts])

    first, between, last = map(F.lit, template.other)
    built = three(F.concat(first, escape(role, template), between), last, False)
    for name, marks in template.roles.items():
        built = F.when(role == name, three(F.lit(marks.before), F.lit(marks.after), marks.loss)).otherwise(built)
    return built


def _allowed(before: Column, role: Column, template: Template) -> Column:
    """Whether the machine has a step from the state ``before`` by ``role``."""
    steps = F.lit(False)
    for state, roles in template.follows.items():
        steps = steps | ((before == state) & role.isin(*roles))
    return steps


def _state(role: Column, template: Template) -> Column:
    """The state after a turn: its role; roles that the template does not name lead to a state without steps."""
    return F.when(role.isin(*template.roles), role).otherwise(F.lit("\\"))


def turns(rows: DataFrame, template: Template = INSTRUCTIONS, slice_turns: int = SLICE_TURNS) -> DataFrame:
    """A row per turn: ``conv_id, turn, role, position, start, allowed, segments``.

    ``position`` counts from 1; ``start`` is the number of code points before the turn in the formatted conversation.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    bare = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    own = ["_no_id", "_conv"]  # keys without nulls, so that joins and windows share one distribution
    sliced = bare.withColumns(
        {
            "_no_id": F.col("conv_id").isNull(), "_conv": F.coalesce("conv_id", F.lit(0)),
            "_slice": F.coalesce(F.floor(F.col("turn") / slice_turns), F.lit(-(1 << 62))),
            "segments": _segments(F.col("role"), F.col("text"), template),
        }
    )
    chars = F.aggregate("segments", F.lit(0).cast("long"), lambda total, s: total + F.length(s["text"]))
    order = Window.partitionBy(*own, "_slice").orderBy("turn", "role", "text")
    placed = sliced.withColumns(
        {
            "_chars": chars, "_place": F.row_number().over(order), "_role_before": F.lag("role").over(order),
            "_chars_before": F.coalesce(F.sum(chars).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        }
    )
    earlier = Window.partitionBy(*own).orderBy("_slice")
    sums = earlier.rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        sliced.groupBy(*own, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(chars).alias("_c"), F.max(F.struct("turn", "role")).alias("_end"))
        .select(
            *own, "_slice", F.coalesce(F.sum("_n").over(sums), F.lit(0)).alias("_turns_base"),
            F.coalesce(F.sum("_c").over(sums), F.lit(0)).alias("_chars_base"), F.lag("_end.role").over(earlier).alias("_role_base"),
        )
    )
    before = F.coalesce("_role_before", "_role_base")
    state = F.when(before.isNull(), F.lit(START)).otherwise(_state(before, template))
    return placed.join(slices, [*own, "_slice"]).select(
        "conv_id", "turn", "role", (F.col("_turns_base") + F.col("_place")).alias("position"),
        (F.col("_chars_base") + F.col("_chars_before")).alias("start"), _allowed(state, F.col("role"), template).alias("allowed"), "segments",
    )


def conversations(rows: DataFrame, template: Template = INSTRUCTIONS) -> DataFrame:
    """A row per conversation: ``conv_id, formatted, segments, valid, first_bad, complete``.

    ``formatted`` is the segments' texts in one; ``first_bad`` the position of the first turn that the machine doesn't
    allow, null where ``valid``; ``complete`` says whether the last turn is one that may come last.
    """
    gathered = turns(rows, template).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "role", "segments"))).alias("_turns"),
        F.min(F.when(~F.col("allowed"), F.col("position"))).alias("first_bad"),
    )
    segments = F.flatten(F.col("_turns.segments"))
    return gathered.select("conv_id", segments.alias("segments"), "first_bad", F.element_at("_turns.role", -1).isin(*template.ends).alias("complete")).select(
        "conv_id", F.array_join("segments.text", "").alias("formatted"), "segments", F.col("first_bad").isNull().alias("valid"), "first_bad", "complete"
    )


def read_back(formatted: Column, template: Template = INSTRUCTIONS) -> Column:
    """The turns of a formatted conversation, as an array of ``role, text``."""
    first, between, last = template.other
    shapes = [f"{re.escape(m.before)}.*?{re.escape(m.after)}" for m in template.roles.values()]
    shapes.append(f"{re.escape(first)}.*?{re.escape(between)}.*?{re.escape(last)}")
    pieces = F.regexp_extract_all(formatted, F.lit(f"(?s){'|'.join(shapes)}"), F.lit(0))

    def turn(piece: Column) -> Column:
        def inside(begin: Column, after: str) -> Column:
            return unescape(F.substr(piece, begin, F.length(piece) - (begin - 1) - len(after)))

        cut = F.instr(piece, F.lit(between))
        name = unescape(F.substr(piece, F.lit(len(first) + 1), cut - (len(first) + 1)))
        found = F.struct(name.alias("role"), inside(cut + len(between), last).alias("text"))
        for role, marks in template.roles.items():
            known = F.struct(F.lit(role).alias("role"), inside(F.lit(len(marks.before) + 1), marks.after).alias("text"))
            found = F.when(F.startswith(piece, F.lit(marks.before)), known).otherwise(found)
        return found

    return F.transform(pieces, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digest(formatted: DataFrame, template: Template = INSTRUCTIONS) -> DataFrame:
    """Counts and digests of what a reader of the output gets."""
    read = formatted.select("conv_id", "formatted", "valid", "first_bad", "complete", read_back(F.col("formatted"), template).alias("_read"), loss_text(F.col("segments")).alias("_loss"))
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read.select(
        "conv_id", F.size("_read").cast("long").alias("n_turns"), F.sha2(F.array_join(F.transform("_read", line), ""), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
        "valid", F.col("first_bad").cast("long").alias("first_bad"), "complete",
    )
