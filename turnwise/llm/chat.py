"""Chat formatting: a template of roles, a finite-state machine over them, and loss flags.

A template says for every role how a turn opens and closes, whether its text is learned, and
which roles may follow which. Control strings inside a text are escaped by one backslash
behind their first character; one that is escaped already gets one more, so the original can
always be read back. All of it is column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``moves`` maps a state (a role, or "" for the start) to the roles that may come next;
    ``finals`` are the roles a conversation may end with. Roles outside ``learned`` are
    context. ``controls`` are the strings that mean something to the reader of the output."""

    open: str = "<|turn|>"
    after_role: str = "\n"
    close: str = "<|end|>\n"
    learned: Sequence[str] = ("assistant",)
    moves: Mapping[str, Sequence[str]] = field(
        default_factory=lambda: {
            "": ("system", "user"), "system": ("user",), "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    finals: Sequence[str] = ("assistant",)
    controls: Sequence[str] = (
        "<|turn|>", "<|end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>",
        "<</SYS>>",
    )

    def escaped(self) -> str:
        """A control string with any number of backslashes behind its first character."""
        tails = sorted(self.controls, key=len, reverse=True)
        return "|".join(
            f"(?<={re.escape(c[0])})(?=\\\\*{re.escape(c[1:])})" for c in tails
        )


def escape(text: Column, template: Template) -> Column:
    """The text without control strings; ``unescape`` gives it back."""
    return F.regexp_replace(text, template.escaped(), r"\\")


def unescape(text: Column, template: Template) -> Column:
    tails = sorted(template.controls, key=len, reverse=True)
    held = "|".join(f"(?<={re.escape(c[0])})\\\\(?=\\\\*{re.escape(c[1:])})" for c in tails)
    return F.regexp_replace(text, held, "")


def _role_mark(role: Column, template: Template) -> Column:
    """A role on one line, whatever it holds."""
    line = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escape(line, template)


def _mark_role(mark: Column, template: Template) -> Column:
    parts = F.split(unescape(mark, template), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def turn_segments(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per turn: conv_id, turn, role, segments array<struct<text, learn>>.

    No row meets another here, so this table serves conversations of any length. Null role
    and text count as empty. Only the text between the marks is learned.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    mark = F.concat(F.lit(template.open), _role_mark(role, template), F.lit(template.after_role))
    segment = lambda text, learn: F.struct(text.alias("text"), learn.alias("learn"))
    return turns.select(
        "conv_id", "turn", role.alias("role"),
        F.array(
            segment(mark, F.lit(False)),
            segment(escape(F.coalesce(F.col("text"), F.lit("")), template), role.isin(*template.learned)),
            segment(F.lit(template.close), F.lit(False)),
        ).alias("segments"),
    )


def valid_order(roles: Column, template: Template) -> Column:
    """Runs the machine over the roles of a conversation: true if every move is allowed and
    the last role may end it. A state without moves is a dead end."""
    allowed = [
        (F.lit(state), F.array(*[F.lit(r) for r in nexts])) for state, nexts in template.moves.items()
    ]
    moves = F.create_map(*[c for pair in allowed for c in pair])
    dead = F.lit("\u0000")
    step = lambda state, role: F.when(
        F.array_contains(F.coalesce(F.try_element_at(moves, state), F.array().cast("array<string>")), role),
        role,
    ).otherwise(dead)
    return F.aggregate(roles, F.lit(""), step, lambda last: last.isin(*template.finals))


def format_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: conv_id, n_turns, valid, segments, formatted.

    Turns are ordered by number, then role and text, so ties and repeated rows come out the
    same each time and all stay. A null turn comes first; a null conv_id is a conversation.
    Conversations that break the order are formatted too, with valid = false. The turns of a
    conversation meet in one row, because that row is the result.
    """
    slim = turn_segments(turns, template)
    grouped = slim.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "segments"))).alias("t")
    )
    return grouped.select(
        "conv_id",
        F.size("t").cast("bigint").alias("n_turns"),
        valid_order(F.transform("t", lambda x: x["role"]), template).alias("valid"),
        F.flatten(F.transform("t", lambda x: x["segments"])).alias("segments"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns of a formatted text, unescaped: array<struct<role, text>>."""
    pieces = F.split(formatted, re.escape(template.close), -1)
    # What follows the last closing mark is empty.
    bodies = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(body: Column) -> Column:
        mark = F.substring_index(body, template.after_role, 1)
        role = F.substring(mark, len(template.open) + 1, 1 << 30)
        text = F.substring(body, F.length(mark) + len(template.after_role) + 1, F.length(body))
        return F.struct(
            _mark_role(role, template).alias("role"), unescape(text, template).alias("text")
        )

    return F.transform(bodies, turn)


def learned_text(segments: Column, template: Template = Template()) -> Column:
    """All text under the loss flags, unescaped, with nothing between."""
    learned = F.filter(segments, lambda s: s["learn"])
    return F.array_join(F.transform(learned, lambda s: unescape(s["text"], template)), "")
