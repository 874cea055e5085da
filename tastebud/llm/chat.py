"""Chat formatting: a state machine over roles, a declarative template, loss flags by segment.

Native throughout.  A template says for each role which string opens and which
closes its turns and whether the text between bears loss.  Control strings
inside texts (and backslashes) are escaped, so a text can never end its turn
or start another, and the output reads back to exactly the turns it was made
of.  The state machine walks the roles of a conversation through a table of
transitions; a conversation is valid where it ends in an accepting state.
Invalid ones are formatted as well and marked.

Turns are ordered by turn number, nulls first, ties by role and then text.  A
null text is empty, a null role is the role ``''``.  A null conversation id is
one conversation.  Roles that the template doesn't list get its ``other`` turn,
which spells out the role.  Extra columns are ignored.  A conversation is one
string by definition, so it is gathered in one row; conversations are never
gathered together.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    turns: dict[str, Turn]
    other: Turn
    role_end: str                       # ends the spelled-out role in an ``other`` turn
    controls: tuple[str, ...]           # what is escaped inside texts: every open and close is built on these
    start: str = "start"
    accept: tuple[str, ...] = ("assistant",)
    moves: dict[tuple[str, str], str] = field(default_factory=dict)     # (state, role): state


INST = Template(
    turns={"system": Turn("<<SYS>>\n", "\n<</SYS>>\n"), "user": Turn("[INST] ", " [/INST]\n"),
           "assistant": Turn("<s> ", " </s>\n", loss=True)},
    other=Turn("<<ROLE>>", " <</ROLE>>\n"), role_end="<|> ",
    controls=("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<<ROLE>>", "<</ROLE>>", "<|>"),
    moves={("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
           ("user", "assistant"): "assistant", ("assistant", "user"): "user"})


def escaped(text: Column, t: Template) -> Column:
    """Backslashes doubled, then one put after the first character of every control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda c, s: F.replace(c, F.lit(s), F.lit(s[0] + "\\" + s[1:])), t.controls, text)


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _turn(role: Column, t: Template, pick) -> Column:
    cases = reduce(lambda c, r: c.when(role == r, pick(t.turns[r])), t.turns, F.when(F.lit(False), pick(t.other)))
    return cases.otherwise(pick(t.other))


def segments(role: Column, text: Column, t: Template) -> Column:
    """The segments of a turn, (text, loss): what opens it, its text, what closes it."""
    known = role.isin(list(t.turns))
    head = F.concat(_turn(role, t, lambda x: F.lit(x.open)), F.when(known, F.lit("")).otherwise(F.concat(escaped(role, t), F.lit(t.role_end))))
    part = lambda c, loss: F.struct(c.alias("text"), loss.alias("loss"))
    return F.array(part(head, F.lit(False)), part(escaped(text, t), _turn(role, t, lambda x: F.lit(x.loss))),
                   part(_turn(role, t, lambda x: F.lit(x.close)), F.lit(False)))


def valid(roles: Column, t: Template) -> Column:
    """Whether the state machine accepts a sequence of roles."""
    moves = F.create_map(*(F.lit(x) for (state, role), to in t.moves.items() for x in (f"{state}\n{role}", to)))
    end = F.aggregate(roles, F.lit(t.start), lambda s, r: F.coalesce(F.try_element_at(moves, F.concat_ws("\n", s, r)), F.lit("\n")))
    return end.isin(list(t.accept))


def formatted(conversations: DataFrame, t: Template = INST) -> DataFrame:
    """conv_id, segments (array of text, loss), formatted (the segments' text), valid: a row a conversation."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = F.array_sort(F.collect_list(F.struct("turn", blank("role").alias("role"), blank("text").alias("text"))))
    rows = conversations.select("conv_id", "turn", "role", "text").groupBy("conv_id").agg(turns.alias("turns"))
    parts = F.flatten(F.transform("turns", lambda x: segments(x["role"], x["text"], t)))
    return (rows.withColumn("segments", parts)
            .select("conv_id", "segments", F.array_join(F.col("segments")["text"], "").alias("formatted"),
                    valid(F.col("turns")["role"], t).alias("valid")))


def read_back(text: Column, t: Template = INST) -> Column:
    """The turns (role, text) that a formatted string was made of."""
    every = [*t.turns.items(), (None, t.other)]
    pattern = "(?s)" + "|".join(re.escape(x.open) + ".*?" + re.escape(x.close) for _, x in every)

    def turn(x: Column) -> Column:
        body = lambda u: F.substr(x, F.lit(len(u.open) + 1), F.length(x) - (len(u.open) + len(u.close)))
        other, mark = body(t.other), F.lit(t.role_end)
        cut = F.position(mark, other)
        out = F.when(F.lit(False), F.struct(F.lit("").alias("role"), F.lit("").alias("text")))
        for role, u in t.turns.items():
            out = out.when(F.startswith(x, F.lit(u.open)), F.struct(F.lit(role).alias("role"), unescaped(body(u)).alias("text")))
        return out.otherwise(F.struct(unescaped(F.substr(other, F.lit(1), cut - 1)).alias("role"),
                                      unescaped(F.substr(other, cut + len(t.role_end))).alias("text")))

    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), turn)
