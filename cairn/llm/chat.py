"""Chat formatting: a finite-state machine over roles and a declarative template.

A ``Template`` states, as data, which role may follow which, how a turn is opened and closed, and
which roles are trained on. ``format_conversations`` returns per conversation:

* ``valid`` and ``bad_turn``: whether the roles follow the machine, and the position of the first
  turn that does not;
* ``segments``: an array of (text, loss), the formatted text in pieces, each with its loss flag;
* ``formatted``: the pieces joined.

Control strings inside texts are escaped reversibly. The escape character is doubled first; then
one is put before the last character of each control string. Afterwards a run of escape characters
between other characters is odd exactly where one was put in, so undoing both steps in reverse
order restores every text. No control string has a proper prefix that is also its suffix
(``Template`` checks it), so neither neighbouring texts nor two replacements can form a new one.

A conversation is one output row and its digest needs its turns in order, so turns are gathered
per conversation; texts are formatted before that, in parallel. The gathered row is bounded by
Spark's row size. Built-in functions only.

Defined results: null text is empty, a null role is the empty role and never valid; unknown roles
are formatted with their name. Turns are ordered by ``turn`` (nulls first), then role, then text,
so repeated turns have one order. A null ``conv_id`` is a conversation of its own. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    names: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    open_mark: str = "### "
    name_end: str = ": "
    close_mark: str = "</turn>"
    turn_end: str = "\n"
    other: str = "Role "
    loss_roles: tuple[str, ...] = ("assistant",)
    start: tuple[str, ...] = ("system", "user")
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    escape: str = "\\"

    def __post_init__(self) -> None:
        for s in self.control:
            if len(s) < 2 or self.escape in s or any(s[:k] == s[-k:] for k in range(1, len(s))):
                raise ValueError(f"control string {s!r} cannot be escaped safely")
        if any(self.name_end in n or n.startswith(self.other) or self.open_mark in n for n in self.names.values()):
            raise ValueError("a role's name must not hold a control string")

    @property
    def control(self) -> tuple[str, ...]:
        return (self.open_mark, self.close_mark, self.name_end)

    def escaped(self, s: str) -> str:
        return s[:-1] + self.escape + s[-1]


def escape(text: Column, t: Template) -> Column:
    out = F.replace(text, F.lit(t.escape), F.lit(t.escape * 2))
    for s in t.control:
        out = F.replace(out, F.lit(s), F.lit(t.escaped(s)))
    return out


def unescape(text: Column, t: Template) -> Column:
    for s in t.control:
        text = F.replace(text, F.lit(t.escaped(s)), F.lit(s))
    return F.replace(text, F.lit(t.escape * 2), F.lit(t.escape))


def _mapped(key: Column, pairs: dict[str, str], otherwise: Column) -> Column:
    out = None
    for k, v in pairs.items():
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return otherwise if out is None else out.otherwise(otherwise)


def _allowed(before: Column, role: Column, t: Template) -> Column:
    """The machine's transition: may ``role`` follow ``before`` (null: the start)?"""
    ok = before.isNull() & role.isin(*t.start)
    for k, nexts in t.follows.items():
        ok = ok | ((before == k) & role.isin(*nexts))
    return F.coalesce(ok, F.lit(False))


def format_conversations(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, n_turns, valid, bad_turn, segments array<struct<text, loss>>, formatted."""
    t = template
    role = F.coalesce("role", F.lit(""))
    name = _mapped(role, t.names, F.concat(F.lit(t.other), escape(role, t)))
    turns = conversations.select(
        "conv_id", "turn", role.alias("role"),
        F.concat(F.lit(t.open_mark), name, F.lit(t.name_end)).alias("head"),
        escape(F.coalesce("text", F.lit("")), t).alias("body"))
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "body", "head"))).alias("turns"))
    n = F.size("turns")
    roles = F.transform("turns", lambda x: x["role"])
    bad = F.filter(F.sequence(F.lit(0), n - 1), lambda i: ~_allowed(
        F.when(i > 0, F.get(roles, i - 1)), F.get(roles, i), t))
    close = t.close_mark + t.turn_end
    pieces = F.flatten(F.transform("turns", lambda x: F.array(
        F.struct(x["head"].alias("text"), F.lit(False).alias("loss")),
        F.struct(x["body"].alias("text"), x["role"].isin(*t.loss_roles).alias("loss")),
        F.struct(F.lit(close).alias("text"), F.lit(False).alias("loss")))))
    rows = rows.select("conv_id", n.cast("long").alias("n_turns"), (F.size(bad) == 0).alias("valid"),
                       F.get(bad, F.lit(0)).alias("bad_turn"), pieces.alias("segments"))
    return rows.withColumn("formatted", F.concat_ws("", F.transform("segments", lambda x: x["text"])))


def parsed_turns(formatted: Column, template: Template = Template()) -> Column:
    """Read a formatted conversation back: array of (role, text)."""
    t = template
    mark = t.close_mark + t.turn_end
    parts = F.split(formatted, r"\Q" + mark + r"\E")
    back = {v: k for k, v in t.names.items()}

    def turn(part: Column) -> Column:
        at = F.instr(part, F.lit(t.name_end))
        name = F.substring(part, F.lit(len(t.open_mark) + 1), at - 1 - len(t.open_mark))
        body = F.substring(part, at + len(t.name_end), F.length(part))
        other = unescape(F.substring(name, F.lit(len(t.other) + 1), F.length(name)), t)
        return F.struct(_mapped(name, back, other).alias("role"), unescape(body, t).alias("text"))

    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)
