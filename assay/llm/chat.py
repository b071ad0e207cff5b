"""Chat formatting by a finite-state machine over roles, in DataFrame functions alone.

A declarative template names, for each role, the marks around its text and whether the text is learnt from. A state
machine over the roles checks the order of turns. Each turn gives segments (text, loss): marks carry no loss, and a
text carries its role's flag. Texts are escaped so that no mark can occur inside: the escape character and the first
character of every mark are written as a two-character code, which reading back undoes.

Defined results: a null text or role is empty. Roles the template lacks are written with their name between marks and
carry no loss. Rows of a conversation go by turn (nulls first), then role, then text; repeated rows are turns each.
Conversations whose id is null form one conversation. Order faults are reported, never dropped.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    #: role -> (mark before, mark after, loss)
    roles: dict[str, tuple[str, str, bool]]
    #: marks for other roles: before the name, between name and text, after the text
    other: tuple[str, str, str]
    #: state -> roles that may follow
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    start: str = "start"

    @property
    def marks(self) -> list[str]:
        return [m for a, b, _ in self.roles.values() for m in (a, b)] + list(self.other)

    @property
    def codes(self) -> dict[str, str]:
        """Character -> what stands for it in texts; the escape character comes first."""
        firsts = sorted({m[0] for m in self.marks})
        if ESCAPE in "".join(self.marks) or not all(self.marks):
            raise ValueError("a mark must not be empty nor hold the escape character")
        return {c: f"{ESCAPE}{k}" for k, c in enumerate([ESCAPE, *firsts])}


LLAMA_LIKE = Template(
    roles={"system": ("<<SYS>>", "<</SYS>>", False), "user": ("[INST]", "[/INST]", False), "assistant": ("<s>", "</s>", True)},
    other=("[ROLE]", "[TEXT]", "[/ROLE]"),
    allowed={"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
)


def escape(text: Column, t: Template) -> Column:
    for c, code in t.codes.items():
        text = F.replace(text, F.lit(c), F.lit(code))
    return text


def unescape(text: Column, t: Template) -> Column:
    for c, code in reversed(t.codes.items()):
        text = F.replace(text, F.lit(code), F.lit(c))
    return text


def _segments(turn: Column, t: Template) -> Column:
    def seg(text: Column, loss: bool) -> Column:
        return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

    body = escape(turn["text"], t)
    a, b, c = t.other
    out = F.array(seg(F.lit(a), False), seg(escape(turn["role"], t), False), seg(F.lit(b), False), seg(body, False), seg(F.lit(c), False))
    for role, (before, after, loss) in t.roles.items():
        out = F.when(turn["role"] == role, F.array(seg(F.lit(before), False), seg(body, loss), seg(F.lit(after), False))).otherwise(out)
    return out


def _walk(turns: Column, t: Template) -> Column:
    """The state machine: position (from 1) of the first turn that may not follow, null if the order is valid."""
    state = F.struct(F.lit(t.start).alias("state"), F.lit(0).alias("k"), F.lit(None).cast("int").alias("bad"))

    def step(acc: Column, x: Column) -> Column:
        ok = F.lit(False)
        for s, roles in t.allowed.items():
            ok = ok | ((acc["state"] == s) & x["role"].isin(*roles))
        k = acc["k"] + 1
        return F.struct(x["role"].alias("state"), k.alias("k"), F.coalesce(acc["bad"], F.when(~ok, k)).alias("bad"))

    return F.aggregate(turns, state, step, lambda acc: acc["bad"])


def format_chats(rows: DataFrame, template: Template = LLAMA_LIKE) -> DataFrame:
    """(conv_id, n_turns, first_bad_turn, formatted, segments) of each conversation of (conv_id, turn, role, text)."""
    clean = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    conv = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(clean), _by_turn).alias("turns"))
    conv = conv.select("conv_id", F.size("turns").cast("long").alias("n_turns"), _walk(F.col("turns"), template).alias("first_bad_turn"), F.flatten(F.transform("turns", lambda x: _segments(x, template))).alias("segments"))
    return conv.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def _by_turn(a: Column, b: Column) -> Column:
    def cmp(x: Column, y: Column) -> Column:
        return F.when(x.eqNullSafe(y), 0).when(x.isNull(), -1).when(y.isNull(), 1).when(x < y, -1).otherwise(1)

    first = cmp(a["turn"], b["turn"])
    second = cmp(a["role"], b["role"])
    return F.when(first != 0, first).when(second != 0, second).otherwise(cmp(a["text"], b["text"]))


def read_back(formatted: Column, t: Template = LLAMA_LIKE) -> Column:
    """The turns (role, text) of a formatted conversation, from its characters alone."""
    firsts = "".join(sorted({m[0] for m in t.marks}))
    body = "([^" + "".join("\\" + c for c in firsts) + "]*)"

    def quote(s: str) -> str:
        return "".join(c if c.isalnum() or c.isspace() else "\\" + c for c in s)

    shapes = [f"{quote(a)}{body}{quote(b)}" for a, b, _ in t.roles.values()]
    a, b, c = t.other
    shapes.append(f"{quote(a)}{body}{quote(b)}{body}{quote(c)}")
    turns = F.regexp_extract_all(formatted, F.lit("|".join(shapes)), F.lit(0))

    def parse(x: Column) -> Column:
        plain = F.substring(x, len(a) + 1, F.length(x) - len(a) - len(c))
        at = F.instr(plain, b)
        out = F.struct(unescape(F.substring(plain, F.lit(1), at - 1), t).alias("role"), unescape(F.substring(plain, at + len(b), F.length(plain)), t).alias("text"))
        for role, (before, after, _) in t.roles.items():
            text = F.substring(x, F.lit(len(before) + 1), F.length(x) - len(before) - len(after))
            out = F.when(x.startswith(before), F.struct(F.lit(role).alias("role"), unescape(text, t).alias("text"))).otherwise(out)
        return out

    return F.transform(turns, parse)


def masked_text(segments: Column, t: Template = LLAMA_LIKE) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], t)), "")
