"""Operator 1, chat formatting: a finite-state machine over roles validates the
turn order, and a declarative template turns each conversation into segments
with per-segment loss flags.

Everything is DataFrame expressions over one sorted array of turns per
conversation. A formatted conversation is one string by definition, so all
turns of a conversation meet in one row; its size is bounded by what a string
may hold (2 GB), not by the number of conversations, and the texts are shuffled
once.

Defined results: a null text or role counts as empty; null turns sort first;
equal turns are ordered by role, then text, and repeated rows stay repeated
turns; rows with a null ``conv_id`` form one conversation; an empty table gives
an empty result; columns other than the four used are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """What surrounds a turn, which roles are trained on, which order is legal.

    ``controls`` are strings that may not appear in a text unescaped: the
    template's own marks and those of other common chat formats. Inside a text,
    ``<`` + ``|im_end|>`` becomes ``<`` + ``\\`` + ``|im_end|>``; a run of
    backslashes already standing there grows by one, so that taking one away
    restores the text exactly.
    """

    turn_start: str = "<|im_start|>"
    role_end: str = "\n"
    turn_end: str = "<|im_end|>\n"
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]")
    loss_roles: tuple[str, ...] = ("assistant",)
    transitions: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user"})
    accepting: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        first = {c[0] for c in self.controls}
        if any(x in c[1:] for c in self.controls for x in first) or "\\" in "".join(self.controls):
            raise ValueError("a control string may hold no other one's first character and no backslash")
        for mark in (self.turn_start, self.turn_end):
            if not any(mark.startswith(c) for c in self.controls):
                raise ValueError(f"{mark!r} must begin with a control string")

    @property
    def _parts(self) -> tuple[str, str]:
        first = "".join(sorted({re.escape(c[0]) for c in self.controls}))
        rest = "|".join(re.escape(c[1:]) for c in sorted(self.controls, key=lambda c: (-len(c), c)))
        return f"([{first}])", f"({rest})"

    @property
    def escape_pattern(self) -> str:
        return rf"{self._parts[0]}(\\*){self._parts[1]}"

    @property
    def unescape_pattern(self) -> str:
        return rf"{self._parts[0]}\\(\\*){self._parts[1]}"

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(self.escape_pattern), F.lit(r"$1\\$2$3"))

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(self.unescape_pattern), F.lit("$1$2$3"))

    def escape_role(self, role: Column) -> Column:
        """Roles end at a line break, so a line break inside one is spelled out."""
        spelled = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit(self.role_end), F.lit("%0A"))
        return self.escape(spelled)

    def unescape_role(self, role: Column) -> Column:
        return F.replace(F.replace(self.unescape(role), F.lit("%0A"), F.lit(self.role_end)), F.lit("%25"), F.lit("%"))


def format_chats(conversations: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """One row per conversation: ``conv_id``, ``valid`` (the machine accepts the
    roles), ``end_state``, ``segments`` (array of text and loss flag; joined, they
    are ``formatted``) and ``formatted``. Invalid conversations are formatted too."""
    t = template or ChatTemplate()
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))
    steps = F.create_map(*[F.lit(x) for (state, role), to in t.transitions.items() for x in (f"{state}>{role}", to)])
    state = F.aggregate("turns", F.lit("start"),
                        lambda s, x: F.coalesce(F.try_element_at(steps, F.concat(s, F.lit(">"), x["role"])), F.lit("invalid")))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(F.transform("turns", lambda x: F.array(
        segment(F.concat(F.lit(t.turn_start), t.escape_role(x["role"]), F.lit(t.role_end)), F.lit(False)),
        segment(t.escape(x["text"]), x["role"].isin(*t.loss_roles)),
        segment(F.lit(t.turn_end), F.lit(False)))))
    out = turns.select("conv_id", state.alias("end_state"), segments.alias("segments"))
    return out.select("conv_id", F.col("end_state").isin(*t.accepting).alias("valid"), "end_state", "segments",
                      F.array_join(F.transform("segments", lambda x: x["text"]), "").alias("formatted"))


def parse_chats(formatted: Column, template: ChatTemplate | None = None) -> Column:
    """The turns of a formatted conversation: array of role and text, unescaped."""
    t = template or ChatTemplate()
    pieces = F.split(formatted, F.lit(re.escape(t.turn_end)), F.lit(-1))
    bodies = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda x: F.substr(x, F.lit(len(t.turn_start) + 1)))

    def turn(body: Column) -> Column:
        role = F.substring_index(body, t.role_end, 1)
        text = F.substr(body, F.length(role) + len(t.role_end) + 1)
        return F.struct(t.unescape_role(role).alias("role"), t.unescape(text).alias("text"))

    return F.transform(bodies, turn)


def loss_text(segments: Column, template: ChatTemplate | None = None) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    t = template or ChatTemplate()
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: t.unescape(s["text"])), "")


def chat_digest(conversations: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Digests read back from what ``format_chats`` gave."""
    chats = format_chats(conversations, template)
    read = chats.select("conv_id", "valid", F.length("formatted").cast("long").alias("formatted_chars"),
                        parse_chats(F.col("formatted"), template).alias("turns"),
                        loss_text(F.col("segments"), template).alias("loss"))
    joined = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "valid")
