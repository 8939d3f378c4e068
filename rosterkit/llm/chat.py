"""Chat formatting (operator 4), DataFrame expressions only.

A conversation's turns are collected as structs and sorted; adjacent
turns of one role become one block, and all is joined to one string:

    <s>[INST]role[/INST]text[SEP]text</s><s>[INST]...

Control strings inside roles and texts are escaped so that the output
alone gives back every turn: ``escape`` is reversible and the escaped
form holds no control string. The loss mask is a list of (start, length)
in code points; it covers the escaped texts of the trained roles and
nothing of the markup.

Defined results: a null text or role is the empty string; turns with the
same number are ordered by role, then text; repeated rows are repeated
turns; a null turn number comes first; rows with a null conversation id
form one conversation; extra columns are ignored; an empty table gives
an empty result. One conversation is one output row and must fit a task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep


@dataclass(frozen=True)
class ChatTemplate:
    open: str = "<s>[INST]"
    role_end: str = "[/INST]"
    separator: str = "[SEP]"
    close: str = "</s>"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "[SEP]")
    mark: str = "~"                         # escape character; may occur in texts
    trained: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        if len(self.controls) > 9 or any(self.mark in c for c in self.controls):
            raise ValueError("at most nine control strings, none with the escape character")
        for a in self.controls:            # else a text's end and the next control could form an earlier match
            for b in self.controls:
                if any(a.endswith(b[:k]) for k in range(1, len(b)) if (a, k) != (b, len(b))):
                    raise ValueError(f"{a!r} ends like {b!r} begins")


def escape(x: Column, template: ChatTemplate) -> Column:
    """mark -> mark 0, then control k -> mark k."""
    x = F.replace(x, F.lit(template.mark), F.lit(template.mark + "0"))
    for k, control in enumerate(template.controls, 1):
        x = F.replace(x, F.lit(control), F.lit(f"{template.mark}{k}"))
    return x


def unescape(x: Column, template: ChatTemplate) -> Column:
    for k, control in enumerate(template.controls, 1):
        x = F.replace(x, F.lit(f"{template.mark}{k}"), F.lit(control))
    return F.replace(x, F.lit(template.mark + "0"), F.lit(template.mark))


def format_conversations(turns: DataFrame, template: ChatTemplate = ChatTemplate(), conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss (array of start, length)."""
    t = keep(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    t = t.select("conv_id", F.struct("turn", escape(F.coalesce("role", F.lit("")), template).alias("role"),
                                     escape(F.coalesce("text", F.lit("")), template).alias("text")).alias("t"))
    c = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # Places where a block of one role begins, and where the next one does.
    c = c.withColumn("at", F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: (i == 1) | (
        F.element_at("turns", i)["role"] != F.element_at("turns", F.greatest(i - 1, F.lit(1)))["role"])))
    c = c.withColumn("blocks", F.transform(F.arrays_zip(F.col("at").alias("a"), F.concat(F.slice("at", 2, F.size("at")), F.array(F.size("turns") + 1)).alias("b")),
                                           lambda p: F.struct(F.element_at("turns", p["a"])["role"].alias("role"),
                                                              F.transform(F.slice("turns", p["a"], p["b"] - p["a"]), lambda x: x["text"]).alias("texts"))))
    head = lambda b: F.concat(F.lit(template.open), b["role"], F.lit(template.role_end))
    body = lambda b: F.array_join(b["texts"], template.separator)
    c = c.withColumn("formatted", F.array_join(F.transform("blocks", lambda b: F.concat(head(b), body(b), F.lit(template.close))), ""))
    # The mask: lengths of all stretches in order, summed up, those of trained texts kept.
    sep, close = len(template.separator), len(template.close)
    trained = F.array(*[F.lit(r) for r in template.trained])
    stretches = F.flatten(F.transform("blocks", lambda b: F.transform(b["texts"], lambda x, i: F.struct(
        F.when(i == 0, F.length(head(b))).otherwise(F.lit(sep)).alias("skip"), F.length(x).alias("n"),
        F.when(i == F.size(b["texts"]) - 1, F.lit(close)).otherwise(F.lit(0)).alias("after"),
        F.array_contains(trained, unescape(b["role"], template)).alias("on")))))
    return c.withColumn("stretches", stretches).select("conv_id", "formatted", _mask(F.col("stretches")).alias("loss"))


def _mask(stretches: Column, chunk: int = 256) -> Column:
    """(start, length) of the stretches that are on. Folded in chunks: a
    fold copies the list that it grows, which a long one would feel."""
    spans = "array<struct<start:bigint,length:bigint>>"
    def step(a: Column, s: Column) -> Column:
        at = a["at"] + s["skip"]
        span = F.struct(at.alias("start"), s["n"].cast("long").alias("length"))
        return F.struct((at + s["n"] + s["after"]).alias("at"), F.when(s["on"], F.concat(a["out"], F.array(span))).otherwise(a["out"]).alias("out"))

    def fold(a: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(a["at"].alias("at"), F.array().cast(spans).alias("out")), step)
        return F.struct(inner["at"].alias("at"), F.concat(a["out"], F.array(inner["out"])).alias("out"))

    parts = F.transform(F.sequence(F.lit(1), F.greatest(F.size(stretches), F.lit(1)), F.lit(chunk)), lambda i: F.slice(stretches, i, chunk))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{spans}>").alias("out"))
    return F.flatten(F.aggregate(parts, start, fold)["out"])


def read_back(formatted: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """The turns and the text under the mask, from the output alone:
    conv_id, turns (array of role, text), loss_text, formatted."""
    quoted = lambda s: r"\Q" + s + r"\E"
    blocks = F.filter(F.split("formatted", quoted(template.close), -1), lambda b: b != "")
    body = lambda b: F.substring(b, F.lit(len(template.open) + 1), F.length(b))
    role = lambda b: F.substring_index(body(b), template.role_end, 1)
    texts = lambda b: F.split(F.substring(body(b), F.length(role(b)) + len(template.role_end) + 1, F.length(b)), quoted(template.separator), -1)
    turns = F.flatten(F.transform(blocks, lambda b: F.transform(texts(b), lambda x: F.struct(
        unescape(role(b), template).alias("role"), unescape(x, template).alias("text")))))
    loss = F.array_join(F.transform("loss", lambda m: unescape(F.substring(F.col("formatted"), (m["start"] + 1).cast("int"), m["length"].cast("int")), template)), "")
    return formatted.select("conv_id", turns.alias("turns"), loss.alias("loss_text"), "formatted")
