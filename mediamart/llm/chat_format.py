"""Operator 9, chat formatting by prefix-target expansion (DataFrame functions only).

Every assistant turn becomes one example: all turns before it as context, the
reply as the only trainable part. A turn renders as

    <s> role [INST] text </s>        (without the spaces)

and depends on nothing around it, so an example is a prefix of its rendered
conversation. Role and text are escaped first, ``\\`` as ``\\e``, ``<`` as
``\\l``, ``[`` as ``\\b``; after that no control string can occur inside them,
and the escapes read back without loss.

Defined cases: null role or text counts as empty; turns sort by (turn, role,
text), nulls first, so ties and repeated rows have one order and all are kept;
a null conv_id is a conversation of its own; turns after the last reply (or a
conversation without one) come as one more example without a trainable part,
so no turn is lost; very long texts are formatted whole (a conversation has to
fit into one row, at most 2 GB, and so has each of its examples); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, MIDDLE, END = "<s>", "[INST]", "</s>"
# order matters: the escape character itself goes first
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))
TARGET_ROLE = "assistant"


def escape(text: Column) -> Column:
    for raw, code in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for raw, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(BEGIN), escape(role), F.lit(MIDDLE), escape(text), F.lit(END))


def parse(formatted: Column) -> Column:
    """Array of (role, text) read from a formatted string."""
    parts = F.split(formatted, END)
    return F.transform(
        F.slice(parts, F.lit(1), F.size(parts) - 1),
        lambda p: F.struct(
            unescape(F.substring_index(F.substr(p, F.lit(len(BEGIN) + 1)), MIDDLE, 1)).alias("role"),
            unescape(F.substring_index(p, MIDDLE, -1)).alias("text")))


def format_examples(turns: DataFrame) -> DataFrame:
    """One row per example: conv_id, example (from 0), formatted, loss_start
    (1-based character position), loss_length (0: nothing trainable) and
    is_last (the example that holds the whole conversation)."""
    rows = turns.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    shown = rows.select("*", escape(F.col("text")).alias("body"), render(F.col("role"), F.col("text")).alias("shown"))
    # running end position of every turn in the rendered conversation; it grows with every turn, so it orders them
    so_far = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    placed = shown.select("conv_id", F.struct(
        F.sum(F.length("shown")).over(so_far).alias("end"), F.length("body").cast("long").alias("size"),
        (F.col("role") == TARGET_ROLE).alias("reply"), F.col("shown")).alias("t"))
    talks = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("steps"))
    talks = talks.select("conv_id", "steps", F.array_join(F.transform("steps", lambda t: t["shown"]), "").alias("whole"))
    total = F.size("steps")
    chosen = F.filter(
        F.transform("steps", lambda s, i: F.struct(s["end"].alias("end"), s["size"].alias("size"),
                                                   s["reply"].alias("reply"), (i == total - 1).alias("is_last"))),
        lambda s: s["reply"] | s["is_last"])
    each = talks.select("conv_id", "whole", F.posexplode(chosen).alias("example", "s"))
    tail = len(END)
    return each.select(
        "conv_id", "example",
        F.substr("whole", F.lit(1), F.col("s.end").cast("int")).alias("formatted"),
        F.when(F.col("s.reply"), F.col("s.end") - tail - F.col("s.size") + 1).otherwise(F.lit(1).cast("long")).alias("loss_start"),
        F.when(F.col("s.reply"), F.col("s.size")).otherwise(F.lit(0).cast("long")).alias("loss_length"),
        F.col("s.is_last").alias("is_last"))


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted examples: number and
    digest of its turns, and length and digest of the text under the loss mask."""
    turns = parse(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = unescape(F.substr("formatted", F.col("loss_start").cast("int"), F.col("loss_length").cast("int")))
    read = examples.select(
        "conv_id", "example", F.length("formatted").cast("long").alias("chars"), loss.alias("loss"),
        F.when(F.col("is_last"), F.size(turns).cast("long")).alias("turns"),
        F.when(F.col("is_last"), F.sha2(said.cast("binary"), 256)).alias("sha"))
    each = read.groupBy("conv_id").agg(
        F.max("turns").alias("n_turns"), F.max("sha").alias("turns_sha256"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"))
    return each.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
