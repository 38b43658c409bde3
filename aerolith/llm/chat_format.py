"""Chat formatting by prefix-target expansion (DataFrame functions only).

Every assistant turn becomes one training example: all turns before it are
context, and only that reply is under the loss mask. Turns that follow the last
assistant turn (or a conversation without one) make one further example without
a trainable part, so that the output holds every turn.

Template, one piece per turn::

    <|im_start|>ROLE<|im_sep|>TEXT<|im_end|>

Control strings inside roles and texts are escaped with one backslash after
their first character (a control string that already has ``k`` backslashes there
gets ``k + 1``); ``unescape`` takes one away, so the step is reversible for any text.

Defined cases: null role or text counts as empty; turns are ordered by turn
(null first), then role, then text; repeated rows are repeated turns; rows with a
null conversation id form one conversation; other columns are ignored; an empty
table gives no rows. One conversation is one row: its expansion holds each prefix
once, as the training set itself does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"

#: Control strings: what follows the first character of each family.
ANGLE = r"(\|[A-Za-z0-9_]+\|>|/?s>|</?SYS>>)"
SQUARE = r"(/?INST\])"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    text = F.regexp_replace(text, r"(<)(\\*)" + ANGLE, r"$1\\$2$3")
    return F.regexp_replace(text, r"(\[)(\\*)" + SQUARE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    text = F.regexp_replace(text, r"(\[)\\(\\*)" + SQUARE, "$1$2$3")
    return F.regexp_replace(text, r"(<)\\(\\*)" + ANGLE, "$1$2$3")


def format_chats(turns: DataFrame) -> DataFrame:
    """Examples of all conversations: ``conv_id, example, text, loss_start, loss_end, last``.

    ``example`` is the position (from 0) of the last turn in ``text``; the loss mask
    is the code-point range ``[loss_start, loss_end)`` of ``text``, empty where
    nothing is trained. ``last`` marks the example that holds the whole conversation.
    """
    chats = (turns
             .select("conv_id", F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                                         F.coalesce("text", F.lit("")).alias("text")).alias("t"))
             .groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts")))
    pieces = chats.select(
        "conv_id",
        F.transform("ts", lambda t: t["role"] == TRAINED_ROLE).alias("trained"),
        F.transform("ts", lambda t: F.concat(F.lit(START), escape(t["role"]), F.lit(SEP))).alias("heads"),
        F.transform("ts", lambda t: F.concat(escape(t["text"]), F.lit(END))).alias("bodies"))
    n = F.size("heads")
    rows = pieces.select(
        "*", F.explode(F.filter(F.sequence(F.lit(0), n - 1),
                                lambda i: F.get("trained", i) | (i == n - 1))).alias("example"))
    whole = F.array_join(F.zip_with(F.slice("heads", 1, F.col("example") + 1),
                                    F.slice("bodies", 1, F.col("example") + 1), lambda h, b: F.concat(h, b)), "")
    rows = rows.select("conv_id", "example", whole.alias("text"), (F.col("example") == n - 1).alias("last"),
                       F.get("trained", F.col("example")).alias("trained"),
                       F.char_length(F.get("bodies", F.col("example"))).alias("body"))
    end = F.char_length("text") - len(END)
    return rows.select(
        "conv_id", "example", "text",
        F.when(F.col("trained"), F.char_length("text") - F.col("body")).otherwise(end).cast("long").alias("loss_start"),
        end.cast("long").alias("loss_end"), "last")


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, what the formatted examples say about it."""
    turns = F.transform(
        F.expr("slice(split(text, '<[|]im_end[|]>'), 1, size(split(text, '<[|]im_end[|]>')) - 1)"),
        lambda p: F.split(F.substr(p, F.lit(len(START) + 1)), "<[|]im_sep[|]>"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(
        unescape(F.get(t, 0)), F.lit("\n"), unescape(F.get(t, 1)), F.lit("\n"))), "")
    rows = examples.select(
        "conv_id", "example", F.char_length("text").alias("chars"),
        F.when(F.col("last"), F.sha2(said.cast("binary"), 256)).alias("turns_sha256"),
        F.when(F.col("last"), F.size(turns)).alias("n_turns"),
        unescape(F.substr("text", (F.col("loss_start") + 1).cast("int"),
                          (F.col("loss_end") - F.col("loss_start")).cast("int"))).alias("loss"))
    loss = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "")
    return (rows.groupBy("conv_id")
            .agg(F.max("n_turns").cast("long").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"),
                 loss.alias("l"), F.sum("chars").alias("formatted_chars"))
            .select("conv_id", "n_turns", "turns_sha256", F.char_length("l").cast("long").alias("loss_chars"),
                    F.sha2(F.col("l").cast("binary"), 256).alias("loss_sha256"), "formatted_chars"))
