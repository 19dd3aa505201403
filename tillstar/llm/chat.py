"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
context, only its text is trainable. Turns after the last assistant turn (or a
conversation without any) make one more example without a trainable reply, so no
turn is lost. An example holds its whole prefix, hence the output is as long as the
sum of the prefixes; that is the method, not a side effect.

Defined results: a null text or role is empty; turns sort by (turn, role, text), so
ties and repeated rows keep all their rows in a fixed order; rows whose ``conv_id`` is
null make one conversation; an empty table gives no example; columns other than
the four named ones are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """One backslash more between ``<`` and ``|``: afterwards no control string is left inside."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """Roles end at a line break, so theirs is written as ``\\n`` and a backslash as ``\\b``."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def examples(conversations: DataFrame) -> DataFrame:
    """Examples: conv_id, example (from 0), formatted, loss_start, loss_end.

    The mask is a range of code points of ``formatted``, end exclusive; null in an example without a
    trainable reply.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = (
        conversations.select("conv_id", F.struct("turn", empty("role").alias("role"), empty("text").alias("text")).alias("t"))
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    )
    segment = lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(END + "\n"))
    replies = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.element_at("turns", i)["role"] == "assistant")
    last = F.when(F.size("replies") == 0, F.lit(0)).otherwise(F.element_at("replies", -1))
    tail = F.when(last < F.size("turns"), F.array(F.struct(F.size("turns").alias("end"), F.lit(False).alias("reply")))).otherwise(
        F.array().cast("array<struct<end:int,reply:boolean>>"))
    ends = F.concat(F.transform("replies", lambda i: F.struct(i.alias("end"), F.lit(True).alias("reply"))), tail)
    expanded = (
        turns.select("conv_id", F.transform("turns", segment).alias("segments"), replies.alias("replies"), "turns")
        .select("conv_id", "segments", F.posexplode(ends).alias("example", "of"))
    )
    formatted = F.array_join(F.slice("segments", F.lit(1), F.col("of.end")), "")
    own = F.char_length(F.element_at("segments", F.col("of.end"))) - len(START) - len("assistant\n") - len(END + "\n")
    stop = F.char_length("formatted") - len(END + "\n")
    return (
        expanded.select("conv_id", "example", formatted.alias("formatted"), F.when(F.col("of.reply"), own).alias("own"))
        .select("conv_id", "example", "formatted", F.when(F.col("own").isNotNull(), stop - F.col("own")).alias("loss_start"),
                F.when(F.col("own").isNotNull(), stop).alias("loss_end"))
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) pairs that ``formatted`` was made of."""
    closed = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda s: s != "")
    body = lambda s: F.substr(s, F.lit(len(START) + 1))
    return F.transform(closed, lambda s: F.struct(
        unescape_role(F.substring_index(body(s), "\n", 1)).alias("role"),
        unescape(F.substr(body(s), F.instr(body(s), F.lit("\n")) + 1)).alias("text")))


def loss_text(formatted: Column, start: Column, end: Column) -> Column:
    return unescape(F.substr(formatted, start + 1, end - start))


def digest(examples_: DataFrame) -> DataFrame:
    """Per conversation what the examples say of its turns and trainable texts; all read from ``examples_``."""
    per = examples_.select("conv_id", "example", "formatted", F.coalesce(loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end")), F.lit("")).alias("loss"))
    grouped = per.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"),
        F.sum(F.char_length("formatted").cast("long")).alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_examples"),
    )
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return grouped.select("*", read_turns(F.col("whole")).alias("turns")).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars", "n_examples")
