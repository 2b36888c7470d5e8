"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context, the reply is the
only trainable text. Turns are written as `<|im_start|>role\\ntext<|im_end|>\\n`; control strings inside roles
and texts are escaped reversibly, so the marks of the template are the only ones in the output.

The turns of a conversation meet in one row because its last example holds them all; a conversation is
bounded by what one string may hold. Examples are made after that, row by row, without another shuffle.

Null texts and roles count as empty. Turns with equal numbers are ordered by role and text, a null turn
comes first; a null conv_id is a conversation like others. A conversation without an assistant turn, and the
turns behind the last one, make a closing row without a target, so no turn is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    """`&` and `<|` written so that no control string is left."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    """A role also ends at a line feed, so that is escaped too."""
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def prefix_targets(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The examples: conv_id, example (from 0), n_turns, formatted, loss_start, loss_end, closing.

    `formatted` holds the context and the reply to its end mark; the half-open span of code points from
    loss_start to loss_end is the reply. Both are null in a row without a target. `closing` marks the row that
    reaches the last turn.
    """
    turns = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    gathered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            (t["role"] == ASSISTANT).alias("reply"),
            F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"),
            escape(t["text"]).alias("body"),
        ),
    )
    laid = gathered.select("conv_id", parts.alias("parts")).select(
        "conv_id",
        F.transform(
            "parts",
            lambda p: F.struct(
                p["reply"].alias("reply"),
                F.concat(p["head"], p["body"], F.lit(END + "\n")).alias("whole"),
                F.length(p["head"]).alias("head"),
                F.length(p["body"]).alias("body"),
            ),
        ).alias("parts"),
    )
    whole = laid.select(
        "conv_id",
        F.size("parts").alias("n_turns"),
        F.array_join(F.transform("parts", lambda p: p["whole"]), "").alias("conversation"),
        F.posexplode("parts").alias("place", "part"),
        F.transform("parts", lambda p: F.length(p["whole"])).alias("lengths"),
        F.transform("parts", lambda p: p["reply"]).alias("replies"),
    )
    last = F.col("place") == F.col("n_turns") - 1
    wanted = whole.where(F.col("part.reply") | last)
    begin = F.aggregate(F.slice("lengths", F.lit(1), F.col("place")), F.lit(0), lambda a, n: a + n)
    earlier = F.size(F.filter(F.slice("replies", F.lit(1), F.col("place")), lambda r: r))
    loss = F.when(F.col("part.reply"), F.col("begin") + F.col("part.head"))
    return wanted.withColumns({"begin": begin, "example": earlier}).select(
        "conv_id",
        "example",
        F.col("n_turns").cast("long").alias("n_turns"),
        F.substr("conversation", F.lit(1), F.col("begin") + F.length("part.whole")).alias("formatted"),
        loss.alias("loss_start"),
        (loss + F.col("part.body")).alias("loss_end"),
        last.alias("closing"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: an array of (role, text), unescaped."""
    pieces = F.filter(F.split(formatted, "<\\|im_end\\|>\n", -1), lambda p: p != "")
    bodies = F.transform(pieces, lambda p: F.substr(p, F.lit(len(START) + 1)))
    return F.transform(
        bodies,
        lambda b: F.struct(
            unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
            unescape(F.substr(b, F.instr(b, "\n") + 1)).alias("text"),
        ),
    )


def digest(examples: DataFrame) -> DataFrame:
    """What the examples say when read back, a row per conversation.

    The turns are those of the closing example, the trained text is that under the loss spans of all
    examples in order, `formatted_chars` counts the code points of all examples.
    """
    read = examples.select(
        "conv_id",
        "example",
        F.length("formatted").alias("chars"),
        unescape(F.substr("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))).alias("loss"),
        F.when(F.col("closing"), read_turns(F.col("formatted"))).alias("turns"),
    )
    grouped = read.groupBy("conv_id").agg(
        F.first("turns", ignorenulls=True).alias("turns"),
        F.array_sort(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))).alias("losses"),
        F.sum(F.col("chars").cast("long")).alias("formatted_chars"),
    )
    trained = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return grouped.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        "formatted_chars",
    )
