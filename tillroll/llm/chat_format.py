r"""Chat formatting as a relational job: sorted turn structs, merged runs of one role, concatenation by expressions.

A conversation becomes one text of messages, `<|im_start|>role\ntext<|im_end|>\n`. Its turns are collected as structs and
sorted; adjacent turns of one role are merged into one message whose texts stand apart by `<|im_next|>`, so that the
turns can be told apart again. A loss mask, as runs of code points over the whole text, marks the texts of the assistant
and nothing else. `read_back` takes the turns and the masked texts out of the formatted text again.

Control strings inside a text cannot be mistaken for the template's: one backslash is put into every `<|`, and one more
into every `<\|`, `<\\|` and so on, so no escaped text holds `<|`, and taking one backslash away restores it. A role also
has `%` and line breaks written as `%25` and `%0A`, because a line break ends it.

Scale: one shuffle of the turns by conversation. Every step afterwards is linear in a conversation's length: runs are cut
out by slices and joined once, nothing grows an array element by element. A conversation is one training example and one
value of the result, so it must fit one row (Spark's limit is 2 GB); a digest of the whole forbids splitting it.

Defined cases: a null text is the empty text, a null role the empty role; turns are sorted by (turn, role, text), null turns first,
and repeated rows all stay; rows with a null conversation id form one conversation; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, NEXT = "<|im_start|>", "<|im_end|>\n", "<|im_next|>"
LOSS_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def role_text(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def role_back(text: Column) -> Column:
    return F.replace(F.replace(unescaped(text), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _chars(text: Column | str) -> Column:
    return F.char_length(F.lit(text) if isinstance(text, str) else text)


def messages(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, turns, messages): messages are structs (role, texts) of escaped text, one for each run of one role."""
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    rows = turns.select(F.col(conv_col).alias("conv"), turn.alias("t"))
    grouped = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def begins(i: Column) -> Column:
        return (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"])

    cut = grouped.withColumn("starts", F.filter(F.sequence(F.lit(0), F.size("turns") - 1), begins))

    def merged(start: Column, i: Column) -> Column:
        end = F.coalesce(F.get("starts", i + 1), F.size("turns"))
        texts = F.transform(F.slice("turns", start + 1, end - start), lambda t: escaped(t["text"]))
        return F.struct(role_text(F.get("turns", start)["role"]).alias("role"), texts.alias("texts"))

    return cut.select("conv", F.size("turns").alias("n_turns"), F.transform("starts", merged).alias("messages"))


def format_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: (conv, n_messages, formatted, loss_mask).

    `loss_mask` covers the text with runs (chars, loss), in turn the template's own characters and one turn's text; the
    last run closes the last message.
    """
    merged = messages(turns, conv_col, turn_col, role_col, text_col)

    def line(m: Column) -> Column:
        return F.concat(F.lit(START), m["role"], F.lit("\n"), F.array_join(m["texts"], NEXT), F.lit(END))

    def runs(m: Column, i: Column) -> Column:
        opening = F.when(i > 0, len(END)).otherwise(0) + len(START) + _chars(m["role"]) + 1

        def pair(text: Column, j: Column) -> Column:
            gap = F.when(j == 0, opening).otherwise(len(NEXT))
            return F.array(
                F.struct(gap.alias("chars"), F.lit(False).alias("loss")),
                F.struct(_chars(text).alias("chars"), (m["role"] == LOSS_ROLE).alias("loss")),
            )

        return F.flatten(F.transform(m["texts"], pair))

    last = F.array(F.struct(F.lit(len(END)).alias("chars"), F.lit(False).alias("loss")))
    return merged.select(
        F.col("conv").alias(conv_col),
        F.size("messages").alias("n_messages"),
        F.array_join(F.transform("messages", line), "").alias("formatted"),
        F.concat(F.flatten(F.transform("messages", runs)), last).alias("loss_mask"),
    )


def read_back(formatted: DataFrame, text_col: str = "formatted", mask_col: str = "loss_mask") -> DataFrame:
    """The columns of `formatted` and what its text says: `turns`, structs (role, text), and `loss_text`."""
    whole = F.split(F.col(text_col), r"<\|im_end\|>\n", -1)

    def parts(message: Column) -> Column:
        line_end = F.instr(message, "\n")
        role = F.substr(message, F.lit(len(START) + 1), line_end - len(START) - 1)
        texts = F.split(F.substr(message, line_end + 1), r"<\|im_next\|>", -1)
        return F.struct(role.alias("role"), texts.alias("texts"))

    split = formatted.withColumn("_whole", whole).withColumn(
        "_parts", F.transform(F.slice("_whole", F.lit(1), F.size("_whole") - 1), parts)
    )
    turns = F.flatten(
        F.transform(
            "_parts",
            lambda m: F.transform(m["texts"], lambda t: F.struct(role_back(m["role"]).alias("role"), t.alias("text"))),
        )
    )
    # Run 2i + 1 of the mask covers text i.
    masked = F.filter(
        F.transform(
            "_turns",
            lambda t, i: F.when(
                F.get(mask_col, 2 * i + 1)["loss"], F.substr(t["text"], F.lit(1), F.get(mask_col, 2 * i + 1)["chars"])
            ),
        ),
        lambda text: text.isNotNull(),
    )
    read = split.withColumn("_turns", turns)
    return read.select(
        *[F.col(f"`{c}`") for c in formatted.columns],
        F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), unescaped(t["text"]).alias("text"))).alias("turns"),
        F.array_join(F.transform(masked, unescaped), "").alias("loss_text"),
    )


def digests(read: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_messages) of what `read_back` gives."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        conv_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.col("n_messages").cast("long").alias("n_messages"),
    )
