"""Chat formatting with Spark expressions: collected turn structs, sorted, merged and concatenated.

Template: each block of turns of one role is ``<|im_start|>role LF text <|im_sep|> text ... <|im_end|> LF``; adjacent
turns of a role share a block and are parted by the separator.  Inside roles and texts a backslash goes between
``<`` (with the backslashes after it) and ``|``, so no control string can arise there, and taking one away again
restores the text.  A line feed in a role is written ``<|nl|>``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END, NL = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n", "<|nl|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _literally(control: str) -> str:
    return control.replace("|", "\\|")


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", learn_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans, n_blocks) for each conversation.

    ``loss_spans``: (start, length) in code points of each text of ``learn_role`` in ``formatted``, in order.  Null
    roles and texts are empty.  Turns of equal number go by role, then text (a null number first); repeated rows are
    turns of their own.  Rows of a null conversation form one.  An empty table gives an empty result.  A
    conversation is one row of the result, so its turns meet in one task; only that row's size grows with it."""
    none = F.lit("")
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), none).alias("role"),
                    F.coalesce(F.col(text_col).cast("string"), none).alias("text"))
    c = turns.select(F.col(conv_col).alias("conv_id"), turn.alias("t")).groupBy("conv_id") \
        .agg(F.sort_array(F.collect_list("t")).alias("t"))
    # a block begins at the first turn and at each change of role
    starts = F.filter(F.sequence(F.lit(0), F.size("t") - 1),
                      lambda i: (i == 0) | (F.get("t", i)["role"] != F.get("t", i - 1)["role"]))
    c = c.withColumn("starts", starts)

    def block(start, k):
        stop = F.coalesce(F.get(F.col("starts"), k + 1), F.size("t"))
        own = F.slice("t", start + 1, stop - start)
        role = F.get("t", start)["role"]
        return F.struct(F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit(NL)), F.lit("\n")).alias("head"),
                        F.transform(own, lambda x: escape(x["text"])).alias("texts"), (role == learn_role).alias("learn"))

    c = c.select("conv_id", F.transform("starts", block).alias("blocks"))
    text = F.array_join(F.transform("blocks", lambda b: F.concat(b["head"], F.array_join(b["texts"], SEP), F.lit(END))), "")
    # the pieces between which the mask changes: heads, texts, separators and ends, with their lengths
    pieces = F.flatten(F.transform("blocks", lambda b: F.concat(
        F.array(F.struct(F.length(b["head"]).alias("size"), F.lit(False).alias("learn"))),
        F.flatten(F.transform(b["texts"], lambda t, k: F.array(
            F.struct(F.when(k == 0, 0).otherwise(len(SEP)).alias("size"), F.lit(False).alias("learn")),
            F.struct(F.length(t).alias("size"), b["learn"].alias("learn"))))),
        F.array(F.struct(F.lit(len(END)).alias("size"), F.lit(False).alias("learn"))))))
    empty = F.array().cast("array<struct<start:int,length:int>>")
    walked = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), empty.alias("spans")), lambda acc, p: F.struct(
        (acc["at"] + p["size"]).alias("at"),
        F.when(p["learn"], F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("start"), p["size"].alias("length")))))
        .otherwise(acc["spans"]).alias("spans")))
    return c.select("conv_id", text.alias("formatted"), walked["spans"].alias("loss_spans"),
                    F.size("blocks").cast("long").alias("n_blocks"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    def turns(block):
        body = F.substring(block, F.lit(len(START) + 1), F.length(block))
        head = F.substring_index(body, "\n", 1)
        role = unescape(F.replace(head, F.lit(NL), F.lit("\n")))
        rest = F.substring(body, F.length(head) + 2, F.length(body))
        return F.transform(F.split(rest, _literally(SEP)), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    blocks = F.split(formatted, _literally(END))
    return F.flatten(F.transform(F.slice(blocks, 1, F.size(blocks) - 1), turns))


def learned_text(formatted: Column, loss_spans: Column) -> Column:
    """What stands under the loss mask, unescaped and concatenated."""
    return F.array_join(F.transform(loss_spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")
