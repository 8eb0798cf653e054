"""Chat formatting by prefix-target expansion (DataFrame operations only).

Every assistant turn becomes an example of its own: the turns before it as context, and only its reply trainable. Where
turns follow the last assistant turn, one more example holds the whole conversation and trains nothing, so that the
output has every turn.

An example is `<|im_start|>role\\ntext<|im_end|>` for each turn. Inside roles and texts the first character of each
control string, and the escape character itself, are written as %XX, so texts can say anything and come back unchanged.
loss_start and loss_chars (in code points) mark the reply.

Defined cases: null roles and texts are empty; turns are ordered by turn, then role and text, null first; a conversation
with a null id is one conversation; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: What may not stand unescaped inside a text; the role also holds no line end.
ESCAPES = (("%", "%25"), ("<|", "%3C|"), ("</s>", "%3C/s>"), ("<s>", "%3Cs>"), ("[INST]", "%5BINST]"), ("[/INST]", "%5B/INST]"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "%0A"))


def escaped(text: Column, escapes=ESCAPES) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column, escapes=ESCAPES) -> Column:
    """The codes in any order, the escape character last: an encoded text has no other % than those of the codes."""
    for plain, code in reversed(escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_chat(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", trained_role: str = "assistant") -> DataFrame:
    """(conv_id, example, text, loss_start, loss_chars), an example for each reply; loss_chars is null where nothing is trained."""
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    turns = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    talk = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    talk = talk.select(
        "conv_id",
        F.transform("t", lambda x: F.concat(F.lit(OPEN), escaped(x["role"], ROLE_ESCAPES), F.lit("\n"), escaped(x["text"]), F.lit(CLOSE))).alias("parts"),
        F.transform("t", lambda x: F.when(x["role"] == trained_role, F.char_length(escaped(x["text"])))).alias("loss"),
    )
    ends = F.filter(F.sequence(F.lit(1), F.size("parts")), lambda i: F.element_at("loss", i).isNotNull() | (i == F.size("parts")))
    rows = talk.select("conv_id", "parts", "loss", F.posexplode(ends).alias("example", "last"))
    whole = F.array_join(F.slice("parts", F.lit(1), F.col("last")), "")
    loss = F.element_at("loss", F.col("last"))
    return rows.select("conv_id", "example", whole.alias("text"), (F.char_length(whole) - loss - len(CLOSE)).alias("loss_start"), loss.alias("loss_chars"))


def read_back(examples: DataFrame) -> DataFrame:
    """(conv_id, roles, texts, learnt, formatted_chars) from the examples alone: the turns are those of the longest one, learnt the replies in order."""
    reply = F.when(F.col("loss_chars").isNotNull(), F.substring("text", F.col("loss_start") + 1, F.col("loss_chars")))
    by = examples.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("text"),
        F.sort_array(F.collect_list(F.when(F.col("loss_chars").isNotNull(), F.struct("example", reply.alias("reply"))))).alias("replies"),
        F.sum(F.char_length("text")).alias("formatted_chars"),
    )
    parts = F.transform(F.filter(F.split("text", r"<\|im_start\|>"), lambda p: p != ""), lambda p: F.substring(p, F.lit(1), F.char_length(p) - len(CLOSE)))
    return by.select(
        "conv_id",
        F.transform(parts, lambda p: unescaped(F.substring_index(p, "\n", 1), ROLE_ESCAPES)).alias("roles"),
        F.transform(parts, lambda p: unescaped(F.substring(p, F.instr(p, "\n") + 1, F.char_length(p)))).alias("texts"),
        F.transform("replies", lambda r: unescaped(r["reply"])).alias("learnt"),
        "formatted_chars",
    )
