"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn becomes a training example of its own: all turns before it are its
context, and only that reply is trainable. Turns after a conversation's last reply make
one more example without a target, so that the output holds every turn.

The template, with one blank inside each mark:

    user        <s>[INST] text [/INST]
    other role  <s>[INST:role] text [/INST]     role as url_encode() writes it
    assistant    text </s>

Control strings inside texts are escaped reversibly: a backslash goes behind the opening
character of whatever looks like a mark, or like a mark with backslashes in it already.
So no text can hold a mark, and taking one backslash out restores it.

Defined cases: null text is empty, a null role is the role ``""``; turns go by number
(null first), equal numbers by role and then text; repeated rows stay; rows with a null
conversation id are one conversation; an empty table gives no examples; other columns are
ignored. A conversation is one row and its turns' text must fit into one; the expansion
itself is never held at once, since an example is cut from the conversation's formatted
text only when its row is made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template.
MARK = r"([<\[])(\\*)(/?(?:s>|INST[\]:]))"
ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST[\]:]))"
TURN = r"(?s)<s>\[INST(?::([^\]]*))?\] (.*?) \[/INST\]| (.*?) </s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, MARK, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def format_turn(role: Column, text: Column) -> Column:
    body = escape(text)
    header = F.when(role == "user", F.lit("<s>[INST] ")).otherwise(
        F.concat(F.lit("<s>[INST:"), F.url_encode(role), F.lit("] ")))
    return F.when(role == "assistant", F.concat(F.lit(" "), body, F.lit(" </s>"))).otherwise(
        F.concat(header, body, F.lit(" [/INST]")))


def chat_examples(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """One row per example: conv_id, example (from 0), turns (how many it shows), last
    (whether it is the conversation's last example), text, and the loss mask as the code
    point span [loss_start, loss_end) of ``text``, null in an example without a target."""
    plain = F.coalesce(F.col(text), F.lit(""))
    who = F.coalesce(F.col(role), F.lit(""))
    formatted = format_turn(who, plain)
    turns = conversations.groupBy(F.col(conv_id).alias("conv_id")).agg(
        F.array_sort(F.collect_list(F.struct(
            F.col(turn).alias("turn"), who.alias("role"), plain.alias("text"), formatted.alias("formatted")))).alias("t"))
    # ends[i]: code points up to the end of turn i.
    ends = F.expr("""aggregate(t, cast(array() as array<bigint>),
        (acc, x) -> array_append(acc, coalesce(try_element_at(acc, -1), 0L) + length(x.formatted)))""")
    shown = F.expr("filter(sequence(1, size(t)), i -> t[i - 1].role = 'assistant' or i = size(t))")
    conv = turns.select(
        "conv_id", F.array_join(F.expr("transform(t, x -> x.formatted)"), "").alias("whole"), ends.alias("ends"),
        F.expr("transform(t, x -> x.role = 'assistant')").alias("replies"), shown.alias("shown"))
    rows = conv.select("conv_id", "whole", "ends", "replies", F.size("shown").alias("n"),
                       F.posexplode("shown").alias("example", "turns"))
    upto, before = F.expr("ends[turns - 1]"), F.expr("if(turns = 1, 0L, ends[turns - 2])")
    target = F.expr("replies[turns - 1]")
    return rows.select(
        "conv_id", "example", "turns", (F.col("example") == F.col("n") - 1).alias("last"),
        F.substring("whole", F.lit(1), upto.cast("int")).alias("text"),
        F.when(target, before + 1).alias("loss_start"), F.when(target, upto - len(" </s>")).alias("loss_end"))


def read_turns(text: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    return F.transform(
        F.regexp_extract_all(text, F.lit(TURN), F.lit(0)),
        lambda m: F.when(
            m.startswith("<s>"),
            F.struct(
                F.when(m.startswith("<s>[INST] "), F.lit("user")).otherwise(
                    F.url_decode(F.regexp_extract(m, r"^<s>\[INST:([^\]]*)\]", 1))).alias("role"),
                unescape(F.regexp_extract(m, r"(?s)^<s>\[INST[^\]]*\] (.*) \[/INST\]$", 1)).alias("text")),
        ).otherwise(F.struct(F.lit("assistant").alias("role"), unescape(F.regexp_extract(m, r"(?s)^ (.*) </s>$", 1)).alias("text"))))


def conversation_digests(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: n_turns, turns_sha256 (role, newline,
    text, newline per turn), loss_chars and loss_sha256 (all text under the loss mask,
    unescaped, in order) and formatted_chars (code points of all its examples)."""
    span = F.substring("text", (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    per = examples.select(
        "conv_id", "example", F.length("text").cast("long").alias("chars"),
        F.when(F.col("loss_start").isNotNull(), unescape(span)).alias("loss"),
        F.when(F.col("last"), read_turns(F.col("text"))).alias("turns"))
    grouped = per.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.flatten(F.collect_list("turns")).alias("turns"), F.sum("chars").alias("formatted_chars"))
    loss = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    lines = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return grouped.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
