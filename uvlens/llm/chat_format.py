"""Chat formatting (operator 8, native): relational formatting with Spark
expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of
one role are merged into a run; runs are concatenated:

    <|turn|>role<|says|>text<|more|>text<|end|>

``<|more|>`` stands between merged texts, so every turn can be read back. Control
strings inside roles and texts are escaped reversibly: ``&`` becomes ``&amp;``, then
the first character of each control string (the template's own ``<|``, and those
that tokenizers commonly reserve) becomes an entity.

``format_chats`` returns the formatted string and the loss mask as spans (start and
length in code points, one span per text of an assistant turn). ``read_back``
parses turns and masked texts out of the formatted string and spans alone.

The one exchange is by conversation: the result holds one string per conversation,
so a conversation must fit one task (as must its result row); conversations are
spread over the tasks by a hash of their id. Time is linear in the text: where a text
begins is a running sum of lengths, a window over the same exchange.

Cases. Null texts and roles read as empty. Turns are ordered by (turn, role, text),
null turns first, so ties and repeated rows have one order, and repeated rows are
kept. Rows with a null conversation id form one conversation. Empty table: empty
result. Extra columns are ignored; only the named ones are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, SAYS, MORE, END = "<|turn|>", "<|says|>", "<|more|>", "<|end|>"
# Control strings that texts must not contain unescaped.
CONTROL = ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
ENTITIES = {"<": "&lt;", "[": "&lsqb;"}


def escape(c: Column) -> Column:
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;"))
    for s in CONTROL:
        c = F.replace(c, F.lit(s), F.lit(ENTITIES[s[0]] + s[1:]))
    return c


def unescape(c: Column) -> Column:
    for ch, entity in ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(ch))
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def collect_turns(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per conversation: conv_id and its sorted turns, each with the position
    (from 0) at which its text begins in the formatted string."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.lag("role").over(order)
    head = F.length("role") + len(TURN) + len(SAYS)
    control = F.when(before.isNull(), head).when(before != F.col("role"), head + len(END)).otherwise(len(MORE))
    rows = (df.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), escape(F.col(role)).alias("role"),
                      escape(F.col(text)).alias("text"))
            .withColumn("control", control.cast("bigint")))
    ends = F.sum(F.col("control") + F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (rows.withColumn("start", ends - F.length("text"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "start"))).alias("turns")))


def format_chats(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", learn_role: str = "assistant") -> DataFrame:
    """conv_id, formatted (string), loss_spans (array of start, length; from 0)."""
    turns = F.col("turns")
    n = F.size(turns)
    # where a run of one role begins (positions from 1), and one past the end
    begins = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (
        F.get(turns, i - 1)["role"] != F.get(turns, i - 2)["role"]))
    got = (collect_turns(df, conv_id, turn, role, text)
           .withColumn("begins", F.concat(begins, F.array(n + 1))))
    b = F.col("begins")
    runs = F.transform(
        F.sequence(F.lit(0), F.size(b) - 2),
        lambda k: F.slice(turns, F.get(b, k), F.get(b, k + 1) - F.get(b, k)))
    got = got.withColumn("runs", runs)

    def run_text(run: Column) -> Column:
        return F.concat(F.lit(TURN), F.get(run, F.lit(0))["role"], F.lit(SAYS),
                        F.array_join(F.transform(run, lambda t: t["text"]), MORE), F.lit(END))

    learned = F.filter(turns, lambda t: t["role"] == escape(F.lit(learn_role)))
    spans = F.transform(learned, lambda t: F.struct(t["start"].alias("start"),
                                                    F.length(t["text"]).cast("bigint").alias("length")))
    return got.select("conv_id", F.array_join(F.transform("runs", run_text), "").alias("formatted"),
                      spans.alias("loss_spans"))


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (array of role, text) and loss_texts (array),
    parsed from ``formatted`` and ``loss_spans`` and unescaped."""
    def parts(run: Column) -> Column:
        # "role<|says|>text<|more|>text<|end|>"
        who = F.substring_index(run, SAYS, 1)
        body = F.substring(run, F.length(who) + len(SAYS) + 1, F.length(run))
        body = F.substring(body, F.lit(1), F.length(body) - len(END))
        return F.transform(F.split(body, r"<\|more\|>"),
                           lambda x: F.struct(unescape(who).alias("role"), unescape(x).alias("text")))

    pieces = F.split("formatted", r"<\|turn\|>")
    runs = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    texts = F.transform("loss_spans", lambda s: unescape(
        F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return chats.select("conv_id", "formatted", F.flatten(F.transform(runs, parts)).alias("turns"),
                        texts.alias("loss_texts"))
