"""Chat formatting in budgeted windows, with DataFrame operations only.

1. Turns of a conversation are ordered by ``turn`` (then role, text; null turns first). The size of a turn
   is its number of words and punctuation runs. Prefix sums of the sizes choose spans: a turn
   belongs to span (words before it) div ``BUDGET``, so spans are whole turns and begin where the budget is
   used up; a turn above the budget stands in a span of its own or ends one.
2. The window of a span: the leading system turn again (if the span does not hold it), the last
   ``HISTORY`` turns before the span as context, then the turns of the span.
3. Every turn is written ``<s>role LF text</s>``. Backslash, ``<`` and ``[``, in texts and roles, are
   written \\0, \\1 and \\2 (line feeds of a role \\3), so no control string can come from a text, and
   each escape is undone in one step. ``loss`` lists the spans (begin, length in code points, escaped
   form) of the assistant texts of the span itself; repeated turns are never targets.

Null roles and texts are empty. Rows that repeat (conversation, turn) are turns of their own. A null
conversation id is a conversation. A conversation's digest needs all its turns in one row;
everything before it, the windows included, is spread over (conversation, turn bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnloom.llm.store import only

BUDGET = 512
HISTORY = 2
BUCKET = 64
BEGIN, END = "<s>", "</s>"
TARGET = "assistant"


def escaped(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\0")), F.lit("<"), F.lit("\\1")), F.lit("["), F.lit("\\2"))
    return F.replace(out, F.lit("\n"), F.lit("\\3")) if role else out


def unescaped(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("\\3"), F.lit("\n")), F.lit("\\2"), F.lit("["))
    return F.replace(F.replace(out, F.lit("\\1"), F.lit("<")), F.lit("\\0"), F.lit("\\"))


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    own = only(conversations, **{conv_id: "conv_id", turn: "turn", role: "role", text: "text"})
    own = own.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    size = F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+")) + 4
    return own.withColumn("size", size.cast("bigint")).withColumn("bucket", F.coalesce(F.floor(F.col("turn") / BUCKET), F.lit(-(2**60))))


def placed_turns(own: DataFrame) -> DataFrame:
    """Turns with ``number`` and ``before``: turns and words of the conversation ahead of each."""
    order = ["turn", "role", "text"]
    inside = Window.partitionBy("conv_id", "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = own.withColumn("n", F.row_number().over(inside)).withColumn("w", F.sum("size").over(inside) - F.col("size"))
    totals = own.groupBy("conv_id", "bucket").agg(F.count("*").alias("held"), F.sum("size").alias("words"))
    over = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = totals.select(
        F.col("conv_id").alias("c"), F.col("bucket").alias("b"), (F.sum("held").over(over) - F.col("held")).alias("turns_ahead"), (F.sum("words").over(over) - F.col("words")).alias("words_ahead")
    )
    met = local.join(ahead, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("bucket") == F.col("b")))
    return met.select("conv_id", "role", "text", (F.col("turns_ahead") + F.col("n") - 1).alias("number"), (F.col("words_ahead") + F.col("w")).alias("before"))


def format_windows(conversations: DataFrame, *, budget: int = BUDGET, history: int = HISTORY, **names: str) -> DataFrame:
    """(conv_id, span, turns, repeated, formatted, loss): one row for each window.

    ``turns`` counts all turns of the window, ``repeated`` those at its head that earlier windows hold.
    """
    placed = placed_turns(turns(conversations, **names)).withColumn("span", F.floor(F.col("before") / budget))
    # where a span begins, and the span after it, follow from its own rows
    first = placed.groupBy("conv_id", "span").agg(F.min("number").alias("first"), F.count("*").alias("held"))
    spans = first.select(F.col("conv_id").alias("c"), F.col("span").alias("s"), "first", "held")
    reach = F.struct("number", "role", "text")
    own = placed.select("conv_id", "span", F.lit(True).alias("new"), reach.alias("t"))
    # a turn is context of the spans that begin within ``history`` turns after it
    ends = spans.select("c", "s", F.explode(F.sequence(F.greatest(F.col("first") - history, F.lit(0)), F.col("first") - 1)).alias("at")).where("first > 0") if history else None
    parts = own
    if history:
        past = ends.join(placed, F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("at") == F.col("number")))
        parts = parts.union(past.select("c", "s", F.lit(False), reach))
    head = placed.where((F.col("number") == 0) & (F.col("role") == "system")).select("conv_id", reach.alias("t"))
    again = spans.where(F.col("first") > history).join(head, F.col("c").eqNullSafe(F.col("conv_id")))
    parts = parts.union(again.select("c", "s", F.lit(False), "t"))
    role, text = escaped(F.col("t.role"), True), escaped(F.col("t.text"))
    lead = F.concat(F.lit(BEGIN), role, F.lit("\n"))
    whole = F.concat(lead, text, F.lit(END))
    piece = F.struct(
        F.col("t.number").alias("number"),
        whole.alias("whole"),
        "new",
        F.char_length(lead).alias("lead"),
        F.char_length(text).alias("body"),
        F.char_length(whole).alias("size"),
        ((F.col("t.role") == TARGET) & F.col("new")).alias("target"),
    )
    rows = parts.groupBy("conv_id", "span").agg(F.sort_array(F.collect_list(piece)).alias("p"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<begin:bigint,length:bigint>>").alias("loss"))

    def add(a: Column, x: Column) -> Column:
        mine = F.array(F.struct((a["at"] + x["lead"]).alias("begin"), x["body"].cast("bigint").alias("length")))
        return F.struct((a["at"] + x["size"]).alias("at"), F.when(x["target"], F.concat(a["loss"], mine)).otherwise(a["loss"]).alias("loss"))

    return rows.select(
        "conv_id",
        "span",
        F.size("p").alias("turns"),
        F.size(F.filter("p", lambda x: ~x["new"])).alias("repeated"),
        F.array_join(F.transform("p", lambda x: x["whole"]), "").alias("formatted"),
        F.aggregate("p", start, add)["loss"].alias("loss"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns, loss, formatted_chars) read back from formatted windows alone.

    ``turns`` is role LF text LF of every turn once, ``loss`` all text under the mask, both unescaped.
    """
    marked = F.slice(F.split("formatted", END), F.col("repeated") + 1, F.col("turns") - F.col("repeated"))

    def turn(x: Column) -> Column:
        at = F.instr(x, "\n")
        role, text = F.substring(x, F.lit(len(BEGIN) + 1), at - len(BEGIN) - 1), F.substring(x, at + 1, F.char_length(x))
        return F.concat(unescaped(role), F.lit("\n"), unescaped(text), F.lit("\n"))

    targets = F.transform("loss", lambda s: unescaped(F.substring("formatted", (s["begin"] + 1).cast("int"), s["length"].cast("int"))))
    one = windows.select(
        "conv_id",
        "span",
        (F.col("turns") - F.col("repeated")).alias("n"),
        F.array_join(F.transform(marked, turn), "").alias("text"),
        F.array_join(targets, "").alias("target"),
        F.char_length("formatted").alias("chars"),
    )
    all_ = one.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("span", "text", "target"))).alias("w"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    return all_.select("conv_id", "n_turns", F.array_join("w.text", "").alias("turns"), F.array_join("w.target", "").alias("loss"), "formatted_chars")
