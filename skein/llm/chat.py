r"""Chat formatting by Spark expressions only.

A conversation becomes blocks, one for each run of turns of the same role:

    <|role|>\n text <|sep|> text <|end|>\n

Inside roles and texts a backslash becomes two, `<|` becomes `<\|` and `|>` becomes `|\>`, so that no control string can
stand in a text; reading back takes the character after each backslash as it is. Turns merged into a block stay apart by
<|sep|>, so that the output gives back every turn. The loss mask covers each assistant text, without any mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, SEP, END = "<|", "|>\n", "<|sep|>", "<|end|>\n"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit("<|"), F.lit("<\\|")), F.lit("|>"), F.lit("|\\>"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, n_turns, loss_spans) for turns(conv_id, turn, role, text).

    Null roles and texts count as empty. Turns are ordered by turn (null first), then role, then text, so that ties and
    repeated rows, which all stay, have one order. Null conv_ids form one conversation. Other columns are ignored; an
    empty table gives no rows. loss_spans has start (from 0) and length in characters of every assistant text, escaped
    as it stands in the output. A conversation is one string, so it has to fit into one row (2 GB).
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("written", escape(F.col("text")))
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    first = F.coalesce(F.lag("role").over(w) != F.col("role"), F.lit(True))
    last = F.coalesce(F.lead("role").over(w) != F.col("role"), F.lit(True))
    rows = rows.withColumns({"no": F.row_number().over(w), "first": first, "last": last})
    before = F.when(F.col("first"), F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(CLOSE))).otherwise(F.lit(SEP))
    rows = rows.withColumns({"before": F.char_length(before), "after": F.when(F.col("last"), len(END)).otherwise(0)})
    size = F.char_length("written").cast("bigint")
    upto = F.sum(F.col("before") + size + F.col("after")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("start", upto - F.col("after") - size)
    turn = F.struct("no", "role", "written", "first", "start", size.alias("length"))
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    # Merge adjacent turns of a role: the indices at which a run begins, then the slice from each to the next.
    begins = F.transform(F.filter("turns", lambda t: t["first"]), lambda t: t["no"])
    convs = convs.withColumn("begins", F.concat(begins, F.array(F.size("turns") + 1)))
    runs = F.transform(
        F.slice("begins", F.lit(1), F.size("begins") - 1),
        lambda at, i: F.slice("turns", at, F.element_at("begins", i + 2) - at),
    )
    convs = convs.withColumn("runs", runs)
    block = lambda run: F.concat(
        F.lit(OPEN), escape(F.element_at(run, 1)["role"]), F.lit(CLOSE), F.array_join(F.transform(run, lambda t: t["written"]), SEP), F.lit(END)
    )
    spans = F.transform(F.filter("turns", lambda t: t["role"] == LEARNED), lambda t: F.struct(t["start"], t["length"]))
    return convs.select(
        "conv_id", F.array_join(F.transform("runs", block), "").alias("formatted"), F.size("turns").cast("bigint").alias("n_turns"), spans.alias("loss_spans")
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """formatted with the column turns, array<struct<role, text>>, taken from the output alone."""
    # The part after the last <|end|> is empty.
    blocks = F.expr(r"split(formatted, '<[|]end[|]>\n', -1)")
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)
    head = lambda b: F.substring_index(b, CLOSE, 1)
    turns = F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.substring(b, F.char_length(head(b)) + len(CLOSE) + 1, F.char_length(b)), r"<[|]sep[|]>", -1),
                lambda t: F.struct(unescape(F.substring(head(b), len(OPEN) + 1, F.char_length(b))).alias("role"), unescape(t).alias("text")),
            ),
        )
    )
    return formatted.withColumn("turns", turns)


def digest(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the output."""
    back = read_back(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(
        F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )
    back = back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), said.alias("said"), loss.alias("loss"), "formatted")
    sha = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return back.select(
        "conv_id", "n_turns", sha("said").alias("turns_sha256"), F.char_length("loss").cast("bigint").alias("loss_chars"),
        sha("loss").alias("loss_sha256"), F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
