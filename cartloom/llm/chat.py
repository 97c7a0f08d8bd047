"""Chat formatting with prefix-target expansion, in DataFrame functions only.

A conversation becomes one text: every turn is `<|im_start|>role`, a line break, its text,
`<|im_end|>` and a line break. Every assistant turn is exploded into an example of its own: the
conversation up to and including that turn, of which only the reply is trainable. As the template has
no end mark of its own, each example is a prefix of the conversation's text and can be kept as
offsets; `examples` writes the texts out.

Control strings inside texts are escaped with a backslash in front of the bar of every `<|` and of
every backslash; roles are percent-coded. Both are undone exactly by `parse_turns`.

Cases: null texts and roles are empty. Turns are ordered by number (null first), ties by role and
text, and repeated rows are turns of their own. Null conversation ids form one conversation. A
conversation without an assistant turn has no example. Other columns are not read. A conversation's
text is one value by contract, so one conversation is put together in one task; hot first turns or
repeated conversations are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm.pii import running_totals

#: Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\|(?<=<)\|)", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escape_role(role: Column) -> Column:
    coded = F.replace(role, F.lit("%"), F.lit("%25"))
    return F.replace(F.replace(coded, F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def _unescape_role(role: Column) -> Column:
    plain = F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n"))
    return F.replace(plain, F.lit("%25"), F.lit("%"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, targets.

    targets: per assistant turn (turn, start, end): its place among the turns, and the code points of
    `formatted` that are its escaped reply. The example of a target is `formatted` up to its end.
    """
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
        ).alias("row"),
    )
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    pieces = gathered.select("conv_id", F.transform("rows", lambda r: F.struct(
        (r["role"] == TRAINED_ROLE).alias("trained"),
        F.concat(F.lit(START), _escape_role(r["role"]), F.lit("\n")).alias("head"),
        escape(r["text"]).alias("body"),
    )).alias("pieces"))
    # Columns of their own, as the sums look their elements up block by block.
    measured = pieces.withColumn(
        "lengths", F.transform("pieces", lambda p: (F.length(p["head"]) + F.length(p["body"]) + len(END)).cast("long"))
    )
    placed = measured.withColumn("starts", running_totals(F.col("lengths")))
    marked = F.transform(F.arrays_zip("pieces", "lengths", "starts"), lambda x, i: F.struct(
        x["pieces"]["trained"].alias("trained"),
        F.struct(
            i.alias("turn"), (x["starts"] + F.length(x["pieces"]["head"])).alias("start"),
            (x["starts"] + x["lengths"] - len(END)).alias("end"),
        ).alias("target"),
    ))
    return placed.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
        F.transform(F.filter(marked, lambda m: m["trained"]), lambda m: m["target"]).alias("targets"),
    )


def examples(formatted: DataFrame) -> DataFrame:
    """Prefix-target examples: conv_id, turn, text, loss_start, loss_end.

    `text` holds all turns before and the reply; its code points from loss_start to loss_end are trainable.
    Row by row, so no task holds more than one example's text at a time.
    """
    each = formatted.select("conv_id", "formatted", F.explode("targets").alias("t"))
    return each.select(
        "conv_id", F.col("t.turn").alias("turn"),
        F.substring(F.col("formatted"), F.lit(1), F.col("t.end").cast("int")).alias("text"),
        F.col("t.start").alias("loss_start"), F.col("t.end").alias("loss_end"),
    )


def parse_turns(formatted: Column) -> Column:
    """The turns (role, text) back from a formatted conversation."""
    turns = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda t: t != "")
    bodies = F.transform(turns, lambda t: F.substring(t, len(START) + 1, 2**31 - 1))
    return F.transform(bodies, lambda b: F.struct(
        _unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
        unescape(b.substr(F.length(F.substring_index(b, "\n", 1)) + 2, F.length(b))).alias("text"),
    ))


def loss_text(example: Column, start: Column, end: Column) -> Column:
    """What is under the loss mask of an example, unescaped."""
    return unescape(example.substr((start + 1).cast("int"), (end - start).cast("int")))


def report(turns: DataFrame) -> DataFrame:
    """Digests of every conversation, read back from its formatted text and its examples."""
    formatted = format_conversations(turns)
    read = formatted.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), parse_turns(F.col("formatted")).alias("turns"))
    whole = read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        "formatted_chars",
    )
    parts = examples(formatted).select(
        "conv_id", "turn", loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("reply")
    )
    replies = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "reply"))).alias("replies"))
    loss = replies.select(
        F.col("conv_id").alias("__conv"), F.array_join("replies.reply", "").alias("loss"), F.size("replies").cast("long").alias("n_examples")
    )
    joined = whole.join(loss, whole["conv_id"].eqNullSafe(loss["__conv"]), "left")
    text = F.coalesce("loss", F.lit(""))
    return joined.select(
        "conv_id", "n_turns", "turns_sha256", F.length(text).cast("long").alias("loss_chars"),
        F.sha2(text.cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
        F.coalesce("n_examples", F.lit(0)).cast("long").alias("n_examples"),
    )
