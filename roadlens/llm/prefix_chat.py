r"""Chat formatting by prefix-target expansion (operator 13).

Every turn of the trained role becomes an example of its own: all turns before
it are the context, and its text alone is trainable. A conversation that does
not end with the trained role has one more example, untrained, with all its
turns, so no turn is lost.

``format_conversations`` formats every turn and places it in the stream of its
conversation; an example is a length of that stream with a loss span:

    example k = the stream up to ``end``; loss on [``loss_start``, ``loss_end``)

``expanded`` writes every example out, context and target, and ``digests`` reads
conversations back from these texts alone. Written examples grow with the square
of a conversation's turns, as the method asks; an example is kept in pieces of
``RUN`` turns, so no row, group or task holds more of a long one. ``example_texts``
gives the whole texts of the examples that a job wants.

A turn is ``start role middle text end``. Control strings (the template's own
and those of other common templates) inside roles and texts get a backslash
after their first character, after every backslash has been doubled; this is
undone exactly by ``unescaped``.

Positions and offsets come from two levels of sums, over blocks of ``BLOCK``
turn numbers and inside them, so a conversation that holds a third of all rows
is spread over its blocks. DataFrame functions only.

Defined cases: null text and null role are empty strings (a null role is never
trained); turns are ordered by ``turn``, nulls first, ties by the formatted
turn, so repeated rows stay and their order is fixed; a null ``conv_id`` is one
conversation; an empty table gives an empty stream; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.common import written

BLOCK = 256
#: Turns in a piece of an example.
RUN = 256


@dataclass(frozen=True)
class Template:
    """Marks around a turn, the role that is trained, and further strings to escape."""

    start: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    trained: str = "assistant"
    others: tuple[str, ...] = ("<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

    def __post_init__(self) -> None:
        if any(not s or s.startswith("\\") for s in self.controls):
            raise ValueError("control strings are not empty and do not begin with a backslash")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.start, self.middle, self.end, *self.others)

    def rests(self) -> dict[str, str]:
        """First character -> pattern of what may follow it in a control string."""
        out: dict[str, list[str]] = {}
        for s in self.controls:
            out.setdefault(s[0], []).append(re.escape(s[1:]))
        return {c: "|".join(sorted(rest)) for c, rest in sorted(out.items())}


CHAT = Template()


def escaped(text: Column, template: Template = CHAT) -> Column:
    """The text without control strings."""
    heads = "|".join(f"{re.escape(c)}(?={rest})" for c, rest in template.rests().items())
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"({heads})", r"$1\\")


def unescaped(text: Column, template: Template = CHAT) -> Column:
    """The inverse of ``escaped``."""
    heads = "|".join(rf"{re.escape(c)}(?=\\(?:{rest}))" for c, rest in template.rests().items())
    return F.replace(F.regexp_replace(text, rf"({heads})\\", "$1"), F.lit("\\\\"), F.lit("\\"))


def format_conversations(turns: DataFrame, template: Template = CHAT) -> DataFrame:
    """The written stream: conv_id, position, segment, start, end, last, of, example, loss_start, loss_end.

    One row per turn. ``start`` and ``end`` are its place in the stream of its
    conversation in code points. ``example`` numbers the trained turns from 1
    and is null elsewhere, as are ``loss_start`` and ``loss_end``. ``last`` marks
    the final turn of a conversation, which has ``of`` turns.
    """
    role = escaped(F.coalesce(F.col("role"), F.lit("")), template)
    text = escaped(F.coalesce(F.col("text"), F.lit("")), template)
    rows = turns.select(
        F.struct("conv_id", F.floor(F.col("turn") / BLOCK).alias("block")).alias("key"),  # equal also where a part is null
        "turn",
        F.concat(F.lit(template.start), role, F.lit(template.middle), text, F.lit(template.end)).alias("segment"),
        F.coalesce(F.col("role") == template.trained, F.lit(False)).alias("trained"),
        (F.length(role) + len(template.start) + len(template.middle)).cast("long").alias("before"),
    )
    rows = rows.withColumn("chars", F.length("segment").cast("long"))

    sums = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("chars").alias("chars"), F.sum(F.col("trained").cast("long")).alias("examples")
    )
    conversation = Window.partitionBy("key.conv_id")
    earlier = conversation.orderBy(F.asc_nulls_first("key.block"))
    until = earlier.rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "key",
        *[F.coalesce(F.sum(x).over(until), F.lit(0)).alias(f"{x}_before") for x in ("rows", "chars", "examples")],
        F.sum("rows").over(conversation).alias("of"),
    )
    inside = Window.partitionBy("key").orderBy(F.asc_nulls_first("turn"), "segment")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.select(
        "*",
        F.row_number().over(inside).alias("nth"),
        F.sum("chars").over(so_far).alias("chars_here"),
        F.sum(F.col("trained").cast("long")).over(so_far).alias("examples_here"),
    ).join(offsets, "key")
    position = F.col("rows_before") + F.col("nth")
    end = F.col("chars_before") + F.col("chars_here")
    start = end - F.col("chars")
    trained = F.col("trained")
    return written(
        placed.select(
            F.col("key.conv_id").alias("conv_id"),
            position.alias("position"),
            "segment",
            start.alias("start"),
            end.alias("end"),
            (position == F.col("of")).alias("last"),
            "of",
            F.when(trained, F.col("examples_before") + F.col("examples_here")).alias("example"),
            F.when(trained, start + F.col("before")).alias("loss_start"),
            F.when(trained, end - len(template.end)).alias("loss_end"),
        ),
        "chat-stream",
    )


def examples(stream: DataFrame) -> DataFrame:
    """One row per example: conv_id, example (null: the untrained rest), turns, chars, loss_start, loss_end."""
    return stream.where(F.col("example").isNotNull() | F.col("last")).select(
        "conv_id", "example", F.col("position").alias("turns"), F.col("end").alias("chars"), "loss_start", "loss_end"
    )


def example_texts(wanted: DataFrame, stream: DataFrame) -> DataFrame:
    """``wanted`` rows of ``examples`` with their whole ``text``; the output is as large as those texts."""
    parts = stream.select(F.col("conv_id").alias("c"), "position", "segment")
    key = ["conv_id", "example", "turns", "chars", "loss_start", "loss_end"]
    joined = wanted.select(*key).join(parts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("position") <= F.col("turns")))
    whole = joined.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("position", "segment"))).alias("parts"))
    return whole.select(*key, F.array_join(F.col("parts.segment"), "").alias("text"))


def read_turns(stream: DataFrame, template: Template = CHAT) -> DataFrame:
    """The stream's rows parsed again: its columns, role, text, and ``loss_text``, the text under the loss mask (null: none)."""
    body = F.substring("segment", F.lit(len(template.start) + 1), F.length("segment") - len(template.start) - len(template.end))
    role = F.substring_index(body, template.middle, 1)
    text = F.substring(body, F.length(role) + len(template.middle) + 1, F.length(body))
    under = F.substring("segment", (F.col("loss_start") - F.col("start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    return stream.select("*", unescaped(role, template).alias("role"), unescaped(text, template).alias("text"), unescaped(under, template).alias("loss_text"))


def expanded(stream: DataFrame) -> DataFrame:
    """The written examples: conv_id, example (null: the untrained rest), turns, whole, piece, start, text, loss_start, loss_end.

    One row per piece of an example: ``text`` has the turns of one run of ``RUN``
    and begins at code point ``start``; the pieces in order are the context and,
    last, the target. The loss span is told on the piece that holds it, in code
    points of the example; ``whole`` marks the example that has all turns.
    """
    key = ["conv_id", "example", "turns", "whole", "piece", "start", "text", "loss_start", "loss_end"]
    run = F.floor((F.col("position") - 1) / RUN)
    part = F.struct("position", "segment", "example", "last", "loss_start", "loss_end")
    runs = stream.groupBy("conv_id", run.alias("piece")).agg(F.min("start").alias("start"), F.array_sort(F.collect_list(part)).alias("parts"))
    targets = F.filter("parts", lambda t: t["example"].isNotNull() | t["last"])
    ends = runs.select("conv_id", "piece", "start", F.col("parts.segment").alias("segments"), F.explode(targets).alias("t"))
    upto = (F.col("t.position") - F.col("piece") * RUN).cast("int")
    last_pieces = ends.select(
        "conv_id", "piece", "start", F.array_join(F.slice("segments", F.lit(1), upto), "").alias("text"),
        F.col("t.example").alias("example"), F.col("t.position").alias("turns"), F.col("t.last").alias("whole"), "t.loss_start", "t.loss_end",
    )

    # contexts that reach back beyond the target's run
    long = stream.where(F.col("of") > RUN)
    piece = F.struct("position", "segment")
    full = long.groupBy(F.struct("conv_id", run.alias("piece")).alias("run")).agg(
        F.min("start").alias("start"), F.array_join(F.array_sort(F.collect_list(piece))["segment"], "").alias("text")
    )
    later = long.where((F.col("position") > RUN) & (F.col("example").isNotNull() | F.col("last"))).select(
        "conv_id", "example", F.col("position").alias("turns"), F.col("last").alias("whole"), F.explode(F.sequence(F.lit(0).cast("long"), run - 1)).alias("piece")
    )
    contexts = later.withColumn("run", F.struct("conv_id", "piece")).join(full, "run")
    none = F.lit(None).cast("long")
    contexts = contexts.withColumns({"loss_start": none, "loss_end": none})
    return written(last_pieces.select(*key).unionByName(contexts.select(*key)), "chat-examples", compression="zstd")


def read_examples(pieces: DataFrame, template: Template = CHAT, parsed: Column | None = None) -> DataFrame:
    """Written examples parsed by their marks: the rows with ``read``, an array of role and text, and ``loss_text`` (null: none).

    ``parsed``: the rows whose turns are asked for (default all); ``read`` is null elsewhere.
    """
    for mark in (template.middle, template.end):
        if any(mark.startswith(mark[k:]) for k in range(1, len(mark))):
            raise ValueError(f"{mark!r} overlaps itself and cannot be told from a text before it")

    def turn(formatted: Column) -> Column:
        body = F.substring(formatted, F.lit(len(template.start) + 1), F.length(formatted))
        role = F.substring_index(body, template.middle, 1)
        text = F.substring(body, F.length(role) + len(template.middle) + 1, F.length(body))
        return F.struct(unescaped(role, template).alias("role"), unescaped(text, template).alias("text"))

    formatted = F.split("text", re.escape(template.end), -1)  # nothing stands after the last mark
    under = F.substring("text", (F.col("loss_start") - F.col("start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    return pieces.select(
        "*",
        F.when(F.lit(True) if parsed is None else parsed, F.transform(F.slice(formatted, F.lit(1), F.size(formatted) - 1), turn)).alias("read"),
        unescaped(under, template).alias("loss_text"),
    )


def digests(stream: DataFrame, template: Template = CHAT) -> DataFrame:
    """Per conversation, read back from its expanded examples: counts, digests of its turns and of its loss text, and the length of its examples.

    Turns come from the example that has them all, loss texts from the targets,
    lengths from every example. A digest covers one string, so a conversation's
    texts meet in one row here; formatting and expansion need no such row.
    """
    said = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = read_examples(expanded(stream), template, F.col("whole")).select(
        "conv_id",
        F.when(F.col("whole"), F.struct("piece", said.alias("turns"), F.size("read").cast("long").alias("n"))).alias("turns"),
        F.when(F.col("loss_text").isNotNull(), F.struct("example", "loss_text")).alias("loss"),
        F.length("text").cast("long").alias("chars"),
    )
    whole = back.groupBy("conv_id").agg(
        F.array_sort(F.collect_list("turns")).alias("turns"), F.array_sort(F.collect_list("loss")).alias("losses"), F.sum("chars").alias("formatted_chars")
    )
    turns, loss = F.array_join("turns.turns", ""), F.array_join("losses.loss_text", "")
    return whole.select(
        "conv_id",
        F.aggregate("turns.n", F.lit(0).cast("long"), lambda a, n: a + n).alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
