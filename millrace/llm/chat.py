"""Chat formatting by prefix-target expansion: every assistant turn is an example of its own.

A turn is written as ``<|im_start|>role``, a line end, the text, ``<|im_end|>`` and a line end. The context of an
example is everything before its assistant turn, and only that turn's text is trainable. ``format_turns`` writes each
turn once, with its place in the conversation, and ``examples`` makes all examples with their full contexts from that.
A conversation is cut into slices of ``SLICE`` characters, and an example has a row for each slice that it reaches, so
that no row grows with the conversation; the rows of all its examples grow with the square of its length.

Inside a text, control strings are escaped: every ``<|``, with any backslashes between the two, gets one backslash
more. Inside a role, backslashes and line ends are escaped as well. Both ways back are exact.

Turns go by number; equal numbers by role, then text; null numbers first. Null role or text counts as empty. Rows with
a null conversation id make one conversation. Only rows of role ``assistant`` are targets.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import with_small_batches

START, END = "<|im_start|>", "<|im_end|>"
TARGET = "assistant"
#: Characters of a conversation in one row of an example.
SLICE = 1 << 16
#: Slices that meet the targets of their conversation together.
BLOCK = 4
#: Shape of a segment, to read it back.
SEGMENT = re.compile(rf"{re.escape(START)}([^\n]*)\n(.*){re.escape(END)}\n", re.DOTALL)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_text(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape_text(role))


def format_turns(turns: DataFrame) -> DataFrame:
    """Segments of all conversations: (conv_id, place, segment, start, loss_start, loss_end).

    ``start`` is the place of the segment's first character in its conversation. ``loss_start`` and ``loss_end`` are
    the bounds of the trainable characters, null for turns that are no target. The example of a target is the
    conversation's text from 0 to ``loss_end``, and everything before ``loss_start`` is its context.
    """
    with_small_batches(turns.sparkSession)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    front = F.concat(F.lit(START), escape_role(role), F.lit("\n"))
    body = escape(text)
    rows = turns.select(
        "conv_id",
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.concat(front, body, F.lit(END + "\n")).alias("segment"),
        F.when(role == TARGET, F.length(front)).alias("loss_from"),
        F.length(body).alias("body"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("role", "text", "turn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _place(batches)

    return ordered.mapInArrow(run, "conv_id long, place long, segment string, start long, loss_start long, loss_end long")


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running places of segments; only the counters of one conversation are held."""
    conv, place, at = _NONE, 0, 0
    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "segment", "loss_from", "body")]
        for conv_id, segment, front, body in zip(*columns, strict=True):
            if conv_id != conv:
                conv, place, at = conv_id, 0, 0
            loss = (None, None) if front is None else (at + front, at + front + body)
            out.append((conv_id, place, segment, at, *loss))
            place += 1
            at += len(segment)
        if out:
            a, b, c, d, e, f = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string())] + [pa.array(x, pa.int64()) for x in (d, e, f)],
                ["conv_id", "place", "segment", "start", "loss_start", "loss_end"],
            )


#: No conversation yet; differs from every id and from null.
_NONE = "none"


def spell_out(segments: DataFrame, targets: DataFrame) -> DataFrame:
    """Full examples of the targets (conv_id, place): (conv_id, place, context, reply).

    Grows with the square of a conversation's length if all its targets are asked for.
    """
    asked = targets.select(F.col("conv_id").alias("c"), F.col("place").alias("target"))
    pairs = segments.join(asked, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("place") <= F.col("target")))
    parts = F.array_sort(F.collect_list(F.struct("place", "segment")))
    joined = pairs.groupBy("c", "target").agg(parts.alias("p"), F.max(F.struct("place", "loss_start", "loss_end")).alias("t"))
    text = F.array_join(F.transform("p", lambda x: x["segment"]), "")
    whole = joined.select("c", "target", text.alias("all"), "t.loss_start", "t.loss_end")
    return whole.select(
        F.col("c").alias("conv_id"),
        F.col("target").alias("place"),
        F.expr("substring(all, 1, loss_start)").alias("context"),
        F.expr("substring(all, loss_start + 1, loss_end - loss_start)").alias("reply"),
    )


def examples(segments: DataFrame) -> DataFrame:
    """All examples, one for each target: (conv_id, place, slice, context, reply).

    The context of an example is that of its slices one after the other, and so is its reply. Examples of no more than
    ``SLICE`` characters are one row.
    """
    size, end = F.length("segment"), F.col("start") + F.length("segment")
    cut = segments.select("conv_id", "start", "segment", F.explode(F.sequence(F.floor(F.col("start") / SLICE), F.floor((end - 1) / SLICE))).alias("slice"))
    skipped = F.greatest(F.col("slice") * SLICE - F.col("start"), F.lit(0))
    taken = F.least((F.col("slice") + 1) * SLICE - F.col("start"), size) - skipped
    parts = cut.select("conv_id", "slice", F.struct("start", F.substr("segment", (skipped + 1).cast("int"), taken.cast("int")).alias("text")).alias("part"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda x: x["text"]), "")
    slices = parts.groupBy("conv_id", "slice").agg(joined.alias("text"))
    # Slices meet targets block by block, so that the square of a long conversation spreads over tasks.
    slices = slices.withColumn("block", F.floor(F.col("slice") / BLOCK))
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("loss_end") - 1) / (SLICE * BLOCK))))
    targets = segments.filter("loss_start is not null").select(F.col("conv_id").alias("c"), "place", "loss_start", "loss_end", blocks.alias("b"))
    begin = F.col("slice") * SLICE
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    pairs = slices.join(targets, same & (begin < F.col("loss_end")))
    front = F.least(F.greatest(F.col("loss_start") - begin, F.lit(0)), F.lit(SLICE)).cast("int")
    back = F.least(F.col("loss_end") - begin, F.lit(SLICE)).cast("int")
    return pairs.select(
        "conv_id",
        "place",
        "slice",
        F.substr("text", F.lit(1), front).alias("context"),
        F.substr("text", front + 1, back - front).alias("reply"),
    )


def read_back(segments: DataFrame, made: DataFrame | None = None) -> DataFrame:
    """What is written, per conversation: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).

    Roles and texts are parsed from the segments, the trainable text comes from the replies of the examples ``made``
    (those of the segments where none are given), and formatted_chars counts the characters of all examples. A digest
    runs over the rows of a conversation in order, so it is one stream, of which one batch at a time is held.
    """
    made = examples(segments) if made is None else made

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _digest(batches)

    def replies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _digest_replies(batches)

    ordered = segments.select("conv_id", "place", "segment").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    said = ordered.mapInArrow(turns, "conv_id long, n_turns long, turns_sha256 string")
    rows = made.select("conv_id", "place", "slice", "reply", (F.length("context") + F.length("reply")).cast("long").alias("chars"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "place", "slice")
    learned = ordered.mapInArrow(replies, "c long, loss_chars long, loss_sha256 string, formatted_chars long")
    return said.join(learned, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.coalesce("loss_chars", F.lit(0)).alias("loss_chars"),
        F.coalesce("loss_sha256", F.lit(hashlib.sha256().hexdigest())).alias("loss_sha256"),
        F.coalesce("formatted_chars", F.lit(0)).alias("formatted_chars"),
    )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, state = _NONE, None

    def done() -> dict:
        return {"conv_id": conv, "n_turns": state["n"], "turns_sha256": state["turns"].hexdigest()}

    for batch in batches:
        out = []
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "segment")]
        for conv_id, segment in zip(*columns, strict=True):
            if conv_id != conv:
                if state:
                    out.append(done())
                conv, state = conv_id, {"turns": hashlib.sha256(), "n": 0}
            parsed = SEGMENT.fullmatch(segment)
            state["turns"].update(f"{unescape_role(parsed[1])}\n{unescape_text(parsed[2])}\n".encode())
            state["n"] += 1
        if out:
            yield pa.RecordBatch.from_pylist(out, TURNS)
    if state:
        yield pa.RecordBatch.from_pylist([done()], TURNS)


#: What may be the begin of an escaped string that the next slice goes on with.
OPEN = re.compile(r"<\\*\Z")


def _digest_replies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, place, state = _NONE, None, None

    def add(text: str) -> None:
        text = unescape_text(text)
        state["loss"].update(text.encode())
        state["loss_chars"] += len(text)

    def done() -> dict:
        add(state["open"])
        return {"c": conv, "loss_chars": state["loss_chars"], "loss_sha256": state["loss"].hexdigest(), "formatted_chars": state["chars"]}

    for batch in batches:
        out = []
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "place", "reply", "chars")]
        for conv_id, at, reply, chars in zip(*columns, strict=True):
            if conv_id != conv:
                if state:
                    out.append(done())
                conv, place, state = conv_id, at, {"loss": hashlib.sha256(), "loss_chars": 0, "chars": 0, "open": ""}
            elif at != place:
                add(state["open"])
                place, state["open"] = at, ""
            state["chars"] += chars
            text = state["open"] + reply
            cut = found.start() if (found := OPEN.search(text)) else len(text)
            add(text[:cut])
            state["open"] = text[cut:]
        if out:
            yield pa.RecordBatch.from_pylist(out, REPLIES)
    if state:
        yield pa.RecordBatch.from_pylist([done()], REPLIES)


TURNS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string())])
REPLIES = pa.schema([("c", pa.int64()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
