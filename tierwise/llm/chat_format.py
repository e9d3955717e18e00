"""Chat formatting by prefix-target expansion.

Every assistant turn is the target of one training example whose context is all
preceding turns; only that reply is trainable. ``format_turns`` renders each turn and
writes it into every example that it is part of: an example is its rows in order, one a
turn, with the reply's span as the mask. ``expand`` puts an example's rows into one text.
The examples of a conversation grow with the square of its turns, by definition of the
method; its turns are dealt over all tasks before they are written out, row by row.

Template: ``[INST] text [/INST]`` (user), ``<<SYS>> text <</SYS>>`` (system),
`` text </s>`` (assistant), ``[ROLE name] text [/ROLE]`` (any other role). Control
strings inside texts are broken by a backslash after their first character and backslashes
are doubled; ``parse`` undoes both, so the text comes back as it was.

Defined results: null text = empty; null role = role "" ; turns are ordered by turn
(null first), then role, then text, so ties and repeated rows have one order; a null
conv_id is a conversation of its own; an empty table gives an empty one. Turns after the
last reply are in no example: they come once, with a null ``example``. A conversation is
streamed in order through one task row by row: its turns are never gathered.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierwise.llm.common import map_batches

# The template's marks.
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>> ", " <</SYS>>"), "assistant": (" ", " </s>")}
CONTROL = re.compile(r"\\|\[(?=/?(?:INST|ROLE))|<(?=</?SYS>>|/?s>)")
ESCAPED = re.compile(r"\\(.)", re.S)
ROLE_END = re.compile(r"\\.|\]", re.S)

TURNS_DDL = ("conv_id bigint, seq bigint, own bigint, examples bigint, target boolean, segment string, "
             "starts_at bigint, loss_start bigint, loss_end bigint, example_chars bigint")
DIGEST_DDL = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
              "loss_sha256 string, formatted_chars bigint, n_examples bigint")


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1], text)


def marks(role: str) -> tuple[str, str]:
    if role in MARKS:
        return MARKS[role]
    return "[ROLE " + escape(role).replace("]", "\\]") + "] ", " [/ROLE]"


def render(role: str, text: str) -> tuple[str, int, int]:
    """The segment of a turn and the span of its (escaped) text in it."""
    head, tail = marks(role)
    body = escape(text)
    return head + body + tail, len(head), len(head) + len(body)


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a rendered segment."""
    for role, (head, tail) in MARKS.items():
        if segment.startswith(head) and segment.endswith(tail) and len(segment) >= len(head) + len(tail):
            return role, unescape(segment[len(head):len(segment) - len(tail)])
    at = 6
    while (m := ROLE_END.search(segment, at))[0] != "]":
        at = m.end()
    return unescape(segment[6:m.start()]), unescape(segment[m.end() + 1:len(segment) - 8])


def in_order(df: DataFrame, *order) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def rendered(turns: DataFrame) -> DataFrame:
    """One row per turn: its segment, where it starts, the first example that holds it
    (``own``: the next reply's) and how many examples its conversation has."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text")).repartition("conv_id")
    whole = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("examples", F.count_if(F.col("role") == "assistant").over(whole))
    rows = rows.sortWithinPartitions("conv_id", "turn", "role", "text")

    def init():
        state = {"conv": object(), "seq": 0, "example": 0, "chars": 0}

        def step(cols):
            out = {c.split()[0]: [] for c in TURNS_DDL.split(", ")}
            for conv, role, text, examples in zip(cols["conv_id"], cols["role"], cols["text"], cols["examples"]):
                if conv != state["conv"]:
                    state.update(conv=conv, seq=0, example=0, chars=0)
                segment, a, b = render(role, text)
                target, start = role == "assistant", state["chars"]
                row = (conv, state["seq"], state["example"], examples, target, segment, start,
                       start + a if target else None, start + b if target else None,
                       start + len(segment) if target else None)
                for k, v in zip(out, row):
                    out[k].append(v)
                state["chars"] += len(segment)
                state["seq"] += 1
                state["example"] += target
            return out
        return step

    return map_batches(rows, init, TURNS_DDL)


def format_turns(turns: DataFrame) -> DataFrame:
    """The examples, one row per example and turn in it: an example is the segments of its rows
    in order of ``seq``. Its last row is the reply, the only trainable one, with the span
    of the reply's text in the example and the example's length. ``is_new``: no earlier
    example holds the turn. All offsets are code points."""
    rows = rendered(turns).repartition("conv_id", "seq")  # a long conversation is written out by all tasks
    held = F.when(F.col("own") < F.col("examples"), F.sequence("own", F.col("examples") - 1)).otherwise(
        F.array(F.lit(None).cast("bigint")))
    rows = rows.withColumn("example", F.explode(held))
    is_new = F.col("example").isNull() | (F.col("example") == F.col("own"))
    trainable = F.col("target") & is_new
    return rows.select(
        "conv_id", "example", "seq", is_new.alias("is_new"), trainable.alias("trainable"), "segment", "starts_at",
        *[F.when(trainable, F.col(c)).alias(c) for c in ("loss_start", "loss_end", "example_chars")])


def examples(formatted: DataFrame) -> DataFrame:
    """One row per example: the reply, its trainable span and the example's length."""
    return formatted.where("trainable").select(
        "conv_id", "example", F.col("seq").alias("target_seq"), F.col("segment").alias("target"),
        "loss_start", "loss_end", "example_chars")


def expand(formatted: DataFrame) -> DataFrame:
    """The examples, each as one text."""
    rows = F.array_sort(F.collect_list(F.struct("seq", "segment")))
    return formatted.where("example IS NOT NULL").groupBy("conv_id", "example").agg(
        F.concat_ws("", F.transform(rows, lambda r: r["segment"])).alias("text"),
        F.max("loss_start").alias("loss_start"), F.max("loss_end").alias("loss_end"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, what can be read from its examples: turns (each where it first
    appears), the text under the mask of every example, and over all rows of the examples their
    total length and how many have their mask within the reply."""
    masked = F.expr("trainable AND loss_start >= starts_at AND loss_end <= starts_at + length(segment)")
    chars = formatted.where("example IS NOT NULL").groupBy("conv_id").agg(
        F.sum(F.length("segment")).alias("chars"), F.count_if(masked).alias("n_examples"))
    turns = formatted.where("is_new").select("conv_id", "seq", "trainable", "segment", "starts_at", "loss_start", "loss_end")
    rows = in_order(turns.unionByName(chars, allowMissingColumns=True), "seq")  # the length (no seq) comes first

    def init():
        state = {"conv": object(), "n": 0}

        def close(out):
            if state["n"]:
                for k, v in zip(out, (state["conv"], state["n"], state["turns"].hexdigest(), state["chars"],
                                      state["loss"].hexdigest(), state["formatted"], state["examples"])):
                    out[k].append(v)

        def step(cols):
            out = {c.split()[0]: [] for c in DIGEST_DDL.split(", ")}
            for i, conv in enumerate(cols["conv_id"]):
                if conv != state["conv"]:
                    close(out)
                    state.update(conv=conv, n=0, turns=hashlib.sha256(), loss=hashlib.sha256(), chars=0,
                                 formatted=0, examples=0)
                if cols["seq"][i] is None:
                    state["formatted"] += cols["chars"][i]
                    state["examples"] += cols["n_examples"][i]
                    continue
                role, text = parse(cols["segment"][i])
                state["n"] += 1
                state["turns"].update(f"{role}\n{text}\n".encode())
                if cols["trainable"][i]:
                    at = cols["starts_at"][i]
                    loss = unescape(cols["segment"][i][cols["loss_start"][i] - at:cols["loss_end"][i] - at])
                    state["loss"].update(loss.encode())
                    state["chars"] += len(loss)
            return out

        def end():
            out = {c.split()[0]: [] for c in DIGEST_DDL.split(", ")}
            close(out)
            return out

        step.end = end
        return step

    return map_batches(rows, init, DIGEST_DDL)
