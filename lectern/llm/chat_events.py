"""Conversations rebuilt from event logs, then rendered.

A log has a row per event: (conv_id, seq, part, kind, message, role, text). In the order of seq, then part, the events of a conversation
are folded:
* `start` opens a message of a role at the end; a second one replaces it in its place;
* `delta` appends text to a message, opened by role if it is not there yet;
* `edit` replaces a message's text, and its role if one is given;
* `regenerate` empties the message and drops all that follow it;
* `delete` drops the message.
Events for a message that isn't there (and give no role) change nothing.

Logs are partitioned by conversation and sorted inside the partitions; a task folds one conversation at a time, in a stream, and
emits a row per final message, so no conversation is held as a group beyond its own final messages.

Rendering: a turn is OPEN, role (on one line), newline, text, CLOSE, newline. Inside roles and texts `<` becomes `<` and
ESCAPE if `|` or ESCAPE follows, so neither mark can occur there, and removing the first ESCAPE after each `<` gives the text back.
Loss spans cover assistant texts.

Defined results: null texts are empty, null roles are empty strings; a null conv_id is a conversation; ties in (seq, part) go by
kind (`start` first), role, text and message; repeated rows are events of their own; an empty log has no messages.
"""
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.frames import pick

OPEN, CLOSE, ESCAPE = "<|im_start|>", "<|im_end|>", "\\"
_EVENT = ("conv_id", "seq", "part", "kind", "message", "role", "text")
_ORDER = {"start": 0, "regenerate": 1, "edit": 2, "delta": 3, "delete": 4}


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(?=\\*\|)", r"<\\")


def escaped_role(role: Column) -> Column:
    """On one line: backslashes are doubled, line feeds become a backslash and n."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape(text: str) -> str:
    return re.sub(r"<\\(?=\\*\|)", "<", text)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _fold_task(kind: str):
    def messages(events) -> Iterator[tuple[str, str]]:
        """role and text of the final messages of one conversation"""
        place: dict = {}
        for name, message, role, text in events:
            own = place.get(message)
            if name == "start":
                place[message] = [role or "", [text or ""]]
            elif name == "delta":
                if own is None and role is not None:
                    own = place.setdefault(message, [role, []])
                if own is not None:
                    own[1].append(text or "")
            elif own is not None and name == "edit":
                own[:] = [own[0] if role is None else role, [text or ""]]
            elif own is not None and name == "regenerate":
                own[1] = []
                later = False
                for m in list(place):
                    if later:
                        del place[m]
                    later = later or m == message
            elif own is not None and name == "delete":
                del place[message]
        for role, texts in place.values():
            yield role, "".join(texts)

    def conversations(batches):
        """(conv_id, its events), streamed"""
        current, waiting = None, []
        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            for conv, name, message, role, text in zip(columns[0], *columns[3:]):
                if current is not None and conv != current[0]:
                    yield current[0], waiting
                    waiting = []
                current = (conv,)
                waiting.append((name, message, role, text))
        if current is not None:
            yield current[0], waiting

    def task(batches):
        for conv, events in conversations(batches):
            final = list(messages(events))
            for lo in range(0, len(final), 1000):
                part = final[lo:lo + 1000]
                yield pa.RecordBatch.from_arrays([pa.array([conv] * len(part), kind), pa.array(range(lo, lo + len(part)), pa.int64()),
                                                  pa.array([r for r, _ in part], pa.string()), pa.array([t for _, t in part], pa.string())],
                                                 names=["conv_id", "turn", "role", "text"])
    return task


def final_messages(events: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): what the log leaves, turns from 0."""
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in _ORDER.items()], F.lit(9))
    rows = pick(events, *_EVENT).withColumn("conv_id", F.col("conv_id").cast("bigint")).withColumn("role", F.col("role").cast("string"))
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "part", rank, "role", "text", "message")
            .mapInArrow(_fold_task(pa.int64()), "conv_id bigint, turn bigint, role string, text string"))


def rendered(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, chunk, mask): a conversation's formatted text is its chunks in the order of turns; mask holds the spans
    (start, end) of the chunk, in code points, that count for the loss."""
    role, text = escaped_role(F.coalesce("role", F.lit(""))), escaped(F.coalesce("text", F.lit("")))
    start = F.length(F.lit(OPEN)) + F.length(role) + 1
    return messages.select("conv_id", "turn", F.concat(F.lit(OPEN), role, F.lit("\n"), text, F.lit(CLOSE + "\n")).alias("chunk"),
                           F.when(F.col("role") == "assistant", F.array(F.struct(start.alias("start"), (start + F.length(text)).alias("end"))))
                           .otherwise(F.array().cast("array<struct<start:int,end:int>>")).alias("mask"))


def _read_task(batches):
    """Rendered rows in order, read back: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)."""
    turn = re.compile(re.escape(OPEN) + r"([^\n]*)\n(.*?)" + re.escape(CLOSE) + r"\n", re.S)
    state = None

    def done():
        conv, n, turns, loss_chars, loss, chars = state
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], pa.int64()), pa.array([n], pa.int64()), pa.array([turns.hexdigest()]), pa.array([loss_chars], pa.int64()),
             pa.array([loss.hexdigest()]), pa.array([chars], pa.int64())],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    for b in batches:
        for conv, chunk, mask in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
            if state is None or state[0] != conv:
                if state is not None:
                    yield done()
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for m in turn.finditer(chunk):
                state[1] += 1
                state[2].update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
            for span in mask:
                text = unescape(chunk[span["start"]:span["end"]])
                state[3] += len(text)
                state[4].update(text.encode())
            state[5] += len(chunk)
    if state is not None:
        yield done()


def read_back(rendered_rows: DataFrame) -> DataFrame:
    """Digests of every conversation, taken from its formatted text alone."""
    return (rendered_rows.select("conv_id", "turn", "chunk", "mask").repartition("conv_id").sortWithinPartitions("conv_id", "turn")
            .mapInArrow(_read_task, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"))
