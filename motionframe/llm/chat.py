"""Chat formatting with a grammar round trip.

A turn is rendered between control strings, and a deterministic parser reads it back. Where what it recovers is not the
turn, the text's control strings are escaped and the turn is rendered again, until both are identical:

    conversation = { turn }
    turn         = "<s>" body "</s>"
    body         = "[SYS]" text "[/SYS]" | "[INST]" text "[/INST]" | "[ROLE " name "]" text "[/ROLE]" | text

for system, user, any other role (its name percent-encoded) and assistant. A text has no control string in it. Escaping
adds a backslash behind the first character of each control string, also of those that have backslashes there already,
and reading takes one away, so it is reversible and texts that need none stay as they are. Turns are closed, so the
rendering of a conversation is that of its turns one after another, and is unambiguous where each turn is.

A conversation's turns are rendered where they stand, dealt by conversation, sorted and joined into examples of at most
`EXAMPLE_CHARS` (a longer turn is an example of its own), so no task holds a conversation, however long. The loss mask
are the spans of the assistants' texts in an example, as code points, end exclusive.

Turns come by turn, null first, then by role and text. Nulls: a null text is empty, a null role is the role "", a null
conv_id is a conversation. Repeated rows are repeated turns. Empty tables give no examples. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motionframe.llm.common import SPANS, ddl, map_rows

EXAMPLE_CHARS = 1 << 20
_LIKE = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|ROLE |/ROLE\])")
_TOKEN = re.compile(r"</?s>|\[/?INST\]|\[/?SYS\]|\[ROLE ([A-Za-z0-9_.~%-]*)\]|\[/ROLE\]")
_TAGS = {"[INST]": ("user", "[/INST]"), "[SYS]": ("system", "[/SYS]")}


def escape(text: str) -> str:
    return _LIKE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _LIKE.sub(lambda m: m[1] + m[2][1:] + m[3], text)


def parse(rendered: str) -> list[tuple[str, str, int, int]] | None:
    """(role, text, start, end of the text as it is rendered) of each turn, or None if it is no conversation."""
    out, tokens, at = [], list(_TOKEN.finditer(rendered)), 0
    k = 0

    def take(what: str | None = None) -> re.Match | None:
        nonlocal k
        if k < len(tokens) and (what is None or tokens[k][0] == what):
            k += 1
            return tokens[k - 1]
        return None

    while at < len(rendered):
        m = take("<s>")
        if m is None or m.start() != at:
            return None
        role, close, start = "assistant", None, m.end()
        if k < len(tokens) and tokens[k].start() == start and tokens[k][0] != "</s>":
            tag = take()
            role, close = _TAGS.get(tag[0], (None, None)) if tag[1] is None else (unquote(tag[1]), "[/ROLE]")
            if close is None:
                return None
            start = tag.end()
        m = end = take(close or "</s>")
        if m is None:
            return None
        if close:
            m = take("</s>")
            if m is None or m.start() != end.end():
                return None
        out.append((role, unescape(rendered[start : end.start()]), start, end.start()))
        at = m.end()
    return out


def render(role: str, text: str) -> tuple[str, int, int]:
    """(the turn, start and end of its text in it), such that parse() recovers role and text."""
    body = text
    for _ in range(2):
        if role == "assistant":
            made = f"<s>{body}</s>"
        elif role in ("user", "system"):
            tag = "INST" if role == "user" else "SYS"
            made = f"<s>[{tag}]{body}[/{tag}]</s>"
        else:
            made = f"<s>[ROLE {quote(role, safe='')}]{body}[/ROLE]</s>"
        got = parse(made)
        if got is not None and [x[:2] for x in got] == [(role, text)]:
            return made, got[0][2], got[0][3]
        body = escape(text)
    raise ValueError(f"no rendering of {role!r} is read back as it was")


def _by_conversation(df: DataFrame, order: list[str]) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", example_chars: int = EXAMPLE_CHARS) -> DataFrame:
    """conv_id, example (0, 1, ... in a conversation), formatted and loss."""
    source = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))

    def one(roles, texts):
        return zip(*(render(r, t) for r, t in zip(roles, texts))) if roles else ((), (), ())

    turns = map_rows(source, ["conv_id", "turn", "role", "text"], ["role", "text"], [("piece", pa.string()), ("start", pa.int64()), ("end", pa.int64())], lambda r, t: list(map(list, one(r, t))))
    fields = [("conv_id", pa.int64()), ("example", pa.int64()), ("formatted", pa.string()), ("loss", SPANS)]
    schema = pa.schema(fields)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        now: dict | None = None
        pieces: list[str] = []
        size = 0

        def close():
            if now is not None:
                done.append(now | {"formatted": "".join(pieces)})

        for batch in batches:
            for r in batch.to_pylist():
                new = now is None or now["conv_id"] != r["conv_id"]
                if new or size + len(r["piece"]) > example_chars:
                    close()
                    now, pieces, size = {"conv_id": r["conv_id"], "example": 0 if new else now["example"] + 1, "loss": []}, [], 0
                if r["role"] == "assistant":
                    now["loss"].append({"kind": "loss", "start": size + r["start"], "end": size + r["end"]})
                pieces.append(r["piece"])
                size += len(r["piece"])
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
                done = []
        close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)

    ordered = _by_conversation(turns, ["turn", "role", "text"]).select("conv_id", "role", "piece", "start", "end")
    return ordered.mapInArrow(join, ", ".join(f"`{c}` {ddl(t)}" for c, t in fields))


def read_back(examples: DataFrame) -> DataFrame:
    """Of each conversation, from its examples alone: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    fields = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = []
        now = None
        for batch in batches:
            for r in batch.to_pylist():
                if now is None or now[0] != r["conv_id"]:
                    rows += [now] if now else []
                    now = [r["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _, _ in parse(r["formatted"]):
                    now[1] += 1
                    now[2].update(f"{role}\n{text}\n".encode())
                for s in r["loss"]:
                    text = unescape(r["formatted"][s["start"] : s["end"]])
                    now[3] += len(text)
                    now[4].update(text.encode())
                now[5] += len(r["formatted"])
            if rows:
                yield _closed(rows, schema)
                rows = []
        if now:
            yield _closed([now], schema)

    return _by_conversation(examples, ["example"]).mapInArrow(run, ", ".join(f"`{c}` {ddl(t)}" for c, t in fields))


def _closed(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x.hexdigest() if hasattr(x, "hexdigest") else x for x in col], f.type) for col, f in zip(zip(*rows), schema)], schema=schema)
