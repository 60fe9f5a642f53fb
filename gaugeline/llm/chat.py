"""Chat formatting at token level.

Template: `<s>` opens a conversation. A user turn is `[INST]text[/INST]`, an assistant turn is
`text</s>`, any other role is `[ROLE]role[/ROLE]text</s>`. Control strings exist as reserved ids above the
vocabulary only: every text segment is encoded on its own and the ids are spliced between, so
no text can form a control id. Control strings that occur inside texts are escaped too,
so that the rendered form can be parsed as well: a backslash is doubled, and a control string
gets a backslash and a hyphen after its first character.

The loss mask is a running sum of +1 where an assistant text begins and -1 where it ends (after its
`</s>` if `learn_end`). Turns are rows with their token offset in the conversation, a sum over
the turns before; a conversation is read back as a stream in turn order, so neither a long one nor a hot
one is ever held whole.

Defined cases: null texts and roles are empty; turns that share a number are ordered by role and text; a null
conversation id is one conversation; repeated rows are separate turns; an empty table gives
an empty result; further columns are left alone and not returned.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import importable
from .bytebpe import default_path, encoder
from .common import named, text_or_empty
from .rows import by_batch

# The control strings of the template, in the order of their reserved ids.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]"]
OPEN, END, USER, USER_END, ROLE, ROLE_END = range(len(CONTROLS))
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\-" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\([\\-])", lambda m: "\\" if m[1] == "\\" else "", text)


def turn_ids(role: str, pieces: list[np.ndarray], base: int, opens: bool, learn_end: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids and loss mask of one turn; `pieces` are the encoded role and text."""
    name, text = pieces
    def control(n: int) -> list[int]:
        return [base + n]
    start = control(OPEN) if opens else []
    if role == "user":
        parts, learned = [start + control(USER), text, control(USER_END)], False
    elif role == "assistant":
        parts, learned = [start, text, control(END)], True
    else:
        parts, learned = [start + control(ROLE), name, control(ROLE_END), text, control(END)], False
    ids = np.concatenate([np.asarray(p, np.uint16) for p in parts])
    steps = np.zeros(len(ids) + 1, np.int8)
    if learned:
        steps[len(start)] += 1
        steps[len(start) + len(text) + (1 if learn_end else 0)] -= 1
    return ids, np.cumsum(steps[:-1]).astype(np.uint8)


def format_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    tokenizer: str | None = None, learn_end: bool = False,
) -> DataFrame:
    """Per turn: `conv, place, start, n_ids, ids, mask` (16-bit ids and a byte mask, as binary)."""
    path = tokenizer or default_path()
    rows = turns.select(named(conv).cast("long").alias("conv"), named(turn).cast("long").alias("turn"),
                        text_or_empty(role).alias("role"), text_or_empty(text).alias("text"))
    within = Window.partitionBy("conv").orderBy("turn", "role", "text")
    rows = rows.withColumn("place", F.row_number().over(within).cast("long") - 1)

    def make(batch: dict[str, list]) -> dict[str, list]:
        tool = encoder(path)
        base = tool.tokenizer.get_vocab_size()
        pieces = [np.frombuffer(b, "<u2") for b in tool.encode([escape(t) for pair in zip(batch["role"], batch["text"]) for t in pair])]
        made = [turn_ids(r, pieces[2 * n:2 * n + 2], base, place == 0, learn_end)
                for n, (r, place) in enumerate(zip(batch["role"], batch["place"]))]
        return {"conv": batch["conv"], "place": batch["place"], "n_ids": [len(i) for i, _ in made],
                "ids": [i.astype("<u2").tobytes() for i, _ in made], "mask": [m.tobytes() for _, m in made]}
    formatted = by_batch(rows, make, "conv long, place long, n_ids long, ids binary, mask binary")
    before = Window.partitionBy("conv").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return formatted.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def parsed_turns(ids: np.ndarray, base: int, decode) -> Iterator[tuple[str, str]]:
    """`(role, text)` of whole turns, from ids alone."""
    role, text, at = "assistant", "", 0
    marks = [*np.flatnonzero(ids >= base), len(ids)]
    for mark in marks:
        if mark > at:
            text = unescape(decode(ids[at:mark]))
        at = mark + 1
        if mark == len(ids):
            break
        kind = int(ids[mark]) - base
        if kind == USER:
            role, text = "user", ""
        elif kind == ROLE_END:
            role, text = text, ""
        elif kind in (END, USER_END):
            yield role, text
            role, text = "assistant", ""


def rendered(ids: np.ndarray, base: int, decode) -> str:
    """The formatted text: control ids as their strings, texts escaped."""
    out, at = [], 0
    for mark in np.flatnonzero(ids >= base):
        out += [decode(ids[at:mark]) if mark > at else "", CONTROLS[int(ids[mark]) - base]]
        at = mark + 1
    return "".join(out) + (decode(ids[at:]) if at < len(ids) else "")


def read_back(formatted: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Per conversation, from ids and mask alone: number and digest of the turns, the text under the mask, the rendered length."""
    importable(formatted.sparkSession)
    path = tokenizer or default_path()
    ordered = formatted.select("conv", "place", "ids", "mask").repartition("conv").sortWithinPartitions("conv", "place")
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, started = encoder(path), False
        base = tool.tokenizer.get_vocab_size()
        conv, counts, digests, done = None, [0, 0, 0], [], []

        def close() -> None:
            done.append((conv, counts[0], digests[0].hexdigest(), counts[1], digests[1].hexdigest(), counts[2]))

        def flushed() -> pa.RecordBatch:
            columns = zip(*done) if done else [[] for _ in schema]
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            done.clear()
            return made
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                for row in batch.slice(at, 500).to_pylist():
                    if not started or row["conv"] != conv:
                        if started:
                            close()
                        conv, counts, digests, started = row["conv"], [0, 0, 0], [hashlib.sha256(), hashlib.sha256()], True
                    ids, mask = np.frombuffer(row["ids"], "<u2"), np.frombuffer(row["mask"], np.uint8)
                    for role, text in parsed_turns(ids, base, tool.decode):
                        counts[0] += 1
                        digests[0].update(f"{role}\n{text}\n".encode())
                    learned = ids[(mask > 0) & (ids < base)]
                    if len(learned):
                        text = unescape(tool.decode(learned))
                        counts[1] += len(text)
                        digests[1].update(text.encode())
                    counts[2] += len(rendered(ids, base, tool.decode))
                yield flushed()
        if started:
            close()
        yield flushed()
    return ordered.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
