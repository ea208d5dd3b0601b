"""Chat formatting by incremental black-box rendering.

A template is any function from a list of messages to a string. Nothing is
assumed of its layout: the prefixes of a conversation are rendered one turn
longer each time, and what an output adds to the one before is that turn's
span. An output that does not begin with the one before is a template that
rewrites history; the turns at which it does are reported. Rendering the turn
once more with a placeholder as its text shows where in the span the text lies,
which gives the loss mask (assistant texts only).

Prefixes are rendered whole, so the work grows with the square of a
conversation's turns. A template that declares itself turn-wise (attribute
``turnwise``: its output is that of each turn alone, one after the other, as in
chatml) is rendered whole for the first ``WINDOW`` turns only; later turns are
rendered from the last turn of the window before on, as long as that turn
alone renders as it did there.

Rows are dealt by conversation and sorted by turn within each partition, and
tasks stream them, holding one conversation at a time: a conversation is one
ordered text with one digest, so it is the smallest unit.

Defined cases: null texts and roles count as empty; rows with the same turn
stand in order of role, then text; a null conv_id is a conversation like any
other; an empty table gives no rows; columns besides the four are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

Message = dict[str, str]
Template = Callable[[list[Message]], str]

START, END = "<|im_start|>", "<|im_end|>"
WINDOW = 32
HOLE = "\ue000"      # the placeholder text

SCHEMA = ("conv_id long, n_turns long, formatted string, spans array<struct<start:long,end:long>>, "
          "loss array<struct<start:long,end:long>>, rewritten array<long>")


def escape(text: str) -> str:
    """Text in which no control string ``<|`` is left; undone by unescape."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def chatml(messages: list[Message]) -> str:
    """The default template: one marked block for each turn."""
    return "".join(f"{START}{_role_out(m['role'])}\n{escape(m['content'])}{END}\n" for m in messages)


chatml.turnwise = True


def parse_chatml(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    found = re.findall(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", text, re.S)
    return [(_role_in(role), unescape(body)) for role, body in found]


def _shared(a: str, b: str) -> int:
    """Length of the longest common prefix, by bisection."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


def render(messages: list[Message], template: Template) -> tuple[str, list[tuple[int, int]], list[tuple[int, int]], list[int]]:
    """(formatted text, span of each turn, span of each assistant text, turns
    at which the template rewrote what it had given before)."""
    turnwise = getattr(template, "turnwise", False)
    settled, spans, texts, rewritten = [], [], [], []
    first, base, last = 0, 0, ""     # messages[first:] are rendered as last, which begins at base; before it stands settled
    for i, m in enumerate(messages):
        if turnwise and i and i % WINDOW == 0 and not rewritten:
            lo, hi = spans[i - 1][0] - base, spans[i - 1][1] - base
            if template(messages[i - 1:i]) == last[lo:hi]:
                settled.append(last[:lo])
                first, base, last = i - 1, base + lo, last[lo:hi]
        out = template(messages[first:i + 1])
        if out.startswith(last):
            at = len(last)
        else:
            rewritten.append(i)
            at = _shared(out, last)
        if rewritten and first:      # spans by whole prefixes from here on
            settled, first, base, out = [], 0, 0, template(messages[:i + 1])
            at = min(at, len(out))
        spans.append((base + at, base + len(out)))
        if m["role"] == "assistant":
            probe = template([*messages[first:i], {**m, "content": HOLE}])
            head = probe.rfind(HOLE)
            tail = len(probe) - head - len(HOLE)
            if head >= 0 and head + tail <= len(out):
                texts.append((base + head, base + len(out) - tail))
        last = out
    return "".join([*settled, last]), spans, texts, rewritten


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(k).to_pylist() for k in ("conv_id", "role", "text")), strict=True)


def format_chats(turns: DataFrame, template: Template = chatml) -> DataFrame:
    """Per conversation: conv_id, n_turns, formatted, spans, loss, rewritten."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, rows in groupby(_rows(batches), key=lambda r: r[0]):
            messages = [{"role": r[1] or "", "content": r[2] or ""} for r in rows]
            text, spans, loss, rewritten = render(messages, template)
            out.append({"conv_id": conv, "n_turns": len(messages), "formatted": text, "rewritten": rewritten,
                        "spans": [{"start": a, "end": b} for a, b in spans],
                        "loss": [{"start": a, "end": b} for a, b in loss]})
            if len(out) >= 500:
                yield pa.RecordBatch.from_pylist(out, schema=ARROW)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=ARROW)

    rows = turns.selectExpr("cast(conv_id AS long) conv_id", "cast(turn AS long) turn", "role", "text")
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(run, SCHEMA)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
ARROW = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
                   ("spans", _SPANS), ("loss", _SPANS), ("rewritten", pa.list_(pa.int64()))])


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations."""
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long, n_rewritten long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                turns = parse_chatml(r["formatted"])
                loss = "".join(unescape(r["formatted"][s["start"]:s["end"]]) for s in r["loss"])
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                out.append((r["conv_id"], len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                            hashlib.sha256(loss.encode()).hexdigest(), len(r["formatted"]), len(r["rewritten"])))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            names = [x.split()[0] for x in schema.split(", ")]
            columns = zip(*out, strict=True) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return formatted.mapInArrow(run, schema)
