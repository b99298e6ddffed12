"""Chat formatting with a loss mask found by rendering successive prefixes of a conversation."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]  # role, text
Template = Callable[[list[Turn]], str]

START, END = "<|im_start|>", "<|im_end|>"


def escaped(text: str) -> str:
    """Reversible: afterwards no text holds ``<|``, and a role no line end."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


def _marked(role: str, text: str) -> str:
    return f"{START}{escaped(role).replace(chr(10), chr(92) + 'n')}\n{escaped(text)}{END}\n"


#: The same for texts that come again and again as prefixes grow; long ones are not held.
_marked_short = lru_cache(maxsize=1024)(_marked)
SHORT = 20_000


def marked_turns(turns: list[Turn]) -> str:
    """The template of the query: marks about each turn, the role on the first line."""
    return "".join([_marked_short(role, text) if len(text) < SHORT else _marked(role, text) for role, text in turns])


def read_marked_turns(out: str) -> list[Turn]:
    """The turns that :func:`marked_turns` has written."""
    found = []
    for part in out.split(START)[1:]:
        role, _, body = part.partition("\n")
        found.append((unescaped(role), unescaped(body[: body.rindex(END)])))
    return found


@dataclass
class Rendered:
    text: str = ""
    #: For each turn where its text stands in ``text``; None where the template gives no such place.
    spans: list[tuple[int, int] | None] = field(default_factory=list)
    #: The first turn after which the earlier output was no longer a prefix; None if there is none.
    rewritten_at: int | None = None


PROBES = ("\ue000", "\ue001")


def _edges(before: list[Turn], role: str, template: Template) -> tuple[int, int] | None:
    """Lengths of what the template puts in front of a last turn's text, and after it."""
    one, two = (template([*before, (role, p)]) for p in PROBES)
    if len(one) != len(two):
        return None
    places = [i for i, (x, y) in enumerate(zip(one, two, strict=True)) if x != y]
    if len(places) != 1:
        return None
    return places[0], len(one) - places[0] - 1


def render(turns: list[Turn], template: Template) -> Rendered:
    """Render each prefix of ``turns`` with a template of which nothing is known.

    If the output for k turns begins with that for k - 1, the rest is the k-th turn's span; where
    its text stands in it is found by rendering the same prefix with two one-letter texts, once
    for each role: a later span that begins and ends with the same marks has its text between
    them, and any other span is probed anew. If the output doesn't begin so, the template rewrites history: the spans so far are no longer valid and are
    set to None, and the turn is noted.
    """
    out = Rendered()
    marks: dict[str, tuple[str, str]] = {}  # by role, what stood before and after a text
    for k, (role, _) in enumerate(turns):
        now = template(turns[: k + 1])
        start = len(out.text)
        if not now.startswith(out.text):
            out.rewritten_at = k if out.rewritten_at is None else out.rewritten_at
            out.spans, marks, start = [None] * k, {}, 0
        before, after = marks.get(role, ("", ""))
        if role in marks and len(now) >= start + len(before) + len(after) and now.startswith(before, start) and now.endswith(after):
            out.spans.append((start + len(before), len(now) - len(after)))
        elif (edges := _edges(turns[:k], role, template)) and start <= edges[0] <= len(now) - edges[1]:
            out.spans.append((edges[0], len(now) - edges[1]))
            marks[role] = now[start : edges[0]], now[len(now) - edges[1] :]
        else:
            out.spans.append(None)
        out.text = now
    return out


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[Turn]]]:
    """Runs of equal conv_id; rows come sorted, also across batches."""
    held: tuple | None = None
    turns: list[Turn] = []
    for batch in batches:
        for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held is not None and held[0] != conv:
                yield held[0], turns
                turns = []
            held = (conv,)
            turns.append((role or "", text or ""))
    if held is not None:
        yield held[0], turns


def _sorted_turns(conversations: DataFrame) -> DataFrame:
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")


FORMATTED = "conv_id long, n_turns long, formatted string, spans array<array<long>>, rewritten_at long"


def format_conversations(conversations: DataFrame, template: Template = marked_turns, trained_role: str = "assistant") -> DataFrame:
    """(conv_id, n_turns, formatted, spans, rewritten_at) for each conversation.

    ``conversations(conv_id, turn, role, text)``: rows in order of turn, then role and text (ties
    and repeated rows all stay, null turns come first); null role and text are empty; rows without
    conv_id are one conversation. ``spans`` are the [from, to) code points of the trained role's
    texts in ``formatted``: the loss mask. ``rewritten_at`` is the turn at which the template
    changed earlier output, else null; spans it has made void are left out. One shuffle by
    conv_id; a task holds one conversation at a time. Other columns are ignored.
    """

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.int64()]
    names = ["conv_id", "n_turns", "formatted", "spans", "rewritten_at"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for conv, turns in _conversations(batches):
            r = render(turns, template)
            spans = [list(s) for s, (role, _) in zip(r.spans, turns, strict=True) if s and role == trained_role]
            rows.append((conv, len(turns), r.text, spans, r.rewritten_at))
            size += len(r.text)
            if size > 1_000_000:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)

    return _sorted_turns(conversations).mapInArrow(run, FORMATTED)


def format_digests(formatted: DataFrame) -> DataFrame:
    """What is read back from the output of :func:`format_conversations` with the default template.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars): the turns parsed
    from the text, and the texts under the loss mask.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, out, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                turns = read_marked_turns(out)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                loss = "".join(unescaped(out[a:b]) for a, b in spans)
                rows.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(out)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("conv_id", "formatted", "spans").mapInArrow(run, schema)
