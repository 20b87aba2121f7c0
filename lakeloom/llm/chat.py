"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns (dicts of ``role`` and
``text``) to a string. Nothing is known of its inside: the successive prefixes
of a conversation are rendered and consecutive outputs compared. What the
longer output adds is the span of its last turn. If the shorter output is not
a prefix of the longer one, the template rewrote history; the turn is counted
in ``n_rewrites`` and its span begins where the outputs part. The text inside
a span is found by rendering the prefix twice more with probe texts that
differ at once; it lies where these outputs part.

Conversations are gathered by id (their turns sorted by turn, role, text, so
ties and repeated rows have one order) and rendered each in one task: a
prefix is a prefix of the whole conversation, so this work cannot be split
within one conversation, only between them.

Nulls: null roles and texts are empty strings, a null turn sorts first, rows
without conversation id form one conversation whose id is null. Empty texts
have empty spans. An empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Render = Callable[[list[dict]], str]


class TurnTemplate:
    r"""Turns as ``### role: text</turn>`` and a newline.

    Inside roles and texts a backslash goes before every backslash, ``#``,
    ``<`` and ``:``, so a control string can only come from the template, and
    :meth:`parse` gives back the turns.
    """

    _special = re.compile(r"([\\#<:])")
    _escaped = re.compile(r"\\([\\#<:])")
    _turn = re.compile(r"### ((?:\\[\\#<:]|[^\\#<:])*): ((?:\\[\\#<:]|[^\\#<:])*)</turn>\n")

    def __call__(self, turns: list[dict]) -> str:
        return "".join(f"### {self.escape(t['role'])}: {self.escape(t['text'])}</turn>\n" for t in turns)

    def escape(self, text: str) -> str:
        return self._special.sub(r"\\\1", text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(r"\1", text)

    def parse(self, formatted: str) -> list[dict]:
        turns, at = [], 0
        while at < len(formatted):
            m = self._turn.match(formatted, at)
            if not m:
                raise ValueError(f"not a formatted conversation at character {at}")
            turns.append({"role": self.unescape(m[1]), "text": self.unescape(m[2])})
            at = m.end()
        return turns


@dataclass
class Rendered:
    text: str = ""
    #: ``(start, end)`` of each turn, and of each turn's text, in the output.
    turns: list[tuple[int, int]] = field(default_factory=list)
    texts: list[tuple[int, int]] = field(default_factory=list)
    n_rewrites: int = 0


def _common(a: str, b: str) -> int:
    """Length of the longest common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


def render_incrementally(render: Render, turns: list[dict]) -> Rendered:
    out = Rendered(render([]))
    for i, turn in enumerate(turns):
        now = render(turns[: i + 1])
        start = len(out.text)
        if not now.startswith(out.text):
            out.n_rewrites += 1
            start = _common(out.text, now)
        one, two = (render([*turns[:i], {**turn, "text": x}]) for x in ("A", "B"))
        at = _common(one, two)
        out.turns.append((start, len(now)))
        out.texts.append((at, max(at, at + len(now) - len(one) + 1)))
        out.text = now
    return out


FORMATTED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("formatted", T.StringType()),
        T.StructField("turn_spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("loss_spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("n_rewrites", T.LongType()),
    ]
)


def gather_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: one row per conversation, turns in order."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def format_conversations(conversations: DataFrame, render: Render, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """The formatted text of every conversation with the spans of its turns and of the texts under the loss mask (code points)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = {n: [] for n in FORMATTED.names[1:]}
            for turns in b.column(1).to_pylist():
                r = render_incrementally(render, turns)
                rows["formatted"].append(r.text)
                rows["turn_spans"].append([list(x) for x in r.turns])
                rows["loss_spans"].append([list(x) for x, t in zip(r.texts, turns) if t["role"] in loss_roles])
                rows["n_rewrites"].append(r.n_rewrites)
            spans = pa.list_(pa.list_(pa.int64()))
            kinds = {"formatted": pa.string(), "turn_spans": spans, "loss_spans": spans, "n_rewrites": pa.int64()}
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(rows[n], kinds[n]) for n in FORMATTED.names[1:])], names=FORMATTED.names)

    return gather_turns(conversations).mapInArrow(run, FORMATTED)


READ_BACK = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
        T.StructField("n_rewrites", T.LongType()),
    ]
)


def read_back(formatted: DataFrame, template: TurnTemplate) -> DataFrame:
    """Counts and digests of what the formatted texts hold, from these texts and spans alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for conv, text, spans, rewrites in zip(*(b.column(n).to_pylist() for n in ("conv_id", "formatted", "loss_spans", "n_rewrites"))):
                turns = template.parse(text)
                said = "".join(f"{t['role']}\n{t['text']}\n" for t in turns)
                loss = "".join(template.unescape(text[s:e]) for s, e in spans)
                rows.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text), rewrites))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=READ_BACK.names)

    return formatted.select("conv_id", "formatted", "loss_spans", "n_rewrites").mapInArrow(run, READ_BACK)
