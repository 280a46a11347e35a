"""Chat formatting: conversations rendered by a compiled template, with generation markers, and read back.

Rows are sorted by conversation and turn within a shuffle by conversation and
stream through the template: a task holds one turn at a time, never a whole
conversation. Hashes run over the turns as they pass.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches
from tidemark.llm.template import compile_template

START, END = "<|im_start|>", "<|im_end|>"
TEMPLATE = (
    "{% for m in messages %}"
    "{{ '<|im_start|>' }}{{ m.role | escape_role }}{{ '\\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}"
    "{{ '<|im_end|>' + '\\n' }}"
    "{% endfor %}"
)
RESULT = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def escape(text: str | None) -> str:
    """``text`` without ``<|``: every run of backslashes between ``<`` and ``|`` gets one more."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text or "")


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str | None) -> str:
    """As ``escape``, and on one line."""
    return escape((role or "").replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


FILTERS = {"escape": escape, "escape_role": escape_role}


def render(messages, template: str = TEMPLATE) -> Iterator[tuple[str, bool]]:
    """Pieces of a conversation's formatted text, each with whether it is under the loss mask."""
    return compile_template(template, FILTERS)({"messages": messages})


def read_back(pieces: Iterator[tuple[str, bool]]) -> Iterator[tuple[str, str, str, int]]:
    """Turns of a formatted conversation as they complete: role, text, text under the mask, characters read.

    Only the output is read: a turn runs from its start marker to its end
    marker, which escaped texts cannot hold.
    """
    held, masked = [], []
    for text, trained in pieces:
        held.append(text)
        if trained:
            masked.append(text)
        if END not in text:
            continue
        joined = "".join(held)
        while (end := joined.find(END + "\n")) >= 0:
            turn, joined = joined[:end], joined[end + len(END) + 1:]
            head, body = turn[len(START):].split("\n", 1)
            yield unescape_role(head), unescape(body), unescape("".join(masked)), len(turn) + len(END) + 1
            masked = []
        held = [joined]


def summaries(template: str = TEMPLATE):
    """Arrow function from sorted ``conv_id, role, text`` to one row per conversation, read back from its formatted text."""
    names = [part.split()[0] for part in RESULT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(k).to_pylist() for k in range(3))))
        made = []
        for conv_id, turns in itertools.groupby(rows, key=lambda row: row[0]):
            messages = ({"role": role, "text": text} for _, role, text in turns)
            all_turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = formatted = 0
            for role, text, masked, size in read_back(render(messages, template)):
                all_turns.update(f"{role}\n{text}\n".encode())
                loss.update(masked.encode())
                n_turns, loss_chars, formatted = n_turns + 1, loss_chars + len(masked), formatted + size
            made.append((conv_id, n_turns, all_turns.hexdigest(), loss_chars, loss.hexdigest(), formatted))
            if len(made) == 1000:
                yield _batch(made, kinds, names)
                made = []
        if made:
            yield _batch(made, kinds, names)

    return run


def _batch(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def formatted_turns(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """``conv_id, turn, formatted``: each turn's share of its conversation's formatted text."""

    @F.arrow_udf("string")
    def of(roles: pa.Array, texts: pa.Array) -> pa.Array:
        return pa.array(["".join(p for p, _ in render([{"role": r, "text": t}], template))
                         for r, t in zip(roles.to_pylist(), texts.to_pylist())], pa.string())

    bound_batches(conversations.sparkSession)
    return conversations.select("conv_id", "turn", of("role", "text").alias("formatted"))


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Per conversation what its formatted text holds, read back from that text.

    Turns are ordered by ``turn`` (null first), ties by role and text. Null
    texts and roles count as empty; rows without ``conv_id`` form one
    conversation; repeated rows are repeated turns; further columns are
    ignored; no rows give no rows. A hash over a conversation is sequential, so
    one conversation is read by one task, but never held.
    """
    bound_batches(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
                                F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(summaries(template), RESULT)
