"""Conversations rendered for training, with a loss mask over tokens aligned by offsets.

Each conversation is rendered whole, encoded once with character offsets, and the sorted spans of
its assistant texts are intersected with the sorted spans of its tokens by binary search: a token
is under the mask if it shares a character with such a span, and the share is what counts.

Template: for each turn ``### role``, a line feed, the text, ``</turn>`` and a line feed. Inside
texts and roles a backslash precedes backslashes, ``###`` and ``</turn>`` (and stands with n for a
line feed in a role), so no text can open or close a turn, and reading back gives what was written.

A conversation is one record and is put together in one task, as a document is; there is no other
group. Defined results: a null text or role is empty; turns go by number, those of equal number by
role and text, nulls first; repeated rows are turns of their own; rows without a conversation id
are one conversation; no rows give an empty result; further columns are left aside.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

TURN, CLOSE = "### ", "</turn>\n"
_CONTROL = re.compile(r"\\|###|</turn>")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\\n]|\\.)*)\n((?:[^\\<]|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Formatted text, and where each turn's text stands in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = TURN + escape(role).replace("\n", "\\n") + "\n"
        body = escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        role = _ESCAPED.sub(lambda e: "\n" if e[1] == "n" else e[1], m[1])
        out.append((role, unescape(m[2])))
        at = m.end()
    return out


def mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """1 for each token that shares a character with a span. Tokens and spans are sorted."""
    out = np.zeros(len(starts), np.uint8)
    for a, b in spans:
        if a < b:
            out[np.searchsorted(ends, a, "right"):np.searchsorted(starts, b, "left")] = 1
    return out


def masked_text(formatted: str, starts, ends, under, spans) -> str:
    """The text under the mask, unescaped: what masked tokens share with the spans, each character
    once, in order. Tokens of one character's bytes have equal offsets."""
    out = []
    for a, b in spans:
        i, j = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left")
        pieces, at = [], a
        for k in np.flatnonzero(under[i:j]) + i:
            first, last = max(int(starts[k]), at), min(int(ends[k]), b)
            if first < last:
                pieces.append(formatted[first:last])
                at = last
        out.append(unescape("".join(pieces)))
    return "".join(out)


FORM = ("formatted string, ids binary, starts binary, ends binary, loss binary, spans array<int>")


def _encoded(coder_json, trained: str):
    names = ["conv_id", *(f.split()[0] for f in FORM.split(", "))]

    def run(batches):
        coder = Tokenizer.from_str(coder_json.value)
        coder.encode_special_tokens = True
        for batch in batches:
            rows = []
            for turns in batch.column("turns").to_pylist():
                pairs = [(t["role"] or "", t["text"] or "") for t in turns]
                text, spans = render(pairs)
                code = coder.encode(text, add_special_tokens=False)
                offsets = np.array(code.offsets, np.int32).reshape(-1, 2)
                starts, ends = offsets[:, 0], offsets[:, 1]
                spans = [s for s, (role, _) in zip(spans, pairs, strict=True) if role == trained]
                rows.append((text, np.array(code.ids, "<u4").tobytes(), starts.tobytes(),
                             ends.tobytes(), mask(starts, ends, spans).tobytes(),
                             [x for s in spans for x in s]))
            kinds = [pa.string(), *[pa.binary()] * 4, pa.list_(pa.int32())]
            columns = [[r[k] for r in rows] for k in range(len(kinds))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *(pa.array(c, t) for c, t in zip(
                    columns, kinds, strict=True))], names=names)
    return run


def format_conversations(rows: DataFrame, tokenizer: str, trained: str = "assistant",
                         key: str = "conv_id") -> DataFrame:
    """(conv_id, formatted, ids, starts, ends, loss, spans): per conversation its text, the ids and
    character offsets of its tokens, their loss mask, and the spans of the trained texts.
    ``tokenizer``: the JSON text of a tokenizer that gives offsets."""
    turns = rows.groupBy(F.col(f"`{key}`").alias("conv_id")).agg(F.array_sort(F.collect_list(
        F.struct(F.col("turn").isNotNull(), "turn", F.col("role").isNotNull(), "role",
                 F.col("text").isNotNull(), "text"))).alias("turns"))
    turns = turns.select("conv_id", F.transform("turns", lambda t: F.struct(
        t["role"].cast("string").alias("role"), t["text"].cast("string").alias("text"))).alias("turns"))
    sent = rows.sparkSession.sparkContext.broadcast(tokenizer)
    kind = turns.schema["conv_id"].dataType.simpleString()
    return turns.mapInArrow(_encoded(sent, trained), f"conv_id {kind}, {FORM}")


def _read(batches):
    for batch in batches:
        turns, losses = [], []
        for row in batch.to_pylist():
            starts, ends = (np.frombuffer(row[k], np.int32) for k in ("starts", "ends"))
            under = np.frombuffer(row["loss"], np.uint8)
            spans = list(zip(row["spans"][::2], row["spans"][1::2], strict=True))
            turns.append([{"role": r, "text": t} for r, t in read_turns(row["formatted"])])
            losses.append(masked_text(row["formatted"], starts, ends, under, spans))
        turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("formatted"), pa.array(turns, turn),
             pa.array(losses, pa.string()), batch.column("loss")],
            names=["conv_id", "formatted", "turns", "loss_text", "loss"])


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss_text, loss): turns as read from the formatted text, and the
    text under the loss mask."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(
        _read, f"conv_id {kind}, formatted string, turns array<struct<role:string,text:string>>, "
               "loss_text string, loss binary")
