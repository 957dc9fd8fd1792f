"""Chat formatting with offset-aligned loss masks (operator 4).

A whole conversation is rendered as one string::

    <|turn|>role<|text|>text<|end|> ... one group per turn

The marks are special tokens.  Inside roles and texts every ``<`` that is
followed by backslashes and ``|`` gets one backslash more, so ``<|`` never
occurs there; taking one away restores the text.

The string is encoded once; tokens carry byte offsets.  The turns' text spans
are sorted, as are the token offsets, so binary search finds the tokens of
each span.  Marks are atomic, hence token borders fall on span borders and the
mask is exact: it covers the texts of assistant turns and nothing else.

Defined results: null roles and texts are empty, null turns sort first, equal
turn numbers by role and text; repeated rows are repeated turns; a row with a
null conv_id belongs to no other and is a conversation of one turn with a null
id; an empty table gives an empty table.  A conversation is one training example, so its turns meet in one
row by design."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.bpe import Vocabulary
from tracewise.llm.common import small_batches

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
MARKS = (TURN, TEXT, END)
LOSS_ROLE = "assistant"

_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<(\\*)\\\|")
_PARSE = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, int]]]:
    """The formatted string, and (begin, end, turn) byte spans of the texts."""
    parts, spans, at = [], [], 0
    for k, (role, text) in enumerate(turns):
        head = TURN + escape(role) + TEXT
        body = escape(text)
        begin = at + len(head.encode())
        end = begin + len(body.encode())
        spans.append((begin, end, k))
        parts += [head, body, END]
        at = end + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted string."""
    return [(unescape(r), unescape(t)) for r, t in _PARSE.findall(formatted)]


def token_mask(ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in one of the sorted byte spans; ``ends`` are the
    tokens' end offsets.  Binary search of both span ends."""
    mask = np.zeros(len(ends), np.uint8)
    if spans:
        s = np.array(spans)
        for a, b in zip(np.searchsorted(ends, s[:, 0], "right"), np.searchsorted(ends, s[:, 1], "right"), strict=True):
            mask[a:b] = 1
    return mask


def masked_text(formatted: str, ends: np.ndarray, mask: np.ndarray) -> str:
    """Unescaped text of the masked tokens: one piece per run of the mask."""
    data = formatted.encode()
    step = np.diff(np.concatenate([[0], mask, [0]]).astype(np.int8))
    begin = np.concatenate([[0], ends])
    return "".join(unescape(data[begin[a]:begin[b]].decode())
                   for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True))


def format_conversations(rows: DataFrame, vocabulary_path: str, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv_id, formatted, ids, ends, mask): the string, its token ids and
    their end offsets in bytes (packed little-endian unsigned 32-bit), and one
    mask byte per token."""
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path, MARKS))
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    talks = rows.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    talks = talks.unionByName(rows.where("conv_id IS NULL").select("conv_id", F.array("t").alias("turns")))

    def run(batches):
        vocab = shared.value
        enc = vocab.encoder()
        size = np.array([len(b) for b in vocab.token_bytes])
        for part in small_batches(batches, 256):
            talks = [[(t["role"], t["text"]) for t in c] for c in part.column("turns").to_pylist()]
            made = [render(t) for t in talks]
            packed = list(enc.encode([m[0] for m in made]))
            ends, masks = [], []
            for turns, (_, spans), ids in zip(talks, made, packed, strict=True):
                end = np.cumsum(size[np.frombuffer(ids, "<u4")])
                ends.append(end.astype("<u4").tobytes())
                masks.append(token_mask(end, [(a, b) for a, b, k in spans if turns[k][0] == loss_role]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column("conv_id"), pa.array([m[0] for m in made], pa.string()),
                 *(pa.array(c, pa.binary()) for c in (packed, ends, masks))],
                names=["conv_id", "formatted", "ids", "ends", "mask"])

    return talks.mapInArrow(run, "conv_id long, formatted string, ids binary, ends binary, mask binary")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns, loss_text, formatted_chars) read from the
    output of :func:`format_conversations` alone."""

    def run(batches):
        for part in small_batches(batches, 256):
            n, turns, loss = [], [], []
            cols = (part.column(c).to_pylist() for c in ("formatted", "ends", "mask"))
            for text, ends, mask in zip(*cols, strict=True):
                read = parse(text)
                n.append(len(read))
                turns.append("".join(f"{r}\n{t}\n" for r, t in read))
                loss.append(masked_text(text, np.frombuffer(ends, "<u4").astype(np.int64), np.frombuffer(mask, np.uint8)))
            yield pa.RecordBatch.from_arrays(
                [part.column("conv_id"), pa.array(n, pa.int64()), pa.array(turns, pa.string()),
                 pa.array(loss, pa.string()), pa.array([len(t) for t in part.column("formatted").to_pylist()], pa.int64())],
                names=["conv_id", "n_turns", "turns", "loss_text", "formatted_chars"])

    return formatted.mapInArrow(
        run, "conv_id long, n_turns long, turns string, loss_text string, formatted_chars long")
