"""Best-fit packing with several sequence lengths (operator 5).

Every document is a run of units (code points unless another length column is
named).  A document longer than the largest permitted length is cut into
pieces of that length and a rest.  Pieces are dealt to groups of about
GROUP_PIECES by a hash of (doc_id, copy, piece); a group is packed by itself,
so the work is spread evenly whatever key is hot, and each group is bounded.

A sequence of length c costs ``c + c * c * ATTENTION + OVERHEAD``: its units,
the share of attention that grows with the square, and a fixed part.  So long
sequences cost more a unit, short ones leave more room unfilled, and the
permitted lengths have to be weighed against each other.

Inside a group: pieces in descending order go to the open sequence with the
least room that still fits (best fit, by binary search).  If none fits, a
sequence is opened.  For every permitted length that holds the piece, the room
it would really fill is taken from the pieces still to come (the largest that
fit, one after the other); the length with the least cost per filled unit is
opened.  So a long piece gets the length that it needs, whatever suits the
short ones.  As a greedy choice can mislead, the group is also packed with each
subset of lengths up to a largest and from a smallest one on, long pieces
always getting the shortest that holds them; the packing with the least total
cost is taken.  At the end each sequence shrinks to the smallest permitted
length that holds its contents.

Defined results: null or empty documents have no pieces and do not appear;
rows with equal (doc_id, length) are packed as often as they occur, told apart
by ``copy``; ties are broken by (doc_id, length, copy, piece); an empty table
gives an empty table."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewise.llm.common import small_batches

CAPACITIES = (1024, 2048, 4096, 8192, 16384)
OVERHEAD = 16
#: attention at 16,384 units costs half as much again as the units themselves
ATTENTION = 2.0 ** -15
GROUP_PIECES = 10_000
KEY = ("doc_id", "length", "copy", "piece", "start", "size")


def sequence_cost(capacity: int, overhead: float, attention: float) -> float:
    return capacity + attention * capacity * capacity + overhead


def _fill(sizes: np.ndarray, upto: np.ndarray, at: int, room: int) -> int:
    """How much of ``room`` the pieces from index ``at`` on (descending) fill,
    taking the largest that fits again and again; ``upto`` are prefix sums."""
    filled, n = 0, len(sizes)
    while room and at < n:
        at += int(np.searchsorted(-sizes[at:], -room))
        if at == n:
            break
        # as many as fit in a row
        end = int(np.searchsorted(upto, upto[at] + room, "right")) - 1
        part = int(upto[end] - upto[at])
        filled, room, at = filled + part, room - part, end
    return filled


def best_fit(sizes: np.ndarray, capacities: tuple[int, ...], overhead: float = OVERHEAD, attention: float = ATTENTION,
             choice: tuple[int, ...] | None = None) -> tuple[np.ndarray, list[int], float]:
    """Bin of each piece (``sizes`` descending), final capacity of each bin
    and the total cost.  Sequences of the lengths in ``choice`` (all by
    default) are opened; a piece beyond them gets the shortest that holds it."""
    choice = capacities if choice is None else choice
    cost = {c: sequence_cost(c, overhead, attention) for c in capacities}
    sizes = np.asarray(sizes, np.int64)
    upto = np.concatenate([[0], np.cumsum(sizes)])
    bins = np.empty(len(sizes), np.int64)
    room: list[tuple[int, int]] = []
    opened = 0
    for k, size in enumerate(sizes.tolist()):
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            fit = [c for c in choice if c >= size] or [min(c for c in capacities if c >= size)]
            free = fit[0] if len(fit) == 1 else min(
                fit, key=lambda c: (cost[c] / (size + _fill(sizes, upto, k + 1, c - size)), c))
            b = opened
            opened += 1
        bins[k] = b
        if free > size:
            insort(room, (free - size, b))
    used = np.bincount(bins, sizes, opened).astype(np.int64) if opened else np.empty(0, np.int64)
    caps = np.asarray(capacities)
    final = caps[np.searchsorted(caps, used)].tolist()
    return bins, final, sum(cost[c] for c in final)


def pack_group(sizes: np.ndarray, capacities: tuple[int, ...], overhead: float = OVERHEAD,
               attention: float = ATTENTION) -> tuple[np.ndarray, list[int]]:
    """The cheapest packing over the subsets of neighbouring lengths."""
    n = len(capacities)
    tries = [best_fit(sizes, capacities, overhead, attention, capacities[i:j])
             for i in range(n) for j in range(i + 1, n + 1)]
    return min(tries, key=lambda t: t[2])[:2]


def pieces(docs: DataFrame, largest: int, id_col: str = "doc_id", length=None) -> DataFrame:
    """(doc_id, length, copy, piece, start, size) of every document."""
    size = F.coalesce(length if length is not None else F.char_length("text"), F.lit(0)).cast("long")
    # repeated rows come as a count, so that a row repeated without end is spread, too
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), size.alias("length")).where("length > 0") \
        .groupBy("doc_id", "length").agg(F.count(F.lit(1)).alias("times"))
    rows = rows.select("doc_id", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)).alias("copy"))
    last = F.floor((F.col("length") - 1) / largest).cast("long")
    rows = rows.select("doc_id", "length", "copy", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * largest
    return rows.select("doc_id", "length", "copy", "piece", start.alias("start"),
                       F.least(F.lit(largest), F.col("length") - start).cast("long").alias("size"))


def pack(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, overhead: float = OVERHEAD,
         group_pieces: int = GROUP_PIECES, id_col: str = "doc_id", length=None,
         attention: float = ATTENTION) -> DataFrame:
    """(sequence, capacity, offset, doc_id, length, copy, piece, start, size): where
    each piece lies.  ``sequence`` is unique over all groups."""
    capacities = tuple(sorted(set(capacities)))
    cut = pieces(docs, capacities[-1], id_col, length)
    groups = max(1, -(-cut.count() // group_pieces))
    cut = cut.withColumn("grp", F.pmod(F.xxhash64("doc_id", "length", "copy", "piece"), F.lit(groups)))

    def run(key, rows):
        rows = rows.sort_by([("size", "descending"), ("doc_id", "ascending"), ("length", "ascending"),
                             ("copy", "ascending"), ("piece", "ascending")])
        sizes = rows.column("size").to_numpy()
        bins, final = pack_group(sizes, capacities, overhead, attention)
        order = np.argsort(bins, kind="stable")
        begun = np.cumsum(sizes[order]) - sizes[order]
        first = np.flatnonzero(np.diff(bins[order], prepend=-1))
        shift = np.repeat(begun[first], np.diff(np.append(first, len(order))))
        offset = np.empty(len(sizes), np.int64)
        offset[order] = begun - shift
        sequence = key[0].as_py() * (1 << 32) + bins
        cols = {"sequence": sequence, "capacity": np.asarray(final, np.int64)[bins], "offset": offset}
        return pa.table({k: pa.array(v, pa.int64()) for k, v in cols.items()} | {
            c: rows.column(c) for c in KEY})

    return cut.groupBy("grp").applyInArrow(
        run, "sequence long, capacity long, offset long, " + ", ".join(f"{c} long" for c in KEY))


def with_texts(placed: DataFrame, docs: DataFrame, largest: int = CAPACITIES[-1], id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``placed`` (as of :func:`pack` over the texts' code points) with each
    piece's text in ``piece_text``, so that sequences can be rebuilt from the rows
    alone.  Documents that share an id and a length are told apart by the
    order of their texts: their copies are numbered in that order."""
    ident = F.col(id_col).cast("long").alias("doc_id")
    kinds = docs.select(ident, F.col(text_col).alias("text")).where(F.char_length("text") > 0) \
        .groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("times")) \
        .withColumn("length", F.char_length("text").cast("long"))
    before = Window.partitionBy("doc_id", "length").orderBy("text").rowsBetween(Window.unboundedPreceding, -1)
    kinds = kinds.withColumn("low", F.coalesce(F.sum("times").over(before), F.lit(0)))

    def run(batches):
        for part in small_batches(batches, 256):
            rows = {c: [] for c in ("doc_id", "length", "low", "high", "piece", "piece_text")}
            for i, text, length, low, times in zip(*(part.column(c).to_pylist() for c in (
                    "doc_id", "text", "length", "low", "times")), strict=True):
                for piece, at in enumerate(range(0, len(text), largest)):
                    for c, v in zip(rows, (i, length, low, low + times, piece, text[at:at + largest]), strict=True):
                        rows[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.string() if c == "piece_text" else pa.int64()) for c, v in rows.items()], names=list(rows))

    texts = kinds.select("doc_id", "text", "length", "low", "times").mapInArrow(
        run, "doc_id long, length long, low long, high long, piece long, piece_text string")
    p, t = placed.alias("p"), texts.alias("t")
    same = F.col("p.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("p.length") == F.col("t.length")) \
        & (F.col("p.piece") == F.col("t.piece")) & (F.col("p.copy") >= F.col("t.low")) & (F.col("p.copy") < F.col("t.high"))
    return p.join(t, same).select("p.*", "t.piece_text")
