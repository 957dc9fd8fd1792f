"""Prefix trie of conversations (operator 11).

A conversation is a sequence of turns; every distinct sequence of first d
turns is a node of depth d.  The trie is built from the sorted order:

1. A turn becomes a 128-bit digest of role and text plus its length; a
   conversation's key is the concatenation of its turns' digests.  The
   conversations are sorted globally by key and id (range partitions, so
   conversations that share a beginning, or are equal, are spread over tasks).
2. A partition is read in blocks of about BLOCK_TURNS turns.  In a block,
   neighbours are joined by edges weighted with the number of turns they share
   (LCP).  The edges are taken in descending depth by a union-find: a merge at
   depth d first completes the nodes deeper than d on both sides and creates
   the branching node at depth d.
3. Nodes that contain a block's first or last conversation may go on in the
   neighbouring block: they stay open.  A block's forest is contracted to these
   two chains, each with what its complete subtrees add to every open node.
   The same union-find merges the chains of a partition's blocks, then those of
   FAN_IN neighbouring partitions a round, until one forest is left.
4. Nodes whose parent was open when they were completed get the parent's id by
   a join on block and parent, so even the root's children are no hot key.
   The id lists of open nodes are written as pieces, in order, and hashed as a
   stream (SHA-256 can only be computed in order; memory is one piece).

Defined results: turns are taken by turn number, nulls first, equal numbers by
role and text digest; null roles and texts are empty.  Rows with a null
conversation id belong to no conversation and are left out.  An empty table
gives an empty table, without a root.  A conversation is one example, so the
digests (not the texts) of its turns meet in one row by design."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.common import materialise

TOKEN = 16
BLOCK_TURNS = 65_536
FAN_IN = 64
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

_SCHEMA = ("kind int, scope long, conv_id long, depth long, n_convs long, n_children long, n_leaves long, "
           "saved_tokens long, ends_sha256 string, node binary, parent_conv_id long, parent binary, place long, "
           "key binary, lens array<long>, sums array<struct<depth:long,conv:long,n:long,kids:long,leaves:long,"
           "saved:long,ends:boolean>>, piece binary")
_NAMES = [f.split()[0] for f in ("kind", "scope", "conv_id", "depth", "n_convs", "n_children", "n_leaves",
                                 "saved_tokens", "ends_sha256", "node", "parent_conv_id", "parent", "place", "key",
                                 "lens", "sums", "piece")]
NODE, CHAIN, PIECE = 0, 1, 2


class Sums:
    """What is known so far about one node: its smallest member, its members,
    children, leaves and saved tokens, and the ids that end there."""

    __slots__ = ("conv", "n", "kids", "leaves", "saved", "ends", "far")

    def __init__(self, conv=None, n=0, kids=0, leaves=0, saved=0, ends=(), far=False):
        self.conv, self.n, self.kids, self.leaves, self.saved = conv, n, kids, leaves, saved
        self.ends, self.far = list(ends), far  # far: ids that end here are in pieces

    def add(self, o: Sums) -> None:
        if o.conv is not None:
            self.conv = o.conv if self.conv is None else min(self.conv, o.conv)
        self.n += o.n
        self.kids += o.kids
        self.leaves += o.leaves
        self.saved += o.saved
        self.ends += o.ends
        self.far |= o.far

    def empty(self) -> bool:
        return self.conv is None


class Chain:
    """A path from the root: its key, the lengths of its turns, and sums by depth."""

    __slots__ = ("key", "lens", "sums", "_ids")

    def __init__(self, key: bytes, lens: list[int], sums: dict[int, Sums]):
        self.key, self.lens, self.sums, self._ids = key, lens, sums, None

    def node_id(self, depth: int) -> bytes:
        """The digest of the first ``depth`` turns."""
        if self._ids is None:
            h = hashlib.blake2b(digest_size=TOKEN)
            self._ids = [h.digest()]
            for i in range(0, len(self.key), TOKEN):
                h.update(self.key[i:i + TOKEN])
                self._ids.append(h.copy().digest())
        return self._ids[depth]


def shared_turns(a: bytes, b: bytes) -> int:
    """Number of first turns that two keys share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TOKEN
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(differ.argmax()) // TOKEN


class Part:
    """A component of the union-find: an interval of chains merged down to
    the node at ``depth``, which is not complete yet."""

    __slots__ = ("depth", "sums", "pending", "chain", "first", "last", "waiting")

    def __init__(self, chain: Chain, first: bool, last: bool):
        self.depth, self.chain, self.first, self.last = len(chain.lens), chain, first, last
        self.pending = dict(chain.sums)
        self.sums = self.pending.pop(self.depth, None) or Sums()
        self.waiting = []  # rows of complete children of this node

    def union(self, o: Part) -> None:
        self.sums.add(o.sums)
        self.first |= o.first
        self.last |= o.last
        self.waiting += o.waiting
        if len(o.pending) > len(self.pending):
            self.pending, o.pending = o.pending, self.pending
        for d, s in o.pending.items():
            if d in self.pending:
                self.pending[d].add(s)
            else:
                self.pending[d] = s


def contract(chains: list[Chain], final: bool,
             again: bool = True) -> tuple[list[list], list[Chain], list[tuple[bytes, list[int]]]]:
    """Merge neighbouring chains.  Returns the rows of complete nodes
    [conv_id, depth, n_convs, n_children, n_leaves, saved_tokens, ends or None,
    node id, parent_conv_id, parent id], the first and the last chain with
    their open sums (none if ``final``), and the ids that end in open nodes.
    ``again``: the chains were contracted before, so their nodes were open and
    need an id for those who wait for them."""
    rows, far_ends = [], []
    last = len(chains) - 1
    parts = [Part(c, k == 0, k == last) for k, c in enumerate(chains)]
    above = list(range(len(chains)))
    open_first, open_last = {}, {}

    def find(x):
        while above[x] != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    def rise(p, depth):
        """Complete the nodes of ``p`` that are deeper than ``depth``."""
        while p.depth > depth:
            s, waiting = p.sums, p.waiting
            if (p.first or p.last) and not final:  # may go on in the neighbouring block
                node = p.chain.node_id(p.depth)
                if s.ends:
                    far_ends.append((node, s.ends))
                    s.ends, s.far = [], True
                for row in waiting:
                    row[9] = node
                if not s.empty():
                    (open_first if p.first else open_last)[p.depth] = s
                up, p.waiting = Sums(), []
            else:
                leaves = s.leaves if s.kids else 1
                saved = s.saved + ((s.n - 1) * p.chain.lens[p.depth - 1] if p.depth else 0)
                for row in waiting:
                    row[8] = s.conv
                row = [s.conv, p.depth, s.n, s.kids, leaves, saved, None if s.far else s.ends,
                       p.chain.node_id(p.depth) if again else None, None, None]
                rows.append(row)
                up, p.waiting = Sums(s.conv, s.n, 1, leaves, saved), [row]
            p.depth -= 1
            if (more := p.pending.pop(p.depth, None)) is not None:
                up.add(more)
            p.sums = up

    lcp = np.array([shared_turns(a.key, b.key) for a, b in zip(chains, chains[1:], strict=False)], np.int64)
    for k in np.argsort(-lcp, kind="stable").tolist():
        a, b = find(k), find(k + 1)
        rise(parts[a], int(lcp[k]))
        rise(parts[b], int(lcp[k]))
        parts[a].union(parts[b])  # the branching node
        above[b] = a
        parts[b] = None
    rise(parts[find(0)], -1)
    left = [] if final else [Chain(chains[0].key, chains[0].lens, open_first)]
    if last and not final:
        left.append(Chain(chains[last].key, chains[last].lens, open_last))
    return rows, left, far_ends


def _frame(rows: list[dict]) -> pa.RecordBatch:
    types = [pa.int32(), *[pa.int64()] * 7, pa.string(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.binary(),
             pa.list_(pa.int64()), pa.list_(pa.struct([("depth", pa.int64()), ("conv", pa.int64()), ("n", pa.int64()),
                                                       ("kids", pa.int64()), ("leaves", pa.int64()),
                                                       ("saved", pa.int64()), ("ends", pa.bool_())])), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in zip(_NAMES, types, strict=True)],
                                      names=_NAMES)


def _frames(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    return (_frame(rows[i:i + 4096]) for i in range(0, len(rows), 4096))


def ids_sha(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


def _node_rows(rows: list[list], scope: int) -> Iterator[dict]:
    for conv, depth, n, kids, leaves, saved, ends, node, parent_conv, parent in rows:
        yield {"kind": NODE, "scope": scope, "conv_id": conv, "depth": depth, "n_convs": n, "n_children": kids,
               "n_leaves": leaves, "saved_tokens": saved, "node": node, "parent_conv_id": parent_conv, "parent": parent,
               "ends_sha256": None if ends is None else ids_sha(ends) if ends else EMPTY_SHA}


def _chain_row(chain: Chain, place: int) -> dict:
    return {"kind": CHAIN, "place": place, "key": chain.key, "lens": chain.lens,
            "sums": [{"depth": d, "conv": s.conv, "n": s.n, "kids": s.kids, "leaves": s.leaves, "saved": s.saved,
                      "ends": s.far} for d, s in chain.sums.items()]}


def _chain(key: bytes, lens: list[int], sums: list[dict]) -> Chain:
    return Chain(key, lens, {s["depth"]: Sums(s["conv"], s["n"], s["kids"], s["leaves"], s["saved"], (), s["ends"])
                             for s in sums})


def _partition_forest(block_turns: int, fan_in: int):
    """Sorted conversations -> complete nodes, id pieces, and the partition's
    first and last chain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, turns, block, chains = [], 0, 0, []

        def close():
            nonlocal held, turns, block, chains
            rows, left, far = contract(held, final=False, again=False)
            out = list(_node_rows(rows, (part << 24) + block))
            out += [{"kind": PIECE, "node": node, "conv_id": min(ids), "piece": ",".join(map(str, sorted(ids))).encode()}
                    for node, ids in far]
            chains += left
            held, turns, block = [], 0, block + 1
            return out

        def shrink():
            """The partition's blocks so far become one."""
            nonlocal block, chains
            rows, chains, _ = contract(chains, final=False)
            block += 1
            return list(_node_rows(rows, (part << 24) + block - 1))

        for batch in batches:
            for key, conv, lens in zip(*(batch.column(c).to_pylist() for c in ("key", "conv_id", "lens")), strict=True):
                held.append(Chain(key, lens, {len(lens): Sums(conv, 1, ends=(conv,))}))
                turns += len(lens) + 1
                if turns >= block_turns:
                    yield from _frames(close())
                    if len(chains) >= 2 * fan_in:
                        yield from _frames(shrink())
        if held:
            yield from _frames(close())
        if chains:
            yield from _frames([*shrink(), *(_chain_row(c, part) for c in chains)])

    return run


def _merge_forests(final: bool, level: int, fan_in: int):
    def run(rows: pa.Table) -> pa.Table:
        # a first chain comes before the last one of the same place; equal keys keep their sums apart
        cols = [rows.column(c).to_pylist() for c in ("place", "key", "lens", "sums")]
        got = sorted(zip(*cols, strict=True), key=lambda r: (r[0], r[1]))
        group = got[0][0] // fan_in
        made, left, _ = contract([_chain(*r[1:]) for r in got], final)
        out = [*_node_rows(made, -((level << 40) + group) - 1), *(_chain_row(c, group) for c in left)]
        return pa.Table.from_batches([_frame(out)])
    return run


def conversation_keys(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv_id, turns): the ordered (token, len) of every conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    token = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return rows.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), "turn", token.alias("token"),
        F.char_length(text).cast("long").alias("len")) \
        .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "token", "len"))).alias("turns")) \
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["token"].alias("token"), t["len"].alias("len")))
                .alias("turns"))


def prefix_trie(keyed: DataFrame, block_turns: int = BLOCK_TURNS, fan_in: int = FAN_IN) -> DataFrame:
    """The nodes of the trie over (conv_id, turns array<struct<token hex
    string, len long>>): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = keyed.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["token"]), "")).alias("key"),
        F.transform("turns", lambda t: t["len"]).alias("lens"))
    ordered = rows.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    found = materialise(ordered.mapInArrow(_partition_forest(block_turns, fan_in), _SCHEMA))
    nodes, chains = found.where(F.col("kind") == NODE), found.where(F.col("kind") == CHAIN)
    top, level = chains.agg(F.max("place")).first()[0], 0
    while top is not None:
        level, final = level + 1, top < fan_in
        merged = materialise(chains.groupBy(F.floor(F.col("place") / fan_in).alias("g")).applyInArrow(
            _merge_forests(final, level, fan_in), _SCHEMA))
        nodes = nodes.unionByName(merged.where(F.col("kind") == NODE))
        chains = merged.where(F.col("kind") == CHAIN)
        top = None if final else top // fan_in
    return _joined(nodes, found.where(F.col("kind") == PIECE))


def _streamed_sha(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (node, first id) -> one digest a node."""
    node, digest = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])],
                                          names=["node", "sha"])
    for batch in batches:
        for n, piece in zip(batch.column("node").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            if n == node:
                digest.update(b"," + piece)
            else:
                if node is not None:
                    yield out()
                node, digest = n, hashlib.sha256(piece)
    if node is not None:
        yield out()


def _joined(nodes: DataFrame, pieces: DataFrame) -> DataFrame:
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    sha = pieces.select("node", "conv_id", "piece").repartition("node").sortWithinPartitions("node", "conv_id") \
        .mapInArrow(_streamed_sha, "node binary, sha string")
    known = nodes.where("ends_sha256 IS NOT NULL")
    streamed = nodes.where("ends_sha256 IS NULL").join(sha, "node").withColumn("ends_sha256", F.col("sha")).drop("sha")
    nodes = known.unionByName(streamed)
    waiting = nodes.where("parent IS NOT NULL")
    # a node that was open once is complete only once; few rows, one a block and depth
    wanted = waiting.select("scope", "parent").distinct()
    smallest = wanted.join(nodes.where("node IS NOT NULL").select(F.col("node").alias("parent"),
                                                                  F.col("conv_id").alias("up")), "parent")
    found = waiting.join(smallest, ["scope", "parent"]).withColumn("parent_conv_id", F.col("up"))
    return nodes.where("parent IS NULL").select(columns).unionByName(found.select(columns))


def with_shared_starts(keyed: DataFrame, longest: int, block: int, turns_from_base) -> DataFrame:
    """Conversations (as of :func:`conversation_keys`) rebuilt from a shared
    start: conversation c takes the first h = ``turns_from_base``(id column)
    turns (``longest`` at most) of conversation c - c % ``block`` and goes on
    with its own turns after its first h."""
    c = F.col("conv_id")
    base = keyed.select(c.alias("__base"), F.slice("turns", 1, longest).alias("__start"))
    h = turns_from_base(c).cast("int")
    none = F.slice("turns", 1, 0)
    rows = keyed.withColumn("__base", c - c % block).join(base, "__base", "left")
    start = F.slice(F.coalesce("__start", none), F.lit(1), h)
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return rows.select("conv_id", F.concat(start, rest).alias("turns"))
