"""MinHash near-duplicates by an LSH forest (operator 7).

1. One pass over the texts gives each document its shingle-set size, a 128-bit
   set digest and a MinHash signature of TREES * DEPTH values.  Documents with
   equal sets are one class from here on, so copies are never compared.
2. Every tree orders the classes by KEY_DEPTH signature values, starting at
   its own DEPTH values and going on with the next tree's, so that dense
   regions are told apart more deeply.  The rows of all trees are sorted globally (range partitions, so a dense region is
   spread over tasks), and each row is compared with the rows that follow it:
   in a sorted order these share the longest common prefixes.  The depth
   adapts to the region: where many classes share a prefix, the neighbours are
   those that agree to the deepest level, elsewhere MIN_DEPTH is enough.
   Rows next to a partition border are matched in a second small step.  A
   neighbour is a candidate if the whole signatures agree at least as often
   as four standard deviations below the wanted similarity.  This is done
   twice: first with the next row in the FIRST_TREES first orders alone, two pairs a
   class, which after step 3 joins most groups of copies; then with NEIGHBOURS
   rows in all orders, for the classes that share a prefix with another
   component, passing over rows of the same component.  Where a group is wider
   than the window, a row gives only its best neighbour in that order: all pairs
   of such groups are met again in step 4.
3. Candidates are confirmed on the full shingle sets in rounds: every
   component offers its best untried candidate to another component, what is
   confirmed is merged, and candidates whose ends have met are dropped.  A group
   of true copies shrinks by half or more a round, so it costs a few
   comparisons a class, however many candidates it has.  When a linear number is
   left, or a round refutes nearly all it tries (near misses), the rounds end.
   The candidates left over are confirmed at once, but for those inside crowded
   groups, which step 4 joins anyway.
4. Where more classes share MIN_DEPTH values than a row has neighbours, the
   window may end before a row's partner is met.  All classes of such crowded
   groups are joined once more, exactly: two sets that reach the similarity
   share one of the rarest shingles of both (prefix filter), so the classes
   that hold a rare shingle are compared in blocks of BLOCK rows: on their
   signatures, and those with a possible partner on their whole sets.  A pair is
   looked at only under the first rare shingle that it shares (as far as the
   first LISTED shingles of both tell), not under each.  Only pairs of different
   components are wanted: shingles held by one component alone are left out,
   and a block gives at most one link for two components.
5. Components over the confirmed links.  Vertices are classes; every document
   then looks up its class.  The classes with the most copies (MAX_LISTED at
   most) are broadcast, all others joined, so no join key is hot.

Two sets of similarity s share MIN_DEPTH values in at least one of the trees
with probability 1 - (1 - s**MIN_DEPTH)**TREES: more than 0.999998 at 0.8.
In a dense region a row is compared with its NEIGHBOURS nearest rows of each
order, and near misses (one template, a hot source) may fill those places;
step 4 finds the pairs this leaves out.  The signature filter of steps 2 and 4
misses a pair at exactly 0.8 with a probability of about 3 in 100,000.

Defined results: null or empty texts, or texts without words, have an empty
set and stand alone.  Rows with a null id are never linked and have a null
component.  Ids stand for documents: rows that repeat an id share its
component, and should they differ in text, candidates are confirmed on the
smallest one.  An empty table gives an empty table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewise.llm.common import few_parts, materialise, text_chunks, text_rows
from tracewise.llm.components import connected_components
from tracewise.llm.wordhash import joined, mix, run_hashes, word_hashes, word_spans

TREES = 20
DEPTH = 8
MIN_DEPTH = 3
NEIGHBOURS = 16
KEY_DEPTH = 16
FIRST_TREES = 2
BLOCK = 512
LISTED = 32
MAX_LISTED = 10_000
MAX_ROUNDS = 12


def shingle_sets(texts: list[str], words: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text."""
    for i, j in text_chunks(texts):
        buf, at = joined(texts[i:j])
        starts, ends = word_spans(buf)
        hashes = word_hashes(buf, starts, ends, fold=True)
        cut = np.searchsorted(starts, at)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if b - a >= words:
                yield np.unique(run_hashes(hashes[a:b], words))
            elif b > a:  # the whole sequence is one shingle; its length keeps it apart from others
                yield run_hashes(hashes[a:b], b - a) ^ np.uint64(b - a)
            else:
                yield np.empty(0, np.uint64)


def _coefficients(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(seed))
    # full 64-bit odd multipliers: smaller ones would keep the order of the values
    return (rng.integers(0, (1 << 64) - 1, n, dtype=np.uint64, endpoint=True) | np.uint64(1),
            rng.integers(0, (1 << 64) - 1, n, dtype=np.uint64, endpoint=True))


def signature(values: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """MinHash values (32 bits) of a set of 64-bit hashes, block by block."""
    low = None
    for i in range(0, len(values), 1024):
        x = (values[i:i + 1024] >> np.uint64(16)) & np.uint64(0xFFFFFFFF)
        h = (((x[:, None] * mul[None, :] + add) >> np.uint64(32)) & np.uint64(0xFFFFFFFF)).min(axis=0)
        low = h if low is None else np.minimum(low, h)
    return low.astype(">u4")


def sketches(rows: DataFrame, words: int, trees: int, depth: int, seed: int = 7) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, sig) of every (doc_id, text) row."""
    mul, add = _coefficients(trees * depth, seed)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                n, a, b, sig = [], [], [], []
                for s in shingle_sets(part.column("text").to_pylist(), words):
                    n.append(len(s))
                    a.append(int(mix(s).sum(dtype=np.uint64).astype(np.int64)))
                    b.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
                    sig.append(signature(s, mul, add).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.int64()),
                     pa.array(b, pa.int64()), pa.array(sig, pa.binary())],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "sig"])

    return rows.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_a long, set_b long, sig binary")


def small_of(sig: str) -> Column:
    """The last byte of each signature value."""
    return F.unhex(F.regexp_replace(F.hex(sig), ".{6}(..)", "$1"))


def _neighbour_pairs(tree: np.ndarray, keys: np.ndarray, ids: np.ndarray, comp: np.ndarray, wide: np.ndarray,
                     small: np.ndarray, min_depth: int, neighbours: int, least: float,
                     seen: int = 0) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(id, id, common prefix) of rows of different components at most
    ``neighbours`` apart whose signatures agree in a share of ``least``; of a
    ``wide`` row only the pair that agrees best.  Pairs among the first
    ``seen`` rows were given before."""
    out = []
    best = np.zeros(len(ids))
    partner, shared = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    for k in range(1, min(neighbours, len(ids) - 1) + 1):
        same = np.logical_and.accumulate(keys[:-k] == keys[k:], axis=1)
        lcp = np.where(tree[:-k] == tree[k:], same.sum(axis=1), 0)
        hit = (lcp >= min_depth) & (comp[:-k] != comp[k:])
        hit[:max(0, seen - k)] = False
        at = np.flatnonzero(hit)
        if not len(at):
            continue
        agree = (small[at] == small[at + k]).mean(axis=1)
        at, agree = at[agree >= least], agree[agree >= least]
        better = wide[at] & (agree > best[at])
        i = at[better]
        best[i], partner[i], shared[i] = agree[better], i + k, lcp[i]
        at = at[~wide[at]]
        if len(at):
            out.append((ids[at], ids[at + k], lcp[at]))
    i = np.flatnonzero(best)
    if len(i):
        out.append((ids[i], ids[partner[i]], shared[i]))
    return out


def head_groups(classes: DataFrame, trees: int, depth: int, min_depth: int) -> DataFrame:
    """(doc_id, tree, head) of the classes that share a tree's shortest prefix
    with another class."""
    own = 4 * depth
    heads = classes.select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "sig") \
        .select("doc_id", "tree", F.xxhash64("tree", F.substring("sig", F.col("tree") * own + 1, F.lit(4 * min_depth)))
                .alias("head")).repartition("head")
    return heads.join(heads.groupBy("head").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("head"), "head") \
        .select("doc_id", "tree", "head")


def shared_heads(heads: DataFrame, label: DataFrame | None, neighbours: int) -> DataFrame:
    """(doc_id, component, trees, crowd): the trees in which a class shares its
    prefix with another component (each with whether that group is wider than
    the window), and the size of the largest such group."""
    if label is None:
        named = heads.withColumn("component", F.col("doc_id"))
    else:
        named = heads.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left") \
            .withColumn("component", F.coalesce("component", "doc_id"))
    named = named.repartition("head")
    shared = named.groupBy("head").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("low"),
                                       F.max("component").alias("high")).where("low <> high").select("head", "n")
    return named.join(shared, "head").groupBy("doc_id", "component").agg(
        F.collect_set(F.struct("tree", (F.col("n") > neighbours + 1).alias("wide"))).alias("trees"), F.max("n").alias("crowd"))


def candidates(classes: DataFrame, places: DataFrame, trees: int, depth: int, min_depth: int, neighbours: int,
               parts: int, least: float) -> DataFrame:
    """(a, b, weight) with a < b: neighbours in at least one tree's sorted
    order; ``weight`` sums the common prefix lengths over the trees."""
    width = 4 * min(KEY_DEPTH, trees * depth)
    own = 4 * depth
    # most rows share their shortest prefix with no other: only the rest is sorted
    entries = classes.select("doc_id", "sig").join(places.select("doc_id", "component", "trees"), "doc_id") \
        .withColumn("small", small_of("sig")) \
        .select("doc_id", "component", F.explode("trees").alias("t"), "sig", "small") \
        .select("doc_id", "component", "t.tree", "t.wide", "sig", "small") \
        .select("doc_id", "component", "tree", "wide", F.substring(F.concat("sig", "sig"), F.col("tree") * own + 1, F.lit(width))
                .alias("key"), "small")
    ordered = entries.repartitionByRange(parts, "tree", "key", "doc_id").sortWithinPartitions("tree", "key", "doc_id")

    def run(batches):
        """Pairs inside the partition, and its first and last rows as border rows."""
        border = TaskContext.get().partitionId()
        held = None  # the last rows of the batches before
        head = 0

        def frame(kind, border_at, tree, key, small, comp, wide, a, b, lcp):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), kind, np.int32)), pa.array(np.full(len(a), border_at, np.int64)),
                 pa.array(tree, pa.int32()), pa.array(key, pa.binary()), pa.array(small, pa.binary()),
                 pa.array(comp, pa.int64()), pa.array(wide, pa.bool_()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                 pa.array(lcp, pa.int32())],
                names=["kind", "border", "tree", "key", "small", "component", "wide", "a", "b", "lcp"])

        def borders(kind, at, tree, keys, ids, comp, wide, small):
            return frame(kind, at, tree, [k.tobytes() for k in keys], [x.tobytes() for x in small], comp, wide, ids, ids,
                         np.zeros(len(ids), np.int32))

        for batch in batches:
            if not batch.num_rows:
                continue
            tree, ids, comp, wide = (batch.column(c).to_numpy(zero_copy_only=False)
                                     for c in ("tree", "doc_id", "component", "wide"))
            keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), ">u4").reshape(-1, width // 4)
            small = np.frombuffer(b"".join(batch.column("small").to_pylist()), np.uint8).reshape(len(ids), -1)
            if head < neighbours:
                take = min(neighbours - head, len(ids))
                yield borders(1, border, tree[:take], keys[:take], ids[:take], comp[:take], wide[:take], small[:take])
                head += take
            seen = 0
            if held is not None:
                seen = len(held[2])
                tree, keys, ids, comp, wide, small = (
                    np.concatenate([x, y]) for x, y in zip(held, (tree, keys, ids, comp, wide, small), strict=True))
            for a, b, lcp in _neighbour_pairs(tree, keys, ids, comp, wide, small, min_depth, neighbours, least, seen):
                none = [None] * len(a)
                yield frame(0, 0, np.zeros(len(a), np.int32), none, none, np.zeros(len(a), np.int64), np.zeros(len(a), bool),
                            np.minimum(a, b), np.maximum(a, b), lcp.astype(np.int32))
            held = tuple(x[-neighbours:] for x in (tree, keys, ids, comp, wide, small))
        if held is not None:
            yield borders(2, border + 1, *held)

    found = materialise(ordered.mapInArrow(
        run, "kind int, border long, tree int, key binary, small binary, component long, wide boolean, a long, b long, lcp int"))

    def across(_, rows):
        """Last rows of one partition against the first rows of the next."""
        rows = rows.sort_by([("kind", "descending"), ("tree", "ascending"), ("key", "ascending"), ("a", "ascending")])
        ids = rows.column("a").to_numpy()
        keys = np.frombuffer(b"".join(rows.column("key").to_pylist()), ">u4").reshape(-1, width // 4)
        small = np.frombuffer(b"".join(rows.column("small").to_pylist()), np.uint8).reshape(len(ids), -1)
        comp, wide = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("component", "wide"))
        pairs = _neighbour_pairs(rows.column("tree").to_numpy(), keys, ids, comp, wide, small, min_depth, 2 * neighbours, least)
        none = np.empty(0, np.int64)
        a, b, lcp = (np.concatenate([none, *x]) for x in (zip(*pairs, strict=True) if pairs else ((), (), ())))
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64()),
                         "lcp": pa.array(lcp.astype(np.int32))})

    crossing = found.where("kind > 0").groupBy("border").applyInArrow(across, "a long, b long, lcp int")
    inside = found.where("kind = 0").select("a", "b", "lcp")
    return inside.unionByName(crossing).groupBy("a", "b").agg(F.sum("lcp").alias("weight"))


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The (a, b) pairs whose full shingle sets reach the similarity."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.select("a", "b").join(left, "a").join(right, "b")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keep, last = [], (None, None)
                right_sets = shingle_sets(part.column("text_b").to_pylist(), words)
                for ta, y in zip(part.column("text_a").to_pylist(), right_sets, strict=True):
                    if last[0] is None or last[0] != ta:
                        last = (ta, next(shingle_sets([ta], words)))
                    x = last[1]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]) \
                    .filter(pa.array(keep, pa.bool_()))

    return rows.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of common shingles of each left and each right set."""
    none = np.empty(0, np.int64)
    both = np.intersect1d(np.concatenate([none, *left]), np.concatenate([none, *right]))
    out = np.zeros((len(left), len(right)), np.float32)

    def places(sets):
        flat = np.concatenate([none, *sets])
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.searchsorted(both, flat)
        hit = both[np.minimum(at, len(both) - 1)] == flat
        order = np.argsort(at[hit], kind="stable")
        return row[hit][order], at[hit][order]

    if len(both):
        (lr, la), (rr, ra) = places(left), places(right)
        for i in range(0, len(both), 2048):
            wide = min(2048, len(both) - i)
            x, y = (np.zeros((len(sets), wide), np.float32) for sets in (left, right))
            for m, row, at in ((x, lr, la), (y, rr, ra)):
                a, b = np.searchsorted(at, [i, i + wide])
                m[row[a:b], at[a:b] - i] = 1
            out += x @ y.T
    return out.astype(np.int64)


def _shared_tokens(index: DataFrame) -> DataFrame:
    """(token, m): the shingles of (token, doc_id, component) rows that are
    held by more than one component, and by how many rows."""
    # shingles with the same holders (those of one passage) need one comparison
    return index.groupBy("token").agg(
        F.count(F.lit(1)).alias("m"), F.min("component").alias("low"), F.max("component").alias("high"),
        F.bit_xor(F.xxhash64("doc_id")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "doc_id")).alias("y")) \
        .where("low <> high").groupBy("m", "low", "high", "x", "y").agg(F.min("token").alias("token")) \
        .select("token", "m")


def _in_blocks(index: DataFrame, sets: DataFrame):
    """``index`` (token, m, doc_id, component) with the columns of ``sets``,
    grouped by shingle and pair of blocks."""
    dealt = index.withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int")).select(
        "token", "m", "doc_id", "component", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return dealt.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")) \
        .join(sets, "doc_id").groupBy("token", "lo", "hi")


def _first_shared(lists: list[list[int]], token: int) -> np.ndarray:
    """Which pairs of rows share no listed shingle before ``token``."""
    before = []
    for one in lists:
        before.append(one[:one.index(token)] if token in one else one)
    codes = {t: k for k, t in enumerate(dict.fromkeys(t for one in before for t in one))}
    held = np.zeros((len(lists), max(1, len(codes))), np.float32)
    for row, one in enumerate(before):
        held[row, [codes[t] for t in one]] = 1
    return held @ held.T == 0


def crowded_links(sets: DataFrame, percent: int, least: float) -> DataFrame:
    """(a, b) pairs that reach the similarity and join what ``sets`` (doc_id,
    component, n, shingles, small) has in different components: all such
    components are joined, by one pair or by a chain of them.  Pairs whose
    signatures agree in a smaller share than ``least`` are not looked at."""
    def alike(key, rows):
        """The holders of one pair of blocks that have a possible partner in another component."""
        ids, comp, n, own, lo, hi = (rows.column(x).to_numpy() for x in ("doc_id", "component", "n", "own", "lo", "hi"))
        first = _first_shared(rows.column("listed").to_pylist(), key[0].as_py())
        i, j = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
        small = np.frombuffer(b"".join(rows.column("small").to_pylist()), np.uint8).reshape(len(ids), -1)
        keep = np.zeros(len(ids), bool)
        for k in i.tolist():
            fits = first[k, j] & (comp[j] != comp[k]) \
                & (100 * np.minimum(n[j], n[k]) >= percent * np.maximum(n[j], n[k]))
            at = j[fits]
            at = at[(small[at] == small[k]).mean(axis=1) >= least]
            keep[at] = True
            keep[k] |= len(at) > 0
        return rows.select(["token", "doc_id", "component"]).filter(pa.array(keep))

    def compare(_, rows):
        """The links of one pair of blocks, one for two components."""
        ids, comp, n, own, lo, hi = (rows.column(x).to_numpy() for x in ("doc_id", "component", "n", "own", "lo", "hi"))
        i, j = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
        none = np.empty(0, np.int64)
        a, b = none, none
        if len(i) and len(j) and (comp[i].min() != comp[j].max() or comp[i].max() != comp[j].min()):
            column = rows.column("shingles").combine_chunks()
            at, flat = column.offsets.to_numpy(), column.values.to_numpy()
            held = [flat[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            common = _common([held[k] for k in i.tolist()], [held[k] for k in j.tolist()])
            hit = (100 * common >= percent * (n[i][:, None] + n[j][None, :] - common)) \
                & (comp[i][:, None] != comp[j][None, :])
            x, y = np.nonzero(hit)
            a, b = i[x], j[y]
            ends = np.stack([np.minimum(comp[a], comp[b]), np.maximum(comp[a], comp[b])], axis=1)
            _, first = np.unique(ends, axis=0, return_index=True)
            a, b = ids[a[first]], ids[b[first]]
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    tokens = sets.select("doc_id", F.explode("shingles").alias("token"))
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # shingles without a second holder come first in the order of rarity, but need no place in the index
    single = F.col("n") - F.size("ranked")
    prefix = F.col("n") - F.ceil((F.col("n") * percent) / 100).cast("long") + 1
    rare = tokens.join(often, "token").groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("df", "token"))).alias("ranked")) \
        .join(sets.select("doc_id", "component", "n"), "doc_id").select(
        "doc_id", "component", F.explode(F.slice("ranked", F.lit(1), F.greatest(
            F.lit(0), prefix - single).cast("int"))).alias("x")).select("doc_id", "component", "x.token")
    rare = materialise(rare)
    index = materialise(rare.join(_shared_tokens(rare), "token").select("token", "m", "doc_id", "component"))
    # every pair has one first shared shingle in this order, and is looked at under it at least
    listed = index.groupBy("doc_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("m", "token"))), 1, LISTED)
                                         .alias("x")).select("doc_id", F.col("x.token").alias("listed"))
    small = sets.select("doc_id", "n", "small").join(listed, "doc_id")
    # whole sets go only to the holders with a partner that their signatures do not rule out
    near = materialise(_in_blocks(index, small).applyInArrow(
        alike, "token long, doc_id long, component long").distinct())
    again = near.join(_shared_tokens(near), "token")
    return _in_blocks(again, sets.select("doc_id", "n", "shingles")).applyInArrow(
        compare, "a long, b long").distinct()


def whole_sets(texts: DataFrame, words: int, trees: int, depth: int, seed: int = 7) -> DataFrame:
    """(doc_id, component, n, shingles, small) of (doc_id, component, text) rows."""
    mul, add = _coefficients(trees * depth, seed)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                held = list(shingle_sets(part.column("text").to_pylist(), words))
                small = [signature(s, mul, add).astype(np.uint8).tobytes() for s in held]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("component"), pa.array([len(s) for s in held], pa.int64()),
                     pa.array([s.view(np.int64) for s in held], pa.list_(pa.int64())), pa.array(small, pa.binary())],
                    names=["doc_id", "component", "n", "shingles", "small"])

    return texts.select("doc_id", "component", "text").mapInArrow(
        run, "doc_id long, component long, n long, shingles array<long>, small binary")


def _labelled(pairs: DataFrame, label: DataFrame | None) -> DataFrame:
    """(a, b) pairs, with further columns, whose ends lie in different
    components (ca, cb)."""
    if label is None:
        return pairs.withColumn("ca", F.col("a")).withColumn("cb", F.col("b"))
    la = label.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    lb = label.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    return pairs.join(la, "a", "left").join(lb, "b", "left").withColumn("ca", F.coalesce("ca", "a")) \
        .withColumn("cb", F.coalesce("cb", "b")).where("ca <> cb")


def _merged(label: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after more (a, b) links; the old ones stand for their links."""
    edges = links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    if label is not None:
        edges = edges.unionByName(label.select(F.col("node").alias("src"), F.col("component").alias("dst")))
    return materialise(connected_components(edges))


def confirmed_components(found: DataFrame, texts: DataFrame, label: DataFrame | None, crowded: DataFrame | None,
                         words: int, percent: int) -> DataFrame:
    """(node, component) after the candidates ``found`` (a, b, weight) that
    reach the similarity, but for those with both ends in ``crowded`` that were
    not reached in rounds."""
    n = found.count()
    rest = materialise(few_parts(_labelled(found.select("a", "b", "weight"), label), n))
    few = 2 * found.select(F.explode(F.array("a", "b")).alias("id")).distinct().count()
    for _ in range(MAX_ROUNDS):
        if n <= few:
            break
        best = rest.select("a", "b", "weight", F.explode(F.array("ca", "cb")).alias("c")) \
            .groupBy("c").agg(F.max(F.struct("weight", "a", "b")).alias("x")).select("x.a", "x.b").distinct()
        best = materialise(few_parts(best, n))
        links = materialise(confirmed(best, texts, words, percent))
        label = _merged(label, links)
        left = rest.select("a", "b", "weight").join(best, ["a", "b"], "left_anti")
        rest = materialise(few_parts(_labelled(left, label), n))
        n = rest.count()
        if links.count() * 8 < best.count():  # near misses: the rest takes the other ways
            break
    rest = rest.select("a", "b")
    if crowded is not None:
        inside = crowded.select(F.col("doc_id").alias("a"), F.lit(True).alias("in_a"))
        other = crowded.select(F.col("doc_id").alias("b"), F.lit(True).alias("in_b"))
        rest = rest.join(inside, "a", "left").join(other, "b", "left").where("in_a IS NULL OR in_b IS NULL")
    return _merged(label, confirmed(rest.select("a", "b"), texts, words, percent))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, trees: int = TREES, depth: int = DEPTH,
                    min_depth: int = MIN_DEPTH, neighbours: int = NEIGHBOURS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``."""
    rows = text_rows(docs, id_col, text_col)
    sketch = materialise(sketches(rows, words, trees, depth))
    whole = sketch.where("doc_id IS NOT NULL AND n_shingles > 0")
    key = ["set_a", "set_b", "n_shingles"]
    classes = materialise(whole.groupBy(*key).agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.first("sig").alias("sig")))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(parts, classes.count() * trees // 2000))
    # four standard deviations below the wanted similarity
    share = percent / 100
    least = share - 4 * (share * (1 - share) / (trees * depth)) ** 0.5
    # 1: the next row in a few orders; whatever this leaves apart comes again in 2
    heads = materialise(head_groups(classes, trees, depth, min_depth))
    places = materialise(shared_heads(heads, None, neighbours))
    few = places.withColumn("trees", F.slice(F.array_sort("trees"), 1, FIRST_TREES))
    shared = materialise(classes.select("doc_id", "sig").join(places.select("doc_id"), "doc_id", "left_semi"))
    found = materialise(candidates(shared, few, trees, depth, min_depth, 1, parts, least))
    texts = materialise(rows.where("doc_id IS NOT NULL").join(places.select("doc_id"), "doc_id", "left_semi")
                        .groupBy("doc_id").agg(F.min("text").alias("text")))
    label = confirmed_components(found, texts, None, None, words, percent)
    # 2: more neighbours, in other components
    places = materialise(shared_heads(heads, label, neighbours))
    found = materialise(candidates(shared, places, trees, depth, min_depth, neighbours, parts, least))
    # in a larger group a window may end before the partner
    crowded = materialise(places.where(F.col("crowd") > neighbours + 1).select("doc_id"))
    label = confirmed_components(found, texts, label, crowded, words, percent)
    if not crowded.isEmpty():
        sets = materialise(whole_sets(
            texts.join(crowded, "doc_id").join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .withColumn("component", F.coalesce("component", "doc_id")), words, trees, depth))
        label = _merged(label, crowded_links(sets, percent, least))
    # an id with several texts joins their classes
    several = sketch.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.struct(*key)).alias("low"), F.max(F.struct(*key)).alias("high")).where("low <> high").select("doc_id")
    several = materialise(several)
    if not several.isEmpty():
        own = whole.join(several, "doc_id", "left_semi").select("doc_id", *key).distinct()
        label = _merged(label, own.join(classes.select(F.col("doc_id").alias("rep"), *key), key)
                        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    # what the classes tell their documents
    told = materialise(classes.select(F.col("doc_id").alias("node"), "copies", *key).join(label, "node", "left")
                       .where("copies > 1 OR component IS NOT NULL")
                       .select(*key, "copies", F.coalesce("component", "node").alias("component")))
    total = told.agg(F.sum("copies")).first()[0] or 0
    often = max(2, -(-total // MAX_LISTED))  # so many copies can only MAX_LISTED classes have
    hot = told.where(F.col("copies") >= often).select(*key, F.col("component").alias("__hot"))
    out = sketch.select("doc_id", *key).join(F.broadcast(hot), key, "left") \
        .join(told.where(F.col("copies") < often).select(*key, "component"), key, "left") \
        .withColumn("component", F.coalesce("__hot", "component"))
    shared = label.join(several, F.col("node") == F.col("doc_id"), "left_semi") \
        .select(F.col("node").alias("doc_id"), F.col("component").alias("__own"))
    out = out.join(shared, "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("__own", "component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      (F.col("doc_id") == component).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without near-duplicates: of each component the row with the
    smallest id.  Where that id repeats, rows with equal texts become one (the
    first in the order of all their columns) and rows whose texts differ stay.
    Rows with a null id stay."""
    verdict = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    gone = verdict.where("NOT kept").select(F.col("doc_id").alias("__tw_id")).distinct()
    left = docs.join(gone, F.col(id_col).cast("long") == F.col("__tw_id"), "left_anti")
    known = left.where(F.col(id_col).isNotNull())
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    content = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # maps have no order
    first = F.min_by(content, F.to_json(content)) if "map<" in docs.schema.simpleString() else F.min(content)
    one = known.groupBy(F.col(id_col).cast("long").alias("__tw_id"), digest.alias("__tw_text")).agg(
        first.alias("__tw_row")).select("__tw_row.*")
    return one.unionByName(left.where(F.col(id_col).isNull()))
